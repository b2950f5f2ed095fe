"""BPE with word ends against the library."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from edgeworks.llm import arrow, queries, word_bpe

from .conftest import ODD

TRICKY = ["a" * 5000, "<|endoftext|>", "x<|endoftext|>y <|startoftext|>", "<|EndOfText|>", "don't we'LL 'S", "é É é ́a ΑΣ Σ İ", "a b　c\x1cd\x85e\xa0f", "ﬁ 中文字 🙂🙂", "123 4५6", "=" * 3000, "\n\n a"]


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def codec():
    return word_bpe.Codec(word_bpe.public_tokenizer())


def _ids(codec, texts):
    out = []
    for _, _, data, offsets in arrow.text_blocks(pa.array(texts, pa.large_string()), word_bpe.BLOCK_BYTES):
        packed = codec.encode(data, offsets)
        out += [(np.frombuffer(x.as_py(), "<u4").tolist(), y.as_py().decode()) for x, y in zip(packed, codec.decode(packed), strict=True)]
    return out


def _want(library, texts):
    found = library.encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [(x.ids, library.decode(x.ids, skip_special_tokens=False)) for x in found]


def test_equals_library(codec, library):
    rng = random.Random(1)
    texts = [t or "" for t in ODD] + TRICKY
    texts += ["".join(rng.choices("abtheino rs' .!<|ÉéİΣσ\ń 中1५", k=rng.randint(0, 60))) for _ in range(3000)]
    texts += ["".join(rng.choices("aab", k=rng.randint(0, 80))) for _ in range(1000)]
    texts += [f"a{chr(i)}b{chr(i)}{chr(i)} {chr(i)}" for i in range(1, 0x3000)]
    assert _ids(codec, texts) == _want(library, texts)


def _merged(merges, ids):
    """The leftmost pair of least rank, again and again."""
    while True:
        ranks = [merges.merge.get(a << merges.shift | b, 1 << 60) for a, b in zip(ids, ids[1:])]
        if not ranks or min(ranks) == 1 << 60:
            return ids
        k = ranks.index(min(ranks))
        made = next(t for t, r in merges.rank.items() if r == ranks[k])
        ids = [*ids[:k], made, *ids[k + 2 :]]


def test_pairs_of_tokens_stay_apart_as_plain_merging_says(codec):
    rng = random.Random(2)
    merges = codec.merges
    text = {i: t for t, i in merges.inner.items() if i >= 0}
    short = [i for i, t in text.items() if len(t) <= 3]
    pairs = [(rng.choice(short), rng.choice(short)) for _ in range(500)]
    for word in ("aaaa", "aaaaaa", "thethe", "ininin", "ssss"):
        for k in range(1, len(word)):
            pairs += [(merges.inner[x], merges.inner[y]) for x in [word[:k]] for y in [word[k:]] if min(merges.inner.get(x, -1), merges.inner.get(y, -1)) >= 0]
    for a, b in pairs:
        assert merges.stay_apart(a, b) == (_merged(merges, [merges.inner[c] for c in text[a] + text[b]]) == [a, b])


def test_long_words_take_time_in_proportion(codec, library):
    rng = random.Random(3)
    texts = ["z" * 400_000, "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=200_000)), "a\n" * 100_000]
    assert _ids(codec, texts) == _want(library, texts)


def test_small_caches_and_blocks_change_nothing(library, monkeypatch):
    monkeypatch.setattr(word_bpe, "PIECES", 50)
    monkeypatch.setattr(word_bpe, "PAIRS", 20)
    monkeypatch.setattr(word_bpe, "BLOCK_BYTES", 300)
    rng = random.Random(4)
    texts = [" ".join("".join(rng.choices("abthe", k=rng.randint(1, 7))) for _ in range(rng.randint(0, 60))) for _ in range(200)]
    assert _ids(word_bpe.Codec(word_bpe.public_tokenizer()), texts) == _want(library, texts)


def test_ids_outside_the_vocabulary(codec):
    with pytest.raises(ValueError, match="not in the vocabulary"):
        codec.decode(pa.array([np.array([60_000], "<u4").tobytes()], pa.large_binary()))


def test_other_models_are_refused():
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as file, pytest.raises(ValueError, match="word ends"):
        word_bpe.Codec(file.read())


def test_operator_carries_columns(spark, odd, empty, library):
    tokenizer = word_bpe.public_tokenizer()
    docs = odd.withColumn("IDS2", F.lit("x")).withColumn("a.b", F.lit(1))
    out = word_bpe.encode(docs, tokenizer, decoded="decoded")
    assert out.columns == [*docs.columns, "ids", "decoded"]
    rows = out.collect()
    assert len(rows) == docs.count()
    for r in rows:
        [(ids, text)] = _want(library, [r["text"]])
        assert (np.frombuffer(r["ids"], "<u4").tolist(), r["decoded"]) == (ids, text)
    again = word_bpe.decode(out.drop("decoded"), tokenizer).select("decoded").collect()
    assert sorted(r["decoded"] for r in again) == sorted(r["decoded"] for r in rows)
    assert word_bpe.encode(empty, tokenizer).count() == 0


def test_op13_against_library(spark, sf_dir, library):
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.QUERIES["op13_word_bpe"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for d, (ids, text) in zip(docs, _want(library, [d["text"] for d in docs]), strict=True):
        want[d["doc_id"]] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    assert got == want
