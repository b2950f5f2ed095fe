"""Byte-level BPE of words of any length against the library."""

import base64
import random

import numpy as np
import pyarrow as pa
import pytest

from edgeworks.llm import bpe


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(*bpe.public_ranks())


def _check(codec, library, texts):
    packed = codec.encode(pa.array(texts, pa.large_string()))
    for text, ids, back in zip(texts, packed, codec.decode(packed), strict=True):
        assert np.frombuffer(ids.as_py(), "<u4").tolist() == library.encode_ordinary(text)
        assert back.as_py() == text.encode()


def test_long_words(codec, library):
    rng = random.Random(1)
    texts = ["".join(rng.choices("etaoinshr", k=rng.randint(60, 700))) for _ in range(60)]
    texts += [("ab" * 300)[:k] for k in range(1, 600, 37)] + [("a" * k + "b" * (k // 3)) * 3 for k in range(1, 200, 11)]
    texts += [c * k for c in "=\na" for k in (63, 64, 65, 127, 128, 129, 500, 5000)] + ["thethe" * 60 + "x" * k for k in range(0, 90, 7)]
    texts += ["中文字符" * 200, "ไทย" * 150, "🙂" * 300, "".join(rng.choices(["tion", "the", "en", "ing"], k=3000))]
    _check(codec, library, texts)


def test_long_random_words_take_no_time(codec, library):
    rng = random.Random(2)
    _check(codec, library, ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=200_000))])


@pytest.mark.parametrize("c", ["a", "\n", "="])
def test_millions_of_one_character(codec, library, c):
    """The library is quadratic here, so its ids of a shorter run say what the tokens are, and the bytes must come back."""
    packed = codec.encode(pa.array([c * 3_000_000], pa.large_string()))
    ids = np.frombuffer(packed[0].as_py(), "<u4")
    assert codec.decode(packed)[0].as_py() == c.encode() * 3_000_000
    # all but the ends are the token that long runs are made of
    usual = np.bincount(library.encode_ordinary(c * 5000)).argmax()
    assert np.count_nonzero(ids != usual) < 12


def test_parts_and_segments_of_other_sizes(codec, library, monkeypatch):
    rng = random.Random(3)
    texts = ["".join(rng.choices("aab", k=rng.randint(1, 120))) for _ in range(150)] + ["".join(rng.choices("the ", k=50)) for _ in range(50)]
    for size in (4, 9):
        monkeypatch.setattr(bpe, "SEGMENT", size)
        monkeypatch.setattr(bpe, "RUN_IDS", 3)
        _check(bpe.Codec(*bpe.public_ranks()), library, texts)


def test_parts_have_no_token_over_a_border(codec):
    rng = random.Random(4)
    tokens = set(codec.tokens.values())
    for _ in range(200):
        word = "".join(rng.choices("qxzjktheaé", k=60)).encode()
        parts = codec._cut(word)
        assert b"".join(parts) == word
        at = 0
        for part in parts[:-1]:
            at += len(part)
            assert not any(word[a:b] in tokens for a in range(at) for b in range(at + 1, len(word) + 1))
