"""Lockstep alignment against a plain one, token by token."""

import collections
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from edgeworks.llm import alignment, arrow, queries, tables

from .conftest import ODD

TRICKY = [" a", "  a  b ", " ▁ a", "▁a", "a ▁b", "a▁ b", "x\x00y", "é e", "a é b é", "<s> </s> <0x41> <|endoftext|>", "\n\n a \n b", "a\xa0 b", "🙂 🙂 a 🙂", "中 文 a", "it's we'll 's", "a\x7f b", "　a b", "a  b", "aaaa" * 2000]


@pytest.fixture(scope="module")
def own():
    return alignment.Pair(*alignment.public_files())


def plain(own, text):
    """Numbers of tokens, groups and links, the groups, and the links, by walking over all overlapping tokens."""
    nothing = (0, 0, 0, 0, "", [])
    if not text:
        return nothing
    ids = [own.a.encode(" " + text, add_special_tokens=False).ids, own.b.encode(text)]
    spelled = [[known[x] for x in side] for known, side in zip(own.bytes, ids, strict=True)]
    if any(b"".join(x) != (" " + text).encode() for x in spelled):
        return nothing
    (a, b), (end_a, end_b) = ids, [np.cumsum([len(x) for x in side]).tolist() for side in spelled]
    from_a, from_b = [0, *end_a[:-1]], [0, *end_b[:-1]]
    links, low = [], 0
    for i in range(len(a)):
        while end_b[low] <= from_a[i]:
            low += 1
        j = low
        while j < len(b) and from_b[j] < end_a[i]:
            links.append((a[i], b[j]))
            j += 1
    groups, x, y = [], 0, 0
    for e in sorted({*end_a} & {*end_b}):
        x2, y2 = end_a.index(e, x) + 1, end_b.index(e, y) + 1
        groups.append(f"{','.join(map(str, a[x:x2]))}|{','.join(map(str, b[y:y2]))}")
        x, y = x2, y2
    return len(a), len(b), len(groups), len(links), ";".join(groups), links


def _aligned(own, texts):
    out = []
    for first, end, data, offsets in arrow.text_blocks(pa.array(texts, pa.large_string()), alignment.BLOCK_BYTES):
        found = own.align(data, offsets)
        keys, pairs, groups = found["keys"].tolist(), found["pairs"].to_pylist(), found["groups"].to_pylist()
        for k in range(end - first):
            held = {(keys[c] >> 32, keys[c] & 0xFFFFFFFF): t for c, t in np.frombuffer(pairs[k], "<u4").reshape(-1, 2).tolist()}
            out.append((*(int(found[x][k]) for x in ("n_a", "n_b", "n_groups", "n_links")), groups[k], held))
    return out


def _texts(n):
    rng = random.Random(1)
    return [*ODD, *TRICKY, *("".join(rng.choices("abtheino rs'  .!<ÉéİΣ\ń 中1▁\xa0 🙂", k=rng.randint(0, 60))) for _ in range(n))]


@pytest.mark.parametrize("lane", [512, 3])
def test_equals_plain(own, monkeypatch, lane):
    monkeypatch.setattr(alignment, "LANE", lane)
    texts = [t for t in _texts(1500) if len(t or "") < 20_000]
    want = [(*w[:5], dict(collections.Counter(w[5]))) for w in (plain(own, t) for t in texts)]
    assert _aligned(own, texts) == want


def test_long_texts_are_aligned_whole(own):
    for text in ("word " * 30_000, "z" * 70_000):
        [(n_a, n_b, _, n_links, groups, held)] = _aligned(own, [text])
        assert n_a == len(own.a.encode(" " + text, add_special_tokens=False).ids) and n_b == len(own.b.encode(text))
        assert sum(held.values()) == n_links and groups.count("|") == groups.count(";") + 1


def test_small_blocks_and_caches_change_nothing(own, monkeypatch):
    texts = _texts(300)[-300:]
    want = _aligned(own, texts)
    monkeypatch.setattr(alignment, "UNITS", 20)
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 400)
    assert _aligned(alignment.Pair(*alignment.public_files()), texts) == want


def test_lockstep_on_ranges():
    rng = random.Random(2)
    for _ in range(200):
        ends = [[], []]
        bounds = [[0], [0]]
        total = 0
        for _ in range(rng.randint(0, 5)):
            size = rng.randint(0, 12)
            for side in (0, 1):
                places = sorted({*rng.sample(range(1, size), rng.randint(0, size - 1)), size}) if size else []
                ends[side] += [total + p for p in places]
                bounds[side].append(len(ends[side]))
            total += size
        a, b = (np.array(x, np.int64) for x in ends)
        count, i, j, cut = alignment.lockstep(a, b, np.array(bounds[0][:-1], np.int64), np.array(bounds[0][1:], np.int64), np.array(bounds[1][:-1], np.int64))
        start_a, start_b = np.append(0, a)[:-1], np.append(0, b)[:-1]
        want = [(x, y, a[x] == b[y]) for x in range(len(a)) for y in range(len(b)) if start_a[x] < b[y] and start_b[y] < a[x]]
        assert list(zip(i.tolist(), j.tolist(), cut.tolist(), strict=True)) == want and count.sum() == len(want)


def _check(rows, own, text_of):
    links = {k: plain(own, t) for k, t in text_of.items()}
    docs = collections.Counter(p for w in links.values() for p in set(w[5]))
    most = collections.defaultdict(int)
    for (a, _), n in docs.items():
        most[a] = max(most[a], n)
    for k, r in rows.items():
        w = links[k]
        assert r == (*w[:4], sum(docs[p] == most[p[0]] for p in w[5]), sum(docs[p] for p in w[5]))


def test_weights_over_odd_documents(spark, odd, empty, own):
    docs = odd.withColumn("BLOCK2", F.lit(1)).withColumn("x.y", F.lit("z")).withColumn("n_a", F.lit("old"))
    aligned = tables.stored(alignment.align(docs, *alignment.public_files()).withColumn("row", F.monotonically_increasing_id()))
    out = alignment.weigh(aligned)
    assert out.columns == [*[c for c in docs.columns if c != "n_a"], "n_a", "n_b", "n_groups", "n_links", "groups", "row", "n_best", "count_sum"]
    found = out.collect()
    assert len(found) == docs.count()
    _check({r["row"]: tuple(r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")) for r in found}, own, {r["row"]: r["text"] for r in found})
    assert alignment.weigh(tables.stored(alignment.align(empty, *alignment.public_files()))).count() == 0


def test_op12_against_plain(spark, sf_dir, own):
    rows = {r["doc_id"]: r for r in queries.QUERIES["op12_token_alignment"](spark, sf_dir).collect()}
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    assert rows.keys() == texts.keys()
    _check({k: tuple(r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")) for k, r in rows.items()}, own, texts)
    for k, t in texts.items():
        groups = plain(own, t)[4]
        assert rows[k]["groups_sha256"] == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")
