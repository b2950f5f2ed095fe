"""Operators that bring documents together, against plain versions; and the pipeline."""

import base64
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from edgeworks.llm import components, passages, sharding, simhash

from .conftest import ODD


def plain_classes(pairs, nodes):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(70)] + [(2000, 2000 + i) for i in range(1, 90)]
    want = plain_classes(pairs, {n for p in pairs for n in p if p[0] != p[1]})
    got = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == want
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_fingerprint(text):
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    grams = [" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_components(spark, make_docs, odd, empty):
    rng = random.Random(2)
    base = [" ".join(rng.choices(["Alpha", "beta", "GAMMA", "δ", "e5"], k=rng.randint(1, 40))) for _ in range(40)]
    docs = make_docs([*base, *base[:10], *(t + " tail" for t in base[:20])]).unionByName(odd.withColumn("doc_id", F.col("doc_id") + 500))
    rows = simhash.near_components(simhash.fingerprints(docs.withColumn("component_id", F.lit(None).cast("long")).drop("component_id"))).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    prints = collections.defaultdict(set)
    for r in rows:
        prints[r["doc_id"]].add(r["fingerprint"] % (1 << 64))
    assert len(rows) == docs.count()
    assert all(plain_fingerprint(texts[i]) in prints[i] for i in texts)
    nodes = sorted({p for s in prints.values() for p in s})
    links = [(a, b) for k, a in enumerate(nodes) for b in nodes[k:] if (a ^ b).bit_count() <= 2]
    root = plain_classes(links, nodes)
    first = collections.defaultdict(list)
    for r in rows:
        first[root[r["fingerprint"] % (1 << 64)]] += [r["doc_id"]] if r["doc_id"] is not None else []
    for r in rows:
        assert r["component_id"] == min(first[root[r["fingerprint"] % (1 << 64)]], default=None)
    assert simhash.near_components(simhash.fingerprints(empty)).count() == 0


def test_op7_against_plain(spark, sf_dir, duck):
    """Fingerprints of all documents from shingles counted one by one, and their components by brute force."""
    texts = dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())
    rows = {r["doc_id"]: r for r in simhash.op7(spark, sf_dir).collect()}
    assert rows.keys() == texts.keys()
    prints = {i: int(r["fingerprint"], 16) for i, r in rows.items()}
    assert all(prints[i] == plain_fingerprint(t or "") and len(rows[i]["fingerprint"]) == 16 for i, t in texts.items())
    nodes = sorted(set(prints.values()))
    points = np.array(nodes, np.uint64)
    links = np.argwhere(np.triu(simhash.hamming(points[:, None], points[None, :]) <= 2, 1))
    root = plain_classes([(nodes[a], nodes[b]) for a, b in links], nodes)
    first = collections.defaultdict(list)
    for i, x in prints.items():
        first[root[x]].append(i)
    assert all(rows[i]["component_id"] == min(first[root[x]]) for i, x in prints.items())


@pytest.mark.parametrize("dense", [False, True])
def test_sharded_tree_loses_no_link(spark, dense):
    rng = np.random.default_rng(3)
    points = rng.integers(0, 1 << 63, 1500, dtype=np.uint64)
    if dense:
        points = np.concatenate([points[:300], points[0] ^ (np.uint64(1) << rng.integers(0, 20, 2000).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 20, 2000).astype(np.uint64))])
    else:
        points = np.concatenate([points, points[:700] ^ (np.uint64(1) << rng.integers(0, 63, 700).astype(np.uint64)), points[:300] ^ np.uint64(7)])
    points = np.unique(points)
    distinct = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fingerprint long")
    links = simhash.near_links(distinct).toPandas()
    pairs = list(zip(links["a"], links["b"], strict=True))
    assert len(pairs) < 60 * len(points)
    signed = [int(p) for p in points.view(np.int64)]
    near = np.argwhere(np.triu(simhash.hamming(points[:, None], points[None, :]) <= 2, 1))
    assert plain_classes(pairs, signed) == plain_classes([(signed[a], signed[b]) for a, b in near], signed)


# -- sharding ---------------------------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 3, 24, 60, 900])
def test_cuts_are_the_exact_minimax(spark, n):
    rng = random.Random(n)
    groups = sorted((rng.getrandbits(64) - (1 << 63), rng.choice([8, 100, rng.randint(8, 9000)])) for _ in range(n))
    sizes = np.array([s for _, s in groups])
    cuts = sharding.minimax_cuts(spark.createDataFrame(groups, "key long, bytes long"), 7)
    shard = [sum(k >= c for c in cuts) for k, _ in groups]
    got = max(sum(s for s, x in zip(sizes, shard, strict=True) if x == k) for k in set(shard))

    def fits(capacity):
        used, left = 1, capacity
        for s in sizes:
            if s > left:
                used, left = used + 1, capacity
            left -= s
        return used <= 7

    assert got <= next(c for c in range(max(sizes.max(), -(-sizes.sum() // 7)), sizes.sum() + 1) if fits(c))
    assert shard == sorted(shard) and max(shard) < 7


def test_shards(spark, make_docs, odd, empty):
    rng = random.Random(5)
    docs = make_docs(["hot " * 50] * 300 + ["x" * rng.randint(0, 400) + str(i) for i in range(600)], ["1 AS key", "2 AS bucket", "'s' AS shard"])
    rows = sharding.assign_shards(docs).collect()
    by_shard, by_text = collections.defaultdict(list), collections.defaultdict(set)
    for r in rows:
        by_shard[r["shard"]].append(r)
        by_text[r["text"]].add(r["shard"])
        assert r["size"] == len(r["text"].encode()) + 8
    assert len(rows) == 900 and all(len(s) == 1 for s in by_text.values())
    assert all(sorted(r["slot"] for r in v) == list(range(len(v))) for v in by_shard.values())
    sizes = sorted(sum(r["size"] for r in v) for v in by_shard.values())
    assert len(sizes) == 24 and sizes[-2] - sizes[0] < 2 * 420
    assert sharding.assign_shards(odd).count() == len(ODD) + 2
    assert sharding.assign_shards(empty).count() == 0


def test_op9_columns(spark, sf_dir, duck):
    texts = dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())
    rows = sharding.op9(spark, sf_dir).collect()
    assert {r["doc_id"] for r in rows} == texts.keys()
    assert all(r["text_crc32"] == zlib.crc32((texts[r["doc_id"]] or "").encode()) and r["law"] == "bytes" for r in rows)


def test_shard_files(spark, make_docs, tmp_path):
    assigned = sharding.assign_shards(make_docs([f"text {i}" * (i % 9) for i in range(100)]))
    sharding.write_shards(assigned, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == 100


# -- passages ---------------------------------------------------------------------------------


def test_chain_against_quadratic():
    rng = random.Random(6)
    for _ in range(60):
        n = rng.randint(2, 30)
        points = sorted({(rng.randrange(60), rng.randrange(60)) for _ in range(n)})
        x, y = [p[0] for p in points], [p[1] for p in points]
        best = []
        for j in range(len(points)):
            own = passages.SEED_SCORE
            before = [best[i] - passages.GAP_COST * (x[j] - x[i] + y[j] - y[i]) + min(passages.SEED_SCORE, x[j] - x[i], y[j] - y[i]) for i in range(j) if x[i] < x[j] and y[i] < y[j]]
            best.append(max([own, *before]))
        found = passages.chain(x, y)
        assert all(x[a] < x[b] and y[a] < y[b] for c in found for a, b in zip(c, c[1:], strict=False))
        # every seed is in one chain, a lone one in its own; longer chains only where a predecessor pays
        assert len({i for c in found for i in c}) == sum(map(len, found)) == len(points)
        assert max(map(len, found)) == 1 or max(best) > passages.SEED_SCORE


def test_planted_passages(spark, make_docs, odd, empty):
    rng = random.Random(7)
    vocabulary = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(4000)]
    text = lambda n: rng.choices(vocabulary, k=n)
    shared, fuzzy = text(60), text(80)
    docs = [text(150) for _ in range(30)]
    for i in (1, 5, 9, 12):
        docs[i] = docs[i][:70] + shared + docs[i][70:]
    for i in (3, 7, 20):
        noisy = [w if rng.random() > 0.06 else "zz" for w in fuzzy]
        docs[i] = docs[i][:40] + noisy + docs[i][40:]
    docs[14] = list(docs[2])
    table = make_docs([", ".join(d) for d in docs]).unionByName(odd.withColumn("doc_id", F.col("doc_id") + 1000))
    got = {r["doc_id"]: r for r in passages.repeated_passages(table).where("doc_id < 1000").collect()}
    for i in (1, 5, 9, 12):
        assert got[i]["class_id"] == 1 and got[i]["spans"][0]["start"] <= 70 and got[i]["spans"][0]["end"] >= 130 and 60 <= got[i]["n_repeated"] <= 75
    for i in (3, 7, 20):
        assert got[i]["class_id"] == 3 and 60 <= got[i]["n_repeated"] <= 90
    assert got[14]["class_id"] == 2 and got[2]["n_repeated"] == 150
    clean = set(range(30)) - {1, 5, 9, 12, 3, 7, 20, 2, 14}
    assert all(got[i]["n_repeated"] == 0 and got[i]["class_id"] == i for i in clean)
    assert passages.repeated_passages(table).count() == table.count()
    assert passages.repeated_passages(empty).count() == 0


def test_op3_finds_every_exact_run(spark, sf_dir, duck):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = {i: word.findall((t or "").translate(lower)) for i, t in duck.execute("SELECT doc_id, text FROM documents").fetchall()}
    where = collections.defaultdict(set)
    for i, w in words.items():
        for k in range(len(w) - 49):
            where[tuple(w[k : k + 50])].add(i)
    rows = {r["doc_id"]: r for r in passages.op3(spark, sf_dir).collect()}
    covered = {i: {p for s in r["spans"].split(",") if s for p in range(*map(int, s.split(":")))} for i, r in rows.items()}
    for i, w in words.items():
        assert rows[i]["n_words"] == len(w)
        for k in range(len(w) - 49):
            own = where[tuple(w[k : k + 50])]
            if len(own) > 1:
                assert covered[i].issuperset(range(k, k + 50)) and len({rows[j]["class_id"] for j in own}) == 1


def test_chain_over_a_gap_is_cut(spark, make_docs):
    rng = random.Random(17)
    new = iter(range(10**6))
    text = lambda n: [f"w{next(new)}" for _ in range(n)]
    for gap in (40, 55, 300):
        one, two = text(60), text(60)
        docs = [text(30) + one + text(gap) + two + text(30) for _ in range(2)]
        found = {r["doc_id"]: r["spans"] for r in passages.repeated_passages(make_docs([" ".join(d) for d in docs])).collect()}
        for i in (0, 1):
            assert [(s["start"], s["end"]) for s in found[i]] == [(30, 90), (90 + gap, 150 + gap)]
    for _ in range(50):
        a, b = [[rng.randrange(5) for _ in range(rng.randrange(25))] for _ in range(2)]
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        assert passages._between(a, b) == table[-1, -1]


def node_of(text):
    n = xxhash.xxh64_intdigest(text.encode(), 42)
    return n - (n >> 63 << 64)


def test_passage_whose_seeds_have_other_hubs(spark, make_docs):
    new = iter(range(10**6))
    text = lambda n: [f"v{next(new)}" for _ in range(n)]
    shared = text(60)
    a, b = (" ".join(text(40) + shared + text(40)) for _ in range(2))
    # the parts occur alone in texts of lower hashes
    others = []
    for part in (shared[:25], shared[20:45], shared[40:]):
        other = " ".join(text(30) + part + text(30))
        while node_of(other) >= min(node_of(a), node_of(b)):
            other = " ".join(text(30) + part + text(30))
        others.append(other)
    found = {r["doc_id"]: r for r in passages.repeated_passages(make_docs([a, b, *others])).collect()}
    for i in (0, 1):
        assert [(s["start"], s["end"]) for s in found[i]["spans"]] == [(40, 100)] and found[i]["class_id"] == 0
    assert all(found[i]["n_repeated"] == 0 for i in (2, 3, 4))


def test_every_copy_in_a_hub_counts(spark, make_docs):
    new = iter(range(10**6))
    text = lambda n: [f"u{next(new)}" for _ in range(n)]
    twice, line = text(60), text(9)
    docs = []
    for _ in range(2):
        # both texts have all copies, so either may be the hub
        docs.append(" ".join(text(30) + twice + text(200) + twice + text(30)))
        docs.append(" ".join(text(30) + line * 50 + text(30)))
    found = passages.repeated_passages(make_docs(docs)).collect()
    spans = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in found}
    assert spans == {0: [(30, 90), (290, 350)], 2: [(30, 90), (290, 350)], 1: [(30, 480)], 3: [(30, 480)]}


def test_no_pair_at_the_threshold_is_left_out(spark, make_docs):
    """40 words of which 8 are replaced, and passages all of whose seeds occur, a few at a time, in other texts too, which may be their hubs."""
    rng = random.Random(29)
    new = iter(range(10**6))
    text = lambda n: [f"t{next(new)}" for _ in range(n)]
    docs, pairs, alone = [], [], []

    def add(*parts):
        docs.append(" ".join(w for p in parts for w in p))
        return len(docs) - 1

    for n in range(120):
        a = text(40)
        b = list(a)
        for k in [4, 9, 14, 19, 24, 29, 34, 37] if n % 2 else rng.sample(range(1, 39), 8):
            b[k] = f"zz{next(new)}"
        pairs.append((add(text(50), a, text(50)), add(text(50), b, text(50))))
        if n % 3 == 0:
            alone += [add(*[x for k in range(0, 36, 6) for x in (a[k : k + 9], text(12))]) for _ in range(4)]
    got = {r["doc_id"]: r for r in passages.repeated_passages(make_docs(docs)).collect()}
    assert all(got[a]["n_links"] == got[b]["n_links"] == 1 and got[a]["class_id"] == got[b]["class_id"] for a, b in pairs)
    assert all(got[i]["n_links"] < 4 for i in alone)


# -- pipeline ---------------------------------------------------------------------------------


def test_pipeline(spark, sf_dir, duck):
    import corpus_pipeline
    import tiktoken

    from edgeworks.llm import bpe, decontaminate, secrets, toxicity
    from edgeworks.llm.tables import read

    docs, counts = read(spark, sf_dir, "documents"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, before, sf_dir).cache()
        assert docs.columns == before.columns, name
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    # what is left: no toxic, near, contaminated or secret-bearing document
    assert not any(plain_fingerprint(a) == plain_fingerprint(b) for a, b in zip(list(texts.values())[:60], list(texts.values())[1:61], strict=False))
    items = read(spark, sf_dir, "benchmark")
    assert decontaminate.find_contamination(docs, items).where(decontaminate.contaminated()).count() == 0
    assert not any(re.search("[0-9a-f]{24}", t) for t in texts.values())
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert got.keys() == texts.keys()
    rank_file, pattern = bpe.public_ranks()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines())}
    encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    for i, t in texts.items():
        ids = np.array(encoding.encode_ordinary(t), "<u4")
        assert (got[i]["n_tokens"], got[i]["ids_sha256"]) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert got[i]["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest()
    assert toxicity and secrets


def test_pipeline_stages_take_odd_documents(spark, sf_dir, odd):
    import corpus_pipeline

    docs = odd
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir).cache()
        assert docs.count() > 0


def test_pipeline_stages_take_an_empty_table(spark, sf_dir, empty):
    import corpus_pipeline

    docs = empty
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0, name


def test_every_operator_is_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names


def test_recall_of_planted_passages(spark, make_docs):
    """Exact runs around differing middles, doubled passages, runs of one word, and noisy copies, all in one table."""
    rng = random.Random(23)
    vocabulary = [f"w{k}" for k in range(50_000)]
    text = lambda n: rng.choices(vocabulary, k=n)
    docs, planted, noisy = [], collections.defaultdict(list), collections.defaultdict(list)

    def add(kind, *parts):
        """A document of parts; those given as tuples are planted."""
        at, words = 0, []
        for part in parts:
            if isinstance(part, tuple):
                planted[kind].append((len(docs), at, at + len(part)))
            words += part
            at += len(part)
        docs.append(" ".join(words))
        return len(docs) - 1

    for run in (60, 100, 200, 400):
        for middle in (20, 60, 100, 300):
            for _ in range(2):
                a, b = tuple(text(run)), tuple(text(run))
                for _ in range(2):
                    add("run", text(30), a, text(middle), b, text(30))
    for gap in (0, 5, 100):
        for _ in range(4):
            a, between = tuple(text(60)), text(gap)
            add("twice", text(30), a, between, a, text(30))
            add("twice", text(50), a, text(50))
    for n, m in ((200, 300), (60, 45), (1000, 2000)):
        word = f"same{n}"
        add("one word", (word,) * n)
        add("one word", (word,) * m)
    # words of a passage, and which of them are replaced: so many at random (of 40, within both ends), or every so many-th
    for words, rule in ((60, 3), (60, 6), (60, 9), (60, 12), (60, "every 6"), (60, "every 5"), (40, 8), (120, 24)):
        changed = words, rule
        for _ in range(60):
            a = text(words)
            b = list(a)
            inner = range(1, words - 1) if words == 40 else range(words)
            step = int(rule.split()[1]) if isinstance(rule, str) else None
            for k in range(step - 1, words, step) if step else rng.sample(inner, rule):
                b[k] = f"zz{rng.randrange(10**9)}"
            noisy[changed].append((add("", text(60), a, text(60)), add("", text(60), b, text(60))))
    groups = []
    for _ in range(4):
        a, own = text(100), []
        for _ in range(15):
            b = list(a)
            for k in rng.sample(range(100), 10):
                b[k] = f"zz{rng.randrange(10**9)}"
            own.append(add("", text(20), b, text(20)))
        groups.append(own)
    got = {r["doc_id"]: r for r in passages.repeated_passages(make_docs(docs)).collect()}
    covered = {i: {p for s in r["spans"] for p in range(s["start"], s["end"])} for i, r in got.items()}
    for kind, places in planted.items():
        found, words = (sum(f(*x) for x in places) for f in (lambda d, a, b: len(covered[d].intersection(range(a, b))), lambda d, a, b: b - a))
        assert found >= 0.98 * words, kind
    share = {k: sum(got[a]["class_id"] == got[b]["class_id"] for a, b in pairs) / len(pairs) for k, pairs in noisy.items()}
    assert min(share.values()) >= 0.9 and share[60, 3] >= 0.98, share
    assert all(len({got[i]["class_id"] for i in own}) == 1 for own in groups)


def test_hot_keys_are_joined_apart(spark):
    rows = spark.createDataFrame([(k if k is not None else None, i) for i, k in enumerate([1] * 500 + [2] * 30 + list(range(3, 60)) + [None] * 4)], "k long, v long")
    facts = rows.where("k IS NOT NULL AND k <> 7").groupBy("k").agg(F.count("*").alias("n"), F.max("v").alias("top"))
    for how in ("inner", "left"):
        got = sorted(map(tuple, components.join_hot(rows, facts, "k", how).select("k", "v", "top").collect()), key=repr)
        assert got == sorted(map(tuple, rows.join(facts.drop("n"), "k", how).select("k", "v", "top").collect()), key=repr)


def test_seeds_of_long_parts_meet(spark, monkeypatch):
    import itertools

    import pyarrow as pa

    for name, value in (("LONG", 300), ("HELD", 50), ("PACKED", 100)):
        monkeypatch.setattr(passages, name, value, raising=False)
    rng = random.Random(5)
    common = [rng.choices([f"w{k}" for k in range(3000)], k=12) for _ in range(12)]
    texts = [(i, " ".join(sum(rng.sample(common[:3] if i % 2 else common, 2), []) + [f"x{rng.randrange(300)}" for _ in range(20)])) for i in range(60)]
    # a copy of a text lies in another task
    docs = spark.createDataFrame([*texts, *texts[:5]], "node long, text string").repartition(3)
    places = collections.defaultdict(set)
    for nodes, h, first_word, _ in passages._word_hashes(iter([pa.RecordBatch.from_pydict({"node": [t[0] for t in texts], "text": [t[1] for t in texts]})])):
        for at, key in zip(*passages.seed_places(h, first_word), strict=True):
            row = int(np.searchsorted(first_word, at, "right")) - 1
            places[int(key.view(np.int64))].add((int(nodes[row]), int(at - first_word[row])))
    often = {(k, *p) for k, own in places.items() if len({n for n, _ in own}) > passages.FEW for p in own}
    pairs = collections.Counter((a, x, b, y) for own in places.values() if 1 < len({n for n, _ in own}) <= passages.FEW for (a, x), (b, y) in itertools.combinations(sorted(own), 2) if a != b)
    rows = [r for turn in range(passages.TURNS) for r in passages.seed_meetings(docs, turn, 2).collect()]
    assert often and pairs
    assert {(r["key"], r["a"], r["xs"]) for r in rows if r["b"] is None} == often
    assert collections.Counter((r["a"], r["xs"], r["b"], r["ys"]) for r in rows if r["b"] is not None) == pairs


@pytest.mark.parametrize("size", [1, 3, 7, 100])
def test_tables_have_whole_groups(size):
    import pyarrow as pa

    rng = random.Random(size)
    rows = sorted((rng.randrange(4), rng.randrange(3), k) for k in range(60))
    table = pa.table({c: [r[i] for r in rows] for i, c in enumerate("abk")})
    found = [list(zip(*(t[c].to_pylist() for c in "abk"), strict=True)) for t in passages._whole_groups(iter(table.to_batches(size)), 2)]
    assert [r for t in found for r in t] == rows
    groups = [{r[:2] for r in t} for t in found]
    assert all(not x & y for i, x in enumerate(groups) for y in groups[:i])


def test_lone_seeds_without_enough_equal_words_end_early(monkeypatch):
    # no table of runs is made for a seed whose surroundings have nothing in common
    a, b = np.arange(200, dtype=np.uint16), np.arange(1000, 1200, dtype=np.uint16)
    b[100:104] = a[90:94]
    monkeypatch.setattr(passages.np, "array", None)
    assert passages.align([90], [100], 0, a, 0, b) == []
