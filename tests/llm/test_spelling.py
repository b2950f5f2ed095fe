"""Words one edit apart against all pairs."""

import collections
import random
import re
import zlib

import pyarrow as pa
import pytest

from edgeworks.llm import queries, spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a != b and (a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else len(b) == len(a) + 1 and a[k:] == b[k + 1 :])


def plain(words):
    """word: (n, n_near, form, form_n, root) by comparing all pairs."""
    out = {}
    for w, n in words.items():
        found = sorted((-m, x) for x, m in words.items() if near(w, x))
        form = found[0][1] if found and -found[0][0] >= 10 * n else None
        out[w] = [n, len(found), form, words[form] if form else None]
    for w, row in out.items():
        root = w
        while out[root][2] is not None:
            root = out[root][2]
        row.append(root)
    return {w: tuple(r) for w, r in out.items()}


def _found(df):
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in df.collect()}


def _family(rng, n):
    """Words and variants of theirs, with counts that make chains of forms."""
    words = {}
    for _ in range(n):
        w = "".join(rng.choices(rng.choice(["ab", "aeio", "abcdefghéßøÿ"]), k=rng.randint(7, 14)))
        words[w] = rng.choice([2, 30, 400, 5000])
        for _ in range(rng.randint(0, 6)):
            k = rng.randrange(len(w))
            w = rng.choice([w[:k] + w[k + 1 :], w[:k] + "e" + w[k:], w[:k] + "é" + w[k + 1 :], w + "s", "a" + w])
            if len(w) >= 7:
                words.setdefault(w, rng.choice([2, 3, 25, 25, 300]))
    return words


@pytest.mark.parametrize(("frequent", "dictionary"), [(spelling.FREQUENT, spelling.DICTIONARY), (0, 20_000), (3, 5), (10**9, 1)])
def test_equals_all_pairs(spark, frequent, dictionary):
    words = _family(random.Random(frequent % 97), 150)
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert _found(spelling.spelling_groups(df, frequent=frequent, dictionary=dictionary)) == plain(words)


def test_one_edit_at_any_length(spark):
    rng = random.Random(8)
    rows = [("".join(rng.choices("abé", k=rng.randint(0, 6))), "".join(rng.choices("abé", k=rng.randint(0, 6)))) for _ in range(3000)]
    df = spark.createDataFrame(rows, "a string, b string")
    got = df.select("a", "b", spelling.one_edit("a", "b").alias("x")).collect()
    assert all(r["x"] == near(r["a"], r["b"]) for r in got)


def test_long_and_uniform_words(spark):
    words = {"a" * k: 2 + k for k in range(7, 40)} | {"z" * 50_000: 2, "z" * 49_999 + "y": 40, "z" * 50_001: 3, "ab" * 4: 2, "ab" * 4 + "a": 20, "\x01\x02" * 5: 3, "\x01\x02" * 5 + "\x01": 2}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert _found(spelling.spelling_groups(df)) == plain(words)


def test_the_dictionary_is_bounded(spark):
    rng = random.Random(5)
    words = spark.createDataFrame([("".join(rng.choices("abc", k=12)), 2) for _ in range(3000)], "word string, n long").distinct()
    for dictionary in (1, 7, 40):
        assert len(spelling.frequent_grams(words, frequent=0, dictionary=dictionary)) <= 3 * dictionary


def test_an_edit_leaves_the_other_grams(spark):
    """What the merging of lists rests on: near words share all but the affected grams."""
    rng = random.Random(6)
    words = ["".join(rng.choices("abc", k=rng.randint(7, 12))) for _ in range(400)]
    known = spelling.frequent_grams(spark.createDataFrame([(w, 2) for w in words], "word string, n long"), frequent=20)
    index = spelling.Index(known)
    for w in words:
        k = rng.randrange(len(w))
        for x, gap in ((w[:k] + "c" + w[k + 1 :], 0), (w[:k] + w[k + 1 :], 0), (w[:k] + "b" + w[k:], 1)):
            held = []
            for y in (w, x):
                word, place, size, gram, n, starts = index.decompose(pa.array([y]))
                held.append(collections.Counter(gram.tolist()))
                if y is w:
                    most = [m[0] for m in index.affected(word, place, size, starts)]
            assert sum((held[0] & held[1]).values()) >= sum(held[0].values()) - most[gap]


def test_runs(spark, make_docs, odd, empty):
    texts = [None, "", "Abcdefgh abcdefgh ABCDEFGH", "Élephant élephant xélephants_abcdefgh", "short words only", "a" * 70_000, "×÷ÀÿZzzzz " * 3]
    rows = [(i, t) for i, t in enumerate(texts)] + [(2, texts[2]), (None, "abcdefgh abcdefgh")]
    want = collections.Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                want[run] += 1
    got = {r["word"]: r["n"] for r in spelling.runs(make_docs(rows)).collect()}
    assert got == {w: n for w, n in want.items() if n >= 2}
    assert spelling.spelling_groups(spelling.runs(odd)).count() >= 0
    assert spelling.spelling_groups(spelling.runs(empty)).count() == 0


def test_op11_against_all_variants(spark, sf_dir, duck):
    df = queries.QUERIES["op11_spelling_variants"](spark, sf_dir)
    found = duck.execute(queries.ORACLES["op11_spelling_variants"])
    names = [c[0] for c in found.description]
    want = {tuple(r[names.index(c)] for c in df.columns) for r in found.fetchall()}
    assert {tuple(r) for r in df.collect()} == want and any(r[df.columns.index("form")] for r in want)
