"""Spelling variants: words one edit apart, found through an index of variable-length grams.

A word stands between a start and an end mark. The gram at a place is the shortest one of LEAST code points or more
that is not frequent, up to MOST code points or the end mark; the dictionary of frequent grams is pruned by
frequency, so it has a proven bound, and everything rarer is its own list. A gram depends on nothing but the code points
it covers. So an edit affects only the grams over its place, and a word keeps all but `affected` of them, the most
that cover one place (for a replaced or deleted code point) or one gap (for an inserted one).

Two near words therefore share a gram among the affected + 1 rarest of each, whichever order of rarity
both use. So only these lists are merged: a join on gram, place and length, with the place shifted by one for an insertion.
Pairs that meet there are verified by their edit distance. Hash collisions of grams only add pairs to be verified.

The form of a word is its near word of largest n, if that has MARGIN times its own; roots follow forms by pointer
jumping, which ends soon as n grows tenfold at each form.

Defined cases: null texts have no words; a null doc_id counts as an empty one; repeated rows count each; words of
any length take lists in proportion to `affected` only; an empty table gives no words; other columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrow
from .tables import read, stored

LEAST, MOST = 3, 5
#: Shortest word. An edit must not affect all its grams, so it must have MOST + LEAST - 2 code points at least.
SHORTEST = 7
#: A frequent gram is in more than FREQUENT places, and in more than one of DICTIONARY of all places.
FREQUENT, DICTIONARY = 48, 20_000
MARGIN = 10
#: Code points up to which levenshtein() compares two words, and entries of a task's counts before they go out.
SHORT = 64
PARTIAL = 1_000_000
NOISE = 31
_START, _END = "\x01", "\x02"


def runs(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """(word, n) of the words of docs(doc_id, text) with at least shortest code points and two occurrences.

    A run whose checksum with its document NOISE divides loses one code point. Shorter runs only get shorter.
    """
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    found = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(F.regexp_extract_all("text", F.lit(f"[A-Za-zÀ-ÿ]{{{shortest},}}"), F.lit(0))).alias("run"))
    lowered = found.select("doc", F.translate("run", upper, lower).alias("run"))
    hashed = lowered.withColumn("h", F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary")))
    place = F.col("h") % F.length("run")
    cut = F.concat(F.substring("run", F.lit(1), place.cast("int")), F.substring("run", (place + 2).cast("int"), F.length("run")))
    words = hashed.select(F.when(F.col("h") % NOISE == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n")).where("n >= 2")


def _codes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words between their marks, and where each word begins (one entry more)."""
    words = words.cast(pa.large_string())
    text = "".join(f"{_START}{w}{_END}" for w in words.to_pylist())
    return np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64), np.append(0, np.cumsum(np.asarray(pc.utf8_length(words), np.int64) + 2))


def _grams(codes: np.ndarray, size: int) -> np.ndarray:
    """A hash of the gram of this size at each place; the last places have none."""
    h = np.full(len(codes) - size + 1, size, np.uint64) if len(codes) >= size else np.empty(0, np.uint64)
    for k in range(size):
        h = arrow.mix(h + codes[k : k + len(h)] + np.uint64(0x9E3779B97F4A7C15))
    return h


def _room(starts: np.ndarray) -> np.ndarray:
    """Code points from each place to its word's end, the end mark included."""
    size = np.diff(starts)
    return np.repeat(starts[1:], size) - np.arange(starts[-1])


def frequent_grams(words: DataFrame, least: int = LEAST, most: int = MOST, frequent: int = FREQUENT, dictionary: int = DICTIONARY) -> list[tuple[int, int]]:
    """(hash, places) of the frequent grams: fewer than (most - least + 1) * dictionary of them, whatever the number of words."""

    def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        gram, place = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
        return gram, np.bincount(place, np.concatenate([n for _, n in parts]), len(gram)).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            codes, starts = _codes(batch.column(0))
            room = _room(starts)
            for size in range(least, most + 1):
                h = _grams(codes, size)
                held.append(np.unique(h[room[: len(h)] >= size], return_counts=True))
            if sum(len(g) for g, _ in held) > PARTIAL:
                held = [summed(held)]
                if len(held[0][0]) > PARTIAL // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(held[0][0].view(np.int64)), pa.array(held[0][1])], names=["gram", "n"])
                    held = []
        if held:
            gram, n = summed(held)
            yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(n)], names=["gram", "n"])

    # places of the shortest grams; longer ones have fewer
    total = words.agg(F.sum(F.length("word") + 3 - least)).first()[0] or 0
    counted = words.select("word").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return [(r["gram"], r["n"]) for r in counted.where(F.col("n") > max(frequent, total // dictionary)).collect()]


class Index:
    """Grams of words by a dictionary of frequent ones."""

    def __init__(self, known: list[tuple[int, int]], least: int = LEAST, most: int = MOST):
        pairs = sorted((g % (1 << 64), n) for g, n in known)
        self.gram = np.array([g for g, _ in pairs], np.uint64)
        self.n = np.array([n for _, n in pairs], np.int64)
        self.least, self.most = least, most

    def frequency(self, grams: np.ndarray) -> np.ndarray:
        """Places of frequent grams; 0 for all others."""
        if not len(self.gram):
            return np.zeros(len(grams), np.int64)
        k = np.minimum(np.searchsorted(self.gram, grams), len(self.gram) - 1)
        return np.where(self.gram[k] == grams, self.n[k], 0)

    def decompose(self, words: pa.Array) -> tuple[np.ndarray, ...]:
        """Word, place, size, hash and frequency of each gram, in order, and the words' starts and code points."""
        codes, starts = _codes(words)
        room = _room(starts)
        at = np.flatnonzero(room >= self.least)
        gram = _grams(codes, self.least)[at]
        size = np.full(len(at), self.least)
        n = self.frequency(gram)
        for longer in range(self.least + 1, self.most + 1):
            grow = np.flatnonzero((size == longer - 1) & (n > 0) & (room[at] >= longer))
            gram[grow] = _grams(codes, longer)[at[grow]]
            size[grow] = longer
            n[grow] = self.frequency(gram[grow])
        word = np.searchsorted(starts, at, "right") - 1
        return word, at - starts[word], size, gram, n, starts

    def affected(self, word: np.ndarray, place: np.ndarray, size: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The most grams of each word over one code point, and over one gap."""
        out = []
        for gap in (0, 1):
            change = np.zeros(starts[-1] + 1, np.int64)
            np.add.at(change, starts[word] + place + gap, 1)
            np.add.at(change, starts[word] + place + size, -1)
            over = np.cumsum(change)[:-1]
            # a mark is neither replaced nor deleted, and nothing is inserted before the first one
            if not gap:
                over[starts[:-1]] = 0
                over[starts[1:] - 1] = 0
            out.append(np.maximum.reduceat(over, starts[:-1]) if len(starts) > 1 else over)
        return out[0], out[1]

    def lists(self, words: pa.Array) -> tuple[np.ndarray, ...]:
        """Word, role and key of the lists that a word is in: by its own length and places, role 0, and by those that an insertion would give it, role 1."""
        word, place, size, gram, n, starts = self.decompose(words)
        change, insert = self.affected(word, place, size, starts)
        length = np.diff(starts)[word].astype(np.uint64)
        order = np.lexsort((place, gram, n, word))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order)) - np.searchsorted(word, np.arange(len(starts)))[word[order]]
        out = []
        for role, most, shift in ((0, change, 0), (1, insert, 0), (1, insert, 1)):
            own = np.flatnonzero(rank <= most[word])
            key = arrow.mix(arrow.mix(gram[own] + (place[own] + shift).astype(np.uint64)) + length[own] + np.uint64(role))
            out.append((word[own], np.full(len(own), role, np.int8), key.view(np.int64)))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _shared(a: Column, b: Column) -> Column:
    """Code points that a and b begin with alike, by halving."""
    size = F.least(F.length(a), F.length(b))

    def halve(state: Column, _: Column) -> Column:
        low, high = state["low"], state["high"]
        middle = F.floor((low + high + 1) / 2).cast("int")
        same = F.substring(a, low + 1, middle - low) == F.substring(b, low + 1, middle - low)
        return F.struct(F.when(same, middle).otherwise(low).alias("low"), F.when(same, high).otherwise(middle - 1).alias("high"))

    return F.aggregate(F.sequence(F.lit(0), F.ceil(F.log2(size + 1)).cast("int")), F.struct(F.lit(0).alias("low"), size.alias("high")), halve, lambda s: s["low"])


def one_edit(a: str, b: str) -> Column:
    """Whether a and b differ by one inserted, deleted or replaced code point, behind what they share. levenshtein() says the same, but is quadratic."""
    x, y = F.col(a), F.col(b)
    k, more = _shared(x, y), F.length(y) - F.length(x)
    rest = lambda c, n: F.substring(c, n, F.length(c))
    return F.when(more == 0, (x != y) & (rest(x, k + 2) == rest(y, k + 2))).when(more == 1, rest(x, k + 1) == rest(y, k + 2)).when(more == -1, rest(x, k + 2) == rest(y, k + 1)).otherwise(False)


def near_pairs(words: DataFrame, index: Index) -> DataFrame:
    """(a, b, a_n, b_n), once a pair, of words(word, n) one edit apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 20_000):
                part = batch.slice(k, 20_000)
                word, role, key = index.lists(part.column(0))
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(word)), part.column(1).take(pa.array(word)), pa.array(role), pa.array(key)], names=["word", "n", "role", "key"])

    listed = words.select("word", "n").mapInArrow(run, T.StructType([*words.select("word", "n").schema.fields, T.StructField("role", T.ByteType()), T.StructField("key", T.LongType())]))
    left = listed.select(F.col("word").alias("a"), F.col("n").alias("a_n"), "key", "role")
    right = listed.where("role = 0").select(F.col("word").alias("b"), F.col("n").alias("b_n"), F.col("key").alias("b_key"))
    met = left.join(right, (F.col("key") == F.col("b_key")) & ((F.col("role") == 1) | (F.col("a") < F.col("b"))))
    # of one edit, the half before or the half behind it knows nothing
    half = F.floor(F.least(F.length("a"), F.length("b")) / 2).cast("int")
    alike = (F.left("a", half) == F.left("b", half)) | (F.right("a", half) == F.right("b", half))
    # long words' distances are left for what has met: the join's condition stays one that Spark compiles
    passed = (F.length("a") > SHORT) | (F.levenshtein("a", "b", 1) == 1)
    return stored(met.where(alike & passed).select("a", "b", "a_n", "b_n").distinct()).where((F.length("a") <= SHORT) | one_edit("a", "b"))


def forms(words: DataFrame, pairs: DataFrame, margin: int = MARGIN) -> DataFrame:
    """(word, n, n_near, form, form_n) of every word."""
    way = lambda x, y, n: F.struct(F.col(x).alias("word"), F.col(y).alias("near"), F.col(n).alias("near_n"))
    sides = pairs.select(F.explode(F.array(way("a", "b", "b_n"), way("b", "a", "a_n"))).alias("side")).select("side.*")
    # equal n: the smallest word, as bytes of UTF-8 have the order of code points
    best = sides.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near"))).alias("best"))
    joined = words.select("word", "n").join(best, "word", "left")
    good = -F.col("best.m") >= margin * F.col("n")
    return joined.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(good, F.col("best.near")).alias("form"), F.when(good, -F.col("best.m")).alias("form_n"))


def roots(formed: DataFrame) -> DataFrame:
    """(word, root) of every word with a form: the last of its forms."""
    jumps = stored(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        onward = jumps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = stored(jumps.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if further.where("moved").isEmpty():
            return further.select("word", "root")
        jumps = further.select("word", "root")


def spelling_groups(words: DataFrame, least: int = LEAST, most: int = MOST, margin: int = MARGIN, frequent: int = FREQUENT, dictionary: int = DICTIONARY) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of words(word, n), which are distinct and have at least SHORTEST code points."""
    if most + least - 2 > SHORTEST:
        raise ValueError("an edit could affect all grams of a word")
    words = stored(words.select("word", "n"))
    index = Index(frequent_grams(words, least, most, frequent, dictionary), least, most)
    formed = stored(forms(words, near_pairs(words, index), margin))
    return formed.join(roots(formed), "word", "left").withColumn("root", F.coalesce("root", "word"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(runs(read(spark, sf_dir, "documents"))).select("word", "form", "root", "n", "n_near", "form_n")
