"""Benchmark decontamination by a prefix-filtered containment join.

Every item gives windows of WINDOW consecutive words (one window where it has fewer). A window's
shingles are ordered by rarity in the documents; containment needs all of them, so the rarest one
alone is the necessary prefix. Documents meet the windows on that shingle; its place in the window
gives the start that the window must have (position bound), the text's end gives the length bound,
and the words are then compared, first by hash and at last byte by byte.

A window index of at most BLOCK_BYTES of window text goes to the executors with the task, and a document needs
no shuffle. A larger one stays a table: two passes over the documents, whatever its size, emit the shingles that a bit
map of fixed size lets through, first to count them and then, for the prefixes, with the words around them;
these meet the windows in a shuffle join on the prefix, and the hits are merged by text digest.

Defined cases: null and wordless texts have no words, no hits and are clean; an item without words
has no window; repeated items count once by item_id; an item with a null item_id marks words as hit
but is not listed; repeated documents are each returned; empty tables give empty or clean results;
other columns are carried by find_contamination, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrow
from .components import join_hot
from .tables import checkpoint, read, stored

WINDOW = 13
SHINGLE = 3
#: A document is contaminated when at least one word in so many is hit.
SHARE = 20
BLOCK_BYTES = 8 << 20
#: Size of the bit map of shingles, as a power of two: 8 MB.
MAP_BITS = 26

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_IS_WORD = np.zeros(256, bool)
_IS_WORD[0x30:0x3A] = _IS_WORD[0x61:0x7B] = _IS_WORD[0x80:] = True
_LOWER = bytes(arrow.LOWER)

RESULT = "n_words long, n_hit long, items array<string>"


def item_windows(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item, window): the distinct windows of each item, as words joined by spaces (UTF-8 bytes)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, out = [], []
            for i, t in zip(batch["item"], batch["text"], strict=True):
                w = _WORD.findall((t or "").encode().translate(_LOWER))
                k = min(WINDOW, len(w))
                for s in range(len(w) - k + 1) if k else ():
                    ids.append(i)
                    out.append(b" ".join(w[s : s + k]))
            yield pd.DataFrame({"item": pd.Series(ids, dtype=object), "window": pd.Series(out, dtype=object)})

    return items.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text")).mapInPandas(run, "item string, window binary").distinct()


class Windows:
    """A block of windows, by the hash of their prefix shingle."""

    def __init__(self, texts: list[bytes], items: list[list[str]]):
        self.texts, self.items = texts, items
        split = [t.split(b" ") for t in texts]
        joined = b" ".join(texts)
        data = np.frombuffer(joined, np.uint8)
        starts, ends, _ = arrow.words(data, np.array([0, len(data)]), _IS_WORD)
        flat = arrow.word_hashes(data, starts, ends)
        self.length = np.array([len(w) for w in split], np.int64)
        stop = np.cumsum(self.length)
        #: word hashes of each window, padded with zeros to WINDOW
        self.words = np.zeros((len(texts), WINDOW), np.uint64)
        for n in np.unique(self.length):
            rows = np.flatnonzero(self.length == n)
            self.words[rows[:, None], np.arange(n)] = flat[(stop[rows] - n)[:, None] + np.arange(n)]
        #: windows by the size of their shingles
        self.sizes = np.minimum(self.length, SHINGLE)
        self.prefix: dict[int, tuple] = {}

    def _grams(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows, offsets and hashes of all shingles of n words."""
        rows = np.flatnonzero(self.sizes == n)
        out = [np.empty(0, np.int64)] * 2 + [np.empty(0, np.uint64)]
        parts = []
        for length in np.unique(self.length[rows]):
            own = rows[self.length[rows] == length]
            for offset in range(length - n + 1):
                h = self.words[own, offset].copy()
                for k in range(1, n):
                    h = h * np.uint64(arrow._M) + self.words[own, offset + k]
                parts.append((own, np.full(len(own), offset), arrow.mix(h)))
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else tuple(out)

    def shingles(self) -> dict[int, np.ndarray]:
        return {int(n): np.unique(self._grams(int(n))[2]) for n in np.unique(self.sizes)}

    def choose(self, counts: dict[int, np.ndarray]) -> None:
        """Keep each window's rarest shingle (ties: the lower hash, then the earlier place)."""
        for n, known in self.shingles().items():
            window, offset, h = self._grams(n)
            order = np.lexsort((offset, h, counts[n][np.searchsorted(known, h)], window))
            first = order[np.unique(window[order], return_index=True)[1]]
            first = first[np.argsort(h[first], kind="stable")]
            keys, begin = np.unique(h[first], return_index=True)
            self.prefix[n] = keys, np.append(begin, len(first)), window[first], offset[first]


def _lookup(h: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in h whose value is in sorted keys, and the key's number; a bit map drops most places first."""
    if not len(keys) or not len(h):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    maybe = np.zeros(1 << 20, bool)
    maybe[(keys >> np.uint64(44)).astype(np.int64)] = True
    at = np.flatnonzero(maybe[(h >> np.uint64(44)).astype(np.int64)])
    k = np.minimum(np.searchsorted(keys, h[at]), len(keys) - 1)
    same = keys[k] == h[at]
    return at[same], k[same]


def _blocks(column: pa.Array) -> Iterator[tuple]:
    for first, end, data, offsets in arrow.text_blocks(column):
        data = arrow.LOWER[data]
        starts, ends, first_word = arrow.words(data, offsets, _IS_WORD)
        yield first, end, data, starts, ends, first_word, arrow.word_hashes(data, starts, ends)


def count_shingles(texts: DataFrame, shingles: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Occurrences of each shingle over all documents, within or across words of one text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {n: np.zeros(len(keys), np.int64) for n, keys in shingles.items()}
        for batch in batches:
            for _, _, _, _, _, first_word, h in _blocks(batch.column(0)):
                for n, keys in shingles.items():
                    at, k = _lookup(arrow.gram_hashes(h, n), keys)
                    inside = np.searchsorted(first_word, at, "right") == np.searchsorted(first_word, at + n - 1, "right")
                    total[n] += np.bincount(k[inside], minlength=len(keys))
        for n, x in total.items():
            k = np.flatnonzero(x)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), n), pa.int32()), pa.array(k, pa.int32()), pa.array(x[k], pa.int64())], names=["n", "k", "seen"])

    out = {n: np.zeros(len(keys), np.int64) for n, keys in shingles.items()}
    for r in texts.mapInArrow(run, "n int, k int, seen long").groupBy("n", "k").agg(F.sum("seen").alias("seen")).collect():
        out[r["n"]][r["k"]] = r["seen"]
    return out


def match(column: pa.Array, index: Windows) -> tuple[np.ndarray, list[np.ndarray | None], list[list[str]]]:
    """For each text: number of words, hit flags by word (None without hits), items with occurring windows."""
    n_words, hits, items = np.zeros(len(column), np.int64), [None] * len(column), [[] for _ in range(len(column))]
    for first, end, data, starts, ends, first_word, h in _blocks(column):
        n_words[first:end] = np.diff(first_word)
        found: dict[int, set] = {}
        for n, (keys, begin, windows, offsets) in index.prefix.items():
            at, k = _lookup(arrow.gram_hashes(h, n), keys)
            size = begin[k + 1] - begin[k]
            place = np.repeat(at, size)
            entry = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin[k], size)
            w, start = windows[entry], place - offsets[entry]
            doc = np.searchsorted(first_word, place, "right") - 1
            fits = (start >= first_word[doc]) & (start + index.length[w] <= first_word[doc + 1])
            w, start, doc = w[fits], start[fits], doc[fits]
            for a in range(0, len(w), 1 << 16):
                ww, ss, dd = w[a : a + (1 << 16)], start[a : a + (1 << 16)], doc[a : a + (1 << 16)]
                inside = np.arange(WINDOW) < index.length[ww][:, None]
                equal = (h[np.minimum(ss[:, None] + np.arange(WINDOW), len(h) - 1)] == index.words[ww]) | ~inside
                ok = equal.all(axis=1)
                for x, s, d in zip(ww[ok].tolist(), ss[ok].tolist(), dd[ok].tolist(), strict=True):
                    e = s + int(index.length[x])
                    if b" ".join(data[i:j].tobytes() for i, j in zip(starts[s:e].tolist(), ends[s:e].tolist(), strict=True)) == index.texts[x]:
                        row = first + d
                        if hits[row] is None:
                            hits[row] = np.zeros(int(n_words[row]), bool)
                        hits[row][s - first_word[d] : e - first_word[d]] = True
                        found.setdefault(row, set()).update(index.items[x])
        for row, names in found.items():
            items[row] = sorted(names)
    return n_words, hits, items


def _collect(windows: DataFrame) -> Windows:
    by: dict[bytes, list[str]] = {}
    for r in windows.toLocalIterator():
        by.setdefault(bytes(r["window"]), []).extend([r["item"]] if r["item"] is not None else [])
    texts = sorted(by)
    return Windows(texts, [sorted(by[t]) for t in texts])


# -- a window index of any size ---------------------------------------------------------------


def _bit_map(hashes: DataFrame) -> np.ndarray:
    """Which values of the upper MAP_BITS bits the column h has: 2**MAP_BITS bits, whatever the number of rows."""
    word = F.shiftrightunsigned("h", 64 - MAP_BITS + 6)
    bit = F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(h, {64 - MAP_BITS}) & 63 AS INT))")
    found = hashes.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(1 << (MAP_BITS - 6), np.uint64)
    out[np.asarray(found["word"])] = np.asarray(found["bits"], np.int64).view(np.uint64)
    return out


def _known(h: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Places of hashes that the bit map lets through."""
    top = h >> np.uint64(64 - MAP_BITS)
    return np.flatnonzero(bits[(top >> np.uint64(6)).astype(np.int64)] >> (top & np.uint64(63)) & np.uint64(1))


def _occurrences(column: pa.Array, sizes: list[int], bits: np.ndarray) -> Iterator[tuple]:
    """(first row, data, starts, ends, first_word, n, places, hashes) of the shingles in each block that the bit map lets through."""
    for first, _, data, starts, ends, first_word, h in _blocks(column):
        for n in sizes:
            grams = arrow.gram_hashes(h, n)
            at = _known(grams, bits)
            at = at[np.searchsorted(first_word, at, "right") == np.searchsorted(first_word, at + n - 1, "right")]
            yield first, data, starts, ends, first_word, n, at, grams[at]


def window_shingles(windows: DataFrame) -> DataFrame:
    """(window, h, n, offset): every shingle of each window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                index = Windows(batch.column(0).to_pylist(), [])
                for n in np.unique(index.sizes).tolist():
                    window, offset, h = index._grams(n)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(window)), pa.array(h.view(np.int64)), pa.array(np.full(len(h), n), pa.int32()), pa.array(offset, pa.int32())], names=["window", "h", "n", "offset"])

    return windows.select("window").mapInArrow(run, "window binary, h long, n int, offset int")


def prefixes(windows: DataFrame, texts: DataFrame) -> tuple[DataFrame, list[int]]:
    """(h, offset, window, items, n) of each distinct window's rarest shingle, n its occurrences in the texts; and the sizes of shingles."""
    whole = stored(windows.groupBy("window").agg(F.collect_list("item").alias("items")))
    shingles = stored(window_shingles(whole))
    sizes = sorted(r[0] for r in shingles.select("n").distinct().collect())
    bits = _bit_map(shingles)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for *_, n, _, h in _occurrences(batch.column(0), sizes, bits):
                keys, seen = np.unique(h, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), n), pa.int32()), pa.array(keys.view(np.int64)), pa.array(seen)], names=["n", "h", "seen"])

    counts = texts.mapInArrow(count, "n int, h long, seen long").groupBy("n", "h").agg(F.sum("seen").alias("seen"))
    # ties: the lower hash, then the earlier place
    ranked = shingles.join(counts, ["n", "h"], "left").select("window", F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "h", "offset").alias("best"))
    chosen = ranked.groupBy("window").agg(F.min("best").alias("best"))
    return stored(chosen.join(whole, "window").select("best.h", "best.offset", "window", "items", F.col("best.seen").alias("n"))), sizes


def joined_hits(windows: DataFrame, texts: DataFrame) -> DataFrame:
    """(key, n_hit, items, n): hit words and items of each distinct text with hits, by its digest, and how many texts are equal to it."""
    chosen, sizes = prefixes(windows, texts)
    bits = _bit_map(chosen)

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            for first, data, starts, ends, first_word, _, at, h in _occurrences(column, sizes, bits):
                row = np.searchsorted(first_word, at, "right") - 1
                digest = {r: hashlib.sha256(column[first + r].as_py().encode()).digest() for r in np.unique(row).tolist()}
                low, high = np.maximum(at - WINDOW + 1, first_word[row]), np.minimum(at + WINDOW, first_word[row + 1])
                words = [b" ".join(data[i:j].tobytes() for i, j in zip(starts[a:b].tolist(), ends[a:b].tolist(), strict=True)) for a, b in zip(low.tolist(), high.tolist(), strict=True)]
                columns = [pa.array(h.view(np.int64)), pa.array([digest[r] for r in row.tolist()], pa.binary()), pa.array(low - first_word[row], pa.int32()), pa.array(at - low, pa.int32()), pa.array(words, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["h", "key", "low", "lead", "words"])

    found = texts.mapInArrow(around, "h long, key binary, low int, lead int, words binary")
    # hashes that only share their bits, or other shingles, end here: the words decide
    met = join_hot(found, chosen, "h").select("key", "low", "lead", "words", "offset", "window", "items")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, low, lead, words, offset, window = (batch.column(k).to_pylist() for k in range(6))
            kept, begin, end = [], [], []
            for i in range(batch.num_rows):
                a, size = lead[i] - offset[i], window[i].count(b" ") + 1
                if a >= 0 and b" ".join(words[i].split(b" ")[a : a + size]) == window[i]:
                    kept.append(i)
                    begin.append(low[i] + a)
                    end.append(low[i] + a + size)
            yield pa.RecordBatch.from_arrays([pa.array([key[i] for i in kept], pa.binary()), pa.array(begin, pa.int32()), pa.array(end, pa.int32()), batch.column(6).take(pa.array(kept, pa.int64()))], names=["key", "begin", "end", "items"])

    hits = met.mapInArrow(verify, "key binary, begin int, end int, items array<string>")
    # equal texts have the same hits
    hits = hits.groupBy("key", "begin", "end", "items").agg(F.count("*").alias("copies"))

    def merge(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("begin")
        reached = np.concatenate([[0], np.maximum.accumulate(group["end"].to_numpy())[:-1]])
        n_hit = np.maximum(0, group["end"].to_numpy() - np.maximum(group["begin"].to_numpy(), reached)).sum()
        return pd.DataFrame({"key": [key[0]], "n_hit": [int(n_hit)], "items": [sorted({i for x in group["items"] for i in x})], "n": [int(group["copies"].max())]})

    return hits.groupBy("key").applyInPandas(merge, "key binary, n_hit long, items array<string>, n long")


def find_contamination(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs with a struct column contamination (n_words, n_hit, items), all other columns as they were."""
    windows = checkpoint(item_windows(items, item_id, item_text))
    size = windows.agg(F.sum(F.octet_length("window") + F.coalesce(F.octet_length("item"), F.lit(0)) + 16)).first()[0] or 0
    texts = docs.select(F.col(arrow.quoted(text)).alias("text"))
    kept = [c for c in docs.columns if c != "contamination"]
    source = docs.select(*[F.col(arrow.quoted(c)) for c in kept])
    place = kept.index(text)

    if size <= block_bytes:
        index = _collect(windows)
        index.choose(count_shingles(texts, index.shingles()))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n_words, hits, found = match(batch.column(place), index)
                n_hit = [0 if x is None else int(x.sum()) for x in hits]
                struct = pa.StructArray.from_arrays([pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(found, pa.list_(pa.string()))], names=["n_words", "n_hit", "items"])
                yield pa.RecordBatch.from_arrays([*batch.columns, struct], names=[*batch.schema.names, "contamination"])

        return arrow.mapped(source, run, len(kept), T.StructField("contamination", T._parse_datatype_string(RESULT)))

    no_windows = Windows([], [])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(match(batch.column(place), no_windows)[0], pa.int64())], names=[*batch.schema.names, size_name])

    size_name, key, hit, names = arrow.free(kept, "n_words", "key", "n_hit", "items")
    counted = arrow.mapped(source, count, len(kept), T.StructField(size_name, T.LongType()))
    counted = counted.withColumn(key, F.unhex(F.sha2(F.col(arrow.quoted(text)).cast("binary"), 256)))
    merged = joined_hits(windows, texts).select(F.col("key").alias(key), F.col("n_hit").alias(hit), F.col("items").alias(names), "n")
    result = F.struct(F.col(size_name).alias("n_words"), F.coalesce(hit, F.lit(0).cast("long")).alias("n_hit"), F.coalesce(names, F.array().cast("array<string>")).alias("items"))
    return join_hot(counted, merged, key, "left").select(*[F.col(arrow.quoted(c)) for c in kept], result.alias("contamination"))


def contaminated() -> Column:
    return (F.col("contamination.n_hit") > 0) & (SHARE * F.col("contamination.n_hit") >= F.col("contamination.n_words"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, read(spark, sf_dir, "benchmark"))
    c = F.col("contamination")
    return found.select("doc_id", c["n_words"].alias("n_words"), c["n_hit"].alias("n_hit"), F.size(c["items"]).cast("long").alias("n_items"), F.sha2(F.array_join(c["items"], ","), 256).alias("items_sha256"), contaminated().alias("contaminated"))
