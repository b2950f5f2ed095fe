"""Alignment of two tokenizers' tokens over the bytes that both stand for, in lockstep.

A encodes a space and the text, B the text, before which it puts a space itself. Where both give the
same bytes, their tokens are ranges of one line of bytes. Each lane of a block of documents has a place in A's tokens and
one in B's. A step takes the pair of tokens at both places of all lanes at once: they overlap, so they are a link; the
token that ends first, or both where they end together, makes way for the next one, and an end of both is a
cut. Lanes that are through are taken out of the state vectors.

A text is cut before single spaces between characters of one or two bytes that are neither white space nor A's or
B's marks: neither tokenizer has a token over such a place. The units between these cuts repeat, so a worker keeps their
ids in a bounded cache, and lanes hold LANE units at most, so that one long document doesn't hold up a block.

How many documents hold a pair of ids linked is a sum over blocks: a block sends each of its pairs once, with the
number of its documents that hold it, and gets its pairs' counts back. Documents keep their own pairs as
places in the block's list, with how often they are linked.

Defined cases: null and empty texts, and those whose bytes differ between A, B and the text, have no tokens, zeros
and an empty groups column; repeated rows count as documents of their own; special tokens' strings are plain text;
other columns are carried along.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrow
from .components import join_hot
from .packed import Known, binary, flat
from .tables import read, stored

#: Entries and bytes of the cache of units before a worker forgets the older ones; bytes of a block; units of a lane.
UNITS, UNITS_BYTES = 500_000, 48 << 20
BLOCK_BYTES = 2 << 20
LANE = 512
_MISFIT = np.uint32(1 << 31)


def cut_places(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places of the spaces before which both tokenizers always end a token."""
    n = len(data)
    space = np.flatnonzero(data == 32)
    space = space[(space > 0) & (space < n - 1)]
    before, after = data[space - 1], data[space + 1]
    # characters of two bytes, from U+00C0: no white space, and none that a tokenizer takes for it
    two = (before >= 0x80) & (space > 1)
    two[two] = (data[space[two] - 2] >= 0xC3) & (data[space[two] - 2] <= 0xDF)
    good = ((before > 0x20) & (before < 0x7F) | two) & ((after > 0x20) & (after < 0x7F) | (after >= 0xC3) & (after <= 0xDF))
    # a space at a text's border is no cut
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    return space[good & ~edge[space] & ~edge[space + 1]]


def lockstep(a_end: np.ndarray, b_end: np.ndarray, a_from: np.ndarray, a_to: np.ndarray, b_from: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links of all lanes: number of links of each lane, and by lane and place A's token, B's token and whether both end there.

    a_end and b_end are the places where tokens end. Lane k has A's tokens a_from[k] to a_to[k] and B's from b_from[k], over the same bytes.
    """
    count = np.zeros(len(a_from), np.int64)
    lane = np.flatnonzero(a_from < a_to)
    i, j, stop = a_from[lane], b_from[lane], a_to[lane]
    steps: list[tuple[np.ndarray, ...]] = []
    while len(lane):
        ends_a, ends_b = a_end[i], b_end[j]
        steps.append((lane, i, j, ends_a == ends_b))
        i, j = i + (ends_a <= ends_b), j + (ends_b <= ends_a)
        on = i < stop
        if not on.all():
            count[lane[~on]] = len(steps)
            lane, i, j, stop = lane[on], i[on], j[on], stop[on]
    if not steps:
        return count, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    place = np.concatenate([s[0] for s in steps])
    first = np.cumsum(count) - count
    place = first[place] + np.repeat(np.arange(len(steps)), [len(s[0]) for s in steps])
    out = []
    for k in (1, 2, 3):
        part = np.concatenate([s[k] for s in steps])
        row = np.empty_like(part)
        row[place] = part
        out.append(row)
    return count, *out


class Pair:
    """Both tokenizers, the bytes of their tokens, and the units that this worker knows."""

    def __init__(self, a_file: bytes, b_file: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_str(a_file.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        # byte-level names: printable bytes are themselves, the others the characters from U+0100 on, in order
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        byte = {chr(x): x for x in plain} | {chr(0x100 + k): x for k, x in enumerate(x for x in range(256) if x not in plain)}
        names = {i: t for t, i in self.a.get_vocab(with_added_tokens=False).items()}
        a_bytes = [bytes(byte[c] for c in names.get(i, "")) for i in range(max(names) + 1)]
        b_bytes = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))]
        self.bytes = a_bytes, b_bytes
        self.size = tuple(np.array([len(x) for x in known], np.int64) for known in self.bytes)
        most = max(map(len, self.bytes))
        #: each id with what may follow it
        self.names = pa.array([f"{i}{mark}" for i in range(most) for mark in ",|;"], pa.large_string()).cast(pa.large_binary())
        self.units = Known(UNITS, UNITS_BYTES)

    def _learn(self, units: pa.Array) -> None:
        """Keep the ids of units: the number of A's, marked where the bytes differ, then A's and B's ids."""
        texts = units.cast(pa.large_string()).to_pylist()
        a_ids = [x.ids for x in self.a.encode_batch_fast([f" {t}" for t in texts], add_special_tokens=False)]
        b_ids = self.b.encode(texts, num_threads=1)
        b_bytes, out, ends = self.bytes[1], [], [0]
        for t, a, b in zip(units.to_pylist(), a_ids, b_ids, strict=True):
            # A keeps all bytes
            fits = b"".join([b_bytes[x] for x in b]) == b" " + t
            out.append(len(a) if fits else len(a) | int(_MISFIT))
            out += a
            out += b
            ends.append(len(out))
        self.units.add(units, binary(np.array(out, "<u4").tobytes(), 4 * np.array(ends, np.int64)))

    def tokens(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        """A's ids, B's ids, and for each unit of the block its row, numbers of A's and of B's ids, and whether both fit its bytes."""
        self.units.turn()
        cuts = cut_places(data, offsets)
        kept = np.ones(len(data), bool)
        kept[cuts] = False
        some = np.flatnonzero(np.diff(offsets) > 0)
        starts = np.sort(np.concatenate([offsets[some], cuts + 1]))
        row = np.searchsorted(offsets, starts, "right") - 1
        before = np.append(0, np.cumsum(kept))
        coded = binary(data[kept].tobytes(), np.append(before[starts], before[-1])).dictionary_encode()
        place = self.units.find(coded.dictionary)
        new = coded.dictionary.filter(pa.array(place < 0))
        if len(new):
            for k in range(0, len(new), 20_000):
                self._learn(new.slice(k, 20_000))
            place[place < 0] = self.units.find(new)
        packed, at = flat(self.units.values.take(pa.array(place[np.asarray(coded.indices)])))
        values, at = np.frombuffer(packed[at[0] : at[-1]].tobytes(), "<u4"), (at - at[0]) // 4
        fits = values[at[:-1]] < _MISFIT
        n_a = (values[at[:-1]] & ~_MISFIT).astype(np.int64)
        n_b = np.diff(at) - 1 - n_a
        side = np.repeat(np.tile(np.array([0, 1, 2], np.int8), len(row)), np.stack([np.ones_like(n_a), n_a, n_b], 1).ravel())
        return values[side == 1].astype(np.int64), values[side == 2].astype(np.int64), row, n_a, n_b, fits

    def _same(self, text: bytes, a: np.ndarray, b: np.ndarray) -> bool:
        want = b" " + text
        return all(b"".join([known[x] for x in ids.tolist()]) == want for known, ids in zip(self.bytes, (a, b), strict=True))

    def align(self, data: np.ndarray, offsets: np.ndarray) -> dict[str, object]:
        """Of the texts of a block: numbers of tokens, groups and links, the groups, the pairs of each text, and the block's distinct pairs."""
        rows = len(offsets) - 1
        a, b, row, n_a, n_b, fits = self.tokens(data, offsets)
        # units that don't fit may still make up a text that does; it is one lane then
        whole = np.unique(row[~fits])
        to_a, to_b = np.append(0, np.cumsum(n_a)), np.append(0, np.cumsum(n_b))
        first = np.searchsorted(row, np.arange(rows + 1))
        bad = [r for r in whole.tolist() if not self._same(data[offsets[r] : offsets[r + 1]].tobytes(), a[to_a[first[r]] : to_a[first[r + 1]]], b[to_b[first[r]] : to_b[first[r + 1]]])]
        if bad:
            gone = np.zeros(rows, bool)
            gone[bad] = True
            a, b = a[np.repeat(~gone[row], n_a)], b[np.repeat(~gone[row], n_b)]
            row, n_a, n_b = (x[~gone[row]] for x in (row, n_a, n_b))
            to_a, to_b = np.append(0, np.cumsum(n_a)), np.append(0, np.cumsum(n_b))
            first = np.searchsorted(row, np.arange(rows + 1))
        inside = np.arange(len(row)) - first[row]
        begins = (inside == 0) | ((inside % LANE == 0) & ~np.isin(row, whole))
        lanes = np.flatnonzero(begins)
        stops = np.append(lanes[1:], len(row))
        a_end, b_end = np.cumsum(self.size[0][a]), np.cumsum(self.size[1][b])
        links, i, j, cut = lockstep(a_end, b_end, to_a[lanes], to_a[stops], to_b[lanes])
        n_links = np.bincount(row[lanes], links, rows).astype(np.int64)
        link_row = np.repeat(np.arange(rows), n_links)
        cuts = np.flatnonzero(cut)
        return {
            "n_a": to_a[first[1:]] - to_a[first[:-1]], "n_b": to_b[first[1:]] - to_b[first[:-1]],
            "n_groups": np.bincount(link_row[cuts], minlength=rows).astype(np.int64), "n_links": n_links,
            "groups": self._written(a, b, i[cuts], j[cuts], to_a[first], to_b[first]),
            **self._pairs((a[i] << 32) | b[j], link_row, rows),
        }

    def _written(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray, a_bounds: np.ndarray, b_bounds: np.ndarray) -> pa.Array:
        """The groups of each text as a1,a2|b1;a3|b2, from the last tokens of the groups."""
        in_a, in_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        mark_a, mark_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        mark_a[last_a], mark_b[last_b] = 1, 2
        order = np.empty(len(a) + len(b), np.int64)
        # A's tokens come after B's of the groups before, B's after A's of their own group
        order[np.arange(len(a)) + np.repeat(np.cumsum(in_b) - in_b, in_a)] = 3 * a + mark_a
        order[np.arange(len(b)) + np.repeat(np.cumsum(in_a), in_b)] = 3 * b + mark_b
        text, at = flat(self.names.take(pa.array(order)))
        bounds = at[a_bounds + b_bounds] - at[0]
        text = text[at[0] : at[-1]]
        some = np.diff(bounds) > 0
        kept = np.ones(len(text), bool)
        kept[bounds[1:][some] - 1] = False
        return binary(text[kept].tobytes(), bounds - np.append(0, np.cumsum(some))).cast(pa.large_string()).cast(pa.string())

    @staticmethod
    def _pairs(key: np.ndarray, row: np.ndarray, rows: int) -> dict[str, object]:
        """Each text's distinct pairs as places in the block's list, with their times; the list, and how many texts hold each."""
        coded = pa.array(key).dictionary_encode()
        distinct = len(coded.dictionary)
        found = pc.value_counts(pa.array(row * max(1, distinct) + np.asarray(coded.indices)))
        value, times = np.asarray(found.field(0)), np.asarray(found.field(1))
        code = value % max(1, distinct)
        packed = np.stack([code, times], 1).astype("<u4")
        return {"pairs": binary(packed.tobytes(), 8 * np.searchsorted(value // max(1, distinct), np.arange(rows + 1))).cast(pa.binary()), "keys": np.asarray(coded.dictionary), "held": np.bincount(code, minlength=distinct)}


_pairs: dict[tuple[bytes, bytes], Pair] = {}


def pair(a_file: bytes, b_file: bytes) -> Pair:
    """The worker's tokenizers; what they keep is bounded."""
    if (a_file, b_file) not in _pairs:
        _pairs[a_file, b_file] = Pair(a_file, b_file)
    return _pairs[a_file, b_file]


def align(docs: DataFrame, a_file: bytes, b_file: bytes, text: str = "text") -> DataFrame:
    """docs with n_a, n_b, n_groups, n_links, groups, and what weigh() needs: block, pairs, and on a block's first row keys and held.

    Blocks are numbered by task, so the result must be written before weigh() reads it twice.
    """
    added = (
        *(T.StructField(x, T.LongType()) for x in ("n_a", "n_b", "n_groups", "n_links")), T.StructField("groups", T.StringType()),
        T.StructField("block", T.LongType()), T.StructField("pairs", T.BinaryType()), *(T.StructField(x, T.ArrayType(T.LongType())) for x in ("keys", "held")),
    )
    kept = [c for c in docs.columns if c not in {f.name for f in added}]
    source = docs.select(*[F.col(arrow.quoted(c)) for c in kept])
    place = kept.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, n = pair(a_file, b_file), TaskContext.get().partitionId() << 32
        for batch in batches:
            for first, end, data, offsets in arrow.text_blocks(batch.column(place), BLOCK_BYTES):
                found = own.align(data, offsets)
                once = [pa.array([found[x].tolist(), *[None] * (end - first - 1)], pa.list_(pa.int64())) for x in ("keys", "held")]
                columns = [*(pa.array(found[x]) for x in ("n_a", "n_b", "n_groups", "n_links")), found["groups"], pa.array(np.full(end - first, n)), found["pairs"], *once]
                n += 1
                yield pa.RecordBatch.from_arrays([*batch.slice(first, end - first).columns, *columns], names=[*batch.schema.names, *(f.name for f in added)])
        pa.default_memory_pool().release_unused()

    return arrow.mapped(source, run, len(kept), *added)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(key, n_docs, n, best): A's id and B's in a long, documents that hold the pair, blocks that hold it, and whether no pair of A's id has more."""
    sums = aligned.where("keys IS NOT NULL").select(F.explode(F.arrays_zip("keys", "held")).alias("x")).groupBy(F.col("x.keys").alias("key")).agg(F.sum("x.held").alias("n_docs"), F.count("*").alias("n"))
    # the pairs of one id are no more than B has ids
    return sums.withColumn("best", F.col("n_docs") == F.max("n_docs").over(Window.partitionBy(F.shiftright("key", 32))))


def weigh(aligned: DataFrame) -> DataFrame:
    """aligned (written) with n_best and count_sum, without block, pairs, keys and held.

    Each block's pairs meet their counts, and then the block's documents: as many rows as a block has.
    """
    listed = aligned.where("keys IS NOT NULL").select("block", F.posexplode("keys").alias("code", "key"))
    facts = join_hot(listed, pair_counts(aligned), "key").select(F.col("block").alias("of_block"), "code", "n_docs", "best")
    names = [c for c in aligned.columns if c not in ("block", "pairs", "keys", "held")]
    safe = aligned.select(*[F.col(arrow.quoted(c)).alias(f"_{k}_carried") for k, c in enumerate(names)], "block", "pairs")

    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        docs = docs.combine_chunks()
        order = np.argsort(np.asarray(known["code"]), kind="stable")
        n_docs, best = np.asarray(known["n_docs"])[order], known["best"].to_numpy(zero_copy_only=False)[order].astype(np.int64)
        packed, at = flat(docs["pairs"].combine_chunks().cast(pa.large_binary()))
        code, times = np.frombuffer(packed[at[0] : at[-1]].tobytes(), "<u4").reshape(-1, 2).T.astype(np.int64)
        bounds = (at - at[0]) // 8
        sums = [np.append(0, np.cumsum(times * x[code])) for x in (best, n_docs)]
        out = docs.drop_columns(["block", "pairs"])
        for name, total in zip(("n_best", "count_sum"), sums, strict=True):
            out = out.append_column(name, pa.array(np.diff(total[bounds])))
        return out

    schema = T.StructType([*safe.drop("block", "pairs").schema.fields, T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])
    return safe.groupBy("block").cogroup(facts.groupBy("of_block")).applyInArrow(run, schema).toDF(*names, "n_best", "count_sum")


def public_files(a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model") -> tuple[bytes, bytes]:
    """The files of two installed public tokenizers."""
    import public_tokenizers

    out = []
    for name in (a, b):
        with open(public_tokenizers.path(name), "rb") as file:
            out.append(file.read())
    return out[0], out[1]


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of tokens, groups, links and best links, the sum of counts, and a digest of the groups."""
    aligned = align(read(spark, sf_dir, "documents").select("doc_id", "text"), *public_files())
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    slim = aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", digest.alias("groups_sha256"), "block", "pairs", "keys", "held")
    return weigh(stored(slim)).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
