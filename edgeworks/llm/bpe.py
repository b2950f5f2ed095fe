"""Byte-level BPE with DuckDB inside each partition.

encode() splits a text into pre-tokens. The distinct pre-tokens that a worker has not met
are put into a table of (word, position, token, next token) rows; a recursive query joins it with
the merge table and contracts each word's leftmost pair of least rank until no pair is left.
decode() joins (run, position, id) rows with the vocabulary and puts the bytes together by an
ordered aggregation. Words and runs repeat, so a worker keeps what it has found in bounded
caches; its database is closed at a partition's end; texts are read whole, in blocks, and never shuffled.

A text is cut at single spaces between visible characters first, where a pre-token always begins;
the pattern itself runs on distinct pieces only. Texts with other white space at such places are
matched whole. Every word takes the same recursion, in queries of a bounded number of rows. One of over SEGMENT bytes is cut
first where no merge can cross, which the merge table proves: where no token holds the bytes on both sides. What is left
of over SEGMENT bytes is encoded in segments, and these are joined: the tokens around a border are encoded again as one
word, and where the outermost ones stay as they are, all is right, since tokens are an encoding just if each two neighbours
are one. So memory and steps of a query stay bounded for a word of any length.

Defined cases: null is an empty text, which has no ids and decodes to no bytes; repeated rows are
each encoded; ids outside the vocabulary raise a ValueError; other columns are carried along.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrow
from .packed import Known, binary, flat
from .tables import read

#: Entries and bytes of a cache before its half that was not met for longest goes.
CACHE, CACHE_BYTES = 400_000, 32 << 20
#: Words of a query and the rows that its steps may have, bytes of a segment, and segments and borders that are kept while words are joined.
WORDS_PER_QUERY, ROWS_PER_QUERY = 10_000, 1_000_000
SEGMENT = 64
BORDERS = 100_000
#: Ids of a run that decodes at once.
RUN_IDS = 1024
BLOCK_BYTES = 4 << 20
DUCKDB_MEMORY = "150MB"

_START = """
WITH RECURSIVE seq AS (
    SELECT i.word, i.pos, i.token, i.next, m.merged, 0 AS step
    FROM initial i LEFT JOIN merges m ON m.pair = (i.token::BIGINT << 32) + i.next
    UNION ALL
    SELECT n.word, n.pos, n.token, n.next, m.merged, n.step
    FROM ("""
_END = """) n LEFT JOIN merges m ON m.pair = (n.token::BIGINT << 32) + n.next
)
SELECT word, pos, token, next, step FROM seq JOIN (SELECT word, max(step) AS step FROM seq GROUP BY word) USING (word, step) ORDER BY word, pos
"""

_ENCODE = f"""{_START}
        SELECT s.word, s.pos - (s.pos > b.pos)::INT AS pos,
               CASE WHEN s.pos = b.pos THEN b.merged ELSE s.token END AS token,
               CASE WHEN s.pos = b.pos THEN b.after WHEN s.pos = b.pos - 1 THEN b.merged ELSE s.next END AS next,
               s.step + 1 AS step
        FROM seq s JOIN (
            SELECT l.word, l.pos, l.merged, r.next AS after
            FROM (
                SELECT word, (least & 4294967295)::INT AS pos, (least >> 32)::INT AS merged
                FROM (SELECT word, min((merged::BIGINT << 32) + pos) AS least FROM seq WHERE merged IS NOT NULL GROUP BY word)
            ) l JOIN seq r ON r.word = l.word AND r.pos = l.pos + 1
        ) b ON s.word = b.word AND s.pos <> b.pos + 1
    {_END}"""

_DECODE = "SELECT run, string_agg(text, '' ORDER BY pos) AS text FROM runs JOIN vocabulary USING (id) GROUP BY run ORDER BY run"


def _visible(pieces: pa.Array) -> np.ndarray:
    """Whether a piece neither is empty nor starts or ends with white space."""
    data, at = flat(pieces.cast(pa.large_binary()))
    some = np.flatnonzero(np.diff(at) > 0)
    first, last = data[at[some]], data[at[some + 1] - 1]
    out = np.zeros(len(pieces), bool)
    out[some] = (first > 0x20) & (last > 0x20)
    for i in some[(first >= 0x80) | (last >= 0x80)].tolist():
        piece = pieces[i].as_py()
        out[i] = out[i] and not piece[0].isspace() and not piece[-1].isspace()
    return out


class Codec:
    """Tables of one rank file, with the caches of this worker."""

    def __init__(self, rank_file: bytes, pattern: str):
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines())}
        self.pattern = regex.compile(pattern)
        left, right, merged = [], [], []
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        left, right, merged = (np.array(x, np.int64) for x in (left, right, merged))
        self.merges = pa.table({"pair": (left << 32) + right, "merged": pa.array(merged, pa.int32())})
        self.tokens = {rank: token for token, rank in ranks.items()}
        #: pairs of bytes that are a token, and bits of the triples of bytes that a token holds
        self.pairs, triples = np.zeros(1 << 16, bool), np.zeros(1 << 24, bool)
        self.pairs[[int.from_bytes(t) for t in ranks if len(t) == 2]] = True
        triples[[int.from_bytes(t[k : k + 3]) for t in ranks for k in range(len(t) - 2)]] = True
        self.triples = np.packbits(triples)
        self.borders: dict[bytes, list[int]] = {}
        self.byte_rank = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        # a byte is the character of the same number
        self.names = pa.table({"id": pa.array(list(ranks.values()), pa.int32()), "text": [t.decode("latin-1") for t in ranks]})
        self.in_vocabulary, self.starts_run = np.zeros((2, max(ranks.values()) + 1), bool)
        self.in_vocabulary[list(ranks.values())] = True
        self.starts_run[[r for t, r in ranks.items() if t[:1] == b" "]] = True
        self.vocabulary, self.words, self.runs = (Known(CACHE, CACHE_BYTES) for _ in range(3))
        self.vocabulary.add(pa.array(list(ranks), pa.large_binary()), pa.array([r.to_bytes(4, "little") for r in ranks.values()], pa.large_binary()))
        self.release()

    def release(self) -> None:
        """Close the partition's database; the caches stay, as they are bounded."""
        if getattr(self, "db", None) is not None:
            self.db.close()
        self.db, self.tables = None, set()
        pa.default_memory_pool().release_unused()

    def _need(self, **tables: pa.Table) -> None:
        """Create those of the merge tables or the vocabulary that this worker uses."""
        if self.db is None:
            self.db = duckdb.connect(config={"threads": 1, "memory_limit": DUCKDB_MEMORY, "temp_directory": ""})
        for name in tables.keys() - self.tables:
            self.db.register("rows", tables[name])
            self.db.execute(f"CREATE TABLE {name} AS FROM rows")
            self.db.unregister("rows")
            self.tables.add(name)

    def _query(self, name: str, rows: pa.Table, sql: str) -> pa.Table:
        self.db.register(name, rows)
        out = self.db.sql(sql).to_arrow_table()
        self.db.unregister(name)
        return out

    # -- encoding ---------------------------------------------------------------------------

    def _contract(self, words: pa.Array) -> pa.Array:
        """Packed ids of words by the recursive query."""
        data, at = flat(words)
        data, at = data[at[0] : at[-1]], at - at[0]
        size = np.diff(at)
        token = self.byte_rank[data]
        last = np.zeros(len(token), bool)
        last[at[1:] - 1] = True
        state = pa.table({"word": pa.array(np.repeat(np.arange(len(words)), size), pa.int32()), "pos": pa.array(np.arange(len(token)) - np.repeat(at[:-1], size), pa.int32()), "token": pa.array(token, pa.int32()), "next": pa.array(np.append(token[1:], 0), pa.int32(), mask=last)})
        self._need(merges=self.merges)
        out = self._query("initial", state, _ENCODE)
        word, ids = np.asarray(out["word"]), np.asarray(out["token"])
        return binary(ids.astype("<u4").tobytes(), 4 * np.searchsorted(word, np.arange(len(words) + 1)))

    @staticmethod
    def _batches(size: np.ndarray) -> list[np.ndarray]:
        """Places of words by query; a word of n bytes has up to n rows in each of up to n steps."""
        part = np.maximum(np.arange(len(size)) // WORDS_PER_QUERY, np.cumsum(size * size // 2) // ROWS_PER_QUERY)
        return np.split(np.arange(len(size)), np.flatnonzero(np.diff(part)) + 1) if len(size) else []

    def _cut(self, word: bytes) -> list[bytes]:
        """A word in parts between which no merge can cross: no token is the two bytes at a border, or holds them with one more."""
        w = np.frombuffer(word, np.uint8).astype(np.int64)
        two = w[:-1] << 8 | w[1:]
        three = two[:-1] << 8 | w[2:]
        inside = (self.triples[three >> 3] >> (7 - (three & 7)).astype(np.uint8) & 1).astype(bool)
        crossed = self.pairs[two]
        crossed[1:] |= inside
        crossed[:-1] |= inside
        ends = [0, *(np.flatnonzero(~crossed) + 1).tolist(), len(word)]
        return [word[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def _encoded(self, words: list[bytes]) -> None:
        """Put the ids of words into borders."""
        new = pa.array(list(dict.fromkeys(w for w in words if w not in self.borders)), pa.large_binary())
        for own in self._batches(np.asarray(pc.binary_length(new), np.int64)):
            part = new.slice(int(own[0]), len(own))
            self.borders.update((w, np.frombuffer(ids, "<u4").tolist()) for w, ids in zip(part.to_pylist(), self._contract(part).to_pylist(), strict=True))

    def _border(self, left: list[int], right: list[int], a: int, b: int) -> bytes:
        return b"".join([self.tokens[i] for i in (*left[-a:], *right[:b])])

    def _joined(self, left: list[int], right: list[int], a: int, b: int) -> tuple[bool, bool]:
        """Whether the outermost tokens of a and b around a border stay as they are, or are the first and last there."""
        found = self.borders[self._border(left, right, a, b)]
        return a >= len(left) or found[0] == left[-a], b >= len(right) or found[-1] == right[b - 1]

    def _fold(self, left: list[int], right: list[int]) -> list[int]:
        """left with the text of right, segment by segment: for what repeats so evenly that all tokens of right move."""
        text, left = b"".join([self.tokens[i] for i in right]), list(left)
        for k in range(0, len(text), SEGMENT):
            segment = text[k : k + SEGMENT]
            self._encoded([segment])
            own, a, b = self.borders[segment], 4, 4
            while True:
                border = self._border(left, own, a, b)
                self._encoded([border])
                good_a, good_b = self._joined(left, own, a, b)
                if good_a and good_b:
                    break
                a, b = a if good_a else 2 * a, b if good_b else 2 * b
            left[-a:] = self.borders[border] + own[b:]
        return left

    def _assemble(self, words: list[bytes]) -> list[list[int]]:
        """Ids of long words: of their parts, or of the parts' segments, joined two by two; all borders of a round are encoded together."""
        if len(self.borders) > BORDERS:
            self.borders.clear()
        parts = [(w, p) for w, word in enumerate(words) for p in self._cut(word)]
        lists = [[p[k : k + SEGMENT] for k in range(0, len(p), SEGMENT)] for _, p in parts]
        self._encoded([segment for own in lists for segment in own])
        rows = [[self.borders[segment] for segment in own] for own in lists]
        while any(len(own) > 1 for own in rows):
            open_ = [(r, k, 4, 4) for r, own in enumerate(rows) for k in range(0, len(own) - 1, 2)]
            merged = [[None if k + 1 < len(own) else own[k] for k in range(0, len(own), 2)] for own in rows]
            while open_:
                self._encoded([self._border(rows[r][k], rows[r][k + 1], a, b) for r, k, a, b in open_])
                again = []
                for r, k, a, b in open_:
                    left, right = rows[r][k], rows[r][k + 1]
                    border = self._border(left, right, a, b)
                    good_a, good_b = self._joined(left, right, a, b)
                    if good_a and good_b:
                        merged[r][k // 2] = left[:-a] + self.borders[border] + right[b:]
                    elif len(border) > 2 * SEGMENT:
                        merged[r][k // 2] = self._fold(left, right)
                    else:
                        again.append((r, k, a if good_a else 2 * a, b if good_b else 2 * b))
                open_ = again
            rows = merged
        out: list[list[int]] = [[] for _ in words]
        for (w, _), own in zip(parts, rows, strict=True):
            out[w] += own[0]
        return out

    def _learn(self, tokens: pa.Array) -> None:
        """Put the packed ids of pre-tokens into the cache."""
        tokens = tokens.unique()
        tokens = tokens.filter(pa.array(self.words.find(tokens) < 0))
        place = self.vocabulary.find(tokens)
        whole = place >= 0
        if whole.any():
            self.words.add(tokens.filter(pa.array(whole)), self.vocabulary.values.take(pa.array(place[whole])))
        tokens = tokens.filter(pa.array(~whole))
        size = np.asarray(pc.binary_length(tokens), np.int64)
        short = tokens.filter(pa.array(size <= SEGMENT))
        for own in self._batches(size[size <= SEGMENT]):
            words = short.slice(int(own[0]), len(own))
            self.words.add(words, self._contract(words))
        long = tokens.filter(pa.array(size > SEGMENT))
        if len(long):
            ids = self._assemble(long.to_pylist())
            self.words.add(long, binary(np.array([i for x in ids for i in x], "<u4").tobytes(), 4 * np.cumsum([0, *map(len, ids)])))

    def _places(self, pieces: pa.Array) -> np.ndarray:
        """Places in the cache of pieces with the space before them; unknown ones are matched and learnt."""
        keys = pc.binary_join_element_wise(pa.scalar(b"", pa.large_binary()), pieces.cast(pa.large_binary()), pa.scalar(b" ", pa.large_binary()))
        place = self.words.find(keys)
        missing = np.flatnonzero(place < 0)
        if len(missing):
            new = keys.take(pa.array(missing))
            # a space and letters are one pre-token; others are matched
            plain = pc.ascii_is_alpha(pieces.take(pa.array(missing)))
            mixed = new.filter(pc.invert(plain))
            found = [self.pattern.findall(p) for p in mixed.cast(pa.large_string()).to_pylist()]
            several = np.array([len(f) > 1 for f in found], bool)
            tokens = pa.array([t for f in found for t in f], pa.large_string()).cast(pa.large_binary())
            self._learn(pa.concat_arrays([new.filter(plain), tokens]))
            if several.any():
                tokens = pa.array([t for f in found if len(f) > 1 for t in f], pa.large_string()).cast(pa.large_binary())
                data, at = flat(self.words.values.take(pa.array(self.words.find(tokens))))
                ends = np.cumsum([0, *(len(f) for f in found if len(f) > 1)])
                self.words.add(mixed.filter(pa.array(several)), binary(data, at[ends]))
            place[missing] = self.words.find(new)
        return place

    def encode(self, texts: pa.Array) -> pa.Array:
        """Packed ids of whole texts (large strings)."""
        self.words.turn()
        parts = pc.split_pattern(texts, " ")
        bounds = np.asarray(parts.offsets, np.int64)
        coded = parts.flatten().dictionary_encode()
        codes = np.asarray(coded.indices)
        bounds = bounds - bounds[0]
        # a cut is a place where a pre-token begins only between visible characters; other texts are matched whole
        cut = np.logical_and.reduceat(_visible(coded.dictionary)[codes], bounds[:-1])
        first = [self.pattern.findall(coded.dictionary[k].as_py() if c else texts[i].as_py()) for i, (c, k) in enumerate(zip(cut.tolist(), codes[bounds[:-1]].tolist(), strict=True))]
        heads = pa.array([t for f in first for t in f], pa.large_string()).cast(pa.large_binary()).dictionary_encode()
        # a piece stands for itself with a space before it; the first piece of a text has none
        behind = np.repeat(cut, np.diff(bounds))
        behind[bounds[:-1]] = False
        used = np.zeros(len(coded.dictionary), bool)
        used[codes[behind]] = True
        self._learn(heads.dictionary)
        place = np.zeros(len(used), np.int64)
        place[used] = self._places(coded.dictionary.filter(pa.array(used)))
        n_heads, n_behind = np.array([len(f) for f in first], np.int64), np.where(cut, np.diff(bounds) - 1, 0)
        stop = np.concatenate([[0], np.cumsum(n_heads + n_behind)])
        is_head = np.zeros(int(stop[-1]), bool)
        is_head[np.arange(int(n_heads.sum())) + np.repeat(stop[:-1] - (np.cumsum(n_heads) - n_heads), n_heads)] = True
        order = np.empty(len(is_head), np.int64)
        order[is_head] = self.words.find(heads.dictionary)[np.asarray(heads.indices)]
        order[~is_head] = place[codes[behind]]
        data, at = flat(self.words.values.take(pa.array(order)))
        return binary(data, at[stop])

    # -- decoding ---------------------------------------------------------------------------

    def _join_runs(self, runs: pa.Array) -> None:
        data, at = flat(runs)
        ids, at = np.frombuffer(data[at[0] : at[-1]].tobytes(), "<u4"), (at - at[0]) // 4
        size = np.diff(at)
        rows = pa.table({"run": pa.array(np.repeat(np.arange(len(runs)), size), pa.int32()), "pos": pa.array(np.arange(len(ids)) - np.repeat(at[:-1], size), pa.int32()), "id": pa.array(ids.astype(np.int32))})
        self._need(vocabulary=self.names)
        text = self._query("runs", rows, _DECODE)["text"].combine_chunks().cast(pa.large_string())
        data, utf8 = flat(text.cast(pa.large_binary()))
        chars = np.asarray(pc.utf8_length(text), np.int64)
        self.runs.add(runs, binary(data[utf8[0] : utf8[-1]].tobytes().decode().encode("latin-1"), np.concatenate([[0], np.cumsum(chars)])))

    def decode(self, packed: pa.Array) -> pa.Array:
        """Bytes of each packed id list; a run is an id whose bytes start with a space, and those up to the next such id."""
        self.runs.turn()
        data, at = flat(packed)
        data, bounds = data[at[0] : at[-1]], (at - at[0]) // 4
        ids = np.frombuffer(data.tobytes(), "<u4")
        if not len(ids):
            return binary(b"", np.zeros(len(packed) + 1))
        strange = ids[(ids >= len(self.in_vocabulary)) | ~self.in_vocabulary[np.minimum(ids, len(self.in_vocabulary) - 1)]]
        if len(strange):
            raise ValueError(f"id {int(strange[0])} is not in the vocabulary")
        begins = self.starts_run[ids]
        # bytes of ids may be put together in any parts
        begins[::RUN_IDS] = True
        begins[bounds[:-1][np.diff(bounds) > 0]] = True
        starts = np.flatnonzero(begins)
        coded = binary(data, 4 * np.append(starts, len(ids))).dictionary_encode()
        distinct = coded.dictionary
        place = self.runs.find(distinct)
        new = distinct.filter(pa.array(place < 0))
        for k in range(0, len(new), WORDS_PER_QUERY):
            self._join_runs(new.slice(k, WORDS_PER_QUERY))
        place[place < 0] = self.runs.find(new)
        data, at = flat(self.runs.values.take(pa.array(place[np.asarray(coded.indices)])))
        return binary(data, at[np.searchsorted(starts, bounds)])


_codecs: dict[tuple[bytes, str], Codec] = {}


def codec(rank_file: bytes, pattern: str) -> Codec:
    """The worker's codec for these ranks; its tables and caches are kept while the worker lives."""
    key = rank_file, pattern
    if key not in _codecs:
        _codecs[key] = Codec(rank_file, pattern)
    return _codecs[key]


def encode(docs: DataFrame, rank_file: bytes, pattern: str, text: str = "text", into: str = "ids", decoded: str | None = None) -> DataFrame:
    """docs with a binary column of ids, packed as little-endian unsigned 32-bit integers.

    With a name in decoded, also what these ids decode to, from the same workers and codec.
    """
    added = [into] if decoded is None else [into, decoded]
    kept = [c for c in docs.columns if c not in added]
    source = docs.select(*[F.col(arrow.quoted(c)) for c in kept])
    place = kept.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(rank_file, pattern)
        try:
            for batch in batches:
                for first, end, data, offsets in arrow.text_blocks(batch.column(place), BLOCK_BYTES):
                    ids = own.encode(binary(data, offsets).cast(pa.large_string()))
                    out = [ids] if decoded is None else [ids, own.decode(ids)]
                    yield pa.RecordBatch.from_arrays([*batch.slice(first, end - first).columns, *(x.cast(pa.binary()) for x in out)], names=[*batch.schema.names, *added])
        finally:
            own.release()

    return arrow.mapped(source, run, len(kept), *(T.StructField(x, T.BinaryType()) for x in added))


def decode(tokens: DataFrame, rank_file: bytes, pattern: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """tokens with a binary column of the bytes that the packed ids stand for."""
    kept = [c for c in tokens.columns if c != into]
    source = tokens.select(*[F.col(arrow.quoted(c)) for c in kept])
    place = kept.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(rank_file, pattern)
        try:
            for batch in batches:
                column = pc.fill_null(batch.column(place), b"").cast(pa.large_binary())
                size = np.asarray(pc.binary_length(column), np.int64)
                block = np.concatenate([[0], np.cumsum(size)]) // BLOCK_BYTES
                cuts = np.unique([0, *(np.flatnonzero(np.diff(block[:-1])) + 1).tolist(), len(size)])
                for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                    yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, own.decode(column.slice(a, b - a)).cast(pa.binary())], names=[*batch.schema.names, into])
        finally:
            own.release()

    return arrow.mapped(source, run, len(kept), T.StructField(into, T.BinaryType()))


def public_ranks(name: str = "byte_bpe_50k.tiktoken") -> tuple[bytes, str]:
    """Rank file and pattern of an installed public tokenizer."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as file:
        return file.read(), public_tokenizers.PATTERN


def token_digests(docs: DataFrame) -> DataFrame:
    """doc_id, number of tokens, and digests of the packed ids and of what they decode to."""
    ranks, pattern = public_ranks()
    back = encode(docs.select("doc_id", "text"), ranks, pattern, decoded="decoded")
    return back.select("doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(read(spark, sf_dir, "documents"))
