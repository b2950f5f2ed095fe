"""Secret scanning: base rules, and probabilistic automata inferred from labelled credentials.

The base rules label credentials of three kinds. From a sample of each kind a prefix tree over
character classes is built, and states whose outgoing and end frequencies agree within Hoeffding
bounds are merged, children included, into a deterministic probabilistic automaton. Another one is
inferred from ordinary tokens. Every token of every text that is as long as the shortest labelled value can be is
then scored by its likelihood under each kind against the ordinary one, those that base spans overlap too;
tokens that look like a credential by format are added to the spans of the base rules, unless one of these holds the whole token.

The labelled sample is bounded by MAX_TRAIN distinct values a kind, those with the smallest hash
over all documents, so it does not depend on partitioning. All texts are scanned whole.

Defined cases: null is an empty text without spans; repeated rows are each scanned; without
labelled values of a kind there is no automaton for it, and without ordinary tokens none adds
spans; other columns are carried along.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrow
from .tables import checkpoint, read

# fixed values of the base rules
_ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex")
FORMAT = "format"

#: Shortest labelled value and so shortest token that is scored, labelled values a kind, and confidence of the compatibility test.
LEAST_TOKEN = min(LEAST.values())
MAX_TRAIN = 400
CONFIDENCE = 0.05
#: A token is added if its log-likelihood beats the ordinary one's by MARGIN a character and by EVIDENCE as a whole,
#: and if it is, by character, not under the lowest hundredth of the labelled values' own by more than SLACK.
MARGIN, EVIDENCE = 0.5, 8.5
SLACK = 0.2
UNSEEN = 1e-4

_TOKEN = np.zeros(256, bool)
_TOKEN[[ord(c) for c in "0123456789+/_=-"]] = _TOKEN[65:91] = _TOKEN[97:123] = True
_DOT = ord(".")
_HEX = np.zeros(256, bool)
_HEX[0x30:0x3A] = _HEX[0x61:0x67] = True

#: Character class and size of the class, for each code point under 128.
_CLASS, _WIDTH = [0] * 128, [1] * 128
for _i, _members in enumerate(("0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", "+", "/", "_", "=", "-", "."), 1):
    for _c in _members:
        _CLASS[ord(_c)], _WIDTH[ord(_c)] = _i, len(_members)


_LOG_UNSEEN = math.log(UNSEEN)
_BYTE_CLASS = np.array([*_CLASS, *[0] * 128])
_BYTE_LOG_WIDTH = np.log(np.array([*_WIDTH, *[1] * 128], float))


class Automaton:
    """A deterministic probabilistic automaton over character classes."""

    def __init__(self, moves: list[dict[int, tuple[int, float]]], ends: list[float]):
        # a class unseen in a state costs UNSEEN and stays in it
        classes = max(_CLASS) + 1
        self.to = np.repeat(np.arange(len(moves))[:, None], classes, axis=1)
        self.log = np.full((len(moves), classes), _LOG_UNSEEN)
        for state, out in enumerate(moves):
            for symbol, (target, log) in out.items():
                self.to[state, symbol], self.log[state, symbol] = target, log
        self.ends = np.array(ends)

    def log_likelihoods(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Of each token, the end included; all tokens advance together, one character a step."""
        size = np.diff(offsets)
        order = np.argsort(-size, kind="stable")
        at, size = offsets[:-1][order], size[order]
        state, total = np.zeros(len(size), np.int64), np.zeros(len(size))
        # tokens that have a character at each place: the longest ones, which come first
        left = len(size) - np.searchsorted(size[::-1], np.arange(size[0] if len(size) else 0), "right")
        for k, n in enumerate(left.tolist()):
            byte = data[at[:n] + k]
            symbol = _BYTE_CLASS[byte]
            total[:n] += self.log[state[:n], symbol] - _BYTE_LOG_WIDTH[byte]
            state[:n] = self.to[state[:n], symbol]
        out = np.empty(len(size))
        out[order] = total + self.ends[state]
        return out


class _Tree:
    """A prefix tree whose states are merged in place."""

    def __init__(self, values: list[str]):
        self.count, self.end, self.next = [0], [0], [{}]
        self.flow: list[dict[int, int]] = [{}]
        for value in values:
            state = 0
            self.count[0] += 1
            for c in value:
                symbol = _CLASS[ord(c)]
                self.flow[state][symbol] = self.flow[state].get(symbol, 0) + 1
                if symbol not in self.next[state]:
                    self.next[state][symbol] = len(self.count)
                    for x, new in ((self.count, 0), (self.end, 0), (self.next, {}), (self.flow, {})):
                        x.append(new)
                state = self.next[state][symbol]
                self.count[state] += 1
            self.end[state] += 1

    def compatible(self, a: int, b: int) -> bool:
        """Whether all frequencies from a and b on agree within Hoeffding bounds."""
        bound = math.sqrt(0.5 * math.log(2 / CONFIDENCE))
        pairs = [(a, b)]
        while pairs:
            a, b = pairs.pop()
            n, m = self.count[a], self.count[b]
            if not n or not m:
                continue
            most = bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if abs(self.end[a] / n - self.end[b] / m) > most:
                return False
            for symbol in self.flow[a].keys() | self.flow[b].keys():
                if abs(self.flow[a].get(symbol, 0) / n - self.flow[b].get(symbol, 0) / m) > most:
                    return False
                if symbol in self.next[a] and symbol in self.next[b]:
                    pairs.append((self.next[a][symbol], self.next[b][symbol]))
        return True

    def fold(self, a: int, b: int) -> None:
        """Add the subtree of b to state a and what follows it."""
        pairs = [(a, b)]
        while pairs:
            a, b = pairs.pop()
            self.count[a] += self.count[b]
            self.end[a] += self.end[b]
            for symbol, child in self.next[b].items():
                self.flow[a][symbol] = self.flow[a].get(symbol, 0) + self.flow[b][symbol]
                if symbol in self.next[a]:
                    pairs.append((self.next[a][symbol], child))
                else:
                    self.next[a][symbol] = child


def infer(values: list[str]) -> Automaton | None:
    """Merge compatible states of the values' prefix tree, most visited first."""
    if not values:
        return None
    tree = _Tree(sorted(values))
    kept = [0]
    while True:
        is_kept = set(kept)
        fringe = [(-tree.count[child], child, state, symbol) for state in kept for symbol, child in tree.next[state].items() if child not in is_kept]
        if not fringe:
            break
        _, child, state, symbol = min(fringe)
        for other in kept:
            if tree.compatible(other, child):
                tree.next[state][symbol] = other
                tree.fold(other, child)
                break
        else:
            kept.append(child)
    number = {state: i for i, state in enumerate(kept)}
    log = lambda x, n: math.log((x + UNSEEN) / (n + 12 * UNSEEN))
    moves = [{symbol: (number[child], log(tree.flow[s][symbol], tree.count[s])) for symbol, child in tree.next[s].items()} for s in kept]
    return Automaton(moves, [log(tree.end[s], tree.count[s]) for s in kept])


def _packed(values: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [v.encode() for v in values]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


class Formats:
    """Automata of the labelled kinds and of ordinary tokens."""

    def __init__(self, labelled: dict[str, list[str]], ordinary: list[str]):
        self.ordinary = infer(ordinary)
        self.kinds = {}
        for kind, values in sorted(labelled.items()):
            automaton = infer(values)
            data, offsets = _packed(values)
            own = np.sort(automaton.log_likelihoods(data, offsets) / (np.diff(offsets) + 1))
            self.kinds[kind] = automaton, own[len(own) // 100] - SLACK

    def are_credentials(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Whether each token looks like a credential of some kind rather than like an ordinary token."""
        out = np.zeros(len(offsets) - 1, bool)
        if self.ordinary is None:
            return out
        size = np.diff(offsets) + 1
        usual = self.ordinary.log_likelihoods(data, offsets)
        for automaton, floor in self.kinds.values():
            own = automaton.log_likelihoods(data, offsets)
            out |= (own >= floor * size) & (own - usual >= np.maximum(MARGIN * size, EVIDENCE))
        return out


class Scan:
    """The base spans of a block of texts by row, as (start, kind number, end, value) in code points, and its tokens."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.raw, self.offsets = data.tobytes(), offsets
        self.points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        low = arrow.LOWER[data].tobytes()
        # a dot belongs to a token between two of its other characters
        dotted = _TOKEN.copy()
        dotted[_DOT] = True
        lone = np.flatnonzero(data == _DOT)
        inside = (lone > 0) & (lone + 1 < len(data))
        lone = lone[~inside | ~(_TOKEN[data[np.maximum(lone - 1, 0)]] & _TOKEN[data[np.minimum(lone + 1, len(data) - 1)]])]
        marked = data.copy()
        marked[lone] = 0x20
        starts, ends, _ = arrow.words(marked, offsets, dotted)
        # a text may begin or end with a dot that lies between tokens of two texts
        starts, ends = starts + (data[starts] == _DOT), ends - (data[ends - 1] == _DOT)
        keep = ends - starts >= LEAST_TOKEN
        self.starts, self.ends = starts[keep], ends[keep]
        self.row_of = np.searchsorted(offsets, self.starts, "right") - 1
        hs, he, _ = arrow.words(data, offsets, _HEX)
        keep = he - hs >= LEAST["hex"]
        hexes: dict[int, list[tuple[int, int]]] = {}
        for r, s, e in zip((np.searchsorted(offsets, hs[keep], "right") - 1).tolist(), hs[keep].tolist(), he[keep].tolist(), strict=True):
            hexes.setdefault(r, []).append((s, e))
        self.base: dict[int, list[tuple[int, int, int, str]]] = {}
        for r, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            words = any(low.find(w, a, b) >= 0 for w in _ASSIGN_WORDS)
            access = self.raw.find(b"AKIA", a, b) >= 0
            if not (words or access or r in hexes):
                continue
            text = self.raw[a:b].decode("utf-8", "replace")
            found = []
            if words:
                found += [(m.start(), 0, m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
            if access:
                found += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
            found += [(p := self.place(r, s), 2, p + e - s, self.raw[s:e].decode()) for s, e in hexes.get(r, ())]
            if found:
                self.base[r] = sorted(found)

    def place(self, row: int, at: int) -> int:
        """Code points of a row's text before a byte of the block."""
        return int(self.points[at] - self.points[self.offsets[row]])

    def tokens(self) -> pa.DictionaryArray:
        """The tokens' bytes, each distinct one once."""
        size = self.ends - self.starts
        stop = np.concatenate([[0], np.cumsum(size)])
        data = np.frombuffer(self.raw, np.uint8)[np.arange(stop[-1]) + np.repeat(self.starts - stop[:-1], size)]
        return pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(stop), pa.py_buffer(data)]).dictionary_encode()


def scan(column: pa.Array) -> Iterator[tuple[int, int, Scan]]:
    """(first row, end row, findings) of consecutive rows."""
    for first, end, data, offsets in arrow.text_blocks(column):
        yield first, end, Scan(data, offsets)


def _bytes_of(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    _, offsets, data = values.buffers()
    return np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8), np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1]


def fit(docs: DataFrame, text: str = "text") -> Formats:
    """Infer the automata from the smallest-hashed labelled values, and tokens that no base span touches, of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[str, dict[str, int]] = {}

        def add(kind: str, found: list[tuple[str, int]]) -> None:
            mine = best.setdefault(kind, {})
            mine.update(found)
            if len(mine) > 4 * MAX_TRAIN:
                best[kind] = dict(sorted(mine.items(), key=lambda x: (x[1], x[0]))[:MAX_TRAIN])

        for batch in batches:
            for _, _, found in scan(batch.column(0)):
                touched = np.zeros(len(found.starts), bool)
                for r, base in found.base.items():
                    for _, kind, _, value in base:
                        add(KINDS[kind], [(value, xxhash.xxh64_intdigest(value.encode(), 7) >> 1)])
                    own = slice(*np.searchsorted(found.row_of, [r, r + 1]))
                    p = found.points[found.starts[own]] - found.points[found.offsets[r]]
                    for start, _, end, _ in base:
                        touched[own] |= (start < p + found.ends[own] - found.starts[own]) & (p < end)
                coded = found.tokens()
                distinct, usual = coded.dictionary, np.ones(len(coded.dictionary), bool)
                usual[np.asarray(coded.indices)[touched]] = False
                data, at = _bytes_of(distinct)
                h = arrow.word_hashes(data, at[:-1], at[1:]) >> np.uint64(1)
                usual = np.flatnonzero(usual)
                least = usual[np.argsort(h[usual], kind="stable")[:MAX_TRAIN]]
                add("", [(distinct[i].as_py().decode(), int(h[i])) for i in least.tolist()])
        rows = [(k, v, h) for k, mine in best.items() for v, h in sorted(mine.items(), key=lambda x: (x[1], x[0]))[:MAX_TRAIN]]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))], names=["kind", "value", "hash"])

    found = checkpoint(docs.select(F.col(arrow.quoted(text)).alias("text")).mapInArrow(run, "kind string, value string, hash long").distinct())
    pick = lambda kind: [r[0] for r in found.where(F.col("kind") == kind).orderBy("hash", "value").limit(MAX_TRAIN).select("value").collect()]
    labelled = {kind: values for kind in KINDS if (values := pick(kind))}
    return Formats(labelled, pick(""))


SPANS = "array<struct<kind:string,start:long,end:long>>"


def find_secrets(docs: DataFrame, formats: Formats, text: str = "text", into: str = "secrets") -> DataFrame:
    """docs with a column of spans (kind, start, end in code points), by start, then base kinds as listed, then added ones."""
    kept = [c for c in docs.columns if c != into]
    source = docs.select(*[F.col(arrow.quoted(c)) for c in kept])
    place = kept.index(text)
    kind_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[dict]] = []
            for first, end, found in scan(batch.column(place)):
                spans = {r: [(s, k, e) for s, k, e, _ in base] for r, base in found.base.items()}
                coded = found.tokens()
                good = formats.are_credentials(*_bytes_of(coded.dictionary))[np.asarray(coded.indices)]
                for i in np.flatnonzero(good).tolist():
                    r = int(found.row_of[i])
                    s = found.place(r, int(found.starts[i]))
                    e = s + int(found.ends[i] - found.starts[i])
                    if not any(a <= s and e <= b for a, _, b, _ in found.base.get(r, ())):
                        spans.setdefault(r, []).append((s, len(KINDS), e))
                out += [[{"kind": (*KINDS, FORMAT)[k], "start": s, "end": e} for s, k, e in sorted(spans.get(r, ()))] for r in range(end - first)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, kind_type)], names=[*batch.schema.names, into])

    return arrow.mapped(source, run, len(kept), T.StructField(into, T._parse_datatype_string(SPANS)))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_secrets(docs, fit(docs)).select("doc_id", "secrets")
    spans = F.col("secrets")
    base = F.filter(spans, lambda x: x["kind"] != FORMAT)
    count = lambda kind: F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(_joined(base), 256).alias("base_sha256"), _joined(spans).alias("spans"))


def redact(text: str = "text", spans: str = "secrets", mark: str = "[SECRET]") -> Column:
    """The text with every span, overlapping ones as one, replaced by mark."""
    t = F.col(text)
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(state: Column, span: Column) -> Column:
        gap = F.substring(t, (state["at"] + 1).cast("int"), (span["start"] - state["at"]).cast("int"))
        out = F.when(span["start"] >= state["at"], F.concat(state["out"], gap, F.lit(mark))).otherwise(state["out"])
        return F.struct(out.alias("out"), F.greatest(state["at"], span["end"]).alias("at"))

    rest = lambda s: F.concat(s["out"], F.substring(t, (s["at"] + 1).cast("int"), 2147483647))
    return F.when(F.size(spans) > 0, F.aggregate(F.col(spans), start, step, rest)).otherwise(t)
