"""Byte-level helpers that the operators use inside Arrow batches.

Every helper works on blocks of a few megabytes, so memory does not depend on the
number of rows in a batch; a single longer text makes a block of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

BLOCK_BYTES = 2 << 20
PIECE_BYTES = 1 << 17

_M = 0x9E3779B97F4A7C15
_MINV = pow(_M, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, by doubling."""
    out = np.ones(n, np.uint64)
    size, step = 1, base
    while size < n:
        k = min(size, n - size)
        out[size : size + k] = out[:k] * np.uint64(step)
        size, step = size + k, step * step % (1 << 64)
    return out


_POW, _POWINV = _powers(_M, PIECE_BYTES + 1), _powers(_MINV, PIECE_BYTES + 1)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_M))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, end row, bytes, offsets) of consecutive rows; null is an empty text.

    offsets has end - first + 1 entries, relative to the block's bytes. A block ends before the
    row that would take it over limit, and holds at least one row.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of a block, and for each text the index of its first word (one entry more).

    is_word says for each of the 256 byte values whether it belongs to a word. No word spans two texts.
    """
    flag = is_word[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(data), bool)
    before[:1] = True
    np.logical_not(flag[:-1], out=before[1:])
    starts = np.flatnonzero(flag & (before | edge[:-1]))
    after = np.empty(len(data), bool)
    after[-1:] = True
    np.logical_not(flag[1:], out=after[:-1])
    ends = np.flatnonzero(flag & (after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, from prefix sums of weighted byte values."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + PIECE_BYTES, "right")))
        a, b = int(starts[i]), int(ends[j - 1])
        powers, inverse = (_POW, _POWINV) if b - a <= PIECE_BYTES else (_powers(_M, b - a + 1), _powers(_MINV, b - a + 1))
        total = np.zeros(b - a + 1, np.uint64)
        np.cumsum(_BYTE_VALUE[data[a:b]] * powers[: b - a], out=total[1:])
        s, e = starts[i:j] - a, ends[i:j] - a
        out[i:j] = (total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64)
        i = j
    return mix(out)


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive word hashes; entry i covers words i .. i+n-1."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    out = h[: len(h) - n + 1].copy()
    for k in range(1, n):
        out = out * np.uint64(_M) + h[k : len(h) - n + 1 + k]
    return mix(out)


def free(taken: list[str], *names: str) -> list[str]:
    """Names of helper columns that no column has, whatever its case: underscores are put before until they are free."""
    used = {c.lower() for c in taken}
    out = []
    for name in names:
        while name.lower() in used:
            name = "_" + name
        used.add(name.lower())
        out.append(name)
    return out


def mapped(source: DataFrame, run: Callable, kept: int, *added: T.StructField) -> DataFrame:
    """source.mapInArrow(run) for columns of any name, which pass as numbers: the first kept ones come back, then the added ones."""
    names = source.columns
    safe = source.toDF(*[f"_{i}_carried" for i in range(len(names))])
    return safe.mapInArrow(run, T.StructType([*safe.schema.fields[:kept], *added])).toDF(*names[:kept], *[f.name for f in added])


def quoted(name: str) -> str:
    """A column name that Spark takes as one name, dots and backticks included."""
    return "`" + name.replace("`", "``") + "`"
