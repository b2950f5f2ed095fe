"""Byte strings in flat arrays, and bounded caches of them, for the codecs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from . import arrow


def flat(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a large binary array, and the offsets in them (one entry more)."""
    _, offsets, data = values.buffers()
    at = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1] if offsets else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8), at


def binary(data: np.ndarray | bytes | pa.Buffer, offsets: np.ndarray) -> pa.Array:
    """A large binary array from its bytes and offsets."""
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), data if isinstance(data, pa.Buffer) else pa.py_buffer(data)])


class Known:
    """Byte strings and what was found for each, in flat arrays: looked up by a 64-bit hash, then compared."""

    def __init__(self, entries: int, size: int):
        #: most entries and bytes; a block may go over them
        self.entries, self.bytes = entries, size
        self.keys = self.values = pa.array([], pa.large_binary())
        self.hash, self.at, self.met, self.clock = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), 0
        #: places of keys whose hash another key has
        self.odd: dict[bytes, int] = {}

    def turn(self) -> None:
        """Between two blocks: at its bound, keep the half met last. Places found before do not hold any more."""
        self.clock += 1
        if len(self.keys) > self.entries or self.keys.nbytes + self.values.nbytes > self.bytes:
            kept = np.sort(np.argsort(self.met, kind="stable")[len(self.met) // 2 :])
            keys, values, met = self.keys.take(pa.array(kept)), self.values.take(pa.array(kept)), self.met[kept]
            clock = self.clock
            self.__init__(self.entries, self.bytes)
            self.add(keys, values)
            self.met, self.clock = met, clock

    @staticmethod
    def _hashes(keys: pa.Array) -> np.ndarray:
        data, at = flat(keys)
        return arrow.word_hashes(data, at[:-1], at[1:])

    def find(self, keys: pa.Array) -> np.ndarray:
        """Place of each key in values, or -1."""
        out = np.full(len(keys), -1, np.int64)
        if len(keys) and len(self.hash):
            h = self._hashes(keys)
            k = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
            hit = np.flatnonzero(self.hash[k] == h)
            place = self.at[k[hit]]
            same = pc.equal(keys.take(pa.array(hit)), self.keys.take(pa.array(place))).to_numpy(zero_copy_only=False)
            out[hit[same]] = place[same]
            for i in hit[~same].tolist() if self.odd else ():
                out[i] = self.odd.get(keys[i].as_py(), -1)
            self.met[out[out >= 0]] = self.clock
        return out

    def add(self, keys: pa.Array, values: pa.Array) -> None:
        """Distinct keys that find() does not know."""
        place = np.arange(len(self.keys), len(self.keys) + len(keys))
        h = self._hashes(keys)
        order = np.argsort(h, kind="stable")
        h, place_of = h[order], place[order]
        taken = np.append(False, h[1:] == h[:-1])[: len(h)]
        if len(self.hash):
            taken |= self.hash[np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)] == h
        for i in np.flatnonzero(taken).tolist():
            self.odd[keys[int(order[i])].as_py()] = int(place_of[i])
        where = np.searchsorted(self.hash, h[~taken])
        self.hash, self.at = np.insert(self.hash, where, h[~taken]), np.insert(self.at, where, place_of[~taken])
        self.met = np.append(self.met, np.full(len(keys), self.clock))
        self.keys, self.values = pa.concat_arrays([self.keys, keys]), pa.concat_arrays([self.values, values])
