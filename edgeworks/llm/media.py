"""Media columns: texts as greyscale PNG images in a binary column, and hashes of their low frequencies.

to_png() stores the UTF-8 bytes of a text, filled up with bytes 255 to a positive multiple of 576, as
8-bit samples of an image WIDTH wide. from_png() checks the signature and every chunk's CRC,
inflates the data, undoes the row filters with numpy, and hashes the 8 x 8 lowest frequencies of
a cosine transform. All five filters of the format are read; the writer uses the first three.

Defined cases: null is an empty text (one block of 255s); equal texts give equal values; repeated
rows are each stored; a damaged image raises a ValueError; other columns are carried along.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrow
from .tables import read

BLOCK = 576
WIDTH = 192
FILL = 255
LEVEL = 2
CHUNK_BYTES = 1 << 20
TAIL = 32
SIDE, LOW = 32, 8

_SIGNATURE = b"\x89PNG\r\n\x1a\n"
_COSINE = np.cos(np.pi * (np.arange(SIDE) + 0.5) * np.arange(LOW)[:, None] / SIDE)


def payload(data: bytes) -> bytes:
    return data + bytes([FILL]) * ((-len(data)) % BLOCK if data else BLOCK)


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def write_png(samples: bytes) -> bytes:
    """An 8-bit greyscale image WIDTH wide; all rows take the filter with the least sum of magnitudes."""
    pixels = np.frombuffer(samples, np.uint8).reshape(-1, WIDTH)
    left, up = pixels.copy(), pixels.copy()
    left[:, 1:] -= pixels[:, :-1]
    up[1:] -= pixels[:-1]
    cost = [int(np.abs(x.view(np.int8).astype(np.int16)).sum()) for x in (pixels, left, up)]
    best = int(np.argmin(cost))
    rows = np.empty((len(pixels), WIDTH + 1), np.uint8)
    rows[:, 0] = best
    rows[:, 1:] = (pixels, left, up)[best]
    packed = zlib.compress(rows.tobytes(), LEVEL)
    header = struct.pack(">IIBBBBB", WIDTH, len(pixels), 8, 0, 0, 0, 0)
    parts = [_chunk(b"IDAT", packed[i : i + CHUNK_BYTES]) for i in range(0, len(packed), CHUNK_BYTES)]
    return b"".join([_SIGNATURE, _chunk(b"IHDR", header), *parts, _chunk(b"IEND", b"")])


def _by_byte(kind: int, row: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Undo the average (3) or Paeth (4) filter, which depend on each byte before."""
    out, line, top = [], row.tolist(), above.tolist()
    left = corner = 0
    for x, b in zip(line, top, strict=True):
        if kind == 3:
            guess = (left + b) // 2
        else:
            to_left, to_above, to_corner = abs(b - corner), abs(left - corner), abs(left + b - 2 * corner)
            guess = left if to_left <= to_above and to_left <= to_corner else b if to_above <= to_corner else corner
        left, corner = (x + guess) & 255, b
        out.append(left)
    return np.array(out, np.uint8)


def unfilter(rows: np.ndarray) -> np.ndarray:
    """Pixels of rows whose first byte names the filter; neighbouring rows with one filter are undone together."""
    kinds, out = rows[:, 0], rows[:, 1:].copy()
    cuts = [0, *(np.flatnonzero(np.diff(kinds)) + 1).tolist(), len(rows)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        kind = int(kinds[a])
        above = out[a - 1] if a else np.zeros(out.shape[1], np.uint8)
        if kind == 1:
            np.cumsum(out[a:b], axis=1, dtype=np.uint8, out=out[a:b])
        elif kind == 2:
            out[a] += above
            np.cumsum(out[a:b], axis=0, dtype=np.uint8, out=out[a:b])
        elif kind in (3, 4):
            for i in range(a, b):
                out[i] = above = _by_byte(kind, out[i], above)
        elif kind:
            raise ValueError(f"unknown row filter {kind}")
    return out


def read_png(data: bytes) -> np.ndarray:
    """Pixels of an 8-bit greyscale image without interlacing."""
    if data[:8] != _SIGNATURE:
        raise ValueError("not a PNG image")
    at, size, parts, ended = 8, None, [], False
    while at < len(data) and not ended:
        length, kind = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + length]
        if len(body) != length or struct.unpack(">I", data[at + 8 + length : at + 12 + length])[0] != zlib.crc32(kind + body):
            raise ValueError(f"damaged chunk {kind!r}")
        if kind == b"IHDR":
            width, height, depth, colour, _, _, interlace = struct.unpack(">IIBBBBB", body)
            if (depth, colour, interlace) != (8, 0, 0):
                raise ValueError("only 8-bit greyscale without interlacing is read")
            size = height, width + 1
        elif kind == b"IDAT":
            parts.append(body)
        ended = kind == b"IEND"
        at += 12 + length
    if size is None or not ended:
        raise ValueError("truncated image")
    rows = np.frombuffer(zlib.decompress(b"".join(parts)), np.uint8)
    return unfilter(rows.reshape(size))


def _shrink(pixels: np.ndarray, axis: int) -> np.ndarray:
    """Means over SIDE stretches of an axis; an axis shorter than that repeats its entries."""
    n = pixels.shape[axis]
    low = np.arange(SIDE) * n // SIDE
    high = np.maximum(low + 1, np.arange(1, SIDE + 1) * n // SIDE)
    total = np.cumsum(pixels, axis=axis, dtype=np.float64)
    total = np.concatenate([np.zeros_like(total.take([0], axis)), total], axis)
    shape = [1, 1]
    shape[axis] = SIDE
    return (total.take(high, axis) - total.take(low, axis)) / (high - low).reshape(shape)


def frequency_hash(pixels: np.ndarray) -> bytes:
    """64 bits: which of the lowest frequencies, the mean left out, lie above their median."""
    small = _shrink(_shrink(pixels, 1), 0)
    low = np.round(_COSINE @ small @ _COSINE.T, 3).ravel()
    bits = low > np.median(low[1:])
    bits[0] = False
    return np.packbits(bits).tobytes()


def to_png(docs: DataFrame, text: str = "text", into: str = "media") -> DataFrame:
    """docs with a binary column of images instead of the text."""
    kept = [c for c in docs.columns if c not in (into, text)]
    source = docs.select(*[F.col(arrow.quoted(c)) for c in [*kept, text]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in arrow.text_blocks(batch.column(batch.num_columns - 1)):
                raw = data.tobytes()
                images = [write_png(payload(raw[a:b])) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.slice(first, end - first).columns[:-1], pa.array(images, pa.binary())], names=[*batch.schema.names[:-1], into])

    return arrow.mapped(source, run, len(kept), T.StructField(into, T.BinaryType()))


_FACTS = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, hash binary"


def from_png(images: DataFrame, media: str = "media", into: str = "read_back") -> DataFrame:
    """images with a struct of what the stored bytes hold, instead of the images."""
    kept = [c for c in images.columns if c not in (into, media)]
    source = images.select(*[F.col(arrow.quoted(c)) for c in [*kept, media]])
    kind = pa.struct([("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("hash", pa.binary())])

    def facts(image: bytes) -> dict:
        pixels = read_png(image)
        stored = pixels.tobytes()
        return {"n_bytes": len(stored.rstrip(bytes([FILL]))), "payload_bytes": len(stored), "payload_sha256": hashlib.sha256(stored).hexdigest(), "tail_crc32": zlib.crc32(stored[-TAIL:]), "media_bytes": len(image), "media_sha256": hashlib.sha256(image).hexdigest(), "hash": frequency_hash(pixels)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [facts(x.as_py()) for x in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, kind)], names=[*batch.schema.names[:-1], into])

    return arrow.mapped(source, run, len(kept), T.StructField(into, T._parse_datatype_string(_FACTS)))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = from_png(to_png(read(spark, sf_dir, "documents").select("doc_id", "text")))
    names = ("n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256")
    return found.select("doc_id", *[F.col(f"read_back.{n}").alias(n) for n in names], F.lower(F.hex("read_back.hash")).alias("feature"))
