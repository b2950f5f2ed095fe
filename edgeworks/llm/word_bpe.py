"""BPE with word ends, by depth-first traversal of a trie of the distinct words.

A word's encoding is fixed by the last token of each of its prefixes: the token is the one that ends the
prefix and stays apart from the last token before it. Words with a common prefix share these states. So the
distinct words of a block are put into a trie, which is walked depth-first: the path to a node is a stack of
last tokens, a node is solved once for all words below it, and at a word's end the tokens are read back along
the path. The last symbol of a word carries the word end, so a word leaves the trie at its last but one symbol.
Two tokens stay apart if no merge across their border comes before those that made them; answers are cached.

Texts are cut at ASCII white space, which no word holds. A piece of printable ASCII is lower-cased and
matched here, any other one by the normalizer and the splitter that the file names. Pieces repeat, so a
worker keeps what it has found in a bounded cache; texts are read whole, in blocks, and never shuffled.

Defined cases: null is an empty text, which has no ids and decodes to no text; repeated rows are each encoded;
the strings of special tokens in texts are those tokens, as the library takes them; a word of any length takes
time in proportion to it; ids outside the vocabulary raise a ValueError; other columns are carried along.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

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

#: Entries and bytes of the cache of pieces, and answers about pairs, before a worker forgets the older ones.
PIECES, PIECES_BYTES, PAIRS = 1_000_000, 64 << 20, 600_000
BLOCK_BYTES = 4 << 20
_NOT_SPACE = np.ones(256, bool)
_NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False


class Merges:
    """Tokens and merges of a model, and the encoding of words by them."""

    def __init__(self, vocabulary: dict[str, int], merges: list, end: str):
        inner = {t: i for t, i in vocabulary.items() if not t.endswith(end)}
        #: tokens inside a word and at its end, the latter without the mark, and -1 for what is only the end of one
        self.inner, self.final = (
            {**{t[k:]: -1 for t in known for k in range(1, len(t))}, **known} for known in (inner, {t.removesuffix(end): i for t, i in vocabulary.items() if t.endswith(end) and t != end})
        )
        self.size = {i: len(t) for t, i in inner.items()}
        self.shift = max(vocabulary.values()).bit_length()
        self.rank: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.merge: dict[int, int] = {}
        for k, pair in enumerate(merges):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b, made = vocabulary[left], vocabulary[right], vocabulary[left + right]
            if made in self.rank or max(self.rank.get(a, -1), self.rank.get(b, -1)) >= k:
                raise ValueError(f"merge {k} makes a token anew or comes before its parts")
            self.rank[made], self.parts[made], self.merge[a << self.shift | b] = k, (a, b), k
        self.apart: dict[int, bool] = {}

    def stay_apart(self, a: int, b: int) -> bool:
        """Whether a followed by b is what their text is encoded to.

        Backwards in time: the token made last is taken apart, and the parts at the border must not have
        had an earlier merge. Of equal merges the left one comes first.
        """
        before = len(self.merge)
        while True:
            if self.merge.get(a << self.shift | b, before) < before:
                return False
            made_a, made_b = self.rank.get(a, -1), self.rank.get(b, -1)
            if made_a > made_b:
                a, before = self.parts[a][1], made_a
            elif made_b >= 0:
                b, before = self.parts[b][0], made_b + 1
            else:
                return True

    def encode(self, words: list[str]) -> list[list[int]]:
        """Ids of distinct words in sorted order: the trie's nodes in depth-first order are what each adds to the one before it."""
        inner, size, apart, shift = self.inner, self.size, self.apart, self.shift
        if len(apart) > PAIRS:
            apart.clear()
        last: list[int] = [-1]  # the last token of each prefix on the path; none for the empty one
        path, out = "", []
        for word in words:
            n = len(word)
            shared, most = 0, min(n - 1, len(path))
            while shared < most and path[shared] == word[shared]:
                shared += 1
            del last[shared + 1 :]
            for d in range(shared + 1, n + 1):
                ends = inner if d < n else self.final
                k = d - 1
                # from the shortest suffix to the longest that a token ends with; one of them fits
                while (token := ends[word[k:d]]) < 0 or k:
                    if token >= 0:
                        pair = last[k] << shift | token
                        known = apart.get(pair)
                        if known is None:
                            known = apart[pair] = self.stay_apart(last[k], token)
                        if known:
                            break
                    k -= 1
                # a token's own text is that token, as every merge comes after those of its parts
                last.append(token)
            path = word[:-1]
            ids, d = [token], k
            while d:
                token = last[d]
                ids.append(token)
                d -= size[token]
            ids.reverse()
            out.append(ids)
            last.pop()
        return out


class Codec:
    """What a tokenizer file says, with the caches of this worker."""

    def __init__(self, tokenizer: bytes):
        from tokenizers import Tokenizer

        spec = json.loads(tokenizer)
        model = spec["model"]
        if model["type"] != "BPE" or not model["end_of_word_suffix"] or model["continuing_subword_prefix"] or model["byte_fallback"] or model["ignore_merges"]:
            raise ValueError("not a BPE model with word ends")
        self.merges = Merges(model["vocab"], model["merges"], model["end_of_word_suffix"])
        # the normalizer and the splitter without the model
        bare = Tokenizer.from_str(json.dumps({**spec, "added_tokens": [], "model": {**model, "vocab": {}, "merges": []}}))
        self.normalizer, self.splitter = bare.normalizer, bare.pre_tokenizer
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile("|".join(sorted(map(regex.escape, self.special), key=len, reverse=True))) if self.special else None
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        names = {**{i: t for t, i in model["vocab"].items()}, **{i: t for t, i in self.special.items()}}
        self.known = np.zeros(max(names) + 1, bool)
        self.known[list(names)] = True
        # each name after a space, so that a text is what its ids' names come to, less the first space
        self.names = pa.array([f" {names[i]}" if i in names else "" for i in range(len(self.known))], pa.large_string()).cast(pa.large_binary())
        self.pieces = Known(PIECES, PIECES_BYTES)

    def _words(self, piece: str) -> list[str]:
        if piece.isascii() and piece.isprintable():
            return self.pattern.findall(piece.lower())
        return [w for w, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(piece))]

    def _split(self, piece: str) -> list[str | int]:
        """Words of a piece, and ids of the special tokens whose strings it holds."""
        if self.cut is None or "<" not in piece:
            return self._words(piece)
        out: list[str | int] = []
        at = 0
        for found in self.cut.finditer(piece):
            out += [*self._words(piece[at : found.start()]), self.special[found[0]]]
            at = found.end()
        return out + self._words(piece[at:])

    def _learn(self, pieces: pa.Array) -> None:
        """Put the packed ids of pieces into the cache."""
        parts = [self._split(p) for p in pieces.cast(pa.large_string()).to_pylist()]
        words = sorted({w for p in parts for w in p if isinstance(w, str)})
        found = dict(zip(words, self.merges.encode(words), strict=True))
        ids: list[int] = []
        ends = [0]
        for p in parts:
            for w in p:
                if isinstance(w, str):
                    ids += found[w]
                else:
                    ids.append(w)
            ends.append(len(ids))
        self.pieces.add(pieces, binary(np.array(ids, "<u4").tobytes(), 4 * np.array(ends, np.int64)))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """Packed ids of the texts of a block."""
        self.pieces.turn()
        starts, ends, first = arrow.words(data, offsets, _NOT_SPACE)
        coded = binary(data[_NOT_SPACE[data]].tobytes(), np.append(0, np.cumsum(ends - starts))).dictionary_encode()
        distinct = coded.dictionary
        place = self.pieces.find(distinct)
        new = distinct.filter(pa.array(place < 0))
        if len(new):
            self._learn(new)
            place[place < 0] = self.pieces.find(new)
        ids, at = flat(self.pieces.values.take(pa.array(place[np.asarray(coded.indices)])))
        return binary(ids, at[first])

    def decode(self, packed: pa.Array) -> pa.Array:
        """The text that each packed id list stands for: the names of its tokens, with spaces between them."""
        data, at = flat(packed)
        ids = np.frombuffer(data[at[0] : at[-1]].tobytes(), "<u4")
        strange = ids[(ids >= len(self.known)) | ~self.known[np.minimum(ids, len(self.known) - 1)]]
        if len(strange):
            raise ValueError(f"id {int(strange[0])} is not in the vocabulary")
        text, stop = flat(self.names.take(pa.array(ids.astype(np.int64))))
        bounds = stop[(at - at[0]) // 4]
        kept = np.ones(len(text), bool)
        some = np.diff(bounds) > 0
        kept[bounds[:-1][some]] = False
        return binary(text[kept].tobytes(), bounds - np.append(0, np.cumsum(some)))


_codecs: dict[bytes, Codec] = {}


def codec(tokenizer: bytes) -> Codec:
    """The worker's codec for this file; its caches are kept while the worker lives."""
    if tokenizer not in _codecs:
        _codecs[tokenizer] = Codec(tokenizer)
    return _codecs[tokenizer]


def encode(docs: DataFrame, tokenizer: bytes, text: str = "text", into: str = "ids", decoded: str | None = None) -> DataFrame:
    """docs with a binary column of ids, packed as little-endian unsigned 32-bit integers.

    With a name in decoded, also what these ids decode to, from the same workers and codec.
    """
    added = [into] if decoded is None else [into, decoded]
    kept = [c for c in docs.columns if c not in added]
    source = docs.select(*[F.col(arrow.quoted(c)) for c in kept])
    place = kept.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer)
        for batch in batches:
            for first, end, data, offsets in arrow.text_blocks(batch.column(place), BLOCK_BYTES):
                ids = own.encode(data, offsets)
                out = [ids.cast(pa.binary())] if decoded is None else [ids.cast(pa.binary()), own.decode(ids).cast(pa.large_string()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays([*batch.slice(first, end - first).columns, *out], names=[*batch.schema.names, *added])
        pa.default_memory_pool().release_unused()

    return arrow.mapped(source, run, len(kept), *(T.StructField(x, T.BinaryType() if x == into else T.StringType()) for x in added))


def decode(tokens: DataFrame, tokenizer: bytes, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """tokens with the text that the packed ids stand for; null ids are none."""
    kept = [c for c in tokens.columns if c != into]
    source = tokens.select(*[F.col(arrow.quoted(c)) for c in kept])
    place = kept.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer)
        for batch in batches:
            column = pc.fill_null(batch.column(place), b"").cast(pa.large_binary())
            block = np.cumsum(np.asarray(pc.binary_length(column), np.int64)) // BLOCK_BYTES
            cuts = [*np.unique([0, *(np.flatnonzero(np.diff(block)) + 1)]).tolist(), len(column)] if len(column) else []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, own.decode(column.slice(a, b - a)).cast(pa.large_string()).cast(pa.string())], names=[*batch.schema.names, into])

    return arrow.mapped(source, run, len(kept), T.StructField(into, T.StringType()))


def public_tokenizer(name: str = "word_bpe_49k.json") -> bytes:
    """The file of an installed public tokenizer."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, number of tokens, and digests of the packed ids and of what they decode to."""
    back = encode(read(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizer(), decoded="decoded")
    return back.select("doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
