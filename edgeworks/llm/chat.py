"""Chat formatting: records of many layouts to canonical turns, by fingerprints of their nested paths.

A record is a JSON object. The hash of its sorted leaf paths, list items written as [], is its
schema fingerprint. Each declarative mapping states the paths that it needs and those that may be
missing; every such set of paths has a fingerprint of its own in the registry, and the fingerprint of those of
the record's paths that any mapping uses selects the mapping, so further fields do no harm. Turns are then
written by one template and read back from it.

Template: [INST]role[/INST]text</s> for each turn. Inside roles and texts a backslash is doubled and
a control string gets a backslash after its first character, so no control string is left there,
and every backslash escapes what follows it.

Defined cases: a null text or role is empty; a record whose fingerprint is unknown, that is no
JSON object or null, has null turns and keeps its fingerprint (null where there is none); records
without turns give an empty text; ties in the turn number are ordered by role and text; repeated
rows are each a turn; null texts are read back as no turns; other columns are carried along.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrow
from .tables import read

CONTROL = ("<s>", "</s>", "[INST]", "[/INST]")
_CONTROL = re.compile("|".join(re.escape(c) for c in CONTROL))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"\[INST\](.*?)\[/INST\](.*?)</s>", re.DOTALL)
LOSS_ROLE = "assistant"


@dataclass(frozen=True)
class Mapping:
    """How one layout gives turns: a list of messages, or one turn from each of some fields."""

    name: str
    paths: tuple[str, ...]
    optional: tuple[str, ...] = ()
    each: str = ""
    role: str = ""
    text: str = ""
    #: (role, fields whose texts are joined by an empty line) for layouts without a list
    fields: tuple[tuple[str, tuple[str, ...]], ...] = ()
    roles: dict[str, str] = field(default_factory=dict)

    def turns(self, record: dict) -> list[tuple[str, str]]:
        if self.each:
            found = ((m.get(self.role), m.get(self.text)) for m in record[self.each])
            return [(self.roles.get(_text(r), _text(r)), _text(t)) for r, t in found]
        return [(role, "\n\n".join(parts)) for role, names in self.fields if (parts := [_text(record[n]) for n in names if record.get(n) is not None])]


def _text(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def _messages(name: str, each: str, role: str, text: str, *optional: str, roles: dict[str, str] | None = None) -> Mapping:
    inner = (f"{each}[].{role}", f"{each}[].{text}", *(f"{each}[].{o}" for o in optional))
    return Mapping(name, (), (*inner, f"{each}[]", "conv_id", "id", "system"), each, role, text, roles=roles or {})


MAPPINGS = (
    _messages("turn_rows", "turns", "role", "text", "turn"),
    _messages("messages", "messages", "role", "content"),
    _messages("from_value", "conversations", "from", "value", roles={"human": "user", "gpt": "assistant"}),
    Mapping("prompt_response", ("prompt", "response"), ("conv_id", "id", "system"), fields=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping("prompt_completion", ("prompt", "completion"), ("conv_id", "id", "system"), fields=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",)))),
    Mapping("instruction", ("instruction", "output"), ("conv_id", "id", "system", "input"), fields=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))),
    Mapping("question", ("question", "answer"), ("conv_id", "id", "context"), fields=(("user", ("context", "question")), ("assistant", ("answer",)))),
)


def leaf_paths(value: object, at: str = "") -> set[str]:
    """Paths of the leaves; an empty list or object is a leaf."""
    if isinstance(value, dict) and value:
        return set().union(*(leaf_paths(v, f"{at}.{k}" if at else k) for k, v in value.items()))
    if isinstance(value, list):
        return set().union(*(leaf_paths(v, f"{at}[]") for v in value)) if value else {f"{at}[]"}
    return {at}


def fingerprint(paths: set[str]) -> str:
    return f"{xxhash.xxh64_intdigest(chr(10).join(sorted(paths)).encode()):016x}"


def _registry() -> dict[str, Mapping]:
    out: dict[str, Mapping] = {}
    for mapping in MAPPINGS:
        for n in range(len(mapping.optional) + 1):
            for chosen in combinations(mapping.optional, n):
                paths = {*mapping.paths, *chosen}
                if not mapping.each or any(p.startswith(f"{mapping.each}[") for p in paths):
                    out.setdefault(fingerprint(paths), mapping)
    return out


REGISTRY = _registry()
#: Paths that some mapping uses; others are further fields.
USED = frozenset().union(*({*m.paths, *m.optional} for m in MAPPINGS))


def canonical(record: str | None) -> tuple[str | None, str | None, list[tuple[str, str]] | None]:
    """(fingerprint, name of the mapping, turns) of a JSON record."""
    try:
        value = json.loads(record) if record is not None else None
    except ValueError:
        value = None
    if not isinstance(value, dict):
        return None, None, None
    paths = leaf_paths(value)
    key = fingerprint(paths)
    mapping = REGISTRY.get(fingerprint(paths & USED))
    return (key, mapping.name, mapping.turns(value)) if mapping else (key, None, None)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def write(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text, and the code points under the loss mask: the texts of LOSS_ROLE."""
    parts, mask, at = [], [], 0
    for role, text in turns:
        head, body = f"[INST]{escape(role)}[/INST]", escape(text)
        if role == LOSS_ROLE:
            mask.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, "</s>"]
        at += len(head) + len(body) + 4
    return "".join(parts), mask


def parse(formatted: str) -> list[tuple[str, str]]:
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


FORMATTED = "fingerprint string, layout string, formatted string, loss array<struct<start:long,end:long>>"


def format_records(records: DataFrame, record: str = "record", into: str = "chat") -> DataFrame:
    """records with a struct column: fingerprint, layout, formatted text and loss mask."""
    kept = [c for c in records.columns if c != into]
    source = records.select(*[F.col(arrow.quoted(c)) for c in kept])
    place = kept.index(record)
    kind = pa.struct([("fingerprint", pa.string()), ("layout", pa.string()), ("formatted", pa.string()), ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in batch.column(place):
                key, layout, turns = canonical(x.as_py())
                text, mask = (None, None) if turns is None else write(turns)
                out.append({"fingerprint": key, "layout": layout, "formatted": text, "loss": None if mask is None else [{"start": a, "end": b} for a, b in mask]})
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, kind)], names=[*batch.schema.names, into])

    return arrow.mapped(source, run, len(kept), T.StructField(into, T._parse_datatype_string(FORMATTED)))


def records_of(rows: DataFrame) -> DataFrame:
    """(conv_id, record): one JSON record a conversation from rows (conv_id, turn, role, text)."""
    turn = F.struct("turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns")).select("conv_id", F.to_json(F.struct("turns")).alias("record"))


def read_back(chats: DataFrame) -> DataFrame:
    """Digests of turns and loss text, taken from the formatted text and its mask alone."""
    source = chats.select("conv_id", "chat.formatted", "chat.loss")
    schema = T.StructType([source.schema["conv_id"], *T._parse_datatype_string("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for formatted, loss in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                # a record of an unknown layout has no text
                formatted, loss = formatted or "", loss or []
                turns = parse(formatted)
                masked = "".join(unescape(formatted[s["start"] : s["end"]]) for s in loss)
                rows.append((len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(masked), hashlib.sha256(masked.encode()).hexdigest(), len(formatted)))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True))], names=schema.names)

    return source.mapInArrow(run, schema)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], "conv_id long, turn long, role string, text string")
    return read_back(format_records(records_of(rows.unionByName(extra))))
