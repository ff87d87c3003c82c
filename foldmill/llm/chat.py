"""Chat formatting: schema fingerprints select declarative mappings to canonical turns.

A record is a JSON object. Its fingerprint is a hash of its nested field paths (list elements are ``[]``); the fingerprint selects a
``Mapping`` that says where the turns, their roles and their texts are. Prompt/response pairs, instruction records and message lists
all become canonical turns (role, text), which a template marks and joins.

Marks start with ``<|``. Inside roles and texts every ``<`` that is followed by backslashes and a bar gets one backslash more, so no ``<|``
is left there; taking one away gives the text back. Each turn is formatted by itself: the output of a conversation is the concatenation of its pieces, which stay
separate rows, so a conversation of any length never sits in memory.

Null roles and texts count as empty, records that are null or not objects give no turns, a record with an unknown fingerprint raises unless a fallback is
given. Turns of equal number are ordered by role and text. Repeated rows are turns of their own; an empty table gives no rows (the report then has conversation -1 alone).
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldmill.llm.common import partitions, ready, stored

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
LEARNED_ROLE = "assistant"
_OPEN = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


@dataclass(frozen=True)
class Mapping:
    """Where a layout keeps its turns.

    ``fields``: (role, path) for layouts with one field a turn, in order. Or ``turns``, the path of a list, with ``role`` and ``text``, paths inside an
    element. Or ``role`` and ``text`` alone: the record is one turn. ``roles`` renames roles; absent or null fields of ``fields`` give no turn if
    they are ``optional``.
    """

    paths: tuple[str, ...]
    fields: tuple[tuple[str, str], ...] = ()
    turns: str = ""
    role: str = ""
    text: str = ""
    roles: tuple[tuple[str, str], ...] = ()
    optional: tuple[str, ...] = ()


_NAMES = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant"))
MAPPINGS = (
    Mapping(("role", "text"), role="role", text="text"),
    Mapping(("messages", "messages[].content", "messages[].role"), turns="messages", role="role", text="content", roles=_NAMES),
    Mapping(("messages",), turns="messages", role="role", text="content", roles=_NAMES),
    Mapping(("conversations", "conversations[].from", "conversations[].value"), turns="conversations", role="from", text="value", roles=_NAMES),
    Mapping(("conversation", "conversation[].role", "conversation[].text"), turns="conversation", role="role", text="text", roles=_NAMES),
    Mapping(("prompt", "response"), fields=(("user", "prompt"), ("assistant", "response"))),
    Mapping(("completion", "prompt"), fields=(("user", "prompt"), ("assistant", "completion"))),
    Mapping(("prompt", "response", "system"), fields=(("system", "system"), ("user", "prompt"), ("assistant", "response")), optional=("system",)),
    Mapping(("instruction", "output"), fields=(("user", "instruction"), ("assistant", "output"))),
    Mapping(("input", "instruction", "output"), fields=(("user", "instruction"), ("user", "input"), ("assistant", "output")), optional=("input",)),
    Mapping(("data", "data.answer", "data.question"), fields=(("user", "data.question"), ("assistant", "data.answer"))),
)


def field_paths(value: object, at: str = "") -> set[str]:
    """All nested field paths of a decoded JSON value."""
    found: set[str] = set()
    stack = [(value, at)]
    while stack:
        value, at = stack.pop()
        if isinstance(value, dict):
            for name, inner in value.items():
                path = f"{at}.{name}" if at else name
                found.add(path)
                stack.append((inner, path))
        elif isinstance(value, list):
            stack.extend((inner, f"{at}[]") for inner in value)
    return found


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def _at(value: object, path: str) -> object:
    for name in path.split("."):
        value = value.get(name) if isinstance(value, dict) else None
    return value


def _plain(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def turns_of(record: dict, mapping: Mapping) -> Iterator[tuple[str, str]]:
    """Canonical turns of one record."""
    renamed = dict(mapping.roles)
    if mapping.fields:
        for role, path in mapping.fields:
            value = _at(record, path)
            if path not in mapping.optional or value not in (None, ""):
                yield role, _plain(value)
        return
    for one in (_at(record, mapping.turns) or []) if mapping.turns else [record]:
        role = _plain(_at(one, mapping.role))
        yield renamed.get(role, role), _plain(_at(one, mapping.text))


def canonical_turns(records: DataFrame, keys: list[str], record: str = "record", mappings: tuple[Mapping, ...] = MAPPINGS, fallback: Mapping | None = None) -> DataFrame:
    """The turns of each record: its ``keys``, ``layout`` (the fingerprint), ``turn`` (from 0 in the record), ``role``, ``text``."""
    known = {fingerprint(m.paths): m for m in mappings}

    def run(batches):
        for batch in batches:
            rows, layouts, places, roles, texts = [], [], [], [], []
            for i, raw in enumerate(batch.column(len(keys)).to_pylist()):
                value = json.loads(raw) if raw else None
                if not isinstance(value, dict):
                    continue
                layout = fingerprint(field_paths(value))
                mapping = known.get(layout, fallback)
                if mapping is None:
                    raise ValueError(f"no mapping for layout {layout}: {sorted(field_paths(value))}")
                for n, (role, text) in enumerate(turns_of(value, mapping)):
                    rows.append(i)
                    layouts.append(layout)
                    places.append(n)
                    roles.append(role)
                    texts.append(text)
            kept = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([kept.column(k) for k in range(len(keys))] + [pa.array(layouts, pa.string()), pa.array(places, pa.int64()), pa.array(roles, pa.string()), pa.array(texts, pa.string())], names=[*keys, "layout", "turn", "role", "text"])

    ready(records.sparkSession)
    named = ", ".join(f"{k} {records.schema[k].dataType.simpleString()}" for k in keys)
    return records.select(*keys, record).mapInArrow(run, f"{named}, layout string, turn long, role string, text string")


def escape(text: str) -> str:
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """A turn's piece, and the learned span in it (code points; empty unless the role is learned)."""
    head = f"{TURN}{escape(role)}{TEXT}"
    body = escape(text)
    learned = role == LEARNED_ROLE
    return head + body + END, len(head), len(head) + len(body) * learned


def parse_turn(piece: str) -> tuple[str, str]:
    """Role and text back from a piece; what does not have the template's form raises."""
    if not piece.startswith(TURN) or not piece.endswith(END):
        raise ValueError("not a turn")
    role, mark, text = piece[len(TURN) : -len(END)].partition(TEXT)
    if not mark or "<|" in role or "<|" in text:
        raise ValueError("not a turn")
    return unescape(role), unescape(text)


def formatted(turns: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` with piece, loss_start and loss_end (in the piece) for each turn."""

    def run(batches):
        for batch in batches:
            found = [format_turn(r or "", t or "") for r, t in zip(batch.column(len(keys)).to_pylist(), batch.column(len(keys) + 1).to_pylist())]
            columns = [batch.column(k) for k in range(len(keys))] + [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.int64()), pa.array([x[2] for x in found], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keys, "piece", "loss_start", "loss_end"])

    ready(turns.sparkSession)
    named = ", ".join(f"{k} {turns.schema[k].dataType.simpleString()}" for k in keys)
    return turns.select(*keys, "role", "text").mapInArrow(run, f"{named}, piece string, loss_start long, loss_end long")


def digests(pieces: DataFrame, by: str, order: list[str]) -> DataFrame:
    """Per conversation what its formatted output says, read piece by piece: number of turns, digests of turns and of the text under the loss mask.

    Rows are dealt by conversation and stream through in order; only hash states are kept."""

    def run(batches):
        name, state, started = None, None, False

        def closed():
            n, turns, chars, loss, length = state
            return [name, n, turns.hexdigest(), chars, loss.hexdigest(), length]

        for batch in batches:
            out = []
            for key, piece, a, b in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if not started or key != name:
                    if started:
                        out.append(closed())
                    name, state, started = key, [0, hashlib.sha256(), 0, hashlib.sha256(), 0], True
                role, text = parse_turn(piece)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                learned = unescape(piece[a:b])
                state[2] += len(learned)
                state[3].update(learned.encode())
                state[4] += len(piece)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], names=names)
        if started:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(closed(), kinds)], names=names)

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    ready(pieces.sparkSession)
    ordered = pieces.repartition(partitions(pieces.sparkSession), by).sortWithinPartitions(by, *order)
    return ordered.select(by, "piece", "loss_start", "loss_end").mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def format_conversations(rows: DataFrame) -> DataFrame:
    """Formatted pieces of a table of turns (conv_id, turn, role, text), each row taken as a record of one turn; written once and read back."""
    records = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("place"), F.to_json(F.struct(F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))).alias("record"))
    turns = canonical_turns(records, ["conv_id", "place"])
    return stored(formatted(turns, ["conv_id", "place"]), "chat")


def report(conversations: DataFrame) -> DataFrame:
    """Digests of all conversations and of conversation -1, whose two turns say the marks of another template."""
    spark = conversations.sparkSession
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text").unionByName(probe)
    return digests(format_conversations(rows), "conv_id", ["place", "piece"])
