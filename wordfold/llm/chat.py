r"""Chat formatting with a grammar round trip.

Turns are rendered by this grammar, one after the other:

    user       <s>[INST] text [/INST]
    assistant  (space) text </s>
    others     <s>[ROLE] role [TEXT] text [/ROLE]     ([NOROLE] for a null role)

Each rendered turn is parsed again by a deterministic parser. If what comes
back is not the source turn, its text (or role name) conflicts with the
grammar: every control string in it, and every one that already has backslashes
before it, gets one more backslash, which the parser takes away again. A turn
that still differs is an error, so what is written always reads back.

A control string never begins inside another one, and the spaces keep a text's
own end away from the closing string, so a turn ends at its own closing string
whatever follows, and turns can be rendered and checked one by one. A
conversation's turns are only streamed in order, never gathered.

Defined results: null texts are empty; a null role is kept and counts as empty
in digests; conversations are ordered by turn (null turns first), and equal
turns by their rendered form; a null conversation id is a conversation; repeated
rows are repeated turns; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordfold.llm.common import stored, table

CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[TEXT]", "[/ROLE]", "[NOROLE]")
_ANY = "|".join(map(re.escape, CONTROL))
_ESCAPE = re.compile(rf"\\*(?:{_ANY})")
_UNESCAPE = re.compile(rf"\\(\\*(?:{_ANY}))")
_FREE = {c: re.compile(rf"(?<!\\){re.escape(c)}") for c in CONTROL}


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def _layout(role: str | None, text: str) -> str:
    if role == "user":
        return f"<s>[INST] {text} [/INST]"
    if role == "assistant":
        return f" {text} </s>"
    return f"<s>[NOROLE] [TEXT] {text} [/ROLE]" if role is None else f"<s>[ROLE] {role} [TEXT] {text} [/ROLE]"


def _until(data: str, at: int, control: str) -> tuple[str, int]:
    """The text from ``at`` to the next unescaped ``control`` and the space before it, and the
    place after it. Any other unescaped control string on the way is an error."""
    end = _FREE[control].search(data, at)
    if not end or end.start() - 1 < at or data[end.start() - 1] != " ":
        raise ValueError(f"no {control}")
    inside = data[at : end.start() - 1]
    if any(p.search(inside) for p in _FREE.values()):
        raise ValueError("unescaped control string")
    return unescape(inside), end.end()


def parse(data: str) -> list[tuple[str | None, str]]:
    """The ``(role, text)`` turns of a formatted conversation."""
    turns, at = [], 0
    while at < len(data):
        if data.startswith("<s>[INST] ", at):
            text, at = _until(data, at + 10, "[/INST]")
            turns.append(("user", text))
        elif data.startswith("<s>[NOROLE] [TEXT] ", at):
            text, at = _until(data, at + 19, "[/ROLE]")
            turns.append((None, text))
        elif data.startswith("<s>[ROLE] ", at):
            role, at = _until(data, at + 10, "[TEXT]")
            if not data.startswith(" ", at):
                raise ValueError("no space after [TEXT]")
            text, at = _until(data, at + 1, "[/ROLE]")
            turns.append((role, text))
        elif data.startswith(" ", at):
            text, at = _until(data, at + 1, "</s>")
            turns.append(("assistant", text))
        else:
            raise ValueError(f"no turn at {at}")
    return turns


def _same(data: str, role: str | None, text: str) -> bool:
    try:
        return parse(data) == [(role, text)]
    except ValueError:
        return False


def render(role: str | None, text: str) -> str:
    """One turn by the grammar; escaped where it would not read back."""
    name = role if role in ("user", "assistant") or role is None else escape(role)
    for shown_role, shown in ((role, text), (role, escape(text)), (name, escape(text))):
        data = _layout(shown_role, shown)
        if _same(data, role, text):
            return data
    raise ValueError(f"turn does not read back: {role!r}")


def chat_format(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, formatted``: each turn of ``conversations`` (``conv_id, turn, role,
    text``) rendered; a conversation's rows in order of ``turn, formatted`` and joined without
    anything between are its formatted text."""
    slim = conversations.select(
        "conv_id", "turn", F.col("role").cast("string").alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    kinds = [slim.schema[c].dataType.simpleString() for c in ("conv_id", "turn")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shown = [render(r.as_py(), t.as_py()) for r, t in zip(b.column(2), b.column(3))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(shown, pa.string())], names=["conv_id", "turn", "formatted"]
            )

    return slim.mapInArrow(run, f"conv_id {kinds[0]}, turn {kinds[1]}, formatted string")


def chat_turns(formatted: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, loss``: formatted turns parsed again; ``loss`` marks the
    texts that a model learns to say (the assistant's)."""
    kinds = [formatted.schema[c].dataType.simpleString() for c in ("conv_id", "turn")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            turns = [parse(x.as_py())[0] for x in b.column(2)]
            role, text = [t[0] for t in turns], [t[1] for t in turns]
            cols = [pa.array(role, pa.string()), pa.array(text, pa.string()), pa.array([r == "assistant" for r in role], pa.bool_())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), *cols], names=["conv_id", "turn", "role", "text", "loss"]
            )

    slim = formatted.select("conv_id", "turn", "formatted")
    return slim.mapInArrow(run, f"conv_id {kinds[0]}, turn {kinds[1]}, role string, text string, loss boolean")


def chat_digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read back from ``formatted``: ``conv_id, n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars``.

    A digest needs its conversation's turns in order, so they are sorted into one
    partition and streamed through it, a batch at a time.
    """
    kind = formatted.schema["conv_id"].dataType.simpleString()
    columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for b in batches:
            out = []
            for conv, data in zip(b.column(0).to_pylist(), b.column(1)):
                if now is None or now[0] != conv:
                    if now is not None:
                        out.append(now)
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                shown = data.as_py()
                now[5] += len(shown)
                for role, text in parse(shown):
                    now[1] += 1
                    now[2].update(f"{role or ''}\n{text}\n".encode())
                    if role == "assistant":
                        now[3] += len(text)
                        now[4].update(text.encode())
            yield finished(out, b.schema.field(0).type)
        if now is not None:
            yield finished([now], b.schema.field(0).type)

    def finished(rows: list, id_type: pa.DataType) -> pa.RecordBatch:
        types = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        values = [[r[0], r[1], r[2].hexdigest(), r[3], r[4].hexdigest(), r[5]] for r in rows]
        cols = [pa.array([v[i] for v in values], t) for i, t in enumerate(types)]
        return pa.RecordBatch.from_arrays(cols, names=columns)

    rows = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")
    schema = f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return rows.select("conv_id", "formatted").mapInArrow(run, schema)


def q_chat(spark, sf_dir):
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chat_digests(stored(chat_format(rows), "chat-formatted"))
