"""Chat formatting by event-sourced reconstruction.

Input is an event log. Events of a conversation are dealt to one partition,
sorted by sequence, and folded as they stream by: a message is opened, grows
by deltas, is replaced by an edit, or emptied by a regeneration and streamed
again. The final messages are rendered into one text with turn marks, and the
code-point ranges of assistant texts are returned as its loss mask. Only the
message in hand and the text of the conversation in hand are held.

Events: ``conv_id, seq long, kind, role, text`` with kind ``open`` (begins a
message with ``role``), ``delta`` (appends), ``edit`` (replaces),
``regenerate`` (empties). Events before the first ``open`` of a conversation
are ignored. Equal sequence numbers fold in the order open, regenerate, edit, delta, and
then by text.

Defined results: a null text or role is empty; a null ``conv_id`` is one
conversation of its own; an empty message is a turn; an empty log gives no
rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockhand.llm.common import batches, text_of

START, END = "<|im_start|>", "<|im_end|>"
LEARNED_ROLE = "assistant"
DELTA = 400

_TURN = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.DOTALL)
_OPENS, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<(\\*)\\\|")


def escape(text: str) -> str:
    """No control string can appear: every ``<|`` gets one more backslash between."""
    return _OPENS.sub(r"<\1\\|", text) if "<" in text else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text) if "<" in text else text


def escape_role(role: str) -> str:
    """A role stands on one line, so its backslashes and line breaks are written out as well."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render(messages: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text and its loss mask as (start, end) ranges of code points."""
    parts, mask, at = [], [], 0
    for role, text in messages:
        head, body = f"{START}{escape_role(role)}\n", escape(text)
        if role == LEARNED_ROLE:
            mask.append((at + len(head), at + len(head) + len(body)))
        parts += (head, body, END, "\n")
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), mask


def parse(formatted: str) -> list[tuple[str, str]]:
    """Messages read back from a formatted text."""
    return [(unescape_role(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def fold(events: Iterator[tuple[str, str, str]]) -> list[tuple[str, str]]:
    """Final (role, text) messages of one conversation's ordered (kind, role, text) events."""
    messages: list[tuple[str, str]] = []
    role, parts = None, []
    for kind, who, text in events:
        if kind == "open":
            if role is not None:
                messages.append((role, "".join(parts)))
            role, parts = who, [text]
        elif kind == "delta":
            parts.append(text)
        elif kind == "edit":
            parts = [text]
        elif kind == "regenerate":
            parts = []
        else:
            raise ValueError(f"unknown event kind: {kind}")
    if role is not None:
        messages.append((role, "".join(parts)))
    return messages


FORMATTED = pa.schema(
    [("conv_id", pa.int64()), ("formatted", pa.string()), ("loss_starts", pa.list_(pa.int64())), ("loss_ends", pa.list_(pa.int64()))]
)


def _format(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def finish(conv: int | None, events: list[tuple[str, str, str]]) -> tuple:
        formatted, mask = render(fold(iter(events)))
        return conv, formatted, [a for a, _ in mask], [b for _, b in mask]

    nothing = object()
    conv, events, rows, size = nothing, [], [], 0
    for batch in source:
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "kind", "role", "text"))
        for key, *event in zip(*columns, strict=True):
            if key != conv or conv is nothing:
                if conv is not nothing:
                    rows.append(finish(conv, events))
                    size += len(rows[-1][1])
                    if size > 8 << 20:
                        yield from batches(rows, FORMATTED)
                        rows, size = [], 0
                conv, events = key, []
            events.append(tuple(event))
    if conv is not nothing:
        rows.append(finish(conv, events))
    yield from batches(rows, FORMATTED)


def format_chats(events: DataFrame) -> DataFrame:
    """Per conversation: conv_id, formatted, loss_starts, loss_ends (arrays of equal length)."""
    order = F.when(F.col("kind") == "open", 0).when(F.col("kind") == "regenerate", 1).when(F.col("kind") == "edit", 2).otherwise(3)
    rows = events.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "seq",
        order.alias("step"),
        F.col("kind"),
        text_of("role").alias("role"),
        text_of("text").alias("text"),
    )
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "seq", "step", "text")
    return dealt.drop("seq", "step").mapInArrow(
        _format, "conv_id long, formatted string, loss_starts array<long>, loss_ends array<long>"
    )


def _event(seq: Column, kind: str, role: Column, text: Column) -> Column:
    return F.struct(seq.alias("seq"), F.lit(kind).alias("kind"), role.alias("role"), text.alias("text"))


def turn_events(turns: DataFrame, delta: int = DELTA) -> DataFrame:
    """The log a chat service would have kept of finished turns.

    Assistant turns were streamed in part, regenerated and streamed whole;
    other turns were sent without their second half and then edited. Turns of one
    number follow each other by role and text.
    """
    by_turn = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", text_of("role").alias("role"), text_of("text").alias("text"))
    rows = rows.withColumn("at", F.row_number().over(by_turn).cast("long") * (1 << 32))
    at, role, text, none = F.col("at"), F.col("role"), F.col("text"), F.lit("")
    half = F.substring(text, F.lit(1), F.floor(F.length(text) / 2).cast("int"))
    # at most 64 deltas, as each is cut from the start of the text
    width = F.greatest(F.lit(delta), F.ceil(F.length(text) / 64)).cast("int")
    pieces = F.transform(
        F.sequence(F.lit(0), F.greatest(F.ceil(F.length(text) / width) - 1, F.lit(0)).cast("int")),
        lambda k: _event(at + 4 + k, "delta", none, F.substring(text, k * width + 1, width)),
    )
    streamed = F.concat(
        F.array(_event(at, "open", role, none), _event(at + 1, "delta", none, half), _event(at + 2, "regenerate", none, none)), pieces
    )
    edited = F.array(_event(at, "open", role, half), _event(at + 1, "edit", none, text))
    events = F.when(role == LEARNED_ROLE, streamed).otherwise(edited)
    return rows.select("conv_id", F.inline(events))


DIGEST = pa.schema(
    [
        ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
    ]
)


def _read_back(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in source:
        rows = []
        for conv, text, starts, ends in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            turns, loss, learned, n = hashlib.sha256(), hashlib.sha256(), 0, 0
            for role, body in parse(text):
                turns.update(f"{role}\n{body}\n".encode())
                n += 1
            for start, end in zip(starts, ends, strict=True):
                part = unescape(text[start:end])
                learned += len(part)
                loss.update(part.encode())
            rows.append((conv, n, turns.hexdigest(), learned, loss.hexdigest(), len(text)))
        yield from batches(rows, DIGEST)


def chat_digests(formatted: DataFrame) -> DataFrame:
    """What a reader of the formatted texts and masks gets back, as digests."""
    return formatted.mapInArrow(
        _read_back,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
