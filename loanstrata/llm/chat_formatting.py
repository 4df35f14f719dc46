"""Chat formatting from event logs: events are folded into final messages, and these are rendered as marked turns."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanstrata.llm.common import written

# The kinds of events.
MESSAGE, DELTA, EDIT, REGENERATE, DELETE = "message", "delta", "edit", "regenerate", "delete"

# The template: "### role", a line break, the text, "</turn>", a line break.
HEAD, END, TAIL = "### ", "</turn>", "</turn>\n"
#: The role whose texts are under the loss mask.
TRAINED = "assistant"

_CONTROL = re.compile(r"\\|###|</turn>")
_ESCAPED = re.compile(r"\\(\\|###|</turn>)")
_ESCAPED_IN_ROLE = re.compile(r"\\(\\|###|</turn>|n)")
_NEXT = re.compile(r"\\(?:\\|###|</turn>)|</turn>")

#: Characters of messages that a task holds at a time; a longer conversation comes in parts.
PART_CHARS = 4_000_000

_PART = "whole boolean, n_turns int, formatted string, loss_starts array<long>, loss_ends array<long>"
_MESSAGE = "message string, role string, text string, reset boolean, closed boolean, deleted boolean"


def escape(text: str) -> str:
    """``text`` with a backslash before each backslash and each control string."""
    return _CONTROL.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """One turn, and where its escaped text starts and ends."""
    head = HEAD + escape(role).replace("\n", "\\n") + "\n"
    body = escape(text)
    return head + body + TAIL, len(head), len(head) + len(body)


def turns(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of every turn, read back from the output."""
    at = 0
    while at < len(formatted):
        line = formatted.index("\n", at)
        role = _ESCAPED_IN_ROLE.sub(lambda m: "\n" if m[1] == "n" else m[1], formatted[at + len(HEAD) : line])
        # an escaped control string is skipped whole, so the first bare end mark is the turn's
        end = next(m.start() for m in _NEXT.finditer(formatted, line + 1) if m[0] == END)
        yield role, unescape(formatted[line + 1 : end])
        at = end + len(TAIL)


def conversation_log(conversations: DataFrame, delta_chars: int = 512) -> DataFrame:
    """A table of finished turns (conv_id, turn, role, text) as the log that would have led to it.

    Texts of assistants come as a stream: a message event with the first ``delta_chars`` characters, and a
    delta for each further run of them. Others are one message event each. Null turns come first; rows of
    equal turns are ordered by role and a hash of the text, and repeated rows are repeated messages.
    """
    text = F.coalesce("text", F.lit(""))
    runs = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{delta_chars}}}"), F.lit(0))
    streamed = F.when(F.col("role") == TRAINED, runs).otherwise(F.array(text))
    rows = conversations.select(
        "conv_id", "turn", "role", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("row"), streamed.alias("runs")
    )
    events = rows.select("conv_id", "turn", "role", "hash", "row", F.posexplode_outer("runs").alias("at", "text"))
    follows = F.col("at") > 0
    return events.select(
        "conv_id",
        F.struct("turn", "role", "hash", "row", "at").alias("seq"),
        F.when(follows, DELTA).otherwise(MESSAGE).alias("kind"),
        F.col("row").cast("string").alias("message_id"),
        F.when(~follows | F.col("at").isNull(), F.col("role")).alias("role"),
        "text",
    )


class _Message:
    """What some consecutive events of a log make of one message. Joining two of them is associative.

    ``reset``: an event set the text anew, so earlier texts don't count. ``closed``: deltas that follow
    don't count.
    """

    __slots__ = ("closed", "deleted", "message", "nth", "reset", "role", "seq", "texts")

    def __init__(self, seq, nth, message, role=None, text="", reset=False, closed=False, deleted=False) -> None:
        self.seq, self.nth, self.message, self.role, self.texts = seq, nth, message, role, [text] if text else []
        self.reset, self.closed, self.deleted = reset, closed, deleted

    def add(self, later: _Message) -> None:
        if later.reset:
            self.texts, self.reset, self.closed, self.deleted = later.texts, True, later.closed, later.deleted
        elif not self.closed:
            self.texts += later.texts
        if later.role is not None:
            self.role = later.role

    @classmethod
    def of(cls, seq, nth, message, kind, role, text) -> _Message:
        return cls(seq, nth, message, role, text or "", kind != DELTA, kind in (EDIT, DELETE), kind == DELETE)

    def text(self) -> str:
        return "" if self.deleted else "".join(self.texts)


class _Rows:
    """Rows of a fixed schema, given out as batches of some megabytes."""

    def __init__(self, schema: pa.Schema) -> None:
        self.schema, self.held = schema, 0
        self.columns = [[] for _ in schema.names]

    def add(self, size: int, *row) -> None:
        for column, value in zip(self.columns, row, strict=True):
            column.append(value)
        self.held += size + 64

    def full(self) -> Iterator[pa.RecordBatch]:
        if self.held > PART_CHARS:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.columns[0]:
            arrays = [pa.array(c, t) for c, t in zip(self.columns, self.schema.types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=self.schema)
            self.columns, self.held = [[] for _ in self.columns], 0


def _schema(batch: pa.RecordBatch, *fields: tuple[str, pa.DataType]) -> pa.Schema:
    """The conversation's and the sequence number's own types, then the given fields."""
    own = [("conv_id", batch.schema.field("conv_id").type), ("seq", batch.schema.field("seq").type)]
    return pa.schema([*own, ("nth", pa.int64()), *fields])


_SPANS = pa.list_(pa.int64())
_PART_FIELDS = (
    ("whole", pa.bool_()),
    ("n_turns", pa.int32()),
    ("formatted", pa.string()),
    ("loss_starts", _SPANS),
    ("loss_ends", _SPANS),
)
_MESSAGE_FIELDS = (
    ("message", pa.string()),
    ("role", pa.string()),
    ("text", pa.string()),
    ("reset", pa.bool_()),
    ("closed", pa.bool_()),
    ("deleted", pa.bool_()),
)


def _part(messages) -> tuple[int, str, list[int], list[int]]:
    """Turns of the messages that are left, as one text, with the spans under the loss mask."""
    out, at, n, starts, ends = [], 0, 0, [], []
    for m in messages:
        if m.deleted:
            continue
        turn, start, end = render(m.role or "", m.text())
        if m.role == TRAINED:
            starts.append(at + start)
            ends.append(at + end)
        out.append(turn)
        at += len(turn)
        n += 1
    return n, "".join(out), starts, ends


def _fold(batches, most: int):
    """Events in order → one row per conversation that surely lies whole in this task, else one per message.

    A conversation at either end of the task's range may go on in another task, and one of more than
    ``most`` characters is handed on in between; their messages are joined later.
    """
    out = None
    conv, messages, first, cut, held = None, {}, True, False, 0
    seq, nth = None, -1

    def pieces():
        for m in messages.values():
            text = m.text()
            out.add(len(text), conv, m.seq, m.nth, False, *[None] * 4, m.message, m.role, text, m.reset, m.closed, m.deleted)

    for batch in batches:
        out = out or _Rows(_schema(batch, *_PART_FIELDS, *_MESSAGE_FIELDS))
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "seq", "kind", "message_id", "role", "text"))
        for conv_, seq_, kind, message, role, text in zip(*columns, strict=True):
            if (messages or cut) and conv_ != conv:
                if first or cut:
                    pieces()
                else:
                    n, formatted, starts, ends = _part(messages.values())
                    out.add(len(formatted), conv, None, 0, True, n, formatted, starts, ends, *[None] * 6)
                messages, first, cut, held, nth = {}, False, False, 0, -1
                seq = seq_
            elif seq_ != seq:
                nth = -1
            conv, seq, nth = conv_, seq_, nth + 1
            event = _Message.of(seq, nth, message, kind, role, text)
            # an event that names no message shares no key
            key = event if message is None else message
            if key in messages:
                messages[key].add(event)
            else:
                messages[key] = event
            held += len(text or "") + 64
            if held > most:
                pieces()
                messages, cut, held = {}, True, 0
            yield from out.full()
    if out:
        pieces()
        yield from out.rest()


def _message(row) -> _Message:
    _, seq, nth, message, role, text, reset, closed, deleted = row
    return _Message(seq, nth, message, role, text, reset, closed, deleted)


def _sorted_messages(batches):
    names = ["conv_id", "seq", "nth", *[f[0] for f in _MESSAGE_FIELDS]]
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            yield batch, row


def _join(batches):
    """Pieces of messages, sorted by conversation, message and place → one row per message."""
    out, key, held = None, None, None

    def give():
        text = held.text()
        out.add(len(text), key[0], held.seq, held.nth, held.message, held.role, text, held.reset, held.closed, held.deleted)

    for batch, row in _sorted_messages(batches):
        out = out or _Rows(_schema(batch, *_MESSAGE_FIELDS))
        later = _message(row)
        if held is not None and key == (row[0], later.message):
            held.add(later)
            continue
        if held is not None:
            give()
            yield from out.full()
        key, held = (row[0], later.message), later
    if held is not None:
        give()
    if out:
        yield from out.rest()


def _assemble(batches, most: int):
    """Final messages in order → parts of whole turns, none of more than ``most`` characters and a turn."""
    out, conv, messages, held = None, None, [], 0

    def give():
        n, formatted, starts, ends = _part(messages)
        out.add(len(formatted), conv, messages[0].seq, messages[0].nth, False, n, formatted, starts, ends)

    for batch, row in _sorted_messages(batches):
        out = out or _Rows(_schema(batch, *_PART_FIELDS))
        if messages and (row[0] != conv or held > most):
            give()
            yield from out.full()
            messages, held = [], 0
        conv = row[0]
        messages.append(_message(row))
        held += len(row[5] or "") + 64
    if messages:
        give()
    if out:
        yield from out.rest()


def format_conversations(log: DataFrame, part_chars: int = PART_CHARS) -> DataFrame:
    """Final messages of an event log as marked turns:
    (conv_id, seq, nth, whole, n_turns, formatted, loss_starts, loss_ends).

    ``log`` has one event per row: (conv_id, seq, kind, message_id, role, text). ``message`` and
    ``regenerate`` set a message's text anew, a ``delta`` is appended to it, an ``edit`` sets it and ends it
    (deltas that still arrive don't count, until the message is generated again), ``delete`` removes it.
    A message stands at the place of its first event and has the last role an event named. An event of
    another or no kind counts as ``message``; one without ``message_id`` is a message of its own. ``seq`` is of
    any type that can be ordered.

    Backslashes and control strings in roles and texts are escaped by a backslash, so `turns` reads the
    same turns back. ``loss_starts`` and ``loss_ends`` are offsets into ``formatted``, in code points, of the
    escaped texts of assistants.

    The log is cut into ranges of (conversation, sequence), sorted and folded; a conversation that lies
    whole in one range is finished there, which is one shuffle for nearly all of them. Ranges may also cut
    through a conversation, so one that holds a third of all events is many tasks' work: its tasks fold
    their own events, the pieces of a message are joined by message, and the turns come in several rows
    (``whole`` false), which (seq, nth) order. Only one message has to fit a task.

    Null ids are one conversation. Null sequence numbers come first; events of equal numbers are ordered by
    kind, message, role and text, so repeated rows are repeated messages. Null roles and texts are empty.
    A conversation without messages left has no turns and an empty text.
    """
    events = log.select("conv_id", "seq", "kind", F.col("message_id").cast("string").alias("message_id"), "role", "text")
    ordered = events.repartitionByRange("conv_id", "seq").sortWithinPartitions(*events.columns)
    types = {c: events.schema[c].dataType.simpleString() for c in ("conv_id", "seq")}
    own = f"conv_id {types['conv_id']}, seq {types['seq']}, nth long"
    folded = written(ordered.mapInArrow(lambda batches: _fold(batches, part_chars), f"{own}, {_PART}, {_MESSAGE}"))

    names = ["conv_id", "seq", "nth", *[f[0] for f in _MESSAGE_FIELDS]]
    pieces = folded.filter("not whole").select(*names)
    addressed = pieces.filter("message is not null").repartition("conv_id", "message")
    joined = addressed.sortWithinPartitions("conv_id", "message", "seq", "nth").mapInArrow(_join, f"{own}, {_MESSAGE}")
    messages = pieces.filter("message is null").unionByName(joined)
    places = ["conv_id", "seq", "nth"]
    parts = (
        messages.repartitionByRange(*places)
        .sortWithinPartitions(*places)
        .mapInArrow(lambda batches: _assemble(batches, part_chars), f"{own}, {_PART}")
    )
    return folded.filter("whole").select(*parts.columns).unionByName(parts)


def _digests(batches):
    out, conv, state = None, None, None

    def give():
        out.add(0, conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])

    fields = [("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64())]
    fields += [("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
    for batch in batches:
        out = out or _Rows(pa.schema([("conv_id", batch.schema.field("conv_id").type), *fields]))
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_starts", "loss_ends"))
        for conv_, formatted, starts, ends in zip(*columns, strict=True):
            if state is None or conv_ != conv:
                if state is not None:
                    give()
                conv, state = conv_, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text in turns(formatted):
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
            for start, end in zip(starts, ends, strict=True):
                text = unescape(formatted[start:end])
                state[2] += len(text)
                state[3].update(text.encode())
            state[4] += len(formatted)
        if out.held > PART_CHARS:
            yield from out.rest()
    if state is not None:
        give()
    if out:
        yield from out.rest()


def read_back(parts: DataFrame) -> DataFrame:
    """Digests of every conversation, read from the rows of `format_conversations` alone:
    (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars).

    Conversations in one row are read where they lie. The parts of others meet in one task, which reads
    them one by one: a digest over a conversation has to see its bytes in order.
    """
    id_type = parts.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {id_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    columns = ["conv_id", "formatted", "loss_starts", "loss_ends"]
    cut = parts.filter("not whole").repartition("conv_id").sortWithinPartitions("conv_id", "seq", "nth")
    whole = parts.filter("whole").select(*columns)
    return whole.mapInArrow(_digests, schema).unionByName(cut.select(*columns).mapInArrow(_digests, schema))
