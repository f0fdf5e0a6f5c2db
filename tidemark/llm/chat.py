"""Chat formatting by incremental black-box rendering.

A template is any function from turns (role and text) to a string. It is not asked where a turn's text
ends up: the prefixes of a conversation are rendered one after the other, and what a rendering adds to
the one before is the new turn's span. A rendering that does not begin with the one before means that
the template rewrites history; such a conversation has no spans and is reported. Inside the span of a
turn, its text is found by rendering the turn once more with an empty text: the common beginning and
end of both are the template's own marks.

A template that is a plain function renders every prefix from its first turn on, which costs the square
of the turns. A ``Resumable`` one goes on from the state that the prefix before has left, whatever that
state holds of it, and only the ends of two successive renderings have to be compared: what was put out
before a turn was known cannot depend on it. So the work is linear, and prefixes are still whole ones.

``format_conversations`` has a conversation in one row. ``format_turns`` works at any length: turns are
range-sorted by conversation and place and each partition is walked in order. Conversations that go on
from the partition before wait for the state they go on from; it comes from a stream of their turns that
renders nothing. A turn is a row; offsets in the conversation come from sums of the partitions, digests
from a stream of sorted rows.

``marked_turns`` is the template used here. Each turn is ``<turn role>`` text ``</turn>`` on lines of
their own; a line of the text that could be taken for a control string gets one more backslash, and
loses it when read back, so any text and any role comes back as it was. ``marked_prefix`` is the same
template as a plain function; the query uses it, so every prefix of a conversation is really rendered and
compared with the one before.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.text import SLICE_CHARS, SLICE_ROWS, arrow_schema, in_small_batches, slices
from tidemark.session import written

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

# Control strings: a turn's opening and closing mark, and the heads that other formats use. Each is
# escaped by a backslash behind its first character; so is a backslash that stands there already.
_CONTROL = re.compile(r"(<)(?=\\*/?turn\b)|(#)(?=\\*##\s*\w+:)")
_ESCAPED = re.compile(r"(<)\\(?=\\*/?turn\b)|(#)\\(?=\\*##\s*\w+:)")
_OPEN = re.compile(r"<turn ([^\n]*)>\n")
_CLOSE = "\n</turn>\n"


def escape(text: str) -> str:
    # Most texts have no control string; prefixes show a text again and again.
    return _CONTROL.sub(r"\g<0>\\", text) if "turn" in text or "##" in text else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def _escape_role(role: str) -> str:
    return escape(role).replace("%", "%25").replace("\n", "%0A")


def _unescape_role(role: str) -> str:
    return unescape(role.replace("%0A", "\n").replace("%25", "%"))


@dataclass(frozen=True)
class Resumable:
    """A template whose rendering goes on from a state, which may hold anything of the turns before.

    ``show`` is what a turn appends for good, ``end`` what the rendering of a prefix has behind that and
    the next one may replace; ``step`` is the state behind a turn. States are pickled.
    """

    begin: Any
    step: Callable[[Any, Turn], Any]
    show: Callable[[Any, Turn], str]
    end: Callable[[Any], str]

    def __call__(self, turns: list[Turn]) -> str:
        state, out = self.begin, []
        for turn in turns:
            out.append(self.show(state, turn))
            state = self.step(state, turn)
        return "".join(out) + self.end(state)


def resumable(template: Template) -> Resumable:
    """Any template as one with states; that of a plain function is all turns so far."""
    if isinstance(template, Resumable):
        return template
    return Resumable((), lambda turns, turn: (*turns, turn), lambda turns, turn: "", lambda turns: template(list(turns)))


def _marked_turn(_: None, turn: Turn) -> str:
    return f"<turn {_escape_role(turn[0])}>\n{escape(turn[1])}{_CLOSE}"


def _stateless(_: None, turn: Turn) -> None:
    return None


def _nothing(_: None) -> str:
    return ""


marked_turns = Resumable(None, _stateless, _marked_turn, _nothing)


def marked_prefix(turns: list[Turn]) -> str:
    """What ``marked_turns`` gives, by a plain function: each prefix is rendered whole."""
    return "".join([_marked_turn(None, turn) for turn in turns])


def read_turns(formatted: str) -> list[Turn]:
    """The turns back from what ``marked_turns`` made."""
    turns, at = [], 0
    while at < len(formatted):
        opened = _OPEN.match(formatted, at)
        closed = formatted.index(_CLOSE, opened.end())
        turns.append((_unescape_role(opened[1]), unescape(formatted[opened.end() : closed])))
        at = closed + len(_CLOSE)
    return turns


@dataclass
class Rendered:
    """A conversation's rendering; spans are ``(start, end, text_start, text_end)`` by turn.

    ``rewritten_at`` is the first turn whose rendering changed what stood before (no spans then).
    """

    text: str
    spans: list[tuple[int, int, int, int]]
    rewritten_at: int | None = None


def _common(a: str, b: str) -> int:
    return len(os.path.commonprefix([a, b]))


def _text_span(added: str, bare: str, text: str) -> tuple[int, int] | None:
    """Where ``text`` stands in ``added``; ``bare`` is the same turn rendered with an empty text."""
    if not text:
        return len(added), len(added)
    head = min(_common(added, bare), len(bare))
    tail = _common(added[::-1], bare[::-1])
    length = len(added) - len(bare)
    # Marks and text may share characters; any place in this range gives the same string, and the one
    # that reads back as the text is right.
    for at in range(max(0, len(bare) - tail), head + 1):
        if unescape(added[at : at + length]) == text:
            return at, at + length
    return None


class Prefixes:
    """The successive prefixes of a conversation, each rendered and compared with the one before."""

    def __init__(self, template: Template):
        self.template = resumable(template)
        self.begin(None)

    def begin(self, state: bytes | None) -> None:
        """At the first turn, or behind the turns that have left this state."""
        self.first = state is None
        self.state = self.template.begin if state is None else pickle.loads(state)
        self.tail = self.template.end(self.state)

    def _next(self, turn: Turn) -> tuple[Any, str, str]:
        shown, state = self.template.show(self.state, turn), self.template.step(self.state, turn)
        tail = self.template.end(state)
        return state, tail, shown + tail

    def add(self, turn: Turn) -> tuple[str, int, int] | None:
        """What the turn adds to the rendering, and the span of its text in that; None: rewritten.

        The first turn of a conversation also has what the template starts with.
        """
        role, text = turn
        before, first = self.tail, self.first
        state, tail, now = self._next(turn)
        empty = self._next((role, ""))[2] if text else now
        self.state, self.tail, self.first = state, tail, False
        if not (now.startswith(before) and empty.startswith(before)):
            return None
        start = 0 if first else len(before)
        found = _text_span(now[start:], empty[start:], text)
        return None if found is None else (now[start:], *found)

    def left(self) -> bytes:
        return pickle.dumps(self.state)


def render(turns: list[Turn], template: Template) -> Rendered:
    """Render successive prefixes and compare each with the one before."""
    prefixes = Prefixes(template)
    head = len(prefixes.tail)
    pieces, spans, start = [], [], 0
    for k, turn in enumerate(turns):
        made = prefixes.add(turn)
        if made is None:
            return Rendered(template(turns), [], k)
        piece, *found = made
        spans.append((start if k else head, start + len(piece), start + found[0], start + found[1]))
        pieces.append(piece)
        start += len(piece)
    return Rendered("".join(pieces) if turns else prefixes.tail, spans)


def added_by(turn: Turn, last: Turn | None, template: Template) -> tuple[str, int, int] | None:
    """What a turn adds to a conversation of the one turn before it (None: of no turn)."""
    prefixes = Prefixes(template)
    if last is not None:
        prefixes.add(last)
    return prefixes.add(turn)


def conversations(rows: DataFrame) -> DataFrame:
    """``conv_id, turns`` with the turns of a conversation in order (turn, then role, then text).

    Null roles and texts count as empty; rows without ``conv_id`` form one conversation of their own,
    rows without ``turn`` come first. A conversation is one string in the end, so it is one row here.
    """
    turn = F.struct(
        F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))


_FORMATTED = (
    "conv_id long, formatted string, spans array<struct<start:int,end:int,text_start:int,text_end:int>>, "
    "loss array<struct<start:int,end:int>>, rewritten_at int"
)


def format_conversations(rows: DataFrame, template: Template = marked_turns, trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """``conv_id, formatted, spans, loss, rewritten_at`` of every conversation.

    ``spans`` has the place of each turn and of its text, in code points; ``loss`` the texts of the
    ``trained`` roles, the marks around them left out. A template that rewrites history gives empty
    spans and the turn where it did. An empty table gives an empty result.
    """
    schema = arrow_schema(_FORMATTED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                part = batch.slice(k, 64)
                out = []
                for conv_id, turns in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    said = [(t["role"], t["text"]) for t in turns]
                    made = render(said, template)
                    spans = [dict(zip(("start", "end", "text_start", "text_end"), s, strict=True)) for s in made.spans]
                    loss = [
                        {"start": s[2], "end": s[3]}
                        for (role, _), s in zip(said, made.spans, strict=False)
                        if role in trained and s[3] > s[2]
                    ]
                    out.append((conv_id, made.text, spans, loss, made.rewritten_at))
                arrays = [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return in_small_batches(conversations(rows)).mapInArrow(run, _FORMATTED)


_WALKED = (
    "conv_id long, part int, place long, edge string, role string, text string, state binary, "
    "formatted string, text_start long, text_end long, rewritten boolean"
)
_WAITING = "conv_id long, part int, place long, role string, text string, state binary"
_TURNS = "conv_id long, part int, place long, role string, formatted string, text_start long, text_end long, rewritten boolean"

def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as batches of at most 1,000 rows and about ``SLICE_CHARS`` characters or bytes of states."""
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += sum(len(v) for v in row if isinstance(v, str | bytes))
        if len(held) >= SLICE_ROWS or chars >= SLICE_CHARS:
            yield _batch(held, schema)
            held, chars = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _rows(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple]:
    for batch in batches:
        for columns in slices(batch, text):
            yield from zip(*columns.values(), strict=True)


def _formatted(made: tuple[str, int, int] | None) -> tuple:
    return (*made, False) if made else (None, None, None, True)


def format_turns(rows: DataFrame, template: Template = marked_turns) -> DataFrame:
    """``conv_id, part, place, role, formatted, text_start, text_end, rewritten``, a row for each turn.

    ``formatted`` is what the turn adds, ``text_start`` and ``text_end`` the place of its text in it (code
    points); ``part, place`` is the order of turns over all conversations (turn, then role, then text).
    What the template adds for a turn may depend on all turns before it; one that changes what stands
    there gives ``rewritten`` and nulls. Null roles and texts count as empty, rows without
    ``turn`` come first, rows without ``conv_id`` are one conversation. Repeated rows stay. An empty
    table gives an empty result.

    Turns are sorted once by range, so a conversation of any length is spread over partitions. The first
    conversation of a partition waits until the template's state behind the partitions before is known.
    The work is linear with a ``Resumable`` template and the square of a conversation's turns with others.
    """
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role")]
    named = rows.select("conv_id", "turn", *(F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")))
    # Ranges are cut by beginnings of texts (their bounds go through the driver); equal rows stay together.
    spread = named.repartitionByRange(*order, F.substring("text", 1, 64))
    ordered = spread.sortWithinPartitions(*order, "text").select(F.spark_partition_id().alias("part"), "conv_id", "role", "text")
    walked_schema, waiting_schema, turns_schema = (arrow_schema(s) for s in (_WALKED, _WAITING, _TURNS))
    none = (None,) * 4

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every conversation but the first, whose turns wait, and the state that the last one leaves."""

        def walked() -> Iterator[tuple]:
            prefixes, here, waiting = Prefixes(template), None, True
            for place, (part, conv_id, role, text) in enumerate(_rows(batches, "text")):
                if here is not None and here[0] != conv_id:
                    waiting = False
                    prefixes.begin(None)
                here = (conv_id, part, place)
                if waiting:
                    yield (*here, "first", role, text, None, *none)
                else:
                    yield (*here, "", role, None, None, *_formatted(prefixes.add((role, text))))
            if not waiting:
                yield (*here, "last", None, None, prefixes.left(), *none)

        yield from _batches(walked(), walked_schema)

    def resume(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The state at the first turn of each partition, from the turns before it in order."""

        def states() -> Iterator[tuple]:
            kind, at, state = resumable(template), None, None
            for conv_id, part, _, role, text, left in _rows(batches, "text"):
                if at is None or at[0] != conv_id:
                    state, begun = kind.begin, False
                if left is not None:
                    state, begun = pickle.loads(left), True
                else:
                    if at != (conv_id, part):
                        yield (conv_id, part, -1, None, None, pickle.dumps(state) if begun else None)
                    state, begun = kind.step(state, (role, text)), True
                at = (conv_id, part)

        yield from _batches(states(), waiting_schema)

    def go_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def formatted() -> Iterator[tuple]:
            prefixes = Prefixes(template)
            for conv_id, part, place, role, text, state in _rows(batches, "text"):
                if place < 0:
                    prefixes.begin(state)
                else:
                    yield (conv_id, part, place, role, *_formatted(prefixes.add((role, text))))

        yield from _batches(formatted(), turns_schema)

    walked = written(in_small_batches(ordered).mapInArrow(walk, _WALKED), "chat-turns")
    edges = walked.where("edge != ''").select(*waiting_schema.names)
    streamed = edges.repartition("conv_id").sortWithinPartitions("conv_id", "part", "place")
    states = written(streamed.mapInArrow(resume, _WAITING), "chat-states")
    firsts = walked.where("edge = 'first'").select(*waiting_schema.names).unionByName(states)
    resumed = firsts.repartition("part").sortWithinPartitions("part", "place").mapInArrow(go_on, _TURNS)
    return walked.where("edge = ''").select(*turns_schema.names).unionByName(resumed)


def with_offsets(turns: DataFrame) -> DataFrame:
    """``format_turns`` with ``start``: where each turn begins in its conversation's string.

    A turn's offset is what its conversation has in the partitions before, a sum of few rows, and in its
    own partition before it. Behind a rewritten turn there are no offsets (null).
    """
    size = F.when(~F.col("rewritten"), F.length("formatted")).cast("long")
    sized = turns.withColumn("size", size)
    sums = sized.groupBy("conv_id", "part").agg(F.sum("size").alias("sum"), F.max("rewritten").alias("bad"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col("conv_id").alias("sum_conv"),
        F.col("part").alias("sum_part"),
        F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("base"),
        F.coalesce(F.max("bad").over(before), F.lit(False)).alias("base_bad"),
    )
    joined = sized.join(sums, (F.col("part") == F.col("sum_part")) & F.col("conv_id").eqNullSafe(F.col("sum_conv")))
    here = Window.partitionBy("part", "conv_id").orderBy("place")
    until = here.rowsBetween(Window.unboundedPreceding, -1)
    bad = F.col("base_bad") | F.max("rewritten").over(here.rowsBetween(Window.unboundedPreceding, 0))
    start = F.col("base") + F.coalesce(F.sum("size").over(until), F.lit(0))
    return joined.withColumn("start", F.when(~bad, start)).select(*turns.columns, "start")


_DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def digests(turns: DataFrame, trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """What can be read back from formatted turns: the turns, and the text under the loss mask.

    The loss mask is the text span of every turn of a ``trained`` role. Conversations are streams of sorted
    rows: a digest needs its conversation in one task, in order, but never whole in memory.
    """
    schema = arrow_schema(_DIGESTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def conversation() -> Iterator[tuple]:
            state: _Digest | None = None
            for conv_id, _, _, role, text, start, end, _ in _rows(batches, "formatted"):
                if state is None or state.conv_id != conv_id:
                    if state is not None:
                        yield state.row()
                    state = _Digest(conv_id)
                state.add(text or "", (start, end) if role in trained and text is not None else None)
            if state is not None:
                yield state.row()

        yield from _batches(conversation(), schema)

    names = arrow_schema(_TURNS).names
    streamed = turns.select(*names).repartition("conv_id").sortWithinPartitions("conv_id", "part", "place")
    return in_small_batches(streamed).mapInArrow(run, _DIGESTS)


class _Digest:
    """Sums and digests of one conversation, fed turn by turn."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, formatted: str, loss: tuple[int, int] | None) -> None:
        self.chars += len(formatted)
        for role, text in read_turns(formatted):
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode())
        if loss is not None:
            under = unescape(formatted[loss[0] : loss[1]])
            self.loss_chars += len(under)
            self.loss.update(under.encode())

    def row(self) -> tuple:
        return self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars
