"""Chat formatting with typed content parts.

A message is a list of parts: text, images, audio, documents. A visitor flattens them in
order: text is escaped, any other part becomes one placeholder, and its reference, its place
in the output and the tokens it will expand to are recorded. Every turn becomes a segment

    <|turn|>role<|text|>content<|end|>

and a conversation is its segments in order of turns, so turns are formatted where they lie
and only the segments are brought together. A control string inside a text, with any number
of backslashes after its first character, gets one backslash more there. Control strings
start with `<` or `[` and hold neither further on, so none can arise between a text and what the
template puts beside it; text parts side by side are one text. Taking the backslash out again
gives the text back.

Conversations are read back as streams of their joined segments: where a turn ends is told by
the output alone, and whatever a conversation's length, one turn is held at a time.

Defined cases: a null role, text or part is empty; turns alike in number go by their content;
a null conversation id is an id like others; an unknown kind of part stops the run with its
name; an empty table gives no rows; other columns are not touched.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
# Tokens of a part that does not say how many it takes.
EXPANDED = {"image": 256, "audio": 128, "document": 512}
CONTROL = r"\|(?:turn|text|end|image|audio|document)\|>|/?s>|/?INST\]"
_PLAIN = re.compile(rf"([<\[])(\\*)({CONTROL})")
_ESCAPED = re.compile(rf"([<\[])\\(\\*)({CONTROL})")
_SEGMENT = re.compile(r"<\|turn\|>(.*?)<\|text\|>(.*?)<\|end\|>", re.DOTALL)
_HOLDER = re.compile("|".join(map(re.escape, PLACEHOLDERS.values())))
LOSS_ROLE = "assistant"
# Numbers of turns whose segments are placed together.
BLOCK = 4096

PARTS = "array<struct<kind string, text string, ref string, tokens int>>"
ATTACHMENTS = "array<struct<kind string, ref string, at int, tokens int>>"


def escape(text: str) -> str:
    return _PLAIN.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def _texts(content: str) -> str:
    """The texts of a content without its placeholders, each as it was."""
    return "".join(unescape(t) for t in _HOLDER.split(content))


@dataclass
class Flattener:
    """Visits the parts of a message and gathers its content and attachments.

    Text is held until another part or the end comes, as a control string may begin in one part
    and end in the next.
    """

    out: list[str] = field(default_factory=list)
    size: int = 0
    attachments: list[dict] = field(default_factory=list)
    held: list[str] = field(default_factory=list)

    def visit(self, part: dict) -> None:
        kind = part["kind"] or "text"
        method = getattr(self, f"visit_{kind}", None)
        if method is None:
            raise ValueError(f"unknown kind of content part: {kind}")
        method(part)

    def content(self) -> str:
        self._flush()
        return "".join(self.out)

    def _add(self, text: str) -> None:
        self.out.append(text)
        self.size += len(text)

    def _flush(self) -> None:
        if self.held:
            self._add(escape("".join(self.held)))
            self.held = []

    def visit_text(self, part: dict) -> None:
        self.held.append(part["text"] or "")

    def _attach(self, part: dict) -> None:
        self._flush()
        kind = part["kind"]
        tokens = EXPANDED[kind] if part["tokens"] is None else part["tokens"]
        self.attachments.append({"kind": kind, "ref": part["ref"], "at": self.size, "tokens": tokens})
        self._add(PLACEHOLDERS[kind])

    visit_image = visit_audio = visit_document = _attach


def text_parts(text: Column) -> Column:
    """The parts of a message of text alone."""
    none = F.lit(None)
    one = F.struct(
        F.lit("text").alias("kind"),
        F.coalesce(text, F.lit("")).alias("text"),
        none.cast("string").alias("ref"),
        none.cast("int").alias("tokens"),
    )
    return F.array(one).cast(PARTS)


def format_turns(df: DataFrame, conv_id: Column, turn: Column, role: Column, parts: Column):
    """A row per turn: `conv_id`, `turn`, its `segment`, the places `loss_from` and `loss_to` in it
    (equal if nothing is learnt from it), its `attachments` and the tokens they expand to."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for role, parts in zip(b.column("role"), b.column("parts")):
                name, visitor = role.as_py() or "", Flattener()
                head = f"{TURN}{escape(name)}{TEXT}"
                visitor.size = len(head)
                for part in parts.as_py() or ():
                    if part is not None:
                        visitor.visit(part)
                content = visitor.content()
                end = len(head) + len(content)
                rows.append(
                    (f"{head}{content}{END}", len(head) if name == LOSS_ROLE else end, end,
                     visitor.attachments, sum(a["tokens"] for a in visitor.attachments))
                )
            cols = list(zip(*rows)) if rows else [()] * 5
            attached = pa.list_(
                pa.struct([("kind", pa.string()), ("ref", pa.string()), ("at", pa.int32()), ("tokens", pa.int32())])
            )
            types = [pa.string(), pa.int32(), pa.int32(), attached, pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), b.column("turn"), *[pa.array(c, t) for c, t in zip(cols, types)]],
                ["conv_id", "turn", "segment", "loss_from", "loss_to", "attachments", "expanded"],
            )

    rows = df.select(
        conv_id.alias("conv_id"), turn.alias("turn"), role.alias("role"), parts.cast(PARTS).alias("parts")
    )
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("conv_id", "turn"))
    return rows.mapInArrow(
        run,
        f"{kinds}, segment string, loss_from int, loss_to int, attachments {ATTACHMENTS}, expanded long",
    )


@dataclass
class Reader:
    """Reads the turns of a conversation from its output, given piece by piece."""

    rest: str = ""

    def feed(self, piece: str) -> Iterator[tuple[str, str]]:
        """Role and text of the turns that end in the piece; placeholders are left out."""
        self.rest += piece
        while found := _SEGMENT.match(self.rest):
            self.rest = self.rest[found.end() :]
            role, content = found.groups()
            yield unescape(role), _texts(content)


def read_conversation(formatted: str) -> list[tuple[str, str]]:
    """Role and text of each turn of a formatted conversation."""
    reader = Reader()
    turns = list(reader.feed(formatted))
    if reader.rest:
        raise ValueError("the output does not end with a turn")
    return turns


def read_segment(segment: str) -> tuple[str, str]:
    """Role and text of a segment."""
    [turn] = read_conversation(segment)
    return turn


def digests(turns: DataFrame) -> DataFrame:
    """Per conversation, read back from the segments: turns, loss text and their digests."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, done = None, None, []

        def closed() -> tuple:
            n, every, chars, loss, size, attached, expanded, reader = state
            if reader.rest:
                raise ValueError("the output does not end with a turn")
            return (now[0], n, every.hexdigest(), chars, loss.hexdigest(), size, attached, expanded)

        def made() -> pa.RecordBatch:
            types = [conv_type, pa.int64(), pa.string(), pa.int64(), pa.string()] + [pa.int64()] * 3
            cols = [pa.array(c, t) for c, t in zip(zip(*done), types)]
            return pa.RecordBatch.from_arrays(cols, NAMES)

        conv_type = None
        for b in batches:
            conv_type = b.column("conv_id").type
            for conv, segment, low, high, attached, expanded in zip(*[c.to_pylist() for c in b.columns]):
                if now is None or now[0] != conv:
                    if now is not None:
                        done.append(closed())
                    now, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0, Reader()]
                for role, text in state[7].feed(segment):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                learnt = _texts(segment[low:high])
                state[2] += len(learnt)
                state[3].update(learnt.encode())
                state[4] += len(segment)
                state[5] += attached
                state[6] += expanded
            if done:
                yield made()
                done = []
        if now is not None:
            done.append(closed())
            yield made()

    rows = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "segment")
    rows = rows.select("conv_id", "segment", "loss_from", "loss_to", F.size("attachments"), "expanded")
    kind = rows.schema["conv_id"].dataType.simpleString()
    return rows.mapInArrow(
        run,
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, n_attachments long, expanded_tokens long",
    )


NAMES = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars",
         "n_attachments", "expanded_tokens"]


def conversations(turns: DataFrame) -> DataFrame:
    """`conv_id` and the formatted conversation as one string, which must fit a row; long
    conversations take `placed_segments`."""
    ordered = F.array_sort(F.collect_list(F.struct("turn", "segment")))
    text = F.array_join(F.transform(ordered, lambda x: x["segment"]), "")
    return turns.groupBy("conv_id").agg(text.alias("formatted"))


def placed_segments(turns: DataFrame) -> DataFrame:
    """The turns, and in `offset` where their segment starts in the formatted conversation.

    Turns are numbers. The sums of blocks of `BLOCK` of them are laid end to end, then the
    segments of each block. One task has a sum for each block of a conversation, and the rows
    of a block, one at a time; no string holds more than a segment.
    """
    length = F.length("segment").cast("long")
    rows = turns.withColumn("_block", F.floor(F.col("turn") / BLOCK))
    blocks = rows.groupBy("conv_id", "_block").agg(F.sum(length).alias("_size"))
    before = Window.partitionBy("conv_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_start", F.coalesce(F.sum("_size").over(before), F.lit(0)))
    order = Window.partitionBy("conv_id", "_block").orderBy("turn", "segment")
    inside = F.sum(length).over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("_inside", F.coalesce(inside, F.lit(0)))
    same = F.col("r.conv_id").eqNullSafe(F.col("b.conv_id")) & F.col("r._block").eqNullSafe(F.col("b._block"))
    offset = (F.col("_start") + F.col("_inside")).alias("offset")
    return rows.alias("r").join(blocks.alias("b"), same).select(*[f"r.`{c}`" for c in turns.columns], offset)
