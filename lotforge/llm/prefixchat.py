"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it as context, and its reply
as the only text under the loss mask. A turn is written as

    <turn ROLE>TEXT</turn> and a line feed

where each of the characters \\ < > of a role or a text has a backslash before it, so that no text
can hold a marker, and taking the backslashes away again gives the text back.

`expand` writes every example out: its text is the whole prefix and the target. Contexts of one
conversation are prefixes of each other, so the texts grow with the square of its turns. They are
therefore made in tasks from the turns in order, with one prefix and a few megabytes of examples in
memory, and never shuffled: `digests` cuts from every text the turns that no earlier example of the
conversation ends with, and only those are dealt by conversation.

A conversation that does not end with an assistant turn gets one more example over all its turns
with an empty mask, so that nothing is lost in the formatted output. Places and offsets are summed
within blocks of turn numbers and then over blocks, so a conversation with a third of all turns is
dealt over many tasks.

Turns are ordered by turn, nulls first; ties by role and text; repeated rows are separate turns. A
null text or role is the empty one. Rows without a conv_id are one conversation. An empty table
gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TRAINED = "assistant"
#: Turn numbers in a block, as a power of two.
_BLOCK = 8
#: Characters of examples that a task holds before it passes them on.
_HELD = 4_000_000
_END = "</turn>\n"
_TURN = re.compile(r"<turn ((?:\\.|[^\\<>])*)>((?:\\.|[^\\<>])*)</turn>\n", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<>])", r"\\$1")


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def segments(conversations: DataFrame) -> DataFrame:
    """One row per turn: conv_id, place (from 0), segment (the formatted turn), start (code points
    of the stream before it) and, where the turn ends an example, its number from 0, the loss
    mask loss_start to loss_end in the example's text, and that text's length n_chars."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit("<turn "), escaped(role), F.lit(">"))
    rows = conversations.select(
        "conv_id",
        "turn",
        F.shiftright("turn", _BLOCK).alias("block"),
        role.alias("role"),
        text.alias("text"),
        F.length(head).cast("long").alias("head"),
        F.concat(head, escaped(text), F.lit("</turn>\n")).alias("segment"),
    )
    rows = rows.withColumn("chars", F.length("segment").cast("long"))
    trained = F.when(F.col("role") == TRAINED, 1).otherwise(0)
    blocks = rows.groupBy("conv_id", "block").agg(
        F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"), F.sum(trained).alias("trained")
    )
    along = Window.partitionBy("conv_id").orderBy(F.col("block").asc_nulls_first())
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        F.col("conv_id").alias("_conv"),
        F.col("block").alias("_block"),
        F.col("n").alias("_n"),
        F.lead("n").over(along).isNull().alias("_final"),
        *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_{c}_before") for c in ("n", "chars", "trained")),
    )
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    inside = Window.partitionBy("conv_id", "block").orderBy(*order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select(
        "conv_id",
        "block",
        "head",
        "segment",
        "chars",
        trained.alias("trained"),
        F.row_number().over(inside).alias("number"),
        F.coalesce(F.sum("chars").over(so_far), F.lit(0)).alias("start"),
        F.coalesce(F.sum(trained).over(so_far), F.lit(0)).alias("example"),
    )
    here = F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("block").eqNullSafe(F.col("_block"))
    placed = rows.join(blocks, here)
    start = F.col("start") + F.col("_chars_before")
    body = start + F.col("head")
    end = start + F.col("chars")
    reply = F.col("trained") == 1
    ends = reply | (F.col("_final") & (F.col("number") == F.col("_n")))
    return placed.select(
        "conv_id",
        (F.col("number") - 1 + F.col("_n_before")).alias("place"),
        "segment",
        start.alias("start"),
        F.when(ends, F.col("example") + F.col("_trained_before")).alias("example"),
        F.when(ends, F.when(reply, body).otherwise(end)).alias("loss_start"),
        F.when(ends, F.when(reply, end - len("</turn>\n")).otherwise(end)).alias("loss_end"),
        F.when(ends, end).alias("n_chars"),
    )


EXAMPLE = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("example", pa.int64()),
        ("text", pa.string()),
        ("loss_start", pa.int64()),
        ("loss_end", pa.int64()),
        ("n_chars", pa.int64()),
    ]
)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def _written_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Examples of turns that come in order, conversation by conversation."""
    names = ("place", "segment", "conv_id", "example", "loss_start", "loss_end", "n_chars")
    prefix, done, held = "", [], 0
    for batch in batches:
        for place, segment, conv_id, example, *spans in zip(*(batch.column(c).to_pylist() for c in names)):
            prefix = prefix + segment if place else segment
            if example is None:
                continue
            done.append((conv_id, example, prefix, *spans))
            held += len(prefix)
            if held > _HELD:
                yield _batch(done, EXAMPLE)
                done, held = [], 0
    if done:
        yield _batch(done, EXAMPLE)


def expand(conversations: DataFrame) -> DataFrame:
    """One row per example: conv_id, example (from 0), text (all turns before, and the target), the
    loss mask loss_start to loss_end in it, and its length n_chars."""
    ordered = segments(conversations).repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return ordered.mapInArrow(
        _written_out, "conv_id long, example long, text string, loss_start long, loss_end long, n_chars long"
    )


def texts(expanded: DataFrame) -> DataFrame:
    """Flat examples: conv_id, example, text, loss_start, loss_end."""
    return expanded.select("conv_id", "example", "text", "loss_start", "loss_end")


class _Digest:
    """What is read back from the examples of one conversation, in order."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.turns, self.examples, self.loss, self.formatted = conv_id, 0, 0, 0, 0
        self.all, self.masked = hashlib.sha256(), hashlib.sha256()

    def add(self, tail: str, masked: str, chars: int) -> None:
        at = 0
        while at < len(tail):
            written = _TURN.match(tail, at)
            at = written.end()
            self.turns += 1
            self.all.update("".join(unescaped(x) + "\n" for x in written.groups()).encode())
        self.examples += 1
        self.formatted += chars
        masked = unescaped(masked)
        self.loss += len(masked)
        self.masked.update(masked.encode())

    def row(self) -> tuple:
        return (self.conv_id, self.turns, self.all.hexdigest(), self.loss, self.masked.hexdigest(), self.formatted, self.examples)


DIGEST = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
        ("n_examples", pa.int64()),
    ]
)


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("conv_id", "tail", "masked", "n_chars")
    open_ = None
    for batch in batches:
        done = []
        for conv_id, *example in zip(*(batch.column(c).to_pylist() for c in names)):
            if open_ is None or open_.conv_id != conv_id:
                done += [open_.row()] if open_ else []
                open_ = _Digest(conv_id)
            open_.add(*example)
        if done:
            yield _batch(done, DIGEST)
    if open_:
        yield _batch([open_.row()], DIGEST)


def _tail() -> Column:
    """The turns of an example's text after the last earlier target of its conversation.

    No text or role holds a bare < or >, so a line feed and a whole opening mark are a turn's start.
    """
    lined = F.concat(F.lit("\n"), F.col("text"))
    mark = f"'\\n<turn {TRAINED}>'"
    rest = F.expr(f"substring_index('\\n' || text, {mark}, if(loss_end < n_chars, -2, -1))")
    after = F.substring_index(rest, _END, 1)
    beyond = F.substr(rest, F.length(after) + len(_END) + 1)
    return F.when(F.length(rest) == F.length(lined), F.col("text")).otherwise(beyond)


def digests(expanded: DataFrame) -> DataFrame:
    """One row per conversation, read back from the texts of its examples: number of turns, hash of
    all roles and texts, length and hash of all text under the loss masks, length of all examples.

    The turns of a conversation stream through one task in order, because a hash over all of them
    can't be made in parts; no more than a batch of them is in memory."""
    masked = F.substr(F.col("text"), F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))
    parts = expanded.select("conv_id", "example", _tail().alias("tail"), masked.alias("masked"), F.length("text").cast("long").alias("n_chars"))
    ordered = parts.repartition("conv_id").sortWithinPartitions("conv_id", "example")
    return ordered.mapInArrow(
        _read_back,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_examples long",
    )
