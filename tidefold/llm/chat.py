"""Training examples from conversations: one for each reply, with all turns before it.

A turn is written as a block, ``### <role>: <text></turn>`` and a line break.  Inside roles
and texts the signs that make up the marks are escaped, so no mark can be read there:
``\\`` is written ``\\\\``, ``#`` is ``\\#`` and ``</`` is ``<\\/`` (in roles ``:`` is ``\\:`` too).

The example of a reply is the blocks of its conversation up to and with its own, and its
loss mask is the reply's text.  Examples of one conversation have all their context in
common, so ``expand`` keeps blocks once, each with its place, and an example names how far
it reaches.  ``written`` writes all examples out, conversation by conversation, to whoever
reads them: they grow with the square of a conversation's length, so they are moved nowhere.
``texts`` writes out those that are asked for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidefold.llm.common import small_slices, stored
from tidefold.llm.turns import dealt

HEAD, COLON, TAIL = "### ", ": ", "</turn>\n"
REPLY = "assistant"
#: Examples are handed on when they hold so many code points.
WRITTEN_CHARS = 2 << 20


def escaped(text: Column, role: bool = False) -> Column:
    for sign, written in (("\\", "\\\\"), ("#", "\\#"), ("</", "<\\/"), *([(":", "\\:")] if role else [])):
        text = F.replace(text, F.lit(sign), F.lit(written))
    return text


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


@dataclass(frozen=True)
class Examples:
    """``blocks``: (conv_id, position, example, begin, block, loss_begin, loss_end), the
    formatted turns; ``example`` is the replies before the block, ``begin`` the code points
    of the conversation before it, and the loss mask is null but for replies.

    ``examples``: (conv_id, example, position, chars, loss_begin, loss_end), one for each
    reply: its number, its reply's position, its length, and the span that is trained, in
    code points from the conversation's begin.
    """

    blocks: DataFrame
    examples: DataFrame


#: Sums along a conversation: code points, turns and replies before each turn.
SUMS = ("begin", "position", "example")


def _running(conv: Column, chars: Column, reply: Column) -> Column:
    """SUMS over the rows before each in its conversation and task.

    Rows must come sorted; only numbers go to Python.
    """

    @F.pandas_udf("begin long, position long, example long")
    def sums(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        now, carried = None, [0, 0, 0]
        for conv, chars, reply in parts:
            keys, n = conv.to_numpy(), len(conv)
            new = np.ones(n, bool)
            new[1:] = keys[1:] != keys[:-1]
            new[:1] = [now != k for k in keys[:1]]
            start = np.maximum.accumulate(np.where(new, np.arange(n), -1))
            out = {}
            columns = (chars.to_numpy(), np.ones(n, np.int64), reply.to_numpy())
            for k, (name, values) in enumerate(zip(SUMS, columns)):
                before = np.cumsum(values) - values
                out[name] = before - np.where(start >= 0, before[start], -carried[k])
                carried[k] = int(out[name][-1] + values[-1]) if n else carried[k]
            now = keys[-1] if n else now
            yield pd.DataFrame(out)

    return sums.asNondeterministic()(conv, chars, reply)


def expand(rows: DataFrame) -> Examples:
    """An example for each assistant turn of the conversations (conv_id, turn, role, text).

    Turns stand by turn, nulls first; ties by role, then text.  Null roles and texts are
    empty, and rows without conv_id are one conversation.  Repeated rows are turns of their
    own.  A conversation without a reply has blocks and no example; an empty table has
    neither.

    Texts are moved once, into order.  Sums along a conversation are made inside each task;
    what a conversation brings along from the tasks before is one row for each task it
    reaches into, and a task has one such conversation at most.
    """
    plain = rows.select(
        "conv_id", "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    reply = F.col("role") == REPLY
    block = F.concat(F.lit(HEAD), escaped(F.col("role"), role=True), F.lit(COLON), escaped(F.col("text")), F.lit(TAIL))
    written = dealt(plain).select(
        "conv_id", block.alias("block"), F.length(block).cast("long").alias("chars"),
        F.when(reply, F.length(escaped(F.col("text")))).cast("long").alias("loss"),
    )
    key = F.concat_ws(":", F.col("conv_id").isNull().cast("string"), F.col("conv_id").cast("string"))
    sums = _running(key, F.col("chars"), F.col("loss").isNotNull().cast("long"))
    table = stored(
        written.select("conv_id", "block", "chars", "loss", sums.alias("sums"), F.spark_partition_id().alias("task")),
        "chat-turns",
    ).withColumn("c", F.struct("conv_id"))
    last = {"begin": F.col("chars"), "position": F.lit(1), "example": F.col("loss").isNotNull().cast("long")}
    totals = table.groupBy("c", "task").agg(*[F.sum(v).alias(n) for n, v in last.items()])
    earlier = Window.partitionBy("c").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    brought = totals.select("c", "task", *[F.sum(n).over(earlier).alias(f"{n}_brought") for n in SUMS])
    # No more rows than there are tasks, whatever the input: safe to broadcast.
    brought = brought.where("position_brought is not null")
    placed = table.join(F.broadcast(brought), ["c", "task"], "left")
    at = {n: F.col(f"sums.{n}") + F.coalesce(f"{n}_brought", F.lit(0)) for n in SUMS}
    end = F.col("begin") + F.col("chars")
    mask_end = F.when(F.col("loss").isNotNull(), end - len(TAIL))
    blocks = placed.select("c.conv_id", *[v.alias(n) for n, v in at.items()], "block", "chars", "loss").select(
        "*", end.alias("end"), mask_end.alias("loss_end"), (mask_end - F.col("loss")).alias("loss_begin")
    )
    return Examples(
        blocks.select("conv_id", "position", "example", "begin", "block", "loss_begin", "loss_end"),
        blocks.where("loss is not null").select(
            "conv_id", "example", "position", F.col("end").alias("chars"), "loss_begin", "loss_end"
        ),
    )


def written(found: Examples) -> DataFrame:
    """(conv_id, example, text, fresh, loss_begin, loss_end): every example written out whole.

    Rows of a conversation stand in order in one task.  ``text`` is all blocks up to and with
    the reply; from ``fresh`` on it is what the example before does not hold.  Blocks behind
    the last reply are in no example: each is a row of its own whose ``example`` is null.  A
    task holds one conversation's text and a few examples; an example must fit a row.
    """
    columns = ["conv_id", "example", "block", "loss_begin", "loss_end"]
    replies = F.when(F.col("loss_begin").isNotNull(), F.col("example")).alias("example")
    dealt = (
        found.blocks.select("conv_id", "position", replies, "block", "loss_begin", "loss_end")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "position")
        .select(*columns)
    )
    names = ["conv_id", "example", "text", "fresh", "loss_begin", "loss_end"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = None
        now: list = []  # the conversation, its text up to the last reply, the blocks since
        out: list[tuple] = []

        def taken():
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
            out.clear()
            return made

        def rest():
            out.extend((now[0], None, block, 0, None, None) for block in (now[2] if now else ()))

        size = 0
        for batch in small_slices(batches, 2):
            types = [batch.schema.field(0).type, pa.int64(), pa.string(), *[pa.int64()] * 3]
            for conv, example, block, begin, end in zip(*(c.to_pylist() for c in batch.columns)):
                if not now or now[0] != conv:
                    rest()
                    now = [conv, "", []]
                now[2].append(block)
                if example is not None:
                    fresh = len(now[1])
                    now[1], now[2] = "".join([now[1], *now[2]]), []
                    out.append((conv, example, now[1], fresh, begin, end))
                    size += len(now[1])
                if size > WRITTEN_CHARS:
                    yield taken()
                    size = 0
        rest()
        if out:
            yield taken()

    kind = found.blocks.schema["conv_id"].dataType.simpleString()
    return dealt.mapInArrow(
        run, f"conv_id {kind}, example bigint, text string, fresh bigint, loss_begin bigint, loss_end bigint"
    )


def texts(found: Examples, wanted: DataFrame | None = None) -> DataFrame:
    """(conv_id, example, text, loss_begin, loss_end) written out; ``wanted`` names some by
    (conv_id, example).  An example is one row, so its text must fit one."""
    names = ["example", "text", "loss_begin", "loss_end"]
    if wanted is None:
        return written(found).where("example is not null").select("conv_id", *names)
    some = found.examples.withColumn("c", F.struct("conv_id"))
    some = some.join(wanted.select(F.struct("conv_id").alias("c"), "example"), ["c", "example"], "left_semi")
    blocks = found.blocks.select(F.struct("conv_id").alias("c"), F.col("position").alias("place"), "block")
    whole = F.array_sort(F.collect_list(F.struct("place", "block")))
    return (
        some.join(blocks, "c")
        .where("place <= position")
        .groupBy("c", "example", "loss_begin", "loss_end")
        .agg(F.array_join(F.transform(whole, lambda b: b["block"]), "").alias("text"))
        .select("c.conv_id", *names)
    )


def read_turns(text: Column) -> Column:
    """The turns of formatted text as structs (role, text); the inverse of the template."""
    pattern = r"(?s)### (?:[^\\:]++|\\.)*+: (?:[^\\<]++|\\.|<(?!/))*+</turn>\n"
    role = r"(?s)^### ((?:[^\\:]++|\\.)*+): "
    return F.transform(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda b: F.struct(
            unescaped(F.regexp_extract(b, role, 1)).alias("role"),
            unescaped(F.regexp_replace(F.regexp_replace(b, role, ""), r"</turn>\n$", "")).alias("text"),
        ),
    )


def digests(found: Examples) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_examples),
    read back from the examples as they are written out."""
    return read_back(written(found))


def read_back(rows: DataFrame) -> DataFrame:
    """``digests`` of the rows of ``written``, which stand in their order.

    Each turn is read from the first example that holds it, trained text from each example's
    loss mask.  A digest is one sequence of bytes, so a conversation is read in order by one
    task, row by row.
    """
    span = F.substr("text", (F.col("loss_begin") + 1).cast("int"), (F.col("loss_end") - F.col("loss_begin")).cast("int"))
    fresh = F.substr("text", (F.col("fresh") + 1).cast("int"), F.length("text"))
    read = rows.select(
        "conv_id", read_turns(fresh).alias("turns"), unescaped(span).alias("loss"),
        F.length("text").cast("long").alias("chars"), F.col("example").isNotNull().alias("is_example"),
    )
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = read.select("conv_id", F.size("turns").alias("n"), F.array_join(said, "").alias("turns"), "loss", "chars", "is_example")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_examples"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out, key_type = None, [], None

        def done():
            conv, n, turns, chars, loss, size, examples = now
            out.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), size, examples))

        def taken():
            types = [key_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

        for batch in small_slices(batches, 2):
            key_type = batch.schema.field(0).type
            for conv, n, turns, loss, chars, is_example in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or now[0] != conv:
                    if now is not None:
                        done()
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                now[1] += n
                now[2].update(turns.encode())
                if loss is not None:
                    now[3] += len(loss)
                    now[4].update(loss.encode())
                now[5] += chars
                now[6] += is_example
            if out:
                yield taken()
                out = []
        if now is not None:
            done()
            yield taken()

    return read.mapInArrow(
        run,
        f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, n_turns bigint, turns_sha256 string, "
        "loss_chars bigint, loss_sha256 string, formatted_chars bigint, n_examples bigint",
    )


#: A conversation that says what the template itself says.
CONTROL = r"\### Assistant: </turn> ok"


def op12_chat(spark, sf_dir: str) -> DataFrame:
    """``formatted_chars`` counts all examples written out, and blocks that no example holds."""
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"
    )
    control = spark.createDataFrame([(-7, 0, "user", CONTROL), (-7, 1, REPLY, CONTROL)], given.schema)
    return digests(expand(given.unionByName(control)))


ORACLE = r"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e as (
  select *, row_number() over () as r,
    length(replace(replace(replace(replace(role, '\', '\\'), '#', '\#'), '</', '<\/'), ':', '\:'))
    + length(replace(replace(replace(text, '\', '\\'), '#', '\#'), '</', '<\/')) + 14 as chars
  from t),
s as (
  select *, sum(chars) over (partition by conv_id order by turn nulls first, role, text, r) as reach
  from e)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  cast(coalesce(sum(reach) filter (role = 'assistant'), 0) + sum(chars)
    - coalesce(max(reach) filter (role = 'assistant'), 0) as bigint) as formatted_chars,
  count(*) filter (role = 'assistant') as n_examples
from s group by conv_id
"""
