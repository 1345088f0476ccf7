"""Dump statements where strings may hold ``;`` at the end of a line.

Whether a line ends a statement depends on whether it ends inside a string, a quoted name or
a comment that began lines, or blocks, before.  So each line is turned into a function: the
state it ends in for each state it can begin in.  These functions are composed along chunks
of lines, along the chunks of a block and along the blocks of a file, one short row each;
that gives every chunk the state it begins in, and every line its statement.  Then lines are
put together.  No task reads a file from its beginning, and files may have different ends
of lines.

The files are read twice.  Lines are named by their place in the read, so both must be cut
alike: read within ``dump_text.pinned_splits``.  A line that has no partner in the other read
fails the job.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# States: in no quotes, in each kind of quotes, and in a comment of several lines.
OUT, SINGLE, DOUBLE, NAME, COMMENT = range(5)
STATES = range(5)

# Possessive quantifiers keep the matcher iterative, so lines of many megabytes pass.
_INSIDE = {
    SINGLE: r"(?:[^'\\]++|\\.)*+'",
    DOUBLE: r'(?:[^"\\]++|\\.)*+"',
    NAME: r"[^`]*+`",
    COMMENT: r"(?:[^*]++|\*(?!/))*+\*/",
}
_OPEN = {SINGLE: "'", DOUBLE: '"', NAME: "`", COMMENT: r"/\*"}
_REST = r"--(?=[ \t\r]|$).*+"
# All of a line that is whole: text outside of quotes, quoted parts, comments.
_WHOLE = (
    r"(?s)^(?:[^'\"`/\-]++|"
    + "|".join(_OPEN[s] + _INSIDE[s] for s in _INSIDE)
    + rf"|{_REST}|/(?!\*)|-(?!-(?:[ \t\r]|$)))*+"
)

#: Lines in one chunk at most, and members of a list that are gone through at once.
CHUNK, RUN = 4096, 64


def _from_out(text: Column) -> Column:
    """The state a text ends in that begins outside of quotes."""
    left = F.regexp_replace(text, _WHOLE, "")
    first = F.substr(left, F.lit(1), F.lit(1))
    return (
        F.when(left == "", OUT).when(first == "'", SINGLE).when(first == '"', DOUBLE).when(first == "`", NAME)
        .otherwise(COMMENT)
    )


def line_states(value: Column) -> Column:
    """The state a line ends in for each of STATES it can begin in."""

    def after(state: int) -> Column:
        if state == OUT:
            return _from_out(value)
        closed = rf"(?s)^{_INSIDE[state]}"
        # A line without the sign that ends the state, such as most, stays in it.
        sign = {SINGLE: "'", DOUBLE: '"', NAME: "`", COMMENT: "*/"}[state]
        shut = F.contains(value, F.lit(sign)) & value.rlike(closed)
        return F.when(shut, _from_out(F.regexp_replace(value, closed, ""))).otherwise(state)

    return F.array(*[after(s) for s in STATES])


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.option("lineSep", "\n")
        .option("recursiveFileLookup", "true")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("ord"),
            "value",
        )
    )


def _composed(rows: Column) -> Column:
    """One struct (to, ends) for a list of such: where each state leads, and how many
    statements end on the way."""

    def along(state: int) -> Column:
        start = F.struct(F.lit(state).alias("at"), F.lit(0).cast("long").alias("ends"))
        return F.aggregate(
            rows,
            start,
            lambda acc, row: F.struct(
                F.get(row["to"], acc["at"]).alias("at"), (acc["ends"] + F.get(row["ends"], acc["at"])).alias("ends")
            ),
        )

    all_states = F.array(*[along(s) for s in STATES])
    return F.struct(
        F.transform(all_states, lambda x: x["at"]).alias("to"), F.transform(all_states, lambda x: x["ends"]).alias("ends")
    )


def _begins(rows: Column, first: Column) -> Column:
    """For a list of structs (to, ends) the state and number each begins with, given the first.

    A list that grows is copied with each member, so it is made of runs of RUN members.
    """

    def step(now: Column, row: Column) -> Column:
        return F.struct(
            F.get(row["to"], now["at"]).alias("at"), (now["ends"] + F.get(row["ends"], now["at"])).alias("ends")
        )

    def before(items: Column, start: Column, after: Callable[[Column, Column], Column]) -> Column:
        none = F.array().cast("array<struct<at: int, ends: bigint>>")
        return F.aggregate(
            items,
            F.struct(start.alias("now"), none.alias("seen")),
            lambda acc, item: F.struct(
                after(acc["now"], item).alias("now"), F.concat(acc["seen"], F.array(acc["now"])).alias("seen")
            ),
            lambda acc: acc["seen"],
        )

    last = F.floor((F.size(rows) - 1) / RUN).cast("int")
    runs = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(rows, k * RUN + 1, RUN))
    starts = before(runs, first, lambda now, run: F.aggregate(run, now, step))
    return F.flatten(F.zip_with(runs, starts, lambda run, start: before(run, start, step)))


def _gathered(rows: DataFrame, group: list[str], order: str, function: str) -> DataFrame:
    listed = F.array_sort(F.collect_list(F.struct(order, F.col(function).alias("f"))))
    return rows.groupBy(*group).agg(listed.alias("of"))


def statement_numbers(lines: DataFrame) -> DataFrame:
    """(file, block, ord, statement): which statement of its file each line belongs to."""
    states = line_states(F.col("value"))
    ending = F.col("value").rlike(r";[ \t\r]*$") & ~F.col("value").rlike(r"^[ \t]*--(?:[ \t\r]|$)")
    told = lines.select("file", "block", "ord", states.alias("to"), ending.alias("ending"))
    ends = F.transform("to", lambda s: F.when(F.col("ending") & (s == OUT), F.lit(1)).otherwise(F.lit(0)).cast("long"))
    told = told.withColumn("f", F.struct("to", ends.alias("ends"))).withColumn("chunk", F.floor(F.col("ord") / CHUNK))

    functions = lambda of: F.transform(of, lambda x: x["f"])
    chunks = _gathered(told, ["file", "block", "chunk"], "ord", "f")
    chunks = chunks.withColumn("g", _composed(functions("of")))
    blocks = _gathered(chunks, ["file", "block"], "chunk", "g").withColumn("h", _composed(functions("of")))
    # One short row for each block of a file.
    files = _gathered(blocks, ["file"], "block", "h")
    none = F.struct(F.lit(OUT).alias("at"), F.lit(0).cast("long").alias("ends"))

    def spread(rows: DataFrame, first: Column, group: list[str], name: str) -> DataFrame:
        """The beginning of each member of ``of``."""
        pairs = F.arrays_zip("of", _begins(functions("of"), first).alias("begin"))
        return rows.select(*group, F.explode(pairs).alias("p")).select(
            *group, F.col(f"p.of.{name}").alias(name), F.col("p.begin").alias("first")
        )

    of_blocks = spread(files, none, ["file"], "block")
    of_chunks = spread(blocks.join(of_blocks, ["file", "block"]), F.col("first"), ["file", "block"], "chunk")
    of_lines = spread(
        chunks.join(of_chunks, ["file", "block", "chunk"]), F.col("first"), ["file", "block"], "ord"
    )
    return of_lines.select("file", "block", "ord", F.col("first.ends").alias("statement"))


def read_quoted(spark: SparkSession, path: str) -> DataFrame:
    """Statements of the dump files below ``path`` as ``dump_text.read_statements`` gives them,
    one per row, cut only where ``;`` ends a line outside of quotes and comments.

    ``block`` and ``ord`` are those of a statement's first line.  A statement is put together
    in one task, so it must fit one; nothing else does.
    """
    numbered = statement_numbers(_lines(spark, path))
    lost = F.raise_error(F.lit("the files were cut differently while they were read")).cast("bigint")
    joined = _lines(spark, path).join(numbered, ["file", "block", "ord"], "full_outer").select(
        "file", "block", "ord",
        F.when(F.col("value").isNull() | F.col("statement").isNull(), lost).otherwise(F.col("statement")).alias("statement"),
        "value",
    )
    whole = F.array_sort(F.collect_list(F.struct("block", "ord", "value")))
    text = F.array_join(F.transform("lines", lambda x: x["value"]), "\n")
    return (
        joined.groupBy("file", "statement")
        .agg(whole.alias("lines"))
        .select(
            "file",
            F.col("lines")[0]["block"].alias("block"),
            F.col("lines")[0]["ord"].alias("ord"),
            F.lit(0).alias("part"),
            F.regexp_replace(text, r";[ \t\r]*$", "").alias("value"),
        )
    )
