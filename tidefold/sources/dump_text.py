"""SQL dump text: reading statements, columns and log coordinates, and writing dumps.

A dump is a set of text files.  Statements end with ``;`` at the end of a line,
which is also where Spark may split a file, so a dump of any size is read by
many tasks.  Only the statement shapes that dump tools write are understood; an
INSERT with anything else in it, or cut off, is reported and never half read.
"""

from __future__ import annotations

from collections.abc import Collection, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefold.functions.keys import render_pk
from tidefold.functions.literals import FIELD, STRING, TUPLE, read_literals, typed, written
from tidefold.functions.types import DATES, ZERO_DATE, spark_type
from tidefold.model import Column, Position

# The coordinate comment of a dump header.
COORDINATES = r"MASTER_LOG_FILE='(.*)', MASTER_LOG_POS=(\d+)"
# End of fixed values.

# Columns that order the statements of a file.
_ORDER = ("block", "ord", "part")

_NAME = r"`((?:[^`]++|``)++)`"
# Stands for a tuple that was read.
_TUPLE_MARK = "\x01"
# Comment and blank lines in front of a statement.
_PREAMBLE = r"(?s)^(?:\s++|--[^\n]*+(?:\n|$)|/\*.*?\*/;?)*+"
# One entry of a column list: up to a comma outside quotes and parentheses.
_NESTED = rf"\((?:{STRING}|[^()']++|\((?:{STRING}|[^()']++)*+\))*+\)"
_ENTRY = rf"(?s)((?:{STRING}|`(?:[^`]++|``)++`|{_NESTED}|[^,()'`]++)++)"
_PRIMARY_KEY = r"(?s)^\s*(?:CONSTRAINT\s+(?:`[^`]*`\s+)?)?PRIMARY KEY[^(]*\((.*)\)"
_DECLARED = rf"(?s)^\s*{_NAME}\s+(\w+(?:\((?:{STRING}|[^()'])*+\))?(?: unsigned)?)"


def line_end_of(spark: SparkSession, path: str) -> str:
    """The line end of a dump, told by its first line that is read."""
    files = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(path)
    first = files.select(F.endswith("value", F.lit("\r")).alias("cr")).take(1)
    return "\r\n" if first and first[0]["cr"] else "\n"


def read_statements(
    spark: SparkSession,
    path: str | list[str],
    line_end: str | None = None,
    more: Mapping[str, SparkColumn] | None = None,
) -> DataFrame:
    """Statements of the dump files below ``path``, one per row, as written.

    ``file``, ``block``, ``ord`` and ``part`` order them: a block is read by one task
    from its start to its end.  Files are split between statements, at ``;`` and the
    line end, which is looked up if it is not given.  What still stands together,
    because of blanks after ``;`` or of mixed line ends, is cut in a second step, so
    it is right but split no further between tasks.  ``more`` adds columns made of the
    file's metadata.
    """
    line_end = line_end or line_end_of(spark, path)
    several = F.split("value", r";[ \t\r]*(?:\n|$)")
    return (
        spark.read.option("lineSep", f";{line_end}")
        .option("recursiveFileLookup", "true")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("ord"),
            *[value.alias(name) for name, value in (more or {}).items()],
            F.posexplode(
                F.when(F.contains("value", F.lit(";")), several).otherwise(F.array("value"))
            ).alias("part", "value"),
        )
    )


#: Bytes of a split of a dump, by which a load can be resumed.
SPLIT_BYTES = 128 << 20


@contextmanager
def pinned_splits(spark: SparkSession, split_bytes: int) -> Iterator[None]:
    """Within it, files are cut every ``split_bytes``, whatever cores and files there are.

    Spark otherwise chooses the size from both, and a load that goes on with other executors
    would not find the splits of the first one.
    """
    pinned = {"spark.sql.files.maxPartitionBytes": str(split_bytes), "spark.sql.files.minPartitionNum": "1"}
    before = {name: spark.conf.get(name, None) for name in pinned}
    for name, value in pinned.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def _split_name(block: SparkColumn, split_bytes: int) -> SparkColumn:
    """A split by the file it is of, as that is now, and where it begins there."""
    file = F.xxhash64(
        "_metadata.file_path", "_metadata.file_size",
        F.unix_micros(F.col("_metadata.file_modification_time").cast("timestamp")), F.lit(split_bytes),
    )
    return F.concat_ws("-", F.lower(F.hex(file)), block.cast("string"))


def list_splits(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(split, path, size): the splits of a dump's files, listed without reading them.

    Names change when a file does, so what was read of a file that has been replaced since
    is read again.
    """
    size = F.col("_metadata.file_size")
    begins = F.sequence(F.lit(0).cast("long"), F.greatest(size - 1, F.lit(0)), F.lit(split_bytes).cast("long"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    listed = files.select("path", size.alias("file_size"), "_metadata", F.explode(begins).alias("block"))
    return listed.select(
        _split_name(F.col("block"), split_bytes).alias("split"),
        "path",
        F.least(F.lit(split_bytes), F.col("file_size") - F.col("block")).alias("size"),
    )


def read_splits(
    spark: SparkSession, path: str, finished: Collection[str], split_bytes: int = SPLIT_BYTES
) -> DataFrame:
    """Statements of the splits that are not ``finished``, with their ``split``.

    Files that are finished whole are not opened.  Of other files, statements of finished
    splits are left out before anything is parsed.  Read it within ``pinned_splits``.
    """
    line_end = line_end_of(spark, path)
    listed = list_splits(spark, path, split_bytes)
    done = spark.createDataFrame([(f,) for f in sorted(finished)], "split string")
    open_files = [r["path"] for r in listed.join(done, "split", "left_anti").select("path").distinct().collect()]
    if not open_files:
        return read_statements(spark, path, line_end).withColumn("split", F.lit("")).limit(0)
    name = _split_name(F.col("_metadata.file_block_start"), split_bytes)
    statements = read_statements(spark, open_files, line_end, {"split": name})
    # The finished are few and short beside the texts; they are broadcast where they are.
    return statements.join(done, "split", "left_anti") if finished else statements


def _starting(statements: DataFrame, words: str) -> DataFrame:
    """Statements that start with some words, without comments before them.

    Nearly all text of a dump is in statements that have none; those are taken as
    they are, without a regular expression over them.
    """
    plain = F.startswith("value", F.lit(words))
    bare = F.when(plain, F.col("value")).otherwise(F.regexp_replace("value", _PREAMBLE, ""))
    # Text without the words cannot start with them, and needs no second look.
    hopeful = statements.where(plain | F.contains("value", F.lit(words)))
    return hopeful.withColumn("value", bare).where(F.startswith("value", F.lit(words)))


def insert_tuples(statements: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per value tuple of the INSERT statements: table, literals.

    A statement that is not a header and tuples between commas from its first to its
    last character gives one row instead, without literals: ``unread`` is its text.
    """
    header = rf"(?s)^INSERT INTO {_NAME}\s*(?:\([^)]*\)\s*)?VALUES\s*"
    read = _starting(statements, "INSERT INTO").withColumn(
        "_header", F.regexp_extract("value", header, 0)
    )
    # With a mark for each tuple, the rest must be a list of marks.
    rest = F.regexp_replace(F.substr("value", F.length("_header") + 1), TUPLE, _TUPLE_MARK)
    listed = F.replace(F.regexp_replace("_rest", r"\s++|;\s*+$", ""), F.lit("," + _TUPLE_MARK), F.lit(""))
    read = read.withColumn("_rest", rest).withColumn(
        "_whole", (F.col("_header") != "") & (listed == _TUPLE_MARK)
    )
    tuples = F.regexp_extract_all(F.substr("value", F.length("_header") + 1), F.lit(TUPLE))
    return read.select(
        *keep,
        F.replace(F.regexp_extract("_header", header, 1), F.lit("``"), F.lit("`")).alias("tbl"),
        F.explode(F.when(F.col("_whole"), tuples).otherwise(F.array("value"))).alias("row"),
        "_whole",
    ).select(
        *keep,
        "tbl",
        F.when(
            F.col("_whole"),
            F.regexp_extract_all(F.substr("row", F.lit(2), F.length("row") - 2), F.lit(FIELD)),
        ).alias("literals"),
        F.when(~F.col("_whole"), F.col("row")).alias("unread"),
    )


def dump_rejects(statements: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """INSERT statements that cannot be read whole: table (empty if unknown) and text."""
    return insert_tuples(statements, keep).where("unread is not null").select(*keep, "tbl", "unread")


def dump_rows(statements: DataFrame, columns: Sequence[Column], keep: Sequence[str] = ()) -> DataFrame:
    """Typed rows of a dump, bound to ``columns`` by position.

    ``_id`` is the rendered key; ``_bad`` names the columns whose literal does not
    fit the declared type, and holds ``*`` when the tuple has values at unknown
    positions, or ``INSERT`` when the row stands for a statement that cannot be read
    whole.  Good rows have an empty ``_bad``; nothing is dropped here.  ``keep`` names columns
    of the statements to keep, which the table must not have.
    """
    ordered = sorted(columns, key=lambda c: c.position)
    key = [c.name for c in ordered if c.is_in_primary_key]
    slot = {c.name: f"_{c.position}" for c in ordered}
    read = read_literals(
        insert_tuples(statements, keep),
        {slot[c.name]: F.get("literals", F.lit(c.position)) for c in ordered},
    ).withColumns({f"{slot[c.name]}_v": typed(slot[c.name], spark_type(c.type)) for c in ordered})
    def misfit(c: Column) -> SparkColumn:
        text = F.col(f"{slot[c.name]}_text")
        lost = F.col(f"{slot[c.name]}_v").isNull() & text.isNotNull()
        return lost & ~text.rlike(ZERO_DATE) if isinstance(spark_type(c.type), DATES) else lost

    failed = [F.when(misfit(c), c.name) for c in ordered]
    too_wide = F.when(F.size("literals") > len(ordered), "*")
    unread = F.when(F.col("unread").isNotNull(), "INSERT")
    row = F.struct(
        *keep,
        *[F.col(f"{slot[c.name]}_v").alias(c.name) for c in ordered],
        F.array_compact(F.array(*failed, too_wide, unread)).alias("_bad"),
    )
    # Inlining a one-element array keeps a later filter on _bad above the parsing,
    # where it reads the result instead of repeating the work.
    rows = read.select(F.inline(F.array(row)))
    return rows.withColumn("_id", render_pk(rows, key) if key else F.lit(""))


def dump_columns(statements: DataFrame, file: str = "file") -> DataFrame:
    """Columns of the first CREATE TABLE of each file, with primary-key flags.

    Only a table-level PRIMARY KEY counts, and its names match exactly.
    """
    order = F.struct(*[c for c in _ORDER if c in statements.columns])
    first = (
        _starting(statements, "CREATE TABLE")
        .groupBy(file)
        .agg(F.min_by("value", order).alias("value"))
    )
    opening = rf"(?s)^CREATE TABLE (?:IF NOT EXISTS )?{_NAME}\s*\("
    entries = F.regexp_extract_all(F.regexp_replace("value", opening, ""), F.lit(_ENTRY))
    keys = F.transform(
        F.filter("entries", lambda e: e.rlike(_PRIMARY_KEY)),
        lambda e: F.regexp_extract_all(F.regexp_extract(e, _PRIMARY_KEY, 1), F.lit(_NAME)),
    )
    plain = lambda name: F.replace(name, F.lit("``"), F.lit("`"))
    return (
        first.select(
            file,
            plain(F.regexp_extract("value", opening, 1)).alias("tbl"),
            entries.alias("entries"),
        )
        .select(
            file,
            "tbl",
            F.coalesce(F.get(keys, F.lit(0)), F.array().cast("array<string>")).alias("keys"),
            F.posexplode(F.filter("entries", lambda e: e.rlike(_DECLARED))).alias(
                "position", "entry"
            ),
        )
        .select(
            file,
            "tbl",
            plain(F.regexp_extract("entry", _DECLARED, 1)).alias("name"),
            F.regexp_extract("entry", _DECLARED, 2).alias("type"),
            "position",
            F.array_contains("keys", F.regexp_extract("entry", _DECLARED, 1)).alias(
                "is_in_primary_key"
            ),
        )
    )


def dump_position(statements: DataFrame, file: str = "file") -> DataFrame:
    """Log coordinate of each file: its first line that carries one.

    A file without one keeps a null coordinate.  An offset beyond 64 bits fails the job.
    """
    order = F.struct(*[c for c in _ORDER if c in statements.columns])
    found = F.col("value").rlike(COORDINATES)
    offset = F.regexp_extract("value", COORDINATES, 2)
    offset = F.when(found, offset).cast("bigint")
    hit = F.struct(
        order.alias("ord"),
        F.regexp_extract("value", COORDINATES, 1).alias("logfile"),
        offset.alias("logpos"),
    )
    return (
        statements.groupBy(file)
        .agg(F.min(F.when(found, hit)).alias("hit"))
        .select(
            file,
            F.when(F.col("hit.logpos").isNotNull(), F.col("hit.logfile")).alias("logfile"),
            F.col("hit.logpos").alias("logpos"),
        )
    )


def head_position(statements: DataFrame) -> Position:
    """The coordinate of a single table's dump.

    The search stops at the first task that finds one, normally the one that
    reads the head of the file.
    """
    found = statements.where(F.col("value").rlike(COORDINATES)).select("file", *[c for c in _ORDER if c in statements.columns], "value")
    head = dump_position(_only(found)).first()
    if head is None or head["logpos"] is None:
        raise ValueError("the dump names no log position")
    return Position(head["logfile"], head["logpos"])


def head_columns(statements: DataFrame) -> list[Column]:
    """The columns of a single table's dump, searched for in the same way."""
    found = dump_columns(_only(_starting(statements, "CREATE TABLE"))).drop("file", "tbl")
    # Bounded by the number of columns a table may have.
    columns = [Column(**r.asDict()) for r in found.orderBy("position").collect()]
    if not columns:
        raise ValueError("the dump describes no table")
    if any("enum" in c.type.lower() for c in columns):
        raise ValueError("columns of an enum type cannot be loaded")
    return columns


def _only(statements: DataFrame) -> DataFrame:
    """The first row, fetched alone: one statement's text."""
    return statements.sparkSession.createDataFrame(statements.take(1), statements.schema)


def require_good(rows: DataFrame) -> DataFrame:
    """Rows of ``dump_rows``; the job that reads them fails at a misfit.  The check
    is part of that job, so the dump is parsed once."""
    message = F.concat(F.lit("values do not fit: "), F.array_join("_bad", ", "))
    failure = F.raise_error(message).cast("boolean")
    return rows.where(F.when(F.size("_bad") == 0, True).otherwise(failure)).drop("_bad")


def insert_statements(table: DataFrame, name: str, statement_id: SparkColumn, order: str) -> DataFrame:
    """INSERT statements for a table's rows, one per ``statement_id``.

    The caller picks ``statement_id`` so that a statement holds a bounded number
    of rows, as dump tools do.
    """
    fields = [written(f.name, f.dataType) for f in table.schema.fields]
    row = F.concat(F.lit("("), F.concat_ws(",", *fields), F.lit(")"))
    gathered = F.array_sort(F.collect_list(F.struct(F.col(order).alias("k"), row.alias("row"))))
    return table.groupBy(statement_id.alias("statement")).agg(gathered.alias("rows")).select(
        F.concat(
            F.lit(f"INSERT INTO `{name}` VALUES "),
            F.array_join(F.transform("rows", lambda r: r["row"]), ","),
            F.lit(";"),
        ).alias("value")
    )


def create_statement(name: str, columns: Sequence[Column]) -> str:
    """CREATE TABLE text for a list of columns."""
    ordered = sorted(columns, key=lambda c: c.position)
    lines = [f"  `{c.name}` {c.type} DEFAULT NULL" for c in ordered]
    key = ",".join(f"`{c.name}`" for c in ordered if c.is_in_primary_key)
    if key:
        lines.append(f"  PRIMARY KEY ({key})")
    return f"CREATE TABLE `{name}` (\n" + ",\n".join(lines) + "\n) ENGINE=InnoDB;"
