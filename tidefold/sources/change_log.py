"""Change logs kept as files: batch reads, bounded reads and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefold.functions.positions import after, until
from tidefold.model import Position


def write_change_log(changes: DataFrame, path: str, by_file: bool = True) -> None:
    """Append changes as parquet.

    ``by_file`` keeps one folder per log file, so that a start or end position
    prunes whole folders; the rebalance hint keeps files of even size although log
    files differ.  Otherwise files hold ranges of positions, which suits many
    small logs.
    """
    if by_file:
        changes.hint("rebalance", "logfile").write.mode("append").partitionBy("logfile").parquet(path)
    else:
        changes.repartitionByRange("logfile", "logpos").write.mode("append").parquet(path)


def bounded(
    changes: DataFrame, start: Position | None = None, end: Position | None = None
) -> DataFrame:
    """Changes in (start, end]; works on a batch and on a stream."""
    if start is not None:
        changes = changes.where(after(start))
    if end is not None:
        changes = changes.where(until(end))
    return changes


#: Column for the text of a line that is not an event, beside the file it stands in.
BROKEN = "_broken"


def _reader(reader, schema: T.StructType, fmt: str, quarantine: bool):
    """Text formats may keep broken lines in a column; else the first one fails the job."""
    if quarantine and fmt in ("json", "csv"):
        whole = T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())])
        return reader.schema(whole).format(fmt).option("mode", "PERMISSIVE").option(
            "columnNameOfCorruptRecord", BROKEN
        )
    return reader.schema(schema).format(fmt).option("mode", "FAILFAST")


def _kept(events: DataFrame, quarantine: bool, fmt: str, start: Position | None, end: Position | None):
    """Events within the bounds; broken lines have no position and are always kept, with
    their place: the file and the block they were read from."""
    if not (quarantine and fmt in ("json", "csv")):
        events = bounded(events, start, end)
        return events.withColumns({n: F.lit(None).cast(t) for n, t in PLACE.items()}) if quarantine else events
    inside = F.lit(True)
    if start is not None:
        inside = inside & after(start)
    if end is not None:
        inside = inside & until(end)
    broken = F.col(BROKEN).isNotNull()
    found = {"_file": "_metadata.file_path", "_block": "_metadata.file_block_start"}
    placed = events.withColumns({n: F.when(broken, F.col(m)) for n, m in found.items()})
    return placed.where(broken | inside)


#: Columns that a quarantined line has beside the (null) fields of an event.
PLACE = {BROKEN: "string", "_file": "string", "_block": "bigint"}


def broken_lines(events: DataFrame) -> DataFrame:
    """(file, block, line, reason) of the lines that are no events."""
    return events.where(F.col(BROKEN).isNotNull()).select(
        F.col("_file").alias("file"), F.col("_block").alias("block"), F.col(BROKEN).alias("line"),
        F.lit("the line is not an event").alias("reason"),
    )


def good_events(events: DataFrame) -> DataFrame:
    return events.where(F.col(BROKEN).isNull()).drop(*PLACE)


def read_change_log(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    start: Position | None = None,
    end: Position | None = None,
    fmt: str = "parquet",
    quarantine: bool = False,
) -> DataFrame:
    """Changes in (start, end].  A line of text that is not an event fails the job, or, with
    ``quarantine``, is a row of its own: see ``broken_lines`` and ``good_events``."""
    read = _reader(spark.read, schema, fmt, quarantine).load(path)
    return _kept(read, quarantine, fmt, start, end)


def stream_change_log(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    start: Position | None = None,
    fmt: str = "parquet",
    files_per_trigger: int | None = None,
    bytes_per_trigger: int = 1 << 30,
    quarantine: bool = False,
) -> DataFrame:
    """The log as a stream from a start position on, in batches of bounded size.

    A line of text that is not an event fails the query, so that the position never
    moves past it; with ``quarantine`` it is a row of its own, as in ``read_change_log``.

    After the first run the query's own checkpoint holds the progress; the start
    position then only filters what a first run would have skipped anyway.
    """
    reader = _reader(spark.readStream, schema, fmt, quarantine)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    else:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    return _kept(reader.load(path), quarantine, fmt, start, None)


def stream_kafka(spark: SparkSession, servers: str, topic: str, schema: T.StructType) -> DataFrame:
    """The log from a Kafka topic of JSON events; needs the Kafka connector."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .load()
    )
    return raw.select(F.from_json(F.col("value").cast("string"), schema, {"mode": "FAILFAST"}).alias("e")).select("e.*")
