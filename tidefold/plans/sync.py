"""The whole job: load tables from dumps, catch up, and follow the change log.

Every step is one of the engine's operators over whole tables; this module only
keeps their order and writes the registry.  Running it again goes on from the
status each table has reached: a dump from the splits that are not loaded yet, the log
from where the stream stopped.  The log is read once for all tables, in each batch and
when new tables catch up.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidefold.functions.positions import position
from tidefold.model import POSITION_SCHEMA, REGISTRY_SCHEMA, RESERVED, ROW_EVENT_SCHEMA, Column, Followed, Position
from tidefold.operators import registry
from tidefold.operators.ordering import high_water_mark
from tidefold.operators.tables import accepted, catalog_of, kinds_in, rejected, route, snapshot_changes
from tidefold.sinks import folders
from tidefold.sinks.fanout import FanOut, Sink
from tidefold.sinks.tables import CATCHUP_BATCH, SNAPSHOT_BATCH, TablesStore
from tidefold.sources import dump_text
from tidefold.sources.change_log import BROKEN, broken_lines, good_events, read_change_log, stream_change_log
from tidefold.streaming.apply import run_stream

MoreSinks = Callable[[Sequence[Followed]], Mapping[str, Sink]]
#: Marks of the position that are kept, the last one being the position.
MARKS = 4


@dataclass(frozen=True)
class SyncConfig:
    """``dumps`` maps each table to its dump folder.  ``sinks`` adds sinks to the keyed
    state, given all tables; they get changes of all tables at once (``operators.tables``).

    A sink's failure fails the batch, or, with ``dead_letters``, keeps it there.  Up to
    ``most_broken`` lines of a batch that are no events are put among the rejects; more fail
    the batch.  Every ``compact_every`` batches the state is compacted, and what that
    replaced goes ``keep_seconds`` later.
    """

    schema: str
    dumps: Mapping[str, str]
    log: str
    target: str
    log_format: str = "json"
    sinks: MoreSinks = field(default=lambda tables: {})
    dead_letters: str | None = None
    most_broken: int = 100
    split_bytes: int = dump_text.SPLIT_BYTES
    buckets: int = 8
    compact_every: int = 16
    keep_seconds: float = 3600.0


class BrokenLog(RuntimeError):
    """More lines than allowed are not events."""


def current_registry(spark: SparkSession, config: SyncConfig) -> DataFrame:
    return registry.registry_upsert(registry_log(spark, config))


def registry_log(spark: SparkSession, config: SyncConfig) -> DataFrame:
    try:
        return spark.read.schema(REGISTRY_SCHEMA).parquet(f"{config.target}/registry")
    except AnalysisException:
        return spark.createDataFrame([], REGISTRY_SCHEMA)


def store(config: SyncConfig) -> TablesStore:
    return TablesStore(f"{config.target}/state", config.buckets)


def fan_out(config: SyncConfig, tables: Sequence[Followed]) -> FanOut:
    return FanOut({"state": store(config), **config.sinks(tables)}, config.dead_letters)


def main_position(spark: SparkSession, config: SyncConfig) -> Position | None:
    """The position the stream has reached, over all events, also of other tables."""
    try:
        marks = spark.read.schema(POSITION_SCHEMA).parquet(f"{config.target}/position")
    except AnalysisException:
        return None  # never followed
    return Position(**high_water_mark(marks).first().asDict())


def load(spark: SparkSession, config: SyncConfig) -> list[Followed]:
    """Bring every configured table to syncing status.

    Dumps are loaded one after the other.  Then other sinks get the new snapshots, and the
    tables whose dump is older than the position the stream has reached are replayed up to
    it, in one scan of the log; the stream goes on from there for all tables.
    """
    # One row per configured table.
    known = {r["name"]: r for r in current_registry(spark, config).collect()}
    tables = [_load_table(spark, config, t, known.get(t)) for t in config.dumps]
    new = [t for t in tables if t.table not in known or known[t.table]["status"] != "syncing"]
    if new:
        more = FanOut(config.sinks(tables), config.dead_letters)
        if more.sinks:
            more(store(config).snapshots(spark, [t.table for t in new]), SNAPSHOT_BATCH)
        _catch_up(spark, config, tables, new)
        for t in new:
            _note(spark, config, t.table, status="syncing")
    return tables


def _note(spark: SparkSession, config: SyncConfig, table: str, **fields) -> None:
    write = {"name": table, "seq": time.time_ns(), **fields}
    registry.append_registry(spark, f"{config.target}/registry", [write])


def _load_table(spark: SparkSession, config: SyncConfig, table: str, known: Row | None) -> Followed:
    """Take a table from the status it has to moved, by legal moves only."""

    def note(status: str, **fields) -> None:
        _note(spark, config, table, status=status, **fields)

    status = None if known is None else known["status"]
    if status in ("moved", "syncing"):
        return Followed(table, _columns(known), Position(**known["binlog_pos"].asDict()))
    if status is None or registry.resume_phase(status) != status:
        status = "created" if status is None else registry.resume_phase(status)
        note(status)
    statements = dump_text.read_statements(spark, config.dumps[table])
    if status == "created":
        note("dumping")
        note("dumped")
        status = "dumped"
    if status == "dumped":
        columns = dump_text.head_columns(statements)
        clash = [c.name for c in columns if c.name.lower() in RESERVED]
        if clash:
            raise ValueError(f'table "{table}" uses reserved column names: {clash}')
        if not any(c.is_in_primary_key for c in columns):
            raise ValueError(f'table "{table}" has no primary key')
        fan_out(config, [Followed(table, columns, Position())]).init(spark, table, columns)
        note("initialized", columns=[tuple(vars(c).values()) for c in columns])
    else:
        columns = _columns(known)
    found = Followed(table, columns, dump_text.head_position(statements))
    # Entered from initialized, or again from moving.
    note("moving")
    try:
        load_dump(spark, config, found)
    finally:
        done = store(config).loaded(spark, table)
        _note(spark, config, table, dump_read_progress=_bytes_of(spark, config, table, done))
    note("moved", binlog_pos=tuple(vars(found.position).values()))
    return found


def _columns(known: Row) -> list[Column]:
    return [Column(**c.asDict()) for c in known["columns"]]


def _bytes_of(spark: SparkSession, config: SyncConfig, table: str, done: set[str]) -> int:
    splits = dump_text.list_splits(spark, config.dumps[table], config.split_bytes)
    names = spark.createDataFrame([(d,) for d in sorted(done)], "split string")
    return splits.join(names, "split", "left_semi").agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]


def load_dump(spark: SparkSession, config: SyncConfig, found: Followed) -> None:
    """Load the splits of a table's dump that are not in its state yet.

    A split is in the state when its file is; what an earlier load ended stays, whatever
    became of that load.
    """
    into, path = store(config), config.dumps[found.table]
    splits = dump_text.list_splits(spark, path, config.split_bytes)
    # One name for each split of the dump.
    into.keep_loads(spark, found.table, {r["split"] for r in splits.select("split").collect()})
    finished = into.loaded(spark, found.table)
    with dump_text.pinned_splits(spark, config.split_bytes):
        statements = dump_text.read_splits(spark, path, finished, config.split_bytes)
        rows = dump_text.require_good(dump_text.dump_rows(statements, found.columns, keep=["split"]))
        into.load(snapshot_changes(rows, found, keep=["split"]), found.table)


def _catch_up(
    spark: SparkSession, config: SyncConfig, tables: Sequence[Followed], new: Sequence[Followed]
) -> None:
    main = main_position(spark, config)
    behind = [t for t in new if main is not None and main > t.position]
    if not behind:
        return
    log = read_change_log(
        spark, config.log, ROW_EVENT_SCHEMA, min(t.position for t in behind), main, config.log_format, True
    )
    routed = route(good_events(log), catalog_of(spark, config.schema, behind), kinds_in(behind))
    fan_out(config, tables)(accepted(routed), CATCHUP_BATCH)
    _reject(rejected(routed), config, CATCHUP_BATCH)


def _reject(rows: DataFrame, config: SyncConfig, batch_id: int) -> None:
    """Rejects by table; a batch without any writes no file."""
    mode = "dynamic" if batch_id < 0 else "static"
    rows.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("tbl").parquet(
        f"{config.target}/rejects/batch_id={batch_id}"
    )


def _mark(spark: SparkSession, config: SyncConfig, reached: Row | None, batch_id: int) -> None:
    """Write the position the stream has reached: the largest of all batches so far.

    A batch that only holds broken lines leaves it where it was.
    """
    now = None if reached is None else Position(reached["logfile"], reached["logpos"])
    before = main_position(spark, config)
    furthest = max((p for p in (before, now) if p is not None), default=None)
    if furthest is None:
        return
    marks = f"{config.target}/position"
    row = spark.createDataFrame([(furthest.logfile, furthest.logpos)], POSITION_SCHEMA)
    row.coalesce(1).write.mode("overwrite").parquet(f"{marks}/batch_id={batch_id}")
    old = sorted(int(m.removeprefix("batch_id=")) for m in folders.children(spark, marks))
    for m in old[:-MARKS]:
        folders.delete(spark, f"{marks}/batch_id={m}")


def follow(
    spark: SparkSession,
    config: SyncConfig,
    tables: Sequence[Followed],
    available_now: bool = False,
    files_per_trigger: int | None = None,
    interval: str = "1 second",
    bytes_per_trigger: int = 1 << 30,
    sinks: FanOut | None = None,
) -> StreamingQuery:
    """Apply the log to all tables from the oldest of their positions on.

    Each table skips what its own snapshot already holds.  A batch is a fixed number of jobs
    whatever the number of tables.  Events that do not fit a table's columns are kept below
    ``rejects``, lines that are no events below ``broken``.
    """
    deliver = sinks or fan_out(config, tables)
    state = store(config)
    catalog, kinds = catalog_of(spark, config.schema, tables), kinds_in(tables)

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            events = good_events(batch)
            mark = batch.agg(
                F.max(F.when(F.col(BROKEN).isNull(), position())).alias("reached"),
                F.count(BROKEN).alias("broken"),
            ).first()
            if mark["broken"] > config.most_broken:
                raise BrokenLog(f"{mark['broken']} lines are not events, more than {config.most_broken}")
            if mark["broken"]:
                broken_lines(batch).write.mode("overwrite").parquet(f"{config.target}/broken/batch_id={batch_id}")
            routed = route(events, catalog, kinds)
            deliver(accepted(routed), batch_id)
            _reject(rejected(routed), config, batch_id)
            # Last, so that the mark never runs ahead of what the sinks hold.
            _mark(spark, config, mark["reached"], batch_id)
        finally:
            batch.unpersist()
        if config.compact_every and batch_id % config.compact_every == config.compact_every - 1:
            state.compact(spark, batch_id)
            state.retire(spark, config.keep_seconds)

    stream = stream_change_log(
        spark,
        config.log,
        ROW_EVENT_SCHEMA,
        start=min(t.position for t in tables),
        fmt=config.log_format,
        files_per_trigger=files_per_trigger,
        bytes_per_trigger=bytes_per_trigger,
        quarantine=True,
    )
    return run_stream(stream, handle, f"{config.target}/checkpoint", available_now, interval)
