"""Registered queries: fan-out and Structured Streaming forms.

These write to the shared scratch folder and return what a reader finds there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefold.functions.positions import after, until
from tidefold.model import Position
from tidefold.operators.documents import BULK_ACTIONS
from tidefold.plans import inputs
from tidefold.plans.inputs import cte
from tidefold.plans.queries_apply import _FOLD, DOC, KEY
from tidefold.plans.registry import query
from tidefold.session import scratch_dir
from tidefold.sinks.fanout import FanOut
from tidefold.sinks.state import FoldStore
from tidefold.sinks.writers import BulkTextSink, ChangeLogSink
from tidefold.sources.change_log import stream_change_log, write_change_log
from tidefold.streaming.apply import run_stream

_LIVE = (
    cte("changes")
    + _FOLD
    + """select user_id, event_id, event_type, "value" from state where boundary = 'insert'"""
)


class UnreachableError(RuntimeError):
    pass


def _unreachable(batch: DataFrame, batch_id: int) -> None:
    raise UnreachableError("this sink is down")


def _four_sinks(folder: str) -> FanOut:
    return FanOut(
        {
            "down": _unreachable,
            "state": FoldStore(f"{folder}/state", KEY, DOC),
            "bulk": BulkTextSink(f"{folder}/bulk", "users", KEY, DOC),
            "log": ChangeLogSink(f"{folder}/log"),
        },
        dead_letters=f"{folder}/dead",
    )


def _count(rows: DataFrame, sink: str) -> DataFrame:
    return rows.groupBy(F.lit(sink).alias("sink"), "op").agg(F.count(F.lit(1)).alias("n_rows"))


_DELIVERED = (
    cte("changes")
    + _FOLD
    + """, net as (select coalesce(boundary, 'update') op from state)
    select 'log' sink, op, count(*) n_rows from changes group by op
    union all select 'down', op, count(*) from changes group by op
"""
)


@query("fan_out", _DELIVERED + " union all select 'bulk', op, count(*) from net group by op")
def fan_out(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of what each sink holds after one batch; one sink is down and its
    batch is kept as a dead letter."""
    folder = scratch_dir(spark, "fan-out")
    _four_sinks(folder)(inputs.changes(spark, sf), 0)
    ops = F.create_map(*[F.lit(x) for op, a in BULK_ACTIONS.items() for x in (a, op)])
    actions = spark.read.text(f"{folder}/bulk/bulk").select(
        ops[F.regexp_extract("value", r'^\{"(index|update|delete)":\{"_index"', 1)].alias("op")
    )
    return (
        _count(spark.read.parquet(f"{folder}/log"), "log")
        .unionByName(_count(spark.read.parquet(f"{folder}/dead/rows/sink=down"), "down"))
        .unionByName(_count(actions.where("op is not null"), "bulk"))
    )


def _logged(spark: SparkSession, sf: str, folder: str, by_file: bool = False) -> DataFrame:
    """The change log written out as files; returns it for its schema."""
    changes = inputs.changes(spark, sf)
    write_change_log(changes, folder, by_file)
    return changes


@query(
    "change_source",
    cte("changes") + "select * from changes where logfile > 'binlog.000000000' or logpos > 20004",
)
def change_source(spark: SparkSession, sf: str) -> DataFrame:
    """The log read as a stream from a start position."""
    folder = scratch_dir(spark, "change-source")
    schema = _logged(spark, sf, f"{folder}/input", by_file=True).schema
    stream = stream_change_log(
        spark, f"{folder}/input", schema, start=Position("binlog.000000000", 20004)
    )
    run_stream(stream, ChangeLogSink(f"{folder}/seen"), f"{folder}/checkpoint", True)
    return spark.read.schema(schema).parquet(f"{folder}/seen/*")


@query("stream_apply", _LIVE)
def stream_apply(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_dir(spark, "stream-apply")
    schema = _logged(spark, sf, f"{folder}/input").schema
    store = FoldStore(f"{folder}/state", KEY, DOC)
    stream = stream_change_log(spark, f"{folder}/input", schema, files_per_trigger=512)
    run_stream(stream, store, f"{folder}/checkpoint", available_now=True)
    return store.current(spark)


@query("stream_checkpoint", _LIVE)
def stream_checkpoint(spark: SparkSession, sf: str) -> DataFrame:
    """Part of the log is applied, the stream stops, compacts, and goes on from
    its checkpoint when the rest has arrived."""
    folder = scratch_dir(spark, "stream-checkpoint")
    changes = inputs.changes(spark, sf)
    store = FoldStore(f"{folder}/state", KEY, DOC)
    halt = Position("binlog.000000004", 50004)
    for part in (changes.where(until(halt)), changes.where(after(halt))):
        write_change_log(part, f"{folder}/input", by_file=False)
        stream = stream_change_log(spark, f"{folder}/input", changes.schema)
        run_stream(stream, store, f"{folder}/checkpoint", available_now=True)
        store.compact(spark, through=0)
    return store.current(spark)


@query("stream_fan_out", _DELIVERED + " union all select 'state', op, count(*) from net group by op")
def stream_fan_out(spark: SparkSession, sf: str) -> DataFrame:
    """As ``fan_out``, on the stream."""
    folder = scratch_dir(spark, "stream-fan-out")
    schema = _logged(spark, sf, f"{folder}/input").schema
    sinks = _four_sinks(folder)
    stream = stream_change_log(spark, f"{folder}/input", schema, files_per_trigger=5)
    run_stream(stream, sinks, f"{folder}/checkpoint", available_now=True)
    state = sinks.sinks["state"].state(spark)
    net = state.select(F.coalesce("boundary.op", F.lit("update")).alias("op"))
    return (
        _count(spark.read.parquet(f"{folder}/log"), "log")
        .unionByName(_count(spark.read.parquet(f"{folder}/dead/rows/sink=down"), "down"))
        .unionByName(_count(net, "state"))
    )
