"""Streams, sinks and state: equal to batch, restartable, repeatable."""

import pytest
from pyspark.sql import functions as F

from bulk import bulk_replay
from tidefold.operators import fold
from tidefold.sinks.fanout import FanOut, activate
from tidefold.sinks.state import FoldStore, MergeStore
from tidefold.sinks.writers import BulkTextSink, ChangeLogSink
from tidefold.sources.change_log import read_change_log, stream_change_log, write_change_log
from tidefold.model import Position
from tidefold.session import scratch_dir
from tidefold.streaming.apply import run_stream

KEY, DOC = ["k"], ["v"]


def changes(spark, n=600):
    """A third of all rows belong to one key."""
    return spark.range(n).selectExpr(
        "concat('binlog.', lpad(cast(id div 60 as string), 6, '0')) logfile",
        "id % 60 * 10 logpos",
        "0 row_idx",
        "element_at(array('insert', 'update', 'update', 'delete', 'update', 'insert', 'update'), cast(id % 7 + 1 as int)) op",
        "if(id % 3 = 0, 0, id % 41) k",
        "concat('v', id) v",
    )


def table(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_equals_batch_in_any_file_order(spark, tmp_path):
    log = changes(spark)
    expected = table(fold.apply_changes(log, KEY, DOC))
    log.orderBy(F.rand(1)).repartition(7).write.json(f"{tmp_path}/in")
    stream = stream_change_log(
        spark, f"{tmp_path}/in", log.schema, fmt="json", files_per_trigger=1
    )
    store = FoldStore(f"{tmp_path}/state", KEY, DOC)
    run_stream(stream, store, f"{tmp_path}/cp", available_now=True)
    assert spark.read.parquet(f"{tmp_path}/state/pieces").select("batch_id").distinct().count() == 7
    assert table(store.current(spark)) == expected


def test_restart_replay_and_compaction(spark, tmp_path):
    log = changes(spark)
    expected = table(fold.apply_changes(log, KEY, DOC))
    store = FoldStore(f"{tmp_path}/state", KEY, DOC)
    parts = log.randomSplit([1.0, 1.0, 1.0], seed=4)
    for i, part in enumerate(parts):
        part.coalesce(2).write.mode("append").json(f"{tmp_path}/in")
        stream = stream_change_log(spark, f"{tmp_path}/in", log.schema, fmt="json")
        run_stream(stream, store, f"{tmp_path}/cp", available_now=True)
        if i == 1:
            store.compact(spark, through=1)
    assert table(store.current(spark)) == expected
    # A batch that runs again, under its own or a new id, changes nothing.
    store.write(parts[2], 2)
    store.write(parts[0], 9)
    assert table(store.current(spark)) == expected
    store.compact(spark, through=9)
    assert table(store.current(spark)) == expected
    # Tombstones survive compaction: an old insert must not revive its key.
    dead = store.state(spark).where("boundary.op = 'delete'").first()["k"]
    store.write(log.where((F.col("k") == dead) & (F.col("op") == "insert")), 10)
    assert table(store.current(spark)) == expected


def test_stateful_form_of_the_same_fold(spark, tmp_path):
    log = changes(spark)
    log.repartition(4).write.json(f"{tmp_path}/in")
    stream = stream_change_log(spark, f"{tmp_path}/in", log.schema, fmt="json", files_per_trigger=1)
    query = (
        fold.live_rows(fold.fold_state(stream, KEY, DOC), KEY)
        .writeStream.outputMode("complete")
        .format("memory")
        .queryName("folded")
        .option("checkpointLocation", f"{tmp_path}/cp")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert table(spark.table("folded")) == table(fold.apply_changes(log, KEY, DOC))


def test_log_folders_are_pruned(spark, tmp_path):
    log = changes(spark)
    write_change_log(log, f"{tmp_path}/log")
    part = read_change_log(
        spark, f"{tmp_path}/log", log.schema, Position("binlog.000003", 100), Position("binlog.000004", 50)
    )
    assert table(part.select("logfile", "logpos")) == table(
        log.where(
            "(logfile = 'binlog.000003' and logpos > 100) or (logfile = 'binlog.000004' and logpos <= 50)"
        ).select("logfile", "logpos")
    )
    assert len(part.inputFiles()) >= 2
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = part._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pruned = plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert ">= 3)" in pruned and "<= 4)" in pruned


def test_fan_out_with_a_failing_sink(spark, tmp_path):
    log = changes(spark)
    calls = []

    def flaky(batch, batch_id):
        calls.append(batch_id)
        if len(calls) == 1:
            raise OSError("unreachable")
        ChangeLogSink(f"{tmp_path}/flaky")(batch, batch_id)

    sinks = FanOut(
        {
            "flaky": flaky,
            "bulk": BulkTextSink(f"{tmp_path}/bulk", "t", KEY, DOC),
            "log": ChangeLogSink(f"{tmp_path}/log"),
        },
        dead_letters=f"{tmp_path}/dead",
    )
    log.sortWithinPartitions("logfile", "logpos").repartitionByRange(3, "logfile").write.json(
        f"{tmp_path}/in"
    )
    stream = stream_change_log(spark, f"{tmp_path}/in", log.schema, fmt="json", files_per_trigger=1)
    run_stream(stream, sinks, f"{tmp_path}/cp", available_now=True)
    assert spark.read.parquet(f"{tmp_path}/log").count() == 600
    assert spark.read.parquet(f"{tmp_path}/dead/errors").select("sink", "error").collect()[0][:] == (
        "flaky",
        "unreachable",
    )
    # The second batch brought the first, in order.
    assert calls == [0, 0, 1, 2] and sinks.pending(spark, "flaky") == []
    assert spark.read.parquet(f"{tmp_path}/flaky").count() == 600


def test_an_older_batch_never_comes_after_a_newer_one(spark, tmp_path):
    log = changes(spark)
    parts = [log.where(f"logfile >= 'binlog.{a:06d}' and logfile < 'binlog.{a + 2:06d}'") for a in range(0, 10, 2)]
    down, got = [True], []

    def sink(batch, batch_id):
        if down[0]:
            raise OSError("unreachable")
        got.append((batch_id, batch.count()))

    sinks = FanOut({"late": sink, "log": ChangeLogSink(f"{tmp_path}/log")}, dead_letters=f"{tmp_path}/dead")
    for i, part in enumerate(parts[:3]):
        sinks(part, i)
    assert got == [] and sinks.pending(spark, "late") == [0, 1, 2]
    # A batch that is repeated while it is kept replaces itself.
    sinks(parts[2], 2)
    assert sinks.pending(spark, "late") == [0, 1, 2]
    down[0] = False
    sinks.retry(spark, "late", 1)
    assert got == [(0, 120), (1, 120)] and sinks.pending(spark, "late") == [2]
    # A new object, as after a restart, finds what is kept.
    again = FanOut({"late": sink}, dead_letters=f"{tmp_path}/dead")
    again(parts[3], 3)
    assert got == [(0, 120), (1, 120), (2, 120), (3, 120)] and again.pending(spark, "late") == []


def test_bulk_text_has_the_effect_of_the_log(spark, tmp_path):
    log = changes(spark)
    sink = BulkTextSink(f"{tmp_path}/bulk", "t", KEY, DOC)
    for i, bounds in enumerate(("logfile < 'binlog.000004'", "logfile >= 'binlog.000004'")):
        sink(log.where(bounds), i)
    docs = bulk_replay(spark, f"{tmp_path}/bulk/bulk", {})
    assert {int(k): v["v"] for k, v in docs.items()} == dict(
        table(fold.apply_changes(log, KEY, DOC).select("k", "v"))
    )


def test_partial_changes_in_store_and_bulk_text(spark, tmp_path):
    log = changes(spark).selectExpr(
        "*",
        "if(logpos % 40 = 0, null, logpos) w",
        "case logpos % 3 when 0 then array('v') when 1 then array('v', 'w') else array('w') end present",
    )
    doc = ["v", "w"]
    expected = {
        r["k"]: {c: r[c] for c in r["present"]}
        for r in fold.merge_changes(log, KEY, doc).collect()
    }
    store = MergeStore(f"{tmp_path}/state", KEY, doc)
    sink = BulkTextSink(f"{tmp_path}/bulk", "t", KEY, doc)
    for i, bounds in enumerate(("logfile < 'binlog.000003'", "logfile >= 'binlog.000003'")):
        store(log.where(bounds), i)
        sink(log.where(bounds), i)
    store.compact(spark, through=0)
    got = {r["k"]: (r["v"], r["w"]) for r in store.current(spark).collect()}
    assert got == {k: (d.get("v"), d.get("w")) for k, d in expected.items()}
    docs = bulk_replay(spark, f"{tmp_path}/bulk/bulk", {})
    assert {d.pop("k"): d for d in docs.values()} == expected


def test_failure_without_dead_letters_is_raised_after_all_sinks(spark, tmp_path):
    def down(batch, batch_id):
        raise OSError("unreachable")

    sinks = FanOut({"down": down, "log": ChangeLogSink(f"{tmp_path}/log")})
    with pytest.raises(RuntimeError, match="down"):
        sinks(changes(spark), 0)
    assert spark.read.parquet(f"{tmp_path}/log").count() == 600


def test_activate():
    assert list(activate({"a": print, "b": print}, ["b"])) == ["b"]
    with pytest.raises(ValueError):
        activate({"a": print}, ["z"])


def test_scratch_follows_the_session(spark):
    assert "tidefold" in scratch_dir(spark, "x") and scratch_dir(spark, "x") != scratch_dir(spark, "x")
