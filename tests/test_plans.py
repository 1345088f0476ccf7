"""Shapes of the physical plans: what would not survive a large scale."""

import inspect
import re

import pytest

from tidefold.model import Position
from tidefold.operators.catchup import catchup_range, resume_after
from tidefold.operators.fold import snapshot_plus_log
from tidefold.plans import QUERIES, queries_tables

SF = "/root/testdata/sf0.001"
WRITING = {"fan_out", "change_source", "stream_apply", "stream_checkpoint", "stream_fan_out"}
WRITING |= {"dump_rows", "dump_rows_pages", "dump_rows_documents", "dump_columns", "dump_rejects"}
WRITING |= {"dump_resume", "stream_tables", "fan_out_in_order", "change_source_broken", "stream_rotate"}
WRITING |= {"stream_dropped_updates", "dump_rows_quoted"}


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(spark, name):
    df = QUERIES[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_no_cross_join_and_no_python(spark, no_broadcast, name):
    plan = plan_of(spark, name)
    assert not re.search(r"Cartesian|NestedLoop|Python|Pandas|MapIn", plan)


@pytest.mark.parametrize(
    "name", ["apply_changes", "apply_changes_lineitem", "merge_changes", "net_actions"]
)
def test_fold_is_one_shuffle_with_partial_aggregates(spark, name):
    plan = plan_of(spark, name)
    assert plan.count("Exchange ") == 1
    assert "partial_max" in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(spark, "apply_changes")
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string,value:double>" in plan
    plan = plan_of(spark, "reconcile")
    assert "o_custkey" not in plan


def _below_exchanges(plan):
    """The plan lines below each shuffle."""
    lines = plan.splitlines()
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    for k, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            for x in lines[k + 1 :]:
                if depth(x) <= depth(line):
                    break
                yield x


def test_a_bucketed_snapshot_is_not_moved(spark, no_broadcast):
    rows = spark.range(1000).selectExpr("id", "id * 2 v")
    spark.sql("drop table if exists plan_snapshot")
    rows.write.bucketBy(8, "id").sortBy("id").saveAsTable("plan_snapshot")
    try:
        log = spark.range(90).selectExpr(
            "id * 13 id", "id v", "'b.1' logfile", "id + 1 logpos", "0 row_idx",
            "case id % 3 when 0 then 'insert' when 1 then 'update' else 'delete' end op",
        )
        snapshot = spark.table("plan_snapshot")
        got = snapshot_plus_log(snapshot, log, Position("b.0", 0), ["id"], ["v"])
        want = {i: i * 2 for i in range(1000)}
        for i in range(90):
            if i % 3 == 0 or (i % 3 == 1 and i * 13 in want):
                want[i * 13] = i
            elif i % 3 == 2:
                want.pop(i * 13, None)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert {r.id: r.v for r in got.collect()} == want
        assert "plan_snapshot" in plan
        assert not any("plan_snapshot" in x for x in _below_exchanges(plan))
    finally:
        spark.sql("drop table if exists plan_snapshot")


def partition_filters(spark, df):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    return re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", plan)


def test_resuming_reads_from_the_smallest_position_on(spark, tmp_path):
    log = spark.range(100).selectExpr(
        "concat('b.', lpad(id div 10, 3, '0')) logfile", "id % 10 logpos", "concat('t', id % 2) tbl"
    )
    log.write.partitionBy("logfile").parquet(str(tmp_path / "log"))
    saved = spark.createDataFrame([("t0", "b.007", 4), ("t1", "b.008", 2)], "tbl string, logfile string, logpos bigint")
    got = resume_after(spark.read.parquet(str(tmp_path / "log")), saved, all_saved=True)
    assert got.count() == 12 + 9
    assert any(">= Subquery" in f or ">= ReusedSubquery" in f for f in partition_filters(spark, got))


def test_a_crossing_replay_is_bounded_on_both_sides(spark, tmp_path):
    log = spark.range(100).selectExpr(
        "concat('b.', lpad(id div 10, 3, '0')) logfile", "id % 10 logpos", "'t' tbl"
    )
    log.write.partitionBy("logfile").parquet(str(tmp_path / "log"))
    read = spark.read.parquet(str(tmp_path / "log"))
    got = catchup_range(read, Position("b.002", 3), Position("b.004", 5), crossing=True)
    assert got.count() == 22
    filters = partition_filters(spark, got)
    assert any(">= 2" in f and "<= Subquery" in f for f in filters), filters


@pytest.mark.parametrize("name", ["fan_out_in_order", "stream_dropped_updates"])
def test_batches_are_cut_by_sketches(name):
    """The exact percentile of a log holds all its events in one task."""
    source = inspect.getsource(queries_tables)
    assert "percentile(" not in source and "_batch_edges(changes" in inspect.getsource(QUERIES[name])
