"""Carried values against brute force, over many bucket sizes and a hot key."""

import random

import pytest
from pyspark.sql import functions as F

from tidefold.operators import ordering, registry
from tidefold.functions import positions
from tidefold.model import Position


def random_rows(n=400):
    rng = random.Random(5)
    return [
        (i * rng.choice([1, 1, 3]) + i * 3, "hot" if rng.random() < 0.4 else rng.choice("abc"), v)
        for i in range(n)
        for v in [rng.choice(["x", "y", None, None, None])]
    ]


def brute(rows, keyed, inclusive):
    last, out = {}, {}
    for o, k, v in sorted(rows):
        key = k if keyed else None
        if inclusive and v is not None:
            last[key] = v
        out[o] = last.get(key)
        if v is not None:
            last[key] = v
    return out


@pytest.mark.parametrize("bucket,block", [(1, 1), (7, 3), (50, None), (10000, 10)])
@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("keyed", [False, True])
def test_carry_forward(spark, bucket, block, keyed, inclusive):
    rows = list({r[0]: r for r in random_rows()}.values())
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "o bigint, k string, v string")
    b = F.floor(F.col("o") / bucket)
    got = ordering.carry_forward(
        df,
        value=F.col("v"),
        into="last",
        order=["o"],
        bucket=b,
        block=None if block is None else F.floor(b / block),
        keys=["k"] if keyed else [],
        inclusive=inclusive,
    )
    assert {r["o"]: r["last"] for r in got.collect()} == brute(rows, keyed, inclusive)
    assert got.columns == ["o", "k", "v", "last"]


def test_rotate_attribution_starts_with_the_opened_file(spark):
    log = [(0, "rows", None), (1, "rotate", "b2"), (2, "rows", None), (9, "rotate", "b3"), (11, "rows", None)]
    df = spark.createDataFrame(log, "ord bigint, kind string, next_log string")
    got = ordering.rotate_attribution(df, "b1", bucket_size=2, buckets_per_block=2)
    assert [r["logfile"] for r in got.orderBy("ord").collect()] == ["b1", "b2", "b2", "b3", "b3"]


def test_high_water_mark_defaults(spark):
    empty = spark.createDataFrame([], "logfile string, logpos bigint")
    assert tuple(ordering.high_water_mark(empty).first()) == ("binlog.000000", 0)


def test_status_transitions_with_small_buckets(spark):
    path = ["created", "dumping", "dumped", "initialized", "moving", "moved", "syncing"]
    log = [("t", 10 * i, s) for i, s in enumerate(path)] + [
        ("u", 1, "dumping"),
        ("u", 500, "created"),
        ("u", 501, "dumped"),
    ]
    df = spark.createDataFrame(log, "tbl string, seq bigint, status string")
    got = registry.status_transitions(df, bucket_size=3, buckets_per_block=2)
    legal = {(r["tbl"], r["seq"]): r["legal"] for r in got.collect()}
    assert all(legal["t", 10 * i] for i in range(7))
    assert [legal["u", s] for s in (1, 500, 501)] == [False, True, False]


def test_position_order_and_bounds(spark):
    rows = [("binlog.000001", 5), ("binlog.000001", 6), ("binlog.000002", 1), ("binlog.000003", 9)]
    df = spark.createDataFrame(rows, "logfile string, logpos bigint")
    start, end = Position("binlog.000001", 5), Position("binlog.000003", 8)
    got = df.where(positions.after(start)).where(positions.until(end)).collect()
    assert sorted(map(tuple, got)) == rows[1:3]
    wide = spark.createDataFrame(
        [("binlog.999999", 9, "binlog.1000000", 1)], "f1 string, p1 int, f2 string, p2 int"
    )
    text = positions.compare_positions(positions.text_position("f1", "p1"), positions.text_position("f2", "p2"))
    number = positions.compare_positions(
        positions.position("f1", "p1"), positions.position("f2", "p2")
    )
    assert tuple(wide.select(text, number).first()) == ("first_newer", "second_newer")
    assert Position("binlog.999999", 9) < Position("binlog.1000000", 1)
    log = spark.createDataFrame([("binlog.999999", 9), ("binlog.1000000", 1)], "logfile string, logpos bigint")
    assert tuple(ordering.high_water_mark(log).first()) == ("binlog.1000000", 1)
    assert log.where(positions.after(Position("binlog.999999", 9))).count() == 1
    assert log.where(positions.until(Position("binlog.999999", 9))).count() == 1


def test_building_carried_values_starts_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("carried", "")
    try:
        for n in (1, 1000):
            rows = spark.range(n).selectExpr("id o", "'k' k", "'v' v")
            ordering.carry_forward(
                rows, value=F.col("v"), into="last", order=["o"], bucket=F.col("o"), keys=["k"]
            )
        assert list(tracker.getJobIdsForGroup("carried")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
