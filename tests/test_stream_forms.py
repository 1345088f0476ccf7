"""Stream forms of order-dependent operators, one-scan catch-up, and digests."""

import random

import pytest
from pyspark.sql import functions as F

from tidefold.model import Column, Position
from tidefold.operators import reconcile as V
from tidefold.operators.catchup import catchup_many
from tidefold.operators.ordering import rotate_attribution
from tidefold.sinks.tables import TablesStore
from tidefold.sinks.writers import ChangeLogSink
from tidefold.sources.tables import table_inventory
from tidefold.streaming.dropped import DroppedUpdates
from tidefold.streaming.rotation import RotateAttribution


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_current_file_is_carried_over_batches_without_a_rotate(spark, tmp_path):
    rng = random.Random(2)
    log = []
    for source in ("a", "b", None):
        for i in range(400):
            name = f"{source}.{i:06d}" if rng.random() < 0.02 or i == 390 else None
            log.append((source, i, "rotate" if name else "rows", name))
    schema = "source string, ord bigint, kind string, next_log string"
    df = spark.createDataFrame(log, schema)
    handle = RotateAttribution(f"{tmp_path}/carried", ChangeLogSink(f"{tmp_path}/seen"), "first", "source", 8, 4, keep=2)
    for b in range(10):
        handle(df.where(f"ord div 40 = {b}"), b)
        if b == 6:  # a batch that runs again reads what the one before it left
            handle(df.where(f"ord div 40 = {b}"), b)
    want = None
    for source in ("a", "b", None):
        own = rotate_attribution(df.where(F.col("source").eqNullSafe(F.lit(source))), "first", bucket_size=16)
        want = own if want is None else want.unionByName(own)
    got = spark.read.parquet(f"{tmp_path}/seen").select("source", "ord", "kind", "next_log", "logfile")
    assert rows(got) == rows(want.select(*got.columns))


def test_dropped_updates_of_batches_equal_a_model(spark, tmp_path):
    rng = random.Random(7)
    ops = ["insert", "update", "update", "update", "delete"]
    log = [
        (f"t{rng.randint(0, 1)}", "binlog.000001", 10 * i, 0, rng.choice(ops), [str(0 if i % 3 == 0 else rng.randint(1, 60))], ["x"])
        for i in range(900)
    ]
    live, want = set(), []
    for tbl, _, pos, _, op, key, _ in log:
        k = (tbl, key[0])
        if op == "insert":
            live.add(k)
        elif op == "delete":
            live.discard(k)
        elif k not in live:
            want.append((tbl, pos))
    schema = "tbl string, logfile string, logpos bigint, row_idx int, op string, key array<string>, vals array<string>"
    df = spark.createDataFrame(log, schema)
    store = TablesStore(f"{tmp_path}/state", buckets=3, fan=2)
    handle = DroppedUpdates(f"{tmp_path}/dropped", store, bucket_bytes=500)
    for b in range(5):
        part = df.where(f"logpos div 1800 = {b}")
        handle(part, b)
        handle(part, b)  # again, as after a kill between the two writes
        store.compact(spark, b)
    assert rows(spark.read.parquet(f"{tmp_path}/dropped").select("tbl", "logpos")) == sorted(want, key=str)


def test_catch_up_of_twenty_tables_reads_the_log_once(spark, tmp_path):
    log = spark.range(4000).selectExpr(
        "concat('t', id % 20) tbl", "concat('binlog.', lpad(id div 400, 6, '0')) logfile", "id % 400 * 10 logpos", "id"
    )
    log.write.partitionBy("logfile").parquet(f"{tmp_path}/log")
    at = lambda i: (f"binlog.{i // 400:06d}", i % 400 * 10)
    ranges = [(f"t{k}", *at(900 + 10 * k), *at(2000 + 35 * k)) for k in range(20)]
    df = spark.createDataFrame(
        ranges, "tbl string, from_logfile string, from_logpos bigint, to_logfile string, to_logpos bigint"
    )
    got = catchup_many(spark.read.parquet(f"{tmp_path}/log"), df)
    plan = got._jdf.queryExecution().executedPlan().toString()
    want = [i for i in range(4000) if 900 + 10 * (i % 20) < i <= 2000 + 35 * (i % 20)]
    assert sorted(r["id"] for r in got.collect()) == want
    assert plan.count("FileScan parquet") == 1 and "PartitionFilters: [(coalesce" in plan


def test_only_differing_buckets_are_joined(spark, tmp_path):
    source = spark.range(20_000).selectExpr("id k", "concat('v', id) v", "cast(id as int) w")
    target = source.selectExpr("k", "if(k = 77, 'other', v) v", "cast(w as bigint) w").where("k <> 5000")
    for name, df in (("s", source), ("t", target.unionAll(spark.sql("select -1L, 'own', 0L")))):
        df.write.parquet(f"{tmp_path}/{name}")
    s, t = (spark.read.parquet(f"{tmp_path}/{n}") for n in "st")
    got = V.reconcile_by_digest(s, t, ["k"], ["v", "w"], buckets=500, target_only=True)
    odd = [tuple(r) for r in got.where("status <> 'verified'").orderBy("k").collect()]
    assert odd == [(-1, "target_only", False), (77, "mismatch", True), (5000, "missing", True)]
    assert got.count() == 20_001
    # The sides of the join hold the rows of three buckets, about 40 each.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ours = V.bucket_digests(s, ["k"], {c: t.schema[c].dataType for c in ("v", "w")}, 500)
        theirs = V.bucket_digests(t, ["k"], {c: s.schema[c].dataType for c in ("v", "w")}, 500)
        assert ours.exceptAll(theirs).count() == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_digests_tell_where_nulls_stand(spark):
    a = spark.createDataFrame([(1, "x", None), (2, "y", "z")], "k int, v string, w string")
    b = spark.createDataFrame([(1, None, "x"), (2, "y", "z")], "k int, v string, w string")
    got = V.reconcile_by_digest(a, b, ["k"], ["v", "w"], buckets=8)
    assert rows(got.select("k", "status")) == [(1, "mismatch"), (2, "verified")]


def test_ids_that_several_keys_share(spark):
    layout = [Column("a", "int", 0, True), Column("b", "int", 1, True), Column("v", "text", 2)]
    source = spark.createDataFrame([(1, 11, "p"), (11, 1, "q"), (2, 3, "r"), (4, None, "s"), (5, 6, "t")], "a int, b int, v string")
    target = spark.createDataFrame([("111", "q"), ("23", "other")], "_id string, v string")
    got = V.reconcile_by_id(source, target, layout, ["v"], buckets=4)
    assert rows(got.select("_id", "status", "collides")) == [
        ("111", "mismatch", True), ("111", "verified", True), ("23", "mismatch", False), ("56", "missing", False)
    ]
    single = [Column("a", "int", 0, True)]
    assert not V.reconcile_by_id(source.where("b > 3"), target, single, ["v"]).where("collides").count()


def test_tables_kept_in_folders_of_any_name(spark, tmp_path):
    spark.range(7).repartition(3).write.parquet(f"{tmp_path}/city.parquet")
    spark.range(5).repartition(2).write.parquet(f"{tmp_path}/country")
    spark.range(4).withColumn("p", F.col("id") % 2).write.partitionBy("p").parquet(f"{tmp_path}/lake")
    spark.range(2).coalesce(1).write.parquet(f"{tmp_path}/one")
    (part,) = [f for f in (tmp_path / "one").iterdir() if f.suffix == ".parquet"]
    part.rename(tmp_path / "single.parquet")
    spark.range(0).write.parquet(f"{tmp_path}/none.parquet")
    got = {r["name"]: r["n_rows"] for r in table_inventory(spark, str(tmp_path)).collect()}
    assert got == {"city": 7, "country": 5, "lake": 4, "single": 2, "none": 0}


def test_positions_of_names_with_and_without_a_number():
    assert Position("binlog.0099").file_no == 99 and Position("binlog.1998-07-26").file_no is None
    assert Position("binlog." + "1" * 19).file_no is None


@pytest.mark.parametrize("name", ["binlog.000042", "x", "binlog.1998-07-26", "a.b.7", "binlog." + "1" * 19, "binlog.", "1"])
def test_file_numbers_are_the_same_in_columns_and_on_the_driver(spark, name):
    from tidefold.functions.positions import file_number

    df = spark.createDataFrame([(name,)], "logfile string")
    assert df.select(file_number()).first()[0] == Position(name).file_no
