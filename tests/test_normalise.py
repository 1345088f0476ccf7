"""Row events to change rows, filters and rejects."""

from pyspark.sql import functions as F

from tidefold.model import ROW_EVENT_SCHEMA, Column
from tidefold.operators import normalise

COLUMNS = [Column("id", "int", 0, True), Column("name", "varchar(9)", 1), Column("n", "bigint", 2)]


def events(spark, *rows):
    return spark.createDataFrame([("s", "t", *r) for r in rows], ROW_EVENT_SCHEMA)


def test_records_after_images_and_missing_tail(spark):
    df = events(
        spark,
        ("write_rows_v2", "f", 1, [["1", "a", "5"], ["2", None, None]]),
        ("update_rows_v1", "f", 2, [["1", "a", "5"], ["1", "b", "6"], ["2", None, None]]),
        ("delete_rows_v2", "f", 3, [["1", "b"]]),
    )
    got = normalise.rows_to_records(df, COLUMNS).orderBy("logpos", "row_idx").collect()
    assert [tuple(r) for r in got] == [
        ("f", 1, 0, "insert", 1, "a", 5, ["id", "name", "n"]),
        ("f", 1, 1, "insert", 2, None, None, ["id", "name", "n"]),
        ("f", 2, 0, "update", 1, "b", 6, ["id", "name", "n"]),
        ("f", 3, 0, "delete", 1, "b", None, ["id", "name"]),
    ]


def test_one_wide_row_loses_its_event(spark):
    df = events(
        spark,
        ("write_rows_v1", "f", 1, [["1", "a", "5"], ["2", "b", "5", "more"]]),
        ("write_rows_v1", "f", 2, [["3", "c", "5"]]),
        # Only after-images are bound, so a wide before-image does no harm.
        ("update_rows_v2", "f", 3, [["3", "c", "5", "more"], ["3", "d", "5"]]),
    )
    kept = normalise.rows_to_records(df, COLUMNS).collect()
    assert sorted((r["logpos"], r["id"]) for r in kept) == [(2, 3), (3, 3)]
    rejects = normalise.record_rejects(df, COLUMNS).collect()
    assert [(r["logpos"], r["reason"]) for r in rejects] == [(1, "the value at position 3 belongs to no column")]


def test_values_of_the_wrong_type_are_rejected_row_by_row(spark):
    df = events(spark, ("write_rows_v2", "f", 1, [["1", "a", "5"], ["x", "b", "many"], ["3", None, None]]))
    assert [r["id"] for r in normalise.rows_to_records(df, COLUMNS).collect()] == [1, 3]
    (reject,) = normalise.record_rejects(df, COLUMNS).collect()
    assert (reject["rows"], reject["reason"]) == ([["x", "b", "many"]], "values do not fit: id, n")


def test_other_events_are_ignored(spark):
    df = events(spark, ("query", "f", 1, None), ("rotate", "f", 2, None), ("delete_rows_v1", "f", 3, []))
    assert [r["logpos"] for r in normalise.row_events_only(df).collect()] == [3]


def test_table_filter_by_schema_or_name(spark):
    df = spark.createDataFrame([("a", "t"), ("b", "t"), ("a", "u")], "schema string, tbl string")
    registry = spark.createDataFrame(
        [("a", "t", "syncing"), ("a", "u", "moved")], "schema string, tbl string, status string"
    )
    assert normalise.table_filter(df, registry).count() == 1
    assert normalise.table_filter(df, registry, match_schema=False).count() == 2


def test_column_at(spark):
    df = spark.range(4).select(normalise.column_at(COLUMNS, F.col("id").cast("int")).alias("c"))
    assert [r["c"] for r in df.collect()] == ["id", "name", "n", None]


def test_key_changes(spark):
    df = events(
        spark,
        ("update_rows_v2", "f", 1, [["1", "a", "5"], ["9", "a", "5"], ["2", "x", "1"], ["2", "y", "1"], ["7", "q", "0"]]),
        ("update_rows_v2", "f", 2, [["1", "unpaired", "5"]]),
    )
    pairs = normalise.update_pairs(df, COLUMNS, ["logfile", "logpos"])
    assert [(r["before"]["id"], r["after"]["id"]) for r in normalise.pk_change(pairs, ["id"]).collect()] == [(1, 9)]
    moves = normalise.move_changed_keys(pairs, ["id"], ["logfile", "logpos"]).orderBy("row_idx")
    assert [(r["row_idx"], r["op"], r["id"]) for r in moves.collect()] == [
        (0, "delete", 1),
        (1, "insert", 9),
        (2, "update", 2),
    ]


def test_missing_key_rejects_its_batch(spark):
    df = spark.createDataFrame([(1, "a"), (1, ""), (2, "b"), (3, None)], "batch int, _id string")
    got = normalise.missing_key_reject(df, ["batch"]).collect()
    assert sorted((r["batch"], r["accepted"]) for r in got) == [
        (1, False), (1, False), (2, True), (3, False)
    ]


def test_enum_rejects_its_table(spark):
    df = spark.createDataFrame(
        [("a", "int"), ("a", "ENUM('x')"), ("b", "int")], "tbl string, type string"
    )
    got = normalise.enum_reject(df).collect()
    assert sorted((r["tbl"], r["accepted"]) for r in got) == [("a", False), ("a", False), ("b", True)]
