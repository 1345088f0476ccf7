"""Raw row events to change rows: routing, after-images, names, rejects."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefold.functions.types import DATES, ZERO_DATE, spark_type
from tidefold.model import DELETE, INSERT, ROW_EVENT_OPS, UPDATE, Column


def classify_op(event_type: SparkColumn) -> SparkColumn:
    """insert, update or delete for row events of both generations, else null."""
    ops = F.create_map(*[F.lit(x) for pair in ROW_EVENT_OPS.items() for x in pair])
    return F.try_element_at(ops, event_type)


def row_events_only(events: DataFrame) -> DataFrame:
    """Drop everything but row events (schema changes, commits, rotations)."""
    return events.where(F.col("event_type").isin(*ROW_EVENT_OPS))


def table_filter(events: DataFrame, registry: DataFrame, match_schema: bool = True) -> DataFrame:
    """Events of the tables that are in syncing status.

    ``match_schema=False`` compares table names only.
    """
    on = ["schema", "tbl"] if match_schema else ["tbl"]
    syncing = registry.where(F.col("status") == "syncing").select(*on).distinct()
    return events.join(syncing, on, "left_semi")


def after_images(event_type: SparkColumn, rows: SparkColumn) -> SparkColumn:
    """Rows to apply: the second of each before/after pair of an update, without
    an unpaired last row; all rows of other events."""
    second = F.filter(rows, lambda row, i: i % 2 == 1)
    return F.when(classify_op(event_type) == UPDATE, second).otherwise(rows)


def explode_rows(events: DataFrame, keep: Sequence[str]) -> DataFrame:
    """One line per row to apply, with its op and its index inside the event."""
    return events.select(
        *keep,
        classify_op(F.col("event_type")).alias("op"),
        F.posexplode(after_images(F.col("event_type"), F.col("rows"))).alias("row_idx", "row"),
    )


def too_wide(columns: Sequence[Column]) -> SparkColumn:
    """True for events holding a value at a position no column has."""
    known = max(c.position for c in columns) + 1
    return F.exists(
        after_images(F.col("event_type"), F.col("rows")), lambda row: F.size(row) > known
    )


def _bound(events: DataFrame, columns: Sequence[Column], keep: Sequence[str]) -> DataFrame:
    """Rows of events of a known width, with typed columns beside the raw row."""
    return explode_rows(events.where(~too_wide(columns)), keep).select(
        *keep,
        "row_idx",
        "op",
        "row",
        *[
            F.get("row", F.lit(c.position)).try_cast(spark_type(c.type)).alias(c.name)
            for c in columns
        ],
    )


def _misfits(columns: Sequence[Column]) -> SparkColumn:
    """Names of the columns whose value is not of their type."""
    def misfit(c: Column) -> SparkColumn:
        text = F.get("row", F.lit(c.position))
        lost = text.isNotNull() & F.col(c.name).isNull()
        return lost & ~text.rlike(ZERO_DATE) if isinstance(spark_type(c.type), DATES) else lost

    failed = [
        F.when(misfit(c), c.name) for c in columns if spark_type(c.type).typeName() != "string"
    ]
    return F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")


def rows_to_records(
    events: DataFrame, columns: Sequence[Column], keep: Sequence[str] = ("logfile", "logpos")
) -> DataFrame:
    """Positional values to typed named columns.

    One bad row loses its whole event, so an event with a row wider than the
    schema is left out here and reported by ``record_rejects``; so is a row with a
    value that is not of its column's type.  A shorter row lacks its last columns:
    they are null and missing from ``present``.
    """
    ordered = sorted(columns, key=lambda c: c.position)
    names = F.array(*[F.lit(c.name) for c in ordered])
    return (
        _bound(events, ordered, keep)
        .where(F.size(_misfits(ordered)) == 0)
        .select(
            *keep,
            "row_idx",
            "op",
            *[c.name for c in ordered],
            F.slice(names, F.lit(1), F.size("row")).alias("present"),
        )
    )


def record_rejects(events: DataFrame, columns: Sequence[Column]) -> DataFrame:
    """What ``rows_to_records`` leaves out, with the reason: whole events with a
    row that is too wide, and single rows with values of the wrong type."""
    ordered = sorted(columns, key=lambda c: c.position)
    # The first value that is too many stands behind the last known column.
    wide = events.where(too_wide(ordered)).withColumn(
        "reason", F.lit(f"the value at position {len(ordered)} belongs to no column")
    )
    keep = [c for c in events.columns if c != "rows"]
    # One struct for the event, as a table may have columns named like its fields.
    bound = _bound(events.withColumn("_event", F.struct(*keep)), ordered, ["_event"])
    rows = bound.select("_event", "row", _misfits(ordered).alias("_bad"))
    rows = rows.where(F.size("_bad") > 0).select(
        "_event.*",
        F.array("row").alias("rows"),
        F.concat(F.lit("values do not fit: "), F.array_join("_bad", ", ")).alias("reason"),
    )
    return wide.unionByName(rows)


def column_at(columns: Sequence[Column], position: SparkColumn) -> SparkColumn:
    """Name of the column at a position of a table whose columns are known here."""
    names = F.create_map(*[x for c in columns for x in (F.lit(c.position), F.lit(c.name))])
    return F.try_element_at(names, position)


def column_by_position(values: DataFrame, catalog: DataFrame) -> DataFrame:
    """Bind positional values of many tables to their catalog columns.

    Values at unknown positions stay, with a null name.  No broadcast is forced:
    the catalog grows with the number of tables, so Spark picks by its real size.
    """
    return values.join(catalog, ["tbl", "position"], "left")


def pk_change(pairs: DataFrame, key: Sequence[str]) -> DataFrame:
    """Updates that change the key, given ``before`` and ``after`` structs."""
    moved = [~F.col(f"before.{k}").eqNullSafe(F.col(f"after.{k}")) for k in key]
    changed = moved[0]
    for m in moved[1:]:
        changed = changed | m
    return pairs.where(changed)


def update_pairs(events: DataFrame, columns: Sequence[Column], keep: Sequence[str]) -> DataFrame:
    """Typed before and after images of update events, one line per pair."""
    ordered = sorted(columns, key=lambda c: c.position)

    def image(row: SparkColumn) -> SparkColumn:
        return F.struct(
            *[
                F.get(row, F.lit(c.position)).try_cast(spark_type(c.type)).alias(c.name)
                for c in ordered
            ]
        )

    updates = events.where(classify_op(F.col("event_type")) == UPDATE)
    pairs = F.transform(
        F.sequence(F.lit(0), F.floor(F.size("rows") / 2).cast("int") - 1),
        lambda i: F.struct(F.get("rows", i * 2).alias("b"), F.get("rows", i * 2 + 1).alias("a")),
    )
    return (
        updates.where(F.size("rows") > 1)
        .select(*keep, F.posexplode(pairs).alias("row_idx", "pair"))
        .select(
            *keep, "row_idx", image(F.col("pair.b")).alias("before"), image(F.col("pair.a")).alias("after")
        )
    )


def move_changed_keys(pairs: DataFrame, key: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Change rows in which a key-changing update deletes the old document and
    inserts the new one.  Each pair takes two row indexes, delete first."""
    same = F.lit(True)
    for k in key:
        same = same & F.col(f"before.{k}").eqNullSafe(F.col(f"after.{k}"))
    step = lambda op, image, offset: F.struct(
        F.lit(op).alias("op"), F.lit(offset).alias("offset"), F.col(image).alias("doc")
    )
    steps = F.when(same, F.array(step(UPDATE, "after", 0))).otherwise(
        F.array(step(DELETE, "before", 0), step(INSERT, "after", 1))
    )
    return pairs.select(*keep, "row_idx", F.explode(steps).alias("step")).select(
        *keep,
        (F.col("row_idx") * 2 + F.col("step.offset")).alias("row_idx"),
        F.col("step.op").alias("op"),
        "step.doc.*",
    )


def mark_accepted(rows: DataFrame, fault: SparkColumn, group: Sequence[str]) -> DataFrame:
    """Add ``accepted``: false on every row of a group that has a fault anywhere.

    Faulty groups are made distinct before they are joined, and rows are only on
    the left side, so a group of any size is split by adaptive skew handling.
    """
    faulty = rows.where(fault).select(*group).distinct().withColumn("_faulty", F.lit(True))
    return rows.join(faulty, list(group), "left").select(
        *rows.columns, F.col("_faulty").isNull().alias("accepted")
    )


def missing_key_reject(records: DataFrame, batch: Sequence[str]) -> DataFrame:
    """Mark records: one empty id rejects its whole batch."""
    return mark_accepted(records, F.coalesce(F.col("_id"), F.lit("")) == "", batch)


def enum_reject(catalog: DataFrame) -> DataFrame:
    """Mark catalog columns: a table with an enum column is rejected as a whole."""
    return mark_accepted(catalog, F.contains(F.lower("type"), F.lit("enum")), ["tbl"])
