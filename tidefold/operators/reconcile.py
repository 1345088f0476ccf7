"""Source against target: presence, column differences, summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefold.functions.keys import generate_pk
from tidefold.functions.values import INTEGRAL, NUMERIC, lenient_equal, printed
from tidefold.model import Column as SourceColumn

VERIFIED, MISMATCH, MISSING, TARGET_ONLY = "verified", "mismatch", "missing", "target_only"


def paired(
    source: DataFrame, target: DataFrame, key: Sequence[str], how: str = "left"
) -> DataFrame:
    """Source and target rows of the same key side by side.

    Columns become s_<name> and t_<name>; rows whose key cannot be built are
    skipped.  Keys are unique on both sides, so one key is one pair.
    """
    buildable = F.lit(True)
    for k in key:
        buildable = buildable & F.col(k).isNotNull()
    rename = lambda df, side: df.where(buildable).select(
        *key,
        *[F.col(c).alias(f"{side}_{c}") for c in df.columns if c not in key],
        F.lit(True).alias(f"{side}_found"),
    )
    return rename(source, "s").join(rename(target, "t"), list(key), how)


def reconcile(
    source: DataFrame,
    target: DataFrame,
    key: Sequence[str],
    columns: Sequence[str],
    target_only: bool = False,
) -> DataFrame:
    """Status of each key: verified, mismatch, missing, and optionally target_only.

    ``is_missing`` counts mismatches with the missing, as the verifier does.
    """
    pairs = paired(source, target, key, "full_outer" if target_only else "left")
    same = F.lit(True)
    for c in columns:
        same = same & lenient_equal(pairs, f"s_{c}", f"t_{c}")
    status = (
        F.when(F.col("s_found").isNull(), TARGET_ONLY)
        .when(F.col("t_found").isNull(), MISSING)
        .when(same, VERIFIED)
        .otherwise(MISMATCH)
    )
    return pairs.select(*key, status.alias("status")).withColumn(
        "is_missing", F.col("status").isin(MISSING, MISMATCH)
    )


def _alike(df: DataFrame, name: str, other: T.DataType) -> Column:
    """A column's value in a form that is equal on both sides only if ``lenient_equal`` holds;
    ``other`` is its type on the other side."""
    kind = df.schema[name].dataType
    if kind == other:
        return F.col(name)
    if isinstance(kind, INTEGRAL) and isinstance(other, INTEGRAL):
        return F.col(name).cast("bigint")
    if isinstance(kind, NUMERIC) and isinstance(other, NUMERIC):
        # Wide decimals lose digits here; they are told apart by their text as well.
        return F.struct(F.col(name).cast("double"), printed(df, name))
    return F.struct(printed(df, name), F.lit(""))


def bucket_digests(
    rows: DataFrame, key: Sequence[str], columns: Mapping[str, T.DataType], buckets: int
) -> DataFrame:
    """(bucket, n, x, s): count, xor and sum of row hashes for each bucket of keys.

    Neither depends on the order of rows, and both are made on the map side first, so what
    is moved is one line a bucket and task.
    """
    # A hash passes over nulls, so where they stand is hashed as well.
    nulls = F.concat(F.lit(""), *[F.col(c).isNull().cast("int").cast("string") for c in columns])
    row = F.xxhash64(*key, nulls, *[_alike(rows, c, other) for c, other in columns.items()])
    second = F.pmod(F.xxhash64(row, F.lit(1)), F.lit(1 << 40)).cast("decimal(38,0)")
    return (
        rows.select(_bucket(key, buckets).alias("bucket"), row.alias("row"), second.alias("second"))
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("n"), F.bit_xor("row").alias("x"), F.sum("second").alias("s"))
    )


def _bucket(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets))


def reconcile_by_digest(
    source: DataFrame,
    target: DataFrame,
    key: Sequence[str],
    columns: Sequence[str],
    buckets: int = 4096,
    target_only: bool = False,
) -> DataFrame:
    """As ``reconcile``, moving only rows of buckets that differ.

    Buckets with equal digests on both sides are verified where they lie.  Take as many
    buckets as the sides have some thousand rows each, so that few differences leave most
    buckets alone.  Keys have the same types on both sides.
    """
    buildable = F.lit(True)
    for k in key:
        buildable = buildable & F.col(k).isNotNull()
    source, target = (df.where(buildable).select(*key, *columns) for df in (source, target))
    ours, theirs = (
        bucket_digests(a, key, {c: b.schema[c].dataType for c in columns}, buckets)
        for a, b in ((source, target), (target, source))
    )
    both = ours.join(theirs.toDF("bucket", "tn", "tx", "ts"), "bucket", "full_outer")
    same = F.col("n").eqNullSafe(F.col("tn")) & F.col("x").eqNullSafe(F.col("tx")) & F.col("s").eqNullSafe(F.col("ts"))
    # A line a bucket at most; joined by its real size.
    differing = both.where(~same).select("bucket")
    part = lambda df, how: df.withColumn("bucket", _bucket(key, buckets)).join(differing, "bucket", how).drop("bucket")
    equal = part(source, "left_anti").select(*key, F.lit(VERIFIED).alias("status"), F.lit(False).alias("is_missing"))
    apart = reconcile(part(source, "left_semi"), part(target, "left_semi"), key, columns, target_only)
    return equal.unionByName(apart)


def reconcile_by_id(
    source: DataFrame,
    target: DataFrame,
    layout: Sequence[SourceColumn],
    columns: Sequence[str],
    id_col: str = "_id",
    buckets: int = 4096,
) -> DataFrame:
    """Each source row against the document with its rendered id, as the verifier does.

    ``layout`` names the source's key columns by position, and ``target`` has documents with
    ``id_col``.  Rows whose id cannot be built are skipped.  An id of several columns may
    stand for several keys: ``collides`` says so, and at most one of those keys can be
    verified, as they share a document.
    """
    key = [c.name for c in sorted(layout, key=lambda c: c.position) if c.is_in_primary_key]
    buildable = F.lit(True)
    for k in key:
        buildable = buildable & F.col(k).isNotNull()
    named = source.where(buildable).withColumn(id_col, generate_pk(source, layout))
    kept = [id_col, *dict.fromkeys([*key, *columns])]
    if len(key) > 1:
        # Only ids are moved to find those that more than one key has.
        several = pk_collisions_of(named.select(id_col, *key), id_col).withColumn("collides", F.lit(True))
    else:
        several = named.sparkSession.createDataFrame([], "collides boolean").select(
            F.lit(None).cast(named.schema[id_col].dataType).alias(id_col), "collides"
        )
    marked = named.select(*kept).join(several, id_col, "left").withColumn("collides", F.coalesce("collides", F.lit(False)))
    single = marked.where("not collides")
    found = reconcile_by_digest(single.select(id_col, *columns), target, [id_col], columns, buckets)
    # Few rows: those of colliding ids, which a digest by id cannot tell apart.
    shared = marked.where("collides")
    pairs = shared.select(id_col, *[F.col(k).alias(f"k_{k}") for k in key], *[F.col(c).alias(f"s_{c}") for c in columns]).join(
        target.select(id_col, *[F.col(c).alias(f"t_{c}") for c in columns], F.lit(True).alias("t_found")), id_col, "left"
    )
    same = F.lit(True)
    for c in columns:
        same = same & lenient_equal(pairs, f"s_{c}", f"t_{c}")
    status = F.when(F.col("t_found").isNull(), MISSING).when(same, VERIFIED).otherwise(MISMATCH)
    colliding = pairs.select(id_col, status.alias("status"), F.lit(True).alias("collides"))
    colliding = colliding.withColumn("is_missing", F.col("status").isin(MISSING, MISMATCH))
    return found.withColumn("collides", F.lit(False)).unionByName(colliding)


def pk_collisions_of(named: DataFrame, id_col: str) -> DataFrame:
    """Ids that more than one row has, given rows of different keys."""
    return named.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(id_col)


def reconcile_summary(statuses: DataFrame) -> DataFrame:
    """Counts per table and status, per table, and over everything (nulls mark
    the totals)."""
    return statuses.rollup("tbl", "status").agg(F.count(F.lit(1)).alias("n_rows"))


def doc_diff(
    source: DataFrame,
    target: DataFrame,
    key: Sequence[str],
    columns: Sequence[str],
    present: str | None = None,
) -> DataFrame:
    """One row per differing column of the keys found on both sides.

    With ``present``, a column of both sides that lists the fields a document has, a field
    that one document lacks differs although its column is null: ``reason`` tells ``lacking``
    (the target's document has no such field), ``extra`` (the source's has none) and ``value``.
    """
    pairs = paired(source, target, key, "inner")
    differs = {c: ~lenient_equal(pairs, f"s_{c}", f"t_{c}") for c in columns}
    reasons = {}
    if present:
        for c in columns:
            ours, theirs = (F.coalesce(F.array_contains(f"{side}_{present}", c), F.lit(False)) for side in "st")
            reasons[c] = (
                F.when(ours & ~theirs, "lacking")
                .when(~ours & theirs, "extra")
                .when(ours & theirs & differs[c], "value")
            )
            differs[c] = reasons[c].isNotNull()
    anything = F.lit(False)
    for c in columns:
        anything = anything | differs[c]
    differences = [
        F.when(
            differs[c],
            F.struct(
                F.lit(c).alias("column_name"),
                *([reasons[c].alias("reason")] if present else []),
                printed(pairs, f"s_{c}").alias("source_value"),
                printed(pairs, f"t_{c}").alias("target_value"),
            ),
        )
        for c in columns
    ]
    return (
        pairs.where(anything)
        .select(*key, F.explode(F.array(*differences)).alias("d"))
        .where("d is not null")
        .select(*key, "d.*")
    )


def key_diff(source_columns: Sequence[str], target_columns: Sequence[str]) -> tuple[list, list]:
    """Columns only the target has, and columns only the source has."""
    source, target = set(source_columns), set(target_columns)
    return sorted(target - source), sorted(source - target)
