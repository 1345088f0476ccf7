"""Target tables: creation when absent, appends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidefold.functions.types import spark_type
from tidefold.model import Column


def schema_of(columns: Sequence[Column]) -> T.StructType:
    ordered = sorted(columns, key=lambda c: c.position)
    return T.StructType([T.StructField(c.name, spark_type(c.type)) for c in ordered])


def create_if_missing(
    spark: SparkSession, table: str, columns: Sequence[Column], fmt: str = "parquet"
) -> bool:
    """Create a catalog table for the columns; one that exists stays as it is."""
    if not columns:
        raise ValueError(f"{table} needs at least one column")
    if spark.catalog.tableExists(table):
        return False
    spark.catalog.createTable(table, source=fmt, schema=schema_of(columns))
    return True


def tables_to_create(required: DataFrame, existing: DataFrame, name: str = "tbl") -> DataFrame:
    """Required tables the target does not have."""
    return required.select(name).distinct().join(existing.select(name), name, "left_anti")


def append_rows(target: DataFrame, rows: DataFrame) -> DataFrame:
    """The target with new rows; ids come with the rows."""
    return target.unionByName(rows, allowMissingColumns=True)


def write_rows(rows: DataFrame, table: str) -> None:
    """Append rows to a catalog table; appending nothing is an error."""
    if rows.isEmpty():
        raise ValueError(f"there is nothing to append to {table}")
    rows.write.mode("append").insertInto(table)


def save_bucketed(rows: DataFrame, table: str, key: Sequence[str], buckets: int) -> None:
    """Keep a table bucketed and sorted by its key: joins on the key with another
    table bucketed alike, such as reconciliation, then need no shuffle."""
    rows.write.mode("overwrite").bucketBy(buckets, *key).sortBy(*key).saveAsTable(table)
