"""Table sources: files, catalog and JDBC; full scans, inventories, snapshots."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefold.model import INSERT, Position


def scan_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Every row and column of one table; later filters and projections reach the scan."""
    return spark.read.parquet(f"{root}/{name}.parquet")


def scan_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower: int,
    upper: int,
    partitions: int,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Full scan of a database table, read by ranges of a numeric key."""
    return (
        spark.read.format("jdbc")
        .options(**(options or {}))
        .options(url=url, dbtable=table, partitionColumn=partition_column)
        .options(lowerBound=str(lower), upperBound=str(upper), numPartitions=str(partitions))
        .option("fetchsize", "10000")
        .load()
    )


def table_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Name and row count of every table below ``root``, empty tables included.

    A table is a parquet file, or a folder of such files, of any name, right below
    ``root``; it is named by that file or folder without ``.parquet``.  Names come from a
    file listing whose contents are not read; counts read no column, so they are answered
    from file metadata.
    """
    top = root.rstrip("/").rsplit("/", 1)[-1]
    # What follows the root: paths are made absolute, so its last name is looked for.
    below = F.regexp_extract("path", rf"^.*/{re.escape(top)}/(.*)$", 1)
    name = F.regexp_replace(F.regexp_extract(below, r"^([^/]+)", 1), r"\.parquet$", "")
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(root)
        .select(name.alias("name"))
        .distinct()
    )
    counted = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .parquet(root)
        .select(F.col("_metadata.file_path").alias("path"))
        .groupBy("path")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(name.alias("name"))
        .agg(F.sum("n").alias("n_rows"))
    )
    return listed.join(counted, "name", "left").select(
        "name", F.coalesce("n_rows", F.lit(0)).alias("n_rows")
    )


def catalog_inventory(spark: SparkSession, database: str | None = None) -> list[str]:
    """Table names of a catalog database."""
    return [t.name for t in spark.catalog.listTables(database)]


def snapshot(table: DataFrame, taken_at: Position) -> DataFrame:
    """A table's rows as inserts at the log position the snapshot was taken at."""
    return table.select(
        "*",
        F.lit(taken_at.logfile).alias("logfile"),
        F.lit(taken_at.logpos).cast("bigint").alias("logpos"),
        F.lit(0).alias("row_idx"),
        F.lit(INSERT).alias("op"),
    )
