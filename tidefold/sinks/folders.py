"""Folders of the shared store: which there are, and taking away those nobody needs."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    made = spark._jvm.org.apache.hadoop.fs.Path(path)
    return made, made.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    at, files = _path(spark, path)
    return files.exists(at)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names right below a folder that do not begin with ``_`` or ``.``; none if it is absent."""
    at, files = _path(spark, path)
    if not files.exists(at):
        return []
    names = [status.getPath().getName() for status in files.listStatus(at)]
    return sorted(n for n in names if n[0] not in "_.")


def delete(spark: SparkSession, path: str) -> None:
    """Take away a file or folder with all below it; one that is absent is no error."""
    at, files = _path(spark, path)
    files.delete(at, True)


def named(spark: SparkSession, column: str, value: str) -> str:
    """The folder name Spark gives a partition value."""
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return f"{column}={utils.escapePathName(value)}"


def value(spark: SparkSession, name: str) -> str:
    """The partition value a folder name stands for, given without its column."""
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(name)
