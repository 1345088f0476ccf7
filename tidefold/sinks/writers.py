"""Batch sinks: change log, bulk text and JDBC.

A sink is called with a batch of change rows and the batch id.  Calling it again
with the same batch overwrites what the first call wrote, or is harmless.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefold.functions.keys import render_pk
from tidefold.model import COLUMN_SCHEMA, Column, Followed
from tidefold.operators import tables
from tidefold.operators.documents import bulk_lines, document, index_mapping
from tidefold.operators.fold import fold_state, merge_state, merged_actions, net_actions


def net_changes(changes: DataFrame, key: Sequence[str], doc: Sequence[str]) -> DataFrame:
    """One action per key: key, op, document columns and, when changes may carry
    some columns only, ``present``."""
    if "present" in changes.columns:
        return merged_actions(merge_state(changes, key, doc), key, doc)
    return net_actions(fold_state(changes, key, doc), key).select(*key, "op", "doc.*")


@dataclass(frozen=True)
class ChangeLogSink:
    """Every change as it came, in parquet."""

    path: str

    def __call__(self, changes: DataFrame, batch_id: int) -> None:
        changes.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")


@dataclass(frozen=True)
class BulkTextSink:
    """Bulk request text for a search index.

    The batch is first folded to one action per key.  The lines of a batch then
    need no order among each other, so they are written by any number of tasks,
    and a hot key is one line.
    """

    path: str
    index: str
    key: Sequence[str]
    doc: Sequence[str]

    def __call__(self, changes: DataFrame, batch_id: int) -> None:
        actions = net_changes(changes, self.key, self.doc)
        present = "present" if "present" in actions.columns else None
        actions = actions.withColumn("_id", render_pk(actions, self.key))
        # An empty id would let the index make one up; such a batch is refused.
        empty = F.raise_error(F.lit("a document without an id")).cast("boolean")
        actions = actions.where(F.when(F.col("_id") != "", True).otherwise(empty))
        # A search document holds the key columns, too.
        if present:
            key = F.array(*[F.lit(k) for k in self.key])
            actions = actions.withColumn(present, F.concat(key, present))
        body = document([*self.key, *self.doc], present)
        lines = actions.select(bulk_lines(F.lit(self.index), body).alias("value"))
        lines.write.mode("overwrite").text(f"{self.path}/bulk/batch_id={batch_id}")

    def on_table_init(self, spark: SparkSession, table: str, columns: Sequence[Column]) -> None:
        """Write the mapping of the index beside its text; one that exists stays."""
        if not columns:
            raise ValueError(f"{table} needs at least one column")
        catalog = spark.createDataFrame([tuple(vars(c).values()) for c in columns], COLUMN_SCHEMA)
        mapping = index_mapping(catalog.withColumn("tbl", F.lit(table))).select("mapping")
        mapping.coalesce(1).write.mode("ignore").text(f"{self.path}/mapping")


@dataclass(frozen=True)
class TablesLogSink:
    """Every change of all tables as it came, in parquet, a folder for each table."""

    path: str

    def __call__(self, changes: DataFrame, batch_id: int) -> None:
        _of_batch(changes, batch_id).partitionBy("tbl").parquet(f"{self.path}/batch_id={batch_id}")


@dataclass(frozen=True)
class TablesBulkSink:
    """As ``BulkTextSink``, for changes of many tables at once (see ``operators.tables``): an
    index for each table, and a batch is one job whatever their number."""

    path: str
    tables: Sequence[Followed]

    def __call__(self, changes: DataFrame, batch_id: int) -> None:
        catalog = tables.catalog_of(changes.sparkSession, "", self.tables)
        actions = tables.table_actions(tables.fold_tables(changes, 1))
        lines = tables.action_lines(actions, catalog, tables.kinds_in(self.tables))
        _of_batch(lines, batch_id).partitionBy("tbl").text(f"{self.path}/bulk/batch_id={batch_id}")

    def on_table_init(self, spark: SparkSession, table: str, columns: Sequence[Column]) -> None:
        BulkTextSink(f"{self.path}/index/{table}", table, [], []).on_table_init(spark, table, columns)


def _of_batch(rows: DataFrame, batch_id: int):
    """A writer that replaces a batch.  What does not come from the stream has a negative id
    and may come again for other tables, whose folders stay."""
    mode = "dynamic" if batch_id < 0 else "static"
    return rows.write.mode("overwrite").option("partitionOverwriteMode", mode)


@dataclass(frozen=True)
class JdbcSink:
    """Net actions of each batch appended to a database table, which the database
    merges by key.  Needs a driver on the class path."""

    url: str
    table: str
    key: Sequence[str]
    doc: Sequence[str]
    options: Mapping[str, str] = field(default_factory=dict)

    def __call__(self, changes: DataFrame, batch_id: int) -> None:
        actions = net_changes(changes, self.key, self.doc).withColumn("batch_id", F.lit(batch_id))
        if "present" in actions.columns:
            actions = actions.withColumn("present", F.array_join("present", ","))
        (
            actions.write.format("jdbc")
            .options(**self.options)
            .options(url=self.url, dbtable=self.table)
            .mode("append")
            .save()
        )


@dataclass(frozen=True)
class ConnectorSink:
    """Net actions through an index connector, when its package is installed;
    ``fmt`` is the format name the connector registers."""

    index: str
    key: Sequence[str]
    doc: Sequence[str]
    fmt: str
    options: Mapping[str, str] = field(default_factory=dict)

    def __call__(self, changes: DataFrame, batch_id: int) -> None:
        actions = net_changes(changes, self.key, self.doc).drop("present")
        actions = actions.withColumn("_id", render_pk(actions, self.key)).persist()
        try:
            for op, how in (("insert", "index"), ("update", "update"), ("delete", "delete")):
                (
                    actions.where(F.col("op") == op)
                    .select("_id", *self.key, *self.doc)
                    .write.format(self.fmt)
                    .options(**self.options)
                    .options(**{"es.mapping.id": "_id", "es.mapping.exclude": "_id"})
                    .option("es.write.operation", how)
                    .mode("append")
                    .save(self.index)
                )
        finally:
            actions.unpersist()
