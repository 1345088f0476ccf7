"""The current log file, carried from batch to batch of a stream.

Row events carry no file name: they belong to the file that the latest rotate event of
their source named.  A batch may hold no such event, so the last name is kept beside the
stream: one row a source for each batch, read by the next.  A batch that runs again reads
the same row as before and writes the same.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefold.model import ROTATE_EVENT
from tidefold.operators.ordering import carry_forward
from tidefold.sinks import folders
from tidefold.sinks.fanout import Sink


@dataclass(frozen=True)
class RotateAttribution:
    """Gives the events of a stream their log file and hands them to ``sink``.

    Events have ``kind``, ``next_log`` and ``ord``, their place in the order of their source,
    which the column ``source`` names if there are several.  ``start_file`` is the file a
    source was opened at.  ``keep`` batches of carried names are kept.
    """

    path: str
    sink: Sink
    start_file: str | None = None
    source: str | None = None
    bucket_size: int = 65536
    buckets_per_block: int = 4096
    keep: int = 4

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        source = F.col(self.source) if self.source else F.lit("").cast("string")
        named = F.coalesce(source.cast("string"), F.lit(""))
        before = self._before(spark, batch_id)
        batch.persist()
        try:
            events = batch.withColumn("_source", named)
            bucket = F.floor(F.col("ord") / F.lit(self.bucket_size))
            seen = carry_forward(
                events,
                value=F.when(F.col("kind") == ROTATE_EVENT, F.col("next_log")),
                into="_file",
                order=["ord"],
                bucket=bucket,
                block=F.floor(bucket / F.lit(self.buckets_per_block)),
                keys=["_source"],
            )
            # One row a source: joined by its real size.
            rows = seen.join(before, "_source", "left").select(
                *batch.columns, F.coalesce("_file", "_carried", F.lit(self.start_file)).alias("logfile")
            )
            self.sink(rows, batch_id)
            last = events.where(F.col("kind") == ROTATE_EVENT).groupBy("_source").agg(
                F.max_by("next_log", "ord").alias("_last")
            )
            carried = before.join(last, "_source", "full_outer").select(
                "_source", F.coalesce("_last", "_carried").alias("_carried")
            )
            carried.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")
        finally:
            batch.unpersist()
        for old in self._batches(spark)[: -self.keep]:
            folders.delete(spark, f"{self.path}/batch_id={old}")

    def _batches(self, spark: SparkSession) -> list[int]:
        return sorted(int(b.removeprefix("batch_id=")) for b in folders.children(spark, self.path))

    def _before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """What the batch before this one left, whatever later ones a repeat has."""
        known = [b for b in self._batches(spark) if b < batch_id]
        schema = "_source string, _carried string"
        if not known:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(f"{self.path}/batch_id={known[-1]}")
