"""Hand each batch to several sinks; one that fails does not stop the others."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidefold.model import Column
from tidefold.sinks import folders

log = logging.getLogger(__name__)

Sink = Callable[[DataFrame, int], None]

DELIVERY_SCHEMA = T.StructType(
    [
        T.StructField("sink", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("error", T.StringType()),
    ]
)


@dataclass(frozen=True)
class FanOut:
    """Active sinks by name.

    A sink is called with a batch and its id.  It may have ``on_table_init(spark,
    table, columns)``, called before a table's first rows, and ``close()``.

    Each sink gets its batches in the order of the log.  A batch that a sink fails on is
    kept below ``dead_letters``, with the error beside it, and so are the batches after it
    until the sink takes the first: an older batch never comes after a newer one, which
    would undo it.  Every call tries what is kept first, and ``retry`` does so at any time.
    Other sinks go on.

    Without that folder the failure is raised after all sinks ran, so a stream repeats the
    batch; sinks stand repeats of the last batch they got.
    """

    sinks: Mapping[str, Sink]
    dead_letters: str | None = None
    # The last delivery of each sink, for callers in the same process.
    outcome: dict = field(default_factory=dict)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if len(self.sinks) > 1:
            batch.persist()
        failures = {}
        try:
            for name, sink in self.sinks.items():
                try:
                    if self.dead_letters:
                        self._drain(spark, name, batch_id - 1)
                    sink(batch, batch_id)
                    if self.dead_letters:
                        folders.delete(spark, self._kept(name, batch_id))
                except Exception as error:  # any sink may fail in its own way
                    log.error("sink %s failed on batch %d: %s", name, batch_id, error)
                    failures[name] = error
                self.outcome[name] = failures.get(name)
            if failures and self.dead_letters:
                for name in failures:
                    batch.write.mode("overwrite").parquet(self._kept(name, batch_id))
                report = [(n, batch_id, str(e)) for n, e in failures.items()]
                spark.createDataFrame(report, DELIVERY_SCHEMA).coalesce(1).write.mode(
                    "overwrite"
                ).parquet(f"{self.dead_letters}/errors/batch={batch_id}")
            elif failures:
                report = "; ".join(f"{n}: {e}" for n, e in failures.items())
                raise RuntimeError(f"sinks failed: {report}") from next(iter(failures.values()))
        finally:
            batch.unpersist()

    def _kept(self, name: str, batch_id: int) -> str:
        return f"{self.dead_letters}/rows/sink={name}/batch_id={batch_id}"

    def pending(self, spark: SparkSession, name: str) -> list[int]:
        """Batches that are kept for a sink, in order."""
        kept = folders.children(spark, f"{self.dead_letters}/rows/sink={name}")
        return sorted(int(b.removeprefix("batch_id=")) for b in kept)

    def _drain(self, spark: SparkSession, name: str, through: int) -> None:
        for batch_id in self.pending(spark, name):
            if batch_id <= through:
                self.sinks[name](spark.read.parquet(self._kept(name, batch_id)), batch_id)
                folders.delete(spark, self._kept(name, batch_id))

    def init(self, spark: SparkSession, table: str, columns: Sequence[Column]) -> None:
        """Tell sinks about a table before its first rows; a failure is logged only."""
        for name, sink in self.sinks.items():
            try:
                getattr(sink, "on_table_init", lambda *_: None)(spark, table, columns)
            except Exception as error:
                log.error("sink %s could not prepare table %s: %s", name, table, error)

    def close(self) -> None:
        for name, sink in self.sinks.items():
            try:
                getattr(sink, "close", lambda: None)()
            except Exception as error:
                log.error("sink %s could not be closed: %s", name, error)

    def retry(self, spark: SparkSession, name: str, batch_id: int) -> None:
        """Hand a dead letter to its sink again, after all older ones it still waits for."""
        self._drain(spark, name, batch_id)


def activate(available: Mapping[str, Sink], names: list[str]) -> dict[str, Sink]:
    """The named sinks; a name without a sink is an error."""
    unknown = [n for n in names if n not in available]
    if unknown:
        raise ValueError(f"sinks not available: {unknown} (have {sorted(available)})")
    return {n: available[n] for n in names}
