"""Keyed target kept as partial folds in parquet.

Each micro-batch writes the fold of its own changes to the folder of its batch
id.  Reading folds the pieces together.  A retried batch overwrites its folder,
and a piece that is read twice changes nothing, so no transaction log is needed.
``compact`` replaces many pieces by one; tombstones stay, because a replayed old
insert must not revive a deleted key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefold.operators.fold import (
    combine_merge_states,
    combine_states,
    fold_state,
    live_rows,
    merge_state,
    merged_rows,
)

_COMPACTED = T.StructType(
    [T.StructField("through", T.LongType()), T.StructField("base", T.StringType())]
)


@dataclass(frozen=True)
class FoldStore:
    path: str
    key: Sequence[str]
    doc: Sequence[str]

    def write(self, changes: DataFrame, batch_id: int) -> None:
        """Fold one batch into its own folder."""
        self.fold(changes).write.mode("overwrite").parquet(f"{self.path}/pieces/batch_id={batch_id}")

    def __call__(self, changes: DataFrame, batch_id: int) -> None:
        self.write(changes, batch_id)

    def fold(self, changes: DataFrame) -> DataFrame:
        return fold_state(changes, self.key, self.doc)

    def combine(self, pieces: DataFrame) -> DataFrame:
        return combine_states(pieces, self.key)

    def documents(self, state: DataFrame) -> DataFrame:
        return live_rows(state, self.key)

    def state(self, spark: SparkSession) -> DataFrame:
        """Combined state of all pieces, one row per key, deleted keys included."""
        return self.combine(self._pieces(spark))

    def current(self, spark: SparkSession) -> DataFrame:
        """The documents that exist now."""
        return self.documents(self.state(spark))

    def publish(self, spark: SparkSession, path: str) -> None:
        """Write the current documents for readers that only know parquet."""
        self.current(spark).write.mode("overwrite").parquet(path)

    def compact(self, spark: SparkSession, through: int) -> None:
        """Fold the last base and all pieces up to a batch into a new base.

        The base is announced only after it is written whole.  Pieces stay on
        disk for readers that started earlier; remove them when none is left.
        """
        base = f"{self.path}/bases/through={through}"
        self.combine(self._pieces(spark, through)).write.mode("overwrite").parquet(base)
        announcement = spark.createDataFrame([(through, base)], _COMPACTED)
        announcement.coalesce(1).write.mode("append").parquet(f"{self.path}/compacted")

    def _pieces(self, spark: SparkSession, through: int | None = None) -> DataFrame:
        pieces = spark.read.parquet(f"{self.path}/pieces")
        if through is not None:
            pieces = pieces.where(F.col("batch_id") <= through)
        last = self._last_base(spark)
        if last is None:
            return pieces.drop("batch_id")
        # Folder pruning: pieces the base already holds are not read.
        newer = pieces.where(F.col("batch_id") > last["through"]).drop("batch_id")
        return spark.read.parquet(last["base"]).unionByName(newer)

    def _last_base(self, spark: SparkSession):
        try:
            announced = spark.read.schema(_COMPACTED).parquet(f"{self.path}/compacted")
        except AnalysisException:
            return None  # never compacted
        return announced.orderBy(F.desc("through")).first()


@dataclass(frozen=True)
class MergeStore(FoldStore):
    """The same for changes that may carry some columns only (see ``present``): a
    field that an update lacks keeps its value.  Each column carries its own place
    in the log, so prefer ``FoldStore`` where every change has all columns."""

    def fold(self, changes: DataFrame) -> DataFrame:
        return merge_state(changes, self.key, self.doc)

    def combine(self, pieces: DataFrame) -> DataFrame:
        return combine_merge_states(pieces, self.key, self.doc)

    def documents(self, state: DataFrame) -> DataFrame:
        return merged_rows(state, self.key, self.doc).drop("present")
