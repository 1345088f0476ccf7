"""Updates of a stream that hit a key which does not exist at that moment.

Inside a batch the last insert or delete before an update tells; for updates that have
none before them in the batch, the state of the batches before tells.  Of that state only
the buckets are read that such updates fall into, and of those only what tells whether a
key lives.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefold.functions.positions import file_number
from tidefold.model import DELETE, SEQ, UPDATE
from tidefold.operators.ordering import carry_forward
from tidefold.operators.tables import bucket_of
from tidefold.sinks.tables import TablesStore


@dataclass(frozen=True)
class DroppedUpdates:
    """Writes the dropped updates of each batch of changes (see ``operators.tables``) below
    ``path``, then the batch to ``store``.

    A batch that runs again finds the state as it was before it, so it reports the same.
    """

    path: str
    store: TablesStore
    bucket_bytes: int = 1 << 26

    def __call__(self, changes: DataFrame, batch_id: int) -> None:
        changes.persist()
        try:
            found = self.dropped(changes, batch_id)
            found.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")
            self.store.write(changes, batch_id)
        finally:
            changes.unpersist()

    def dropped(self, changes: DataFrame, batch_id: int) -> DataFrame:
        columns = changes.columns
        seen = carry_forward(
            changes.withColumn("bucket", bucket_of(self.store.buckets)),
            value=F.when(F.col("op") != UPDATE, F.col("op")),
            into="_before",
            order=SEQ,
            bucket=F.floor(F.col("logpos") / F.lit(self.bucket_bytes)),
            block=F.struct(file_number(), "logfile"),
            keys=["tbl", "key"],
            inclusive=False,
        ).where(F.col("op") == UPDATE)
        # Keys whose first changes in the batch are updates: the state must tell.
        open_ = seen.where("_before is null").select("tbl", "bucket", "key").distinct()
        places = open_.select("tbl", "bucket").distinct().collect()  # tables by buckets at most
        state = self.store.boundaries(
            changes.sparkSession, [(r["tbl"], r["bucket"]) for r in places], batch_id - 1
        )
        live = open_.join(state, ["tbl", "key"]).select("tbl", "key", F.col("boundary.op").alias("_held"))
        told = seen.join(live, ["tbl", "key"], "left")
        before = F.coalesce("_before", "_held", F.lit(DELETE))
        return told.where(before == DELETE).select(*columns)
