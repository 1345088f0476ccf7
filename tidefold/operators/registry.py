"""Table registry kept as an append-only log of writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefold.model import REGISTRY_SCHEMA, STATUSES
from tidefold.operators.ordering import carry_forward

FIELDS = ("status", "columns", "binlog_pos", "dump_read_progress")

# Moves a table may make.  Every phase is entered from the one
# before it; a restart repeats the phase it was in, and dumping starts over.
LEGAL_MOVES = (
    *zip(STATUSES, STATUSES[1:]),
    ("created", "created"),
    ("dumping", "created"),
    ("moving", "moving"),
)
# End of fixed values.


def registry_upsert(log: DataFrame, fields: Sequence[str] = FIELDS, name: str = "name") -> DataFrame:
    """Current registry: each field's last value that was set."""
    return log.groupBy(name).agg(
        *[
            F.max(F.when(F.col(f).isNotNull(), F.struct("seq", F.col(f).alias("v"))))["v"].alias(f)
            for f in fields
        ]
    )


def register_tables(
    registry: DataFrame, wanted: DataFrame, name: str = "name", status: str = "status"
) -> DataFrame:
    """The registry plus the wanted tables it does not know, in first status."""
    new = wanted.select(name).distinct().join(registry, name, "left_anti")
    return registry.unionByName(new.withColumn(status, F.lit(STATUSES[0])), allowMissingColumns=True)


def status_transitions(
    log: DataFrame,
    bucket_size: int = 65536,
    buckets_per_block: int = 4096,
) -> DataFrame:
    """Each status write with the status before it and whether the move is legal.

    A table's first status must be the first of the path.
    """
    bucket = F.floor(F.col("seq") / F.lit(bucket_size))
    moves = carry_forward(
        log,
        value=F.col("status"),
        into="previous",
        order=["seq"],
        bucket=bucket,
        block=F.floor(bucket / F.lit(buckets_per_block)),
        keys=["tbl"],
        inclusive=False,
    )
    legal = [F.lit(f"{a}>{b}") for a, b in LEGAL_MOVES]
    move = F.concat_ws(">", "previous", "status")
    return moves.withColumn(
        "legal",
        F.when(F.col("previous").isNull(), F.col("status") == STATUSES[0]).otherwise(move.isin(legal)),
    )


def resume_phase(status: str) -> str:
    """The status a table goes on from after a restart."""
    return STATUSES[0] if status == "dumping" else status


def append_registry(spark: SparkSession, path: str, writes: list[dict]) -> None:
    """Append registry writes; ``seq`` orders them."""
    rows = [tuple(w.get(f.name) for f in REGISTRY_SCHEMA.fields) for w in writes]
    spark.createDataFrame(rows, REGISTRY_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def table_status(registry: DataFrame, table: str, name: str = "name") -> str:
    """Status of one table; unknown names are an error."""
    row = registry.where(F.col(name) == table).select("status").first()
    if row is None:
        raise KeyError(f'table "{table}" not found')
    return row["status"]
