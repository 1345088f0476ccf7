"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefold.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang the larger neighbours of each node on its smallest neighbour."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return (
        both.where(F.col("b") > F.col("a"))
        .join(least, "a")
        .select(F.col("m").alias("a"), "b")
        .where("a < b")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang each node and its smaller neighbours on the smallest of them."""
    down = edges.select(F.col("b").alias("n"), F.col("a").alias("s"))
    least = down.groupBy("n").agg(F.min("s").alias("m"))
    moved = down.join(least, "n").select("n", "s", "m")
    pairs = moved.select(F.col("m").alias("a"), F.col("s").alias("b")).union(
        least.select(F.col("m").alias("a"), F.col("n").alias("b"))
    )
    return pairs.where("a < b").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, root): each node of the links (a, b) with the smallest node it reaches.

    Minima are combined before each shuffle, so a node with very many links is no hot
    task.  Each round is written to the shared folder.  No links give no rows.
    """
    both = edges.where("a <> b")
    now = stored(
        both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "links",
    )
    while not now.isEmpty():
        # Done when every larger end has one smaller end and no root hangs anywhere.
        joined = now.groupBy("b").agg(F.count(F.lit(1)).alias("n"))
        roots = now.select("a").distinct()
        open_ = joined.join(roots, joined["b"] == roots["a"], "left").where(
            "n > 1 or a is not null"
        )
        if open_.isEmpty():
            break
        now = stored(_small_star(_large_star(now)), "links")
    return (
        now.select(F.col("b").alias("node"), F.col("a").alias("root"))
        .union(now.select("a", "a"))
        .distinct()
    )
