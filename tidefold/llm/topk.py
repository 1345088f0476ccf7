"""Exact top-k search by inner product, term at a time.

Queries and candidates are cut into blocks of bounded size.  Each pair of blocks is one
group: candidates become posting lists by term (vector position), and each query scatters
its weight times a term's postings into a dense array of scores.  A group keeps the best
few of each query, with ties to the smaller id, and the groups' lists are merged.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Queries scored together, which bounds the dense score array of a task.
TOGETHER = 64


def quantise(vectors: DataFrame, id_col: str, vector_col: str, factor: float) -> DataFrame:
    """(vec_id, terms): floor(factor * x) as longs; rows with unusable vectors are left out."""
    x = F.col("v")
    usable = x.isNotNull() & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    )
    return (
        vectors.select(
            F.col(id_col).cast("long").alias("vec_id"),
            F.col(vector_col).cast("array<double>").alias("v"),
        )
        .where(F.col("vec_id").isNotNull() & F.coalesce(usable, F.lit(False)))
        .select(
            "vec_id", F.transform("v", lambda c: F.floor(c * F.lit(factor)).cast("long")).alias("terms")
        )
    )


def postings(terms: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each term the rows that have it and their weights."""
    width = max(map(len, terms), default=0)
    table = np.zeros((len(terms), width), np.int64)
    for row, t in enumerate(terms):
        table[row, : len(t)] = t
    lists = []
    for column in table.T:
        rows = np.flatnonzero(column)
        lists.append((rows, column[rows]))
    return lists


def accumulate(queries: list[np.ndarray], lists, n: int) -> np.ndarray:
    """Scores of some queries against ``n`` candidates, term by term."""
    scores = np.zeros((len(queries), n), np.int64)
    for term, (rows, weights) in enumerate(lists):
        if not len(rows):
            continue
        dense = len(rows) == n
        for q, query in enumerate(queries):
            weight = query[term] if term < len(query) else 0
            if weight:
                if dense:
                    scores[q] += weight * weights
                else:
                    scores[q, rows] += weight * weights
    return scores


def select(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> np.ndarray:
    """Positions of the k best of one query; ``ids`` rise, so ties go to the smaller."""
    rows = np.flatnonzero(ids != own)
    if len(rows) > k:
        least = np.partition(scores[rows], len(rows) - k)[len(rows) - k]
        over = rows[scores[rows] > least]
        rows = np.r_[over, rows[scores[rows] == least][: k - len(over)]]
    return rows[np.lexsort((ids[rows], -scores[rows]))]


def top_k(
    queries: DataFrame,
    candidates: DataFrame,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    factor: float = 256.0,
    query_block: int = 4096,
    candidate_block: int = 32768,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of each query, or all if fewer.

    Scores are integer inner products of floor(factor * x); sums must fit in a long.
    A shorter vector counts as padded with zeros.  Rows whose id is the query's are its
    own and are left out.  Ties go to the smaller id.  Rows whose id or vector is null, or
    that hold null or non-finite components, take no part.  Every candidate row counts,
    also those that share an id; different query vectors of one id are queries of their own,
    each with its ranks, and equal ones are one query.  Empty sides give no rows.

    Blocks are numbered by a hash of the id, so that each has about its size whatever the
    ids are.  A candidate is copied once for each query block.
    """
    asked, rows = (quantise(side, id_col, vector_col, factor) for side in (queries, candidates))
    asked = asked.distinct().withColumn("variant", F.xxhash64("terms"))
    n_q = max(1, -(-queries.count() // query_block))
    n_c = max(1, -(-candidates.count() // candidate_block))
    own_q = F.pmod(F.xxhash64("vec_id"), F.lit(n_q)).cast("int").alias("qb")
    own_c = F.pmod(F.xxhash64("vec_id"), F.lit(n_c)).cast("int").alias("cb")
    left = asked.select("vec_id", "variant", "terms", own_q, F.explode(F.sequence(F.lit(0), F.lit(n_c - 1))).alias("cb"))
    right = rows.select("vec_id", "terms", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))).alias("qb"), own_c)

    def block(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(q) and len(c):
            c = c.sort_values("vec_id")
            ids = c["vec_id"].to_numpy()
            lists = postings([np.asarray(t, np.int64) for t in c["terms"]])
            terms = [np.asarray(t, np.int64) for t in q["terms"]]
            asked_ids, variants = q["vec_id"].to_numpy(), q["variant"].to_numpy()
            for at in range(0, len(q), TOGETHER):
                scores = accumulate(terms[at : at + TOGETHER], lists, len(ids))
                for n, s in enumerate(scores, at):
                    best = select(s, ids, asked_ids[n], k)
                    found = {"query_id": asked_ids[n], "variant": variants[n], "vec_id": ids[best], "score": s[best]}
                    out.append(pd.DataFrame(found))
        if not out:
            return pd.DataFrame({c: [] for c in ("query_id", "variant", "vec_id", "score")}, dtype=np.int64)
        return pd.concat(out)

    parts = (
        left.groupBy("qb", "cb")
        .cogroup(right.groupBy("qb", "cb"))
        .applyInPandas(block, "query_id bigint, variant bigint, vec_id bigint, score bigint")
    )
    order = Window.partitionBy("query_id", "variant").orderBy(F.desc("score"), "vec_id")
    return (
        parts.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op6_topk(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(vectors.where(F.col("vec_id") % 50 == 0), vectors)


ORACLE = """
with v as (
  select row_number() over () as r, vec_id,
         list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as t
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
q as (select vec_id, t, min(r) as r from v where vec_id % 50 = 0 group by 1, 2),
x as (select r, generate_subscripts(t, 1) as k, unnest(t) as w from v),
p as (
  select a.r as q, b.r as c, sum(a.w * b.w) as score
  from x a join x b on a.k = b.k where a.r in (select r from q)
  group by 1, 2),
s as (
  select q.r as q, q.vec_id as query_id, v.vec_id as vec_id, cast(coalesce(p.score, 0) as bigint) as score
  from q join v on q.vec_id <> v.vec_id left join p on p.q = q.r and p.c = v.r)
select query_id, cast(rank as integer) as rank, vec_id, score
from (select *, row_number() over (partition by q order by score desc, vec_id) as rank from s)
where rank <= 5
"""
