import math

import duckdb
import numpy as np
import pytest

from oracle import compare, connect
from tidefold.llm import topk as T

SCHEMA = "vec_id bigint, embedding array<float>, score int"


def brute(rows, k, is_query):
    ok = [
        (i, tuple(math.floor(256.0 * float(np.float32(x))) for x in v))
        for i, v, *_ in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, v in {row for row in ok if is_query(row[0])}:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), c) for c, w in ok if c != q)
        out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(scored[:k])]
    return sorted(out)


def data():
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) if x > -0.3 else 0.0 for x in rng.normal(size=12).astype("f4")], 1) for i in range(150)]
    rows += [(200 + i, rows[0][1], 1) for i in range(9)]  # ties
    rows += [(300, None, 1), (301, [1.0, None], 1), (302, [float("nan")] * 12, 1), (303, [float("inf")], 1)]
    rows += [(None, [1.0] * 12, 1), (304, [], 1), (306, [0.5], 1), rows[5], rows[6]]
    rows += [(7, [9.0] * 12, 1), (12, [-1.0] * 12, 1)]  # other vectors of known ids
    return rows


@pytest.mark.parametrize("blocks", [(4096, 32768), (4, 20)])
def test_equals_brute_force(spark, blocks):
    rows = data()
    df = spark.createDataFrame(rows, SCHEMA)
    got = T.top_k(df.where("vec_id % 6 = 0"), df, 5, query_block=blocks[0], candidate_block=blocks[1])
    assert sorted(map(tuple, got.collect())) == brute(rows, 5, lambda i: i % 6 == 0)


def test_fewer_candidates_than_k_and_empty(spark):
    df = spark.createDataFrame(data()[:3], SCHEMA)
    assert T.top_k(df, df, 5).count() == 6
    assert T.top_k(df.limit(0), df, 5).collect() == []
    assert T.top_k(df, df.limit(0), 5).collect() == []


def test_oracle(spark):
    sf = "/root/testdata/sf0.001"
    same, n, want, diff = compare(spark, connect(sf), T.op6_topk, T.ORACLE, sf)
    assert same and n, (n, want, diff)


def test_oracle_with_repeated_ids_and_empty_vectors(spark, tmp_path):
    rows = [(0, [0.1, 0.0]), (50, [-1.0, 0.0]), (50, [2.0, 1.0]), (50, [2.0, 1.0]), (1, [0.1, 0.0]), (1, [3.0, 0.0]), (2, []), (3, [3.0, 0.0]), (3, [3.0, 0.0])]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet/*.parquet'")
    want = sorted(con.execute(T.ORACLE).fetchall())
    got = sorted(map(tuple, T.op6_topk(spark, str(tmp_path)).collect()))
    assert got == want == brute([(*r, 0) for r in rows], 5, lambda i: i % 50 == 0)
