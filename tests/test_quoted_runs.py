"""Lists of line functions are gone through in time proportional to their length."""

import time

import pytest
from pyspark.sql import functions as F

from tidefold.sources import quoted

FORM = "to array<int>, ends array<bigint>"


def begins(df):
    first = F.struct(F.lit(0).alias("at"), F.lit(0).cast("long").alias("ends"))
    return df.select(quoted._begins(F.col("of"), first).alias("b"))


@pytest.mark.parametrize("n", [1, 63, 64, 65, 300])
def test_each_member_begins_where_the_one_before_ends(spark, n):
    rows = [([(k * 7 + s * 3) % 5 for s in range(5)], [(k + s) % 2 for s in range(5)]) for k in range(n)]
    df = spark.createDataFrame([(rows,)], f"of array<struct<{FORM.replace('to ', 'to: ').replace('ends ', 'ends: ')}>>")
    want, at, ends = [], 0, 0
    for to, more in rows:
        want.append((at, ends))
        at, ends = to[at], ends + more[at]
    assert [tuple(x) for x in begins(df).first().b] == want


def test_a_long_list_takes_seconds(spark):
    def seconds(n):
        f = F.struct(F.array(*[F.lit(s) for s in range(5)]).alias("to"), F.array(*[F.lit(1).cast("long")] * 5).alias("ends"))
        df = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda _: f).alias("of"))
        began = time.perf_counter()
        assert begins(df).select(F.size("b")).first()[0] == n
        return time.perf_counter() - began

    seconds(10)
    assert seconds(40_000) < 6
