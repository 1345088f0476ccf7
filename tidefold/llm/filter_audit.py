"""What filters do to each other, in every order they can be applied in.

Documents only differ by the set of filters they fail, so they are counted by that mask,
their part and their labels.  Each such cell is folded along all orders with higher-order
functions: an order's fold carries the filters seen so far and yields a struct of counts a
step, weighted by the cell's documents.  The cells' 600 structs are added up element by
element.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidefold.llm.common import words_of

COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def failing(text: Column) -> dict[str, Column]:
    """Filters that a text alone decides; null texts count as empty."""
    text = F.coalesce(text, F.lit(""))
    words = words_of(text)
    n = F.size(words)
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {
        "A": n < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * n,
        "C": 100 * capitals > 10 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic, n): documents by the filters they fail.

    Bit k of ``mask`` is the k-th filter of ABCDE.  E fails a text that a smaller doc_id has
    too, anywhere in the table; equal texts are told by SHA-256.  Rows of one id and text do
    not fail each other, and rows without an id neither fail nor make others fail.  A label
    counts if any of the id's label rows has it.

    Copies are counted before they meet, so a text of a third of all rows is one row a task.
    """
    text = F.coalesce("text", F.lit(""))
    mask = sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(failing(F.col("text")).values())), F.lit(0))
    rows = docs.select(
        "doc_id",
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        mask.alias("mask"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
    )
    counted = rows.groupBy("doc_id", "part", "mask", "digest").agg(F.count(F.lit(1)).alias("n"))
    flags = labels.groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    flag = lambda name: F.coalesce(F.col(name), F.lit(0)).alias(name)
    labelled = counted.join(flags, "doc_id", "left").select("doc_id", "part", "mask", "digest", "n", flag("good"), flag("toxic"))
    copies = labelled.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.min("doc_id").alias("first"),
        F.min_by("n", "doc_id").alias("n_first"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("nameless"),
    )
    least = F.min("first").over(Window.partitionBy("digest"))
    leading = F.when(F.col("first") == F.col("least"), F.col("n_first")).otherwise(0) + F.col("nameless")
    split = copies.withColumn("least", least).select(
        "part", "mask", "good", "toxic", "n", F.coalesce(leading, F.col("nameless")).alias("leading")
    )
    both = F.explode(
        F.array(
            F.struct(F.col("mask").alias("mask"), F.col("leading").alias("n")),
            F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("leading")).alias("n")),
        )
    )
    return (
        split.select("part", "good", "toxic", both.alias("x"))
        .groupBy("part", F.col("x.mask").alias("mask"), "good", "toxic")
        .agg(F.sum("x.n").alias("n"))
        .where("n > 0")
    )


def _step(seen: Column, bit: Column) -> Column:
    """The counts of one step, for one cell."""
    n, mask = F.col("n"), F.col("mask")
    fails, before = mask.bitwiseAND(bit) != 0, mask.bitwiseAND(seen) != 0
    lost = fails & ~before

    def weight(condition: Column, name: str) -> Column:
        return F.when(condition, n).otherwise(F.lit(0).cast("long")).alias(name)

    return F.struct(
        weight(~fails & ~before, "kept"),
        weight(lost, "removed"),
        weight(fails & before, "redundant"),
        weight(mask == bit, "unique_fails"),
        weight(lost & (F.col("good") == 1), "good_lost"),
        weight(lost & (F.col("toxic") == 1), "toxic_lost"),
    )


def folded(cell: DataFrame, orders: Sequence[Sequence[int]]) -> DataFrame:
    """``cell`` with ``steps``: an array of one struct for each order and step, in turn.

    ``orders`` lists the filters' bits in the order of their use; it is a constant that each
    task gets with the plan.
    """
    every = F.array(*[F.array(*[F.lit(b) for b in bits]) for bits in orders])
    step = "struct<" + ", ".join(f"{c}: bigint" for c in COUNTS) + ">"

    def fold(order: Column) -> Column:
        start = F.struct(F.lit(0).alias("seen"), F.array().cast(f"array<{step}>").alias("steps"))
        return F.aggregate(
            order,
            start,
            lambda acc, bit: F.struct(
                acc["seen"].bitwiseOR(bit).alias("seen"),
                F.concat(acc["steps"], F.array(_step(acc["seen"], bit)).cast(f"array<{step}>")).alias("steps"),
            ),
            lambda acc: acc["steps"],
        )

    return cell.withColumn("steps", F.flatten(F.transform(every, fold)))


def interactions(docs: DataFrame, labels: DataFrame, filters: str = "ABCDE") -> DataFrame:
    """One row per part, order of the filters and step, zeros included.

    Columns: part, filter_order, step (from 1; its filter is that letter), documents kept
    after it, removed by it, redundant (failing it, but gone before), unique_fails (failing
    no other), good_lost and toxic_lost (removed with that label), and shapley (removed by
    its filter over all orders).  Null texts are empty and null languages are the part ''.
    An empty table has no parts and gives no rows.
    """
    orders = list(permutations(range(len(filters))))
    bits = [[1 << k for k in order] for order in orders]
    names = ["".join(filters[k] for k in order) for order in orders]
    places = F.posexplode("steps").alias("place", "s")
    summed = (
        folded(cells(docs, labels), bits)
        .select("part", places)
        .groupBy("part", "place")
        .agg(*[F.sum(f"s.{c}").alias(c) for c in COUNTS])
    )
    width = len(filters)
    order = F.element_at(F.array(*[F.lit(n) for n in names]), F.floor(F.col("place") / width).cast("int") + 1)
    rows = summed.select(
        "part", order.alias("filter_order"), (F.col("place") % width + 1).cast("int").alias("step"), *COUNTS
    )
    # A part has as many rows as there are orders and steps.
    own = Window.partitionBy("part", F.substr("filter_order", F.col("step"), F.lit(1)))
    return rows.withColumn("shapley", F.sum("removed").over(own))


def op13_filters(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return interactions(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


ORACLE = r"""
with d as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w
  from documents),
l as (
  select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
  from labels group by doc_id),
m as (
  select d.part, coalesce(l.good, 0) as good, coalesce(l.toxic, 0) as toxic,
    len(w) < 100 as a, 100 * len(list_distinct(w)) < 80 * len(w) as b,
    100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t) as c,
    regexp_matches(t, '[#$%&*|]') as d,
    coalesce(doc_id > min(doc_id) over (partition by t), false) as e
  from d left join l using (doc_id)),
x as (
  select part, good, toxic, a::int + 2 * b::int + 4 * c::int + 8 * d::int + 16 * e::int as mask, count(*) as n
  from m group by all),
f as (select * from (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) as f(letter, bit)),
o as (
  select p.letter || q.letter || r.letter || s.letter || u.letter as filter_order, [p.bit, q.bit, r.bit, s.bit, u.bit] as bits
  from f p, f q, f r, f s, f u
  where len(list_distinct([p.bit, q.bit, r.bit, s.bit, u.bit])) = 5),
k as (
  select filter_order, step, bits[step] as bit, coalesce(list_sum(bits[1 : step - 1]), 0)::int as seen
  from o, (select unnest(generate_series(1, 5)) as step)),
g as (
  select part, filter_order, cast(step as integer) as step,
    sum(case when mask & (seen | bit) = 0 then n else 0 end) as kept,
    sum(case when mask & bit <> 0 and mask & seen = 0 then n else 0 end) as removed,
    sum(case when mask & bit <> 0 and mask & seen <> 0 then n else 0 end) as redundant,
    sum(case when mask = bit then n else 0 end) as unique_fails,
    sum(case when mask & bit <> 0 and mask & seen = 0 and good = 1 then n else 0 end) as good_lost,
    sum(case when mask & bit <> 0 and mask & seen = 0 and toxic = 1 then n else 0 end) as toxic_lost
  from x, k group by 1, 2, 3)
select part, filter_order, step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
  unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
  cast(sum(removed) over (partition by part, filter_order[step]) as bigint) as shapley
from g
"""
