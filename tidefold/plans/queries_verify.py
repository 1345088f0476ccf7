"""Registered queries: source against target."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefold.functions.values import lenient_equal as equal
from tidefold.operators import reconcile as verify
from tidefold.plans import inputs
from tidefold.plans.inputs import cte
from tidefold.plans.registry import query
from tidefold.sources.tables import scan_table as scan

KEY = ["o_orderkey"]
COLUMNS = ["o_orderstatus", "o_totalprice"]

_STATUS = """, statuses as (
  select o.o_orderkey, case when t.o_orderkey is null then 'missing'
           when o.o_orderstatus = t.o_orderstatus and o.o_totalprice = t.o_totalprice
           then 'verified' else 'mismatch' end status
  from orders o left join orders_target t on o.o_orderkey = t.o_orderkey)
"""


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return scan(spark, sf, "orders").select(*KEY, *COLUMNS)


@query(
    "reconcile",
    cte("orders_target") + _STATUS + "select *, status <> 'verified' is_missing from statuses",
)
def reconcile(spark: SparkSession, sf: str) -> DataFrame:
    return verify.reconcile(
        _orders(spark, sf), inputs.orders_target(spark, sf), KEY, COLUMNS
    )


@query(
    "reconcile_both_sides",
    cte("orders_target")
    + _STATUS
    + """select *, status <> 'verified' is_missing from statuses
    union all
    select o_orderkey, 'target_only', false from orders_target
    where o_orderkey not in (select o_orderkey from orders)""",
)
def reconcile_both_sides(spark: SparkSession, sf: str) -> DataFrame:
    return verify.reconcile(
        _orders(spark, sf), inputs.orders_target(spark, sf), KEY, COLUMNS, target_only=True
    )


@query(
    "reconcile_summary",
    cte("orders_target")
    + _STATUS
    + """, u as (select 'orders' tbl, status from statuses
      union all
      select 'customer', case when c_acctbal >= 0 then 'verified' else 'missing' end from customer)
    select tbl, status, count(*) n_rows from u group by rollup (tbl, status)""",
)
def reconcile_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Orders against their target, customers against one without debtors."""
    orders = verify.reconcile(
        _orders(spark, sf), inputs.orders_target(spark, sf), KEY, COLUMNS
    ).select(F.lit("orders").alias("tbl"), "status")
    customer = scan(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    customers = verify.reconcile(
        customer, customer.where("c_acctbal >= 0"), ["c_custkey"], ["c_name", "c_acctbal"]
    ).select(F.lit("customer").alias("tbl"), "status")
    return verify.reconcile_summary(orders.unionByName(customers))


@query(
    "doc_diff",
    cte("orders_target")
    + """select o_orderkey, 'o_totalprice' column_name, o.o_totalprice source_value,
           t.o_totalprice target_value
    from orders o join orders_target t using (o_orderkey)
    where o.o_totalprice <> t.o_totalprice
    union all
    select o_orderkey, 'o_orderpriority', null, null
    from orders join orders_target t using (o_orderkey)
    where o_orderpriority <> '9-' || t.o_orderstatus""",
)
def doc_diff(spark: SparkSession, sf: str) -> DataFrame:
    """Differences in price, and in priority, which the target has written anew."""
    source = scan(spark, sf, "orders").select(*KEY, "o_totalprice", "o_orderpriority")
    target = inputs.orders_target(spark, sf).selectExpr(
        "o_orderkey", "o_totalprice", "concat('9-', o_orderstatus) o_orderpriority"
    )
    diff = verify.doc_diff(source, target, KEY, ["o_totalprice", "o_orderpriority"])
    is_price = F.col("column_name") == "o_totalprice"
    return diff.withColumns(
        {c: F.when(is_price, F.col(c).cast("double")) for c in ("source_value", "target_value")}
    )


@query(
    "lenient_equal",
    """select l_orderkey, l_partkey, l_suppkey, l_linenumber, true number_and_number,
              l_tax <> 0 bytes_and_number,
              printf('%.2f', l_discount) = cast(l_discount as varchar) text_and_number
       from lineitem""",
)
def lenient_equal(spark: SparkSession, sf: str) -> DataFrame:
    """Equal by printed form or as numbers: bytes parse as numbers, text does not,
    and zero never counts as a number."""
    key = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    rows = scan(spark, sf, "lineitem").selectExpr(
        *key,
        "l_quantity",
        "cast(l_quantity as int) quantity",
        "l_tax",
        "cast(format_string('%.2f', l_tax) as binary) tax",
        "l_discount",
        "format_string('%.2f', l_discount) discount",
    )
    return rows.select(
        *key,
        equal(rows, "l_quantity", "quantity").alias("number_and_number"),
        equal(rows, "l_tax", "tax").alias("bytes_and_number"),
        equal(rows, "l_discount", "discount").alias("text_and_number"),
    )
