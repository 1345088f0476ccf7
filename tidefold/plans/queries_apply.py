"""Registered queries: the keyed fold and its variants."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefold.model import Position
from tidefold.operators import fold, normalise
from tidefold.plans import inputs
from tidefold.plans.inputs import cte
from tidefold.plans.registry import query
from tidefold.sources.tables import scan_table as scan
from tidefold.sources.tables import snapshot

KEY = ["user_id"]
DOC = ["event_id", "event_type", "value"]

# Event ids rise with log positions, so they order changes in the oracles.
_FOLD = """, state as (
  select user_id, arg_max(op, event_id) filter (op <> 'update') boundary,
         max(event_id) event_id, arg_max(event_type, event_id) event_type,
         arg_max(value, event_id) "value"
  from changes group by user_id)
"""


@query(
    "apply_insert",
    cte("changes")
    + """select user_id, max(event_id) event_id, arg_max(event_type, event_id) event_type,
         arg_max(value, event_id) "value" from changes where op = 'insert' group by user_id""",
)
def apply_insert(spark: SparkSession, sf: str) -> DataFrame:
    return fold.apply_insert(inputs.changes(spark, sf), KEY, DOC)


@query(
    "apply_update",
    cte("changes")
    + """, u as (select user_id, max(event_id) event_id, arg_max(event_type, event_id) event_type,
         arg_max(value, event_id) "value" from changes where op = 'update' group by user_id)
    select c_custkey user_id, c_name, coalesce(event_id, -1) event_id,
           coalesce(event_type, c_mktsegment) event_type,
           case when event_id is null then c_acctbal else "value" end "value"
    from customer left join u on c_custkey = user_id""",
)
def apply_update(spark: SparkSession, sf: str) -> DataFrame:
    """Updates of users onto customers; users that are no customers miss."""
    target = scan(spark, sf, "customer").selectExpr(
        "c_custkey user_id",
        "c_name",
        "cast(-1 as bigint) event_id",
        "c_mktsegment event_type",
        "c_acctbal value",
    )
    return fold.apply_update(target, inputs.changes(spark, sf), KEY, DOC)


@query(
    "apply_delete",
    cte("changes")
    + """select c_custkey user_id, c_name from customer
    where c_custkey not in (select user_id from changes where op = 'delete')""",
)
def apply_delete(spark: SparkSession, sf: str) -> DataFrame:
    target = scan(spark, sf, "customer").selectExpr("c_custkey user_id", "c_name")
    return fold.apply_delete(target, inputs.changes(spark, sf), KEY)


@query(
    "apply_changes_rollover",
    cte("changes") + _FOLD + """select user_id, event_id, event_type, "value" from state
    where boundary = 'insert'""",
)
def apply_changes_rollover(spark: SparkSession, sf: str) -> DataFrame:
    """The same log in files whose numbers gain a digit on the way, with positions that rise
    in each file."""
    number = F.col("event_id")
    file = F.format_string("binlog.%06d", F.lit(999_998) + F.floor(number / 400))
    log = inputs.changes(spark, sf).withColumns({"logfile": file, "logpos": number % 400 * 100 + 4})
    return fold.apply_changes(log, KEY, DOC)


@query(
    "apply_changes",
    cte("changes")
    + _FOLD
    + """select user_id, event_id, event_type, "value" from state where boundary = 'insert'""",
)
def apply_changes(spark: SparkSession, sf: str) -> DataFrame:
    return fold.apply_changes(inputs.changes(spark, sf), KEY, DOC)


LINE_DOC = ["l_linenumber", "l_quantity", "l_extendedprice", "l_linestatus"]


@query(
    "apply_changes_lineitem",
    cte("line_changes")
    + """, n as (select *, row_number() over
        (partition by l_orderkey order by logfile, logpos, row_idx) i from line_changes),
    b as (select l_orderkey, arg_max(op, i) filter (op <> 'update') op, max(i) i
          from n group by l_orderkey)
    select n.l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_linestatus
    from n join b on n.l_orderkey = b.l_orderkey and n.i = b.i where b.op = 'insert'""",
)
def apply_changes_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return fold.apply_changes(inputs.line_changes(spark, sf), ["l_orderkey"], LINE_DOC)


@query(
    "net_actions",
    cte("changes")
    + _FOLD
    + """select user_id, coalesce(boundary, 'update') op,
           case when coalesce(boundary, '') <> 'delete' then event_id end event_id,
           case when coalesce(boundary, '') <> 'delete' then event_type end event_type
    from state""",
)
def net_actions(spark: SparkSession, sf: str) -> DataFrame:
    state = fold.fold_state(inputs.changes(spark, sf), KEY, DOC)
    return fold.net_actions(state, KEY).select("user_id", "op", "doc.event_id", "doc.event_type")


@query(
    "merge_changes",
    cte("changes")
    + """, p as (
      select user_id, op, event_id,
             case when event_type <> 'click' then {'v': event_type} end t,
             case when event_type <> 'view' then
               {'v': case when event_type = 'purchase' and value < 10 then null else value end}
             end v
      from changes),
    b as (select user_id, arg_max(op, event_id) op, max(event_id) since from p
          where op <> 'update' group by user_id)
    select user_id, max(event_id) event_id, arg_max(t, event_id).v event_type,
           arg_max(v, event_id).v "value",
           concat_ws(',', 'event_id', case when count(t) > 0 then 'event_type' end,
                     case when count(v) > 0 then 'value' end) present
    from p join b using (user_id)
    where b.op = 'insert' and event_id >= since group by user_id""",
)
def merge_changes(spark: SparkSession, sf: str) -> DataFrame:
    merged = fold.merge_changes(inputs.partial_changes(spark, sf), KEY, DOC)
    return merged.withColumn("present", F.array_join("present", ","))


@query(
    "dropped_updates",
    cte("changes")
    + """, w as (select *, last_value(case when op <> 'update' then op end ignore nulls) over
        (partition by user_id order by event_id rows between unbounded preceding and 1 preceding)
        before from changes)
    select * exclude (before) from w where op = 'update' and coalesce(before, 'delete') = 'delete'""",
)
def dropped_updates(spark: SparkSession, sf: str) -> DataFrame:
    return fold.dropped_updates(inputs.changes(spark, sf), KEY)


@query(
    "snapshot_plus_log",
    cte("changes")
    + """, c as (
      select c_custkey user_id, 'insert' op, -1 event_id, c_mktsegment event_type,
             c_acctbal "value" from customer
      union all
      select user_id, op, event_id, event_type, value from changes
      where logfile > 'binlog.000000003' or (logfile = 'binlog.000000003' and logpos > 50004)),
    s as (select user_id, arg_max(op, event_id) filter (op <> 'update') boundary,
                 max(event_id) event_id, arg_max(event_type, event_id) event_type,
                 arg_max("value", event_id) "value" from c group by user_id)
    select user_id, event_id, event_type, "value" from s where boundary = 'insert'""",
)
def snapshot_plus_log(spark: SparkSession, sf: str) -> DataFrame:
    taken_at = Position("binlog.000000003", 50004)
    users = scan(spark, sf, "customer").selectExpr(
        "c_custkey user_id",
        "cast(-1 as bigint) event_id",
        "c_mktsegment event_type",
        "c_acctbal value",
    )
    return fold.snapshot_plus_log(
        snapshot(users, taken_at), inputs.changes(spark, sf), taken_at, KEY, DOC
    )


_PAIRS = """, pairs as (
  select b.logfile, b.logpos, cast(b.i // 2 as int) row_idx, b.user_id before_user, a.user_id after_user,
         b.event_id before_event, a.event_id after_event
  from row_events b join row_events a
    on a.batch_id = b.batch_id and a.i = b.i + 1 and b.i % 2 = 0
  where b.op = 'update')
"""


@query(
    "pk_change",
    cte("row_events") + _PAIRS + "select * from pairs where before_user <> after_user",
)
def pk_change(spark: SparkSession, sf: str) -> DataFrame:
    pairs = normalise.update_pairs(
        inputs.row_events(spark, sf), inputs.ROW_COLUMNS, ["logfile", "logpos"]
    )
    return normalise.pk_change(pairs, KEY).selectExpr(
        "logfile",
        "logpos",
        "row_idx",
        "before.user_id before_user",
        "after.user_id after_user",
        "before.event_id before_event",
        "after.event_id after_event",
    )


@query(
    "pk_change_moves",
    cte("row_events")
    + _PAIRS
    + """select logfile, logpos, row_idx * 2 row_idx, 'update' op, after_event event_id,
                after_user user_id from pairs where before_user = after_user
    union all
    select logfile, logpos, row_idx * 2, 'delete', before_event, before_user from pairs
    where before_user <> after_user
    union all
    select logfile, logpos, row_idx * 2 + 1, 'insert', after_event, after_user from pairs
    where before_user <> after_user""",
)
def pk_change_moves(spark: SparkSession, sf: str) -> DataFrame:
    keep = ["logfile", "logpos"]
    pairs = normalise.update_pairs(inputs.row_events(spark, sf), inputs.ROW_COLUMNS, keep)
    moves = normalise.move_changed_keys(pairs, KEY, keep)
    return moves.select(*keep, "row_idx", "op", "event_id", "user_id")
