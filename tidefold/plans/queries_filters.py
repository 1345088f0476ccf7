"""Registered queries: filters, rejects, positions, registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefold.functions import positions
from tidefold.model import Position
from tidefold.operators import catchup, normalise, ordering, registry, target
from tidefold.plans import inputs
from tidefold.plans.inputs import cte
from tidefold.plans.registry import query
from tidefold.sources.tables import scan_table as scan

_ROWS = (
    "('write_rows_v1', 'write_rows_v2', 'update_rows_v1', 'update_rows_v2', 'delete_rows_v1', "
    "'delete_rows_v2')"
)
_CURRENT = """, current as (
  select tbl, arg_max(status, seq) filter (status is not null) status,
         arg_max(logfile, seq) filter (logfile is not null) logfile,
         arg_max(logpos, seq) filter (logpos is not null) logpos,
         arg_max(dump_read_progress, seq) filter (dump_read_progress is not null)
           dump_read_progress
  from registry_log group by tbl)
"""
_FIELDS = ("status", "logfile", "logpos", "dump_read_progress")


def _registry(spark: SparkSession, sf: str) -> DataFrame:
    return registry.registry_upsert(inputs.registry_log(spark, sf), _FIELDS, "tbl")


@query(
    "table_filter",
    cte("raw_events", "registry_log")
    + _CURRENT
    + """select * from raw_events where "schema" = 'shop'
         and tbl in (select tbl from current where status = 'syncing')""",
)
def table_filter(spark: SparkSession, sf: str) -> DataFrame:
    tables = _registry(spark, sf).withColumn("schema", F.lit("shop"))
    return normalise.table_filter(inputs.raw_events(spark, sf), tables)


@query(
    "table_filter_by_name",
    cte("raw_events", "registry_log")
    + _CURRENT
    + """select * from raw_events
         where tbl in (select tbl from current where status = 'syncing')""",
)
def table_filter_by_name(spark: SparkSession, sf: str) -> DataFrame:
    return normalise.table_filter(
        inputs.raw_events(spark, sf), _registry(spark, sf), match_schema=False
    )


@query(
    "row_events_only",
    cte("raw_events") + f"select * from raw_events where event_type in {_ROWS}",
)
def row_events_only(spark: SparkSession, sf: str) -> DataFrame:
    return normalise.row_events_only(inputs.raw_events(spark, sf))


_BATCHES = """with records as (
  select event_id // 50 batch_id, event_id,
         case when value < 0.5 then '' else cast(user_id as varchar) end _id from events),
bad as (select distinct batch_id from records where _id = '')
"""


def _batches(spark: SparkSession, sf: str) -> DataFrame:
    return scan(spark, sf, "events").selectExpr(
        "event_id div 50 batch_id",
        "event_id",
        "if(value < 0.5, '', cast(user_id as string)) _id",
    )


@query(
    "missing_key_reject",
    _BATCHES
    + """select *, batch_id not in (select batch_id from bad) accepted from records""",
)
def missing_key_reject(spark: SparkSession, sf: str) -> DataFrame:
    return normalise.missing_key_reject(_batches(spark, sf), ["batch_id"])


@query(
    "enum_reject",
    cte("catalog")
    + """select tbl, name, "type", tbl not in
           (select tbl from catalog where lower("type") like '%enum%') accepted
    from catalog""",
)
def enum_reject(spark: SparkSession, sf: str) -> DataFrame:
    columns = inputs.catalog(spark, sf).select("tbl", "name", "type")
    return normalise.enum_reject(columns)


@query(
    "resume_after",
    cte("raw_events", "registry_log")
    + _CURRENT
    + """select e.* from raw_events e join current c using (tbl)
    where c.logfile is null or e.logfile > c.logfile
       or (e.logfile = c.logfile and e.logpos > c.logpos)""",
)
def resume_after(spark: SparkSession, sf: str) -> DataFrame:
    saved = _registry(spark, sf).where("logfile is not null").select("tbl", "logfile", "logpos")
    return catchup.resume_after(inputs.raw_events(spark, sf), saved)


@query(
    "catchup_range",
    cte("changes")
    + """select * from changes
    where (logfile > 'binlog.000000000' or (logfile = 'binlog.000000000' and logpos > 20004))
      and (logfile < 'binlog.000000007' or (logfile = 'binlog.000000007' and logpos <= 5004))""",
)
def catchup_range(spark: SparkSession, sf: str) -> DataFrame:
    return catchup.catchup_range(
        inputs.changes(spark, sf),
        Position("binlog.000000000", 20004),
        Position("binlog.000000007", 5004),
    )


@query(
    "catchup_range_crossing",
    cte("changes")
    + """, e as (select min(event_id) last from changes
      where logfile > 'binlog.000000007' or (logfile = 'binlog.000000007' and logpos >= 5050))
    select c.* from changes c left join e on true
    where (logfile > 'binlog.000000000' or (logfile = 'binlog.000000000' and logpos > 20004))
      and (logfile < 'binlog.000000007' or (logfile = 'binlog.000000007' and logpos <= 5050)
           or event_id = e.last)""",
)
def catchup_range_crossing(spark: SparkSession, sf: str) -> DataFrame:
    """The end lies inside an event."""
    return catchup.catchup_range(
        inputs.changes(spark, sf),
        Position("binlog.000000000", 20004),
        Position("binlog.000000007", 5050),
        crossing=True,
    )


@query(
    "position_compare",
    """with p as (
         select event_id, printf('binlog.%06d', event_id // 40 % 1500000 + 999900) f1,
                event_id % 7 p1, printf('binlog.%06d', user_id + 999950) f2, user_id % 7 p2
         from events)
       select event_id,
              case when f1 < f2 or (f1 = f2 and p1 < p2) then 'second_newer'
                   when f1 = f2 and p1 = p2 then 'equal' else 'first_newer' end verdict,
              case when n1 < n2 or (n1 = n2 and p1 < p2) then 'second_newer'
                   when n1 = n2 and p1 = p2 then 'equal' else 'first_newer' end numeric_verdict
       from (select *, cast(substr(f1, 8) as bigint) n1, cast(substr(f2, 8) as bigint) n2 from p)""",
)
def position_compare(spark: SparkSession, sf: str) -> DataFrame:
    """Positions around the point where the file suffix gains a digit."""
    pairs = scan(spark, sf, "events").selectExpr(
        "event_id",
        "format_string('binlog.%06d', event_id div 40 % 1500000 + 999900) f1",
        "event_id % 7 p1",
        "format_string('binlog.%06d', user_id + 999950) f2",
        "user_id % 7 p2",
    )
    as_text = positions.compare_positions(
        positions.text_position("f1", "p1"), positions.text_position("f2", "p2")
    )
    as_number = positions.compare_positions(
        positions.position("f1", "p1"), positions.position("f2", "p2")
    )
    return pairs.select(
        "event_id", as_text.alias("verdict"), as_number.alias("numeric_verdict")
    )


@query(
    "high_water_mark",
    cte("raw_events")
    + """select "schema", arg_max(logfile, (logfile, logpos)) logfile,
                arg_max(logpos, (logfile, logpos)) logpos
    from raw_events group by "schema" """,
)
def high_water_mark(spark: SparkSession, sf: str) -> DataFrame:
    return ordering.high_water_mark(inputs.raw_events(spark, sf), ["schema"])


@query(
    "rotate_attribution",
    cte("raw_log")
    + """select ord, kind, next_log,
           coalesce(last_value(next_log ignore nulls) over
             (order by ord rows between unbounded preceding and current row),
             'binlog.start') logfile
    from raw_log""",
)
def rotate_attribution(spark: SparkSession, sf: str) -> DataFrame:
    return ordering.rotate_attribution(inputs.raw_log(spark, sf), "binlog.start")


@query(
    "catchup_plan",
    cte("registry_log", "changes")
    + _CURRENT
    + """, main as (select arg_max(logfile, event_id) f, arg_max(logpos, event_id) p
      from changes where op = 'delete'),
    own as (select tbl, logfile, logpos, f, p,
              case when f > logfile or (f = logfile and p > logpos) then 'table'
                   when f < logfile or (f = logfile and p < logpos) then 'syncing_tables'
                   else 'none' end who
            from current, main where logfile is not null)
    select tbl, who,
      case who when 'table' then logfile when 'syncing_tables' then f end from_logfile,
      case who when 'table' then logpos when 'syncing_tables' then p end from_logpos,
      case who when 'table' then f when 'syncing_tables' then logfile end to_logfile,
      case who when 'table' then p when 'syncing_tables' then logpos end to_logpos
    from own""",
)
def catchup_plan(spark: SparkSession, sf: str) -> DataFrame:
    """The main stream has reached the last delete of the change log."""
    seen = inputs.changes(spark, sf).where("op = 'delete'").select("logfile", "logpos")
    tables = _registry(spark, sf).where("logfile is not null")
    return catchup.catchup_plan(tables, ordering.high_water_mark(seen))


@query(
    "registry_upsert",
    cte("registry_log") + _CURRENT + "select * from current",
)
def registry_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return _registry(spark, sf)


@query(
    "register_tables",
    cte("registry_log")
    + _CURRENT
    + """select tbl, status from current where status is not null
    union all
    select distinct 'o' || o_custkey, 'created' from orders
    union all
    select distinct 't' || user_id, 'created' from events
    where 't' || user_id not in (select tbl from current where status is not null)""",
)
def register_tables(spark: SparkSession, sf: str) -> DataFrame:
    known = _registry(spark, sf).where("status is not null").select("tbl", "status")
    wanted = scan(spark, sf, "events").selectExpr("concat('t', user_id) tbl").unionByName(
        scan(spark, sf, "orders").selectExpr("concat('o', o_custkey) tbl")
    )
    return registry.register_tables(known, wanted, "tbl")


@query(
    "status_transitions",
    cte("registry_log")
    + """, moves as (
      select tbl, seq, status, lag(status) over (partition by tbl order by seq) previous
      from registry_log where status is not null)
    select *, case when previous is null then status = 'created'
      else (previous, status) in (('created', 'dumping'), ('dumping', 'dumped'),
        ('dumped', 'initialized'), ('initialized', 'moving'), ('moving', 'moved'),
        ('moved', 'syncing'), ('created', 'created'), ('dumping', 'created'),
        ('moving', 'moving')) end legal
    from moves""",
)
def status_transitions(spark: SparkSession, sf: str) -> DataFrame:
    log = inputs.registry_log(spark, sf).where("status is not null").select("tbl", "seq", "status")
    return registry.status_transitions(log)


@query(
    "create_if_missing",
    """select distinct 't' || user_id tbl from events
       where user_id not in (select c_custkey from customer where c_mktsegment = 'BUILDING')""",
)
def create_if_missing(spark: SparkSession, sf: str) -> DataFrame:
    required = scan(spark, sf, "events").selectExpr("concat('t', user_id) tbl")
    existing = (
        scan(spark, sf, "customer")
        .where("c_mktsegment = 'BUILDING'")
        .selectExpr("concat('t', c_custkey) tbl")
    )
    return target.tables_to_create(required, existing)


@query(
    "append_row",
    """select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer
       union all
       select (select max(c_custkey) from customer) + 1 + s_suppkey, s_name, s_nationkey,
              s_acctbal, null from supplier""",
)
def append_row(spark: SparkSession, sf: str) -> DataFrame:
    """New rows take ids after the largest present one."""
    table = scan(spark, sf, "customer")
    largest = table.select(F.max("c_custkey")).scalar()
    rows = scan(spark, sf, "supplier").select(
        (largest + 1 + F.col("s_suppkey")).alias("c_custkey"),
        F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"),
        F.col("s_acctbal").alias("c_acctbal"),
    )
    return target.append_rows(table, rows)
