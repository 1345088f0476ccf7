"""Inputs that the registered queries derive from the given tables.

Each input is written twice, once for Spark and once as a DuckDB common table
expression, so that a query and its oracle start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefold.model import Column
from tidefold.sources.dump_text import insert_statements
from tidefold.sources.tables import scan_table

# Columns of the customer and pages tables as a database would declare them.
CUSTOMER = [
    Column("c_custkey", "bigint", 0, True),
    Column("c_name", "varchar(64)", 1),
    Column("c_nationkey", "int", 2),
    Column("c_acctbal", "double", 3),
    Column("c_mktsegment", "varchar(32)", 4),
]
PAGES = [
    Column("page_id", "bigint", 0, True),
    Column("url", "text", 1),
    Column("html", "longtext", 2),
]
DOCUMENTS = [
    Column("doc_id", "bigint", 0, True),
    Column("text", "longtext", 1),
    Column("lang", "varchar(8)", 2),
    Column("source", "varchar(64)", 3),
    Column("n_chars", "bigint", 4),
]
ROW_COLUMNS = [
    Column("event_id", "bigint", 0),
    Column("user_id", "bigint", 1, True),
    Column("event_type", "varchar(16)", 2),
]


def changes(spark: SparkSession, sf: str) -> DataFrame:
    """A change log with one change per event, keyed by user."""
    return scan_table(spark, sf, "events").selectExpr(
        "format_string('binlog.%09d', event_id div 1000) logfile",
        "event_id % 1000 * 100 + 4 logpos",
        "0 row_idx",
        """case event_type when 'signup' then 'insert' when 'error' then 'delete'
           else 'update' end op""",
        "user_id",
        "event_id",
        "event_type",
        "value",
    )


def line_changes(spark: SparkSession, sf: str) -> DataFrame:
    """A larger change log, one change per line item, keyed by order; a log file
    per day of shipping."""
    return scan_table(spark, sf, "lineitem").selectExpr(
        "concat('binlog.', cast(l_shipdate as date)) logfile",
        "l_partkey logpos",
        "cast(l_suppkey * 10 + l_linenumber as int) row_idx",
        """case l_returnflag when 'A' then 'insert' when 'R' then 'delete'
           else 'update' end op""",
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        "l_linestatus",
    )


def partial_changes(spark: SparkSession, sf: str) -> DataFrame:
    """As ``changes``, with documents that carry some columns only.

    Views lack the value, clicks lack the event type, purchases below 10 set the
    value to null explicitly.
    """
    return changes(spark, sf).selectExpr(
        "logfile",
        "logpos",
        "row_idx",
        "op",
        "user_id",
        "event_id",
        "if(event_type = 'click', null, event_type) event_type",
        """if(event_type = 'view' or (event_type = 'purchase' and value < 10), null, value)
           value""",
        """case event_type when 'view' then array('event_id', 'event_type')
           when 'click' then array('event_id', 'value')
           else array('event_id', 'event_type', 'value') end present""",
    )


def raw_log(spark: SparkSession, sf: str) -> DataFrame:
    """Events in arrival order; some announce the next log file."""
    return scan_table(spark, sf, "events").selectExpr(
        "event_id ord",
        "if(event_type = 'signup' and value < 2, 'rotate', 'rows') kind",
        """if(event_type = 'signup' and value < 2,
           format_string('binlog.%09d', event_id), null) next_log""",
    )


def row_events(spark: SparkSession, sf: str) -> DataFrame:
    """Nested positional row events, four source events in each.

    Views lack their last value; very high values carry one value too many.
    """
    row = F.expr(
        """case when value > 200 then array(cast(event_id as string),
                  cast(user_id as string), event_type, props)
                when event_type = 'view' then array(cast(event_id as string),
                  cast(user_id as string))
                else array(cast(event_id as string), cast(user_id as string), event_type) end"""
    )
    events = scan_table(spark, sf, "events")
    gathered = F.array_sort(F.collect_list(F.struct(F.col("event_id").alias("k"), row.alias("r"))))
    return (
        events.groupBy(F.expr("event_id div 4").alias("batch_id"))
        .agg(F.transform(gathered, lambda x: x["r"]).alias("rows"))
        .selectExpr(
            "'shop' schema",
            "'users' tbl",
            """case batch_id % 6 when 0 then 'write_rows_v2' when 1 then 'update_rows_v2'
               when 2 then 'delete_rows_v2' when 3 then 'write_rows_v1'
               when 4 then 'update_rows_v1' else 'delete_rows_v1' end event_type""",
            "format_string('binlog.%09d', batch_id div 250) logfile",
            "batch_id % 250 * 400 + 4 logpos",
            "rows",
        )
    )


def raw_events(spark: SparkSession, sf: str) -> DataFrame:
    """Flat log events of many tables in two schemas, of all event kinds."""
    return scan_table(spark, sf, "events").selectExpr(
        "event_id",
        "if(value < 5, 'archive', 'shop') schema",
        "concat('t', user_id) tbl",
        """case when value > 150 then 'query' when value > 120 then 'xid'
           when event_type = 'signup' then 'write_rows_v2'
           when event_type = 'purchase' then 'write_rows_v1'
           when event_type = 'view' then 'update_rows_v2'
           when event_type = 'click' then 'update_rows_v1'
           when value > 60 then 'delete_rows_v1' else 'delete_rows_v2' end event_type""",
        "format_string('binlog.%09d', event_id div 1000) logfile",
        "event_id % 1000 * 100 + 4 logpos",
    )


def registry_log(spark: SparkSession, sf: str) -> DataFrame:
    """Registry writes: each sets one of a table's fields."""
    return scan_table(spark, sf, "events").selectExpr(
        "concat('t', user_id) tbl",
        "event_id seq",
        f"{_STATUS} status",
        "if(event_type = 'view', format_string('binlog.%09d', event_id div 1000), null) logfile",
        "if(event_type = 'view', event_id % 1000 * 100 + 4, null) logpos",
        "if(event_type = 'click', event_id * 3, null) dump_read_progress",
    )


# Status a table is set to by an event of a kind; other events set none.
_STATUS = """case when event_type = 'signup' and value < 20 then 'created'
  when event_type = 'signup' then 'dumping'
  when event_type = 'error' and value < 20 then 'dumped'
  when event_type = 'error' then 'initialized'
  when event_type = 'purchase' and value < 15 then 'moving'
  when event_type = 'purchase' and value < 30 then 'moved'
  when event_type = 'purchase' then 'syncing' end"""

# Declared type of a catalog column, from the length of a message.
_TYPES = (
    "int(11)",
    "tinyint(1)",
    "BIGINT(20) unsigned",
    "decimal(10,2)",
    "decimal",
    "DATETIME(6)",
    "timestamp",
    "varchar(255)",
    "char(35)",
    "longtext",
    "json",
    "double",
    "bigint",
    "bool",
    "date",
    "set(''a'',''b,)'')",
)
_TYPE = (
    "case length(text) % 97 "
    + " ".join(f"when {i} then '{t}'" for i, t in enumerate(_TYPES))
    + " when 16 then 'enum(''x'',''y'')' else 'smallint' end"
)


def catalog(spark: SparkSession, sf: str) -> DataFrame:
    """Columns of many tables: a table per conversation, a column per turn."""
    sql = _TYPE.replace("''", "\\'")
    return scan_table(spark, sf, "conversations").selectExpr(
        "concat('c', conv_id) tbl",
        "cast(turn as int) position",
        "concat(role, '_', turn) name",
        f"{sql} type",
        "role = 'system' or turn = 1 is_in_primary_key",
        "text",
    )


def create_statements(spark: SparkSession, sf: str) -> DataFrame:
    """CREATE TABLE text of the catalog, with each message as a column comment.

    A statement holds one table's columns, which databases bound.
    """
    quoted = F.concat(
        F.lit("'"),
        F.replace(F.replace(F.col("text"), F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("''")),
        F.lit("'"),
    )
    line = F.concat(
        F.lit("  `"), "name", F.lit("` "), "type", F.lit(" DEFAULT NULL COMMENT "), quoted
    )
    entry = F.struct("position", line.alias("line"), "name", "is_in_primary_key")
    table = catalog(spark, sf).groupBy("tbl").agg(F.array_sort(F.collect_list(entry)).alias("c"))
    names = F.transform(
        F.filter("c", lambda x: x["is_in_primary_key"]),
        lambda x: F.concat(F.lit("`"), x["name"], F.lit("`")),
    )
    key = F.when(
        F.size(names) > 0,
        F.concat(F.lit(",\n  PRIMARY KEY ("), F.array_join(names, ","), F.lit(")")),
    ).otherwise("")
    return table.select(
        F.col("tbl").alias("file"),
        F.concat(
            F.lit("CREATE TABLE `"),
            "tbl",
            F.lit("` (\n"),
            F.array_join(F.transform("c", lambda x: x["line"]), ",\n"),
            key,
            F.lit("\n) ENGINE=InnoDB DEFAULT CHARSET=utf8mb4"),
        ).alias("value"),
    )


def dump_headers(spark: SparkSession, sf: str) -> DataFrame:
    """Header lines of one dump per conversation; assistant turns carry a
    coordinate comment in front of their text."""
    return scan_table(spark, sf, "conversations").selectExpr(
        "concat('c', conv_id) file",
        "turn ord",
        r"""if(role = 'assistant', concat('-- CHANGE MASTER TO MASTER_LOG_FILE=\'',
            format_string('binlog.%06d', conv_id), '\', MASTER_LOG_POS=', turn * 1000 + 7,
            '; ', text), concat('-- ', text)) value""",
    )


def customer_dump(spark: SparkSession, sf: str) -> DataFrame:
    """Dump text of the customer table, 100 key values in each statement."""
    table = scan_table(spark, sf, "customer")
    return insert_statements(table, "customer", F.expr("c_custkey div 100"), "c_custkey")


def customer_names_dump(spark: SparkSession, sf: str) -> DataFrame:
    """As ``customer_dump``, with whole numbers and names only."""
    table = scan_table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    return insert_statements(table, "customer", F.expr("c_custkey div 100"), "c_custkey")


def pages_dump(spark: SparkSession, sf: str) -> DataFrame:
    table = scan_table(spark, sf, "pages")
    return insert_statements(table, "pages", F.expr("page_id div 10"), "page_id")


def documents_dump(spark: SparkSession, sf: str) -> DataFrame:
    table = scan_table(spark, sf, "documents")
    return insert_statements(table, "documents", F.expr("doc_id div 10"), "doc_id")


def orders_target(spark: SparkSession, sf: str) -> DataFrame:
    """A target loaded before the last orders arrived, with urgent prices off by
    one, and with orders of its own."""
    orders = scan_table(spark, sf, "orders").selectExpr(
        "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice", "o_orderdate"
    )
    loaded = orders.where("o_orderdate < timestamp_ntz '2001-03-01 00:00:00'").selectExpr(
        "o_orderkey",
        "o_orderstatus",
        """if(o_orderpriority = '1-URGENT' and o_orderstatus = 'P', o_totalprice + 1,
           o_totalprice) o_totalprice""",
    )
    own = orders.where("o_totalprice > 400000").selectExpr(
        "-1 - o_orderkey o_orderkey", "o_orderstatus", "o_totalprice"
    )
    return loaded.unionByName(own)


SQL = {
    "changes": """changes as (
  select printf('binlog.%09d', event_id // 1000) logfile,
         event_id % 1000 * 100 + 4 logpos, 0 row_idx,
         case event_type when 'signup' then 'insert' when 'error' then 'delete'
              else 'update' end op,
         user_id, event_id, event_type, value
  from events)""",
    "line_changes": """line_changes as (
  select 'binlog.' || cast(cast(l_shipdate as date) as varchar) logfile, l_partkey logpos,
         l_suppkey * 10 + l_linenumber row_idx,
         case l_returnflag when 'A' then 'insert' when 'R' then 'delete' else 'update' end op,
         l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_linestatus
  from lineitem)""",
    "raw_log": """raw_log as (
  select event_id ord,
         case when event_type = 'signup' and value < 2 then 'rotate' else 'rows' end kind,
         case when event_type = 'signup' and value < 2
              then printf('binlog.%09d', event_id) end next_log
  from events)""",
    "row_events": """numbered as (
  select *, event_id // 4 batch_id,
         row_number() over (partition by event_id // 4 order by event_id) - 1 i,
         count(*) over (partition by event_id // 4) n,
         case when value > 200 then 4 when event_type = 'view' then 2 else 3 end width
  from events),
row_events as (
  select *, case batch_id % 3 when 0 then 'insert' when 1 then 'update' else 'delete' end op,
         printf('binlog.%09d', batch_id // 250) logfile, batch_id % 250 * 400 + 4 logpos
  from numbered),
images as (
  select *, cast(case when op = 'update' then i // 2 else i end as int) row_idx
  from row_events where op <> 'update' or i % 2 = 1)""",
    "raw_events": """raw_events as (
  select event_id, case when value < 5 then 'archive' else 'shop' end "schema",
         't' || user_id tbl,
         case when value > 150 then 'query' when value > 120 then 'xid'
              when event_type = 'signup' then 'write_rows_v2'
              when event_type = 'purchase' then 'write_rows_v1'
              when event_type = 'view' then 'update_rows_v2'
              when event_type = 'click' then 'update_rows_v1'
              when value > 60 then 'delete_rows_v1' else 'delete_rows_v2' end event_type,
         printf('binlog.%09d', event_id // 1000) logfile, event_id % 1000 * 100 + 4 logpos
  from events)""",
    "registry_log": f"""registry_log as (
  select 't' || user_id tbl, event_id seq, {_STATUS} status,
         case when event_type = 'view' then printf('binlog.%09d', event_id // 1000) end logfile,
         case when event_type = 'view' then event_id % 1000 * 100 + 4 end logpos,
         case when event_type = 'click' then event_id * 3 end dump_read_progress
  from events)""",
    "catalog": f"""catalog as (
  select 'c' || conv_id tbl, cast(turn as int) position, role || '_' || turn name,
         {_TYPE} "type", role = 'system' or turn = 1 is_in_primary_key, text
  from conversations)""",
    "orders_target": """orders_target as (
  select o_orderkey, o_orderstatus,
         case when o_orderpriority = '1-URGENT' and o_orderstatus = 'P' then o_totalprice + 1
              else o_totalprice end o_totalprice
  from orders where o_orderdate < timestamp '2001-03-01 00:00:00'
  union all
  select -1 - o_orderkey, o_orderstatus, o_totalprice from orders where o_totalprice > 400000)""",
}


def cte(*names: str) -> str:
    return "with " + ",\n".join(SQL[n] for n in names) + "\n"
