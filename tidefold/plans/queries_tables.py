"""Registered queries: many tables at once, resumed loads, delivery and order on streams.

These write to the shared scratch folder and return what a reader finds there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefold.model import ROW_EVENT_SCHEMA, Column, Followed, Position
from tidefold.operators import reconcile as verify
from tidefold.operators import tables
from tidefold.operators.catchup import catchup_many
from tidefold.operators.fold import fold_state, live_rows
from tidefold.plans import inputs
from tidefold.plans.inputs import cte
from tidefold.plans.queries_apply import _FOLD, DOC, KEY
from tidefold.plans.registry import query
from tidefold.session import scratch_dir
from tidefold.sinks.fanout import FanOut
from tidefold.sinks.state import FoldStore
from tidefold.sinks.tables import TablesStore
from tidefold.sinks.writers import BulkTextSink, ChangeLogSink
from tidefold.sources import dump_text, quoted
from tidefold.sources.change_log import broken_lines, good_events, stream_change_log
from tidefold.sources.tables import scan_table as scan
from tidefold.streaming.apply import run_stream
from tidefold.streaming.dropped import DroppedUpdates
from tidefold.streaming.rotation import RotateAttribution


@query("dump_resume", "select * from documents")
def dump_resume(spark: SparkSession, sf: str) -> DataFrame:
    """A dump of which half the splits are loaded, then the rest, as after a kill."""
    folder = scratch_dir(spark, "dump-resume")
    inputs.documents_dump(spark, sf).write.text(f"{folder}/dump")
    size = 1 << 20
    names = [r["split"] for r in dump_text.list_splits(spark, f"{folder}/dump", size).select("split").collect()]
    table = Followed("documents", inputs.DOCUMENTS, Position("binlog.000002", 7))
    store = TablesStore(f"{folder}/state", buckets=2)
    for left_out in (set(sorted(names)[::2]), set()):
        finished = store.loaded(spark, table.table)
        with dump_text.pinned_splits(spark, size):
            statements = dump_text.read_splits(spark, f"{folder}/dump", finished | left_out, size)
            rows = dump_text.dump_rows(statements, table.columns, keep=["split"])
            store.load(tables.snapshot_changes(dump_text.require_good(rows), table, keep=["split"]), table.table)
    return store.current(spark, table)


_LINED = Column("lined", "longtext", 1)


@query("dump_rows_quoted", "select doc_id, replace(text, '. ', ';' || chr(10)) lined from documents")
def dump_rows_quoted(spark: SparkSession, sf: str) -> DataFrame:
    """A dump whose strings hold line breaks, many of them behind ``;``, as they are."""
    folder = scratch_dir(spark, "dump-quoted")
    lined = F.replace("text", F.lit(". "), F.lit(";\n"))
    plain = F.replace(F.replace(lined, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("''"))
    value = F.coalesce(F.concat(F.lit("'"), plain, F.lit("'")), F.lit("NULL"))
    row = F.concat(F.lit("INSERT INTO `d` VALUES ("), F.col("doc_id").cast("string"), F.lit(","), value, F.lit(");"))
    scan(spark, sf, "documents").select(row.alias("value")).write.text(f"{folder}/dump")
    with dump_text.pinned_splits(spark, 4 << 20):
        statements = stored(quoted.read_quoted(spark, f"{folder}/dump"), f"{folder}/statements")
    rows = dump_text.dump_rows(statements, [Column("doc_id", "bigint", 0, True), _LINED])
    return dump_text.require_good(rows).drop("_id")


def stored(rows: DataFrame, path: str) -> DataFrame:
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


# The row events dealt to seven tables, which all have the columns of one.
_SHARES = 7
_TABLES = [
    Followed(f"users{k}", inputs.ROW_COLUMNS, Position("binlog.000000000", 4)) for k in range(_SHARES)
]
# Events with a row that is too wide are rejects; an event's place orders its rows.
_TABLE_CHANGES = (
    cte("row_events")
    + f""", ok as (
    select 'users' || batch_id % {_SHARES} tbl, user_id, op, batch_id * 100 + row_idx seq, batch_id,
           event_id, event_type, width
    from images
    where batch_id not in (select batch_id from images where width > 3)
      and (batch_id >= 250 or batch_id % 250 * 400 > 0)),
  b as (
    select tbl, user_id, max(seq) filter (op <> 'update') s, arg_max(op, seq) filter (op <> 'update') op
    from ok group by 1, 2)
"""
)
_TABLE_ROWS = """select o.tbl, o.user_id,
         arg_max(event_id, seq) filter (o.op <> 'delete' and seq >= s) event_id,
         arg_max(event_type, seq) filter (o.op <> 'delete' and seq >= s and width = 3) event_type
  from ok o join b on o.tbl = b.tbl and o.user_id = b.user_id
  where b.op = 'insert' group by 1, 2"""


def _table_events(spark: SparkSession, sf: str) -> DataFrame:
    events = inputs.row_events(spark, sf)
    number = F.regexp_extract("logfile", r"(\d+)$", 1).cast("int") * 250 + F.floor(F.col("logpos") / 400)
    return events.withColumn("tbl", F.concat(F.lit("users"), (number % _SHARES).cast("string"))).select(
        *ROW_EVENT_SCHEMA.fieldNames()
    )


def _all_rows(spark: SparkSession, store: TablesStore) -> DataFrame:
    out = None
    for t in _TABLES:
        rows = store.current(spark, t).select(F.lit(t.table).alias("tbl"), "user_id", "event_id", "event_type")
        out = rows if out is None else out.unionByName(rows)
    return out


def _routed(spark: SparkSession, events: DataFrame) -> DataFrame:
    return tables.route(events, tables.catalog_of(spark, "shop", _TABLES), tables.kinds_in(_TABLES))


@query("stream_tables", _TABLE_CHANGES + _TABLE_ROWS)
def stream_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Seven tables followed by one stream in one pass, with their state merged by levels."""
    folder = scratch_dir(spark, "stream-tables")
    events = _table_events(spark, sf)
    events.repartitionByRange(6, "logfile", "logpos").write.parquet(f"{folder}/log")
    store = TablesStore(f"{folder}/state", buckets=2, fan=2)

    def handle(batch: DataFrame, batch_id: int) -> None:
        store.write(tables.accepted(_routed(spark, batch)), batch_id)
        store.compact(spark, batch_id)

    stream = stream_change_log(spark, f"{folder}/log", ROW_EVENT_SCHEMA, files_per_trigger=2)
    run_stream(stream, handle, f"{folder}/checkpoint", available_now=True)
    store.retire(spark, older_than=0)
    return _all_rows(spark, store)


@query(
    "table_rejects",
    cte("row_events")
    + f"""select 'users' || batch_id % {_SHARES} tbl, batch_id // 250 file_no, batch_id % 250 * 400 + 4 logpos
    from images where width > 3 and (batch_id >= 250 or batch_id % 250 * 400 > 0)
    group by all""",
)
def table_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Events of all tables that hold a row wider than their table."""
    rejects = tables.rejected(_routed(spark, _table_events(spark, sf)))
    number = F.regexp_extract("logfile", r"(\d+)$", 1).cast("bigint")
    return rejects.select("tbl", number.alias("file_no"), "logpos")


@query(
    "catchup_tables",
    _TABLE_CHANGES
    + """select tbl, user_id, event_id, seq from ok
    where batch_id > 100 + substr(tbl, 6)::int * 40 and batch_id <= 1500 - substr(tbl, 6)::int * 50""",
)
def catchup_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Seven tables replayed, each over a range of its own, in one scan of the log."""
    at = lambda batch: (f"binlog.{batch // 250:09d}", batch % 250 * 400 + 4)
    rows = [(f"users{k}", *at(100 + 40 * k), *at(1500 - 50 * k)) for k in range(_SHARES)]
    ranges = spark.createDataFrame(
        rows, "tbl string, from_logfile string, from_logpos bigint, to_logfile string, to_logpos bigint"
    )
    replayed = catchup_many(_table_events(spark, sf), ranges)
    changes = tables.accepted(_routed(spark, replayed))
    batch = F.regexp_extract("logfile", r"(\d+)$", 1).cast("bigint") * 250 + F.floor(F.col("logpos") / 400)
    return changes.select(
        "tbl",
        F.col("vals")[1].cast("bigint").alias("user_id"),
        F.col("vals")[0].cast("bigint").alias("event_id"),
        (batch * 100 + F.col("row_idx")).alias("seq"),
    )


class DownError(RuntimeError):
    pass


def _batch_edges(changes: DataFrame, *shares: float) -> list[float]:
    """Where a log is cut into batches of about these shares; a sketch of each task is merged."""
    at = ", ".join(map(str, shares))
    edges = changes.selectExpr(f"percentile_approx(event_id, array({at})) e").first()["e"]
    return [float("-inf"), *edges, float("inf")]


@query(
    "fan_out_in_order",
    cte("changes")
    + _FOLD
    + """, live as (select user_id, event_id, event_type from state where boundary = 'insert')
    select 'state' sink, user_id, event_id, event_type from live
    union all select 'bulk', user_id, event_id, event_type from live
    union all select 'log', user_id, event_id, event_type from changes""",
)
def fan_out_in_order(spark: SparkSession, sf: str) -> DataFrame:
    """What each sink holds after all of them failed on the second of four batches, and the
    later batches came while it was still kept.

    The bulk text is read in the order its files were written, as an index takes it.
    """
    folder = scratch_dir(spark, "fan-out-order")
    parts = [f"{folder}/{s}" for s in ("state", "bulk", "log")]
    sinks = {
        "state": FoldStore(parts[0], KEY, DOC),
        "bulk": BulkTextSink(parts[1], "users", KEY, DOC),
        "log": ChangeLogSink(parts[2]),
    }
    down = [True]

    def failing(sink):
        def call(batch: DataFrame, batch_id: int) -> None:
            if batch_id == 1 and down[0]:
                raise DownError("this sink is down")
            sink(batch, batch_id)

        return call

    fan = FanOut({n: failing(s) for n, s in sinks.items()}, dead_letters=f"{folder}/dead")
    changes = inputs.changes(spark, sf)
    whole = _batch_edges(changes, 0.25, 0.5, 0.75)
    for i in range(4):
        fan(changes.where((F.col("event_id") > whole[i]) & (F.col("event_id") <= whole[i + 1])), i)
        down[0] = i < 2  # up again before the fourth batch
    for name in sinks:
        fan.retry(spark, name, 3)
    live = sinks["state"].current(spark).select(F.lit("state").alias("sink"), *KEY, "event_id", "event_type")
    logged = spark.read.parquet(f"{folder}/log").select(F.lit("log").alias("sink"), *KEY, "event_id", "event_type")
    return live.unionByName(_bulk_documents(spark, f"{folder}/bulk/bulk")).unionByName(logged)


def _bulk_documents(spark: SparkSession, path: str) -> DataFrame:
    """The documents an index holds after bulk text, its files taken in the order of writing."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("written"), F.monotonically_increasing_id().alias("i"),
    )
    act = F.regexp_extract("value", r'^\{"(index|update|delete)":\{"_index"', 1)
    numbered = lines.withColumn("action", act)
    # A document stands on the line behind its action, in the same file.
    bodies = numbered.where("action = ''").select("file", (F.col("i") - 1).alias("i"), F.col("value").alias("body"))
    actions = numbered.where("action <> ''").join(bodies, ["file", "i"], "left")
    fields = "user_id bigint, event_id bigint, event_type string"
    plain = F.when(F.col("action") == "update", F.get_json_object("body", "$.doc")).otherwise(F.col("body"))
    ops = F.create_map(F.lit("index"), F.lit("insert"), F.lit("update"), F.lit("update"), F.lit("delete"), F.lit("delete"))
    changes = actions.select(
        F.date_format("written", "'f.'yyyyMMddHHmmssSSS").alias("logfile"),
        F.lit(0).cast("bigint").alias("logpos"),
        F.lit(0).alias("row_idx"),
        ops[F.col("action")].alias("op"),
        F.regexp_extract("value", r'"_id":"(\d+)"', 1).cast("bigint").alias("user_id"),
        F.from_json(plain, fields).alias("d"),
    ).select("logfile", "logpos", "row_idx", "op", "user_id", "d.event_id", "d.event_type")
    state = fold_state(changes, ["user_id"], ["event_id", "event_type"])
    return live_rows(state, ["user_id"]).select(F.lit("bulk").alias("sink"), "user_id", "event_id", "event_type")


@query(
    "change_source_broken",
    """select case when event_id % 97 = 3 then 'broken' else 'good' end kind,
              case when event_id % 97 <> 3 then event_id end event_id,
              case when event_id % 97 = 3 then '{"event_id": ' || event_id || ', "event_type": "' || event_type end line
       from events""",
)
def change_source_broken(spark: SparkSession, sf: str) -> DataFrame:
    """A log of JSON lines some of which are cut short: what is read, and what is kept apart."""
    folder = scratch_dir(spark, "broken")
    whole = F.to_json(F.struct("event_id", "event_type"))
    cut = F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(', "event_type": "'), "event_type")
    broken = F.col("event_id") % 97 == 3
    lines = scan(spark, sf, "events").select(F.when(broken, cut).otherwise(whole).alias("value"))
    lines.write.text(f"{folder}/log")
    schema = scan(spark, sf, "events").select("event_id", "event_type").schema

    def handle(batch: DataFrame, batch_id: int) -> None:
        good_events(batch).write.mode("overwrite").parquet(f"{folder}/good/batch_id={batch_id}")
        broken_lines(batch).write.mode("overwrite").parquet(f"{folder}/broken/batch_id={batch_id}")

    stream = stream_change_log(spark, f"{folder}/log", schema, fmt="json", quarantine=True)
    run_stream(stream, handle, f"{folder}/checkpoint", available_now=True)
    good = spark.read.parquet(f"{folder}/good").select(
        F.lit("good").alias("kind"), "event_id", F.lit(None).cast("string").alias("line")
    )
    return good.unionByName(
        spark.read.parquet(f"{folder}/broken").select(
            F.lit("broken").alias("kind"), F.lit(None).cast("bigint").alias("event_id"), "line"
        )
    )


@query(
    "stream_rotate",
    cte("raw_log")
    + """select ord, kind, next_log,
           coalesce(last_value(next_log ignore nulls) over (order by ord), 'binlog.000000000') logfile
    from raw_log""",
)
def stream_rotate(spark: SparkSession, sf: str) -> DataFrame:
    """The current file of each event of a stream, also in batches that name none."""
    folder = scratch_dir(spark, "stream-rotate")
    log = inputs.raw_log(spark, sf)
    log.repartitionByRange(16, "ord").sortWithinPartitions("ord").write.parquet(f"{folder}/log")
    # Files are taken in the order of their names, which is that of their rows.
    sink = ChangeLogSink(f"{folder}/seen")
    handle = RotateAttribution(f"{folder}/carried", sink, "binlog.000000000")
    files = sorted(spark.read.parquet(f"{folder}/log").inputFiles())
    for batch_id, start in enumerate(range(0, len(files), 2)):
        handle(spark.read.schema(log.schema).parquet(*files[start : start + 2]), batch_id)
    return spark.read.parquet(f"{folder}/seen").drop("batch_id")


@query(
    "stream_dropped_updates",
    cte("changes")
    + """, seen as (
    select *, last_value(case when op <> 'update' then op end ignore nulls) over (
      partition by user_id order by logfile, logpos rows between unbounded preceding and 1 preceding) before
    from changes)
  select user_id, event_id from seen where op = 'update' and coalesce(before, 'delete') = 'delete'""",
)
def stream_dropped_updates(spark: SparkSession, sf: str) -> DataFrame:
    """As ``dropped_updates``, batch by batch, with the keys' state carried in the store."""
    folder = scratch_dir(spark, "stream-dropped")
    changes = inputs.changes(spark, sf)
    rows = [
        F.lit("users").alias("tbl"), "logfile", "logpos", "row_idx", "op",
        F.array(F.col("user_id").cast("string")).alias("key"),
        F.array(F.col("user_id").cast("string"), F.col("event_id").cast("string")).alias("vals"),
    ]
    store = TablesStore(f"{folder}/state", buckets=2, fan=2)
    handle = DroppedUpdates(f"{folder}/dropped", store)
    whole = _batch_edges(changes, 0.3, 0.5, 0.9)
    for i in range(4):
        event = F.col("event_id")
        handle(changes.where((event > whole[i]) & (event <= whole[i + 1])).select(*rows), i)
        store.compact(spark, i)
    found = spark.read.parquet(f"{folder}/dropped")
    return found.select(F.col("key")[0].cast("bigint").alias("user_id"), F.col("vals")[1].cast("bigint").alias("event_id"))


_ID_COLUMNS = [Column("c_custkey", "bigint", 0, True), Column("c_nationkey", "int", 1, True)]


@query(
    "reconcile_by_id",
    """with s as (select *, c_custkey || '' || c_nationkey id from customer),
  t as (
    select id, arg_max(c_name, c_custkey) c_name,
           arg_max(case when c_custkey % 11 = 5 then c_acctbal + 1 else c_acctbal end, c_custkey) c_acctbal
    from s where c_custkey % 13 <> 4 group by id)
  select s.id _id, case when t.id is null then 'missing'
           when s.c_name = t.c_name and s.c_acctbal = t.c_acctbal then 'verified' else 'mismatch' end status,
         t.id is null or s.c_name <> t.c_name or s.c_acctbal <> t.c_acctbal is_missing,
         count(*) over (partition by s.id) > 1 collides
  from s left join t using (id)""",
)
def reconcile_by_id(spark: SparkSession, sf: str) -> DataFrame:
    """Customers against the documents that an index keyed by rendered ids would hold."""
    source = scan(spark, sf, "customer")
    key = F.concat(F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string"))
    changed = F.when(F.col("c_custkey") % 11 == 5, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
    target = (
        source.where("c_custkey % 13 <> 4")
        .groupBy(key.alias("_id"))
        .agg(F.max_by("c_name", "c_custkey").alias("c_name"), F.max_by(changed, "c_custkey").alias("c_acctbal"))
    )
    return verify.reconcile_by_id(source, target, _ID_COLUMNS, ["c_name", "c_acctbal"], buckets=512)


@query(
    "reconcile_by_digest",
    cte("orders_target")
    + """select o.o_orderkey, case when t.o_orderkey is null then 'missing'
           when o.o_orderstatus = t.o_orderstatus and o.o_totalprice = t.o_totalprice
           then 'verified' else 'mismatch' end status,
         t.o_orderkey is null or o.o_orderstatus <> t.o_orderstatus or o.o_totalprice <> t.o_totalprice is_missing
  from orders o left join orders_target t on o.o_orderkey = t.o_orderkey
  union all
  select o_orderkey, 'target_only', false from orders_target
  where o_orderkey not in (select o_orderkey from orders)""",
)
def reconcile_by_digest(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["o_orderstatus", "o_totalprice"]
    source = scan(spark, sf, "orders").select("o_orderkey", *columns)
    return verify.reconcile_by_digest(
        source, inputs.orders_target(spark, sf), ["o_orderkey"], columns, buckets=1024, target_only=True
    )


@query(
    "doc_diff_present",
    """with s as (
    select event_id, event_type, value, event_type <> 'view' has_type, event_type <> 'click' has_value from events),
  t as (
    select event_id, event_type, case when event_id % 5 = 0 then value + 1 else value end as value,
           event_id % 3 <> 0 has_type, event_id % 7 <> 1 has_value from events),
  f as (
    select s.event_id, 'event_type' column_name, s.has_type ours, t.has_type theirs,
           case when s.has_type then s.event_type end a, case when t.has_type then t.event_type end b
    from s join t using (event_id)
    union all
    select s.event_id, 'value', s.has_value, t.has_value,
           case when s.has_value then s.value::varchar end, case when t.has_value then t.value::varchar end
    from s join t using (event_id))
  select event_id, column_name, case when ours and not theirs then 'lacking' when theirs and not ours then 'extra'
           else 'value' end reason
  from f where ours <> theirs or (ours and theirs and a <> b)""",
)
def doc_diff_present(spark: SparkSession, sf: str) -> DataFrame:
    """Fields that differ, or that one of the two documents does not have."""

    def side(value, has_type, has_value) -> DataFrame:
        fields = F.array_compact(F.array(F.when(has_type, "event_type"), F.when(has_value, "value")))
        return scan(spark, sf, "events").select(
            "event_id", F.when(has_type, F.col("event_type")).alias("event_type"),
            F.when(has_value, value).alias("value"), fields.alias("present"),
        )

    kind, number = F.col("event_type"), F.col("event_id")
    source = side(F.col("value"), kind != "view", kind != "click")
    moved = F.when(number % 5 == 0, F.col("value") + 1).otherwise(F.col("value"))
    target = side(moved, number % 3 != 0, number % 7 != 1)
    found = verify.doc_diff(source, target, ["event_id"], ["event_type", "value"], present="present")
    return found.select("event_id", "column_name", "reason")
