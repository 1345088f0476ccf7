"""Changes of many tables in one DataFrame, folded in one pass.

Tables differ in their columns, so a row is kept as one payload: its values by position, as
the text of the declared type.  A change is (tbl, op, position in the log, key values,
payload), and the fold is one aggregation keyed by table and key, whatever the number of
tables.  Rows may be shorter than their table; a value at a position is the last one of the
rows that reach it, so the state has one entry for each width a key was written with.

Nothing here loops over tables: what differs between them comes from a catalog that is
joined, and the declared types that occur, which are few, are spelt out once each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefold.functions.positions import file_number, position
from tidefold.functions.types import ZERO_DATE, spark_type
from tidefold.functions.values import printed_bytes_sql, printed_float_sql
from tidefold.model import DELETE, INSERT, NIL, SEQ, UPDATE, Column, Followed
from tidefold.operators.documents import BULK_ACTIONS, JSON
from tidefold.operators.normalise import after_images, classify_op, row_events_only

CATALOG = (
    "schema string, tbl string, names array<string>, kinds array<string>, keys array<int>, "
    "own_logfile string, own_logpos bigint"
)
CHANGE = ("tbl", *SEQ, "op", "key", "vals")


def kind_of(declared: str) -> str:
    """Name of the Spark type that holds a declared type."""
    return spark_type(declared).simpleString()


def catalog_of(spark: SparkSession, schema: str, tables: Sequence[Followed]) -> DataFrame:
    """One row per followed table: names and types by position, key positions, and the log
    position its snapshot was taken at."""
    rows = []
    for t in tables:
        ordered = sorted(t.columns, key=lambda c: c.position)
        rows.append(
            (
                schema,
                t.table,
                [c.name for c in ordered],
                [kind_of(c.type) for c in ordered],
                [c.position for c in ordered if c.is_in_primary_key],
                t.position.logfile,
                t.position.logpos,
            )
        )
    return spark.createDataFrame(rows, CATALOG)


def kinds_in(tables: Sequence[Followed]) -> list[str]:
    """The types that occur in some tables; few, however many the tables are."""
    return sorted({kind_of(c.type) for t in tables for c in t.columns})


def _by_kind(kinds: Sequence[str], kind: str, each) -> str:
    """SQL that treats a value by the type named in the expression ``kind``."""
    cases = " ".join(f"when '{k}' then {each(k)}" for k in kinds)
    return f"case {kind} {cases} end" if kinds else "cast(null as string)"


def route(events: DataFrame, catalog: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """Rows of the row events of the catalog's tables, after each one's own position.

    Columns: those of a change, ``schema``, ``event_type``, the raw ``row``, and ``bad``:
    why the row is not a change, if it is none.  One row that is too wide spoils its whole
    event, and then the event is one line whose ``rows`` are all of it.  No row is lost: see
    ``accepted`` and ``rejected``.
    """
    own = position("own_logfile", "own_logpos")
    mine = row_events_only(events).join(catalog, ["schema", "tbl"]).where(position() > own)
    images = after_images(F.col("event_type"), F.col("rows"))
    width = F.size("names")
    wide = F.exists(images, lambda row: F.size(row) > width)
    whole = F.array(F.struct(F.lit(None).cast("int").alias("row_idx"), F.lit(None).cast("array<string>").alias("row")))
    each = F.transform(images, lambda row, i: F.struct(i.alias("row_idx"), row.alias("row")))
    lines = mine.withColumn("wide", F.coalesce(wide, F.lit(False))).select(
        "schema", "tbl", "event_type", "logfile", "logpos", "wide", "names", "kinds", "keys",
        F.when(F.col("wide"), F.col("rows")).alias("rows"),
        classify_op(F.col("event_type")).alias("op"),
        F.inline(F.when(F.col("wide"), whole).otherwise(each)),
    )
    text = _by_kind(kinds, "kinds[i]", lambda k: "v" if k == "string" else f"cast(try_cast(v as {k}) as string)")
    vals = F.expr(f"transform(row, (v, i) -> {text})")
    # Inlining keeps what reads the values above the work of making them.
    made = lines.select("*", F.inline(F.array(F.struct(vals.alias("vals")))))
    zero = f"kinds[i] in ('date', 'timestamp', 'timestamp_ntz') and row[i] rlike '{ZERO_DATE}'"
    misfits = F.expr(
        "transform(filter(sequence(0, size(row) - 1), "
        f"i -> row[i] is not null and vals[i] is null and not ({zero})), i -> names[i])"
    )
    reason = F.when(
        F.col("wide"), F.concat(F.lit("the value at position "), width.cast("string"), F.lit(" belongs to no column"))
    ).when((F.size("row") > 0) & (F.size(misfits) > 0), F.concat(F.lit("values do not fit: "), F.array_join(misfits, ", ")))
    return made.select(
        "schema", "tbl", "event_type", *SEQ, "op",
        F.transform("keys", lambda p: F.get("vals", p)).alias("key"),
        "vals",
        F.coalesce("rows", F.array("row")).alias("rows"),
        reason.alias("bad"),
    )


def accepted(routed: DataFrame) -> DataFrame:
    """The changes among routed rows."""
    return routed.where("bad is null").select(*CHANGE)


def rejected(routed: DataFrame) -> DataFrame:
    """The rest, with the reason: events with a row that is too wide, and single misfits."""
    return routed.where("bad is not null").select(
        "schema", "tbl", "event_type", "logfile", "logpos", "rows", F.col("bad").alias("reason")
    )


def snapshot_changes(rows: DataFrame, followed: Followed, keep: Sequence[str] = ()) -> DataFrame:
    """Typed rows of one table as inserts at the position its snapshot was taken at."""
    ordered = sorted(followed.columns, key=lambda c: c.position)
    vals = F.array(*[F.col(c.name).cast("string") for c in ordered])
    return rows.select(
        *keep,
        F.lit(followed.table).alias("tbl"),
        F.lit(followed.position.logfile).alias("logfile"),
        F.lit(followed.position.logpos).cast("bigint").alias("logpos"),
        F.lit(0).alias("row_idx"),
        F.lit(INSERT).alias("op"),
        F.array(*[F.col(c.name).cast("string") for c in ordered if c.is_in_primary_key]).alias("key"),
        vals.alias("vals"),
    )


def bucket_of(buckets: int) -> SparkColumn:
    return F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int")


def entries(changes: DataFrame, buckets: int, keep: Sequence[str] = ()) -> DataFrame:
    """Each change as a state of its own, without any aggregation; ``keep`` names more columns.

    ``width`` is the length of the row; deletes, whose values are never read, have none.
    """
    seq = F.struct(file_number().alias("file_no"), *SEQ)
    written = F.col("op") != DELETE
    return changes.withColumn("_seq", seq).select(
        *keep,
        "tbl",
        bucket_of(buckets).alias("bucket"),
        "key",
        F.when(written, F.size("vals")).otherwise(0).alias("width"),
        F.when(F.col("op") != UPDATE, F.struct(F.col("_seq").alias("seq"), "op")).alias("boundary"),
        F.when(written, F.struct(F.col("_seq").alias("seq"), "vals")).alias("latest"),
    )


def combined(states: DataFrame, among: Sequence[str] = ("tbl", "bucket")) -> DataFrame:
    """States folded, in any order and any number of times: one row per key and width."""
    return states.groupBy(*among, "key", "width").agg(
        F.max("boundary").alias("boundary"), F.max("latest").alias("latest")
    )


def fold_tables(changes: DataFrame, buckets: int) -> DataFrame:
    """Changes of all tables folded; partial maxima go before the one shuffle."""
    return combined(entries(changes, buckets))


def documents(states: DataFrame, columns: Sequence[Column]) -> DataFrame:
    """Documents of one table's states: typed columns, and ``present``, their fields."""
    ordered = sorted(columns, key=lambda c: c.position)
    reaches = {
        c.name: F.max(
            F.when(
                F.col("latest").isNotNull() & (F.col("width") > c.position),
                F.struct(F.col("latest.seq").alias("seq"), F.get("latest.vals", F.lit(c.position)).alias("v")),
            )
        )
        for c in ordered
    }
    whole = states.groupBy("key").agg(
        F.max("boundary").alias("_boundary"), *[v.alias(f"_{k}") for k, v in reaches.items()]
    )
    current = {c.name: F.col(f"_{c.name}.seq") >= F.col("_boundary.seq") for c in ordered}
    return whole.where(F.col("_boundary.op") == INSERT).select(
        *[
            F.when(current[c.name], F.col(f"_{c.name}.v")).try_cast(spark_type(c.type)).alias(c.name)
            for c in ordered
        ],
        F.array_compact(F.array(*[F.when(current[c.name], c.name) for c in ordered])).alias("present"),
    )


def table_actions(states: DataFrame) -> DataFrame:
    """One action per table and key with the same effect as its changes in order.

    ``vals`` holds a struct for each position; null where the action carries no value.  The
    widths of a key, which are no more than its table's columns, meet in one row.
    """
    per_key = states.groupBy("tbl", "key").agg(
        F.max("boundary").alias("boundary"),
        F.max("width").alias("n"),
        F.collect_list(F.when(F.col("latest").isNotNull(), F.struct("width", "latest"))).alias("rows"),
    )
    since = F.col("boundary.seq")
    live = F.filter("rows", lambda r: since.isNull() | (r["latest"]["seq"] >= since))

    def at(p: SparkColumn) -> SparkColumn:
        reach = F.filter(live, lambda r: r["width"] > p)
        last = F.array_max(F.transform(reach, lambda r: F.struct(r["latest"]["seq"].alias("seq"), F.get(r["latest"]["vals"], p).alias("v"))))
        return F.when(last.isNotNull(), F.struct(last["v"].alias("v")))

    op = F.coalesce("boundary.op", F.lit(UPDATE))
    places = F.when(F.col("n") > 0, F.sequence(F.lit(0), F.col("n") - 1))
    return per_key.select(
        "tbl", "key", op.alias("op"), F.when(op != DELETE, F.transform(places, at)).alias("vals")
    )


def action_lines(actions: DataFrame, catalog: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """(tbl, value): bulk request text of ``table_actions``, as ``bulk_lines`` writes it.

    A key without any value would let the index make up an id; it fails the job.
    """
    key_kind = "kinds[keys[i]]"

    def printed(k: str) -> str:
        if k in ("float", "double"):
            return printed_float_sql(f"cast(v as {k})")
        return printed_bytes_sql("cast(v as binary)") if k == "binary" else "v"

    parts = F.expr(f"transform(key, (v, i) -> coalesce({_by_kind(kinds, key_kind, printed)}, '{NIL}'))")
    options = ", ".join(f"'{k}', '{v}'" for k, v in JSON.items())

    def field(k: str) -> str:
        document = f"to_json(struct(cast(x.v as {k}) as v), map({options}))"
        return f"substr({document}, 6, length({document}) - 6)"

    name = "substr(to_json(struct(names[i] as v)), 6, length(to_json(struct(names[i] as v))) - 6)"
    fields = F.expr(
        f"transform(vals, (x, i) -> case when x is not null then concat({name}, ':', {_by_kind(kinds, 'kinds[i]', field)}) end)"
    )
    # A search document holds the key, too, which an update that carries none still names.
    body = F.concat(F.lit("{"), F.array_join(F.array_compact(fields), ","), F.lit("}"))
    named = actions.join(catalog.select("tbl", "names", "kinds", "keys"), "tbl")
    empty = F.raise_error(F.lit("a document without an id")).cast("boolean")
    lines = named.select("tbl", "op", F.array_join(parts, "").alias("_id"), body.alias("body"))
    lines = lines.where(F.when(F.col("_id") != "", True).otherwise(empty))
    action = F.create_map(*[F.lit(x) for pair in BULK_ACTIONS.items() for x in pair])[F.col("op")]
    head = F.to_json(F.create_map(action, F.struct(F.col("tbl").alias("_index"), "_id")))
    wrapped = F.concat(F.lit('{"doc":'), F.col("body"), F.lit("}"))
    second = F.when(F.col("op") == INSERT, F.col("body")).when(F.col("op") == UPDATE, wrapped)
    return lines.select("tbl", F.concat_ws("\n", head, second).alias("value"))
