"""Many tables in one pass: fold, state by levels, bulk text; equal to a model, bounded work."""

import json
import random

import pytest

from tidefold.model import ROW_EVENT_SCHEMA, Column, Followed, Position
from tidefold.operators import normalise
from tidefold.operators import tables as T
from tidefold.plans import sync
from tidefold.sinks import folders
from tidefold.sinks.tables import TablesStore
from tidefold.sinks.writers import TablesBulkSink
from tidefold.sources import dump_text

KINDS = ["write_rows_v2", "update_rows_v2", "delete_rows_v1", "update_rows_v1", "write_rows_v1", "query"]


def followed(n):
    """Tables of different widths and types; every third has a key of two columns."""
    out = []
    for k in range(n):
        columns = [Column("id", "bigint", 0, True), Column("name", "varchar(9)", 1, k % 3 == 2)]
        columns += [Column("amount", "decimal(10,2)", 2), Column("seen", "datetime", 3)][: k % 3]
        out.append(Followed(f"t{k}", columns, Position("binlog.000001", 50)))
    return out


def events(some, n, seed=1, start=0):
    rng = random.Random(seed)
    out = []
    for i in range(start, start + n):
        t = rng.choice(some)
        width = len(t.columns)

        def row():
            full = [str(rng.randint(0, 12)), rng.choice(["a", "b", 'q"é\\'])]
            full += [rng.choice(["1.5", "2", "-3.25", None, "many"]), "2024-01-02 03:04:05"][: width - 2]
            return (full + ["extra"])[: rng.choice([width] * 8 + [max(len(t.key), width - 1), width + 1])]

        rows = [row() for _ in range(rng.choice([1, 2, 3, 4]))]
        out.append(
            dict(schema=rng.choice(["shop"] * 9 + ["other"]), tbl=t.table, event_type=rng.choice(KINDS),
                 logfile=f"binlog.{i // 100 + 1:06d}", logpos=i % 100 * 10, rows=rows)
        )
    return out


def fits(kind, v):
    if v is None or kind in ("varchar(9)", "datetime"):
        return True
    return v.lstrip("-").replace(".", "").isdigit()


def plain(kind, v):
    if v is None:
        return None
    return f"{float(v):.2f}" if kind.startswith("decimal") else v


def model(some, log):
    """A dict for each table; also the number of rejected rows and events."""
    by, docs, rejects = {t.table: t for t in some}, {t.table: {} for t in some}, 0
    for e in sorted(log, key=lambda e: (e["logfile"], e["logpos"])):
        t = by.get(e["tbl"])
        if e["schema"] != "shop" or e["event_type"] == "query" or (e["logfile"], e["logpos"]) <= ("binlog.000001", 50):
            continue
        op = e["event_type"].split("_")[0]
        images = e["rows"][1::2] if op == "update" else e["rows"]
        if any(len(r) > len(t.columns) for r in images):
            rejects += 1
            continue
        for r in images:
            if not all(fits(c.type, v) for c, v in zip(t.columns, r)):
                rejects += 1
                continue
            key = tuple(v for c, v in zip(t.columns, r) if c.is_in_primary_key)
            values = {c.name: plain(c.type, v) for c, v in zip(t.columns, r)}
            if op == "delete":
                docs[e["tbl"]].pop(key, None)
            elif op == "write":
                docs[e["tbl"]][key] = values
            elif key in docs[e["tbl"]]:
                docs[e["tbl"]][key].update(values)
    return docs, rejects


def read(df):
    return sorted(tuple(None if v is None else str(v) for v in r) for r in df.collect())


def wanted(t, docs):
    return sorted(tuple(d.get(c.name) for c in t.columns) for d in docs[t.table].values())


@pytest.fixture(scope="module")
def made(spark):
    some = followed(6)
    log = events(some, 900)
    df = spark.createDataFrame([tuple(e.values()) for e in log], ROW_EVENT_SCHEMA)
    routed = T.route(df, T.catalog_of(spark, "shop", some), T.kinds_in(some)).persist()
    return some, log, routed


def test_one_pass_equals_the_model(spark, made, tmp_path):
    some, log, routed = made
    docs, n = model(some, log)
    assert T.rejected(routed).count() == n
    state = T.fold_tables(T.accepted(routed), 4)
    for t in some:
        assert read(T.documents(state.where(state["tbl"] == t.table), t.columns).drop("present")) == wanted(t, docs)


def test_levels_hold_the_same_in_a_bounded_number_of_files(spark, made, tmp_path):
    some, log, routed = made
    docs, _ = model(some, log)
    changes = T.accepted(routed)
    store = TablesStore(f"{tmp_path}/state", buckets=2, fan=3)
    n = 14
    most = 0
    for b in range(n):
        store.write(changes.where(f"pmod(xxhash64(logfile, logpos), {n}) = {b}"), b)
        store.compact(spark, b)
        one = some[2]
        known = {k: m for (t, k), m in store._manifest(spark).items() if t == one.table}
        most = max(most, len(store._parts(spark, one.table, known, None).inputFiles()))
    # Less than ``fan`` pieces or runs on each of the three levels, for each bucket.
    assert 0 < most <= 2 * 2 * 3 < n * 2
    assert {t.table: read(store.current(spark, t)) for t in some} == {t.table: wanted(t, docs) for t in some}
    # Replaced pieces stay for the readers that know them, then go.
    before = store.touched(spark)
    assert store.retire(spark, older_than=3600) == 0
    assert store.retire(spark, older_than=0) > 0
    assert sum(map(len, store.touched(spark).values())) < sum(map(len, before.values()))
    assert {t.table: read(store.current(spark, t)) for t in some} == {t.table: wanted(t, docs) for t in some}
    # A batch that runs again, merged or not, changes nothing.
    store.write(changes.where(f"pmod(xxhash64(logfile, logpos), {n}) = 1"), 1)
    assert read(store.current(spark, some[0])) == wanted(some[0], docs)


def test_only_touched_buckets_are_merged(spark, tmp_path):
    store = TablesStore(f"{tmp_path}/state", buckets=4, fan=2)
    t = Followed("t", [Column("id", "bigint", 0, True), Column("v", "varchar(9)", 1)], Position())
    rows = [("t", "binlog.000001", p, 0, "insert", [str(p)], [str(p), "v"]) for p in range(40)]
    df = spark.createDataFrame(rows, "tbl string, logfile string, logpos bigint, row_idx int, op string, key array<string>, vals array<string>")
    store.write(df, 0)
    one = df.where("logpos = 7")
    bucket = one.select(T.bucket_of(4)).first()[0]
    store.write(one, 1)
    assert store.compact(spark, 1) == [("t", bucket)]
    assert store.compact(spark, 1) == []
    assert store.current(spark, t).count() == 40
    # A merge that was cut short before it was announced leaves nothing behind.
    store.write(one, 2)
    store.write(one, 3)
    announced = folders.children(spark, f"{store.path}/manifest")
    store.compact(spark, 3)
    fresh = set(folders.children(spark, f"{store.path}/manifest")) - set(announced)
    for f in fresh:
        folders.delete(spark, f"{store.path}/manifest/{f}")
    assert store.current(spark, t).count() == 40 and store.compact(spark, 3) == [("t", bucket)]


def test_a_deleted_key_stays_deleted(spark, tmp_path):
    store = TablesStore(f"{tmp_path}/state", buckets=2, fan=2)
    t = Followed("t:1", [Column("id", "bigint", 0, True), Column("v", "varchar(9)", 1)], Position())
    schema = "tbl string, logfile string, logpos bigint, row_idx int, op string, key array<string>, vals array<string>"
    put = [("t:1", "binlog.000001", 5, 0, "insert", ["1"], ["1", "a"])]
    gone = [("t:1", "binlog.000001", 9, 0, "delete", ["1"], ["1", "a"])]
    for b, r in enumerate((put, gone, put)):
        store.write(spark.createDataFrame(r, schema), b)
        store.compact(spark, b)
    assert store.current(spark, t).collect() == []


def test_bulk_text_of_all_tables(spark, made, tmp_path):
    some, log, routed = made
    docs, _ = model(some, log)
    sink = TablesBulkSink(f"{tmp_path}/out", some)
    changes = T.accepted(routed)
    for b, where in enumerate(("logfile < 'binlog.000004'", "logfile >= 'binlog.000004'")):
        sink(changes.where(where), b)
    for t in some:
        held = {}
        for b in range(2):
            lines = iter([r[0] for r in spark.read.text(f"{tmp_path}/out/bulk/batch_id={b}/tbl={t.table}").collect()])
            for line in lines:
                ((action, at),) = json.loads(line).items()
                assert at["_index"] == t.table
                if action == "index":
                    held[at["_id"]] = json.loads(next(lines))
                elif action == "update":
                    body = json.loads(next(lines))["doc"]
                    if at["_id"] in held:
                        held[at["_id"]].update(body)
                else:
                    held.pop(at["_id"], None)
        want = {"".join(k): {c: float(v) if c == "amount" and v else int(v) if c == "id" else v for c, v in d.items()} for k, d in docs[t.table].items()}
        assert held == want


def test_zero_dates_are_null(spark):
    t = Followed("t", [Column("id", "bigint", 0, True), Column("d", "date", 1), Column("s", "datetime", 2)], Position())
    log = [("shop", "t", "write_rows_v2", "binlog.000001", 9, [["1", "0000-00-00", "0000-00-00 00:00:00"], ["2", "2024-02-30", None]])]
    df = spark.createDataFrame(log, ROW_EVENT_SCHEMA)
    routed = T.route(df, T.catalog_of(spark, "shop", [t]), T.kinds_in([t]))
    assert [(r["key"], r["vals"]) for r in T.accepted(routed).collect()] == [(["1"], ["1", None, None])]
    assert [r["reason"] for r in T.rejected(routed).collect()] == ["values do not fit: d"]
    one = normalise.rows_to_records(df, t.columns)
    assert [tuple(r) for r in one.select("id", "d", "s").collect()] == [(1, None, None)]
    statement = spark.createDataFrame([("INSERT INTO `t` VALUES (1,'0000-00-00','0000-00-00 00:00:00'),(2,'2024-02-30',NULL)",)], "value string")
    got = dump_text.dump_rows(statement, t.columns).select("id", "_bad").collect()
    assert [tuple(r) for r in got] == [(1, []), (2, ["d"])]


def jobs(spark):
    """Jobs started so far."""
    return spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()


def test_jobs_of_a_batch_do_not_depend_on_the_number_of_tables(spark, tmp_path):
    used = {}
    for n in (2, 50):
        at = tmp_path / f"n{n}"
        (at / "log").mkdir(parents=True)
        some = followed(n)
        config = sync.SyncConfig(
            "shop", {t.table: "" for t in some}, f"{at}/log", f"{at}/target",
            sinks=lambda tables: {"bulk": TablesBulkSink(f"{at}/bulk", tables)},
        )
        for b in range(2):
            log = events(some, 300, seed=b, start=300 * b)
            (at / "log" / f"{b}.json").write_text("\n".join(map(json.dumps, log)) + "\n")
            before = jobs(spark)
            sync.follow(spark, config, some, available_now=True)
            used[n, b] = jobs(spark) - before
        docs, _ = model(some, events(some, 300, 0) + events(some, 300, 1, 300))
        for t in some[:4]:
            assert read(sync.store(config).current(spark, t)) == wanted(t, docs)
    assert used[50, 1] <= used[2, 1] + 2, used
