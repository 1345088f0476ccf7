"""The whole job: load from dumps, catch up, follow, restart."""

import dataclasses
import json
import os

import pytest
from pyspark.sql import functions as F

from bulk import bulk_replay
from tidefold import __main__ as job
from tidefold.model import Column, Position
from tidefold.operators import reconcile, registry, target
from tidefold.plans import sync
from tidefold.sinks.writers import TablesBulkSink, TablesLogSink
from tidefold.sources import dump_text

CITY = """-- CHANGE MASTER TO MASTER_LOG_FILE='binlog.000002', MASTER_LOG_POS=100;
CREATE TABLE `city` (
  `ID` int NOT NULL AUTO_INCREMENT,
  `Name` char(35) NOT NULL DEFAULT '',
  `Population` int NOT NULL DEFAULT '0',
  PRIMARY KEY (`ID`)
) ENGINE=InnoDB;
INSERT INTO `city` VALUES (1,'Kabul',1780000),(2,'Qandahar',237500),(3,'Herat',186800);
"""
COUNTRY = """-- CHANGE MASTER TO MASTER_LOG_FILE='binlog.000002', MASTER_LOG_POS=300;
CREATE TABLE `country` (
  `Code` char(3) NOT NULL,
  `Name` char(52) DEFAULT NULL,
  PRIMARY KEY (`Code`)
) ENGINE=InnoDB;
INSERT INTO `country` VALUES ('NLD','Netherlands'),('AFG','Afghanistan');
"""


def event(tbl, kind, pos, rows, schema="world", file="binlog.000002"):
    return dict(schema=schema, tbl=tbl, event_type=kind, logfile=file, logpos=pos, rows=rows)


FIRST = [
    event("city", "delete_rows_v2", 90, [["3", "Herat", "186800"]]),  # before the dump
    event("city", "write_rows_v2", 150, [["4", "Utrecht", "10"], ["5", "Delft", "20"]]),
    event("city", "query", 160, None),
    event("city", "write_rows_v2", 170, [["6", "Elsewhere", "1"]], schema="other"),
    event("country", "delete_rows_v1", 200, [["NLD", "Netherlands"]]),  # before its dump
    event("city", "update_rows_v2", 350, [["1", "Kabul", "1780000"], ["1", "Kabul", "1"]]),
]
SECOND = [
    event("city", "delete_rows_v2", 400, [["2", "Qandahar", "237500"]]),
    event("city", "write_rows_v2", 410, [["7", "Wide", "1", "extra"]]),
    event("country", "update_rows_v2", 420, [["AFG", "x"], ["AFG", "Renamed"]]),
    event("city", "update_rows_v2", 4, [["4", "", "0"], ["4", "Utrecht", "11"]], file="binlog.000003"),
    # A row without its last column keeps the value it had.
    event("city", "update_rows_v2", 9, [["5", "Delft"], ["5", "Delft-Zuid"]], file="binlog.000003"),
]


def write(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows) + "\n")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def config(tmp_path):
    for name, text in (("city", CITY), ("country", COUNTRY)):
        (tmp_path / name).mkdir()
        (tmp_path / name / f"{name}.sql").write_text(text)
    write(tmp_path / "log", "1.json", FIRST)
    return sync.SyncConfig(
        schema="world",
        dumps={t: f"{tmp_path}/{t}" for t in ("city", "country")},
        log=f"{tmp_path}/log",
        target=f"{tmp_path}/target",
        sinks=lambda tables: {
            "log": TablesLogSink(f"{tmp_path}/audit"),
            "bulk": TablesBulkSink(f"{tmp_path}/bulk", tables),
        },
    )


def test_load_follow_and_restart(spark, config, tmp_path):
    tables = sync.load(spark, config)
    city, country = tables
    assert city.key == ["ID"] and country.position == Position("binlog.000002", 300)
    assert rows(sync.store(config).current(spark, city))[2] == (3, "Herat", 186800)
    reg = sync.current_registry(spark, config)
    assert registry.table_status(reg, "city") == "syncing"
    with pytest.raises(KeyError, match="not found"):
        registry.table_status(reg, "lake")

    sync.follow(spark, config, tables, available_now=True)
    write(tmp_path / "log", "2.json", SECOND)
    # Started again: tables come back from the registry, the stream from its checkpoint.
    again = sync.load(spark, config)
    assert again == tables
    sync.follow(spark, config, again, available_now=True)
    assert rows(sync.store(config).current(spark, city)) == [
        (1, "Kabul", 1),
        (3, "Herat", 186800),
        (4, "Utrecht", 11),
        (5, "Delft-Zuid", 20),
    ]
    assert rows(sync.store(config).current(spark, country)) == [("AFG", "Renamed"), ("NLD", "Netherlands")]
    rejects = spark.read.parquet(f"{config.target}/rejects").where("tbl = 'city'")
    assert [(r["logpos"], r["reason"]) for r in rejects.collect()] == [(410, "the value at position 3 belongs to no column")]
    # Three rows of the snapshot and six of the log after it.
    assert spark.read.parquet(f"{tmp_path}/audit").where("tbl = 'city'").count() == 3 + 6
    mapping = json.loads(spark.read.text(f"{tmp_path}/bulk/index/city/mapping").first()[0])
    assert mapping["mappings"]["properties"]["Name"] == {"type": "keyword"}
    docs = bulk_replay(spark, f"{tmp_path}/bulk/bulk", {}, "tbl=city")
    assert sorted((d["ID"], d["Name"], d["Population"]) for d in docs.values()) == rows(
        sync.store(config).current(spark, city)
    )


def test_a_table_added_later_catches_up(spark, config):
    only = dataclasses.replace(config, dumps={"country": config.dumps["country"]})
    assert sync.main_position(spark, only) is None
    sync.follow(spark, only, sync.load(spark, only), available_now=True)
    # The stream has passed the city's dump; its log so far is replayed on load.
    assert sync.main_position(spark, config) == Position("binlog.000002", 350)
    city, _ = sync.load(spark, config)
    assert rows(sync.store(config).current(spark, city)) == [
        (1, "Kabul", 1),
        (2, "Qandahar", 237500),
        (3, "Herat", 186800),
        (4, "Utrecht", 10),
        (5, "Delft", 20),
    ]


def test_unusable_dumps_stop_the_load(spark, config, tmp_path):
    for n, (old, new, error) in enumerate((
        ("char(35)", "enum('a','b')", "enum"),
        ("  PRIMARY KEY (`ID`)\n", "  KEY (`ID`)\n", "primary key"),
        ("MASTER_LOG_POS=100", "", "log position"),
        ("`Name`", "`op`", "reserved"),
        ("'Kabul',1780000", "'Kabul','many'", "do not fit"),
    )):
        (tmp_path / "city" / "city.sql").write_text(CITY.replace(old, new))
        with pytest.raises(Exception, match=error):
            sync.load(spark, dataclasses.replace(config, target=f"{tmp_path}/target{n}"))


def moves(spark, config):
    """The job's own registry, as its moves of status with whether they are legal."""
    log = sync.registry_log(spark, config).where("status is not null")
    checked = registry.status_transitions(log.select(F.col("name").alias("tbl"), "seq", "status"))
    return [(r["tbl"], r["status"], r["legal"]) for r in checked.orderBy("seq").collect()]


@pytest.mark.parametrize("phase", ["dumping", "dumped", "initialized", "moving", "moved", "syncing"])
def test_a_load_killed_at_a_phase_goes_on_by_legal_moves(spark, config, monkeypatch, phase):
    only = dataclasses.replace(config, dumps={"city": config.dumps["city"]}, sinks=lambda tables: {})
    note = sync._note

    def killed(spark, config, table, **fields):
        note(spark, config, table, **fields)
        if fields.get("status") == phase:
            raise KeyboardInterrupt

    monkeypatch.setattr(sync, "_note", killed)
    with pytest.raises(KeyboardInterrupt):
        sync.load(spark, only)
    monkeypatch.setattr(sync, "_note", note)
    (city,) = sync.load(spark, only)
    seen = moves(spark, only)
    assert seen[0][1] == "created" and seen[-1][1] == "syncing" and all(legal for _, _, legal in seen)
    assert rows(sync.store(only).current(spark, city)) == [
        (1, "Kabul", 1780000), (2, "Qandahar", 237500), (3, "Herat", 186800)
    ]


def test_a_killed_load_reads_only_splits_that_are_left(spark, config, tmp_path):
    """Some splits hold a value that does not fit, so their tasks fail after others ended."""
    folder = tmp_path / "city"
    header, insert = CITY.split("INSERT INTO")
    (folder / "city.sql").write_text(header)
    wanted = []
    for f in range(3):
        lines = []
        for k in range(300):
            i = 1000 * f + k
            wanted.append((i, f"City {i}", k))
            lines.append(f"INSERT INTO `city` VALUES ({i},'City {i}',{k});\n")
        (folder / f"rows{f}.sql").write_text("".join(lines))
    good = (folder / "rows2.sql").read_text()
    (folder / "rows2.sql").write_text(good.replace("'City 2299',299", "'City 2299','many'"))
    small = dataclasses.replace(config, dumps={"city": config.dumps["city"]}, split_bytes=4000, sinks=lambda tables: {})
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        with pytest.raises(Exception, match="do not fit"):
            sync.load(spark, small)
        state = sync.store(small)
        first = state.loaded(spark, "city")
        total = dump_text.list_splits(spark, small.dumps["city"], 4000).count()
        assert 0 < len(first) < total
        progress = sync.current_registry(spark, small).first()["dump_read_progress"]
        assert progress == dump_text.list_splits(spark, small.dumps["city"], 4000).where(F.col("split").isin(list(first))).agg(F.sum("size")).first()[0]
        files = {f: os.listdir(f"{small.target}/state/loads/tbl=city/split={f}") for f in first}
        (folder / "rows2.sql").write_text(good)  # that file is another one now
        changed = set(map(lambda r: r["split"], dump_text.list_splits(spark, small.dumps["city"], 4000).collect()))
        kept = first & changed
        assert kept
        with dump_text.pinned_splits(spark, 4000):
            left = {r["split"] for r in dump_text.read_splits(spark, small.dumps["city"], kept, 4000).select("split").distinct().collect()}
        assert not left & kept
        (city,) = sync.load(spark, small)
        assert rows(state.current(spark, city)) == wanted
        # What was loaded before is the same file still, and nothing of the old file is left.
        for f in kept:
            assert os.listdir(f"{small.target}/state/loads/tbl=city/split={f}") == files[f]
        assert state.loaded(spark, "city") <= changed
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert all(legal for _, _, legal in moves(spark, small))


def test_broken_lines_are_kept_apart(spark, config, tmp_path):
    tables = sync.load(spark, config)
    text = (tmp_path / "log" / "1.json").read_text().splitlines()
    text.insert(2, '{"schema": "world", "tbl": "city", "rows": [["9",')
    text.insert(4, "not json at all")
    (tmp_path / "log" / "1.json").write_text("\n".join(text) + "\n")
    with pytest.raises(Exception, match="not events"):
        sync.follow(spark, dataclasses.replace(config, most_broken=1), tables, available_now=True)
    assert sync.main_position(spark, config) is None  # nothing was applied
    sync.follow(spark, config, tables, available_now=True)
    kept = spark.read.parquet(f"{config.target}/broken")
    assert sorted(r["line"] for r in kept.collect()) == sorted([text[2], text[4]])
    assert all(r["file"].endswith("1.json") for r in kept.collect())
    assert sync.main_position(spark, config) == Position("binlog.000002", 350)
    assert (5, "Delft", 20) in rows(sync.store(config).current(spark, tables[0]))
    # The lines after a batch of broken ones only go on; the position does not go back.
    (tmp_path / "log" / "2.json").write_text("broken\n")
    sync.follow(spark, config, tables, available_now=True)
    assert sync.main_position(spark, config) == Position("binlog.000002", 350)
    write(tmp_path / "log", "3.json", SECOND)
    sync.follow(spark, config, tables, available_now=True)
    assert (4, "Utrecht", 11) in rows(sync.store(config).current(spark, tables[0]))


def test_sinks_by_configuration(tmp_path):
    given = {"schema": "s", "log": "l", "target": "t", "dumps": {}, "sinks": {"bulk_text": "b", "log": "c"}}
    assert list(job.configured(given).sinks([])) == ["bulk_text", "log"]
    assert list(job.configured({**given, "active_sinks": ["log"]}).sinks([])) == ["log"]
    for wrong in ({"active_sinks": ["mail"]}, {"sinks": {"mail": "m"}}):
        with pytest.raises(ValueError):
            job.configured({**given, **wrong})


def test_tables_of_the_catalog(spark):
    columns = [Column("id", "int", 0, True), Column("v", "varchar(9)", 1)]
    name = "tidefold_made"
    spark.sql(f"drop table if exists {name}")
    assert target.create_if_missing(spark, name, columns) is True
    assert target.create_if_missing(spark, name, columns) is False
    fresh = spark.createDataFrame([(1, "a")], "id int, v string")
    target.write_rows(fresh, name)
    assert rows(spark.table(name)) == [(1, "a")]
    with pytest.raises(ValueError, match="nothing to append"):
        target.write_rows(fresh.where("id = 2"), name)
    with pytest.raises(ValueError, match="at least one column"):
        target.create_if_missing(spark, "other", [])
    spark.sql(f"drop table {name}")


def test_bucketed_tables_reconcile_without_a_shuffle(spark):
    names = ["tidefold_source", "tidefold_target"]
    df = spark.range(500).selectExpr("id k", "concat('v', id) v")
    for name, part in zip(names, (df, df.where("k > 3"))):
        spark.sql(f"drop table if exists {name}")
        target.save_bucketed(part, name, ["k"], buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        statuses = reconcile.reconcile(*[spark.table(n) for n in names], ["k"], ["v"])
        assert "Exchange" not in statuses._jdf.queryExecution().executedPlan().toString()
        assert statuses.where("status = 'missing'").count() == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in names:
            spark.sql(f"drop table {name}")


def test_registry_keeps_the_last_set_value_of_each_field(spark):
    log = spark.createDataFrame(
        [("t", 1, "created", None), ("t", 3, None, 7), ("t", 2, "dumping", 5), ("u", 1, "created", None)],
        "name string, seq bigint, status string, dump_read_progress bigint",
    )
    got = registry.registry_upsert(log, ["status", "dump_read_progress"])
    assert rows(got.orderBy("name"))[0] == ("t", "dumping", 7)
    wanted = spark.createDataFrame([("t",), ("w",), ("w",)], "name string")
    known = got.select("name", "status")
    assert rows(registry.register_tables(known, wanted)) == [
        ("t", "dumping"), ("u", "created"), ("w", "created")
    ]
    assert registry.resume_phase("dumping") == "created"
    assert registry.resume_phase("moving") == "moving"
