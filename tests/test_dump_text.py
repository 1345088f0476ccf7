"""Hand-written dumps, round trips, and dumps read from files in splits."""

import datetime
import decimal

import pytest
from pyspark.sql import functions as F

from tidefold.functions.literals import literal_value, read_literals
from tidefold.model import Column, Position
from tidefold.sources import dump_text

LONG = "x'(,;)\\ \n" * 120_000  # about a megabyte

HEADER = r"""-- MySQL dump 10.13
--
-- Host: localhost    Database: shop
-- ------------------------------------------------------
/*!40101 SET NAMES utf8 */;

--
-- Position to start replication or point-in-time recovery from
--

-- CHANGE MASTER TO MASTER_LOG_FILE='binlog.000007', MASTER_LOG_POS=1547;

--
-- Table structure for table `note`
--

DROP TABLE IF EXISTS `note`;
/*!40101 SET @saved_cs_client     = @@character_set_client */;
CREATE TABLE `note` (
  `id` int(11) NOT NULL AUTO_INCREMENT COMMENT 'a, (b) `c` it''s; \'q\'',
  `kind` varchar(16) DEFAULT 'PRIMARY KEY (`x`)',
  `amount` decimal(10,2) DEFAULT NULL,
  `seen` datetime DEFAULT NULL,
  `big` bigint(20) unsigned DEFAULT NULL,
  `flag` tinyint(1) DEFAULT '0',
  `raw` varbinary(8) DEFAULT NULL,
  `odd``name` longtext,
  `mode` set('a','b,)') DEFAULT NULL,
  PRIMARY KEY (`id`,`kind`),
  KEY `k` (`amount`),
  CONSTRAINT `f` FOREIGN KEY (`id`) REFERENCES `other` (`id`)
) ENGINE=InnoDB AUTO_INCREMENT=5 DEFAULT CHARSET=utf8mb4 COMMENT='x; y';
LOCK TABLES `note` WRITE;
/*!40000 ALTER TABLE `note` DISABLE KEYS */;
"""
ROWS = r"""INSERT INTO `note` VALUES (1,'O\'Brien, (x);',-1.50,'2024-02-03 04:05:06',18446744073709551615,1,0x4142,'it''s',NULL),(2,'',NULL,NULL,NULL,0,NULL,'a\\nb\nc\\\'d\%\q','a');
INSERT INTO `note` (`id`,`kind`,`amount`,`seen`,`big`,`flag`,`raw`,`odd``name`,`mode`)
VALUES
(3,'NULL',0.10,NULL,7,1,_binary 'AB','MASTER_LOG_FILE=\'evil\', MASTER_LOG_POS=1','b'),
(4,'7',7,'2024-02-03 00:00:00',0,0,'',NULL,'');
"""


@pytest.fixture(scope="module")
def dump(tmp_path_factory):
    folder = tmp_path_factory.mktemp("dump")
    long = LONG.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n")
    big = f"INSERT INTO `note` VALUES (5,'long',1,NULL,NULL,0,NULL,'{long}',NULL);\n"
    (folder / "note.sql").write_text(HEADER + ROWS + big + "UNLOCK TABLES;\n-- Dump completed\n")
    return str(folder)


def test_columns(spark, dump):
    got = dump_text.dump_columns(dump_text.read_statements(spark, dump))
    rows = [tuple(r) for r in got.orderBy("position").drop("file", "tbl").collect()]
    assert rows == [
        ("id", "int(11)", 0, True),
        ("kind", "varchar(16)", 1, True),
        ("amount", "decimal(10,2)", 2, False),
        ("seen", "datetime", 3, False),
        ("big", "bigint(20) unsigned", 4, False),
        ("flag", "tinyint(1)", 5, False),
        ("raw", "varbinary(8)", 6, False),
        ("odd`name", "longtext", 7, False),
        ("mode", "set('a','b,)')", 8, False),
    ]


def columns(spark, dump):
    got = dump_text.dump_columns(dump_text.read_statements(spark, dump)).drop("file", "tbl")
    return [Column(**r.asDict()) for r in got.collect()]


def check_rows(spark, dump):
    statements = dump_text.read_statements(spark, dump)
    got = dump_text.dump_rows(statements, columns(spark, dump)).orderBy("id").collect()
    D, T = decimal.Decimal, datetime.datetime
    assert [tuple(r)[:-2] for r in got] == [
        (1, "O'Brien, (x);", D("-1.50"), T(2024, 2, 3, 4, 5, 6), D("18446744073709551615"), 1, b"AB", "it's", None),
        (2, "", None, None, None, 0, None, "a\\nb\nc\\'d\\%q", "a"),
        (3, "NULL", D("0.10"), None, D(7), 1, b"AB", "MASTER_LOG_FILE='evil', MASTER_LOG_POS=1", "b"),
        (4, "7", D("7.00"), T(2024, 2, 3), D(0), 0, b"", None, ""),
        (5, "long", D("1.00"), None, None, 0, None, LONG, None),
    ]
    assert all(r["_bad"] == [] for r in got)
    assert [r["_id"] for r in got] == ["1O'Brien, (x);", "2", "3NULL", "47", "5long"]


def test_rows(spark, dump):
    check_rows(spark, dump)


def test_rows_read_in_many_splits(spark, dump):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert dump_text.read_statements(spark, dump).rdd.getNumPartitions() > 4
        check_rows(spark, dump)
        position = dump_text.dump_position(dump_text.read_statements(spark, dump)).first()
        assert (position["logfile"], position["logpos"]) == ("binlog.000007", 1547)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_head_of_a_dump(spark, dump):
    statements = dump_text.read_statements(spark, dump)
    assert dump_text.head_position(statements) == Position("binlog.000007", 1547)
    assert dump_text.head_columns(statements) == columns(spark, dump)


def test_windows_line_ends_and_coordinates_without_semicolon(spark, tmp_path):
    text = (
        "-- CHANGE MASTER TO MASTER_LOG_FILE='b.1', MASTER_LOG_POS=5\n"
        "CREATE TABLE `t` (\n  `a` int,\n  PRIMARY KEY (`a`)\n);\n-- rows\nINSERT INTO `t` VALUES (1),\n(2);\n"
    )
    (tmp_path / "t.sql").write_bytes(text.replace("\n", "\r\n").encode())
    statements = dump_text.read_statements(spark, str(tmp_path), line_end=None)
    assert dump_text.head_position(statements) == Position("b.1", 5)
    cols = dump_text.head_columns(statements)
    assert cols == [Column("a", "int", 0, True)]
    assert sorted(r["a"] for r in dump_text.dump_rows(statements, cols).collect()) == [1, 2]


def test_misfits_are_reported_not_dropped(spark):
    text = "INSERT INTO `t` VALUES (1,'x'),(2,3,4),('y',NULL),(5)"
    df = spark.createDataFrame([(text,)], "value string")
    cols = [Column("a", "int", 0, True), Column("b", "varchar(3)", 1)]
    got = [(r["a"], r["b"], r["_bad"]) for r in dump_text.dump_rows(df, cols).collect()]
    assert got == [(1, "x", []), (2, "3", ["*"]), (None, None, ["a"]), (5, None, [])]
    with pytest.raises(Exception, match="do not fit"):
        dump_text.require_good(dump_text.dump_rows(df, cols)).collect()


def test_position_missing_and_large(spark):
    df = spark.createDataFrame([("f", "-- nothing"), ("g", "MASTER_LOG_FILE='b', MASTER_LOG_POS=99999999999")], "file string, value string").withColumn("ord", F.lit(0))
    got = sorted(map(tuple, dump_text.dump_position(df).collect()))
    assert got == [("f", None, None), ("g", "b", 99999999999)]
    with pytest.raises(ValueError, match="names no log position"):
        dump_text.head_position(df.where("file = 'f'").withColumn("block", F.lit(0)))
    beyond = df.withColumn("value", F.lit("MASTER_LOG_FILE='b', MASTER_LOG_POS=99999999999999999999"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cannot be cast"):
        dump_text.dump_position(beyond).collect()


SHORT = [Column("a", "int", 0, True), Column("b", "varchar(9)", 1)]


def loaded(spark, folder, text):
    (folder / "t.sql").write_bytes(text.encode())
    statements = dump_text.read_statements(spark, str(folder))
    rows = dump_text.require_good(dump_text.dump_rows(statements, SHORT)).drop("_id")
    return sorted(tuple(r) for r in rows.collect())


@pytest.mark.parametrize("end", [";\n", ";\r\n", "; \n", ";\t \r\n"])
def test_line_ends_and_blanks_after_statements(spark, tmp_path, end):
    text = "-- d;x\nCREATE TABLE `t` (`a` int);\nINSERT INTO `t` VALUES (1,'x; y'),(2,NULL);\nINSERT INTO `t` VALUES\n(3,'z') , (4,'');\n"
    line = end[1:].lstrip(" \t")
    text = text.replace(";\n", "@").replace("\n", line).replace("@", end)
    want = [(1, "x; y"), (2, None), (3, "z"), (4, "")]
    assert loaded(spark, tmp_path, text) == want
    assert loaded(spark, tmp_path, text.rstrip()) == want


@pytest.mark.parametrize(
    "text",
    [
        "INSERT INTO `t` VALUES (1,'Kabul'),(2,f(3)),(4,'q');\n",
        "INSERT INTO `t` VALUES (4,'x;\ny'),(5,'z');\n",
        "INSERT INTO `t` VALUES (1,'a'),(2,'b",
        "INSERT INTO `t` VALUES (1,'a'),",
        "INSERT INTO `t` VALUES (1,'a') (2,'b');\n",
        "INSERT INTO `t` VALUES (1,'a'); INSERT INTO `t` VALUES (2,'b');\n",
        "INSERT INTO `t` SELECT 1;\n",
        "INSERT INTO `t` VALUES;\n",
    ],
)
def test_what_cannot_be_read_whole_fails_and_is_reported(spark, tmp_path, text):
    good = "INSERT INTO `t` VALUES (9,'ok');\n"
    with pytest.raises(Exception, match="do not fit: INSERT"):
        loaded(spark, tmp_path, good + text)
    statements = dump_text.read_statements(spark, str(tmp_path))
    assert dump_text.dump_rejects(statements).count() >= 1
    assert dump_text.dump_rows(statements, SHORT).where("a = 9").count() == 1


def test_round_trip_of_written_statements(spark):
    texts = ["", "'", "''", "\\", "\\'", "\\\\n", "a\nb\r\t\0\x1a", "\x01\\\x01'", "),(", "NULL", "é😀", None, "\\%", '"q"', LONG]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, t string")
    statements = dump_text.insert_statements(df, "t", F.lit(0), "id")
    cols = [Column("id", "bigint", 0, True), Column("t", "longtext", 1)]
    got = dump_text.dump_rows(statements, cols).orderBy("id").collect()
    assert [r["t"] for r in got] == texts


def test_create_statement_round_trip(spark):
    cols = [Column("id", "bigint(20)", 0, True), Column("n", "varchar(9)", 1)]
    df = spark.createDataFrame([("f", dump_text.create_statement("t", cols))], "file string, value string")
    got = dump_text.dump_columns(df).drop("file", "tbl").collect()
    assert [Column(**r.asDict()) for r in got] == cols


@pytest.mark.parametrize(
    "literal,expected",
    [
        ("NULL", ("null", None, None)),
        ("42", ("int", "42", 42.0)),
        ("18446744073709551615", ("int", "18446744073709551615", 1.8446744073709552e19)),
        ("18446744073709551616", ("string", "18446744073709551616", None)),
        ("1.50", ("string", "1.50", None)),
        ("1.5e3", ("double", "1.5e3", 1500.0)),
        ("'7'", ("string", "7", None)),
        ("'it''s \\'q\\''", ("string", "it's 'q'", None)),
        ("-1.50", ("double", "-1.50", -1.5)),
        ("-1000000", ("double", "-1000000", -1e6)),
        ("-'abc'", ("string", "minus'abc'", None)),
        ("0x3132", ("double", "12", 12.0)),
        ("0x4142", ("string", "AB", None)),
        ("TRUE", ("int", "1", 1.0)),
        ("now()", ("error", "now()", None)),
        ("DEFAULT", ("error", "DEFAULT", None)),
    ],
)
def test_literal_values(spark, literal, expected):
    df = spark.createDataFrame([(literal,)], "l string")
    read = read_literals(df, {"lit": F.col("l")})
    assert tuple(read.select(literal_value("lit").alias("v")).select("v.*").first()) == expected
