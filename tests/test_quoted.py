"""Statements cut outside of quotes only, by many tasks; equal to reading byte by byte."""

import random

import pytest
from pyspark.sql import functions as F

from tidefold.model import Column
from tidefold.sources import dump_text, quoted


def plain_scan(text):
    """Statements by one pass over the characters."""
    out, now, state, i = [], "", None, 0
    line_start = 0
    while i < len(text):
        c = text[i]
        now += c
        if state is None:
            if text.startswith("--", i) and (i + 2 == len(text) or text[i + 2] in " \t\r\n"):
                end = text.find("\n", i)
                end = len(text) if end < 0 else end
                now += text[i + 1 : end]
                i = end
                continue
            if text.startswith("/*", i):
                state, i = "*/", i + 1
                now += "*"
            elif c in "'\"`":
                state = c
            elif c == "\n":
                line = text[line_start:i].rstrip(" \t\r")
                if line.endswith(";") and not line.lstrip(" \t").startswith("-- "):
                    out.append(now[:-1])
                    now = ""
                line_start = i + 1
        elif state == "*/":
            if text.startswith("*/", i):
                state, i = None, i + 1
                now += "/"
            elif c == "\n":
                line_start = i + 1
        elif c == "\\" and state != "`" and i + 1 < len(text):
            i += 1
            now += text[i]
            if text[i] == "\n":
                line_start = i + 1
        elif c == state:
            state = None
        elif c == "\n":
            line_start = i + 1
        i += 1
    if now:
        out.append(now)
    return [o.rstrip("\n").rstrip(" \t\r").removesuffix(";") for o in out]


def statement(rng):
    parts = ["a;", "it''s", "\\'", "\\\\", ";\n", "\n", "--x\n", "-- y;\n", "\\\n", '"', "`", "/*", "*/", "é", "b;\r\n"]
    quote = rng.choice("'''\"`")
    inside = [p for p in parts if quote not in p or quote == "'"]
    if quote != "'":
        inside = [p for p in inside if "'" not in p and "\\" not in p]
    body = "".join(rng.choice(inside) for _ in range(rng.randint(0, 12)))
    return f"INSERT {quote}{body}{quote} - / x"


@pytest.mark.parametrize("split", [37, 400, 1 << 20])
def test_statements_equal_one_pass_over_the_characters(spark, tmp_path, split, monkeypatch):
    monkeypatch.setattr(quoted, "CHUNK", 3)
    rng = random.Random(split)
    want = {}
    for f in range(4):
        end = ["\n", "\r\n"][f % 2]
        text = ""
        for _ in range(25):
            text += rng.choice(["", "-- don't; look" + end, "/* it's; \n a comment */ ", "--" + end])
            text += statement(rng) + rng.choice([";", "; ", " ;"]) + end
        (tmp_path / f"f{f}.sql").write_bytes(text.encode())
        want[f"f{f}.sql"] = plain_scan(text)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        with dump_text.pinned_splits(spark, split):
            rows = quoted.read_quoted(spark, str(tmp_path)).orderBy("file", "block", "ord").collect()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    got = {}
    for r in rows:
        got.setdefault(r["file"].rsplit("/", 1)[1], []).append(r["value"])
    strip = lambda v: [x.rstrip(" \t\r\n") for x in v]
    assert {k: strip(v) for k, v in got.items()} == {k: strip(v) for k, v in want.items()}


def test_a_dump_with_line_breaks_in_strings_loads_whole(spark, tmp_path):
    rows = [(i, f"one;\ntwo '' {i};\r\n-- three;\n\\\\") for i in range(300)]
    written = lambda t: "'" + t.replace("\\\\", "\\\\\\\\") + "'"
    for f, end in enumerate(("\n", "\r\n")):
        lines = [f"INSERT INTO `t` VALUES ({i},{written(t)});" for i, t in rows if i % 2 == f]
        (tmp_path / f"{f}.sql").write_bytes((end.join(lines) + end).encode())
    columns = [Column("id", "int", 0, True), Column("v", "text", 1)]
    with dump_text.pinned_splits(spark, 700):
        got = dump_text.require_good(dump_text.dump_rows(quoted.read_quoted(spark, str(tmp_path)), columns))
        got = sorted((r["id"], r["v"]) for r in got.collect())
    assert got == [(i, t.replace("''", "'")) for i, t in rows]


def test_no_files_with_rows(spark, tmp_path):
    (tmp_path / "empty.sql").write_text("")
    assert quoted.read_quoted(spark, str(tmp_path)).collect() == []


def test_long_lines_do_not_exhaust_the_matcher(spark):
    line = "INSERT INTO `t` VALUES (1,'" + "x;''\\' " * 200_000 + "',2);"
    df = spark.createDataFrame([(line,), (line[:-5],), ("',3);",)], "value string")
    got = [r[0] for r in df.select(quoted.line_states(F.col("value"))).collect()]
    assert [g[quoted.OUT] for g in got] == [quoted.OUT, quoted.SINGLE, quoted.SINGLE]
    assert got[2][quoted.SINGLE] == quoted.OUT
