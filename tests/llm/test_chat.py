import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from oracle import compare, connect
from tidefold.llm import chat as C
from tidefold.llm import turns

SCHEMA = "conv_id bigint, turn bigint, role string, text string, block string, chars int"


def conversations():
    rng = random.Random(3)
    bits = ["\\", "#", "### ", "assistant: ", "</", "</turn>", "\n", "<", "/", "é", "a", " ", ":", "\\#", "<\\/", "\U0001f600"]
    rows = []
    for c in range(80):
        for t in range(rng.randint(1, 9)):
            text = rng.choice([None, "", "".join(rng.choice(bits) for _ in range(rng.randint(1, 30)))])
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "assistant", "system", "a:\\#", "", None]), text))
    rows += [(200, t, ("user", "assistant")[t % 2], f"turn {t} #") for t in range(300)]
    rows += [(None, 0, "user", "u"), (None, 1, "assistant", "a"), (201, 0, "assistant", "x" * 100_000)] + rows[:5]
    return rows


def esc(t, role=False):
    t = t.replace("\\", "\\\\").replace("#", "\\#").replace("</", "<\\/")
    return t.replace(":", "\\:") if role else t


def in_order(rows):
    out = {}
    for c, t, r, x in rows:
        out.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    return {c: [r[2:] for r in sorted(v)] for c, v in out.items()}


def brute(rows):
    out = []
    for c, said in in_order(rows).items():
        text, written = "", 0
        reach = n = 0
        for role, x in said:
            text += f"### {esc(role, True)}: {esc(x)}</turn>\n"
            if role == "assistant":
                written, reach, n = written + len(text), len(text), n + 1
        loss = "".join(x for r, x in said if r == "assistant")
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        out.append((c, len(said), sha("".join(f"{r}\n{x}\n" for r, x in said)), len(loss), sha(loss), written + len(text) - reach, n))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame([(*r, "b", 1) for r in conversations()], SCHEMA).repartition(3)


@pytest.mark.parametrize("batch", ["10000", "7"])
def test_query_equals_brute_force(spark, frame, tmp_path, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        same_as_brute_force(spark, frame, tmp_path)
        # The longest conversation is several tasks.
        tasks = turns.dealt(frame.where("conv_id >= 200")).where("conv_id = 200").select(F.spark_partition_id()).distinct()
        assert tasks.count() > 1
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def same_as_brute_force(spark, frame, tmp_path):
    frame.write.parquet(f"{tmp_path}/conversations.parquet")
    want = brute(conversations() + [(-7, 0, "user", C.CONTROL), (-7, 1, "assistant", C.CONTROL)])
    assert sorted(map(tuple, C.op12_chat(spark, str(tmp_path)).collect()), key=str) == want
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    assert sorted(con.execute(C.ORACLE).fetchall(), key=str) == want


def test_examples_written_out(frame):
    found = C.expand(frame)
    rows = C.texts(found, found.examples.where("conv_id < 40 or conv_id is null")).withColumn("turns", C.read_turns(F.col("text")))
    said = in_order(conversations())
    seen = 0
    for r in rows.collect():
        replies = [k for k, (role, _) in enumerate(said[r.conv_id]) if role == "assistant"]
        own = said[r.conv_id][: replies[r.example] + 1]
        assert [tuple(t) for t in r.turns] == own  # all turns before the reply, and the reply
        assert r.text[r.loss_begin : r.loss_end] == esc(own[-1][1])
        seen += 1
    assert seen == sum(r == "assistant" for c, v in said.items() if c is None or c < 40 for r, _ in v)


def test_all_examples_are_written_and_read_back(frame):
    found = C.expand(frame)
    rows = C.written(found)
    said, n = in_order(conversations()), 0
    for r in rows.where("example is not null").collect():
        whole = said[r.conv_id]
        replies = [k for k, (role, _) in enumerate(whole) if role == "assistant"]
        last = replies[r.example]
        blocks = [f"### {esc(role, True)}: {esc(x)}</turn>\n" for role, x in whole[: last + 1]]
        before = replies[r.example - 1] + 1 if r.example else 0
        assert r.text == "".join(blocks) and r.fresh == len("".join(blocks[:before]))
        assert r.text[r.loss_begin : r.loss_end] == esc(whole[last][1])
        n += 1
    assert n == found.examples.count() == C.texts(found).count()
    # What the examples say is what is digested, not what they were made of.
    altered = rows.withColumn("text", F.replace("text", F.lit("turn 298 "), F.lit("turn 29x ")))
    want = {r.conv_id: r for r in C.digests(found).collect()}
    got = {r.conv_id: r for r in C.read_back(altered).collect()}
    assert {c for c in want if got[c] != want[c]} == {200}


def test_empty_table_and_no_reply(spark):
    none = C.expand(spark.createDataFrame([], SCHEMA))
    assert none.blocks.collect() == [] and none.examples.collect() == [] and C.digests(none).collect() == []
    one = C.expand(spark.createDataFrame([(1, 0, "user", "q", "", 0)], SCHEMA))
    assert one.examples.collect() == [] and C.digests(one).first().loss_chars == 0


def test_oracle(spark):
    sf = "/root/testdata/sf0.001"
    same, n, want, diff = compare(spark, connect(sf), C.op12_chat, C.ORACLE, sf)
    assert same and n, (n, want, diff)
