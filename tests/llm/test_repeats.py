import random
import re

import numpy as np
import pytest

from oracle import compare, connect
from tidefold.llm import repeats as R

SCHEMA = "doc_id bigint, text string, kept int, chunk string"


def brute(rows, window):
    docs = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = {}
    for w in docs:
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            seen[k] = seen.get(k, 0) + 1
    out = []
    for (d, _), w in zip(rows, docs):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def texts():
    rng = random.Random(8)
    words = ["aé", "b", "cc", "ddd", "漢字", "E"]
    some = lambda n: [rng.choice(words) + str(rng.randint(0, 30)) for _ in range(n)]
    passages = [some(rng.randint(5, 60)) for _ in range(8)]
    rows = []
    for i in range(120):
        w = some(rng.randint(0, 50))
        for _ in range(rng.randint(0, 2)):
            at = rng.randint(0, len(w))
            p = rng.choice(passages)
            a = rng.randint(0, 6)
            w[at:at] = p[a : len(p) - rng.randint(0, 3)]
        rows.append((i, rng.choice([" ", "\n", " \t ", "\x0b"]).join(w)))
    rows += [(500, None), (501, ""), (502, " \n "), (None, rows[3][1]), rows[4], rows[4], (503, "same " * 90)]
    rows += [(504, "x\x1cy z " * 30), (505, " ".join(some(20_000)))]
    return rows


@pytest.mark.parametrize("window", [35, 8, 1])
def test_equals_brute_force(spark, window, monkeypatch):
    monkeypatch.setattr(R, "CHUNK_BYTES", 2000)
    rows = texts()
    df = spark.createDataFrame([(i, t, 1, "c") for i, t in rows], SCHEMA).repartition(3)
    path = R.stored(df, "test-repeats")
    got = R.remove_repeats(path, window).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, window)


def test_another_scan_layout_between_the_reads(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(R, "CHUNK_BYTES", 2000)
    rows = texts()
    df = spark.createDataFrame([(i, t, 1, "c") for i, t in rows], SCHEMA).repartition(5)
    df.write.parquet(f"{tmp_path}/docs")
    name, store = "spark.sql.files.maxPartitionBytes", R.stored

    def other_layout_after(df, purpose):
        out = store(df, purpose)
        spark.conf.set(name, "2k" if spark.conf.get(name) != "2k" else "64k")
        return out

    monkeypatch.setattr(R, "stored", other_layout_after)
    try:
        got = R.remove_repeats(spark.read.parquet(f"{tmp_path}/docs"), 35).collect()
    finally:
        spark.conf.unset(name)
    assert sorted(map(tuple, got), key=str) == brute(rows, 35)


def test_a_hot_window_is_one_entry_a_chunk():
    chunk = R.Chunk([b"same " * 500, b"same " * 40], 35)
    found = chunk.different_probes()
    assert len(found.values) == 1 and found.many.all() and len(found.inverse) > 500
    windows, _ = chunk.different_windows(chunk.windows)
    assert len(windows.values) == 1 and windows.many.all()


def test_words_in_slices(monkeypatch):
    monkeypatch.setattr(R, "SLICE", 16)
    data = np.frombuffer(b"  ab abcdefghijklmnopqrstuvwxyz0123456789 c ab\n\td abcd ab", np.uint8)
    s, e, h = R.words(data)
    assert [bytes(data[a:b]) for a, b in zip(s, e)] == bytes(data).split()
    by = {}
    for a, b, x in zip(s, e, h):
        by.setdefault(bytes(data[a:b]), set()).add(int(x))
    assert all(len(v) == 1 for v in by.values()) and len({*map(frozenset, by.values())}) == len(by)


def test_rolling_hash_tells_order():
    w = R.mixed(np.arange(1, 60, dtype=np.uint64))
    w = np.r_[w, w[5:30], w[5:30][::-1]]
    for n in (1, 2, 5, 18, 35):
        h = R.rolling(w, n, R.FIRST)
        keys = {}
        for i, x in enumerate(h):
            keys.setdefault(int(x), set()).add(tuple(w[i : i + n].tolist()))
        assert len(h) == len(w) - n + 1 and all(len(v) == 1 for v in keys.values())
        assert len(keys) == len({tuple(w[i : i + n].tolist()) for i in range(len(h))})


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert R.remove_repeats(df).collect() == []


def test_oracle(spark):
    sf = "/root/testdata/sf0.001"
    same, n, want, diff = compare(spark, connect(sf), R.op9_repeats, R.ORACLE, sf)
    assert same and n, (n, want, diff)
