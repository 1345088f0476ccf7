"""Near copies: sketches judge candidates, and only what may be alike is sent whole."""

import random

import numpy as np
import pyarrow as pa
from test_overlap import brute, corpus
from test_overlap_rounds import kin

from tidefold.llm import overlap as O


def test_texts_that_share_a_passage_only_send_no_set(spark, monkeypatch):
    rng, rows, asked, sets = random.Random(6), [], [], O._sets
    for k in range(80):
        if k % 2 == 0:
            line = [f"p{k}x{j}" for j in range(12)]
        rows.append((k, " ".join(line + [f"w{rng.randint(0, 10**9)}" for _ in range(30)])))

    def counted(nodes, *more):
        asked.append(nodes.count())
        return sets(nodes, *more)

    monkeypatch.setattr(O, "_sets", counted)
    monkeypatch.setattr(O, "_counts", lambda texts, width: np.zeros(1 << 16, np.uint8))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(map(tuple, O.near_copies(df).collect())) == [(k, k) for k in range(80)]
    assert sum(asked) == 0, asked


def test_large_and_small_groups_equal_brute_force(spark, monkeypatch):
    rows = corpus() + [(1000 + k, t) for k, t in kin(60, 3)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = brute(rows)
    monkeypatch.setattr(O, "ROOM_TEXTS", 3)
    assert sorted(map(tuple, O.near_copies(df).collect()), key=str) == want
    monkeypatch.setattr(O, "SMALL_GROUP", 1)
    assert sorted(map(tuple, O.near_copies(df).collect()), key=str) == want


def test_rows_of_a_shingle_without_a_partner_go():
    rng = np.random.default_rng(8)
    rows = []
    for token in range(300):
        for _ in range(int(rng.choice([1, 2, 5, 60]))):
            n = int(rng.integers(5, 40))
            rows.append((token, int(rng.integers(0, 10**6)), n, int(rng.integers(0, n // 5 + 1))))
    # A copy that two tasks have sent is no partner of itself.
    rows += [(300, 7, 20, 0), (300, 7, 20, 0)]
    names = ["token", "node", "n", "at"]
    table = pa.table({c: pa.array([r[k] for r in rows], pa.int64()) for k, c in enumerate(names)})

    def room(a, b):
        return a[1] != b[1] and 9 * min(a[2] - a[3], b[2] - b[3]) >= 4 * (a[2] + b[2])

    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    want = sorted({a for g in groups.values() for a in g if any(room(a, b) for b in g)})
    for size in (7, 50, 100_000):
        got = [tuple(r.values()) for b in O._with_room(iter(table.to_batches(size))) for r in b.to_pylist()]
        assert sorted(got) == want
    limit = 8
    large = {t for t, g in groups.items() if len(g) > limit}
    want = sorted([r for r in rows if r[0] in large] + [r for r in want if r[0] not in large])
    before, O.ROOM_TEXTS = O.ROOM_TEXTS, limit
    try:
        for size in (7, 50, 100_000):
            got = [tuple(r.values()) for b in O._with_room(iter(table.to_batches(size))) for r in b.to_pylist()]
            assert sorted(got) == want
    finally:
        O.ROOM_TEXTS = before
