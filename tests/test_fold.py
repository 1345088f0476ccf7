"""The fold against a sequential model of the target."""

import random

import pytest
from pyspark.sql import functions as F

from tidefold.functions.positions import position
from tidefold.model import Position
from tidefold.operators import fold
from tidefold.sources.tables import snapshot

SCHEMA = (
    "case int, k int, logfile string, logpos bigint, row_idx int, op string, "
    "a int, b string, present array<string>"
)
KEY, DOC = ["case", "k"], ["a", "b"]


def random_changes(seed, cases=150, hot=0.34):
    """Random logs; every third row hits key 0, many rows share a position."""
    rng, rows = random.Random(seed), []
    for case in range(cases):
        file, pos, idx = 1, 4, 0
        for _ in range(rng.randrange(1, 40)):
            step = rng.random()
            if step < 0.3:
                idx += 1
            elif step < 0.9:
                pos, idx = pos + rng.randrange(1, 50), 0
            else:
                file, pos, idx = file + 1, 4, 0
            k = 0 if rng.random() < hot else rng.randrange(1, 6)
            op = rng.choice(["insert", "update", "update", "update", "delete"])
            present = [c for c in DOC if rng.random() < 0.7]
            rows.append(
                (
                    case,
                    k,
                    f"binlog.{file:06d}",
                    pos,
                    idx,
                    op,
                    rng.choice([None, rng.randrange(100)]),
                    rng.choice([None, "x", "y", "it's"]),
                    present,
                )
            )
    return rows


def model(rows, partial):
    """Replay in order on a dict, as a search index would."""
    docs, dropped = {}, []
    for case, k, file, pos, idx, op, a, b, present in sorted(rows, key=lambda r: (r[0], *r[2:5])):
        given = {"a": a, "b": b}
        if partial:
            given = {c: given[c] for c in present}
        if op == "insert":
            docs[case, k] = dict(given)
        elif op == "delete":
            docs.pop((case, k), None)
        elif (case, k) in docs:
            docs[case, k].update(given)
        else:
            dropped.append((case, k, file, pos, idx))
    return docs, sorted(dropped)


@pytest.fixture(scope="module", params=[1, 2])
def case(request, spark):
    rows = random_changes(request.param)
    random.Random(7).shuffle(rows)
    return rows, spark.createDataFrame(rows, SCHEMA)


def as_docs(df):
    return {(r["case"], r["k"]): {"a": r["a"], "b": r["b"]} for r in df.collect()}


def test_apply_changes_equals_sequential_replay(case):
    rows, changes = case
    assert as_docs(fold.apply_changes(changes, KEY, DOC)) == model(rows, False)[0]


def test_result_does_not_depend_on_order_or_partitions(case):
    rows, changes = case
    expected = model(rows, False)[0]
    for shuffled in (changes.repartition(1), changes.repartition(13), changes.orderBy(F.rand(3))):
        assert as_docs(fold.apply_changes(shuffled, KEY, DOC)) == expected


def test_pieces_combine_in_any_order_and_repeat(case):
    rows, changes = case
    early, late = changes.where("logpos % 2 = 0"), changes.where("logpos % 2 = 1")
    pieces = [fold.fold_state(p, KEY, DOC) for p in (late, early, late)]
    state = fold.combine_states(pieces[0].unionByName(pieces[1]).unionByName(pieces[2]), KEY)
    assert as_docs(fold.live_rows(state, KEY)) == model(rows, False)[0]


def test_net_actions_have_the_effect_of_all_changes(case):
    rows, changes = case
    actions = fold.net_actions(fold.fold_state(changes, KEY, DOC), KEY).collect()
    before = {(c, k): {"a": -1, "b": "old"} for c in range(150) for k in range(0, 6, 2)}
    # Replaying the whole log over the same old target ...
    docs = {key: dict(v) for key, v in before.items()}
    for c, k, *_seq, op, a, b, _present in sorted(rows, key=lambda r: (r[0], *r[2:5])):
        if op == "insert" or (op == "update" and (c, k) in docs):
            docs[c, k] = {"a": a, "b": b}
        elif op == "delete":
            docs.pop((c, k), None)
    # ... ends where one action per key does.
    for r in actions:
        key = (r["case"], r["k"])
        if r["op"] == "delete":
            before.pop(key, None)
        elif r["op"] == "insert" or key in before:
            before[key] = r["doc"].asDict()
    assert before == docs


def test_merge_changes_equals_sequential_replay(case):
    rows, changes = case
    merged = fold.merge_changes(changes, KEY, DOC)
    got = {
        (r["case"], r["k"]): {c: r[c] for c in r["present"]} for r in merged.collect()
    }
    assert got == model(rows, True)[0]


def test_merge_pieces_combine(case):
    rows, changes = case
    pieces = [
        fold.merge_state(changes.where(p), KEY, DOC) for p in ("k >= 2 or logpos > 60", "logpos <= 99")
    ]
    state = fold.combine_merge_states(pieces[0].unionByName(pieces[1]), KEY, DOC)
    got = {
        (r["case"], r["k"]): {c: r[c] for c in r["present"]}
        for r in fold.merged_rows(state, KEY, DOC).collect()
    }
    assert got == model(rows, True)[0]


def test_dropped_updates_equal_sequential_replay(case):
    rows, changes = case
    for bucket_bytes in (1 << 26, 300, 1):
        got = fold.dropped_updates(changes, KEY, bucket_bytes)
        got = got.select("case", "k", "logfile", "logpos", "row_idx").collect()
        assert sorted(tuple(r) for r in got) == model(rows, False)[1]


def test_snapshot_plus_log(spark):
    taken = Position("binlog.000002", 100)
    table = spark.createDataFrame([(1, "one"), (2, "two"), (3, "three")], "id int, v string")
    log = spark.createDataFrame(
        [
            (1, "stale", "binlog.000002", 100, 0, "update"),
            (2, "stale", "binlog.000001", 900, 0, "delete"),
            (1, "new", "binlog.000002", 101, 0, "update"),
            (3, None, "binlog.000003", 4, 0, "delete"),
            (4, "four", "binlog.000003", 4, 1, "insert"),
        ],
        "id int, v string, logfile string, logpos bigint, row_idx int, op string",
    )
    got = fold.snapshot_plus_log(snapshot(table, taken), log, taken, ["id"], ["v"])
    assert sorted(tuple(r) for r in got.collect()) == [(1, "new"), (2, "two"), (4, "four")]
    assert got.sparkSession.range(1).select(position(F.lit("a"), F.lit(1))).count() == 1


def test_update_and_delete_of_a_target(spark):
    target = spark.createDataFrame([(1, "a", 9), (2, "b", 8)], "id int, v string, kept int")
    changes = spark.createDataFrame(
        [
            (1, None, "f", 1, 0, "update"),
            (1, "z", "f", 0, 0, "update"),
            (3, "miss", "f", 2, 0, "update"),
            (2, None, "f", 3, 0, "delete"),
            (7, None, "f", 3, 1, "delete"),
        ],
        "id int, v string, logfile string, logpos bigint, row_idx int, op string",
    )
    updated = fold.apply_update(target, changes, ["id"], ["v"])
    assert sorted(map(tuple, updated.collect())) == [(1, None, 9), (2, "b", 8)]
    deleted = fold.apply_delete(target, changes, ["id"])
    assert list(map(tuple, deleted.collect())) == [(1, "a", 9)]
