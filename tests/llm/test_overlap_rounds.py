"""The last round of near copies: as many rows as texts have shingles, whatever their groups."""

import random

import numpy as np
from test_overlap import brute, corpus

from tidefold.llm import overlap as O


def kin(n, changed):
    """Texts of one base, most of them further than 0.8 from each other."""
    rng = random.Random(3)
    rows = []
    for k in range(n):
        w = [f"g{k}" for k in range(100)]
        for at in rng.sample(range(100), changed):
            w[at] = f"y{rng.randint(0, 9)}"
        rows.append((k, " ".join(w)))
    return rows


def test_a_large_group_makes_no_row_for_each_pair(spark, monkeypatch):
    rows, counts, stored = kin(200, 3), {}, O.stored

    def counted(df, purpose):
        out = stored(df, purpose)
        counts[purpose] = max(out.count(), counts.get(purpose, 0))
        return out

    monkeypatch.setattr(O, "stored", counted)
    monkeypatch.setattr(O, "_counts", lambda texts, width: np.zeros(1 << 16, np.uint8))
    monkeypatch.setattr(O, "STAR_ROUNDS", 0)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(map(tuple, O.near_copies(df).collect()), key=str) == brute(rows)
    assert max(counts.values()) <= counts["overlap-shared"], counts


def test_blocks_of_groups_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(O, "BLOCK_BYTES", 1 << 12)
    monkeypatch.setattr(O, "STAR_ROUNDS", 1)
    rows = corpus() + [(1000 + k, t) for k, t in kin(60, 3)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(map(tuple, O.near_copies(df).collect()), key=str) == brute(rows)


def test_sketches_keep_all_alike_sets():
    rng = np.random.default_rng(5)
    for n in (1, 3, 9, 60, 64, 65, 500, 4000):
        base = np.unique(rng.integers(0, 1 << 63, n, np.uint64))
        sets = [base]
        for _ in range(20):
            k = int(rng.integers(0, n // 3 + 1))
            sets.append(np.unique(np.r_[base[k // 2 :], rng.integers(0, 1 << 63, k, np.uint64)]))
        sets = [s for s in sets if len(s)]
        size = np.array([len(s) for s in sets])
        near = O._Sketches([O._sketch(s) for s in sets], size).near(0, np.arange(len(sets)))
        both = np.array([len(np.intersect1d(sets[0], s)) for s in sets])
        assert near[9 * both >= 4 * (size[0] + size)].all()
    far = [np.unique(rng.integers(0, 1 << 63, 300, np.uint64)) for _ in range(50)]
    size = np.array([len(s) for s in far])
    assert O._Sketches([O._sketch(s) for s in far], size).near(0, np.arange(50)).sum() == 1
