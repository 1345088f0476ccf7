import random

import numpy as np

import corpus_pipeline as C
from tidefold.llm import overlap as O
from tidefold.llm import simhash as S


def shingles(text, width=5):
    w = (text or "").lower().split()
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def alike(a, b):
    return 5 * len(a & b) >= 4 * len(a | b)


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    comp = list(range(len(rows)))

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if alike(sets[i], sets[j]):
                comp[find(i)] = find(j)
    best = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            best[find(i)] = min(best.get(find(i), d), d)
    return sorted(((d, best.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def corpus():
    rng = random.Random(9)
    rows, n = [], 0
    line = [f"c{k}" for k in range(30)]  # a passage of many texts
    for _ in range(60):
        base = (line if rng.random() < 0.4 else []) + [f"w{rng.randint(0, 5000)}" for _ in range(rng.randint(1, 90))]
        for _ in range(rng.randint(1, 6)):
            w = list(base)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = f"x{rng.randint(0, 5000)}"
            rows.append((n, " ".join(w)))
            n += 1
    # One group of near copies, most of them further than 0.8 from each other.
    base = [f"g{k}" for k in range(100)]
    for _ in range(40):
        w = list(base)
        for at in rng.sample(range(100), 2):
            w[at] = f"y{rng.randint(0, 9)}"
        rows.append((n, " ".join(w)))
        n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, " \t"), (None, rows[0][1]), rows[1], rows[1], (None, "alone here")]
    return rows


def test_near_copies_equal_brute_force(spark, monkeypatch):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = brute(rows)
    assert sorted(map(tuple, O.near_copies(df).collect()), key=str) == want
    # No star rounds, and all shingles counted as equally common: the same.
    monkeypatch.setattr(O, "STAR_ROUNDS", 0)
    monkeypatch.setattr(O, "_counts", lambda texts, width: np.zeros(1 << 16, np.uint8))
    assert sorted(map(tuple, O.near_copies(df).collect()), key=str) == want


def test_stage_drops_copies_with_a_few_words_changed(spark):
    rng = random.Random(4)
    rows = []
    for k in range(30):
        w = [f"w{rng.randint(0, 5000)}" for _ in range(150)]
        rows.append((2 * k, " ".join(w)))
        for at in (20, 70, 120):
            w[at] = "changed"
        rows.append((2 * k + 1, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = sorted(r.doc_id for r in C.near_dedup(spark, df, "").collect())
    assert kept == list(range(0, 60, 2))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert O.near_copies(df).collect() == []


def test_simhash_names_the_first_candidates(spark):
    texts = sorted({t for _, t in corpus() if t and t.strip()})
    rows = [(int(np.uint64(O._name(O.shingle_set(t))).astype(np.int64)), S.simhash(t, 5)) for t in texts]
    prints = spark.createDataFrame([(n, int(np.uint64(f).astype(np.int64))) for n, f in rows], "node bigint, fp bigint")
    pairs = {(r.a, r.b) for r in O.simhash_pairs(prints).collect()}
    bits = {}
    for n, f in rows:
        bits.setdefault(n, set()).add(f)
    assert pairs and all(a < b for a, b in pairs)
    comp = {n: n for n, _ in rows}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for a, b in pairs:
        comp[find(a)] = find(b)
    for a, f in rows:
        for b, g in rows:
            assert (f ^ g).bit_count() > 4 or find(a) == find(b)


def test_near_copies_go_by_simhash(spark, monkeypatch):
    asked = []
    pairs = O.simhash_pairs
    monkeypatch.setattr(O, "simhash_pairs", lambda prints: asked.append(pairs(prints)) or asked[0])
    df = spark.createDataFrame([(0, "a b c d e f g"), (1, "a b c d e f g"), (2, "A b c d e f g a b c d e f g")], "doc_id bigint, text string")
    assert sorted(map(tuple, O.near_copies(df).collect())) == [(0, 0), (1, 0), (2, 2)] and asked
