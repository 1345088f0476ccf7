import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tidefold.llm import simhash as S
from tidefold.llm.components import connected


def brute_print(text, width=4):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    sh = [" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(rows):
    rows = [(i, brute_print(t)) for i, t in rows]
    comp = list(range(len(rows)))

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 4:
                comp[find(i)] = find(j)
    best = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            best[find(i)] = min(best.get(find(i), d), d)
    return sorted(
        ((d, f"{f:016x}", best.get(find(i))) for i, (d, f) in enumerate(rows)), key=str
    )


def corpus():
    rng = random.Random(5)
    rows, n = [], 0
    for _ in range(40):
        base = [rng.choice("abcdefghijklmnop") * rng.randint(1, 3) + str(rng.randint(0, 99)) for _ in range(rng.randint(1, 120))]
        for _ in range(rng.randint(1, 4)):
            w = list(base)
            if rng.random() < 0.6:
                w[rng.randrange(len(w))] = "Zed"
            rows.append((n, rng.choice([" ", "\t", "\n\x0b"]).join(w)))
            n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, " \t"), (n + 3, "É ß x"), (None, rows[0][1]), rows[1], rows[1]]
    rows += [(n + 4, "w " * 3000), (None, "alone here now what else")]
    return rows


def test_near_duplicates_equal_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(
        [(i, t, "x", 7) for i, t in rows], "doc_id bigint, text string, fp string, component_id int"
    )
    got = S.near_duplicates(df).select(
        "doc_id", S.hex_fingerprint(F.col("fp")).alias("f"), "component_id"
    )
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_components(rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert S.near_duplicates(df).collect() == []


def test_links_connect_all_pairs_in_range_also_with_cut_cells(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 62, 300, dtype=np.uint64)
    out = set(base.tolist())
    for f in base[:40].tolist():
        for _ in range(30):
            g = f
            for b in rng.integers(0, 64, rng.integers(1, 6)):
                g ^= 1 << int(b)
            out.add(g)
    fps = sorted(out)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp bigint")
    want = {}
    arr = np.array(fps, np.uint64)
    comp = {x: x for x in signed}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i in range(len(arr)):
        for j in np.flatnonzero(np.bitwise_count(arr[:i] ^ arr[i]) <= 4):
            a, b = find(signed[i]), find(signed[j])
            if a != b:
                comp[max(a, b)] = min(a, b)
    want = {x: find(x) for x in signed}
    for rows in (1 << 16, 16):
        got = {r.node: r.root for r in connected(S.links(df, cell_rows=rows)).collect()}
        assert {x: got.get(x, x) for x in signed} == want


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 160)] + [(7, 7)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r.node: r.root for r in connected(df).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{k: 100 for k in range(100, 160)}}
