import random
import re

import pytest

from oracle import compare, connect
from tidefold.llm import decontaminate as D

SCHEMA = "doc_id bigint, text string, item_id string, words int"


def tokens(t):
    t = "".join(c for c in (t or "").lower() if c not in D.MARKS)
    return re.sub(r"[\x20\x09-\x0D]+", " ", t).strip(" ").split(" ")


def same_in(dw, iw, shift, f, n):
    return sum(0 <= k + shift < len(dw) and dw[k + shift] == iw[k] for k in range(f, f + n))


def brute(docs, items, span=20, need=0.8):
    out = {}
    for d, dt in docs:
        dw = tokens(dt)
        for i, it in items:
            iw = tokens(it)
            if i is None or iw == [""]:
                continue
            n = min(span, len(iw))
            if len(iw) < 10:
                tried = {(s, 0) for s in range(len(dw) - len(iw) + 1)}
            else:
                tried = set()
                for a in range(len(dw) - 7):
                    for b in range(len(iw) - 7):
                        if any(all(dw[a + k] == iw[b + k] for k, bit in enumerate(m) if bit == "1") for m in D.MASKS):
                            tried |= {(a - b, f) for f in range(max(0, b + 8 - n), min(b, len(iw) - n) + 1)}
            for s, f in tried:
                same = same_in(dw, iw, s, f, n)
                if same >= need * n:
                    out[d, i] = max(out.get((d, i), (0, 0, 0)), (same / n, same, n))
    return sorted(((d, i, m, n) for (d, i), (_, m, n) in out.items()), key=str)


def without_seeds(docs, items, span=20, need=0.8):
    """Pairs that overlap, told by trying every stretch at every place of the document."""
    out = set()
    for d, dt in docs:
        dw = tokens(dt)
        for i, it in items:
            iw = tokens(it)
            n = min(span, len(iw))
            if i is None or iw == [""]:
                continue
            if any(
                same_in(dw, iw, s, f, n) >= need * n
                for f in range(len(iw) - n + 1)
                for s in range(-f, len(dw) - n - f + 1)
            ):
                out.add((d, i))
    return out


def data():
    rng = random.Random(6)
    some = lambda n: [rng.choice("The of And er, on an. é ing st re ha".split()) + rng.choice(["", "x", "y"]) for _ in range(n)]
    items = [(k, some(n)) for k, n in enumerate([40, 30, 14, 8, 7, 25, 55, 5, 9])]
    docs = []
    for d in range(60):
        w = some(rng.randint(0, 40))
        if d % 2:
            p = list(rng.choice(items)[1])
            for _ in range(rng.choice([0, 0, 1, 3, 9])):
                p[rng.randrange(len(p))] = "other"
            a = rng.choice([0, 0, 5, 18])
            at = rng.randint(0, len(w))
            w[at:at] = p[a:]
        docs.append((d, rng.choice([" ", "\n", "\t "]).join(w)))
    docs += [(100, None), (101, ""), (None, docs[1][1]), docs[3], docs[3], (102, "pad " * 3000 + " ".join(items[1][1]))]
    items = [(k, " ".join(w)) for k, w in items] + [(50, None), (51, ""), (None, " ".join(items[0][1]))]
    return docs, items


@pytest.mark.parametrize("most", [10_000, 0])
def test_equals_brute_force(spark, most):
    docs, items = data()
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], SCHEMA)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = D.overlaps(df, bench, most_broadcast=most).collect()
    want = brute(docs, items)
    assert sorted(map(tuple, got), key=str) == want and len(want) > 10


def test_substituted_words_are_found_and_short_overlaps_are_not(spark):
    item = [f"w{i}" for i in range(30)]
    changed = [w if i % 6 != 5 else "zz" for i, w in enumerate(item)]
    docs = spark.createDataFrame(
        [(1, "a b " + " ".join(changed) + " c"), (2, "q " * 30 + " ".join(item[10:17]) + " r" * 30)],
        "doc_id bigint, text string",
    )
    bench = spark.createDataFrame([(7, " ".join(item))], "item_id bigint, text string")
    got = [tuple(r) for r in D.overlaps(docs, bench).collect()]
    assert [r[:2] for r in got] == [(1, 7)] and got[0][2] >= 16


def test_empty_sides(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i")], "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, "a b c d e f g h i")], "item_id bigint, text string")
    assert D.overlaps(docs, bench).count() == 1
    assert D.overlaps(docs.limit(0), bench).collect() == []
    assert D.overlaps(docs, bench.limit(0)).collect() == []


def test_oracle(spark):
    sf = "/root/testdata/sf0.001"
    same, n, want, diff = compare(spark, connect(sf), D.op1_decontaminate, D.ORACLE, sf)
    assert same, (n, want, diff)


def test_short_items_and_recall_against_no_seeds(spark):
    rng = random.Random(12)
    some = lambda n: [f"w{rng.randint(0, 4000)}" for _ in range(n)]
    items = [(k, some(rng.choice([3, 5, 7, 8, 9, 10, 12, 15, 20, 40]))) for k in range(40)]
    docs = []
    for d in range(300):
        _, p = rng.choice(items)
        n = min(20, len(p))
        a = rng.randint(0, len(p) - n)
        part = list(p[a : a + n])
        for at in rng.sample(range(n), rng.randint(0, int(0.2 * n))):
            part[at] = "other"
        docs.append((d, " ".join(some(rng.randint(0, 30)) + part + some(rng.randint(0, 30)))))
    items = [(k, " ".join(w)) for k, w in items]
    docs += [(1000, items[0][1]), (1001, "")]
    want = without_seeds(docs, items)
    df = spark.createDataFrame([(*d, "", 0) for d in docs], SCHEMA)
    its = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in D.overlaps(df, its).collect()}
    assert got <= want
    short = {k for k, t in items if len(t.split()) < 10}
    assert {p for p in want if p[1] in short} <= got  # those are all found
    recall = len(got) / len(want)
    print("recall", recall)
    assert recall >= 0.9, recall
