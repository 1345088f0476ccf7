import itertools
import random
import re

import duckdb

from oracle import compare, connect
from tidefold.llm import filter_audit as A

DOCS = "doc_id bigint, text string, lang string, part string, mask int, steps string"
LABELS = "doc_id bigint, quality int, toxic int, n int"


def brute(docs, labels):
    first = {}
    for d, t, _ in docs:
        if d is not None:
            first[t or ""] = min(first.get(t or "", d), d)
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    rows = []
    for d, t, lang in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": d is not None and first[t] < d}
        rows.append((lang or "", {f for f, x in fails.items() if x}, d in good, d in toxic))
    out = []
    for part in {r[0] for r in rows}:
        own, made = [r for r in rows if r[0] == part], []
        for order in itertools.permutations("ABCDE"):
            left = list(own)
            for k, f in enumerate(order):
                gone = [r for r in left if f in r[1]]
                early = sum(f in r[1] and bool(r[1] & set(order[:k])) for r in own)
                left = [r for r in left if f not in r[1]]
                made.append(("".join(order), k + 1, len(left), len(gone), early, sum(r[1] == {f} for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone)))
        total = {f: sum(m[3] for m in made if m[0][m[1] - 1] == f) for f in "ABCDE"}
        out += [(part, *m, total[m[0][m[1] - 1]]) for m in made]
    return sorted(out)


def tables():
    rng = random.Random(6)
    docs = []
    for i in range(160):
        n = rng.choice([3, 99, 100, 130])
        w = [rng.choice(["aB", "é", "cc", "漢"]) + str(rng.randint(0, rng.choice([9, 5000]))) for _ in range(n)]
        w += rng.choice([[], ["#"], ["CAPITALS" * 20]])
        docs.append((i, rng.choice([" ", "\n", "\x0b "]).join(w), rng.choice(["en", "de", None, ""])))
    docs += [(500 + k, docs[k % 7][1], rng.choice(["en", "fr"])) for k in range(40)]
    docs += [(600, None, "en"), (601, "", "en"), (602, " \t", None), (None, docs[0][1], "en"), (None, "alone", "en"), docs[3], docs[3], (-5, docs[9][1], "de"), (3, "other text", "en"), (700, "word " * 20_000, "en"), (701, "\u00a0" * 50, "fr")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 640, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1)]
    return docs, labels


def test_query_equals_brute_force_and_oracle(spark, tmp_path):
    docs, labels = tables()
    spark.createDataFrame([(*d, "x", 1, "y") for d in docs], DOCS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(*r, 9) for r in labels], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    got = A.op13_filters(spark, str(tmp_path))
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    want = brute(docs, labels)
    assert sorted(map(tuple, got.collect())) == want
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"create view {t} as select * from '{tmp_path}/{t}.parquet/*.parquet'")
    assert sorted(con.execute(A.ORACLE).fetchall()) == want


def test_each_part_has_600_rows(spark):
    docs = spark.createDataFrame([(1, "a", "en"), (2, None, None)], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    got = A.interactions(docs, labels).groupBy("part").count().collect()
    assert sorted(map(tuple, got)) == [("", 600), ("en", 600)]
    assert A.interactions(docs.limit(0), labels).collect() == []


def test_oracle(spark):
    sf = "/root/testdata/sf0.001"
    same, n, want, diff = compare(spark, connect(sf), A.op13_filters, A.ORACLE, sf)
    assert same and n, (n, want, diff)
