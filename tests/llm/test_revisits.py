import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from oracle import compare, connect
from tidefold.llm import revisits as R

DAY = datetime(2024, 1, 1)


def canon(spark, urls):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, u string")
    return [r.c for r in df.select("i", R.canonical_url(F.col("u")).alias("c")).orderBy("i").collect()]


def test_canonical_url(spark):
    got = canon(
        spark,
        ["HTTP://WWW.Ex.org:80/A/?b=2&a=1&utm_source=x#f", "https://ex.org/A?a=1&b=2", "ex.org", "http://ex.org:8080/", None, " ", "#x"],
    )
    assert got == ["ex.org/A?a=1&b=2", "ex.org/A?a=1&b=2", "ex.org", "ex.org:8080", None, None, None]


def low(h):
    return {k.strip().lower(): v for k, v in (h or {}).items()}


def brute(records, canon_of):
    full = {}
    for rid, kind, uri, date, status, h, body, *_ in records:
        if kind == "response" and status == 200 and None not in (body, rid, date, canon_of[uri]):
            full.setdefault(rid, (canon_of[uri], date, low(h), body))
    out = []
    for rid, kind, uri, date, status, h, *_ in records:
        if kind != "revisit":
            continue
        url = canon_of[uri]
        old = [(d, r) for r, (u, d, _, _) in full.items() if date and url and u == url and d < date]
        if not old:
            out.append((rid, url, "missing", None, None, None))
            continue
        src = max(old)[1]
        sh, fresh = full[src][2], low(h)
        tag = lambda x: x.get("etag") and x["etag"].removeprefix("W/")
        agree = None
        if tag(sh) and tag(fresh):
            agree = tag(sh) == tag(fresh)
        elif sh.get("last-modified") and fresh.get("last-modified"):
            agree = sh["last-modified"] == fresh["last-modified"]
        if agree is False:
            out.append((rid, url, "changed", src, None, None))
            continue
        new = {k: v for k, v in fresh.items() if k in R.PERMITTED and v is not None}
        out.append((rid, url, "resolved" if agree else "unchecked", src, str(sorted({**sh, **new}.items())), full[src][3]))
    return sorted(out, key=str)


def data():
    rng = random.Random(3)
    urls = ["http://a.org/x", "https://www.a.org/x/", "http://a.org/y?b=1&a=2", None, "", "http://hot.org/"]
    rows = []
    for i in range(400):
        kind = rng.choice(["response", "revisit", "request", None])
        uri = rng.choice(urls + ["http://hot.org/"] * 5)
        date = rng.choice([None, *[DAY + timedelta(hours=rng.randint(0, 60)) for _ in range(9)]])
        h = rng.choice([None, {}, {"ETag": rng.choice(['"1"', 'W/"1"', '"2"']), "Content-Type": "t"}, {"Last-Modified": rng.choice("ab"), "DATE": "d", "X": None}, {"etag": '"1"', "expires": "e", "content-type": "no"}])
        rows.append((i if rng.random() < 0.97 else None, kind, uri, date, rng.choice([200, 200, 200, 404, None]), h, rng.choice(["body %d" % i, "", None, "b"]), "url"))
    return rows + [rows[-1]]


def test_resolve_equals_brute_force(spark):
    rows = data()
    uris = sorted({r[2] for r in rows}, key=str)
    canon_of = dict(zip(uris, canon(spark, uris)))
    # A repeated id is one response; keep ids of the data apart but for whole repeated rows.
    df = spark.createDataFrame(rows, R.RECORD + ", url string")
    got = [
        (r.record_id, r.url, r.outcome, r.source_id, None if r.headers is None else str(sorted(r.headers.items())), r.body)
        for r in R.resolve(df).collect()
    ]
    want = brute(rows, canon_of)
    assert sorted(got, key=str) == want
    assert {w[2] for w in want} == {"missing", "changed", "resolved", "unchecked"}


def test_header_names_that_differ_in_case_only(spark):
    df = spark.createDataFrame(
        [(1, "response", "a.org/x", DAY, 200, {"ETag": "1", "etag": "2"}, "b"), (2, "revisit", "a.org/x", DAY + timedelta(1), 304, {"ETAG": "2"}, None)],
        R.RECORD,
    )
    r = R.resolve(df).first()
    assert r.outcome == "resolved" and r.headers == {"etag": "2"} and r.body == "b"


def test_empty_table(spark):
    assert R.resolve(spark.createDataFrame([], R.RECORD)).collect() == []


def test_oracle(spark):
    sf = "/root/testdata/sf0.001"
    same, n, want, diff = compare(spark, connect(sf), R.op7_revisits, R.ORACLE, sf)
    assert same and n, (n, want, diff)
