import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidefold.llm import language as L

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame(
        [("ru", "привет как дела сегодня хорошо " * 5), ("el", "καλημέρα τι κάνεις σήμερα " * 5), (None, "x y")],
        "lang string, text string",
    )
    return L.train(docs.where(~L.held_out(F.col("doc_id"))).select("lang", "text").union(extra))


def test_paths_equal_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(40):
        sizes = rng.integers(0, 6, 4)
        scores = rng.normal(size=(int(sizes.sum()), 3))
        got = L.best_paths(scores, sizes, 0.7)
        at = 0
        for n in sizes:
            s = scores[at : at + n]

            def value(p):
                return sum(s[i, k] for i, k in enumerate(p)) - 0.7 * sum(a != b for a, b in zip(p, p[1:]))

            best = max((value(p) for p in itertools.product(range(3), repeat=int(n))), default=0)
            assert abs(value(got[at : at + n].tolist()) - best) < 1e-9
            at += n


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = L.identify(docs, model).select("doc_id", F.col("lang").alias("found"))
    got = found.join(docs, "doc_id").where(L.held_out(F.col("doc_id")))
    n, right = got.agg(F.count("*"), F.sum((F.col("found") == F.col("lang")).cast("int"))).first()
    assert n > 100 and right / n > 0.97


def test_mixed_text_and_odd_rows(spark, model):
    en = "and the thatre of erth onthe is ing that was from with tion " * 3
    de = "der und die sich nicht ein keit schung für zuerst lichen ver " * 3
    rows = [
        (1, en + de, "q", 3),
        (2, en + "привет как дела сегодня " + en, None, 3),
        (3, None, "z", 3),
        (4, "", "z", 3),
        (5, "123 --- !!", "z", 3),
        (6, "漢字漢字 日本", "z", 3),
        (None, en, "z", 3),
        (None, en, "z", 3),
        (7, de * 500, "z", 3),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score int")
    got = L.identify(df, model).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    spans = by[1].spans
    assert [s.lang for s in spans] == ["en", "de"] and abs(spans[0].last - len(en.split())) <= 2
    assert [s.lang for s in by[2].spans] == ["en", "ru", "en"] and by[2].spans[1].last - by[2].spans[1].first == 4
    for k in (3, 4, 5, 6):
        assert by[k].lang == "und" and by[k].score == 0
    assert by[7].lang == "de" and by[7].score > 0.99
    assert sum(r.doc_id is None and r.lang == "en" for r in got) == 2


def test_more_states_than_a_byte_holds():
    scores = np.full((3, 201), -9.0)
    scores[:, 150] = 0.0
    assert L.best_paths(scores, np.array([3]), 1.0).tolist() == [150] * 3


def test_always_names_a_language_where_there_are_letters(spark, model):
    rows = [(1, "漢字文字列"), (2, "漢字 ×5 the"), (3, "12 -- !"), (4, None), (5, "und der die keit"), (6, "漢字 漢字漢 привет")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: (r.lang, r.score) for r in L.identify(df, model, always=True).collect()}
    assert got[1][0] in model.languages and got[1][1] == 0
    assert got[2][0] in ("en", "de", "es", "fr") and 0 < got[2][1] < 1
    assert got[3] == got[4] == ("und", 0.0)
    assert got[5] == ("de", 1.0) and got[6][0] == "ru" and got[6][1] < 0.6


def test_a_small_language_keeps_its_scripts_and_its_text(spark):
    big = [("en", f"word{k} some thing{k} here") for k in range(400)]
    small = [("ru", "привет мир")] * 50
    model = L.train(spark.createDataFrame(big + small, "lang string, text string"), docs_per_language=3, most_grams=40)
    assert model.scripts["Cyrillic"] == [1] and model.languages == ["en", "ru"]
    df = spark.createDataFrame([(1, "мир привет")], "doc_id bigint, text string")
    assert L.identify(df, model).first().lang == "ru"


def test_language_beside_the_row_is_the_same(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(9001, None), (9002, ""), (9003, "漢字"), (9004, "1 2")], docs.schema)
    docs = docs.unionByName(odd)
    want = sorted((r.doc_id, r.lang) for r in L.identify(docs, model).collect())
    for limit in (1, 5000, 8 << 20):
        beside = docs.select("doc_id", L.language_of(F.col("text"), model, limit).alias("lang"))
        assert sorted(map(tuple, beside.collect())) == want


def test_no_labels_and_no_rows(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    model = L.train(none)
    assert L.identify(none, model).collect() == []
    one = spark.createDataFrame([(1, "some words")], "doc_id bigint, text string")
    assert L.identify(one, model).first().lang == "und"
