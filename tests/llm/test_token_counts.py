import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidefold.llm import token_counts as T

PARTS = ["the", " thntion", " ", "  ", "\n", "'s", "'re", "'", "12", " é", "ß漢", ".", "!!", "\t", "\n\n ", "x'll"]


@pytest.fixture(scope="module")
def counter():
    return T.Counter()


def whole(text, counter):
    return len(counter.encoding.encode_ordinary(text))


@pytest.mark.parametrize("leaf", [1, 3, 64])
def test_edits_equal_encoding_anew(counter, leaf, monkeypatch):
    monkeypatch.setattr(T, "LEAF", leaf)
    rng = random.Random(leaf)
    some = lambda n: "".join(rng.choice(PARTS) for _ in range(n))
    for _ in range(60):
        text = some(rng.choice([0, 1, 5, 60, 300]))
        tree = T.Tree(T.split(text, counter))
        for _ in range(12):
            at, removed, added = rng.randint(0, len(text) + 2), rng.choice([0, 0, 1, 7, 400]), some(rng.choice([0, 1, 2, 40]))
            want = text[: min(at, len(text))] + added + text[min(at, len(text)) + removed :]
            text, tree, _ = T.edit(text, tree, at, removed, added, counter)
            assert text == want
            assert tree.tokens == whole(text, counter), repr(text)
            assert tree.chars == len(text)


def test_only_the_region_is_encoded_again(counter):
    text = "and the thatre of erth " * 2000
    tree = T.Tree(T.split(text, counter))
    _, tree, n = T.edit(text, tree, 20_000, 3, "ab c", counter)
    assert n < 2_500


def test_build_and_apply(spark, counter):
    rows = [(1, "Hello the world, it's fine. " * 40), (2, None), (3, ""), (None, "x y"), (None, "x y"), (4, "long " * 20_000)]
    df = spark.createDataFrame([(i, t, 9) for i, t in rows], "doc_id bigint, text string, n_tokens int")
    state = T.build(df.withColumn("edits", T.edits_of(F.coalesce("text", F.lit("")))), keep=("edits",))
    for r in T.apply_edits(state).collect():
        assert r.n_tokens == whole(r.text, counter) == sum(r.leaf_tokens)
        assert sum(r.leaf_chars) == len(r.text)
    nothing = state.withColumn("edits", F.lit(None).cast(state.schema["edits"].dataType))
    for r in T.apply_edits(nothing).collect():
        assert r.n_before == r.n_tokens and r.n_encoded == 0
    odd = state.withColumn("edits", F.expr("array(null, named_struct('at', null, 'removed', 2L, 'added', null), named_struct('at', 999999L, 'removed', null, 'added', 'z'))").cast(state.schema["edits"].dataType))
    for r in T.apply_edits(odd).collect():
        assert r.n_tokens == whole(r.text, counter) and r.text.endswith("z")
    assert T.apply_edits(T.build(df.limit(0).withColumn("edits", T.edits_of(F.lit("")).cast(state.schema["edits"].dataType)), keep=("edits",))).collect() == []


def test_query_equals_encoding_anew(spark, counter):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in T.op10_token_counts(spark, sf).collect()}
    for d, t in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        assert got[d].n_before == whole(t, counter)
        n = len(t)
        t = t[: n // 2] + t[:40] + t[n // 2 :]
        t = t[: n // 3] + t[n // 3 + 25 :]
        a = n * 2 // 3
        t = t[:a] + " 2024-01-02,\n it's  done" + t[a + 10 :]
        assert got[d].n_tokens == whole(t, counter)
