"""Long documents of many hits: no row of generated code may hold all words for each hit."""

import pytest

import corpus_pipeline
from tidefold.llm import decontaminate as D

ITEM = [f"w{i}" for i in range(30)]
WORDS = 20_000


@pytest.fixture
def items(spark):
    def made(*texts):
        return spark.createDataFrame(list(enumerate(texts)), "item_id bigint, text string")

    return made


def test_hits_at_all_places_of_a_long_document(spark, items):
    # 40,000 hits; with all words of the document for each these are more than 10 GB.
    hot = " ".join((ITEM * (WORDS // 30 + 1))[:WORDS])
    docs = spark.createDataFrame([(1, hot), (2, "pad " * WORDS)], "doc_id bigint, text string")
    got = D.overlaps(docs, items(" ".join(ITEM))).collect()
    assert [tuple(r) for r in got] == [(1, 0, 20, 20)]


def test_short_items_and_a_long_document(spark, items):
    # Seeds of one more kind, none of them in the first document.
    docs = spark.createDataFrame(
        [(1, "pad " * WORDS), (2, "pad " * WORDS + " ".join(ITEM[3:9]))], "doc_id bigint, text string"
    )
    got = D.overlaps(docs, items(" ".join(ITEM), " ".join(ITEM[3:9]))).collect()
    assert [tuple(r) for r in got] == [(2, 1, 6, 6)]


def test_hits_are_cut_to_the_words_around_them_in_one_stage_of_code(spark, items):
    docs = spark.createDataFrame([(1, "pad " * 30)], "doc_id bigint, text string")
    plan = D.overlaps(docs, items(" ".join(ITEM), "a b c"))._jdf.queryExecution().executedPlan()
    plan = plan.toString().split("Initial Plan")[-1].splitlines()
    looked_up = [k for k, line in enumerate(plan) if "BroadcastHashJoin [seed" in line]
    assert len(looked_up) == 2
    for k in looked_up:
        # What takes the hits is made of columns that generated code can make.
        assert "HashAggregate(keys" in plan[k - 2] and "slice(words" in plan[k - 1], plan
        assert "lambda" not in plan[k - 1]


def test_pipeline_stage_drops_a_long_document_of_many_hits(spark, items, tmp_path):
    items(" ".join(ITEM), "a b c").write.parquet(str(tmp_path / "benchmark.parquet"))
    hot = " ".join((ITEM * (WORDS // 30 + 1))[:WORDS])
    rows = [(1, hot), (1, "pad " * WORDS), (None, hot), (2, "pad a b c"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = corpus_pipeline.decontaminated(spark, docs, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.text) for r in got) == [(1, "pad " * WORDS), (3, None)]
