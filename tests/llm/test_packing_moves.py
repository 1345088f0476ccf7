"""Pieces with their ids stay where they were made: no shuffle holds them."""

from test_packing import check_places

from tidefold.llm import packing as P


def test_pieces_are_not_shuffled_and_have_the_places_of_the_shuffled_ones(spark):
    rows = [(k, "and the of thin " * (k % 40) if k % 7 else None) for k in range(400)]
    rows += [(500, "one two three " * 3000), (None, "x"), (3, "y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    packed = P.pack_documents(docs)
    plan = packed._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan and "broadcast" in plan
    got = packed.collect()
    assert packed.columns == ["doc_id", "piece", "start", "length", "tokens", "sequence_id", "offset"]
    check_places(got, 2048)
    moved = P.pack(P.tokenise(docs)).collect()
    assert sorted((r.sequence_id, r.offset, r.length) for r in got) == sorted((r.sequence_id, r.offset, r.length) for r in moved)
    assert sorted(map(str, ((r.doc_id, r.piece, r.start, r.length, r.tokens) for r in got))) == sorted(
        map(str, ((r.doc_id, r.piece, r.start, r.length, r.tokens) for r in moved))
    )


def test_rows_that_wait_for_python_do_not_hold_the_numbers_of_their_task(spark):
    docs = spark.createDataFrame([(k, "and the of " * (k % 9)) for k in range(50)], "doc_id bigint, text string")
    packed = P.pack_documents(docs.repartition(3))
    tree = packed._jdf.queryExecution().optimizedPlan()
    evals = [tree.p(k) for k in range(100) if tree.p(k) is not None]
    waiting = [n for n in evals if "EvalPython" in n.nodeName()]
    into = [n.children().head().output().mkString(" ") for n in evals if n.nodeName() == "MapInArrow"]
    assert not waiting and into and not any("_bases" in columns for columns in into)
    assert packed.count() == 50
