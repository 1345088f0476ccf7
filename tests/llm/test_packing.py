import itertools
import random
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidefold.llm import packing as P

CAPACITY = 64


def check_places(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60))
def test_plan_packs_each_piece_once(lengths):
    counts = {n: lengths.count(n) for n in set(lengths)}
    plan = P.best_two_fit(counts, 40)
    packed = sorted(n for copies, seq in plan for n in seq * copies)
    assert packed == sorted(lengths)
    assert all(sum(seq) <= 40 for _, seq in plan)


def one_sequence_at_a_time(lengths, capacity):
    left, out = sorted(lengths, reverse=True), []
    while left:
        use, rest, gap = [], [], capacity
        for n in left:
            if n <= gap:
                use.append(n)
                gap -= n
            else:
                rest.append(n)
        smallest = min(use)
        if gap:
            pairs = {(min(a, b), max(a, b)) for a, b in itertools.combinations(rest, 2)}
            fits = [p for p in pairs if smallest < sum(p) <= gap + smallest]
            if fits:
                pair = max(fits, key=lambda p: (sum(p), -p[0]))
                use.remove(smallest)
                use += pair
                for n in pair:
                    rest.remove(n)
                rest.append(smallest)
        out.append(sorted(use, reverse=True))
        left = sorted(rest, reverse=True)
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=40), st.integers(1, 4))
def test_plan_equals_one_sequence_at_a_time(lengths, copies):
    lengths = lengths * copies
    plan = P.best_two_fit({n: lengths.count(n) for n in set(lengths)}, 40)
    assert [seq for k, seq in plan for _ in range(k)] == one_sequence_at_a_time(lengths, 40)


def test_smallest_gives_way_to_two():
    # Greedy takes 6 and 3, a gap of 1; two pieces of 2 fill it.
    assert P.best_two_fit({6: 1, 3: 1, 2: 2}, 10)[0] == (1, [6, 2, 2])


def test_as_few_sequences_as_the_bound_nearly():
    rng = random.Random(1)
    counts = {}
    for _ in range(20_000):
        n = min(2048, int(rng.lognormvariate(6, 1)) + 1)
        counts[n] = counts.get(n, 0) + 1
    plan = P.best_two_fit(counts, 2048)
    total = sum(n * k for n, k in counts.items())
    assert sum(c for c, _ in plan) <= -(-total // 2048) * 1.002 + 1


def texts():
    rng = random.Random(2)
    odd = [None, "", " ", "a  b", "a   b ", "x \n y", "\n\n a", "it's 'tis <|endoftext|> b", "é ß 　x", "a\x1cb c", "tail  "]
    out = [(i, t) for i, t in enumerate(odd)]
    for i in range(200):
        w = [rng.choice(["the", "thntion", "Ereß,", "12.5", "don't", "\nÀ"]) for _ in range(rng.randint(1, 90))]
        out.append((100 + i, " ".join(w)))
    return [*out, (None, "no id"), out[20], out[20], (7000, "long word " * 900)]


def test_pieces_and_places(spark):
    rows = texts()
    df = spark.createDataFrame(
        [(i, t, 1, "z") for i, t in rows], "doc_id bigint, text string, offset int, piece string"
    )
    got = P.pack_documents(df, CAPACITY)
    out = got.collect()
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        first = len(ids) % CAPACITY or CAPACITY
        at = [0, *range(first, len(ids), CAPACITY), len(ids)]
        want += [(i, k, a, b - a, np.array(ids[a:b], "<u4").tobytes()) for k, (a, b) in enumerate(zip(at, at[1:]))]
    assert sorted(map(tuple, (r[:5] for r in out)), key=str) == sorted(
        ((i, k, a, n, bytearray(t)) for i, k, a, n, t in want), key=str
    )
    n = check_places(out, CAPACITY)
    assert n <= -(-sum(r["length"] for r in out) // CAPACITY) + 2
    whole = P.sequences(got.sparkSession.createDataFrame(out, got.schema)).collect()
    assert len(whole) == n and all(len(r.tokens) == 4 * sum(r.lengths) for r in whole)


def test_chunks_are_encoded_as_whole_texts():
    ids = P._Ids(*P.default_vocabulary())
    tok = ids.tokenizer
    rng = random.Random(9)
    for _ in range(3000):
        t = "".join(rng.choice(["a", "b1", " ", " ", "\n", "'s", "é", ".", "\t", " ", "<|endoftext|>", "<|"]) for _ in range(rng.randint(0, 12)))
        assert ids.encode(t) == np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), repr(t)


def test_empty_table_and_crc(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert P.pack_documents(empty).collect() == []
    one = spark.createDataFrame([(1, "hello there")], "doc_id bigint, text string")
    row = P.tokenise(one).select("tokens", F.crc32("tokens").alias("c")).first()
    assert row.c == zlib.crc32(bytes(row.tokens))
