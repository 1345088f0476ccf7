import hashlib
import random
import re
import zlib

import pytest

from tidefold.llm import repair as R

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id bigint, turn bigint, role string, text string, symbols int, c string"
SHAPE = re.compile(r"(s?(ua)+)?")


def harmed(rows):
    out = []
    for c, t, role, text in rows:
        show = lambda x: " " if x is None else str(x)
        role, text, h = show(role), show(text), zlib.crc32(f"{show(c)}:{show(t)}".encode()) % 20
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        out += [(c, t, "user" if h == 4 else role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))


def fault_of(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        kind = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
        seen.add((role, text))
        out.append(kind)
    return out


def initial(role):
    return role[0] if role and role[0] in "sua" else "?"


def search(rows, kinds):
    """Cheapest edits by (cost, edits) over the text of role initials made so far, all ways tried."""
    def put(into, made, cost, edits):
        if re.fullmatch(r"s?(ua)*u?", made) and ("s" not in made or made[0] == "s"):
            # What follows depends on whether anything stands there and on the last initial.
            key = made[:1] + made[-1:] if made in ("", "s") else made[-1:]
            old = into.get(key)
            if old is None or (cost, edits) < old[:2]:
                into[key] = (cost, edits, made)

    state = {"": (0, "", "")}

    def with_inserts(state):
        for _ in range(3):
            new = dict(state)
            for cost, edits, made in state.values():
                for r in "ua":
                    put(new, made + r, cost + 2, edits + "I")
            state = new
        return state

    for (_, _, role, _), kind in zip(rows, kinds):
        new = {}
        for cost, edits, made in with_inserts(state).values():
            put(new, made, cost + 3, edits + "D")
            if kind not in ("blank", "duplicate"):
                late = kind == "truncated"
                for r in "ua":
                    put(new, made + r, cost + 2 + late, edits + "R")
                if initial(role) != "?":
                    put(new, made + initial(role), cost + late, edits + "K")
        state = new
    return min(v[:2] for v in with_inserts(state).values() if SHAPE.fullmatch(v[2]))


def everything(rows, kinds):
    """All edit sequences with at most three inserts in a gap; for very short conversations."""
    found = []

    def go(k, made, cost, edits, run):
        if run < 3:
            for r in "ua":
                go(k, made + r, cost + 2, edits + "I", run + 1)
        if k == len(rows):
            if SHAPE.fullmatch(made):
                found.append((cost, edits))
            return
        go(k + 1, made, cost + 3, edits + "D", 0)
        if kinds[k] not in ("blank", "duplicate"):
            late = kinds[k] == "truncated"
            for r in "ua":
                go(k + 1, made + r, cost + 2 + late, edits + "R", 0)
            go(k + 1, made + initial(rows[k][2]), cost + late, edits + "K", 0)

    go(0, "", 0, "", 0)
    return min(found)


def put_right(rows, edits):
    made, out, k = "", [], 0
    for e in edits:
        want = "assistant" if made[-1:] == "u" else "user"
        if e == "I":
            out.append(f"{want}:")
            made += want[0]
            continue
        _, _, role, text = rows[k]
        k += 1
        if e == "R":
            out.append(f"{want}:{text}")
            made += want[0]
        elif e == "K":
            out.append(f"{role}:{text}")
            made += role[0]
    return out


def brute(given):
    out = []
    every = harmed(given)
    for c in {r[0] for r in given}:
        rows = in_order([r for r in every if r[0] == c])
        kinds = fault_of(rows)
        cost, edits = search(rows, kinds)
        turns = [r[1] for r in rows if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(initial(a[2]) + initial(b[2]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        digest = hashlib.sha256("\n".join(put_right(rows, edits)).encode()).hexdigest()
        out.append((c, gaps, *[kinds.count(k) for k in ("blank", "duplicate", "truncated")], illegal, cost, edits, digest))
    return sorted(out, key=str)


def conversations():
    rng = random.Random(5)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "agent", "", None]
    says = ["Yes.", "No!", "what", "", None, " \t", "Why? ", "é.\n", "x. y", "A long one that ends well."]
    rows = []
    for c in range(150):
        turn = rng.randint(-2, 3)
        for _ in range(rng.randint(1, 9)):
            turn += rng.choice([0, 1, 1, 1, 1, 3])
            rows.append((c, rng.choice([turn] * 9 + [None]), rng.choice(roles), rng.choice(says)))
    for c in range(150, 260):  # good ones, many alike
        for t in range(2 * rng.randint(1, 4)):
            rows.append((c, t, ("user", "assistant")[t % 2], f"This is turn {t}."))
    for t in range(700):  # a long one
        rows.append((900, t, rng.choice(["user", "assistant", "assistant", "tool"]), rng.choice(says)))
    rows += [(None, t, "user", "Hm.") for t in range(5)] + [(901, None, None, None)] * 3 + rows[:9]
    return rows


def test_matrices_equal_trying_everything():
    rng = random.Random(1)
    kinds = [None, None, "truncated", "blank"]
    symbols = R.symbols()
    for _ in range(120):
        rows = [(0, k, rng.choice(["s", "u", "a", "o"]), "") for k in range(rng.randint(0, 3))]
        faulty = [rng.choice(kinds) for _ in rows]
        names = "".join(symbols[r[2], (R.GOOD if k is None else R.CUT_OFF if k == "truncated" else R.UNFIT)] for r, k in zip(rows, faulty))
        want = everything(rows, faulty)
        assert R.cheapest(R.Grammar(), [names] if names else [])[:2] == want == search(rows, faulty)


def test_rules_and_chunks_change_nothing():
    rng = random.Random(2)
    symbols = list(R.symbols().values())
    rules, names = {}, list(symbols)
    for k in range(30):
        rules[chr(0x100 + k)] = (rng.choice(names), rng.choice(names))
        names.append(chr(0x100 + k))
    grammar = R.Grammar(rules)

    def plain(s):
        return s if s not in rules else plain(rules[s][0]) + plain(rules[s][1])

    for _ in range(60):
        packed = [rng.choice(names) for _ in range(rng.randint(1, 6))]
        whole = "".join(map(plain, packed))
        want = R.cheapest(R.Grammar(), [whole])
        assert R.cheapest(grammar, ["".join(packed)]) == want
        cut = rng.randint(0, len(whole))
        assert R.cheapest(R.Grammar(), [whole[:cut], whole[cut:]]) == want


@pytest.mark.parametrize("chunk", [4096, 5])
def test_query_equals_brute_force(spark, tmp_path, monkeypatch, chunk):
    from tidefold.llm import turns

    monkeypatch.setattr(turns, "CHUNK", chunk)
    rows = conversations()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    got = R.op11_repair(spark, str(tmp_path)).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    )
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_repaired_turns(spark):
    rows = [(1, 0, "user", "a."), (1, 1, "user", "b."), (2, 0, "tool", ""), (3, 0, "system", "S."), (3, 1, "user", "u"), (3, 1, "user", "u")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = [tuple(r) for r in R.repair(df, turns=True).result.orderBy("conv_id", "position").collect()]
    # Ties take the least text: a delete before an insert, an insert before a keep.
    assert got == [
        (1, 0, "user", "a.", "KR"), (1, 1, "assistant", "b.", None),
        (3, 0, "system", "S.", "KKDI"), (3, 1, "user", "u", None), (3, 2, "assistant", "", None),
    ]


def test_grammar_is_shared(spark):
    df = spark.createDataFrame([("bcbc",)] * 40 + [("bcbcbcbc",)] * 3 + [("b",)], "symbols string")
    grammar = R.re_pair(df)
    assert list(grammar.rules.values())[:2] == [("b", "c"), ("Ā", "Ā")]
    packed = df.select(R.replaced(df["symbols"], grammar.rules).alias("s")).distinct().collect()
    assert max(len(r.s) for r in packed) <= 2


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert R.op11_repair(spark, str(tmp_path)).collect() == []


def test_given_conversations(spark):
    given = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = R.op11_repair(spark, SF).select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    assert sorted(map(tuple, got.collect()), key=str) == brute(given)
