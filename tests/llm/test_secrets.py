import hashlib
import math
import random
import re
from collections import Counter

from tidefold.llm import secrets as S

ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)


def base_spans(t):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 32]
    return sorted(out)


def below(z):
    x = -1.5976 * z - 0.070565992 * z**3
    return 0.0 if x > 700 else 1 / (1 + math.exp(x))


def battery(value):
    s = value.rstrip("=").replace("-", "+").replace("_", "/")
    _, _, alphabet, extra = next(e for e in S.ENCODINGS if re.search(e[1], s))
    n, k = len(s), len(alphabet)
    squares = sum(c * c for c in Counter(s).values())
    chi = k / n * squares - n
    spread = 2 / (9 * (k - 1))
    uniform = 1 - below(((max(chi, 0) / (k - 1)) ** (1 / 3) - (1 - spread)) / math.sqrt(spread))
    sides = [alphabet.index(c) >= k // 2 for c in s]
    high, runs = sum(sides), 1 + sum(a != b for a, b in zip(sides, sides[1:]))
    mean = 2 * high * (n - high) / n + 1
    p_runs = 2 * below(-abs((runs - mean) / math.sqrt(max((mean - 1) * (mean - 2) / (n - 1), 1e-9))))
    v = [alphabet.index(c) + 1 - (k + 1) / 2 for c in s]
    lagged = sum(a * b for a, b in zip(v, v[1:]))
    serial = 2 * below(-abs(lagged / (math.sqrt(n - 1) * (k * k - 1) / 12)))
    usual = (1 + extra) / k
    pairs = n * (n - 1)
    seldom = below(((squares - n) / pairs - usual) / math.sqrt(2 * usual * (1 - usual) / pairs))
    return (
        min(1, 3 * min(uniform, p_runs, serial)),
        int(math.log2(n)),
        math.floor(-math.log10(max(seldom, S.LEAST_P)) * S.STEPS),
    )


def brute(texts, rate=0.05, level=0.01):
    cand = [[(m.start(), m.end(), battery(m[0])) for m in re.finditer(S.CANDIDATE, t or "")] for t in texts]
    least = {}
    # A value counts once, without its padding and in either base64 alphabet.
    values = {
        (t[a:b].rstrip("=").replace("-", "+").replace("_", "/"), c[1:])
        for t, doc in zip(texts, cand)
        for a, b, c in doc
    }
    for cls in {c[0] for _, c in values}:
        ps = [c[1] for _, c in values if c[0] == cls]
        ok = [p for p in set(ps) if 10 ** (-p / S.STEPS) <= rate * sum(q >= p for q in ps) / len(ps)]
        least[cls] = min(ok, default=math.inf)
    out = []
    for t, doc in zip(texts, cand):
        base = base_spans(t or "")
        extra = [
            (a, 3, b)
            for a, b, (p, cls, q) in doc
            if p > level and q >= least[cls] and not any(x < b and a < y for x, _, y in base)
        ]
        out.append(sorted(base + extra))
    return out


def texts():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice(["th", "er", "on", "an", "re", "é", "in"]) for _ in range(rng.randint(1, 4)))
    b64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    rand = lambda a, n: "".join(rng.choice(a) for _ in range(n))
    out = [None, "", "token=secret:abcdefghij", "Password: token=abcdefgh", "pass API_KEY = 'x12345678.", "AKIAAKIA12345678 AKIA1234"]
    for i in range(160):
        w = [word() for _ in range(rng.randint(3, 40))]
        w.insert(1, rng.choice([rand(b64, 40), rand(b64[:52], 24), "anderthonthereininanre" * 2, rand("0123456789abcdef", 40), "AKIA" + rand(b64[:26], 16), "password=" + rand("0123456789abcdef", 18), "0" * 30, "abcabcabcabcabcabcabcabc", 'token = "' + rand("0123456789abcdef", 40) + '"', "x", "\U0001f600 secret:" + rand(b64, 12)]))
        out.append(" ".join(w))
    out += [out[9], out[9], "a " * 5000 + "token=abcdefgh12345", rand(b64, 3000)]
    return out


def test_scan_equals_brute_force(spark):
    rows = texts()
    df = spark.createDataFrame([(i, t, 5, "s") for i, t in enumerate(rows)], "doc_id bigint, text string, n_hex int, secrets string")
    got = {r.doc_id: [tuple(s) for s in r.secrets] for r in S.scan(df).collect()}
    want = brute(rows)
    assert [got[i] for i in range(len(rows))] == want
    assert sum(s[1] == 3 for spans in want for s in spans) >= 20
    # Text that only repeats syllables is left alone.
    for t, spans in zip(rows, want):
        for a, k, b in spans:
            assert k != 3 or "anderthon" not in t[a:b]


def test_copies_of_one_text_leave_other_texts_alone(spark, tmp_path):
    rng = random.Random(3)
    b62 = "".join(c for c in S.ENCODINGS[9][2] if c.isalnum())
    keys = ["".join(rng.choice(b62) for _ in range(20)) for _ in range(40)]
    plain = ["".join(rng.choice(["th", "er", "on", "an", "re", "in"]) for _ in range(12)) for _ in range(20)]
    rows = list(enumerate(keys + plain))

    def found(extra, tmp):
        df = spark.createDataFrame(rows + [(1000 + i, t) for i, t in enumerate(extra)], "doc_id bigint, text string")
        df.write.parquet(f"{tmp}/documents.parquet")
        cut = {r.doc_id: r.text for r in S.redact(df).collect() if r.doc_id < 1000}
        spans = {r.doc_id: r.spans for r in S.op3_secrets(spark, str(tmp)).collect() if r.doc_id < 1000}
        return spans, cut

    alone = found([], tmp_path / "alone")
    assert sum(s != "" for s in alone[0].values()) >= 30
    assert found([plain[0]] * 5000, tmp_path / "plain") == alone
    assert found([keys[0]] * 5000, tmp_path / "key") == alone


def test_digest_columns(spark):
    df = spark.createDataFrame([(1, "é token=abcdefgh1 AKIA123456789012"), (2, None)], "doc_id bigint, text string")
    rows = S.digest(S.scan(df)).orderBy("doc_id").collect()
    assert rows[0].__fields__ == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"]
    assert [(*tuple(r)[1:4], r.n_random) for r in rows] == [(1, 1, 0, 0), (0, 0, 0, 0)]
    assert rows[0].spans == "assign:2:17,access:18:34"
    assert rows[0].base_sha256 == hashlib.sha256(rows[0].spans.encode()).hexdigest()
    assert rows[1].base_sha256 == hashlib.sha256(b"").hexdigest() and rows[1].spans == ""


def test_redact(spark):
    df = spark.createDataFrame(
        [(1, "a token=abcdefgh1 z", 1), (2, None, 1), (3, "no", 1), (4, "token=" + "0a" * 20 + " é", 1)],
        "doc_id bigint, text string, n_chars int",
    )
    got = {r.doc_id: r.text for r in S.redact(df).collect()}
    assert got == {1: "a [SECRET] z", 2: None, 3: "no", 4: "[SECRET] é"}


def brute_redact(text, spans, mark="[SECRET]"):
    out, at = "", 0
    for start, _, end in spans:
        if end > at:
            out += text[at:start] + (mark if start >= at else "")
            at = end
    return out + text[at:]


def test_many_matches_in_one_text(spark):
    rng = random.Random(5)
    b62 = "".join(c for c in S.ENCODINGS[9][2] if c.isalnum())
    rand = lambda a, n: "".join(rng.choice(a) for _ in range(n))
    kinds = [
        lambda: "é token=" + rand(b62, 12),
        lambda: "secret: " + rand("0123456789abcdef", 40),
        lambda: "AKIA" + rand(b62[10:36], 16),
        lambda: rand(b62, 30),
        lambda: "token=password=" + rand(b62, 9),
    ]
    rows = [" ".join(rng.choice(kinds)() for _ in range(n)) for n in (1, 127, 128, 129, 400, 4000)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id int, text string")
    want = brute(rows)
    assert [[tuple(s) for s in r.secrets] for r in S.scan(df).orderBy("doc_id").collect()] == want
    assert [r.text for r in S.redact(df).orderBy("doc_id").collect()] == list(map(brute_redact, rows, want))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert S.scan(df).collect() == [] and S.redact(df).collect() == []
