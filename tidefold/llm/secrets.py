"""Secret scans: fixed formats, and a battery of randomness tests for unknown ones.

Long runs of encoding characters are candidates.  For each its encoding is inferred, and
three tests ask whether it could be uniformly random in that alphabet: chi-squared over
the symbol counts, the runs about the middle of the alphabet, and the serial correlation
of neighbours.  A candidate that passes all three may still be short text that looks
random by chance; the chance that text of its length repeats symbols so seldom is the
p-value of the false-discovery control (Benjamini-Hochberg), within classes of length.

Everything is DataFrame functions.  Positions are code points, ends exclusive.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# What is a secret by format, in order of kind.
ASSIGN = (
    r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ["assign", "access", "hex", "random"]

#: Runs of encoding characters that are tested; padding belongs to the run.
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}"

DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()

#: Encodings in the order they are tried: name, pattern, alphabet, and by how much text
#: in that alphabet repeats symbols oftener than random strings do (coincidences, relative).
ENCODINGS = [
    ("decimal", "^[0-9]+$", DIGITS, 1.0),
    ("hex", "^[0-9a-f]+$", DIGITS + LOWER[:6], 1.0),
    ("hex upper", "^[0-9A-F]+$", DIGITS + UPPER[:6], 1.0),
    ("lower", "^[a-z]+$", LOWER, 0.7),
    ("upper", "^[A-Z]+$", UPPER, 0.7),
    ("base32", "^[A-Z2-7]+$", UPPER + DIGITS[2:8], 1.0),
    ("lower alnum", "^[a-z0-9]+$", DIGITS + LOWER, 1.4),
    ("upper alnum", "^[A-Z0-9]+$", DIGITS + UPPER, 1.4),
    ("alnum", "^[A-Za-z0-9]+$", DIGITS + UPPER + LOWER, 3.0),
    ("base64", "^[A-Za-z0-9+/]+$", UPPER + LOWER + DIGITS + "+/", 3.0),
]

#: P-value classes of the false-discovery control: so many in a power of ten.
STEPS, LEAST_P = 20, 1e-20

#: Matches of a text are placed in blocks of so many.
BLOCK = 128


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, also inside of lambdas."""
    return F.element_at(F.transform(F.array(value), use), 1)


def in_blocks(items: Column) -> Column:
    """A non-empty array as arrays of BLOCK elements; sums along it take two short steps."""
    last = F.floor((F.size(items) - 1) / BLOCK).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(items, b * BLOCK + 1, F.lit(BLOCK)))


def _total(items: Column, of: Callable[[Column], Column]) -> Column:
    return F.aggregate(items, F.lit(0).cast("long"), lambda a, x: a + of(x))


def found(text: Column, pattern: str, group: int = 0, least: int = 1) -> Column:
    """(start, end, value) of leftmost non-overlapping matches whose group is long enough.

    A start is the sum of its block's start and of what is before it in the block, so the
    time is nearly in proportion to the matches.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    pairs = let(
        hits,
        lambda h: F.arrays_zip(
            F.slice(gaps, 1, F.size(h)).alias("gap"),
            F.transform(h, F.length).alias("size"),
            (values if group else h).alias("value"),
        ),
    )
    item = "array<struct<start: bigint, end: bigint, value: string>>"

    def through(p):
        return p["gap"] + p["size"]

    def span(base, block, x, i):
        start = base + _total(F.slice(block, 1, i), through) + x["gap"]
        return let(
            start,
            lambda s: F.struct(s.alias("start"), (s + x["size"]).alias("end"), x["value"].alias("value")),
        )

    def placed(blocks, sums):
        def one(block, b):
            base = _total(F.slice(sums, 1, b), lambda n: n)
            return let(base, lambda at: F.transform(block, lambda x, i: span(at, block, x, i)))

        return F.flatten(F.transform(blocks, one))

    spans = let(
        let(pairs, in_blocks),
        lambda blocks: let(F.transform(blocks, lambda k: _total(k, through)), lambda sums: placed(blocks, sums)),
    )
    whole = F.filter(spans, lambda m: F.length(m["value"]) >= least).cast(item)
    return F.when(text.rlike(pattern), whole).otherwise(F.array().cast(item))


def normal_below(z: Column) -> Column:
    """Probability that a standard normal is below ``z``, to about 0.0002."""
    return 1 / (1 + F.exp(-1.5976 * z - 0.070565992 * z * z * z))


def _encoding(core: Column) -> Column:
    """Encoding number; candidates always match the last one."""
    out = F.lit(len(ENCODINGS) - 1)
    for k in range(len(ENCODINGS) - 2, -1, -1):
        out = F.when(core.rlike(ENCODINGS[k][1]), k).otherwise(out)
    return out


def _of(encoding: Column, values: list) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), encoding + 1)


def tested(candidates: Column) -> Column:
    """The candidates with what the battery says of each; stages, so nothing is redone."""

    def core(c):
        plain = F.translate(F.rtrim(c["value"], F.lit("=")), "-_", "+/")
        return F.struct(
            c["start"].alias("start"),
            c["end"].alias("end"),
            plain.alias("core"),
            _encoding(plain).alias("encoding"),
        )

    def symbols(c):
        alphabet = _of(c["encoding"], [a for _, _, a, _ in ENCODINGS])
        return F.struct(
            c["start"].alias("start"),
            c["end"].alias("end"),
            c["encoding"].alias("encoding"),
            c["core"].alias("core"),
            F.length(c["core"]).cast("double").alias("n"),
            F.length(alphabet).cast("double").alias("k"),
            F.filter(F.split(c["core"], ""), lambda s: s != "").alias("chars"),
            alphabet.alias("alphabet"),
            _sides(c["core"], c["encoding"]).alias("sides"),
        )

    def measured(c):
        n, k = c["n"], c["k"]
        squares = F.aggregate(
            F.array_distinct(c["chars"]),
            F.lit(0.0),
            lambda a, s: a + F.pow(n - F.length(F.replace(c["core"], s, F.lit(""))), F.lit(2.0)),
        )
        middle = (k + 1) / 2
        places = F.transform(c["chars"], lambda s: F.position(s, c["alphabet"]) - middle)
        size = F.size(c["chars"])
        products = F.zip_with(
            F.slice(places, 1, size - 1), F.slice(places, 2, size - 1), lambda x, y: x * y
        )
        return F.struct(
            c["start"].alias("start"),
            c["end"].alias("end"),
            c["encoding"].alias("encoding"),
            F.xxhash64(c["core"]).alias("value"),
            n.alias("n"),
            k.alias("k"),
            squares.alias("squares"),
            F.length(F.replace(c["sides"], F.lit("0"), F.lit(""))).cast("double").alias("high"),
            F.length(F.regexp_replace(c["sides"], r"(.)\1*", "$1")).cast("double").alias("runs"),
            F.aggregate(products, F.lit(0.0), lambda a, x: a + x).alias("lagged"),
        )

    def judged(c):
        n, k = c["n"], c["k"]
        # Chi-squared by its cube root, which is nearly normal.
        chi = k / n * c["squares"] - n
        spread = 2.0 / (9.0 * (k - 1))
        uniform = 1 - normal_below((F.pow(F.greatest(chi, F.lit(0.0)) / (k - 1), F.lit(1 / 3)) - (1 - spread)) / F.sqrt(spread))
        expected = 2 * c["high"] * (n - c["high"]) / n + 1
        scatter = F.greatest((expected - 1) * (expected - 2) / (n - 1), F.lit(1e-9))
        runs = 2 * normal_below(-F.abs((c["runs"] - expected) / F.sqrt(scatter)))
        serial = 2 * normal_below(-F.abs(c["lagged"] / (F.sqrt(n - 1) * (k * k - 1) / 12)))
        usual = (1 + _of(c["encoding"], [x for _, _, _, x in ENCODINGS])) / k
        pairs = n * (n - 1)
        seldom = normal_below(((c["squares"] - n) / pairs - usual) / F.sqrt(2 * usual * (1 - usual) / pairs))
        return F.struct(
            c["start"].alias("start"),
            c["end"].alias("end"),
            c["encoding"].alias("encoding"),
            c["value"].alias("value"),
            F.least(F.lit(1.0), 3 * F.least(uniform, runs, serial)).alias("p_random"),
            F.floor(F.log2(n)).cast("int").alias("length_class"),
            F.floor(-F.log10(F.greatest(seldom, F.lit(LEAST_P))) * STEPS).cast("int").alias("p_class"),
        )

    out = candidates
    for stage in (core, symbols, measured, judged):
        out = F.transform(out, stage)
    return out


def _sides(core: Column, encoding: Column) -> Column:
    """The candidate with each symbol as 0 or 1, by the half of the alphabet it is in."""
    out = F.lit("")
    for k, (_, _, a, _) in enumerate(ENCODINGS):
        half = len(a) // 2
        out = F.when(encoding == k, F.translate(core, a, "0" * half + "1" * (len(a) - half))).otherwise(out)
    return out


def discoveries(battery: DataFrame, rate: float) -> dict[int, int]:
    """For each length class the smallest p-value class (largest p-value) that is discovered.

    ``battery`` has a row for each candidate with value, length_class and p_class.  A value
    counts once however often it is copied.  What is fetched is one number for each power of
    two of lengths.
    """
    different = battery.select("value", "length_class", "p_class").distinct()
    classes = different.groupBy("length_class", "p_class").count()
    strict = Window.partitionBy("length_class").orderBy(F.desc("p_class"))
    every = Window.partitionBy("length_class")
    steps = classes.select(
        "length_class",
        "p_class",
        F.sum("count").over(strict).alias("under"),
        F.sum("count").over(every).alias("all"),
    ).where(F.pow(F.lit(10.0), -F.col("p_class") / STEPS) <= rate * F.col("under") / F.col("all"))
    rows = steps.groupBy("length_class").agg(F.min("p_class").alias("least")).collect()
    return {r["length_class"]: r["least"] for r in rows}


def scan(
    docs: DataFrame,
    text_col: str = "text",
    random_level: float = 0.01,
    false_discoveries: float = 0.05,
) -> DataFrame:
    """``docs`` with ``secrets``: array of (start, kind, end), kind numbering KINDS.

    Spans are in order of start, then kind.  A random span that touches a span of another
    kind is left out.  Null and empty texts have no spans; each row of ``docs`` gives one
    row; a column named ``secrets`` is replaced.  The corpus is read twice: for the
    thresholds of the false-discovery control, and for the spans.  That control counts each
    different candidate once, so copies of a text do not move the thresholds of others.
    """
    whole = F.coalesce(F.col(text_col), F.lit(""))
    battery = docs.select(whole.alias("t")).where(F.col("t").rlike(CANDIDATE))
    battery = battery.select(F.explode(tested(found(F.col("t"), CANDIDATE))).alias("c")).select(
        "c.value", "c.length_class", "c.p_class"
    )
    least = discoveries(battery, false_discoveries)
    never = F.lit(math.inf)
    limits = never
    threshold = [(n, p) for n, p in sorted(least.items())]

    def limit(c):
        out = limits
        for n, p in threshold:
            out = F.when(c["length_class"] == n, F.lit(float(p))).otherwise(out)
        return out

    span = "array<struct<start: bigint, kind: int, end: bigint>>"

    def spans(matches, kind):
        return F.transform(
            matches,
            lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end")),
        ).cast(span)

    base = F.concat(
        spans(found(whole, ASSIGN, 2, 8), 0),
        spans(found(whole, ACCESS), 1),
        spans(found(whole, HEX), 2),
    )
    secret = F.filter(
        tested(found(whole, CANDIDATE)),
        lambda c: (c["p_random"] > random_level) & (c["p_class"] >= limit(c)),
    )
    out = docs.withColumn("secrets", F.struct(base.alias("base"), spans(secret, 3).alias("random")))

    def meets(a, b):
        return (a["start"] < b["end"]) & (b["start"] < a["end"])

    def reach(block):
        return F.struct(
            F.array_min(F.transform(block, lambda b: b["start"])).alias("start"),
            F.array_max(F.transform(block, lambda b: b["end"])).alias("end"),
            block.alias("spans"),
        )

    def away(blocks):
        def touched(r):
            return F.exists(blocks, lambda k: meets(k, r) & F.exists(k["spans"], lambda b: meets(b, r)))

        return F.filter("secrets.random", lambda r: ~touched(r))

    base, random = F.col("secrets.base"), F.col("secrets.random")
    both = (F.size(base) > 0) & (F.size(random) > 0)
    apart = F.when(both, let(F.transform(in_blocks(base), reach), away)).otherwise(random)
    return out.withColumn("secrets", F.array_sort(F.concat(base, apart)))


def written(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]", **options) -> DataFrame:
    """``docs`` with each secret span of the text replaced; overlapping spans become one."""
    scanned = scan(docs, text_col, **options)
    text = F.col(text_col)

    def ends(spans):
        return F.coalesce(F.array_max(F.transform(spans, lambda s: s["end"])), F.lit(0).cast("long"))

    def part(whole, start, end):
        return F.substring(whole, (start + 1).cast("int"), F.greatest(end - start, F.lit(0)).cast("int"))

    def cut(block, at):
        """The text from ``at`` to the last end of the block, without its spans."""

        def piece(own, s, i):
            before = F.greatest(at, ends(F.slice(block, 1, i)))
            return let(
                before,
                lambda b: F.concat(
                    part(own, b - at, s["start"] - at), F.when(s["start"] >= b, F.lit(mark)).otherwise(F.lit(""))
                ),
            )

        own = part(text, at, ends(block))
        return let(own, lambda o: F.array_join(F.transform(block, lambda s, i: piece(o, s, i)), ""))

    def cleaned(blocks):
        def one(reached):
            def start(b):
                return F.coalesce(F.array_max(F.slice(reached, 1, b)), F.lit(0).cast("long"))

            pieces = F.transform(blocks, lambda k, b: let(start(b), lambda at: cut(k, at)))
            rest = F.substring(text, (F.array_max(reached) + 1).cast("int"), F.length(text))
            return F.concat(F.array_join(pieces, ""), rest)

        return let(F.transform(blocks, ends), one)

    clean = F.when(F.size("secrets") > 0, let(in_blocks(F.col("secrets")), cleaned)).otherwise(text)
    return scanned.withColumn(text_col, clean).drop("secrets")


def op3_secrets(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return digest(scan(docs))


def digest(scanned: DataFrame) -> DataFrame:
    """(doc_id, counts of fixed formats, base_sha256, spans, n_random) of scanned documents."""

    def count(kind: int) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("secrets", lambda s: s["kind"] < 3)
    return scanned.select(
        "doc_id",
        *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS[:3])],
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("secrets")).alias("spans"),
        count(3).alias(f"n_{KINDS[3]}"),
    )
