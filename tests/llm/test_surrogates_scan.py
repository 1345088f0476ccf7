"""The search for personal data: the matches of the plain alternation, at less cost."""

import random
import time

from pyspark.sql import functions as F

from tidefold.llm import surrogates as S

PLAIN = "|".join(f"(?:{p})" for p in S.KINDS.values())
PARTS = [
    "jo@mail.example.org", "a@b", "@", "x.y%z@h-1.co", "10.0.0.7", "1.2.3.4.5", "+1 (383) 555-6083", "(0383) 555 6083",
    "415-555-0132", "1-415-555-0132", "020 7946 0958", "4041 8949 7460 8795", "40418949746087951234", "+49 171 234 567",
    "Mrs Anna Schmidt", "Mr. Smith", "Г-жа Анна Петрова", "Г-н Петров", "Señora Núñez", "Herr Weiß", "Sr", "Frau", "Miss X",
    "Monsieur Dupont", "Madame Curie", "word", "Word", "12", "3", "(", "+", ".", "-", " ", "  ", "/", ",", "é", "漢", "\n",
]


def test_matches_are_those_of_the_plain_alternation(spark):
    rng = random.Random(2)
    glue = ["", " ", " ", "-", "."]
    texts = ["".join(rng.choice(PARTS) + rng.choice(glue) for _ in range(rng.randint(0, 12))) for _ in range(4000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(8)
    every = {name: F.regexp_extract_all("t", F.lit(p), F.lit(0)) for name, p in (("plain", PLAIN), ("own", S.ANY))}
    gaps = {f"{name}_gaps": F.split("t", p, -1) for name, p in (("plain", PLAIN), ("own", S.ANY))}
    both = df.select("t", S.has_any(F.col("t")).alias("has"), *[c.alias(k) for k, c in {**every, **gaps}.items()])
    rows = both.collect()
    assert all(r.plain == r.own and r.plain_gaps == r.own_gaps and r.has == bool(r.plain) for r in rows)
    assert 1000 < sum(r.has for r in rows) < 4000


def test_clean_text_is_passed_over_quickly(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghiklmnoprstuvw") for _ in range(rng.randint(2, 9))) for _ in range(1000)]
    rows = [(" ".join(rng.choice(words) for _ in range(20_000)),) for _ in range(40)]
    df = spark.createDataFrame(rows, "t string").repartition(8).cache()
    assert df.count() == 40

    def seconds(found):
        best = 1e9
        for _ in range(3):
            start = time.perf_counter()
            assert df.where(found).count() == 0
            best = min(best, time.perf_counter() - start)
        return best

    plain = seconds(F.col("t").rlike(PLAIN))
    assert seconds(S.has_any(F.col("t"))) < plain / 2
    assert seconds(F.col("t").rlike(S.ANY)) < plain / 1.3
