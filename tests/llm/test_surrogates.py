import re

import pytest
from pyspark.sql import functions as F

from tidefold.llm import surrogates as S

SF = "/root/testdata/sf0.001"
FOUND = {
    "email": r"[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}",
    "ip": r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)",
    "phone": r"\+\d \(\d{3}\) \d{3}-\d{4}",
    "card": r"(?<!\d)\d{16}(?!\d)",
}


def luhn(s):
    d = [int(c) for c in s][::-1]
    return sum(d[0::2] + [sum(divmod(2 * x, 10)) for x in d[1::2]]) % 10 == 0


ROWS = [
    (1, "Mail Jo.Doe7@Mail.example.org or jo.doe7@mail.example.org, not @x or a@b."),
    (2, "Call +1 (383) 555-6083 or 1.2.3.4 then 10.0.0.7. Version 1.2.3.4.5"),
    (3, "Card 4041894974608795 and 4041-8949-7460-8795 but 4041894974608796"),
    (4, "Mrs Anna Schmidt met Mr. Schmidt and Frau Weiß. Г-жа Анна Петрова и Г-н Петров"),
    (5, None),
    (6, ""),
    (7, "nothing here 12 34"),
    (None, "Mail jo.doe7@mail.example.org"),
    (None, "Mail jo.doe7@mail.example.org"),
    (8, "x " * 20_000 + "+1 (383) 555-6083"),
]


@pytest.fixture(scope="module")
def out(spark):
    df = spark.createDataFrame([(i, t, 1, "q") for i, t in ROWS], "doc_id bigint, text string, _k1 int, entities string")
    rows = S.pseudonymise(df.drop("_k1"), "key").collect()
    assert len(rows) == len(ROWS)
    return {r.doc_id: r for r in rows}


def test_unchanged_rows(out):
    assert out[5].text is None and out[6].text == "" and out[7].text == ROWS[6][1]
    assert out[7].entities == []


def test_emails(out):
    a, b = re.findall(FOUND["email"], out[1].text)
    assert a == b and "doe" not in a.lower() and re.match(r"^[a-z]{2}\.[a-z]{3}\d@", a)
    assert a in out[None].text and out[1].text.endswith("not @x or a@b.")


def test_numbers(out):
    t = out[2].text
    assert re.match(r"Call \+1 \(\d{3}\) \d{3}-\d{4} or 2[45]\d\.\d+\.\d+\.\d+ then 10\.\d+\.\d+\.\d+\. Version 1\.2\.3\.4\.5$", t)
    assert "383" not in t and t.split("or")[0].split("Call ")[1].strip() in out[8].text
    cards = re.match(r"Card (\d{16}) and (\d{4}-\d{4}-\d{4}-\d{4}) but 4041894974608796$", out[3].text)
    assert cards and cards[1] == cards[2].replace("-", "") and luhn(cards[1]) and cards[1] != "4041894974608795"


def test_names(out):
    m = re.match(r"Mrs (\w+) (\w+) met Mr\. (\w+) and Frau (\w+)\. Г-жа (\w+) (\w+) и Г-н (\w+)$", out[4].text)
    assert m, out[4].text
    assert m[1].endswith("a") and m[2] == m[3] and m[4] != m[3]
    assert re.match("^[А-Я][а-я]+а$", m[5]) and re.match("^[А-Я]", m[6]) and m[6] != m[7]
    assert not {"Anna", "Schmidt", "Weiß", "Анна", "Петрова"} & set(m.groups())


def test_untitled_mentions_of_a_detected_name(spark):
    rows = [
        (1, "Mr. John Smith came. Smith said John's SMITH is not smith or Smithson; John Smith left. É Jones"),
        (2, "Smith and John stay where nobody is named. Mail a@b.org"),
        (3, "Г-жа Анна Петрова пришла. Петрова и Анна"),
        (4, "Smith was early, said Mr. Smith"),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in S.pseudonymise(df, "key").collect()}
    given, family = re.match(r"Mr\. (\w+) (\w+) came", got[1].text).groups()
    assert not {given, family} & {"John", "Smith"}
    assert got[1].text == (
        f"Mr. {given} {family} came. {family} said {given}'s {family.upper()} is not smith or Smithson; {given} {family} left. É Jones"
    )
    assert got[1].entities == ["person"]
    assert got[2].text.startswith("Smith and John stay where nobody is named. Mail ")
    m = re.match(r"Г-жа (\w+) (\w+) пришла\. (\w+) и (\w+)$", got[3].text)
    assert m[1] == m[4] != "Анна" and m[2] == m[3] != "Петрова"
    assert got[4].text == f"{family} was early, said Mr. {family}"


def test_national_phone_numbers(spark):
    found = ["415-555-0132", "415.555.0132", "415 555 0132", "1-415-555-0132", "020 7946 0958"]
    other = ["2024-01-15", "415-555-01325", "12-415-555-0132", "1.415.555.0132.7", "415-5550"]
    rows = [(i, f"Call {t} now, {t}.") for i, t in enumerate(found + other)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in S.pseudonymise(df, "key").collect()}
    for i, t in rows:
        same = re.sub(r"\d", "0", t) == re.sub(r"\d", "0", got[i].text)
        if i < len(found):
            a, b = re.match(r"Call (.*) now, (.*)\.$", got[i].text).groups()
            assert same and a == b != found[i] and got[i].entities == ["phone", "phone"], got[i]
        else:
            assert got[i].text == t and got[i].entities == [], got[i]


def test_same_key_same_text_other_key_other_text(spark, out):
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string")
    again = {r.doc_id: r.text for r in S.pseudonymise(df, "key").collect()}
    other = {r.doc_id: r.text for r in S.pseudonymise(df, "other").collect()}
    assert again == {k: r.text for k, r in out.items()}
    assert other[3] != again[3] and other[7] == again[7]


def test_collisions_are_drawn_again(spark):
    # 300 numbers of three free digits: many first draws collide somewhere.
    ents = [f"phone|{n:03d}" for n in range(0, 600, 2)]
    df = spark.createDataFrame([(e,) for e in ents], "entity string")
    got = {r.entity: r.surrogate for r in S.surrogate_table(df, "k").collect()}
    assert len(got) == 300 == len(set(got.values()))
    assert not set(got.values()) & {e.split("|")[1] for e in ents}


def test_space_used_up_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(S, "MOST_DRAWS", 2)
    df = spark.createDataFrame([(f"phone|{n}",) for n in range(10)], "entity string")
    with pytest.raises(RuntimeError):
        S.surrogate_table(df, "k")


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r for r in S.op4_surrogates(spark, SF).collect()}
    pairs = {}
    for d, t in docs.collect():
        new = got[d].text
        for kind, pattern in FOUND.items():
            both = list(zip(re.findall(pattern, t), re.findall(pattern, new), strict=True))
            if kind == "card":
                assert all(a == b for a, b in both if not luhn(a))
                both = [(a, b) for a, b in both if luhn(a)]
            assert got[d][f"n_{kind}"] == len(both)
            assert all(a not in new for a, _ in both)
            for a, b in both:
                assert pairs.setdefault((kind, a.lower()), b) == b
        mask = "|".join(FOUND.values())
        assert re.split(mask, t) == re.split(mask, new)
    assert len(pairs) > 5 and len(set(pairs.values())) == len(pairs)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert S.pseudonymise(df, "k").collect() == []
