"""Personal data: detection, and keyed surrogates of the same type.

Each entity (an address, a number, a name word) is drawn a surrogate from a keyed hash:
digits for digits and letters for letters, names in the same script with an ending of the
same gender, card numbers with a right check digit.  The same entity gets the same
surrogate everywhere.  A table of all entities is checked for collisions: a surrogate that
another entity has, or that is itself an entity of the texts, is drawn again.

Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefold.llm.common import stored

# What is found, in the order in which a place is tried.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}"
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
IP = rf"(?<![\d.])(?:{OCTET}\.){{3}}{OCTET}(?!\d|\.\d)"
PHONE = r"(?<![\d+])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]\d{3,4}(?!\d)|\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?!\d)"
# National numbers without a bracket: 415-555-0132, 1-415-555-0132, 020 7946 0958.
NATIONAL = r"(?<![\d.+/-])(?<!\d )(?:(?:1[ .-])?(?:\d{3}-\d{3}-\d{4}|\d{3}\.\d{3}\.\d{4}|\d{3} \d{3} \d{4})|0\d{2,4}[ -]\d{3,4}[ -]\d{3,4})(?!\d|[.-]\d)"
PHONE = rf"{PHONE}|{NATIONAL}"
CARD = r"(?<!\d)\d(?:[ -]?\d){12,18}(?!\d)"
FEMALE = "Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|Г-жа"
MALE = "Mr|Herr|Monsieur|Señor|Sr|Г-н"
PERSON = rf"(?<!\p{{L}})(?:{FEMALE}|{MALE})\.? \p{{Lu}}\p{{L}}+(?: \p{{Lu}}\p{{L}}+)?"

KINDS = {"email": EMAIL, "ip": IP, "phone": PHONE, "card": CARD, "person": PERSON}
# At most places the first character rules a kind out before its own pattern is tried.
NUMBER = r"(?=[\d(+])" + f"(?:{'|'.join(f'(?:{KINDS[k]})' for k in ('ip', 'phone', 'card'))})"
TITLED = f"(?=[{''.join(sorted({t[0] for t in f'{FEMALE}|{MALE}'.split('|')}))}])(?:{PERSON})"
ANY = f"(?:{EMAIL})|{NUMBER}|{TITLED}"

#: Syllables of surrogate names, and what ends a given name: neither, female, male.
SCRIPTS = {
    "latin": (list("bdfgklmnprstv"), list("aeiou"), ["n", "a", "o"]),
    "cyrillic": (list("бдгклмнпрств"), list("аеиоу"), ["н", "а", "р"]),
    "greek": (list("βδγκλμνπρστ"), list("αειου"), ["ν", "α", "ς"]),
}

#: Draws after which a space of surrogates counts as used up.
MOST_DRAWS = 64


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def luhn_sum(digits: Column) -> Column:
    """The checksum of card numbers: 0 modulo 10 if the last digit is right."""
    each = F.transform(
        F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""),
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
            c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(each, F.lit(0), lambda a, x: a + x)


def has_any(text: Column) -> Column:
    """Whether ``ANY`` matches somewhere, by its parts: only texts with an @ are searched for addresses."""
    return (text.contains("@") & text.rlike(EMAIL)) | text.rlike(NUMBER) | text.rlike(TITLED)


def kind_of(hit: Column) -> Column:
    """The kind of a match, null for digits that only look like a card number."""
    out = F.when(hit.rlike(f"^(?:{PERSON})$"), "person")
    for kind, pattern in reversed([k for k in KINDS.items() if k[0] != "person"]):
        own = hit.rlike(f"^(?:{pattern})$")
        if kind == "card":
            own = own & (luhn_sum(_digits(hit)) % 10 == 0)
        out = F.when(own, kind).otherwise(out)
    return out


def _script(word: Column) -> Column:
    return (
        F.when(word.rlike(r"^\p{IsCyrillic}"), "cyrillic")
        .when(word.rlike(r"^\p{IsGreek}"), "greek")
        .otherwise("latin")
    )


def entities(kind: Column, hit: Column) -> Column:
    """The entities of a match as kind|value: a person has one for each name word."""
    words = F.split(F.regexp_replace(hit, r"^\S+ ", ""), " ")
    gender = F.when(hit.rlike(rf"^(?:{FEMALE})\b"), "female").otherwise("male")
    family = F.element_at(words, -1)
    names = F.when(
        F.size(words) > 1,
        F.array(
            F.concat_ws("|", F.concat_ws("-", F.lit("given"), gender, _script(words[0])), F.lower(words[0])),
            F.concat_ws("|", F.concat_ws("-", F.lit("family"), _script(family)), F.lower(family)),
        ),
    ).otherwise(F.array(F.concat_ws("|", F.concat_ws("-", F.lit("family"), _script(family)), F.lower(family))))
    single = (
        F.when(kind == "email", F.lower(hit)).when(kind == "ip", hit).otherwise(_digits(hit))
    )
    return F.when(kind == "person", names).otherwise(F.array(F.concat_ws("|", kind, single)))


def _stream(entity: Column, key: str, draw: int) -> Column:
    """256 keyed hexadecimal digits for an entity."""
    inner = F.sha2(F.concat_ws("\u0001", F.lit(key), entity, F.lit(str(draw))).cast("binary"), 256)
    return F.concat(
        *[F.sha2(F.concat(F.lit(f"{key}{k}"), inner).cast("binary"), 256) for k in range(4)]
    )


def _number(stream: Column, at: Column | int, width: int = 4) -> Column:
    """A number below 16 ** width from the stream, which is read round and round."""
    at = F.lit(at) if isinstance(at, int) else at
    return F.conv(F.substring(stream, F.pmod(at * width, F.lit(256 - width)) + 1, F.lit(width)), 16, 10).cast("int")


def _letters(text: Column, stream: Column, first: int = 0) -> Column:
    """Letters for letters and digits for digits; other signs stay."""

    def one(c, i):
        n = _number(stream, i + first)
        return (
            F.when(c.rlike("^[a-z]$"), F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), n % 26 + 1, F.lit(1)))
            .when(c.rlike("^[0-9]$"), (n % 10).cast("string"))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.filter(F.split(text, ""), lambda c: c != ""), one), "")


def _name(kind: Column, stream: Column, draw: int) -> Column:
    out = None
    for script, (consonants, vowels, ends) in SCRIPTS.items():
        pick = lambda signs, at: F.element_at(F.array(*map(F.lit, signs)), _number(stream, at) % len(signs) + 1)
        syllables = [pick(s, 2 * k + j) for k in range(3 + draw // 4) for j, s in enumerate((consonants, vowels))]
        end = F.when(kind.contains("-female-"), ends[1]).when(kind.contains("-male-"), ends[2]).otherwise(ends[0])
        # A consonant before the ending keeps two vowels apart.
        word = F.concat(*syllables, pick(consonants, 60), end)
        out = F.when(kind.endswith(script), word) if out is None else out.when(kind.endswith(script), word)
    return out


def surrogate(entity: Column, key: str, draw: int) -> Column:
    """The surrogate of an entity (kind|value) at a draw, in its own plain form."""
    kind = F.substring_index(entity, "|", 1)
    value = F.expr("substring(entity, length(substring_index(entity, '|', 1)) + 2)")
    stream = _stream(entity, key, draw)
    local = F.substring_index(value, "@", 1)
    domain = F.substring_index(value, "@", -1)
    host = _letters(F.lit("aaaaaa"), _stream(domain, key, 0))
    # Later draws are longer, so that short addresses never run out.
    longer = _letters(F.lit("a" * (draw // 4 + 1) if draw else ""), stream, 40)
    email = F.concat(_letters(local, stream), longer, F.lit("@"), host, F.lit(".example.com"))
    octets = [(_number(stream, k) % 256).cast("string") for k in range(1, 4)]
    # Private addresses stay private; public ones get numbers that are never assigned.
    ip = F.concat_ws(
        ".",
        F.when(value.rlike(r"^(?:10|127|192\.168)\."), "10").otherwise((240 + _number(stream, 0) % 15).cast("string")),
        *octets,
    )
    # Country codes stay: what stands before the last ten digits.
    size = F.length(value)
    fixed = F.when(kind == "card", 1).otherwise(F.greatest(size - 10, F.lit(0)))
    drawn = F.concat(
        F.substring(value, F.lit(1), fixed),
        _letters(F.substring(value, fixed + 1, size - fixed), stream),
    )
    body = F.substring(drawn, F.lit(1), size - 1)
    check = (10 - luhn_sum(F.concat(body, F.lit("0"))) % 10) % 10
    card = F.concat(body, check.cast("string"))
    return (
        F.when(kind == "email", email)
        .when(kind == "ip", ip)
        .when(kind == "phone", drawn)
        .when(kind == "card", card)
        .otherwise(_name(kind, stream, draw))
    )


def _family(entity: Column) -> Column:
    """Entities of one family must have different surrogates."""
    kind = F.substring_index(entity, "|", 1)
    return F.when(kind.startswith("given") | kind.startswith("family"), "name").otherwise(kind)


def surrogate_table(found: DataFrame, key: str) -> DataFrame:
    """(entity, surrogate) for the distinct ``entity`` values of ``found``.

    Surrogates of one family are all different, and none is a value that occurs.  Draws
    are repeated for what collides until nothing does, each written to the shared folder.
    """
    plain = F.expr("substring(entity, length(substring_index(entity, '|', 1)) + 2)")
    pending = stored(found.select("entity").distinct(), "entities")
    taken = pending.select(_family(F.col("entity")).alias("family"), plain.alias("surrogate")).distinct()
    done = None
    for draw in range(MOST_DRAWS):
        drawn = pending.select(
            "entity",
            _family(F.col("entity")).alias("family"),
            surrogate(F.col("entity"), key, draw).alias("surrogate"),
        )
        free = drawn.join(taken, ["family", "surrogate"], "left_anti")
        if done is not None:
            free = free.join(done.select("family", "surrogate"), ["family", "surrogate"], "left_anti")
        won = stored(free.groupBy("family", "surrogate").agg(F.min("entity").alias("entity")), "surrogates")
        done = won if done is None else done.unionByName(won)
        pending = stored(pending.join(won, "entity", "left_anti"), "entities")
        if pending.isEmpty():
            return done.select("entity", "surrogate")
    raise RuntimeError("a kind of entity has more values than surrogates")


def _in_format(hit: Column, digits: Column) -> Column:
    """The digits put where the digits of a match stand."""
    chars = F.filter(F.split(hit, ""), lambda c: c != "")

    def add(state, c):
        is_digit = c.rlike("^[0-9]$")
        return F.struct(
            F.concat(
                state["out"],
                F.when(is_digit, F.substring(digits, state["at"], F.lit(1))).otherwise(c),
            ).alias("out"),
            (state["at"] + F.when(is_digit, 1).otherwise(0)).alias("at"),
        )

    return F.aggregate(chars, F.struct(F.lit("").alias("out"), F.lit(1).alias("at")), add, lambda s: s["out"])


def _replaced(kind: Column, hit: Column, names: Column) -> Column:
    """What stands for a match, given the map of surrogates."""
    of = F.transform(entities(kind, hit), lambda e: F.element_at(names, e))
    title = F.regexp_extract(hit, r"^(\S+) ", 1)
    person = F.concat_ws(" ", title, F.array_join(F.transform(of, F.initcap), " "))
    return (
        F.when(kind.isNull(), hit)
        .when(kind == "person", person)
        .when(kind.isin("phone", "card"), _in_format(hit, of[0]))
        .otherwise(of[0])
    )


def _untitled(gap: Column, names: Column) -> Column:
    """The text between matches, with the capitalised name words of the map replaced."""

    def one(word):
        kinds = ["family", "given-female", "given-male"]
        of = F.coalesce(
            *[F.element_at(names, F.concat(F.lit(f"{k}-"), _script(word), F.lit("|"), F.lower(word))) for k in kinds]
        )
        loud = (F.length(word) > 1) & (word == F.upper(word))
        new = F.when(loud, F.upper(of)).otherwise(F.initcap(of))
        return F.when(word.rlike(r"^\p{Lu}") & of.isNotNull(), new).otherwise(word)

    words = F.transform(F.regexp_extract_all(gap, F.lit(r"\p{L}+"), F.lit(0)), one)
    between = F.split(gap, r"\p{L}+", -1)
    ends = F.concat(words, F.array(F.lit("")))
    return F.array_join(F.flatten(F.zip_with(between, ends, lambda b, w: F.array(b, w))), "")


def pseudonymise(
    docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with personal data in the text replaced, and ``entities``: kinds in order.

    A name detected in a row is replaced wherever else its words stand in that row with a
    capital, with or without a title; ``entities`` has the detected matches only.  Every row
    stays; null and empty texts and texts without personal data are unchanged.
    Rows with equal id and text are rewritten alike.  A column named ``entities`` is
    replaced.  The same ``key`` and texts give the same surrogates.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    has = has_any(text)
    keys = [
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("_k1"),
        F.xxhash64(F.col(text_col), F.lit(1), F.col(id_col)).alias("_k2"),
    ]
    hits = F.transform(
        F.regexp_extract_all(text, F.lit(ANY), F.lit(0)),
        lambda h: F.struct(kind_of(h).alias("kind"), h.alias("hit")),
    )
    with_hits = docs.where(has).select(*keys, hits.alias("hits"))
    found = with_hits.select(
        "_k1",
        "_k2",
        F.explode(
            F.array_distinct(
                F.flatten(
                    F.transform(
                        F.filter("hits", lambda h: h["kind"].isNotNull()),
                        lambda h: entities(h["kind"], h["hit"]),
                    )
                )
            )
        ).alias("entity"),
    ).distinct()
    found = stored(found, "occurrences")
    named = (
        found.join(surrogate_table(found, key), "entity")
        .groupBy("_k1", "_k2")
        .agg(F.map_from_entries(F.collect_list(F.struct("entity", "surrogate"))).alias("_names"))
    )
    keep = [c for c in docs.columns if c.lower() != "entities"]
    rows = docs.where(has).select(
        *keep, *keys, hits.alias("_hits"), F.split(text, ANY, -1).alias("_gaps")
    )
    rows = rows.join(named, ["_k1", "_k2"], "left")
    names = F.coalesce("_names", F.create_map().cast("map<string,string>"))
    replaced = F.transform("_hits", lambda h: _replaced(h["kind"], h["hit"], names))
    ends = F.concat(replaced, F.array(F.lit("")))
    named_here = F.exists(F.map_keys(names), lambda e: _family(e) == "name")
    gaps = F.when(named_here, F.transform("_gaps", lambda g: _untitled(g, names))).otherwise(F.col("_gaps"))
    whole = F.array_join(F.flatten(F.zip_with(gaps, ends, lambda g, r: F.array(g, r))), "")
    kinds = F.transform(F.filter("_hits", lambda h: h["kind"].isNotNull()), lambda h: h["kind"])
    changed = rows.select(
        *[whole.alias(c) if c == text_col else F.col(c) for c in keep], kinds.alias("entities")
    )
    none = F.array().cast("array<string>").alias("entities")
    return changed.unionByName(docs.where(~has).select(*keep, none))


def op4_surrogates(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")

    def count(kind: str) -> Column:
        return F.size(F.filter("entities", lambda e: e == kind)).cast("long")

    counts = [count(kind).alias(f"n_{kind}") for kind in KINDS]
    return pseudonymise(docs, key="corpus").select("doc_id", "text", *counts)
