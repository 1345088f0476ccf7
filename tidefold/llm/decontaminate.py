"""Benchmark decontamination by spaced seeds.

A mask is laid over every run of words of a test item and of a training text; the hash of
the words at its ones is a seed, whatever stands at its zeros.  Equal seeds are hits.
Around each hit the item and the text are compared word by word, so that some words may
be substituted.

Items of up to nine words are found by masks as long as themselves: one without zeros and,
where one word may be substituted, one with a zero at each place.  So they are found
whatever that word is.

Everything is DataFrame functions: seeds of texts are made and looked up in one pass of
generated code for each length of masks, and only hits, with the few words around them, go
further; a row with all words of a text is never made for each hit or seed.  Where there
are too many test items to broadcast their seeds, seeds are joined by a shuffle without
the texts, and hits fetch the words around them from the texts afterwards.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefold.llm.common import BLANKS

#: Ones are compared, zeros are ignored.  Each mask has five ones in eight words.
MASKS = ("11010011", "10111001")

#: Seeds of the test items that are broadcast at most (24 bytes each); more are joined by
#: a shuffle.
MOST_BROADCAST = 2_000_000

#: Marks at the ends of words that do not count.
MARKS = ".,;:!?\"'()[]{}<>"


def tokens(text: Column) -> Column:
    """Lower-cased words without marks; a text without words has one empty word."""
    plain = F.translate(F.lower(F.coalesce(text, F.lit(""))), MARKS, "")
    return F.split(F.trim(F.regexp_replace(plain, BLANKS, " ")), " ")


def _seed(words: Column, at: Column, number: int, mask: str) -> Column:
    """The hash of the words under a mask laid at ``at`` (from 1)."""
    ones = [F.get(words, at + (k - 1)) for k, bit in enumerate(mask) if bit == "1"]
    return F.xxhash64(F.lit(number), *ones)


def seeds(words: DataFrame, masks=MASKS, *carried: str, first: int = 0) -> DataFrame:
    """Rows (seed, at, width, *carried) for each mask at each place of ``words``.

    The masks have one length, ``width``; ``first`` is the number of the first of them.
    """
    span = max(map(len, masks))
    size = F.size("words")
    places = F.when(size >= span, F.sequence(F.lit(1), size - (span - 1)))
    each = words.where(size >= span).select(*carried, "words", F.explode(places).alias("at"))
    made = F.array(*[_seed(F.col("words"), F.col("at"), k, m) for k, m in enumerate(masks, first)])
    return each.select(*carried, "words", "at", F.explode(made).alias("seed"), F.lit(span).alias("width"))


#: Items of up to so many words have masks of their own length.
SHORT = 9


def short_masks(length: int, similarity: float) -> tuple[str, ...]:
    """Masks for an item of ``length`` words: all of it, and all but one word if that is enough."""
    whole = "1" * length
    if length - 1 < similarity * length:
        return (whole,)
    return (whole, *[whole[:k] + "0" + whole[k + 1 :] for k in range(length)])


def stretches(hits: DataFrame, span: int) -> DataFrame:
    """(doc_id, item_id, first, compared, found): the words of documents around hits, each once.

    ``found`` are the words against those of the item from ``first`` on, as far as stretches
    that hold the hit reach; what is outside of the document is null.

    No lambda here: generated code ends at one, and would keep a row with all words of a
    document for each of its hits until the document is done.
    """
    length = F.least(F.lit(span), F.col("item_size"))
    low = F.greatest(F.lit(1), F.col("item_at") + F.col("item_width") - length)
    high = F.greatest(F.lit(1), F.least(F.col("item_at"), F.col("item_size") - length + 1)) + length - 1
    shift = F.col("at") - F.col("item_at")
    begin, end = low + shift, high + shift
    none = F.lit(None).cast("string")
    inside = F.greatest(F.lit(1), begin)
    found = F.concat(
        F.array_repeat(none, F.greatest(F.lit(0), F.lit(1) - begin)),
        F.slice("words", inside, end - inside + 1),
        F.array_repeat(none, F.greatest(F.lit(0), end - F.size("words"))),
    )
    return hits.select(
        "doc_id", "item_id", low.alias("first"), length.alias("compared"), found.alias("found")
    ).distinct()


def overlaps(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    span: int = 20,
    similarity: float = 0.8,
    masks: tuple[str, ...] = MASKS,
    most_broadcast: int = MOST_BROADCAST,
) -> DataFrame:
    """(doc_id, item_id, matched, compared): documents that hold words of test items.

    Each hit is verified in every stretch of ``span`` words of the item that holds the hit
    (the whole item, if it is shorter), against the words of the document at the same
    distance: at least ``similarity`` of them must be equal.  The best stretch is reported,
    one row for each document id and item.  Items without words, null texts and null item
    ids match nothing; rows of one doc_id count together, null ids too; other columns are
    not looked at.  An empty side gives no rows.

    What the masks cannot find: a stretch in which each run of eight words has a
    substitution under a one of both masks.  An item of up to SHORT words is found wherever
    all its places lie in the document.
    """
    test = items.select(
        F.col(item_id_col).alias("item_id"), tokens(F.col(item_text_col)).alias("words")
    ).where("item_id is not null and words[0] <> ''")
    # Rows of equal id and text have equal keys, and equal results.
    whole = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    train = whole.select(
        "doc_id",
        tokens(F.col("text")).alias("words"),
        F.xxhash64("doc_id", "text").alias("k1"),
        F.xxhash64("text", F.lit(1), "doc_id").alias("k2"),
    )
    # No more lengths than SHORT, and texts are looked through for those that occur only.
    sizes = F.size("words")
    short = sorted(r[0] for r in test.where(sizes <= SHORT).select(sizes).distinct().collect())

    # (masks, number of the first, seeds of test items) for long items and each short length.
    groups = []
    first = 0
    for chosen, own in [
        (sizes > SHORT, masks),
        *[(sizes == n, short_masks(n, similarity)) for n in short],
    ]:
        known = seeds(test.where(chosen), own, "item_id", first=first)
        size = F.size("words").alias("item_size")
        width = F.col("width").alias("item_width")
        groups.append((own, first, known.select("seed", "item_id", F.col("at").alias("item_at"), size, width)))
        first += len(own)
    known = reduce(DataFrame.unionByName, [k for _, _, k in groups])
    if known.count() <= most_broadcast:
        # One lookup for each group: a union of seeds would hold a copy of the words for each.
        made = [(seeds(train, own, "doc_id", first=n).drop("width"), k) for own, n, k in groups]
        near = [stretches(m.join(F.broadcast(k), "seed"), span) for m, k in made]
    else:
        made = [seeds(train, own, "k1", "k2", first=n).drop("width", "words") for own, n, _ in groups]
        slim = reduce(DataFrame.unionByName, made).join(known, "seed").drop("seed").distinct()
        near = [stretches(slim.join(train, ["k1", "k2"]), span)]
    near = reduce(DataFrame.unionByName, near)
    own = test.select(F.col("item_id").alias("own_id"), F.col("words").alias("own"))
    same = F.zip_with(
        F.slice("own", F.col("first"), F.size("found")),
        "found",
        lambda a, b: F.coalesce((a == b).cast("int"), F.lit(0)),
    )

    def equal_from(i: Column) -> Column:
        part = F.slice("same", i, F.col("compared"))
        return F.aggregate(part, F.lit(0), lambda n, x: n + x)

    begins = F.sequence(F.lit(1), F.size("same") - F.col("compared") + 1)
    joined = near.join(own, near["item_id"] == own["own_id"])
    compared = joined.select("doc_id", "item_id", "compared", same.alias("same")).select(
        "doc_id", "item_id", "compared", F.array_max(F.transform(begins, equal_from)).alias("matched")
    )
    best = F.max(F.struct((F.col("matched") / F.col("compared")).alias("r"), "matched", "compared"))
    return (
        compared.where(F.col("matched") >= F.lit(similarity) * F.col("compared"))
        .groupBy("doc_id", "item_id")
        .agg(best.alias("best"))
        .select("doc_id", "item_id", "best.matched", "best.compared")
    )


def op1_decontaminate(spark, sf_dir: str) -> DataFrame:
    return overlaps(
        spark.read.parquet(f"{sf_dir}/documents.parquet"),
        spark.read.parquet(f"{sf_dir}/benchmark.parquet"),
    )


_WORDS = r"""string_split(trim(regexp_replace(translate(lower(coalesce(text, '')), '.,;:!?"''()[]{}<>', ''), '[\x20\x09-\x0D]+', ' ', 'g')), ' ')"""

ORACLE = (
    f"""
with d as (select row_number() over () as r, doc_id, {_WORDS} as w from documents),
b as (select * from (select row_number() over () as r, item_id, {_WORDS} as w from benchmark where item_id is not null) where w[1] <> ''),"""
    r"""
ds as (
  select r, 0 as m, unnest(generate_series(1, len(w) - 7)) as i, unnest(list_transform(generate_series(1, len(w) - 7), lambda i: concat_ws(' ', w[i], w[i + 1], w[i + 3], w[i + 6], w[i + 7]))) as s from d where len(w) >= 8 union all
  select r, 1, unnest(generate_series(1, len(w) - 7)), unnest(list_transform(generate_series(1, len(w) - 7), lambda i: concat_ws(' ', w[i], w[i + 2], w[i + 3], w[i + 4], w[i + 7]))) from d where len(w) >= 8),
bs as (
  select r, len(w) as l, 0 as m, unnest(generate_series(1, len(w) - 7)) as i, unnest(list_transform(generate_series(1, len(w) - 7), lambda i: concat_ws(' ', w[i], w[i + 1], w[i + 3], w[i + 6], w[i + 7]))) as s from b where len(w) >= 10 union all
  select r, len(w), 1, unnest(generate_series(1, len(w) - 7)), unnest(list_transform(generate_series(1, len(w) - 7), lambda i: concat_ws(' ', w[i], w[i + 2], w[i + 3], w[i + 4], w[i + 7]))) from b where len(w) >= 10),
h as (
  select distinct ds.r as dr, bs.r as br, ds.i - bs.i as shift, bs.i as bi, bs.l as bl, least(20, bs.l) as n
  from ds join bs on ds.m = bs.m and ds.s = bs.s),
f as (
  select dr, br, n, shift, unnest(generate_series(greatest(1, bi + 8 - n), greatest(1, least(bi, bl - n + 1)))) as f from h
  union all
  select d.r, b.r, len(b.w), unnest(generate_series(0, len(d.w) - len(b.w))), 1
  from b join d on len(d.w) >= len(b.w) where len(b.w) < 10),
e as (
  select doc_id, item_id, n, f, shift, d.w as dw, b.w as bw
  from (select distinct dr, br, n, f, shift from f) x join d on d.r = x.dr join b on b.r = x.br),
c as (
  select doc_id, item_id, n as compared,
    len(list_filter(generate_series(f, f + n - 1), lambda k: k + shift >= 1 and k + shift <= len(dw) and dw[k + shift] = bw[k])) as matched
  from e),
r as (
  select *, row_number() over (partition by doc_id, item_id order by matched / compared desc, matched desc, compared desc) as best
  from c where matched >= 0.8 * compared)
select doc_id, item_id, cast(matched as integer) as matched, cast(compared as integer) as compared from r where best = 1
"""
)
