"""Language identification of mixed text: word scores and a Viterbi path over them.

Each word's script (from code-point ranges) narrows the languages to those that training
saw in that script.  A word's score in a language is the sum of log frequencies of its
character n-grams.  The best path through a text's words, paying a penalty for each
switch, labels its spans.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidefold.llm.common import field, give_back, small_slices

UNKNOWN = "und"
FAR = -60.0

# First code point and script of ranges of letters, in order; a script ends
# where the next range begins.
RANGES = [
    (0x0041, "Latin"),
    (0x0370, "Greek"),
    (0x0400, "Cyrillic"),
    (0x0530, "Armenian"),
    (0x0590, "Hebrew"),
    (0x0600, "Arabic"),
    (0x0780, "Other"),
    (0x0900, "Devanagari"),
    (0x0980, "Bengali"),
    (0x0A00, "Other"),
    (0x0B80, "Tamil"),
    (0x0C00, "Other"),
    (0x0E00, "Thai"),
    (0x0E80, "Other"),
    (0x10A0, "Georgian"),
    (0x1100, "Hangul"),
    (0x1200, "Other"),
    (0x1E00, "Latin"),
    (0x1F00, "Greek"),
    (0x2000, "Other"),
    (0x3040, "Kana"),
    (0x3100, "Other"),
    (0x3400, "Han"),
    (0xA000, "Other"),
    (0xAC00, "Hangul"),
    (0xD7B0, "Other"),
    (0xF900, "Han"),
    (0xFB00, "Latin"),
    (0xFB10, "Other"),
    (0xFF21, "Latin"),
    (0xFF5B, "Other"),
]
_STARTS = [a for a, _ in RANGES]


def script(char: str) -> str:
    """The script of a letter, by range."""
    at = bisect.bisect_right(_STARTS, ord(char)) - 1
    return RANGES[at][1] if at >= 0 else "Other"


def grams(word: str, longest: int = 3) -> list[str]:
    """Character n-grams of a lower-cased word with its ends marked."""
    w = f" {word.lower()} "
    return [w[i : i + n] for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


@dataclass
class Model:
    """Log frequencies of n-grams by language, and the languages of each script."""

    languages: list[str]
    table: dict[str, int]
    weights: np.ndarray  # one row per n-gram, one column per language
    unseen: np.ndarray
    scripts: dict[str, list[int]]
    longest: int = 3
    penalty: float = 6.0
    always: bool = False

    def score(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores of words by language with UNKNOWN last, and their numbers of letters.

        A word in a script of no language is UNKNOWN; with ``always`` it is scored in every
        language instead, and its letters count for none.
        """
        get, unseen = self.table.get, len(self.table)
        rows: list[int] = []
        starts, letters, groups = [], [], []
        kinds: dict[frozenset[str], int] = {frozenset(): 0, frozenset(["Latin"]): 1}
        for word in words:
            starts.append(len(rows))
            rows.extend([get(g, unseen) for g in grams(word, self.longest)])
            if word.isascii():
                n = len(word) if word.isalpha() else sum(map(str.isalpha, word))
                groups.append(1 if n else 0)
            else:
                own = [c for c in word if c.isalpha()]
                n = len(own)
                groups.append(kinds.setdefault(frozenset(map(script, own)), len(kinds)))
            letters.append(n)
        weights = np.vstack([self.weights, self.unseen])
        # Overlapping n-grams tell the same thing several times.
        sums = np.add.reduceat(weights[rows], starts, axis=0) / self.longest
        out = np.full((len(words), len(self.languages) + 1), FAR, np.float32)
        group, counted = np.array(groups), np.array(letters, np.int64)
        for scripts, k in kinds.items():
            at = np.flatnonzero(group == k)
            some = sorted({x for s in scripts for x in self.scripts.get(s, ())})
            if not scripts:
                out[at] = 0.0
            elif not some and not (self.always and self.languages):
                out[at, -1] = 0.0
            else:
                if not some:
                    some, counted[at] = list(range(len(self.languages))), 0
                own = sums[np.ix_(at, some)]
                own -= own.max(axis=1, keepdims=True)
                out[np.ix_(at, some)] = np.maximum(own, FAR)
        return out, np.stack([np.array(letters, np.int64), counted], axis=1)


class _Words(dict):
    """Numbers of words; new ones are scored together by ``scored``."""

    LIMIT = 600_000
    TOGETHER = 20_000

    def __init__(self, model: Model):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.new: list[str] = []
        self.scores = np.zeros((0, len(self.model.languages) + 1), np.float32)
        self.letters = np.zeros((0, 2), np.int64)

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number

    def scored(self) -> tuple[np.ndarray, np.ndarray]:
        """Scores, and letters as (all, in scripts of a language), by number."""
        cuts = range(0, len(self.new), self.TOGETHER)
        parts = [self.model.score(self.new[k : k + self.TOGETHER]) for k in cuts]
        self.new = []
        self.scores = np.concatenate([self.scores, *[p for p, _ in parts]])
        self.letters = np.concatenate([self.letters, *[p for _, p in parts]])
        return self.scores, self.letters


def best_paths(scores: np.ndarray, sizes: np.ndarray, penalty: float) -> np.ndarray:
    """States of the best path of each text; ``scores`` holds the texts' words end to end.

    All texts advance together, the longest ones last.  Ties keep the state, then take
    the first.
    """
    order = np.argsort(-sizes, kind="stable")
    starts = (np.cumsum(sizes) - sizes)[order]
    ordered = sizes[order]
    longest = int(ordered[0]) if len(ordered) else 0
    # How many texts have more than t words.
    active = np.searchsorted(-ordered, -np.arange(longest), "left")
    best = np.zeros((len(order), scores.shape[1]))
    back = np.zeros(scores.shape, np.int16)
    own = np.arange(scores.shape[1], dtype=np.int16)
    for t in range(longest):
        k = active[t]
        rows = starts[:k] + t
        now = best[:k]
        if t:
            lead = now.argmax(axis=1)
            top = now[np.arange(k), lead] - penalty
            switch = now < top[:, None]
            back[rows] = np.where(switch, lead[:, None], own)
            now = np.where(switch, top[:, None], now)
        best[:k] = now + scores[rows]
    states = np.zeros(len(scores), np.int16)
    state = best.argmax(axis=1)
    for t in range(longest - 1, -1, -1):
        k = active[t]
        rows = starts[:k] + t
        states[rows] = state[:k]
        state[:k] = back[rows, state[:k]]
    return states


def train(
    labelled: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    docs_per_language: int = 1500,
    most_grams: int = 200_000,
    longest: int = 3,
    penalty: float = 6.0,
) -> Model:
    """Fit n-gram frequencies on a bounded sample of labelled rows.

    About ``docs_per_language`` rows of each language are taken by a hash of the text, so
    the sample does not depend on order; the text with the least hash is always in it, so
    no language is without one.  Counts are made by tasks; each language's most frequent
    n-grams, ``most_grams`` over all languages, and all its scripts make the model.  Rows
    without label are left out; no labels give a model that knows no language.
    """
    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where(
        "lang is not null and text is not null"
    )
    buckets = 1 << 20
    drawn = F.pmod(F.xxhash64("text"), F.lit(buckets))
    # One row a language.
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min(drawn).alias("least")).collect()
    if not sizes:
        return Model([], {}, np.zeros((0, 0)), np.zeros(0), {}, longest, penalty)
    shares = {
        r["lang"]: max(r["least"] + 1, min(buckets, -(-buckets * docs_per_language // r["n"])))
        for r in sizes
    }
    languages = sorted(shares)
    bound = F.create_map(*[F.lit(x) for lang in languages for x in (lang, shares[lang])])
    sample = rows.where(drawn < F.element_at(bound, F.col("lang")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        for batch in small_slices(batches, 1):
            words: Counter = Counter()
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words.update((lang, w) for w in text.split())
            out: Counter = Counter()
            for (lang, word), n in words.items():
                for c in word:
                    if c.isalpha():
                        out[lang, "", script(c)] += n
                if any(map(str.isalpha, word)):
                    for g in grams(word, longest):
                        out[lang, g, ""] += n
            lang, gram, kind = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(lang, pa.string()),
                    pa.array(gram, pa.string()),
                    pa.array(kind, pa.string()),
                    pa.array(list(out.values()), pa.int64()),
                ],
                ["lang", "gram", "script", "n"],
            )

    frequent = Window.partitionBy("lang", F.col("script") != "").orderBy(F.desc("n"), "gram", "script")
    counts = (
        sample.mapInArrow(count, "lang string, gram string, script string, n bigint")
        .groupBy("lang", "gram", "script")
        .agg(F.sum("n").alias("n"))
        .withColumn("place", F.row_number().over(frequent))
        .where((F.col("script") != "") | (F.col("place") <= -(-most_grams // len(languages))))
        .orderBy(F.desc("n"), "lang", "gram", "script")
        .collect()
    )
    column = {lang: k for k, lang in enumerate(languages)}
    letters: dict[tuple[str, str], int] = {}
    table: dict[str, int] = {}
    for r in counts:
        if r["script"]:
            letters[r["lang"], r["script"]] = r["n"]
        else:
            table.setdefault(r["gram"], len(table))
    freq = np.zeros((len(table), len(languages)))
    for r in counts:
        if not r["script"]:
            freq[table[r["gram"]], column[r["lang"]]] = r["n"]
    totals = freq.sum(axis=0) + 0.5 * (len(table) + 1)
    all_letters = {lang: sum(n for (l, _), n in letters.items() if l == lang) for lang in languages}
    scripts: dict[str, list[int]] = {}
    for (lang, kind), n in letters.items():
        # A script of under one letter in a thousand is foreign to the language.
        if n * 1000 >= all_letters[lang]:
            scripts.setdefault(kind, []).append(column[lang])
    return Model(
        languages,
        table,
        np.log((freq + 0.5) / totals),
        np.log(0.5 / totals),
        {k: sorted(v) for k, v in scripts.items()},
        longest,
        penalty,
    )


def _paths(texts: list[str | None], words: _Words):
    """States of the words of some texts, the text each word is in, and sizes, languages
    and scores of the texts."""
    model = words.model
    names = [*model.languages, UNKNOWN]
    parts = [(t or "").split() for t in texts]
    sizes = np.array([len(p) for p in parts], np.int64)
    if len(words) > words.LIMIT:
        words.forget()
    get = words.__getitem__
    numbers = np.fromiter((get(w) for p in parts for w in p), np.int64, int(sizes.sum()))
    scores, letters = words.scored()
    letters = letters[numbers]
    states = best_paths(scores[numbers], sizes, model.penalty)
    doc = np.repeat(np.arange(len(texts)), sizes)
    held, known = np.zeros((2, len(texts), len(names)))
    np.add.at(held, (doc, states), letters[:, 0])
    np.add.at(known, (doc, states), letters[:, 1])
    total, rows = held.sum(axis=1), np.arange(len(texts))
    # A path holds more in scripts that tell languages than in others, where it can.
    lead = np.where(known.any(axis=1), known.argmax(axis=1), held.argmax(axis=1))
    if not model.always:
        known, lead = held, held.argmax(axis=1)
    score = np.divide(known[rows, lead], total, out=np.zeros(len(texts)), where=total > 0)
    lang = [names[k] if n else UNKNOWN for k, n in zip(lead, total)]
    score[[x == UNKNOWN for x in lang]] = 0.0
    return states, doc, sizes, lang, score


def identify(
    docs: DataFrame,
    model: Model,
    id_col: str = "doc_id",
    text_col: str = "text",
    always: bool = False,
) -> DataFrame:
    """(doc_id, lang, score, spans): the language with most letters, and labelled spans.

    Words stand between white space.  A span is (first, last, lang): numbers of its words,
    the last one excluded.  Words without letters join the span around them.  ``score`` is
    the part of all letters that the language's spans hold.  Null texts and texts without
    letters are ``und`` with score 0 and, having no language, one span or none; ties go to
    the earlier name.  So are words in a script of no language; with ``always`` those take
    a language too, but do not count for the score.  One row per row of ``docs``.
    """
    ids = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    names = [*model.languages, UNKNOWN]
    kind = field(ids, "doc_id")
    used = replace(model, always=always)
    span_type = pa.list_(
        pa.struct([("first", pa.int32()), ("last", pa.int32()), ("lang", pa.string())])
    )

    def label(texts: list[str | None], words: _Words):
        states, doc, sizes, lang, score = _paths(texts, words)
        change = np.ones(len(states), bool)
        change[1:] = (states[1:] != states[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(change)
        last = np.r_[first[1:], len(states)] if len(first) else first
        base = np.cumsum(sizes) - sizes
        spans: list[list[dict]] = [[] for _ in texts]
        for a, b in zip(first.tolist(), last.tolist()):
            d = int(doc[a])
            spans[d].append({"first": a - int(base[d]), "last": b - int(base[d]), "lang": names[states[a]]})
        return lang, score, spans

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words(used)
        for batch in small_slices(batches, 1, 12 << 20):
            lang, score, spans = label(batch.column(1).to_pylist(), words)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lang), pa.array(score), pa.array(spans, span_type)],
                ["doc_id", "lang", "score", "spans"],
            )

    return ids.mapInArrow(
        run,
        f"doc_id {kind}, lang string, score double, "
        "spans array<struct<first: int, last: int, lang: string>>",
    )


def language_of(text: Column, model: Model, limit: int = 2 << 20) -> Column:
    """The language of a text column as ``identify`` tells it, beside the row.

    Only texts go to Python and only names come back, in slices of about ``limit`` bytes.
    Not deterministic for the optimiser's sake alone, which would else run it once more in
    a filter on its result.
    """

    @F.pandas_udf("string")
    def names(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        give_back()
        words = _Words(model)
        for part in parts:
            texts, found, start, size = part.tolist(), [], 0, 0
            for k, text in enumerate(texts):
                size += len(text or "")
                if size >= limit or k + 1 == len(texts):
                    found += _paths(texts[start : k + 1], words)[3]
                    start, size = k + 1, 0
            yield pd.Series(found, dtype=object)

    return names.asNondeterministic()(text)


def held_out(doc_id):
    """Whether a document is kept from training, by the checksum of its id as text."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op5_language(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs.where(~held_out(F.col("doc_id"))))
    return identify(docs, model, always=True).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("lang").alias("lang_pred"),
        "score",
        "spans",
    )
