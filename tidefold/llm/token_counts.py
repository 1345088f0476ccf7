"""Token counts that follow edits: a segment tree of pre-tokens for each document.

Leaves are runs of pre-tokens with their characters and tokens; inner nodes are sums.  An
edit finds its leaf by descending, re-encodes from a boundary a little before it, which
the edit cannot have moved, until a pre-token ends where an old leaf began, and updates
the sums above.  The rest of the document is not encoded again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefold.llm.common import field, small_slices

#: Pre-tokens in a leaf, when a document is split anew.
LEAF = 64

#: A boundary so many characters before an edit is out of the edit's reach: a pre-token
#: is told by its own characters and two more at most.
MARGIN = 4

CACHE_WORDS = 400_000


class Counter(dict):
    """Tokens of pre-tokens by a rank file; each is encoded when first met."""

    def __init__(self, ranks: str | None = None, pattern: str | None = None):
        import base64

        import public_tokenizers
        import regex
        import tiktoken

        pattern = pattern or public_tokenizers.PATTERN
        with open(ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding(
            "own", pat_str=pattern, mergeable_ranks=table, special_tokens={}
        )
        self.pattern = regex.compile(pattern)

    def __missing__(self, word: str) -> int:
        n = len(self.encoding.encode_ordinary(word))
        if len(self) < CACHE_WORDS:
            self[word] = n
        return n


class Tree:
    """Characters and tokens of a document's leaves, with sums above them."""

    def __init__(self, leaves: np.ndarray):
        """``leaves`` has a row (characters, tokens) for each leaf, in order."""
        self.size = 1 << max(0, len(leaves) - 1).bit_length()
        self.sums = np.zeros((2 * self.size, 2), np.int64)
        self.sums[self.size : self.size + len(leaves)] = leaves
        level = self.size
        while level > 1:
            half = level // 2
            self.sums[half:level] = self.sums[level : 2 * level : 2] + self.sums[level + 1 : 2 * level : 2]
            level = half

    @property
    def chars(self) -> int:
        return int(self.sums[1, 0])

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def leaf_at(self, char: int) -> tuple[int, int]:
        """The leaf that holds a character, and where it begins; the last for the end."""
        node, start = 1, 0
        while node < self.size:
            node *= 2
            left = int(self.sums[node, 0])
            if char - start >= left and int(self.sums[node + 1, 0]):
                start += left
                node += 1
        return node - self.size, start

    def leaf(self, number: int) -> tuple[int, int]:
        return int(self.sums[self.size + number, 0]), int(self.sums[self.size + number, 1])

    def set(self, number: int, chars: int, tokens: int) -> None:
        node = self.size + number
        by = np.array([chars, tokens]) - self.sums[node]
        while node:
            self.sums[node] += by
            node //= 2

    def leaves(self) -> np.ndarray:
        own = self.sums[self.size :]
        return own[own[:, 0] > 0]


def split(text: str, counter: Counter) -> np.ndarray:
    """Leaves of a whole text."""
    words = counter.pattern.findall(text)
    if not words:
        return np.zeros((0, 2), np.int64)
    n = len(words)
    both = np.empty((n, 2), np.int64)
    both[:, 0] = np.fromiter(map(len, words), np.int64, n)
    both[:, 1] = np.fromiter(map(counter.__getitem__, words), np.int64, n)
    return np.add.reduceat(both, np.arange(0, n, LEAF), axis=0)


def edit(text: str, tree: Tree, at: int, removed: int, added: str, counter: Counter):
    """(text, tree, characters encoded again) after one edit; places are clamped to the text."""
    at = min(max(at, 0), len(text))
    removed = min(max(removed, 0), len(text) - at)
    new = text[:at] + added + text[at + removed :]
    first, start = tree.leaf_at(at)
    while first and at - start < MARGIN:
        first -= 1
        start -= tree.leaf(first)[0]
    # Old leaves that begin behind the edit are where encoding may stop.
    last, last_start = tree.leaf_at(at + removed)
    end = last_start + tree.leaf(last)[0]
    shift = len(added) - removed
    parts: list[tuple[int, int]] = []
    n = tokens = begun = 0
    place = start
    for m in counter.pattern.finditer(new, start):
        while end + shift < m.end() and last + 1 < tree.size and end < len(text):
            last += 1
            end += tree.leaf(last)[0]
        n += 1
        tokens += counter[m.group()]
        place = m.end()
        if n == LEAF:
            parts.append((place - start - begun, tokens))
            begun, n, tokens = place - start, 0, 0
        if place == end + shift and place >= at + len(added):
            break
    else:
        last = tree.size - 1
    if n:
        parts.append((place - start - begun, tokens))
    room = last - first + 1
    if len(parts) <= room and tree.size > 1:
        for k in range(room):
            was = tree.leaf(first + k)
            now = parts[k] if k < len(parts) else (0, 0)
            if was != now:
                tree.set(first + k, *now)
    else:
        own = tree.sums[tree.size :]
        rows = [own[:first], np.array(parts, np.int64).reshape(-1, 2), own[last + 1 :]]
        rows = np.concatenate(rows)
        tree = Tree(rows[rows[:, 0] > 0])
    return new, tree, place - start


_counter: dict[str | None, Counter] = {}


def _counter_for(ranks: str | None) -> Counter:
    if ranks not in _counter:
        _counter[ranks] = Counter(ranks)
    return _counter[ranks]


def build(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
    ranks: str | None = None,
) -> DataFrame:
    """(doc_id, text, leaf_chars, leaf_tokens, *keep): documents with the leaves of their trees.

    The number of tokens is the sum of ``leaf_tokens``.  Null texts are empty.  ``ranks``
    is a rank file every executor has.  One row per row of ``docs``.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *keep
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter_for(ranks)
        for batch in small_slices(batches, 1, 4 << 20):
            leaves = [split(t, counter) for t in batch.column(1).to_pylist()]
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([x[:, 0] for x in leaves], kind),
                    pa.array([x[:, 1] for x in leaves], kind),
                    *batch.columns[2:],
                ],
                ["doc_id", "text", "leaf_chars", "leaf_tokens", *keep],
            )

    more = "".join(f", {c} {field(rows, c)}" for c in keep)
    return rows.mapInArrow(
        run,
        f"doc_id {field(rows, 'doc_id')}, text string, leaf_chars array<bigint>, "
        f"leaf_tokens array<bigint>{more}",
    )


def apply_edits(state: DataFrame, edits_col: str = "edits", ranks: str | None = None) -> DataFrame:
    """The state after each document's edits, and ``n_before``, ``n_tokens`` and ``n_encoded``.

    ``edits_col`` is an array of (at, removed, added): characters, in the text as the edits
    before have left it.  Places beyond the text are clamped, null fields count as nothing,
    null and empty arrays change nothing.  ``n_encoded`` is the number of characters that
    were encoded again.
    """
    rows = state.select("doc_id", "text", "leaf_chars", "leaf_tokens", F.col(edits_col).alias("edits"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter_for(ranks)
        for batch in small_slices(batches, 1, 4 << 20):
            texts, leaves, before, after, encoded = [], [], [], [], []
            chars, tokens, edits = batch.column(2), batch.column(3), batch.column(4)
            for k, text in enumerate(batch.column(1).to_pylist()):
                pair = [chars[k].values.to_numpy(), tokens[k].values.to_numpy()]
                tree = Tree(np.stack(pair, axis=1))
                before.append(tree.tokens)
                work = 0
                for e in edits[k].as_py() or ():
                    e = e or {}
                    text, tree, n = edit(
                        text, tree, e.get("at") or 0, e.get("removed") or 0, e.get("added") or "", counter
                    )
                    work += n
                texts.append(text)
                leaves.append(tree.leaves())
                after.append(tree.tokens)
                encoded.append(work)
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(texts, pa.string()),
                    pa.array([x[:, 0] for x in leaves], kind),
                    pa.array([x[:, 1] for x in leaves], kind),
                    pa.array(before, pa.int64()),
                    pa.array(after, pa.int64()),
                    pa.array(encoded, pa.int64()),
                ],
                ["doc_id", "text", "leaf_chars", "leaf_tokens", "n_before", "n_tokens", "n_encoded"],
            )

    return rows.mapInArrow(
        run,
        f"doc_id {field(rows, 'doc_id')}, text string, leaf_chars array<bigint>, "
        "leaf_tokens array<bigint>, n_before bigint, n_tokens bigint, n_encoded bigint",
    )


def edits_of(text) -> object:
    """Three edits made of the text itself: an insertion, a deletion and a replacement."""
    n = F.length(text)

    def one(at, removed, added):
        return F.struct(
            at.cast("bigint").alias("at"), removed.cast("bigint").alias("removed"), added.alias("added")
        )

    return F.array(
        one(F.floor(n / 2), F.lit(0), F.substring(text, F.lit(1), F.lit(40))),
        one(F.floor(n / 3), F.lit(25), F.lit("")),
        one(F.floor(n * 2 / 3), F.lit(10), F.lit(" 2024-01-02,\n it's  done")),
    )


def op10_token_counts(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    state = build(docs.withColumn("edits", edits_of(text)), keep=("edits",))
    return apply_edits(state).select("doc_id", "n_before", "n_tokens", "n_encoded")
