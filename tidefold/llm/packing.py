"""Best-two-fit packing of tokenised documents into sequences of fixed capacity.

Only the numbers of pieces by length matter to a packing, and there are no more lengths
than the capacity.  So pieces are counted by length, the counts are packed (runs of equal
sequences at once), and each piece finds its place by its rank among the pieces of its
length.  Ranks come from counts by (writing task, length), so no length is one group.  Pieces
counted while they are made need no shuffle for that.
"""

from __future__ import annotations

import bisect
from collections import Counter
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidefold.llm.common import field, give_back, small_slices, stored

#: Words whose ids one Python worker keeps, and bytes of text it cuts into words at a time.
CACHE_WORDS, TEXT_BYTES = 250_000, 1 << 20
END_ID = 0


class _Numbers(dict):
    """Numbers of parts of texts, in the order in which they are first met."""

    def __missing__(self, part: str) -> int:
        self[part] = number = len(self)
        return number


class _Ids:
    """Token ids of texts, with a store of the parts met before.

    A blank between two signs that are not white space begins a pre-token whatever stands
    around it.  So a text is cut there, and each part is encoded as if it stood alone: the
    first as it is, the others with their blank.  The first is stored with a blank in
    front, which no other part has; the end of a document is stored as None.

    New parts are encoded with the rank file of the same vocabulary, which is faster and
    gives the same ids; parts that may hold a special token's string go to the tokenizer.
    """

    def __init__(self, vocabulary: str, ranks: str, pattern: str):
        import base64
        import re

        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding(
            "own", pat_str=pattern, mergeable_ranks=table, special_tokens={}
        )
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")
        self.runs = re.compile(r"^\s|\s\s|\s$")
        self.cuts = re.compile(r"(?<=\S) (?=\S)")
        self.forget()

    def forget(self) -> None:
        self.numbers = _Numbers({None: 0})
        self.sizes = np.array([1])
        self.flat = np.array([END_ID], "<u4")

    def _encode_new(self) -> None:
        new = list(islice(self.numbers, len(self.sizes), None))
        if new:
            texts = [p[1:] if p[:1] == " " else " " + p for p in new]
            encode, special = self.encoding.encode_ordinary, self.special.search
            ids = [
                self.tokenizer.encode(t, add_special_tokens=False).ids if special(t) else encode(t)
                for t in texts
            ]
            self.sizes = np.concatenate([self.sizes, np.fromiter(map(len, ids), np.int64, len(ids))])
            flat = np.fromiter(chain.from_iterable(ids), "<u4")
            self.flat = np.concatenate([self.flat, flat])

    def encode_all(self, texts: list[str]) -> tuple[bytes, np.ndarray]:
        """The ids of documents one after another, each with its end id, and where each ends."""
        parts: list[str | None] = []
        last = []
        for text in texts:
            cut = self.cuts.split(text) if self.runs.search(text) else text.split(" ")
            cut[0] = " " + cut[0]
            parts += cut
            parts.append(None)
            last.append(len(parts))
        if len(self.numbers) > CACHE_WORDS:
            self.forget()
        number = np.fromiter(map(self.numbers.__getitem__, parts), np.int64, len(parts))
        self._encode_new()
        starts = np.cumsum(self.sizes) - self.sizes
        sizes = self.sizes[number]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(starts[number] - (ends - sizes), sizes) + np.arange(total)
        return self.flat[at].tobytes(), ends[np.array(last, np.int64) - 1]

    def encode(self, text: str) -> bytes:
        """The ids of one text, without an end id."""
        return self.encode_all([text])[0][:-4]


_ids: dict[tuple[str, str, str], _Ids] = {}


def default_vocabulary() -> tuple[str, str, str]:
    import public_tokenizers as p

    return p.path("byte_bpe_50k.json"), p.path("byte_bpe_50k.tiktoken"), p.PATTERN


def piece_starts(n: int, capacity: int) -> list[int]:
    """Where the pieces of ``n`` ids begin: all but the first are full."""
    first = (n - 1) % capacity + 1
    return [0, *range(first, n, capacity)]


def tokenise(
    docs: DataFrame,
    vocabulary: tuple[str, str, str] | None = None,
    capacity: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
    nth: str | None = None,
) -> DataFrame:
    """(doc_id, piece, start, length, tokens): documents as pieces of at most ``capacity`` ids.

    A document is the ids of its text and an end id.  ``tokens`` is binary: unsigned
    32-bit little-endian ids.  Null and empty texts are one piece holding the end id.
    ``vocabulary`` names a tokenizer file, the rank file of the same vocabulary, both of
    which every executor has, and the pattern that splits text before the merges.  ``nth``
    names one more column: the number of earlier pieces of this length in the same task.
    """
    vocabulary = vocabulary or default_vocabulary()
    ids = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        give_back()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if vocabulary not in _ids:
            _ids[vocabulary] = _Ids(*vocabulary)
        encoder = _ids[vocabulary]
        met: Counter[int] = Counter()
        for batch in small_slices(batches, 1, TEXT_BYTES):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            data, ends = encoder.encode_all(texts)
            rows, number, start, length, tokens, earlier = [], [], [], [], [], []
            begin = 0
            for row, end in enumerate(ends.tolist()):
                starts = piece_starts(end - begin, capacity)
                for k, (a, b) in enumerate(zip(starts, [*starts[1:], end - begin])):
                    rows.append(row)
                    number.append(k)
                    start.append(a)
                    length.append(b - a)
                    tokens.append(data[4 * (begin + a) : 4 * (begin + b)])
                    earlier.append(met[b - a])
                    met[b - a] += 1
                begin = end
            columns = {
                "doc_id": batch.column(0).take(pa.array(rows, pa.int64())),
                "piece": pa.array(number, pa.int32()),
                "start": pa.array(start, pa.int64()),
                "length": pa.array(length, pa.int64()),
                "tokens": pa.array(tokens, pa.binary()),
            }
            if nth:
                columns[nth] = pa.array(earlier, pa.int64())
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    form = f"doc_id {field(ids, 'doc_id')}, piece int, start bigint, length bigint, tokens binary"
    return ids.mapInArrow(run, form + (f", {nth} bigint" if nth else ""))


def best_two_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """Sequences as (how many, lengths), from the numbers of pieces by length.

    A sequence is filled greedily with the longest piece that fits.  Then its smallest
    piece gives way to the two unpacked pieces that fill the gap so widened best, if they
    fill more of it.  As many equal sequences are made at once as the counts allow.
    """
    left = {n: k for n, k in counts.items() if k}
    lengths = sorted(left)
    plan = []
    while lengths:
        use: Counter[int] = Counter()
        gap = capacity
        while True:
            at = bisect.bisect_right(lengths, gap) - 1
            while at >= 0 and use[lengths[at]] >= left[lengths[at]]:
                at -= 1
            if at < 0:
                break
            # As many of this length as fit, in one step.
            n = lengths[at]
            k = min(gap // n, left[n] - use[n])
            use[n] += k
            gap -= n * k
        use = +use
        if gap:
            smallest = min(use)
            pair = _two_for(lengths, left, use, smallest, gap + smallest)
            if pair:
                use[smallest] -= 1
                use.update(pair)
                use = +use
        copies = min(left[n] // k for n, k in use.items())
        plan.append((copies, sorted(use.elements(), reverse=True)))
        for n, k in use.items():
            left[n] -= copies * k
            if not left[n]:
                lengths.pop(bisect.bisect_left(lengths, n))
    return plan


def _two_for(lengths, left, use, smallest: int, gap: int) -> list[int] | None:
    """Two unpacked lengths that fill more of ``gap`` than ``smallest``, as much as can be."""
    free = [n for n in lengths[: bisect.bisect_left(lengths, gap)] if left[n] > use[n]]
    best, pair, low, high = smallest, None, 0, len(free) - 1
    while low <= high and best < gap:
        total = free[low] + free[high]
        if total > gap:
            high -= 1
            continue
        if total > best and (low < high or left[free[low]] - use[free[low]] > 1):
            best, pair = total, [free[low], free[high]]
        low += 1
    return pair


def slots(plan: list[tuple[int, list[int]]], lengths_at_most: int):
    """Arrays by length: first rank, first sequence and place of each run of equal slots."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    ranks: Counter[int] = Counter()
    sequence = 0
    for copies, lengths in plan:
        offset = 0
        for n in lengths:
            runs.setdefault(n, []).append((ranks[n], sequence, offset))
            ranks[n] += copies
            offset += n
        sequence += copies
    return {n: np.array(r, np.int64) for n, r in runs.items()}


def pack(pieces: DataFrame, capacity: int = 2048, nth: str | None = None) -> DataFrame:
    """``pieces`` with sequence_id and offset; ``length`` is 1 to ``capacity`` in each row.

    Sequences are gapless from offset 0 and hold at most ``capacity``.  Every row gets its
    own place, repeated rows and null ids too.  No rows give no sequences.  The rows are
    written to the shared folder once, so that ranks hold when tasks run again; own
    columns named like the new ones are replaced.  What reaches the driver is one count
    for each length.

    ``nth`` names a column of ``tokenise``, which is left out of the result.  Then no row is
    moved: places are looked up in the numbers of pieces of each length in earlier tasks, an
    array for each task, sent to all.  All rows must be as and where ``tokenise`` made them.
    """
    keep = [c for c in pieces.columns if c.lower() not in ("sequence_id", "offset") and c != nth]
    row = [F.col(nth).alias("_nth")] if nth else []
    fixed = stored(
        pieces.select(*keep, *row, F.monotonically_increasing_id().alias("_row")), "pieces"
    )
    task = F.shiftright("_row", 33).alias("_task")
    by_task = stored(fixed.groupBy(task, "length").count(), "piece-counts")
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    if any(not 1 <= n <= capacity for n in counts):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    where = slots(best_two_fit(counts, capacity), capacity)
    earlier = Window.partitionBy("length").orderBy("_task").rowsBetween(
        Window.unboundedPreceding, -1
    )
    bases = by_task.select(
        "_task", "length", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_base")
    )
    if nth:
        def dense(part: pa.Table) -> pa.Table:
            base = np.zeros(capacity + 1, np.int64)
            base[part.column("length").to_numpy()] = part.column("_base").to_numpy()
            return pa.table({"_task": part.column("_task")[:1], "_bases": [base]})

        by = bases.groupBy("_task").applyInArrow(dense, "_task bigint, _bases array<bigint>")
        base = F.get("_bases", F.col("length").cast("int"))
        ranked = (
            fixed.withColumn("_task", task)
            .join(F.broadcast(by), "_task")
            .select(*keep, (base + F.col("_nth")).alias("_rank"))
        )
    else:
        own = Window.partitionBy("_task", "length").orderBy("_row")
        ranked = (
            fixed.withColumn("_task", task)
            .join(bases, ["_task", "length"])
            .withColumn("_rank", F.col("_base") + F.row_number().over(own) - 1)
        )

    def places(lengths: np.ndarray, ranks: np.ndarray) -> np.ndarray:
        out = np.zeros((2, len(lengths)), np.int64)
        for n in np.unique(lengths):
            rows = np.flatnonzero(lengths == n)
            runs = where[int(n)]
            hit = np.searchsorted(runs[:, 0], ranks[rows], "right") - 1
            out[0, rows] = runs[hit, 1] + ranks[rows] - runs[hit, 0]
            out[1, rows] = runs[hit, 2]
        return out

    if nth:
        # A scalar function would keep whole rows of the join beside it, each with its array.
        at, last = keep.index("length"), len(keep)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            give_back()
            for batch in batches:
                found = places(batch.column(at).to_numpy(), batch.column(last).to_numpy())
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:last], *map(pa.array, found)], [*keep, "sequence_id", "offset"]
                )

        form = fixed.select(*keep).schema.add("sequence_id", "long").add("offset", "long")
        return ranked.mapInArrow(run, form)

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        found = places(length.to_numpy(), rank.to_numpy())
        return pd.DataFrame(found.T, columns=["sequence_id", "offset"])

    return ranked.withColumn("_place", place("length", "_rank")).select(
        *keep, "_place.sequence_id", "_place.offset"
    )


def pack_documents(docs: DataFrame, capacity: int = 2048, **options) -> DataFrame:
    """(doc_id, piece, start, length, tokens, sequence_id, offset) for whole documents."""
    return pack(tokenise(docs, capacity=capacity, nth="nth", **options), capacity, nth="nth")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, tokens, lengths): the pieces of each sequence joined in order."""
    piece = F.struct("offset", "length", "tokens")
    return packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(piece)).alias("p")).select(
        "sequence_id",
        F.aggregate("p.tokens", F.lit(b""), lambda a, t: F.concat(a, t)).alias("tokens"),
        F.col("p.length").alias("lengths"),
    )


def op2_packing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pieces = tokenise(docs, nth="nth").select(
        "doc_id", "piece", "start", "length", F.crc32("tokens").alias("ids_crc32"), "nth"
    )
    return pack(pieces, nth="nth")
