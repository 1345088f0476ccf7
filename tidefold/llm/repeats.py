"""Exact repeats of long word sequences, found through fixed-block anchors.

A window of ``window`` words holds a whole block of about half its length wherever the
blocks of a document begin.  So the non-overlapping blocks of all documents are the index,
and every rolling window of a block's length probes it.  Where a probe meets a block of
another place, the windows around the hit are compared whole; the union of those that
stand elsewhere too are the maximal repeats.

Documents are handled in chunks of whole rows.  What is shuffled is packed: a chunk sends
each bucket of hashes its own different hashes in order, and gets back one bit for each.
So a passage that very many documents share costs one entry a chunk and no pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefold.llm.common import field, stored

#: Bytes of text in a chunk, and of text for each bucket of hashes.
CHUNK_BYTES, BUCKET_BYTES = 3 << 20, 16 << 20

SLICE = 1 << 20
BASE = 0x9E3779B97F4A7C15
UNBASE = pow(BASE, -1, 1 << 64)
FIRST, SECOND = 0xD6E8FEB86659FD93, 0xA0761D6478BD642F
BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.r_[np.uint64(1), np.full(n - 1, np.uint64(base))], dtype=np.uint64)


_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables_for(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(SLICE, 1 << (n - 1).bit_length())
    if size not in _tables:
        _tables[size] = _powers(BASE, size), _powers(UNBASE, size)
    return _tables[size]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread all bits of a hash over all bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and 64-bit hashes of the words in some bytes."""
    blank = BLANK[data]
    edge = np.flatnonzero(np.diff(np.r_[True, blank, True].view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    hashes = np.zeros(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        stop = max(at + 1, int(np.searchsorted(ends, starts[at] + SLICE, "right")))
        a, b = int(starts[at]), int(ends[stop - 1])
        power, inverse = _tables_for(b - a + 1)
        terms = (data[a:b].astype(np.uint64) + np.uint64(1)) * power[: b - a]
        terms[blank[a:b]] = 0
        sums = np.add.reduceat(terms, starts[at:stop] - a)
        sums *= inverse[starts[at:stop] - a]
        hashes[at:stop] = sums + (ends[at:stop] - starts[at:stop]).astype(np.uint64)
        at = stop
    return starts, ends, mixed(hashes)


def rolling(w: np.ndarray, length: int, base: int) -> np.ndarray:
    """Hashes of every run of ``length`` words, by doubling."""
    n = len(w) - length + 1
    if n <= 0:
        return w[:0]
    out, size, at, run = np.zeros(n, np.uint64), length, 0, w
    power = base
    block = 1
    with np.errstate(over="ignore"):
        while size:
            if size & 1:
                out = out * np.uint64(power) + run[at : at + n]
                at += block
            size >>= 1
            if size:
                run = run[:-block] * np.uint64(power) + run[block:]
                block *= 2
                power = power * power % (1 << 64)
    return mixed(out)


class Chunk:
    """Some whole documents as words, and where their windows are."""

    def __init__(self, texts: list[bytes], window: int):
        self.window, self.block = window, (window + 1) // 2
        self.data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        self.starts, self.ends, self.hashes = words(self.data)
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        self.edges = np.cumsum(sizes) - sizes
        self.first = np.searchsorted(self.starts, np.r_[self.edges, len(self.data)])
        counts = np.diff(self.first)
        doc = np.repeat(np.arange(len(texts)), counts)
        self.doc = doc
        within = np.arange(len(doc)) - self.first[doc]
        left = counts[doc] - within
        long = counts[doc] >= window
        #: Places of windows of both lengths, and which of the shorter are blocks.
        self.probes = np.flatnonzero(long & (left >= self.block))
        self.aligned = within[self.probes] % self.block == 0
        self.windows = np.flatnonzero(left >= window)

    def different_probes(self) -> Different:
        return Different(rolling(self.hashes, self.block, FIRST)[self.probes])

    def candidates(self, hit: np.ndarray) -> np.ndarray:
        """Windows that hold a hit; ``hit`` says which probes are."""
        total = np.zeros(len(self.doc) + 1, np.int64)
        np.cumsum(np.bincount(self.probes[hit], minlength=len(self.doc)), out=total[1:])
        w = self.windows
        return w[total[w + self.window - self.block + 1] > total[w]]

    def different_windows(self, at: np.ndarray) -> tuple[Different, np.ndarray]:
        """The windows at some places, by 95 bits of hash, and the last 31 of those bits."""
        first = rolling(self.hashes, self.window, FIRST)[at]
        second = (rolling(self.hashes, self.window, SECOND)[at] >> np.uint64(33)).astype("<u4")
        found = Different(first, second)
        return found, second[found.first]

    def kept(self, repeated: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Words, removed words and kept words of each document, given the repeated windows."""
        change = np.zeros(len(self.doc) + 1, np.int64)
        change[repeated] += 1
        change[repeated + self.window] -= 1
        gone = np.cumsum(change[:-1]) > 0
        n = np.diff(self.first)
        removed = np.bincount(self.doc[gone], minlength=len(n))
        # Kept words with one byte after each, made a blank.
        size = self.ends - self.starts + 1
        out = self.data.copy()
        out[self.ends] = 32
        stay = np.zeros(len(out) + 1, np.int8)
        stay[self.starts[~gone]] += 1
        stay[self.ends[~gone] + 1] -= 1
        text = out[np.cumsum(stay[:-1], dtype=np.int8) > 0].tobytes()
        ends = np.cumsum(np.bincount(self.doc[~gone], size[~gone], len(n))).astype(np.int64)
        kept = [text[a : max(a, b - 1)] for a, b in zip(np.r_[0, ends[:-1]].tolist(), ends.tolist())]
        return n, removed, kept


def _chunks(batches: Iterator[pa.RecordBatch], limit: int):
    """(chunk id, ids, texts); the ids are different within one run over the table."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1).cast(pa.binary()).to_pylist()):
            ids.append(doc_id)
            texts.append(text or b"")
            size += len(texts[-1])
            if size >= limit:
                yield number, ids, texts
                number, ids, texts, size = number + 1, [], [], 0
    if ids:
        yield number, ids, texts


SENT = ["bucket", "chunk", "payload"]


def _send(chunk: int, hashes: np.ndarray, buckets: int, columns) -> pa.RecordBatch:
    """Rows for the buckets: what ``columns`` makes of each bucket's entries, in order."""
    bucket = ((hashes >> np.uint64(40)) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    which, starts = np.unique(bucket[order], return_index=True)
    cuts = np.split(order, starts[1:]) if len(which) else []
    return pa.RecordBatch.from_arrays(
        [
            pa.array(which, pa.int32()),
            pa.array(np.full(len(which), chunk), pa.int64()),
            pa.array([columns(c) for c in cuts], pa.binary()),
        ],
        SENT,
    )


def _answer(sent: DataFrame, buckets: int, judge, purpose: str) -> DataFrame:
    """(chunk, bucket, bits): for each entry sent whether ``judge`` finds it repeated."""

    def flush(rows):
        parts = [p for _, p in rows]
        hit, sizes = judge(parts)
        for (chunk, _), bits in zip(rows, np.split(hit, np.cumsum(sizes)[:-1])):
            yield chunk, np.packbits(bits).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, rows = None, []

        def result():
            chunk, bits = zip(*flush(rows))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(chunk, pa.int64()),
                    pa.array([bucket] * len(chunk), pa.int32()),
                    pa.array(bits, pa.binary()),
                ],
                ["chunk", "bucket", "bits"],
            )

        for batch in batches:
            for b, chunk, payload in zip(*(c.to_pylist() for c in batch.columns)):
                if b != bucket and rows:
                    yield result()
                    rows = []
                bucket = b
                rows.append((chunk, payload))
        if rows:
            yield result()

    dealt = sent.repartition(buckets, "bucket").sortWithinPartitions("bucket").select(*SENT)
    return stored(dealt.mapInArrow(run, "chunk bigint, bucket int, bits binary"), purpose)


def _sizes_and_joined(parts: list[bytes], width: int):
    sizes = np.array([len(p) // width for p in parts], np.int64)
    return sizes, np.frombuffer(b"".join(parts), np.uint8).reshape(-1, width)


class Different:
    """The different values of some hashes, each once: ``values`` in rising order, whether
    they stand in ``many`` places, and ``inverse``, the value of each place."""

    def __init__(self, *keys: np.ndarray):
        order = np.lexsort(keys[::-1])
        new = np.ones(len(order), bool)
        if len(order):
            new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
        self.first = order[new]
        self.values = keys[0][self.first]
        self.inverse = np.zeros(len(order), np.int64)
        self.inverse[order] = np.cumsum(new) - 1
        self.many = np.bincount(self.inverse, minlength=len(self.first)) > 1


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each entry, and how many entries each group has."""
    found = Different(*keys)
    return found.inverse, np.bincount(found.inverse, minlength=len(found.first))


def judge_probes(parts: list[bytes]):
    """Probes whose hash is a block's, where that hash stands in two places or more.

    An entry is 30 bits of hash, a bit for many places, and the lowest bit for a block.
    """
    sizes, rows = _sizes_and_joined(parts, 4)
    h = rows.reshape(-1).view("<u4")
    group, n = _groups(h >> 2)
    blocks = np.bincount(group, h & 1, len(n))
    many = np.bincount(group, (h >> 1) & 1, len(n))
    return (((n > 1) | (many > 0)) & (blocks > 0))[group], sizes


def judge_windows(parts: list[bytes]):
    """Whole windows that stand in two places or more.

    An entry is 12 bytes: 95 bits of hash, and the lowest bit of the last four for many.
    """
    sizes, rows = _sizes_and_joined(parts, 12)
    a = np.ascontiguousarray(rows[:, :8]).view("<u8").reshape(-1)
    b = np.ascontiguousarray(rows[:, 8:]).view("<u4").reshape(-1)
    group, n = _groups(a, b >> 1)
    many = np.bincount(group, b & 1, len(n))
    return ((n > 1) | (many > 0))[group], sizes


def _bits(hashes: np.ndarray, buckets: int, answers: list[dict] | None) -> np.ndarray:
    """The answers to a chunk's entries, put back in the entries' order."""
    out = np.zeros(len(hashes), bool)
    if not answers or not len(hashes):
        return out
    bucket = ((hashes >> np.uint64(40)) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    n = np.bincount(bucket, minlength=buckets)
    at = np.cumsum(n) - n
    for x in answers:
        b = x["bucket"]
        bits = np.unpackbits(np.frombuffer(x["bits"], np.uint8), count=int(n[b])).astype(bool)
        out[order[at[b] : at[b] + n[b]]] = bits
    return out


def remove_repeats(
    docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): words that stand in a repeated window go.

    A window is ``window`` consecutive words of a document; it is repeated if the same
    words also start anywhere else, in the same document too.  Words stand between blanks
    (space, tab to carriage return); ``kept`` joins those that stay by one blank.  Null
    and empty texts have no words.  Each row of ``docs`` gives one row and counts by
    itself, so a repeated row of ``window`` words or more is removed whole.

    ``docs`` is read once, into stored chunks of whole texts that every later step reads.
    A chunk sends each different hash once, so one window that stands in a third of all
    places costs an entry a chunk.  Equal windows are told by 95 bits of hash.
    """
    import zstandard

    ids = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    size = ids.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(8, -(-size // BUCKET_BYTES))
    kind = ids.schema["doc_id"].dataType

    sent = "bucket int, chunk bigint, payload binary"
    def unpacked(texts: bytes, sizes: list[int]) -> list[bytes]:
        data = zstandard.ZstdDecompressor().decompress(texts, max_output_size=max(1, sum(sizes)))
        ends = np.cumsum(sizes).tolist()
        return [data[e - n : e] for e, n in zip(ends, sizes)]

    def rows_of(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                yield batch.slice(k, 1).to_pylist()[0]

    def probes(batches):
        for row in rows_of(batches):
            chunk = Chunk(unpacked(row["texts"], row["sizes"]), window)
            found = chunk.different_probes()
            block = np.bincount(found.inverse, chunk.aligned, len(found.values)) > 0
            entry = (found.values.astype("<u4") & np.uint32(0xFFFFFFFC)) | (found.many * np.uint32(2)) | block
            yield _send(row["chunk"], found.values, buckets, lambda c: entry[c].astype("<u4").tobytes())

    def packed(batches):
        pack = zstandard.ZstdCompressor(level=1)
        for number, own, texts in _chunks(batches, CHUNK_BYTES):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([[x.as_py() for x in own]], pa.list_(own[0].type)),
                    pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
                    pa.array([pack.compress(b"".join(texts))], pa.binary()),
                ],
                ["chunk", "ids", "sizes", "texts"],
            )

    def answers(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "bits")).alias(name))

    columns = f"chunk bigint, ids array<{kind.simpleString()}>, sizes array<bigint>, texts binary"
    chunks = stored(ids.mapInArrow(packed, columns), "repeat-chunks")
    hits = _answer(
        chunks.select("chunk", "sizes", "texts").mapInArrow(probes, sent), buckets, judge_probes, "repeat-hits"
    )
    asked = chunks.select("chunk", "sizes", "texts").join(answers(hits, "hits"), "chunk", "left")

    def reopened(row) -> tuple[Chunk, np.ndarray]:
        chunk = Chunk(unpacked(row["texts"], row["sizes"]), window)
        found = chunk.different_probes()
        return chunk, chunk.candidates(_bits(found.values, buckets, row["hits"])[found.inverse])

    def wholes(batches):
        for row in rows_of(batches):
            chunk, at = reopened(row)
            found, rest = chunk.different_windows(at)
            entry = np.zeros((len(rest), 12), np.uint8)
            entry[:, :8] = found.values.astype("<u8").view(np.uint8).reshape(-1, 8)
            last = (rest << np.uint32(1)) | found.many
            entry[:, 8:] = last.astype("<u4").view(np.uint8).reshape(-1, 4)
            yield _send(row["chunk"], found.values, buckets, lambda c: entry[c].tobytes())

    twice = _answer(asked.mapInArrow(wholes, sent), buckets, judge_windows, "repeat-windows")
    decided = chunks.join(
        answers(hits, "hits").join(answers(twice, "windows"), "chunk", "left"), "chunk", "left"
    )

    def removed(batches):
        for row in rows_of(batches):
            chunk, at = reopened(row)
            found, _ = chunk.different_windows(at)
            repeated = at[_bits(found.values, buckets, row["windows"])[found.inverse]]
            n, gone, kept = chunk.kept(repeated)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["ids"], arrow_kind),
                    pa.array(n, pa.int64()),
                    pa.array(gone, pa.int64()),
                    pa.array([k.decode("utf-8") for k in kept], pa.string()),
                ],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    from pyspark.sql.pandas.types import to_arrow_type

    arrow_kind = to_arrow_type(kind)
    return decided.mapInArrow(
        removed,
        f"doc_id {kind.simpleString()}, n_words bigint, n_removed bigint, kept string",
    )


def op9_repeats(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


ORACLE = r"""
with d as (select row_number() over () as r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w from documents),
s as (
  select r, unnest(generate_series(1, len(w) - 34)) as i,
    unnest(list_transform(generate_series(1, len(w) - 34), lambda i: array_to_string(w[i : i + 34], ' '))) as t
  from d where len(w) >= 35),
g as (select t from s group by t having count(*) > 1),
c as (select distinct s.r, s.i + k.k as i from s join g using (t), (select unnest(generate_series(0, 34)) as k) k),
x as (select r, unnest(w) as word, generate_subscripts(w, 1) as i from d),
y as (select x.r, count(c.i) as n_removed, string_agg(case when c.i is null then word end, ' ' order by x.i) as kept from x left join c on c.r = x.r and c.i = x.i group by x.r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_removed, 0) as bigint) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from d left join y using (r)
"""
