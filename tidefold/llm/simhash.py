"""SimHash near-duplicates: fingerprints, links within a few bits, and their components.

Fingerprints are embedded as bit counts of two-bit segments, four bits apart at most
meaning at most four counts apart (Manhattan distance is a lower bound of Hamming
distance).  The 32 segments form groups; two fingerprints in range agree exactly on all
but ``max_diff`` groups, so they meet in a grid cell named by the counts of the other
groups.  Inside a cell the Manhattan bound prunes, then the bits are compared.

A cell gives back links that connect what belongs together (a spanning set), not every
pair of a dense group.  A cell with more rows than a task should hold is cut into blocks,
and each pair of blocks is a group of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefold.llm.common import field, small_slices, stored
from tidefold.llm.components import connected

SEED = 42
LANES = np.uint64(0x0101010101010101)
PAIRS = 0x5555555555555555


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """Hashes of a text's shingles in their order, repeats included; none of a wordless text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # lowers A-Z only
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) <= width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(width))))
    digest, seed = xxhash.xxh64_digest, SEED
    return np.frombuffer(b"".join([digest(s, seed) for s in shingles]), dtype=">u8").astype(np.uint64)


def simhash(text: str | None, width: int = 4) -> int:
    """Unsigned 64-bit fingerprint; null and wordless texts give zero."""
    return fingerprint_of(shingle_hashes(text, width))


def fingerprint_of(h: np.ndarray) -> int:
    """The bits set in over half of the hashes."""
    n = len(h)
    if not n:
        return 0
    # Byte lanes hold up to 255 counts, so eight additions a shingle do for 64 bits.
    rows = -(-n // 255)
    padded = np.zeros(rows * 255, np.uint64)
    padded[:n] = h
    padded = padded.reshape(rows, 255)
    fingerprint = 0
    for bit in range(8):
        lanes = ((padded >> np.uint64(bit)) & LANES).sum(axis=1, dtype=np.uint64)
        counts = lanes.view(np.uint8).reshape(rows, 8).sum(axis=0, dtype=np.int64)
        for byte in np.flatnonzero(counts * 2 > n):
            fingerprint |= 1 << (8 * int(byte) + bit)
    return fingerprint


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4
) -> DataFrame:
    """(doc_id, fp): one row per document, the fingerprint as a signed long.

    A shingle is ``width`` words joined by one blank, repeats included; a text with fewer
    words is one shingle.  Null and empty texts have fingerprint zero.
    """
    ids = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches, 1):
            fps = [simhash(t, width) for t in batch.column(1).to_pylist()]
            signed = np.array(fps, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed)], ["doc_id", "fp"])

    return ids.mapInArrow(run, f"doc_id {field(ids, 'doc_id')}, fp bigint")


def segment_counts(fp):
    """Bit counts of the 32 two-bit segments in a long, each in unary (00, 01 or 11)."""
    other = F.shiftrightunsigned(fp, 1)
    some = fp.bitwiseOR(other).bitwiseAND(F.lit(PAIRS))
    both = fp.bitwiseAND(other).bitwiseAND(F.lit(PAIRS))
    return some.bitwiseOR(F.shiftleft(both, 1))


def group_masks(groups: int) -> list[int]:
    """Bit masks that cut 32 two-bit segments into ``groups`` runs."""
    edges = [32 * g // groups for g in range(groups + 1)]
    return [(1 << 2 * b) - (1 << 2 * a) for a, b in zip(edges, edges[1:])]


def cells(fps: DataFrame, max_diff: int, groups: int) -> DataFrame:
    """(combo, cell, fp): the grid cells each fingerprint is in."""
    masks = group_masks(groups)
    keys = [
        F.struct(
            F.lit(k).alias("combo"),
            F.col("counts")
            .bitwiseAND(F.lit(int(np.uint64(sum(masks[g] for g in kept)).astype(np.int64))))
            .alias("cell"),
        )
        for k, kept in enumerate(combinations(range(groups), groups - max_diff))
    ]
    return (
        fps.select("fp", segment_counts(F.col("fp")).alias("counts"))
        .select("fp", F.explode(F.array(*keys)).alias("key"))
        .select("key.combo", "key.cell", "fp")
    )


def _unary(f: np.ndarray) -> np.ndarray:
    """``segment_counts`` of an array; Manhattan distance is then a count of unlike bits."""
    pairs, one = np.uint64(PAIRS), np.uint64(1)
    other = f >> one
    return ((f | other) & pairs) | ((f & other & pairs) << one)


def _spanning(f: np.ndarray, max_diff: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect one cell's fingerprints as all links within range would."""
    unary = _unary(f)
    left, a, b = np.arange(len(f)), [], []
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            i = front.pop()
            near = np.flatnonzero(np.bitwise_count(unary[left] ^ unary[i]) <= max_diff)
            near = near[np.bitwise_count(f[left[near]] ^ f[i]) <= max_diff]
            if len(near):
                found = left[near]
                a.append(np.full(len(found), i))
                b.append(found)
                front.extend(found.tolist())
                left = np.delete(left, near)
    if not a:
        return left, left
    return np.concatenate(a), np.concatenate(b)


def cell_links(f: np.ndarray, group: np.ndarray, max_diff: int):
    """Links of many whole cells whose rows stand together; ``group`` numbers the cells."""
    n = len(f)
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[first, n])
    out_a, out_b = [], []
    for k in np.flatnonzero(sizes > 24):
        a, b = _spanning(f[first[k] : first[k] + sizes[k]], max_diff)
        out_a.append(a + first[k])
        out_b.append(b + first[k])
    room = np.repeat(np.where(sizes > 24, 0, sizes), sizes)
    at = np.arange(n) - np.repeat(first, sizes)
    unary = _unary(f)
    i, lag = np.flatnonzero(room > 1), 1
    while len(i):
        i = i[at[i] + lag < room[i]]
        near = i[np.bitwise_count(unary[i] ^ unary[i + lag]) <= max_diff]
        near = near[np.bitwise_count(f[near] ^ f[near + lag]) <= max_diff]
        out_a.append(near)
        out_b.append(near + lag)
        lag += 1
    if not out_a:
        return first[:0], first[:0]
    return np.concatenate(out_a), np.concatenate(out_b)


def links(
    fps: DataFrame, max_diff: int = 4, groups: int = 6, cell_rows: int = 1 << 16
) -> DataFrame:
    """(a, b): links between different fingerprints ``fp``, enough to connect each component.

    Every pair within ``max_diff`` bits is connected through the links returned.  More
    ``groups`` make smaller cells and more of them; choose more for more fingerprints.
    """
    spread = cells(fps, max_diff, groups)
    large = stored(
        spread.groupBy("combo", "cell")
        .count()
        .where(F.col("count") > cell_rows)
        .select("combo", "cell", F.ceil(F.col("count") / (cell_rows // 2)).alias("blocks")),
        "simhash-large",
    )
    key = ["combo", "cell", "lo", "hi"]
    if large.isEmpty():
        blocked = spread.withColumns({"lo": F.lit(0), "hi": F.lit(0)})
    else:
        block = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
        blocked = (
            spread.join(large, ["combo", "cell"], "left")
            .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
            .withColumn("own", block)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)))
            .select(
                "combo",
                "cell",
                "fp",
                F.least("own", "other").alias("lo"),
                F.greatest("own", "other").alias("hi"),
            )
        )

    def flush(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts)
        f = t.column("fp").to_numpy().view(np.uint64)
        keys = [t.column(c).to_numpy() for c in key]
        changed = np.zeros(len(f), bool)
        for k in keys:
            changed[1:] |= k[1:] != k[:-1]
        a, b = cell_links(f, np.cumsum(changed), max_diff)
        return pa.RecordBatch.from_arrays(
            [pa.array(f[a].view(np.int64)), pa.array(f[b].view(np.int64))], ["a", "b"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A cell may go on in the next batch: keep the last cell's rows back.
        kept: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(c).to_numpy() for c in key]
            same = np.ones(batch.num_rows, bool)
            for k in keys:
                same &= k == k[-1]
            start = batch.num_rows - int(np.argmin(same[::-1])) if not same.all() else 0
            tail = [batch.column(c)[0].as_py() for c in key]
            if start == 0 and kept and tail == [kept[-1].column(c)[-1].as_py() for c in key]:
                kept.append(batch)
                continue
            whole = kept + ([batch.slice(0, start)] if start else [])
            if whole:
                yield flush(whole)
            kept = [batch.slice(start)]
        if kept:
            yield flush(kept)

    found = (
        blocked.repartition(*key).sortWithinPartitions(*key).select(*key, "fp")
    ).mapInArrow(run, "a bigint, b bigint")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 4,
    max_diff: int = 4,
    groups: int = 6,
) -> DataFrame:
    """(doc_id, fp, component_id): one row per row of ``docs``.

    ``component_id`` is the smallest doc_id reachable over links of at most ``max_diff``
    differing bits; documents with equal fingerprints are linked.  Null ids are never the
    smallest (a component of null ids only has a null id); repeated rows stay repeated.
    Empty and null texts share fingerprint zero.  An empty table gives no rows; other
    columns of ``docs`` are not looked at.
    """
    prints = stored(fingerprints(docs, id_col, text_col, width), "simhash-fp")
    reps = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-reps")
    roots = connected(links(reps.select("fp"), max_diff, groups))
    nodes = reps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "rep", F.coalesce("root", "fp").alias("root")
    )
    first = nodes.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = nodes.join(first, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def hex_fingerprint(fp):
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def op8_simhash(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select(
        "doc_id", hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id"
    )
