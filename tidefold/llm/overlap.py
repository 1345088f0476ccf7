"""Near copies by the words they share: Jaccard similarity of shingle sets, exactly.

Candidates come from two sides.  SimHash names texts whose fingerprints are linked within a
few bits (``simhash.links``).  Texts of similarity 0.8 may differ in more bits than a grid of
fingerprints can find, so texts that share rare shingles are candidates, too.

Two sets of similarity 0.8 or more share one of the first few shingles of each (a fifth of
the set and one more) in any order that is the same for all texts.  Rare shingles come
first in it.  Texts that share one are compared where the places of that shingle leave room
for enough others, so no pair is missed.

No pair becomes a row.  Tasks go through the texts of a shingle, or of a link of SimHash, and
send only pairs that connect those that may be alike, judged by a sketch of each set that never
tells alike sets apart.  Only what these pairs connect is then compared whole, so none is linked
by chance: each set is sent once, to those it may be alike, or once for each block where there
are more than a task should hold.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefold.llm.common import field, give_back, small_slices, stored
from tidefold.llm.components import connected
from tidefold.llm.simhash import SEED, fingerprint_of, links, shingle_hashes

#: Counters of shingles for each text, and bits of the number of counters at most.
COUNTERS_PER_TEXT, MOST_BITS = 64, 24
#: Rounds of whole comparisons before those by sketches; there are none any more, tests name it.
STAR_ROUNDS = 0
#: A table of so many bits tells which texts are needed.
BITS = 1 << 25
#: Bytes of a group that one task compares; larger ones are cut into blocks of half as many.
BLOCK_BYTES = 16 << 20
#: Texts of a shingle among which those without a partner are left out; more stay as they are.
ROOM_TEXTS = 1 << 13
#: Groups of so many rows are compared pair by pair, many groups at a time.
SMALL_GROUP = 4


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted hashes of the shingles; a text of fewer words is one, null and wordless none."""
    return np.unique(shingle_hashes(text, width))


def _name(hashes: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(hashes.tobytes(), SEED) if len(hashes) else 0


def _longs(values) -> pa.Array:
    return pa.array(np.asarray(values, np.uint64).view(np.int64))


def _counts(texts: DataFrame, width: int) -> np.ndarray:
    """About how many texts hold a shingle, by the first bits of its hash, on a log scale.

    Counted over all texts; shingles that agree in those bits share a counter.  Each task
    sends its counters packed, by blocks, and a block is added up as the rows arrive, so no
    task holds more than the table.  The table has at most ``1 << MOST_BITS`` bytes.
    """
    bits = min(MOST_BITS, max(16, (COUNTERS_PER_TEXT * texts.count()).bit_length()))
    shift, block = np.uint64(64 - bits), 1 << 16

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        table, waiting, size = np.zeros(1 << bits, np.uint32), [], 0

        def add():
            at, n = np.unique(np.concatenate(waiting), return_counts=True)
            table[at] += n.astype(np.uint32)
            waiting.clear()

        for batch in small_slices(batches, 0):
            for t in batch.column(0).to_pylist():
                waiting.append((shingle_set(t, width) >> shift).astype(np.uint32))
                size += len(waiting[-1])
                if size > 1 << 20:
                    add()
                    size = 0
        if waiting:
            add()
        for k in range(len(table) // block):
            part = table[k * block : (k + 1) * block]
            if part.any():
                # Low bytes apart from high ones: most are zero and pack well.
                packed = zlib.compress(part.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int32()), pa.array([packed], pa.binary())], ["block", "counts"]
                )

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(4, -1).T
                part = np.ascontiguousarray(part).view(np.uint32)[:, 0]
                sums[k] = sums[k] + part if k in sums else part.astype(np.uint64)
        for k, n in sums.items():
            level = np.minimum(255, 8 * np.log2(1.0 + n)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int32()), pa.array([level.tobytes()], pa.binary())], ["block", "counts"]
            )

    form = "block int, counts binary"
    table = np.zeros(1 << bits, np.uint8)
    for r in texts.select("text").mapInArrow(count, form).repartition("block").mapInArrow(add_up, form).collect():
        table[r["block"] * block : (r["block"] + 1) * block] = np.frombuffer(r["counts"], np.uint8)
    return table


def _first_shingles(texts: DataFrame, width: int) -> DataFrame:
    """(token, node, n, at): the shingles by which a set of ``n`` is found, and their places."""
    counts = _counts(texts, width)
    shift = np.uint64(65 - len(counts).bit_length())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        seen: set[int] = set()  # copies are sent once by each task
        for batch in small_slices(batches, 0):
            cols: list[list[np.ndarray]] = [[], [], [], []]
            for t in batch.column(0).to_pylist():
                h = shingle_set(t, width)
                n, node = len(h), _name(h)
                if not n or node in seen:
                    continue
                seen.add(node)
                often = counts[h >> shift]
                k = n - (4 * n + 4) // 5 + 1
                first = h[np.lexsort((h, often))[:k]]
                for c, v in zip(cols, (first, np.full(k, node, np.uint64), np.full(k, n, np.uint64), np.arange(k, dtype=np.uint64))):
                    c.append(v)
            if cols[0]:
                yield pa.RecordBatch.from_arrays(
                    [_longs(np.concatenate(c)) for c in cols], ["token", "node", "n", "at"]
                )

    return texts.select("text").mapInArrow(run, "token bigint, node bigint, n bigint, at bigint")


def _sets(keys: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """(part, node, hashes): the sets of the texts that ``keys`` (node, pick, part) picks."""
    bit = F.pmod(F.col("pick"), F.lit(BITS))
    words = keys.groupBy(F.floor(bit / 64).alias("w")).agg(F.expr(f"bit_or(shiftleft(1L, cast(pmod(pick, {BITS}) % 64 as int)))").alias("bits"))
    table, few = np.zeros(BITS // 64, np.int64), words.toArrow()
    table[few["w"].to_numpy()] = few["bits"].to_numpy()
    needed = table.view(np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        for batch in batches:
            at = batch.column(0).to_numpy() % BITS
            hit = (needed[at // 64] >> (at % 64).astype(np.uint64)) & np.uint64(1)
            some = batch.filter(pa.array(hit.astype(bool)))
            for part in small_slices([some], 1):
                sets = [shingle_set(t, width) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), _longs([_name(h) for h in sets]), pa.array([h.tobytes() for h in sets], pa.binary())],
                    ["pick", "node", "hashes"],
                )

    sets = texts.select("pick", "text").mapInArrow(run, "pick bigint, node bigint, hashes binary")
    return sets.join(keys.select("pick", "node", "part"), ["pick", "node"]).select("part", "node", "hashes")


def _sketch(h: np.ndarray) -> np.ndarray:
    """Whether an odd number of hashes has each value of their last bits, one bit for each value.

    Sketches differ in no more bits than sets in members.  There are at least as many bits as
    members, so unlike sets differ in too many.
    """
    bits = max(64, 1 << (len(h) - 1).bit_length())
    odd = np.bincount((h & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def _folded(sketches: np.ndarray) -> np.ndarray:
    """Sketches of half as many bits."""
    half = sketches.shape[-1] // 2
    return sketches[..., :half] ^ sketches[..., half:]


class _Sketches:
    """Sketches of sets of ``n`` members, kept by length."""

    def __init__(self, sketches: list[np.ndarray], n: np.ndarray):
        self.own, self.n = sketches, n
        self.words = np.array([len(s) for s in sketches])
        self.place, self.stacked = np.zeros(len(n), np.int64), {}
        for w in np.unique(self.words).tolist():
            rows = np.flatnonzero(self.words == w)
            self.place[rows] = np.arange(len(rows))
            self.stacked[w] = np.stack([sketches[k] for k in rows])

    def near(self, i: int, others: np.ndarray) -> np.ndarray:
        """Which others may have 0.8 in common with ``i``: all that do, and few more."""
        own, words = self.own[i], len(self.own[i])
        # Sets of such similarity differ by a fourth in size at most, so in length by one step.
        apart = np.full(len(others), np.iinfo(np.int64).max // 9)
        for w in (words // 2, words, 2 * words):
            at = np.flatnonzero(self.words[others] == w) if w in self.stacked else ()
            if len(at):
                rows = self.stacked[w][self.place[others[at]]]
                unlike = (_folded(rows) if w > words else rows) ^ (_folded(own) if w < words else own)
                apart[at] = np.bitwise_count(unlike).sum(axis=1, dtype=np.int64)
        return 9 * apart <= self.n[i] + self.n[others]


def _spanning(root: np.ndarray, near: Callable[[int, np.ndarray], np.ndarray]) -> tuple[list, list]:
    """Pairs of rows near each other that connect what all such pairs would.

    Rows of one ``root`` are connected already.
    """
    left, a, b = np.ones(len(root), bool), [], []
    for first in range(len(root)):
        if not left[first]:
            continue
        front = np.flatnonzero(root == root[first]).tolist()
        left[front] = False
        while front:
            i, others = front.pop(), np.flatnonzero(left)
            if not len(others):
                break
            found = others[near(i, others)]
            if len(found):
                roots, at = np.unique(root[found], return_index=True)
                a += [i] * len(at)
                b += found[at].tolist()
                more = others[np.isin(root[others], roots)]
                left[more] = False
                front.extend(more.tolist())
    return a, b


def _grouped(rows: DataFrame, sizes: DataFrame, key: str) -> DataFrame:
    """``rows`` (key, node, ...) dealt by key, lo, hi and sorted so, for ``_whole``.

    A key with more than BLOCK_BYTES, by the ``size`` of its rows in ``sizes``, is cut into
    blocks by node, and each pair of blocks is a group.
    """
    large = stored(
        sizes.groupBy(key).agg(F.sum("size").alias("size")).where(F.col("size") > BLOCK_BYTES)
        .select(key, F.ceil(F.col("size") / (BLOCK_BYTES // 2)).cast("int").alias("blocks")),
        "overlap-large",
    )
    if large.isEmpty():
        blocked = rows.withColumns({"lo": F.lit(0), "hi": F.lit(0)})
    else:
        own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
        blocked = (
            rows.join(large, key, "left")
            .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
            .withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")})
        )
    columns = [key, "lo", "hi", *[c for c in rows.columns if c != key]]
    return blocked.select(*columns).repartition(key, "lo", "hi").sortWithinPartitions(key, "lo", "hi")


def _whole(
    batches: Iterator[pa.RecordBatch], keys: int = 3, most: int | None = None
) -> Iterator[tuple[dict[str, pa.Array], np.ndarray]]:
    """Columns of whole groups, and where each begins and the last ends.

    Rows alike in the first ``keys`` columns follow each other and are a group.  One of more
    than ``most`` rows comes in parts, the first of them with more rows than that.
    """

    def begins(part) -> np.ndarray:
        own = [part.column(c).to_numpy() for c in range(keys)]
        changed = np.logical_or.reduce([k[1:] != k[:-1] for k in own])
        return np.concatenate([[0], np.flatnonzero(changed) + 1])

    def out(parts: list[pa.RecordBatch]):
        t = pa.Table.from_batches(parts).combine_chunks()
        return {c: t.column(c).chunk(0) for c in t.column_names}, np.append(begins(t), t.num_rows)

    # A group may go on in the next batch: the last one is kept back.
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        start = int(begins(batch)[-1])
        if start:
            yield out([*kept, batch.slice(0, start)])
            kept = []
        elif kept and any(kept[-1].column(c)[-1] != batch.column(c)[0] for c in range(keys)):
            yield out(kept)
            kept = []
        kept.append(batch.slice(start))
        if most is not None and sum(b.num_rows for b in kept) > most:
            yield out(kept)
            kept = []
    if kept:
        yield out(kept)


def _with_room(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (token, node, n, at) in order of token, those another set of their token has room with.

    Two sets may have 0.8 in common if that is their first common shingle.  Rows of a token
    with more than ROOM_TEXTS rows all stay.
    """
    give_back()
    over = None
    for columns, edges in _whole(batches, 1, ROOM_TEXTS):
        sizes = np.diff(edges)
        token = columns["token"].to_numpy()[edges[:-1]]
        large = (sizes > ROOM_TEXTS) | (token == over if over is not None else False)
        over = token[-1] if sizes[-1] > ROOM_TEXTS else over
        if large.any():
            yield _rows_at(columns, np.flatnonzero(np.repeat(large, sizes)))
        rows = np.flatnonzero(np.repeat(~large & (sizes > 1), sizes))
        if not len(rows):
            continue
        group = np.repeat(np.arange(len(sizes)), sizes)[rows]
        n, at, node = (columns[c].to_numpy()[rows] for c in ("n", "at", "node"))
        order = np.lexsort((node, n, group))
        # A copy that another task has sent, too, is one row.
        copy = (np.diff(group[order]) == 0) & (np.diff(node[order]) == 0)
        order = order[np.append(True, ~copy)]
        n, at, node, group = n[order], at[order], node[order], group[order]
        rest, end, keep = n - at, np.searchsorted(group, group, "right"), np.zeros(len(n), bool)
        i, lag = np.arange(len(n)), 1
        while len(i):
            # In order of size: once one is too large for i, all after it are.
            i = i[i + lag < end[i]]
            i = i[4 * n[i + lag] <= 5 * n[i]]
            j = i + lag
            fit = 9 * np.minimum(rest[i], rest[j]) >= 4 * (n[i] + n[j])
            keep[i[fit]] = keep[j[fit]] = True
            lag += 1
        yield _rows_at(columns, rows[np.sort(order[keep])])


def _rows_at(columns: dict[str, pa.Array], rows: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns[c].take(pa.array(rows)) for c in columns], list(columns))


def _words(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(v.as_buffer(), np.uint64) for v in column]


def _pairs_of(name: np.ndarray, ends: tuple[list, list]) -> pa.RecordBatch:
    a, b = (name[np.array(e, np.int64)] for e in ends)
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def _near_in_small(columns: dict[str, pa.Array], edges: np.ndarray) -> pa.RecordBatch:
    """The pairs in groups of at most SMALL_GROUP rows that may have 0.8 in common."""
    sizes = np.diff(edges)
    small = (sizes > 1) & (sizes <= SMALL_GROUP)
    rows = np.flatnonzero(np.repeat(small, sizes))
    end = np.repeat(edges[1:], sizes)
    n, at, node = (columns[c].to_numpy() for c in ("n", "at", "node"))
    offsets = np.frombuffer(columns["sketch"].buffers()[1], np.int32)[columns["sketch"].offset :] // 8
    flat = np.frombuffer(columns["sketch"].buffers()[2] or b"", np.uint64, count=int(offsets[len(n)]))
    words = np.diff(offsets[: len(n) + 1])
    left, right = [], []
    for lag in range(1, SMALL_GROUP):
        i = rows[rows + lag < end[rows]]
        j = i + lag
        fit = (node[i] != node[j]) & (9 * np.minimum(n[i] - at[i], n[j] - at[j]) >= 4 * (n[i] + n[j]))
        i, j = i[fit], j[fit]
        i, j = np.where(words[i] <= words[j], i, j), np.where(words[i] <= words[j], j, i)
        for w in np.unique(words[i]).tolist():
            for v in (w, 2 * w):
                p = np.flatnonzero((words[i] == w) & (words[j] == v))
                for few in np.array_split(p, len(p) * v // (1 << 20) + 1):
                    x, y = (flat[offsets[r[few]][:, None] + np.arange(k)] for r, k in ((i, w), (j, v)))
                    unlike = x ^ (_folded(y) if v > w else y)
                    near = 9 * np.bitwise_count(unlike).sum(axis=1, dtype=np.int64) <= n[i[few]] + n[j[few]]
                    left.append(i[few][near])
                    right.append(j[few][near])
    none = np.zeros(0, np.int64)
    return _pairs_of(node, (np.concatenate([none, *left]), np.concatenate([none, *right])))


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b): pairs that connect, in each group of ``_grouped``, the sets that may be alike."""
    give_back()
    for columns, edges in _whole(batches):
        yield _near_in_small(columns, edges)
        for k in np.flatnonzero(np.diff(edges) > SMALL_GROUP):
            group = {c: v.slice(edges[k], edges[k + 1] - edges[k]) for c, v in columns.items()}
            n, at, node = (group[c].to_numpy() for c in ("n", "at", "node"))
            sketches, rest = _Sketches(_words(group["sketch"]), n), n - at

            def near(i, others):
                room = 9 * np.minimum(rest[i], rest[others]) >= 4 * (n[i] + n[others])
                room[room] = sketches.near(i, others[room])
                return room

            yield _pairs_of(node, _spanning(node, near))


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b): pairs of similarity 0.8 or more that connect, in each group, all that have it."""
    give_back()
    for columns, edges in _whole(batches):
        for first, last in zip(edges, edges[1:]):
            node = columns["node"].slice(first, last - first).to_numpy()
            hashes = _words(columns["hashes"].slice(first, last - first))
            n = np.array([len(h) for h in hashes])
            sketches = _Sketches([_sketch(h) for h in hashes], n)

            def near(i, others):
                alike = 9 * np.minimum(n[i], n[others]) >= 4 * (n[i] + n[others])
                alike[alike] = sketches.near(i, others[alike])
                whole = others[alike]
                if len(whole):
                    flat = np.concatenate([hashes[k] for k in whole])
                    place = np.minimum(np.searchsorted(hashes[i], flat), n[i] - 1)
                    both = np.add.reduceat((hashes[i][place] == flat).astype(np.int64), np.cumsum(n[whole]) - n[whole])
                    alike[alike] = 9 * both >= 4 * (n[i] + n[whole])
                return alike

            yield _pairs_of(node, _spanning(node, near))


def simhash_pairs(prints: DataFrame, max_diff: int = 4) -> DataFrame:
    """(a, b): pairs of sets that SimHash takes for near copies.

    Of the sets with one fingerprint, each is paired with the least; linked fingerprints pair
    their least sets.  ``prints`` has (node, fp).
    """
    sets = stored(prints.where("node <> 0").select("node", "fp").distinct(), "overlap-fp")
    reps = stored(sets.groupBy("fp").agg(F.min("node").alias("rep")), "overlap-fp-reps")
    same = sets.join(reps, "fp").where("node <> rep").select(F.col("rep").alias("x"), F.col("node").alias("y"))
    near = (
        links(reps.select("fp"), max_diff)
        .join(reps.toDF("a", "x"), "a")
        .join(reps.toDF("b", "y"), "b")
        .select("x", "y")
    )
    return same.unionByName(near).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).where("a < b").distinct()


def near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5
) -> DataFrame:
    """(doc_id, component_id): one row per row of ``docs``.

    ``component_id`` is the smallest doc_id reachable over pairs of texts whose sets of
    ``width``-word shingles have a Jaccard similarity of 0.8 or more.  Null and wordless
    texts count as equal.  Null ids are never the smallest; repeated rows stay repeated.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    texts = texts.select("doc_id", F.xxhash64("doc_id", "text").alias("pick"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        for batch in small_slices(batches, 2):
            names, fps, sizes, sketches = [], [], [], []
            for t in batch.column(2).to_pylist():
                h = shingle_hashes(t, width)
                own = np.unique(h)
                names.append(_name(own))
                fps.append(fingerprint_of(h))
                sizes.append(len(own))
                sketches.append(_sketch(own).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), _longs(names), _longs(fps), pa.array(sizes, pa.int64()), pa.array(sketches, pa.binary())],
                ["doc_id", "pick", "node", "fp", "n", "sketch"],
            )

    prints = stored(
        texts.mapInArrow(run, f"doc_id {field(texts, 'doc_id')}, pick bigint, node bigint, fp bigint, n bigint, sketch binary"),
        "overlap-prints",
    )
    nodes = stored(
        prints.groupBy("node").agg(
            F.min("doc_id").alias("rep"), F.min("pick").alias("pick"), F.max("n").alias("n"), F.max("sketch").alias("sketch")
        ),
        "overlap-nodes",
    )
    rare = _first_shingles(texts, width).repartition("token").sortWithinPartitions("token")
    alike = simhash_pairs(prints).select(F.xxhash64("a", "b").alias("token"), F.explode(F.array("a", "b")).alias("node"))
    # A link of SimHash is a group of two, whose sketches are small enough for any task.
    linked = alike.select("token", "node", F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("at"))
    shared = stored(rare.mapInArrow(_with_room, rare.schema).unionByName(linked), "overlap-shared")
    drawn = shared.drop("n").join(nodes.select("node", "n", "sketch"), "node")
    # A sketch has less than two bits for each member, but eight bytes at least.
    sizes = shared.select("token", (F.col("n") / 4 + 48).alias("size"))
    may = _grouped(drawn, sizes, "token").mapInArrow(_candidates, "a bigint, b bigint")
    parts = connected(may).select("node", F.col("root").alias("part"))
    keys = stored(nodes.select("node", "pick", "n").join(parts, "node"), "overlap-keys")
    sizes = keys.select("part", (8 * F.col("n") + 40).alias("size"))
    same = _grouped(_sets(keys, texts, width), sizes, "part").mapInArrow(_compared, "a bigint, b bigint")
    roots = connected(same)
    rooted = stored(
        nodes.join(roots, "node", "left").select("node", "rep", F.coalesce("root", "node").alias("root")),
        "overlap-rooted",
    )
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = rooted.join(least, "root").select("node", "component_id")
    return prints.join(named, "node").select("doc_id", "component_id")
