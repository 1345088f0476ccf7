"""Keyed state of many tables, in pieces by table and key bucket, compacted by levels.

``loads``   snapshots, one file for each split of a dump that has been read whole
``pieces``  the fold of each batch, a folder for each table and bucket it touches
``runs``    merged pieces, a folder for each merge, table and bucket
``manifest`` what each merge replaced: one file a merge, written after its runs

A bucket of a table is what its last manifest row names, and all pieces since.  Pieces of a
batch that runs again are the same, and a piece that is read twice changes nothing.  When a
bucket has gathered ``fan`` pieces they are merged into a run of the first level, ``fan``
runs of a level into one of the next; other buckets are left alone.  So a bucket is read
from a bounded number of files, and a row is written again once a level.
"""

from __future__ import annotations

import re
import time
from collections import defaultdict
from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefold.model import SEQ, Followed
from tidefold.operators import tables
from tidefold.sinks import folders

#: Batch ids of what does not come from the stream, in the order it is folded in.
SNAPSHOT_BATCH, CATCHUP_BATCH = -2, -1
NOTHING = -3

BOUNDARY = "struct<seq: struct<file_no: bigint, logfile: string, logpos: bigint, row_idx: int>, op: string>"
STATE = (
    f"key array<string>, width int, boundary {BOUNDARY}, "
    "latest struct<seq: struct<file_no: bigint, logfile: string, logpos: bigint, row_idx: int>, vals: array<string>>"
)
MANIFEST = (
    "tbl string, bucket int, version bigint, through bigint, "
    "runs array<struct<level: int, folder: string>>, replaced array<string>, at double"
)
PLACE = re.compile(r"/batch_id=(-?\d+)/tbl=([^/]*)/bucket=(\d+)/")


@dataclass(frozen=True)
class Bucket:
    """What one bucket of a table is made of, by its last manifest row."""

    through: int = NOTHING
    version: int = 0
    runs: tuple[tuple[int, str], ...] = ()


@dataclass(frozen=True)
class TablesStore:
    """``buckets`` for each table is fixed when the store is first written; choose it so that
    one bucket of the largest table fits a task."""

    path: str
    buckets: int = 8
    fan: int = 4

    def write(self, changes: DataFrame, batch_id: int) -> None:
        """Fold one batch of all tables into its own folder, in one job.

        Rows of a table and bucket are brought together, and split where they are many.
        """
        state = tables.fold_tables(changes, self.buckets).hint("rebalance", "tbl", "bucket")
        (
            state.write.mode("overwrite")
            # What does not come from the stream may come again, for other tables.
            .option("partitionOverwriteMode", "dynamic" if batch_id < 0 else "static")
            .partitionBy("tbl", "bucket")
            .parquet(f"{self.path}/pieces/batch_id={batch_id}")
        )

    def __call__(self, changes: DataFrame, batch_id: int) -> None:
        self.write(changes, batch_id)

    # Snapshots, split by split.

    def _loads(self, spark: SparkSession, table: str) -> str:
        return f"{self.path}/loads/{folders.named(spark, 'tbl', table)}"

    def load(self, changes: DataFrame, table: str) -> None:
        """Add snapshot rows, which have a column ``split``; each split is one file.

        Nothing is shuffled, and a task's files stand as soon as it ends, whatever becomes of
        the job: a file is moved into place whole, and a split is all in one task.  Rows that
        are written twice, because a task ran again, change nothing.
        """
        (
            tables.entries(changes, self.buckets, keep=["split"])
            .drop("tbl")
            .write.mode("append")
            .option("mapreduce.fileoutputcommitter.algorithm.version", "2")
            .option("maxRecordsPerFile", "0")
            .partitionBy("split")
            .parquet(self._loads(changes.sparkSession, table))
        )

    def loaded(self, spark: SparkSession, table: str) -> set[str]:
        """Splits of the table's dump that have been read whole."""
        names = folders.children(spark, self._loads(spark, table))
        return {
            n.removeprefix("split=")
            for n in names
            if n.startswith("split=") and folders.children(spark, f"{self._loads(spark, table)}/{n}")
        }

    def snapshots(self, spark: SparkSession, names: Sequence[str]) -> DataFrame:
        """The loaded snapshot rows of some tables as changes again, in one scan."""
        read = spark.read.schema(f"{STATE}, tbl string").parquet(f"{self.path}/loads").where(F.col("tbl").isin(list(names)))
        return read.select("tbl", *[F.col(f"latest.seq.{c}").alias(c) for c in SEQ], F.col("boundary.op").alias("op"), "key", "latest.vals")

    def keep_loads(self, spark: SparkSession, table: str, wanted: set[str]) -> None:
        """Take away splits that are not of the dump that is being loaded."""
        for name in self.loaded(spark, table) - wanted:
            folders.delete(spark, f"{self._loads(spark, table)}/split={name}")

    # Reading.

    def _manifest(self, spark: SparkSession) -> dict[tuple[str, int], Bucket]:
        """The last row of each table and bucket; both are few."""
        try:
            rows = spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest")
        except AnalysisException:
            return {}  # never merged
        last = rows.groupBy("tbl", "bucket").agg(F.max_by(F.struct("version", "through", "runs"), "version").alias("m"))
        return {
            (r["tbl"], r["bucket"]): Bucket(
                r["m"]["through"], r["m"]["version"], tuple((x["level"], x["folder"]) for x in r["m"]["runs"])
            )
            for r in last.collect()
        }

    def state(self, spark: SparkSession, table: str, through: int | None = None) -> DataFrame:
        """Folded state of one table, deleted keys included; ``through`` leaves later batches
        out, if they have not been merged yet."""
        known = {b: m for (t, b), m in self._manifest(spark).items() if t == table}
        return tables.combined(self._parts(spark, table, known, through), among=("bucket",))

    def current(self, spark: SparkSession, followed: Followed) -> DataFrame:
        """The documents of a table that exist now, in columns of their types."""
        known = {b: m for (t, b), m in self._manifest(spark).items() if t == followed.table}
        parts = self._parts(spark, followed.table, known, None)
        return tables.documents(parts, followed.columns).drop("present")

    def _parts(
        self,
        spark: SparkSession,
        table: str,
        known: Mapping[int, Bucket],
        through: int | None,
        some: Sequence[int] | None = None,
    ) -> DataFrame:
        """Entries of one table: runs, snapshot files, and the pieces since, not yet folded;
        ``some`` names the buckets that are wanted."""
        schema = f"{STATE}, bucket int"
        wanted = range(self.buckets) if some is None else sorted(some)
        out = spark.createDataFrame([], schema)
        runs = [folder for b, m in known.items() if b in wanted for _, folder in m.runs]
        if runs:
            # A run holds one bucket, named by its folder.
            read = spark.read.schema(STATE).option("basePath", f"{self.path}/runs").parquet(*[f"{self.path}/runs/{r}" for r in runs])
            out = out.unionByName(_shaped(read))
        merged = {b: m.through for b, m in known.items()}
        left = [b for b in wanted if merged.get(b, NOTHING) < SNAPSHOT_BATCH]
        if left and folders.children(spark, self._loads(spark, table)):
            read = spark.read.schema(schema).parquet(self._loads(spark, table))
            out = out.unionByName(_shaped(read.where(F.col("bucket").isin(left))))
        pieces = self._pieces(spark, table, merged, through, wanted)
        if pieces:
            read = spark.read.schema(STATE).option("basePath", f"{self.path}/pieces").parquet(*pieces)
            out = out.unionByName(_shaped(read))
        return out

    def _pieces(
        self,
        spark: SparkSession,
        table: str,
        merged: Mapping[int, int],
        through: int | None,
        wanted: Collection[int],
    ) -> list[str]:
        """Folders of the table's pieces that no run holds yet: a listing, no file is opened.

        Batches that all buckets have merged are passed over, and go when they are retired.
        """
        at, own = f"{self.path}/pieces", folders.named(spark, "tbl", table)
        lowest = min((merged.get(b, NOTHING) for b in wanted), default=NOTHING)
        found = []
        for name in folders.children(spark, at):
            batch = int(name.removeprefix("batch_id="))
            if batch <= lowest or (through is not None and batch > through):
                continue
            for part in folders.children(spark, f"{at}/{name}/{own}"):
                bucket = int(part.removeprefix("bucket="))
                if bucket in wanted and batch > merged.get(bucket, NOTHING):
                    found.append(f"{at}/{name}/{own}/{part}")
        return found

    def boundaries(
        self, spark: SparkSession, places: Sequence[tuple[str, int]], through: int
    ) -> DataFrame:
        """(tbl, key, boundary): the last insert or delete of the keys in some buckets, as it
        was after a batch.  Other buckets, and documents, are not read."""
        out = spark.createDataFrame([], "tbl string, key array<string>, boundary " + BOUNDARY)
        manifest = self._manifest(spark)
        for table in sorted({t for t, _ in places}):
            own = [b for t, b in places if t == table]
            known = {b: m for (t, b), m in manifest.items() if t == table}
            parts = self._parts(spark, table, known, through, own)
            out = out.unionByName(parts.select(F.lit(table).alias("tbl"), "key", "boundary"))
        return out.groupBy("tbl", "key").agg(F.max("boundary").alias("boundary"))

    # Merging.

    def touched(self, spark: SparkSession) -> dict[tuple[str, int], list[int]]:
        """Batches that have a piece, by table and bucket; read from folder names only."""
        at = f"{self.path}/pieces"
        if not folders.children(spark, at):
            return {}
        names = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(at)
        found: dict[tuple[str, int], set[int]] = defaultdict(set)
        place = F.regexp_extract("path", PLACE.pattern, 0)
        for r in names.select(place.alias("p")).distinct().collect():
            hit = PLACE.search(r["p"])
            if hit:
                found[folders.value(spark, hit[2]), int(hit[3])].add(int(hit[1]))
        return {k: sorted(v) for k, v in found.items()}

    def compact(self, spark: SparkSession, through: int, all_of: bool = False) -> list[tuple[str, int]]:
        """Merge the buckets that have ``fan`` pieces up to a batch (or any, with ``all_of``).

        Returns the buckets that were merged.  One job merges all of them, a bucket being one
        task; what it made is announced last, so a merge that is cut short leaves no trace.
        """
        known, plans = self._manifest(spark), {}
        touched = self.touched(spark)
        for place in set(touched) | set(known):
            have = known.get(place, Bucket())
            fresh = [b for b in touched.get(place, []) if have.through < b <= through]
            if not fresh or (len(fresh) < self.fan and not all_of):
                continue
            plans[place] = (have, fresh, *_cascade(have.runs, self.fan))
        if not plans:
            return []
        version = time.time_ns()
        parts = None
        for table in sorted({t for t, _ in plans}):
            own = {b: p for (t, b), p in plans.items() if t == table}
            runs = {b: Bucket(p[0].through, 0, p[3]) for b, p in own.items()}
            part = self._parts(spark, table, runs, through, sorted(own))
            part = part.withColumn("tbl", F.lit(table))
            parts = part if parts is None else parts.unionByName(part)
        # Dealt by bucket before they are folded, so a bucket is folded where it lands.
        dealt = parts.repartition("tbl", "bucket")
        merged = tables.combined(dealt).withColumn("version", F.lit(version))
        merged.write.mode("append").partitionBy("version", "tbl", "bucket").parquet(f"{self.path}/runs")
        rows = []
        for (t, b), (have, fresh, level, taken) in plans.items():
            own = f"{folders.named(spark, 'tbl', t)}/bucket={b}"
            folder = f"version={version}/{own}"
            kept = [(n, f) for n, f in have.runs if (n, f) not in taken]
            gone = [f"runs/{f}" for _, f in taken] + [f"pieces/batch_id={x}/{own}" for x in fresh]
            rows.append((t, b, version, max(fresh[-1], have.through), [(level, folder), *kept], gone, time.time()))
        spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")
        return sorted(plans)

    def retire(self, spark: SparkSession, older_than: float = 3600.0) -> int:
        """Take away what was replaced more than ``older_than`` seconds ago; returns how much.

        Readers that list the store before a merge still find its files for so long.
        """
        try:
            rows = spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest")
        except AnalysisException:
            return 0
        old = rows.where(F.col("at") <= time.time() - older_than).select(F.explode("replaced").alias("f")).distinct()
        n = 0
        for r in old.collect():
            if folders.exists(spark, f"{self.path}/{r['f']}"):
                folders.delete(spark, f"{self.path}/{r['f']}")
                n += 1
        for batch in folders.children(spark, f"{self.path}/pieces"):
            tables_left = folders.children(spark, f"{self.path}/pieces/{batch}")
            if not any(folders.children(spark, f"{self.path}/pieces/{batch}/{t}") for t in tables_left):
                folders.delete(spark, f"{self.path}/pieces/{batch}")
        return n


def _shaped(read: DataFrame) -> DataFrame:
    return read.select("key", "width", "boundary", "latest", F.col("bucket").cast("int").alias("bucket"))


def _cascade(runs: Sequence[tuple[int, str]], fan: int) -> tuple[int, tuple[tuple[int, str], ...]]:
    """The level of a new run, and the runs that go into it: where it would be the ``fan``-th
    of a level, that level is merged with it into the next."""
    level, taken = 1, []
    while True:
        same = [r for r in runs if r[0] == level]
        if len(same) + 1 < fan:
            return level, tuple(taken)
        taken += same
        level += 1
