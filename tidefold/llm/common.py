"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefold.session import scratch_dir

#: Bytes between words: blank and the controls from tab to carriage return.
BLANKS = r"[\x20\x09-\x0D]+"

#: Texts are handed to Python in pieces of about this many bytes.
SLICE_BYTES = 8 << 20


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write once to the shared folder and read back: a fixed table with a short lineage."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Return to the system what earlier tasks of this Python worker have freed.

    A worker serves tasks of all stages, and its allocators would else keep the most that
    any of them took.  Called where a task begins.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_slices(
    batches: Iterator[pa.RecordBatch], text: int, limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the column at ``text`` holds about ``limit`` bytes; rows stay whole."""
    for batch in batches:
        start = size = 0
        lengths = pa.compute.binary_length(batch.column(text)).fill_null(0).to_pylist()
        for i, n in enumerate(lengths):
            if size and size + n > limit:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < batch.num_rows:
            yield batch.slice(start)


def field(df: DataFrame, column: str) -> str:
    """A column's type as DDL text."""
    return df.schema[column].dataType.simpleString()


def words_of(text):
    """The words of a text column, split at BLANKS; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda w: w != "")
