"""A training corpus from raw documents: five stages, each over all its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefold.llm import decontaminate, language, overlap, packing, secrets
from tidefold.llm.common import stored


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned stay, with the language found as ``lang``.

    Rejected are texts that are null, have no letters, or are mostly in none of the
    languages.
    """
    found = docs.withColumn("lang", language.language_of(F.col("text"), language.train(docs)))
    return found.where(F.col("lang") != language.UNKNOWN).select(*docs.columns)


def _keyed(docs: DataFrame) -> DataFrame:
    """(row, text, key): whole rows beside a key of id and text, rows without an id last.

    The row is one struct, so no column of ``docs`` can clash with another name.
    """
    key = F.struct(
        F.col("row.doc_id").isNull().alias("nameless"),
        F.col("row.doc_id").alias("doc_id"),
        F.xxhash64("row.text").alias("text"),
    )
    rows = docs.select(F.struct("*").alias("row"))
    return rows.select("row", F.col("row.text").alias("text"), key.alias("key"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the smallest id.

    Near duplicates have 0.8 or more of their five-word shingles in common.  SimHash
    fingerprints of these shingles name the candidates, each is compared whole, and a search
    by rare shingles adds those whose fingerprints are further apart.  Rows are told
    apart by id and text: of rows of one id with texts that are not near each other, each
    stays.  Rows without an id come after all others, and among rows of one id the smaller
    hash of the text comes first; of rows alike in both, the least in all columns stays.
    """
    keyed = _keyed(docs)
    groups = overlap.near_copies(keyed, id_col="key")
    counted = groups.groupBy(F.col("doc_id").alias("key"), "component_id").agg(F.count(F.lit(1)).alias("n"))
    # Keys only, written out: where they are few, which Spark then knows, no text is moved.
    odd = stored(counted.where("n > 1 or key <> component_id"), "near-copies")
    alone = keyed.join(odd.select("key"), "key", "left_anti").select("row")
    copies = keyed.join(odd.where("key = component_id").select("key"), "key", "left_semi")
    least = copies.groupBy("key").agg(F.min("row").alias("row")).select("row")
    return alone.unionByName(least).select("row.*")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of ``benchmark`` go; rows of one id are judged apart."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    keyed = _keyed(docs)
    hits = decontaminate.overlaps(keyed, items, id_col="key")
    leaked = stored(hits.select(F.col("doc_id").alias("key")).distinct(), "leaks")
    return keyed.join(leaked, "key", "left_anti").select("row.*")


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are cut out of the texts and ``n_chars`` follows; every document stays."""
    clean = secrets.redact(docs.select(F.struct("*").alias("row"), "text"))
    fresh = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        fresh["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return clean.select(*[fresh.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with token ids, each with its sequence and its place there."""
    return packing.pack_documents(docs.select("doc_id", "text"))


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup, verified", near_dedup),
    ("benchmark decontamination", decontaminated),
    ("secret scans", without_secrets),
    ("best-fit packing", packed_sequences),
]

#: Language identification and token ids are beyond SQL; tests/llm/test_pipeline.py compares
#: each stage with a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
