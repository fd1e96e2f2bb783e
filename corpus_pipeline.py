"""The corpus pipeline: five operators, each working on all that the one before kept.

``STAGES`` are (name, function); a function takes (spark, docs, sf_dir) and
returns the documents it keeps or changes, with the columns of ``documents``.
The last one returns the packed pieces and sequences.  Between stages the documents are
written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import mixing, ngram_join, packing, secret_scan
from plumbline.llm.tables import kept, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    from plumbline.llm import toxicity  # with it comes the ML library, which other queries leave out of the driver

    docs = docs.select(*COLUMNS)
    return toxicity.clean(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies, that with the smallest id.

    Where several texts of a component have that id, or none has an id, the one
    with the smallest hash stays.  Documents without words have no near copies
    and stay.  Of rows that repeat an id and text one stays; rows that have
    neither an id nor words all stay.
    """
    docs = docs.select(*COLUMNS)
    told = ngram_join.rooted(docs)
    name = [F.col("doc_id").isNull().alias("_none"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("_id")]
    key = ["_none", "_id", "text_hash"]
    first = told.where("root is not null").groupBy("root").agg(F.min(F.struct(*name, "text_hash")).alias("r")).select("r.*", F.lit(False).alias("_bare"))
    bare = told.where("root is null").select(*name, "text_hash", F.lit(True).alias("_bare")).distinct()
    stay = docs.select(*COLUMNS, *name, F.xxhash64("text").alias("text_hash")).join(first.unionByName(bare), key)
    once = stay.where("not (_none and _bare)").groupBy(*key).agg(F.min(F.struct(*COLUMNS)).alias("r")).select("r.*")
    return once.unionByName(stay.where("_none and _bare").select(*COLUMNS))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret in their texts masked."""
    return secret_scan.redact(docs.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by their sources' rates, shuffled."""
    return mixing.mix(docs.select(*COLUMNS)).select(*COLUMNS)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, their places in training sequences, and the ids of these."""
    return packing.pack(docs.select("doc_id", "text"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_copies),
    ("secret_scan", mask_secrets),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

#: boosted trees and tokens are beyond SQL; tests hold each stage against a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
