"""From documents to packed training sequences: stages that each read what the one before wrote.

Each stage but the last returns the columns of ``documents``: rejected texts go, one document of each SimHash group stays, personal
data is masked, sources are repeated to their share, and what is left is packed.

Nulls, empty and very long texts, repeated rows and ids, and ties have the results that the operators' docstrings state: a null
or empty text is scored, groups with other empty texts, and is packed as its end token; rows without doc_id are documents like
any other; of repeated rows one stays; ties go to the least doc_id. Further columns of ``documents`` are carried to the last stage,
also under names that an operator uses for itself. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.llm import mixing, packing, pii, quality, simhash
from lakestrata.llm.common import Work


def accept(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.kept(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redacted(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    packed = packing.pack(docs, value=F.struct(F.crc32("ids").alias("crc32"), F.col("ids")))
    return packed.select("doc_id", "piece", "start", "length", F.col("ids.crc32").alias("ids_crc32"), "sequence_id", "offset", "ids.ids")


STAGES = [
    ("quality classifier", accept),
    ("SimHash near-dedup", deduplicate),
    ("PII", redact),
    ("mixing sources to target weights", mix),
    ("best-fit packing", pack),
]

#: A trained classifier, a tokenizer and 64-bit hash fingerprints are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet and read again by the next."""
    work = Work(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = work.store(stage(spark, docs, sf_dir))
    return docs
