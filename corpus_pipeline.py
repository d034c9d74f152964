"""From raw documents to packed token sequences: harmful texts, boilerplate lines, near copies and secrets are removed first.

Each stage reads what the one before it wrote, so a lost executor costs one stage at most. All stages but the last return the
columns of ``documents``; where a stage changes texts, ``n_chars`` follows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rtmart.llm import line_dedup, packing, secret_scan, simhash_dedup, toxicity
from rtmart.llm.shared import shared_folder


def _counted(docs: DataFrame) -> DataFrame:
    length = F.char_length("text").cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None
    return docs if length is None else docs.withColumn("n_chars", length)


def harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score rejects go."""
    return toxicity.reject(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def own_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many sites carry stay at their first place only."""
    return _counted(line_dedup.dedup(docs).select(*docs.columns))


def unlike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every class of near copies the document with the smallest id stays."""
    return simhash_dedup.keep_one(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are masked."""
    return _counted(secret_scan.redact(docs))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every kept document's tokens, piece by piece, in sequences of at most 2048."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", harmless),
    ("line dedup", own_lines),
    ("simhash near-dedup", unlike),
    ("secret scan", without_secrets),
    ("packing", sequences),
]

ORACLE_SQL = None  # a trained score, fingerprints and tokens are beyond SQL; tests compare with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = shared_folder(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
