"""The corpus pipeline: stages over ``documents``, each written as Parquet and
reread as the next one's input.

Every stage but the last returns the five columns of ``documents`` (extra input
columns are left out, so no name can clash). Null and empty texts fail the
quality rules; the later stages keep them, and the near-duplicate stage treats
them as one group. Repeated rows are one group too. An empty table gives an
empty result at every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairstream.llm import decontam, pieces, quality, secret_scan, simhash
from fairstream.llm.shared import materialize
from fairstream.sources.tables import read_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a quality rule go."""
    return quality.keep_good(docs.select(COLUMNS))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: the one with the smallest doc_id."""
    return simhash.keep_one(docs.select(COLUMNS)).select(COLUMNS)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    found = decontam.scan(docs.select(COLUMNS), read_table(spark, sf_dir, "benchmark"))
    return decontam.remove(found).select(COLUMNS)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts; every document stays."""
    masked = secret_scan.redact(docs.select(COLUMNS))
    chars = F.when(F.col("n_masked") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return masked.withColumn("n_chars", chars).select(COLUMNS)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts become piece ids, with a check that they decode to the text."""
    return pieces.encode(docs.select(COLUMNS)).select(
        "doc_id", "lang", "source", "n_chars", "n_pieces", "ids_sha256", "lossless", "ids")


STAGES = [
    ("quality rules", quality_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("secret scans", secret_stage),
    ("SentencePiece encoding", encoding_stage),
]

#: SQL cannot draw the dropout's segmentations; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage to ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
