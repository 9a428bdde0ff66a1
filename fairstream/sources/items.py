"""Item streams (one bigint per row) derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairstream.sources.tables import read_table


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``item bigint`` = ``events.user_id`` (a nearly flat distribution)."""
    return read_table(spark, sf_dir, "events").select(F.col("user_id").cast("bigint").alias("item"))


def skewed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``item bigint`` = ``1000 div (1 + l_partkey % 1000)`` over ``lineitem``:
    item 1 holds about half of the rows, then 2, 3, ... with falling counts."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(F.expr("1000 div (1 + l_partkey % 1000)").cast("bigint").alias("item"))


def wide_items(spark: SparkSession, sf_dir: str, factor: int) -> DataFrame:
    """``item bigint`` = ``(l_partkey % 1000 - 500) * factor``: 64-bit ids of both signs."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(((F.col("l_partkey") % 1000 - 500).cast("bigint") * factor).alias("item"))


def parse_items(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """Text lines, one integer each, to ``item bigint``; a malformed line fails
    the job (ANSI cast), as the reference's parse does."""
    return lines.select(F.trim(F.col(line_col)).cast("bigint").alias("item"))
