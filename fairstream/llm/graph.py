"""Connected components and joins that survive hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairstream.llm.shared import materialize

#: A key with more than one in so many rows of a join's large side is hot.
HOT_SHARE = 1000


def join_counted(large: DataFrame, small: DataFrame, key: str, rows: int, share: int = HOT_SHARE) -> DataFrame:
    """``large`` join ``small`` on ``key``; ``small`` has one row per key with its
    number of rows in ``large`` (column ``n``), ``rows`` is their sum. Keys with
    more than one in ``share`` rows are fewer than ``share``, so they are broadcast;
    only the others meet in a shuffle."""
    hot = F.broadcast(small.filter(F.col("n") * share > rows).drop("n"))
    cold = small.filter(F.col("n") * share <= rows).drop("n")
    return large.join(hot, key).unionByName(large.join(hot.select(key), key, "left_anti").join(cold, key))


def components(edges: DataFrame, share: int = HOT_SHARE) -> DataFrame:
    """(node, root) of every node with an edge (src, dst): alternating large and
    small stars until nothing changes, each round a table in the shared folder.
    The root is the smallest node of the component; a hot centre's edges stay
    where they are, its minimum is broadcast."""
    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first())

    now = materialize(edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
                      .filter("src <> dst").distinct(), "edges")
    before = state(now)
    while before[0]:
        both = now.union(now.select("dst", "src"))
        low = both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("low"), F.count("*").alias("n"))
        large = (join_counted(both, low, "src", 2 * before[0], share).filter("dst > src")
                 .select(F.col("dst").alias("src"), F.col("low").alias("dst")).filter("src <> dst").distinct())
        large = materialize(large, "stars")
        least = large.groupBy("src").agg(F.min("dst").alias("low"), F.count("*").alias("n"))
        small = join_counted(large, least, "src", large.count(), share).select(
            F.explode(F.array(F.struct("src", F.col("low").alias("dst")),
                              F.struct(F.col("dst").alias("src"), F.col("low").alias("dst")))).alias("e"))
        now = materialize(small.select("e.src", "e.dst").filter("src <> dst").distinct(), "edges")
        after = state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("src").alias("node"), F.col("dst").alias("root")).union(
        now.select("dst", "dst").distinct())
