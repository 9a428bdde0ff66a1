"""Sharding by a two-pass external shuffle, in DataFrame functions only.

Pass 1 scatters the records into memory-sized buckets with seeded hashes: the
shard comes from rendezvous hashing of the key, a second hash of the whole record
(and its copy number, if it is repeated many times) spreads a shard over as many
buckets as the bytes of its records ask for, so neither a hot key nor a repeated
record fills one bucket. The records go whole, in one exchange. Pass 2 takes
each bucket whole, puts it in a fixed order, shuffles it (Fisher-Yates,
``functions.shuffle``) and writes it. A bucket is one Spark partition, addressed
by its number, so its seed and with it the result do not depend on the cluster.

The law is ``key``: key and shard count alone decide, and a further shard
takes rows only into itself. Defined results: rows with one key (a null key
too) share a shard; repeated rows keep one slot each; an empty table gives no
rows; input columns with the name of a result are replaced; columns must be of
types that Spark can group by.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairstream.llm.shared import Renamed, column, drop_clashing, free_name
from fairstream.session import scratch_path

RESULTS = ["shard", "grown_shard", "bucket", "slot", "law"]
#: Copies of one record that are laid out from one row.
COPY_BLOCK = 1 << 16
#: Copies of one record above this part of a bucket are spread by number.
HOT_SHARE = 8


def _winner(key: str, shards: int, seed: int) -> Column:
    """Rendezvous hashing: every shard bids a hash, the highest bid wins."""
    bids = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.struct(
        F.xxhash64(F.col(key), s, F.lit(seed)).alias("bid"), s.alias("shard")))
    return F.array_max(bids)


def scatter(df: DataFrame, key: str, shards: int, seed: int) -> DataFrame:
    """Pass 1, the law: ``shard`` and ``grown_shard`` (with one more shard)."""
    best = drop_clashing(df, RESULTS).withColumn("_best", _winner(key, shards, seed))
    more = F.xxhash64(F.col(key), F.lit(shards), F.lit(seed))
    return best.select(
        "*", F.col("_best.shard").alias("shard"),
        F.when(more > F.col("_best.bid"), F.lit(shards)).otherwise(F.col("_best.shard")).alias("grown_shard"),
    ).drop("_best")


def number_copies(records: DataFrame) -> DataFrame:
    """``records`` plus ``_copy``, which numbers the copies of equal records from 0.

    Equal records are counted (merged map-side) and laid out again in blocks, so
    a record that fills a third of the table is no hot group on either side."""
    n = F.col("_n")
    blocks = records.groupBy(*records.columns).agg(F.count("*").alias("_n")).select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / COPY_BLOCK))).alias("_block"))
    first = F.col("_block") * COPY_BLOCK
    return blocks.select(
        *records.columns, F.explode(F.sequence(first, F.least(first + COPY_BLOCK, n) - 1)).alias("_copy"))


def _bytes(df: DataFrame, record_bytes: int) -> Column:
    """The size of a record: ``record_bytes`` and what its columns of no fixed width hold."""
    size = F.lit(record_bytes).cast("long")
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size += F.coalesce(F.octet_length(f.name), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.StructType)):
            size += F.coalesce(F.octet_length(F.to_json(F.struct(f.name))), F.lit(0))
    return size


def shuffle_shards(df: DataFrame, key: str, shards: int = 40, seed: int = 17,
                   record_bytes: int = 64, bucket_bytes: int = 1 << 24) -> DataFrame:
    """``df``, written in shards and read back, plus ``shard``, ``grown_shard``,
    ``bucket``, ``slot`` and ``law``.

    ``record_bytes`` is what a record takes beside its texts; the summed bytes of a
    shard and ``bucket_bytes`` set the number of its buckets, never the shard of a row.
    """
    inside = Renamed(df)
    scattered = scatter(inside.df, inside.of(key), shards, seed)
    size = _bytes(scattered, record_bytes)
    sizes = {r["shard"]: r["n"] for r in                             # at most ``shards`` rows
             scattered.groupBy("shard").agg(F.sum(size).alias("n")).collect()}
    parts = [max(1, math.ceil(sizes.get(s, 0) / bucket_bytes)) for s in range(shards)]
    offsets = [sum(parts[:s]) for s in range(shards)]

    def of_shard(values: list[int]) -> Column:
        return F.get(F.array(*map(F.lit, values)), F.col("shard"))

    # Records whose copies take a share of a bucket are laid out by number; an equal
    # hash of another record only sends it the same way.
    mark = F.xxhash64(F.lit(seed + 2), *scattered.columns)
    hot = scattered.groupBy(mark.alias("_mark")).agg(F.sum(size).alias("_n"), F.count("*").alias("_c")).filter(
        (F.col("_c") > 1) & (F.col("_n") > bucket_bytes // HOT_SHARE)).select("_mark")
    marked = scattered.withColumn("_mark", mark)
    copies = number_copies(marked.join(F.broadcast(hot), "_mark", "left_semi").drop("_mark"))
    single = marked.join(F.broadcast(hot), "_mark", "left_anti").drop("_mark").withColumn(
        "_copy", F.lit(0).cast("long"))
    mixed = F.xxhash64(F.lit(seed + 1), *scattered.columns, "_copy")
    bucket = (of_shard(offsets) + F.pmod(mixed, of_shard(parts))).cast("int")
    records = single.unionByName(copies).withColumn("bucket", bucket).drop("_copy")
    columns = [c for c in records.columns if c not in ("shard", "bucket")]
    taken = {r.lower() for r in RESULTS}
    named = [column(f"c{i}").alias(n) for i, n in enumerate(inside.names) if n.lower() not in taken]
    buckets = (
        records.repartitionById(sum(parts), F.col("bucket"))
        .groupBy("bucket", "shard")
        .agg(F.shuffle(F.sort_array(F.collect_list(F.struct(*columns))), seed).alias("_rows"))
        .select("shard", "bucket", F.posexplode("_rows").alias("slot", "_row"))
        .select("_row.*", "bucket", F.col("slot").cast("long").alias("slot"), "shard")
        .select(*named, "grown_shard", "bucket", "slot", "shard"))
    path = scratch_path(df.sparkSession, "llm-shards")
    write_shards(buckets, path)
    placed = df.sparkSession.read.schema(buckets.schema).parquet(path)
    counts = placed.groupBy("bucket", "shard").agg(F.count("*").alias("_n"))
    earlier = free_name("_before", placed.columns)
    before = counts.select("bucket", (F.sum("_n").over(_earlier()) - F.col("_n")).alias(earlier))
    kept = [column(n) for n in inside.names if n.lower() not in taken]
    return placed.join(F.broadcast(before), "bucket").select(
        *kept, "grown_shard", "shard", "bucket", (F.col(earlier) + F.col("slot")).alias("slot"),
        F.lit("key").alias("law"))


def _earlier():
    from pyspark.sql import Window
    return Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)


def write_shards(buckets: DataFrame, path: str) -> None:
    """Write one folder per shard with one file per bucket, in slot order; ``slot``
    counts within the bucket."""
    buckets.write.partitionBy("shard").parquet(path)
