"""Heavy hitters of a stream with bounded state.

Rows are counted within each task first, so an item that fills a third of a batch
costs one row for each Arrow batch. The counts are dealt to buckets by a hash of the
item, and each bucket keeps a Misra-Gries summary as streaming state: at most
``counters`` items with a count each. When more are known, the count of the first
one that has no room is taken off all of them. What was taken off in all is the
error: an item's true count lies between its count and its count plus the error,
and the error is at most 1 / (counters + 1) of the bucket's rows. So every item with
more than N / counters of the stream's N rows is in the summary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from fairstream.session import scratch_path
from fairstream.streaming.batchlog import BatchLog
from fairstream.streaming.stream import StreamJob, _writer, read_items

SUMMARY = "bucket int, items array<bigint>, counts array<bigint>, err bigint, n bigint"


def local_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = pc.value_counts(batch.column("item").drop_null())
        yield pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], names=["item", "cnt"])


def add_counts(items: np.ndarray, counts: np.ndarray, counters: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(items, counts, taken off) of a summary after adding up equal items."""
    names, at = np.unique(items, return_inverse=True)
    total = np.zeros(len(names), np.int64)
    np.add.at(total, at, counts)
    if len(names) <= counters:
        return names, total, 0
    cut = int(np.partition(total, len(names) - counters - 1)[len(names) - counters - 1])
    keep = total > cut
    return names[keep], total[keep] - cut, cut


def hitters_stream(stream: DataFrame, counters: int, buckets: int = 64, out: str | None = None,
                   trigger: str | None = None) -> StreamJob:
    """Keep a summary of ``counters`` items in each of ``buckets`` buckets; each batch
    writes the summaries it changed. Null items are not counted."""
    if counters < 1 or buckets < 1:
        raise ValueError("counters and buckets must be positive")
    spark = stream.sparkSession
    out = out or scratch_path(spark, "hitters")

    def update(key, frames, state: GroupState):
        import pandas as pd
        items, counts, err, n = state.get if state.exists else ([], [], 0, 0)
        items, counts = np.array(items, np.int64), np.array(counts, np.int64)
        for frame in frames:
            more = frame["cnt"].to_numpy(np.int64)
            items, counts, cut = add_counts(np.r_[items, frame["item"].to_numpy(np.int64)], np.r_[counts, more], counters)
            err, n = err + cut, n + int(more.sum())
        state.update((items.tolist(), counts.tolist(), err, n))
        yield pd.DataFrame({"bucket": [key[0]], "items": [items.tolist()], "counts": [counts.tolist()],
                            "err": [err], "n": [n]})

    counted = read_items(stream).mapInArrow(local_counts, "item bigint, cnt bigint")
    dealt = counted.withColumn("bucket", F.pmod(F.xxhash64("item"), F.lit(buckets)).cast("int"))
    kept = SUMMARY.split(", ", 1)[1]
    summaries = dealt.groupBy("bucket").applyInPandasWithState(
        update, SUMMARY, kept, "update", GroupStateTimeout.NoTimeout)
    log = summary_log(spark, out)
    return StreamJob(_writer(summaries, out, log.put, trigger, "update").start(), out)


def summary_log(spark: SparkSession, out: str) -> BatchLog:
    """A bucket's newest summary is the one of most rows."""
    def newest(rows: DataFrame) -> DataFrame:
        whole = F.struct("items", "counts", "err", "n")
        return rows.groupBy("bucket").agg(F.max_by(whole, "n").alias("s")).select("bucket", "s.*")
    return BatchLog(spark, f"{out}/summaries", SUMMARY, newest)


def hitters_snapshot(spark: SparkSession, out: str) -> DataFrame:
    """``item, lower, upper, n_items``: the items in the summaries with bounds of
    their counts, and the rows seen so far."""
    rows = summary_log(spark, out).read()
    total = rows.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint")).scalar()
    each = rows.select("err", F.explode(F.arrays_zip("items", "counts")).alias("i"))
    return each.select(F.col("i.items").alias("item"), F.col("i.counts").alias("lower"),
                       (F.col("i.counts") + F.col("err")).alias("upper"), total.alias("n_items"))
