"""Structured Streaming jobs over a stream of items (one ``item bigint`` per row).

Every job writes through ``foreachBatch`` into a folder keyed by the batch id
(overwritten as a whole), so a batch replayed after a failure replaces its own
output instead of adding to it; offsets and operator state live in a checkpoint
folder under the shared ``spark.checkpoint.dir``. The results are batch logs
with compaction (``batchlog``), and a ``*_snapshot`` function reads the
current one back as a batch DataFrame from a bounded number of folders.

- ``running_counts``: exact histogram in the state store (state grows with the
  number of distinct items, like the reference's map).
- ``running_distinct``: distinct items as a grouped aggregate (same state
  size, merged map-side before the shuffle).
- ``sketch_cells_stream``: count-min / count-sketch cells, at most D*W rows
  whatever the stream.
- ``distinct_estimate_stream``: length, HyperLogLog++ distinct count and
  largest item as one running row (state: one sketch).
- ``distinct_sketches``: one mergeable distinct sketch a batch, so that any range
  of batches can be counted.
- ``hitters.hitters_stream``: heavy hitters with count bounds, bounded state.
- ``prefix``: whole micro-batches until at least T items were seen (the batch
  that crosses T counts in full), with one histogram per accepted batch; the
  query stops once that batch has committed.

``state_snapshot`` reads a stateful job's current state directly from its
checkpoint (state data source) instead of from the per-batch outputs.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fairstream.session import scratch_path
from fairstream.streaming.batchlog import EVERY, BatchLog, TieredLog

ITEM_SCHEMA = "item bigint"
COUNTS_SCHEMA = "item bigint, cnt bigint, batch_time timestamp, batch_id int"
# Fixed value: the reference's micro-batch interval.
BATCH_INTERVAL = "100 milliseconds"


# --- sources -------------------------------------------------------------------

def split_copy(df: DataFrame, key: str, parts: int, path: str) -> str:
    """Write ``df`` as ``parts`` files by ranges of ``key`` (``path/part=i``),
    to replay a table as a file stream, one file per micro-batch.

    A replay harness for tests and benchmarks: production streams come from a
    message bus or a landing folder and need no copy.
    """
    if parts <= 0:
        raise ValueError("parts must be positive")
    bounds = df.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    lo, hi = bounds["lo"], bounds["hi"]
    if lo is None:
        raise ValueError("cannot split an empty table")
    part = F.floor((F.col(key) - F.lit(lo)) * parts / F.lit(hi - lo + 1)).cast("int")
    df.withColumn("part", part).repartition("part").write.partitionBy("part").parquet(path)
    _order_by_part(df.sparkSession, path, parts)
    return path


def _order_by_part(spark: SparkSession, path: str, parts: int) -> None:
    """Give the files of part i an older modification time than those of part
    i + 1, so the file source (which takes the oldest files first) replays the
    parts in order however many writers ran at once. Metadata only."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    base = fs.getFileStatus(root).getModificationTime() - 1000 * (parts + 1)
    for i in range(parts):
        d = jvm.org.apache.hadoop.fs.Path(f"{path}/part={i}")
        if not fs.exists(d):
            continue
        for st in fs.listStatus(d):
            name = st.getPath().getName()
            if not name.startswith((".", "_")):
                fs.setTimes(st.getPath(), base + 1000 * i, -1)


def file_stream(spark: SparkSession, path: str, schema: str = ITEM_SCHEMA + ", part int",
                max_files_per_trigger: int | None = 1) -> DataFrame:
    """A streaming DataFrame over parquet files landing in ``path``."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def line_copy(df: DataFrame, column: str, key: str, parts: int, path: str) -> str:
    """``split_copy`` as text files, one line for each value of ``column``."""
    split_copy(df.select(F.col(column).cast("string").alias("value"), key), key, parts, f"{path}-rows")
    rows = df.sparkSession.read.parquet(f"{path}-rows").select("value", "part")
    rows.repartition("part").write.partitionBy("part").text(path)
    _order_by_part(df.sparkSession, path, parts)
    return path


def line_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = 1) -> DataFrame:
    """A streaming DataFrame ``value string`` over text files landing in ``path``,
    one row a line; its offsets are the files, so a restart replays them."""
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.text(path).select("value")


def read_items(stream: DataFrame, item_col: str = "item") -> DataFrame:
    """Normalise any streaming source to ``item bigint`` (a text source's lines
    are trimmed and cast; a malformed line fails the query)."""
    c = F.col(item_col)
    if dict(stream.dtypes).get(item_col) == "string":
        c = F.trim(c)
    return stream.select(c.cast("bigint").alias("item"))


# --- running jobs ----------------------------------------------------------------

@dataclass
class StreamJob:
    query: StreamingQuery
    out: str
    state: dict = field(default_factory=dict)

    def wait(self, timeout: float | None = None) -> "StreamJob":
        """Block until the query ends (an ``availableNow`` run, or a stop rule);
        with ``timeout`` (seconds) stop it and raise if it runs longer."""
        deadline = None if timeout is None else time.monotonic() + timeout
        while self.query.isActive:
            if self.state.get("stop") and self._committed(self.state.get("stop_batch", -1)):
                self.query.stop()            # the batch that met the rule is committed
                break
            if deadline is not None and time.monotonic() > deadline:
                self.query.stop()
                raise TimeoutError("streaming query did not finish in time")
            self.query.awaitTermination(0.1)
        err = self.query.exception()
        if err is not None:
            raise RuntimeError(f"streaming query failed: {err}")
        return self

    def _committed(self, batch_id: int) -> bool:
        """Has ``batch_id`` finished (its progress report is posted after its
        commit)? Stopping only then leaves no half-done batch to replay."""
        last = self.query.lastProgress
        return last is not None and last["batchId"] >= batch_id

    def progress_log(self) -> list[tuple[int, str, int]]:
        """``(batch_id, trigger time, input rows)`` of the recent non-empty
        micro-batches, from the query's progress reports (no Spark job)."""
        return [(p["batchId"], p["timestamp"], p["numInputRows"])
                for p in self.query.recentProgress if p["numInputRows"] > 0]

    def drain(self) -> "StreamJob":
        """For a query on a processing-time trigger: process everything that has
        arrived, then stop the query."""
        if self.query.isActive and not self.state.get("stop"):
            self.query.processAllAvailable()
        self.query.stop()
        return self.wait()


def _writer(df: DataFrame, out: str, fn, trigger: str | None, mode: str = "append"):
    w = df.writeStream.outputMode(mode).foreachBatch(fn) \
        .option("checkpointLocation", f"{out}/_checkpoint")
    if trigger:
        w = w.trigger(processingTime=trigger)
    else:
        w = w.trigger(availableNow=True)
    return w


def running_counts(stream: DataFrame, out: str | None = None,
                   trigger: str | None = None, every: int = EVERY) -> StreamJob:
    """Exact running histogram; each batch writes the items whose count changed,
    and every ``every`` batches are merged (``batchlog``)."""
    spark = stream.sparkSession
    out = out or scratch_path(spark, "running-counts")
    agg = read_items(stream).groupBy("item").agg(F.count(F.lit(1)).alias("cnt"))
    return StreamJob(_writer(agg, out, _counts_log(spark, out, every).put, trigger, "update").start(), out)


def _counts_log(spark: SparkSession, out: str, every: int = EVERY) -> BatchLog:
    """Counts only grow, so the latest value is the largest."""
    return BatchLog(spark, f"{out}/updates", "item bigint, cnt bigint",
                    lambda u: u.groupBy("item").agg(F.max("cnt").alias("cnt")), every)


def counts_snapshot(spark: SparkSession, out: str) -> DataFrame:
    """``item, cnt`` so far."""
    return _counts_log(spark, out).read()


def state_snapshot(spark: SparkSession, out: str) -> DataFrame:
    """The operator state of a stateful job as of its last committed batch,
    read with the state data source (``format("statestore")``): key and value
    fields flattened. For ``running_counts`` that is ``item, count``; it reads
    the current state once instead of folding every batch's update files."""
    st = spark.read.format("statestore").load(f"{out}/_checkpoint")
    return st.select("key.*", "value.*")


def running_distinct(stream: DataFrame, out: str | None = None,
                     trigger: str | None = None, every: int = EVERY) -> StreamJob:
    """Running distinct set; each batch writes the distinct items it contained.

    A grouped aggregate: every task merges its rows per item before the shuffle
    into the state store, so an item that fills a third of a batch costs one row
    per task. (A streaming ``distinct()`` has no such stage and ships every copy
    of that item to one task.) State: one row per distinct item.
    """
    spark = stream.sparkSession
    out = out or scratch_path(spark, "running-distinct")
    seen = read_items(stream).groupBy("item").agg(F.max(F.lit(True)).alias("seen"))
    log = _distinct_log(spark, out, every)

    def fn(batch: DataFrame, batch_id: int) -> None:
        log.put(batch.select("item"), batch_id)

    return StreamJob(_writer(seen, out, fn, trigger, "update").start(), out)


def _distinct_log(spark: SparkSession, out: str, every: int = EVERY) -> BatchLog:
    return BatchLog(spark, f"{out}/seen", "item bigint", DataFrame.distinct, every)


def distinct_snapshot(spark: SparkSession, out: str) -> DataFrame:
    """``item``: every item seen so far, once."""
    return _distinct_log(spark, out).read()


ESTIMATE = "n_items bigint, n_distinct bigint, largest bigint, batch bigint"


def distinct_estimate_stream(stream: DataFrame, rsd: float = 0.01, out: str | None = None,
                             trigger: str | None = None) -> StreamJob:
    """Stream length, approximate distinct count (HyperLogLog++, relative error
    ``rsd``) and largest item, as one running row: the state is one sketch,
    whatever the number of distinct items (the exact set keeps one row per
    item)."""
    spark = stream.sparkSession
    out = out or scratch_path(spark, "distinct-estimate")
    agg = read_items(stream).agg(
        F.count("item").alias("n_items"),
        F.approx_count_distinct("item", rsd).alias("n_distinct"),
        F.max("item").alias("largest"))
    log = _estimate_log(spark, out)

    def fn(batch: DataFrame, batch_id: int) -> None:
        log.put(batch.withColumn("batch", F.lit(batch_id).cast("bigint")), batch_id)

    return StreamJob(_writer(agg, out, fn, trigger, "update").start(), out)


def _estimate_log(spark: SparkSession, out: str) -> BatchLog:
    names = [f.split()[0] for f in ESTIMATE.split(", ")]
    return BatchLog(spark, f"{out}/rows", ESTIMATE,
                    lambda r: r.agg(*[F.max_by(c, "batch").alias(c) for c in names]))


def estimate_snapshot(spark: SparkSession, out: str) -> DataFrame:
    """The latest row of ``distinct_estimate_stream``."""
    return _estimate_log(spark, out).read().drop("batch")


BATCH_SKETCH = "batch bigint, n_items bigint, sketch binary"
# log2 of the registers of a batch's distinct sketch: a relative error of 1.04 / sqrt(2^14).
SKETCH_LG_K = 14


def distinct_sketches(stream: DataFrame, out: str | None = None, trigger: str | None = None,
                      lg_k: int = SKETCH_LG_K) -> StreamJob:
    """A mergeable distinct sketch (HLL) and the length of every batch: any range of
    batches can be counted later, without their items. No state but the log, one
    row a batch."""
    spark = stream.sparkSession
    out = out or scratch_path(spark, "distinct-sketches")
    log = _sketch_log(spark, out)

    def fn(batch: DataFrame, batch_id: int) -> None:
        log.put(batch.agg(F.lit(batch_id).cast("bigint").alias("batch"), F.count("item").alias("n_items"),
                          F.hll_sketch_agg("item", F.lit(lg_k)).alias("sketch")), batch_id)

    return StreamJob(_writer(read_items(stream), out, fn, trigger).start(), out)


def _sketch_log(spark: SparkSession, out: str) -> TieredLog:
    return TieredLog(spark, f"{out}/sketches", BATCH_SKETCH)


def distinct_between(spark: SparkSession, out: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """``n_items, n_distinct`` of the batches from ``first`` to ``last`` (both
    included, open where None): their sketches merged."""
    rows = _sketch_log(spark, out).read()
    if first is not None:
        rows = rows.filter(F.col("batch") >= first)
    if last is not None:
        rows = rows.filter(F.col("batch") <= last)
    return rows.agg(F.coalesce(F.sum("n_items"), F.lit(0)).cast("bigint").alias("n_items"),
                    F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch", F.lit(True))), F.lit(0))
                    .alias("n_distinct"))


def stream_summary(spark: SparkSession, counts_out: str) -> DataFrame:
    """``n_items, n_distinct, largest`` of a running histogram."""
    return counts_snapshot(spark, counts_out).agg(
        F.coalesce(F.sum("cnt"), F.lit(0)).cast("bigint").alias("n_items"),
        F.count(F.lit(1)).alias("n_distinct"),
        F.max("item").alias("largest"))


CELLS = "sketch string, row int, bucket int, cnt bigint"


def sketch_cells_stream(stream: DataFrame, sketches, out: str | None = None,
                        trigger: str | None = None, every: int = EVERY) -> StreamJob:
    """Running cells of one or more sketches (``sketch.Sketch``) as one tagged
    table. Sketches are linear: each batch writes the cells of its own items (at
    most the sum of D*W rows, partial sums before the shuffle), and the log adds
    them up. Nothing else is kept, whatever the stream, and the session's settings
    stay as they are."""
    from fairstream.operators.sketch import Sketch, build
    sk = [sketches] if isinstance(sketches, Sketch) else list(sketches)
    spark = stream.sparkSession
    out = out or scratch_path(spark, "sketch-cells")
    log = _cells_log(spark, out, every)

    def fn(batch: DataFrame, batch_id: int) -> None:
        log.put(build(batch, sk).select("sketch", "row", "bucket", "cnt"), batch_id)

    return StreamJob(_writer(read_items(stream), out, fn, trigger).start(), out)


def _cells_log(spark: SparkSession, out: str, every: int = EVERY) -> BatchLog:
    return BatchLog(spark, f"{out}/cells", CELLS,
                    lambda c: c.groupBy("sketch", "row", "bucket").agg(F.sum("cnt").alias("cnt")), every)


def cells_snapshot(spark: SparkSession, out: str) -> DataFrame:
    """``sketch, row, bucket, cnt`` of all batches so far."""
    return _cells_log(spark, out).read()


def prefix(stream: DataFrame, threshold: int | None, out: str | None = None,
           trigger: str | None = None, every: int = EVERY) -> StreamJob:
    """Process whole micro-batches until at least ``threshold`` items were seen.

    Each accepted batch writes its own histogram (item, cnt, batch_time, batch_id) to
    a log in tiers of ``every``, which is all the end-of-stream reports need; batch
    sizes are its sums. Whether a batch is accepted depends only on the sizes of the batches
    before it: the running total is kept on the driver and, after a restart,
    re-read once from what earlier batches wrote, so a replayed batch decides
    the same way. ``threshold=None`` takes the whole stream.
    """
    if threshold is not None and threshold <= 0:
        raise ValueError("threshold must be positive")
    spark = stream.sparkSession
    out = out or scratch_path(spark, "prefix")
    items = read_items(stream)
    state: dict = {"stop": False, "total": None}
    log = _histograms(spark, out, every)

    def total_before(batch_id: int) -> int:
        if state["total"] is None:                  # first batch of this run
            earlier = batch_sizes(spark, out).filter(F.col("batch_id") < batch_id)
            state["total"] = earlier.agg(F.sum("n_rows")).first()[0] or 0
        return state["total"]

    def fn(batch: DataFrame, batch_id: int) -> None:
        before = total_before(batch_id)
        if threshold is not None and before >= threshold:
            state["stop"], state["stop_batch"] = True, batch_id
            return
        counts = batch.groupBy("item").agg(F.count(F.lit(1)).alias("cnt"))
        size = Observation(f"batch_size_{batch_id}")      # measured by the write itself
        stamped = (counts.withColumn("batch_time", F.lit(datetime.now(timezone.utc)))
                   .withColumn("batch_id", F.lit(batch_id).cast("int")))
        log.put(stamped.observe(size, F.sum("cnt").alias("n")), batch_id)
        n = int(size.get.get("n") or 0)
        if n == 0:
            return                          # an empty batch wrote an empty histogram
        state["total"] = before + n
        if threshold is not None and before + n >= threshold:
            state["stop"], state["stop_batch"] = True, batch_id

    return StreamJob(_writer(items, out, fn, trigger).start(), out, state)


def _histograms(spark: SparkSession, out: str, every: int = EVERY) -> TieredLog:
    """The accepted batches' histograms, each kept apart."""
    return TieredLog(spark, f"{out}/counts", COUNTS_SCHEMA, every=every)


def batch_sizes(spark: SparkSession, out: str) -> DataFrame:
    """``batch_id, n_rows`` of the accepted, non-empty batches."""
    return batch_log(spark, out).select("batch_id", "n_rows")


def batch_log(spark: SparkSession, out: str) -> DataFrame:
    """``batch_id, batch_time, n_rows`` of every accepted, non-empty batch, however
    many there were (``progress_log`` covers the query's recent ones only)."""
    c = _histograms(spark, out).read()
    return c.groupBy(F.col("batch_id").cast("bigint").alias("batch_id")) \
        .agg(F.max("batch_time").alias("batch_time"), F.sum("cnt").cast("bigint").alias("n_rows"))


def batch_counts(spark: SparkSession, out: str) -> DataFrame:
    """``item, cnt, batch_id``: each accepted batch's own histogram (the input
    of weighted sketch updates)."""
    return _histograms(spark, out).read().select("item", "cnt", "batch_id")


def prefix_counts(spark: SparkSession, out: str) -> DataFrame:
    """``item, cnt`` over all accepted batches."""
    return _histograms(spark, out).read().groupBy("item") \
        .agg(F.sum("cnt").cast("bigint").alias("cnt"))


def prefix_summary(spark: SparkSession, out: str) -> DataFrame:
    """``n_batches, n_items, n_distinct, largest`` of the processed prefix: the
    batch log and the histogram are stacked and aggregated once (no join)."""
    sizes = batch_sizes(spark, out).select(
        F.col("n_rows"), F.lit(None).cast("bigint").alias("item"))
    hist = prefix_counts(spark, out).select(
        F.lit(None).cast("bigint").alias("n_rows"), F.col("item"))
    return sizes.unionByName(hist).agg(
        F.count("n_rows").alias("n_batches"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("n_items"),
        F.count("item").alias("n_distinct"),
        F.max("item").alias("largest"))
