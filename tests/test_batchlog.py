"""Batch logs with compaction, and the stream jobs built on them."""
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fairstream.functions import hashing as H
from fairstream.operators import sketch
from fairstream.session import scratch_path
from fairstream.sources import items as I
from fairstream.streaming import hitters
from fairstream.streaming import stream as S
from fairstream.streaming.batchlog import BatchLog, TieredLog

SCHEMA = "item bigint, cnt bigint"


def added(rows):
    return rows.groupBy("item").agg(F.sum("cnt").alias("cnt"))


def as_dict(df):
    return {r["item"]: r["cnt"] for r in df.collect()}


def frame(spark, counts):
    return spark.createDataFrame(list(counts.items()), SCHEMA).coalesce(1)


def test_two_hundred_batches_leave_a_bounded_number_of_files(spark):
    log = BatchLog(spark, scratch_path(spark, "log"), SCHEMA, added, every=10)
    want = Counter()
    for b in range(200):
        one = {b % 7: 1, b: 2}
        want.update(one)
        log.put(frame(spark, one), b)
        if b % 41 == 0:
            assert as_dict(log.read()) == dict(want)
    assert as_dict(log.read()) == dict(want)
    assert len(log.read().inputFiles()) <= 8 + 10            # a snapshot's partitions and the deltas
    kept = log.files.names("deltas") + log.files.names("snapshots")
    assert len(kept) <= 2 * 10 + 2 and len(log.files.names("manifest")) <= 3 * 10 + 1


def test_replayed_batches_replace_themselves(spark):
    log = BatchLog(spark, scratch_path(spark, "log"), SCHEMA, added, every=3)
    for b in range(8):
        for _ in range(3):                                   # also the batches that compact
            log.put(frame(spark, {b: 1, 100: 1}), b)
        again = BatchLog(spark, log.path, SCHEMA, added, every=3)
        assert as_dict(again.read()) == {**{i: 1 for i in range(b + 1)}, 100: b + 1}


def test_a_batch_cut_off_before_its_manifest_is_not_seen(spark):
    log = BatchLog(spark, scratch_path(spark, "log"), SCHEMA, added, every=3)
    assert log.read().count() == 0
    log.put(frame(spark, {1: 1}), 0)
    frame(spark, {2: 5}).write.parquet(f"{log.path}/deltas/{1:012d}")
    assert as_dict(log.read()) == {1: 1}
    log.put(frame(spark, {3: 1}), 1)
    assert as_dict(log.read()) == {1: 1, 3: 1}
    with pytest.raises(ValueError):
        BatchLog(spark, log.path, SCHEMA, added, every=0)


def test_tiers_keep_every_row_once_in_few_folders(spark):
    log = TieredLog(spark, scratch_path(spark, "tiers"), SCHEMA, every=3)
    assert log.read().count() == 0
    for b in range(31):
        for _ in range(1 + (b % 4 == 0 or b in (2, 8, 26))):             # replays, also of batches that merge
            log.put(frame(spark, {b: 1}), b)
        again = TieredLog(spark, log.path, SCHEMA, every=3)
        parts = again._parts(again.manifest())
        assert len(parts) <= 2 * 4                                       # 27 batches: a third tier
        if b % 5 == 0 or b in (8, 26, 30):
            assert sorted(r["item"] for r in again.read().collect()) == list(range(b + 1))
    assert any(p.startswith("tier3/") for p in parts)
    folders = [n for t in ("deltas", "tier1", "tier2", "tier3") for n in log.files.names(t)]
    assert len(folders) <= len(parts) + 2 * 3 * 3 and len(log.files.names("manifest")) <= 3 * 3 + 1
    with pytest.raises(ValueError):
        TieredLog(spark, log.path, SCHEMA, every=1)


def test_prefix_histograms_are_merged_and_stay_apart(spark):
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "out")
    def run(files):
        for k in files:
            rows = spark.createDataFrame([(k,)] * (k + 1) + [(9,)], "item bigint")
            rows.coalesce(1).write.mode("append").parquet(landing)
        st = spark.readStream.schema("item bigint").option("maxFilesPerTrigger", 1).parquet(landing)
        S.prefix(st, None, out, every=2).wait(600)
        return sorted((r["batch_id"], r["n_rows"]) for r in S.batch_sizes(spark, out).collect())
    assert run(range(3)) == [(0, 2), (1, 3), (2, 4)]
    assert run(range(3, 7)) == [(b, b + 2) for b in range(7)]            # a restart goes on behind them
    counts = {(r["batch_id"], r["item"]): r["cnt"] for r in S.batch_counts(spark, out).collect()}
    assert counts == {(k, k): k + 1 for k in range(7)} | {(k, 9): 1 for k in range(7)}
    assert len(S._histograms(spark, out).files.names("tier2")) == 1


def test_a_running_job_goes_on_after_a_restart(spark):
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "out")
    want = Counter()
    for part in range(3):
        for k in range(4):
            rows = [(k * part + x % 5,) for x in range(30)]
            want.update(r[0] for r in rows)
            spark.createDataFrame(rows, "item bigint").coalesce(1).write.mode("append").parquet(landing)
        stream = spark.readStream.schema("item bigint").option("maxFilesPerTrigger", 1).parquet(landing)
        job = S.running_counts(stream, out, every=3).wait()
        assert as_dict(S.counts_snapshot(spark, job.out)) == dict(want)
    assert S._counts_log(spark, out).manifest()["snapshot"]


def skewed_landing(spark, parts=6, n=3000):
    path = scratch_path(spark, "skewed")
    rnd = np.random.default_rng(3)
    values = np.minimum(rnd.zipf(1.3, n), 10 ** 6)
    rows = [(int(v), i) for i, v in enumerate(values)]
    return S.split_copy(spark.createDataFrame(rows, "item bigint, i bigint"), "i", parts, path), values


def test_bounded_hitters_keep_their_bounds(spark):
    path, values = skewed_landing(spark)
    stream = S.file_stream(spark, path, "item bigint, i bigint, part int")
    job = hitters.hitters_stream(stream, counters=10, buckets=3).wait()
    found = {r["item"]: r for r in hitters.hitters_snapshot(spark, job.out).collect()}
    true = Counter(values.tolist())
    assert len(found) <= 30 < len(true)                      # many items were turned away
    assert {r["n_items"] for r in found.values()} == {len(values)}
    assert all(r["lower"] <= true[i] <= r["upper"] for i, r in found.items())
    assert all(i in found for i, n in true.items() if n * 10 > len(values))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 12), st.integers(1, 9)), min_size=1, max_size=20), max_size=6),
       st.integers(1, 6))
def test_summaries_bound_every_count(batches, counters):
    items, counts, err, true = np.array([], np.int64), np.array([], np.int64), 0, Counter()
    for batch in batches:
        for i, n in batch:
            true[i] += n
        items, counts, cut = hitters.add_counts(np.r_[items, [i for i, _ in batch]].astype(np.int64),
                                                np.r_[counts, [n for _, n in batch]].astype(np.int64), counters)
        err += cut
    kept = dict(zip(items.tolist(), counts.tolist()))
    assert len(kept) <= counters and err * (counters + 1) <= sum(true.values())
    assert all(kept.get(i, 0) <= n <= kept.get(i, 0) + err for i, n in true.items())


def test_any_range_of_batches_has_its_distinct_count(spark):
    path, values = skewed_landing(spark)
    job = S.distinct_sketches(S.file_stream(spark, path, "item bigint, i bigint, part int")).wait()
    cuts = np.linspace(0, len(values), 7).astype(int)
    for first, last in ((0, 5), (2, 4), (3, 3), (None, 1)):
        mine = values[cuts[first or 0]:cuts[last + 1]]
        r = S.distinct_between(spark, job.out, first, last).first()
        assert r["n_items"] == len(mine)
        assert abs(r["n_distinct"] - len(set(mine.tolist()))) <= 0.05 * len(set(mine.tolist()))
    assert tuple(S.distinct_between(spark, job.out, 90, 99).first()) == (0, 0)


def test_sketch_streams_started_together_leave_the_settings_alone(spark):
    path, _ = skewed_landing(spark)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    cm, cs = H.hash_family(3, 16, seed=9)
    sk = [sketch.Sketch("cm", cm), sketch.Sketch("cs", cs, signed=True)]
    stream = S.file_stream(spark, path, "item bigint, i bigint, part int")
    jobs = [S.sketch_cells_stream(stream, s, every=2) for s in sk]
    counts = S.running_counts(stream)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    whole = sketch.build(spark.read.parquet(path).select("item"), sk)
    for s, job in zip(sk, jobs):
        got = S.cells_snapshot(spark, job.wait().out)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.filter(F.col("sketch") == s.name).collect()))
    assert S.counts_snapshot(spark, counts.wait().out).agg(F.sum("cnt")).first()[0] == 3000


def test_lines_are_parsed_and_a_bad_line_fails(spark):
    path = scratch_path(spark, "lines")
    spark.createDataFrame([(" 5 ",), ("5",), ("-7",)], "value string").coalesce(1).write.text(path)
    job = S.running_counts(I.parse_items(S.line_stream(spark, path)), trigger=S.BATCH_INTERVAL).drain()
    assert as_dict(S.counts_snapshot(spark, job.out)) == {5: 2, -7: 1}
    spark.createDataFrame([("five",)], "value string").coalesce(1).write.mode("append").text(path)
    with pytest.raises(Exception):
        S.running_counts(I.parse_items(S.line_stream(spark, path))).wait()
