from collections import Counter

from pyspark.sql import functions as F

from fairstream.functions import hashing as H
from fairstream.operators import sketch
from fairstream.session import scratch_path
from fairstream.sources.tables import read_table
from fairstream.streaming import stream as S
from tests.conftest import SF_MID


def _events(spark, parts=5):
    ev = read_table(spark, SF_MID, "events").select(F.col("user_id").alias("item"), "event_id")
    path = S.split_copy(ev, "event_id", parts, scratch_path(spark, "t-split"))
    return ev, S.file_stream(spark, path, "item bigint, event_id bigint, part int")


def test_prefix_counts_crossing_batch_in_full(spark):
    ev, st = _events(spark)
    job = S.prefix(st, 5000).wait(600)
    sizes = sorted(tuple(r) for r in S.batch_sizes(spark, job.out).collect())
    assert sizes == [(0, 2000), (1, 2000), (2, 2000)]          # 6000 >= 5000
    summ = S.prefix_summary(spark, job.out).first()
    assert (summ["n_batches"], summ["n_items"]) == (3, 6000)
    log = job.progress_log()
    assert [(b, n) for b, _, n in log][:3] == [(0, 2000), (1, 2000), (2, 2000)]
    want = Counter(r["item"] for r in ev.filter("event_id < 6000").collect())
    got = {r["item"]: r["cnt"] for r in S.prefix_counts(spark, job.out).collect()}
    assert got == dict(want)


def test_running_counts_distinct_and_cells(spark):
    ev, st = _events(spark)
    want = Counter(r["item"] for r in ev.collect())
    job = S.running_counts(st).wait(600)
    assert {r["item"]: r["cnt"] for r in S.counts_snapshot(spark, job.out).collect()} == dict(want)
    _, st2 = _events(spark)
    job2 = S.running_distinct(st2).wait(600)
    assert sorted(r["item"] for r in S.distinct_snapshot(spark, job2.out).collect()) == sorted(want)
    cm, cs = H.hash_family(3, 10, seed=2)
    both = [sketch.Sketch("cm", cm), sketch.Sketch("cs", cs, signed=True)]
    _, st3 = _events(spark)
    job3 = S.sketch_cells_stream(st3, both).wait(600)
    batch = sorted(map(tuple, sketch.build(ev, both).collect()))
    assert sorted(map(tuple, S.cells_snapshot(spark, job3.out).collect())) == batch


def test_restart_resumes_from_checkpoint(spark):
    ev, st = _events(spark)
    out = scratch_path(spark, "t-restart")
    S.prefix(st, 3000, out=out).wait(600)                       # stops after 2 batches
    assert S.batch_sizes(spark, out).count() == 2
    S.prefix(st, 3000, out=out).wait(600)                       # same checkpoint: nothing new accepted
    assert S.batch_sizes(spark, out).count() == 2


def test_text_lines_stream(spark, tmp_path):
    src = tmp_path / "lines"
    src.mkdir()
    (src / "a.txt").write_text("3\n 5\n3\n")
    (src / "b.txt").write_text("7\n3\n")
    st = spark.readStream.option("maxFilesPerTrigger", 1).text(str(src)).withColumnRenamed("value", "item")
    job = S.running_counts(st).wait(600)
    got = {r["item"]: r["cnt"] for r in S.counts_snapshot(spark, job.out).collect()}
    assert got == {3: 3, 5: 1, 7: 1}


def test_hot_item_stream(spark):
    """Item 1 holds about half of the rows: counts, distinct set and prefix stay exact."""
    li = read_table(spark, SF_MID, "lineitem").select(
        F.expr("1000 div (1 + l_partkey % 1000)").cast("bigint").alias("item"), "l_orderkey")
    rows = [r["item"] for r in li.collect()]
    want = Counter(rows)
    assert want.most_common(1)[0][1] * 3 >= len(rows)          # the hot item is over a third
    path = S.split_copy(li, "l_orderkey", 4, scratch_path(spark, "t-hot"))
    schema = "item bigint, l_orderkey bigint, part int"
    job = S.running_counts(S.file_stream(spark, path, schema)).wait(600)
    assert {r["item"]: r["cnt"] for r in S.counts_snapshot(spark, job.out).collect()} == dict(want)
    job = S.running_distinct(S.file_stream(spark, path, schema)).wait(600)
    assert sorted(r["item"] for r in S.distinct_snapshot(spark, job.out).collect()) == sorted(want)
    job = S.prefix(S.file_stream(spark, path, schema), None).wait(600)
    assert {r["item"]: r["cnt"] for r in S.prefix_counts(spark, job.out).collect()} == dict(want)


def test_processing_time_trigger(spark):
    """The reference's 100 ms micro-batches: a continuous query, drained and stopped."""
    ev, st = _events(spark)
    job = S.running_counts(st, trigger=S.BATCH_INTERVAL).drain()
    want = Counter(r["item"] for r in ev.collect())
    assert {r["item"]: r["cnt"] for r in S.counts_snapshot(spark, job.out).collect()} == dict(want)
    _, st2 = _events(spark)
    job2 = S.prefix(st2, 3000, trigger=S.BATCH_INTERVAL).wait(600)     # stops itself at T
    assert not job2.query.isActive
    sizes = sorted(tuple(r) for r in S.batch_sizes(spark, job2.out).collect())
    assert sizes == [(0, 2000), (1, 2000)]


def test_state_snapshot_agrees_with_updates(spark):
    _, st = _events(spark)
    job = S.running_counts(st).wait(600)
    from_updates = {r["item"]: r["cnt"] for r in S.counts_snapshot(spark, job.out).collect()}
    from_state = {r["item"]: r["count"] for r in S.state_snapshot(spark, job.out).collect()}
    assert from_state == from_updates


def test_distinct_estimate_stream(spark):
    ev, st = _events(spark)
    job = S.distinct_estimate_stream(st, rsd=0.02).wait(600)
    r = S.estimate_snapshot(spark, job.out).first()
    exact = {x["item"] for x in ev.collect()}
    assert r["n_items"] == 10000 and r["largest"] == max(exact)
    assert abs(r["n_distinct"] - len(exact)) <= 0.06 * len(exact)


def test_empty_stream(spark, tmp_path):
    """No items: count 0, no distinct items, largest null; no batch logged."""
    empty = tmp_path / "empty"
    empty.mkdir()
    st = S.file_stream(spark, str(empty), "item bigint, part int")
    job = S.prefix(st, 10).wait(600)
    summ = S.prefix_summary(spark, job.out).first()
    assert (summ["n_batches"], summ["n_items"], summ["n_distinct"], summ["largest"]) == (0, 0, 0, None)
    assert S.batch_sizes(spark, job.out).count() == 0
    job2 = S.running_counts(S.file_stream(spark, str(empty), "item bigint, part int")).wait(600)
    assert S.counts_snapshot(spark, job2.out).count() == 0
    s2 = S.stream_summary(spark, job2.out).first()
    assert (s2["n_items"], s2["n_distinct"], s2["largest"]) == (0, 0, None)


def test_sketch_stream_state_is_bounded(spark):
    """What the sketch stream keeps (its log's snapshot, and each batch's part) has at
    most D*W rows per sketch, whatever the stream's length."""
    cm, cs = H.hash_family(3, 10, seed=5)
    both = [sketch.Sketch("cm", cm), sketch.Sketch("cs", cs, signed=True)]
    _, st = _events(spark)
    job = S.sketch_cells_stream(st, both, every=2).wait(600)
    assert S.cells_snapshot(spark, job.out).count() <= cm.cells + cs.cells
    kept = S._cells_log(spark, job.out).manifest()
    assert kept["snapshot"]
    for part in [kept["snapshot"], *kept["deltas"]]:
        assert spark.read.parquet(f"{job.out}/cells/{part}").count() <= cm.cells + cs.cells
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"        # session untouched


def test_batch_log_has_a_time_for_every_batch(spark):
    _, st = _events(spark)
    job = S.prefix(st, None).wait(600)
    log = S.batch_log(spark, job.out).orderBy("batch_id").collect()
    times = [r["batch_time"] for r in log]
    assert len(log) == S.batch_sizes(spark, job.out).count() > 1
    assert None not in times and times == sorted(times)
    assert S.batch_counts(spark, job.out).columns == ["item", "cnt", "batch_id"]
