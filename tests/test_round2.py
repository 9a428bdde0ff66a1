"""Cases that went wrong once: ragged points, foreign round logs, null labels,
wide items, hot items in a stream, repeated noise."""

import math
import random

import pytest
from pyspark.sql import functions as F

from fairstream.functions import hashing as H
from fairstream.operators import cluster, fair, metrics, topk
from fairstream.sources import synth
from fairstream.streaming import stream as S


@pytest.mark.parametrize("dims", [2, 16, 17, 64])
@pytest.mark.parametrize("method", ["columns", "pandas"])
@pytest.mark.parametrize("off", [-1, 1])
def test_points_of_another_size_fail(spark, dims, method, off):
    df = spark.createDataFrame([([0.0] * (dims + off),)], "features array<double>")
    with pytest.raises(Exception, match="differ in size"):
        cluster.assign(df, [[0.0] * dims, [1.0] * dims], None, method=method).collect()


def test_many_centres_take_the_batch_path_with_equal_results(spark):
    rnd = random.Random(2)
    centres = [[float(rnd.randint(0, 99)), float(rnd.randint(0, 99))] for _ in range(70)]
    df = spark.range(300).select((F.col("id") * 37 % 101).cast("double").alias("x"),
                                 (F.col("id") * 53 % 97).cast("double").alias("y"))
    auto = cluster.assign(df, centres)
    assert "MapInPandas" in auto._jdf.queryExecution().executedPlan().toString()
    assert sorted(auto.collect()) == sorted(cluster.assign(df, centres, method="columns").collect())


def test_assignment_start_does_not_depend_on_cores(spark):
    df = spark.range(200).select(F.col("id").cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("y"))
    assert cluster.cache_points(df, partitions=3).unpersist().rdd.getNumPartitions() == 3


def test_round_log_answers_only_for_its_own_run(spark, tmp_path):
    df = spark.range(100).select(F.col("id").cast("double").alias("x"), (F.col("id") % 9).cast("double").alias("y"),
                                 F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("grp"))
    start, log = [[0.0, 0.0], [90.0, 3.0]], str(tmp_path / "log")
    one = fair.fair_rounds(df, start, 1)
    fair.fair_rounds(df, start, 3, log_path=log)
    assert fair.fair_rounds(df, start, 1, log_path=log) == one
    with pytest.raises(ValueError, match="other centres"):
        fair.fair_rounds(df, [[1.0, 0.0], [90.0, 3.0]], 2, log_path=log)
    with pytest.raises(ValueError, match="other centres"):
        fair.fair_rounds(df, [*start, [5.0, 5.0]], 2, log_path=log)
    assert cluster.lloyd(df, start, 2, log_path=log) == cluster.lloyd(df, start, 2)


def test_null_labels_count_as_b_and_empty_tables_raise(spark):
    df = spark.createDataFrame([(0.0, 0.0, "A"), (1.0, 1.0, "B"), (1.0, 2.0, None)], "x double, y double, grp string")
    row = metrics.cluster_report(df, [[0.0, 0.0]]).first()
    assert (row["n"], row["n_a"], row["n_b"]) == (3, 1, 2)
    assert metrics.cluster_statistics(df, [[0.0, 0.0]]).first()["n_b"] == 2
    with pytest.raises(Exception, match="no points"):
        metrics.summary(df.limit(0), [[0.0, 0.0]]).collect()


def test_wide_items_hash_without_overflow(spark):
    rnd = random.Random(4)
    items = [rnd.randrange(-(1 << 63), 1 << 63) for _ in range(200)]
    items += [0, 1, -1, (1 << 63) - 1, -(1 << 63), -8191, -8190, -8192, 8191] + list(range(-40, 40))
    df = spark.createDataFrame([(x,) for x in items], "item long")
    for a, b in ((1, 0), (8190, 8190), (17, 8000), (4096, 1)):
        h = H.HashParams(a, b)
        for r in df.select("item", H.bucket(F.col("item"), h, 50).alias("c"), H.sign(F.col("item"), h).alias("s")).collect():
            v = int(math.fmod(a * r["item"] + b, 8191)) if abs(r["item"]) < 1 << 30 else \
                (1 if a * r["item"] + b >= 0 else -1) * (abs(a * r["item"] + b) % 8191)
            assert r["c"] == v % 50 and r["s"] == (1 if v % 2 == 0 else -1)
    with pytest.raises(ValueError):
        H.spec(8192, [(1, 0)])
    one, two = H.hash_family(3, 10, seed=5), H.hash_family(3, 10, seed=5)
    assert one == two and one != H.hash_family(3, 10, seed=6)


def test_streaming_distinct_merges_before_the_exchange(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(1000).select((F.col("id") * 0).alias("item")).write.parquet(path)
    stream = spark.readStream.schema("item bigint").parquet(path)
    job = S.running_distinct(stream).wait()
    assert [r["item"] for r in S.distinct_snapshot(spark, job.out).collect()] == [0]
    plan = job.query._jsq.explainInternal(False) if hasattr(job.query._jsq, "explainInternal") else ""
    assert "StreamingDeduplicate" not in plan
    assert not plan or "partial_max" in plan


def test_one_route_for_every_k(spark):
    counts = spark.createDataFrame([(i, c) for i, c in enumerate([9, 7, 7, 3, 1])], "item long, cnt long")
    assert [topk.kth_frequency(counts, k).first()[0] for k in (1, 2, 3, 4, 5, 6, 10**9)] == [9, 7, 7, 3, 1, 1, 1]
    assert topk.kth_frequency(counts.limit(0), 3).first()[0] is None


def test_noise_is_independent_and_free_of_the_partitioning(spark):
    ids = spark.range(4000)
    one = synth.labelled_blobs(ids.repartition(1), 4000, 2).orderBy("id").collect()
    assert one == synth.labelled_blobs(ids.repartition(7), 4000, 2).orderBy("id").collect()
    n = ids.select(synth.noise(F.col("id"), 42, "x").alias("a"), synth.noise(F.col("id"), 42, "y").alias("b"))
    r = n.agg(F.avg("a"), F.stddev("a"), F.avg("b"), F.stddev("b"), F.corr("a", "b")).first()
    assert max(abs(r[0]), abs(r[2]), abs(r[4])) < 0.06 and abs(r[1] - 1) < 0.05 and abs(r[3] - 1) < 0.05
