"""The reference's five programs as functions: same inputs (a points file with L,
K, M; a stream with T, D, W, K; N and K for the generator), same reports,
returned as values instead of printed. Each is a composition of the
operators; the work runs on Spark.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairstream.functions import hashing as H
from fairstream.operators import cluster, fair, metrics, sketch, topk
from fairstream.sources import points as P
from fairstream.sources import synth
from fairstream.streaming import stream as S


def _check_kml(k: int, m: int, partitions: int | None) -> None:
    if k <= 0 or m < 0:
        raise ValueError("K must be > 0 and M >= 0")
    if partitions is not None and partitions <= 0:
        raise ValueError("L must be > 0")


@dataclass
class KMeansReport:
    n: int
    n_a: int
    n_b: int
    centers: list
    delta: float
    phi: float
    clusters: list = field(default_factory=list)   # rows: cluster, centre, n_a, n_b


def kmeans_report_job(spark: SparkSession, path: str, partitions: int | None, k: int,
                      iterations: int, seed: int, dims: int | None = 2) -> KMeansReport:
    """Read labelled points, fit k-means (K centres, M iterations), report N,
    NA, NB, Delta, Phi and the per-cluster A/B counts."""
    _check_kml(k, iterations, partitions)
    pts = P.read_points(spark, path, dims=dims, partitions=partitions)
    cols = ("x", "y") if dims == 2 else None
    cached = cluster.cache_points(pts, cols)
    try:
        cs = cluster.kmeans(cached, k, iterations, seed, cols)
        rep = metrics.report(cached, cs, cols)
    finally:
        cached.unpersist()
    rows = [{"cluster": i, "center": cs[i], **v} for i, v in rep["clusters"].items()]
    return KMeansReport(rep["n"], rep["n_a"], rep["n_b"], cs, rep["delta"], rep["phi"], rows)


@dataclass
class FairComparison:
    n: int
    n_a: int
    n_b: int
    standard: list
    fair: list
    phi_standard: float
    phi_fair: float
    ms: dict


def fair_comparison_job(spark: SparkSession, path: str, partitions: int | None, k: int,
                        iterations: int, seed: int, dims: int | None = None,
                        log_path: str | None = None) -> FairComparison:
    """Standard and fair centres on the same points, Phi of each, and the
    milliseconds of the four steps."""
    _check_kml(k, iterations, partitions)
    pts = P.read_points(spark, path, dims=dims, partitions=partitions)
    cols = ("x", "y") if dims == 2 else None
    cached = cluster.cache_points(pts, cols)
    try:
        counts = P.group_counts(cached).first()
        ms = {}
        t = time.perf_counter()
        std = cluster.kmeans(cached, k, iterations, seed, cols)
        ms["standard_centers"] = 1000 * (time.perf_counter() - t)
        t = time.perf_counter()
        phi_std = metrics.report(cached, std, cols)["phi"]
        ms["standard_phi"] = 1000 * (time.perf_counter() - t)
        t = time.perf_counter()
        fc = fair.fair_rounds(cached, cluster.init_centers(cached, k, seed, cols), iterations,
                              cols, persist=False, log_path=log_path)
        ms["fair_centers"] = 1000 * (time.perf_counter() - t)
        t = time.perf_counter()
        phi_fair = metrics.report(cached, fc, cols)["phi"]
        ms["fair_phi"] = 1000 * (time.perf_counter() - t)
    finally:
        cached.unpersist()
    return FairComparison(counts["n"], counts["n_a"], counts["n_b"], std, fc, phi_std,
                          phi_fair, ms)


@dataclass
class HitterReport:
    n_items: int
    n_distinct: int
    phi_k: int | None
    n_hitters: int
    cm_rel_err: float | None
    cs_rel_err: float | None
    listing: DataFrame          # item, true count, count-min estimate


def heavy_hitters_job(stream: DataFrame, threshold: int, depth: int, width: int, k: int,
                      seed: int, out: str | None = None) -> HitterReport:
    """Read whole micro-batches until at least T items, then report the
    distinct count, the top-K heavy hitters (ties included) and the mean
    relative error of a count-min and a count sketch (D rows, W columns) on
    them; ``listing`` is the per-item listing as a DataFrame (ties can make it
    longer than K, so it stays on Spark)."""
    if threshold <= 0 or depth <= 0 or width <= 0 or k <= 0:
        raise ValueError("T, D, W and K must be positive")
    spark = stream.sparkSession
    cm_spec, cs_spec = H.hash_family(depth, width, seed)
    cm, cs = sketch.Sketch("cm", cm_spec), sketch.Sketch("cs", cs_spec, signed=True)
    job = S.prefix(stream, threshold, out=out).wait()
    batch_counts = S.batch_counts(spark, job.out)
    counts = S.prefix_counts(spark, job.out)
    cells = sketch.build(batch_counts, [cm, cs], weight_col="cnt")
    r = topk.report_from_counts(counts, k, cells, cm, cs).first()
    listing = topk.hitter_listing(counts, k, cells.filter(F.col("sketch") == "cm").drop("sketch"), cm_spec)
    return HitterReport(r["n_items"], r["n_distinct"], r["phi_k"], r["n_hitters"],
                        r["cm_rel_err"], r["cs_rel_err"], listing)


def distinct_items_job(stream: DataFrame, threshold: int, out: str | None = None) -> dict:
    """Read whole micro-batches until at least T items; report the number of
    items read, the distinct count, the largest item and the batch sizes."""
    if threshold <= 0:
        raise ValueError("T must be positive")
    spark = stream.sparkSession
    job = S.prefix(stream, threshold, out=out).wait()
    summ = S.prefix_summary(spark, job.out).first()
    sizes = sorted(tuple(r) for r in S.batch_sizes(spark, job.out).collect())
    return {"n_items": summ["n_items"], "n_distinct": summ["n_distinct"],
            "largest": summ["largest"], "batch_sizes": sizes}


def write_blobs(spark: SparkSession, n_total: int, k: int, path: str, seed: int = 42) -> str:
    """Write N labelled points in K blob pairs as ``x,y,label`` text lines."""
    ids = spark.range(n_total)
    synth.to_lines(synth.labelled_blobs(ids, n_total, k, seed)).write.text(path)
    return path
