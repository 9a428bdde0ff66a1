"""The registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame
computed by Spark from the given tables. Fixed parameters live in
``fairstream.plans.fixtures``; the matching SQL lives in ``oracles``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fairstream.functions import hashing as H
from fairstream.functions.exact import coordinate_grid
from fairstream.operators import cluster, fair, metrics, sketch, topk
from fairstream.plans import fixtures as fx
from fairstream.session import scratch_path
from fairstream.sources import items as I
from fairstream.sources import linelog
from fairstream.sources import points as P
from fairstream.sources import synth
from fairstream.sources.tables import read_table
from fairstream.streaming import hitters, sink
from fairstream.streaming import stream as S

Query = Callable[[SparkSession, str], DataFrame]

D, CD = fx.DIGITS, fx.COST_DIGITS


def _round(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.select(*[F.round(c, digits[c]).alias(c) if c in digits else F.col(c)
                       for c in df.columns])


# --- points and metrics -------------------------------------------------------

def q_group_counts(spark, sf_dir):
    return P.group_counts(P.points2d(spark, sf_dir))


def q_parse_points_2d(spark, sf_dir):
    return P.parse_points(P.point_lines(spark, sf_dir), dims=2)


def q_parse_points_nd(spark, sf_dir):
    p = P.parse_points(P.nd_lines(spark, sf_dir), dims=None)
    return p.select(
        "id", "grp", F.size("features").alias("n_dims"),
        F.col("features")[0].alias("c_first"),
        F.element_at("features", -1).alias("c_last"),
        F.round(F.aggregate("features", F.lit(0.0), lambda a, v: a + v), D).alias("c_sum"))


def q_assign_nearest(spark, sf_dir):
    a = cluster.assign(P.points2d(spark, sf_dir), fx.CENTERS_2D, ("x", "y"))
    return _round(a.select("id", "cluster", "dist2"), {"dist2": D})


def q_assign_nearest_nd(spark, sf_dir):
    a = cluster.assign(P.pointsnd(spark, sf_dir), fx.CENTERS_ND, cols=None)
    return _round(a.select("id", "cluster", "dist2"), {"dist2": D})


def q_kmeans_delta(spark, sf_dir):
    return _round(metrics.delta(P.points2d(spark, sf_dir), fx.CENTERS_2D), {"delta": D})


def q_cluster_cost(spark, sf_dir):
    return _round(metrics.cluster_cost(P.points2d(spark, sf_dir), fx.CENTERS_2D), {"cost": CD})


def q_fair_phi(spark, sf_dir):
    return _round(metrics.phi(P.points2d(spark, sf_dir), fx.CENTERS_2D), {"phi": D})


def q_fair_phi_nd(spark, sf_dir):
    return _round(metrics.phi(P.pointsnd(spark, sf_dir), fx.CENTERS_ND, cols=None), {"phi": D})


def q_group_cost(spark, sf_dir):
    g = metrics.group_cost(P.points2d(spark, sf_dir), fx.CENTERS_2D)
    return _round(g, {"cost": CD, "mean_cost": D})


def q_cluster_statistics(spark, sf_dir):
    return metrics.cluster_statistics(P.points2d(spark, sf_dir), fx.CENTERS_2D)


def q_cluster_group_stats(spark, sf_dir):
    s = fair.cluster_group_stats(P.points2d(spark, sf_dir), fx.CENTERS_2D)
    return _round(s, {"weight": D, "mean_x": D, "mean_y": D, "sse": CD})


# --- iterative clustering -------------------------------------------------------

def q_lloyd_2rounds(spark, sf_dir):
    c = cluster.lloyd_rounds(P.points2d(spark, sf_dir), fx.CENTERS_2D, 2)
    return _round(c, {"x": D, "y": D})


def q_fair_kmeans_1round(spark, sf_dir):
    f = fair.fair_round_frame(P.points2d(spark, sf_dir), fx.CENTERS_2D)
    return _round(f, {c: D for c in ("x", "y", "alpha", "beta", "ell", "shift")})


def q_init_centers(spark, sf_dir):
    pts = P.points2d(spark, sf_dir)
    cs = cluster.init_centers(pts, fx.KMEANS_K, fx.KMEANS_SEED, id_col="id")
    return _round(metrics.cluster_statistics(pts, cs), {"x": D, "y": D})


def q_kmeans_report(spark, sf_dir):
    pts = P.points2d(spark, sf_dir)
    cs = cluster.kmeans(pts, fx.KMEANS_K, fx.KMEANS_ITER, fx.KMEANS_SEED, id_col="id", tol=0.0)
    return _round(metrics.cluster_report(pts, cs), {"x": D, "y": D, "cost": CD})


def q_kmeans_summary(spark, sf_dir):
    return _round(metrics.summary(P.points2d(spark, sf_dir), fx.CENTERS_2D),
                  {"delta": D, "phi": D})


def q_cluster_report(spark, sf_dir):
    r = metrics.cluster_report(P.points2d(spark, sf_dir), fx.CENTERS_2D)
    return _round(r, {"cost": CD})


def q_lloyd_2rounds_nd(spark, sf_dir):
    c = cluster.lloyd_rounds(P.pointsnd(spark, sf_dir), fx.CENTERS_ND, 2, cols=None)
    return _round(c, {f"c{j}": D for j in range(fx.ND_DIMS)})


def q_fair_kmeans_1round_nd(spark, sf_dir):
    f = fair.fair_round_frame(P.pointsnd(spark, sf_dir), fx.CENTERS_ND, cols=None)
    return _round(f, {c: D for c in [f"c{j}" for j in range(fx.ND_DIMS)]
                      + ["alpha", "beta", "ell", "shift"]})


def q_compare_centers(spark, sf_dir):
    c = fair.compare_centers(P.points2d(spark, sf_dir), fx.KMEANS_K, fx.FAIR_ROUNDS,
                             fx.KMEANS_SEED, id_col="id", tol=0.0)
    return _round(c.drop("seconds_centers", "seconds_phi"), {"delta": D, "phi": D})


def clustering_queries() -> dict[str, Query]:
    return {
        "group_counts": q_group_counts,
        "parse_points_2d": q_parse_points_2d,
        "parse_points_nd": q_parse_points_nd,
        "assign_nearest": q_assign_nearest,
        "assign_nearest_nd": q_assign_nearest_nd,
        "kmeans_delta": q_kmeans_delta,
        "cluster_cost": q_cluster_cost,
        "fair_phi": q_fair_phi,
        "fair_phi_nd": q_fair_phi_nd,
        "group_cost": q_group_cost,
        "cluster_statistics": q_cluster_statistics,
        "cluster_group_stats": q_cluster_group_stats,
        "lloyd_2rounds": q_lloyd_2rounds,
        "fair_kmeans_1round": q_fair_kmeans_1round,
        "lloyd_2rounds_nd": q_lloyd_2rounds_nd,
        "fair_kmeans_1round_nd": q_fair_kmeans_1round_nd,
        "cluster_report": q_cluster_report,
        "kmeans_summary": q_kmeans_summary,
        "init_centers": q_init_centers,
        "kmeans_report": q_kmeans_report,
        "compare_centers": q_compare_centers,
    }


# --- more rounds, centres and widths ------------------------------------------------

def _fair_after(points, centers, rounds):
    f = fair.fair_round_frame(points, fair.fair_rounds(points, centers, rounds - 1))
    return _round(f, {c: D for c in ("x", "y", "alpha", "beta", "ell", "shift")})


def q_fair_kmeans_3rounds(spark, sf_dir):
    return _fair_after(P.points2d(spark, sf_dir), fx.CENTERS_2D, 3)


def q_fair_kmeans_edge(spark, sf_dir):
    """A cluster without group B and one without points, over two rounds."""
    return _fair_after(P.points2d_edge(spark, sf_dir, fx.EDGE_Y), fx.CENTERS_EDGE, 2)


def q_fair_vs_standard_fixed(spark, sf_dir):
    c = fair.compare_fixed(P.points2d(spark, sf_dir), fx.CENTERS_2D, fx.FAIR_ROUNDS)
    return _round(c, {"delta": D, "phi": D})


def q_assign_nearest_k500(spark, sf_dir):
    a = cluster.assign(P.points2d(spark, sf_dir), fx.CENTERS_K500, ("x", "y"))
    return _round(a.select("id", "cluster", "dist2"), {"dist2": D})


def q_assign_nearest_k5000(spark, sf_dir):
    """Nearest of 5,000 centres, with copies among them, through the tree of centres."""
    a = cluster.assign(P.points2d(spark, sf_dir), fx.CENTERS_K5000, ("x", "y"))
    return _round(a.select("id", "cluster", "dist2"), {"dist2": D})


def _assign_width(spark, sf_dir, dims):
    p = P.pointsnd(spark, sf_dir).withColumn("features", F.slice("features", 1, dims))
    a = cluster.assign(p, [c[:dims] for c in fx.CENTERS_ND], cols=None)
    return _round(a.select("id", "cluster", "dist2"), {"dist2": D})


def q_assign_nearest_d3(spark, sf_dir):
    return _assign_width(spark, sf_dir, 3)


def q_assign_nearest_d17(spark, sf_dir):
    return _assign_width(spark, sf_dir, 17)


def q_read_points_text(spark, sf_dir):
    """The points as a text file, every tenth line with a bad number: what is read
    back, by group, and the rejects, by reason."""
    path = scratch_path(spark, "point-lines")
    bad = F.regexp_replace("line", "^[^,]*", "x1")
    P.point_lines(spark, sf_dir).select(
        F.when(F.col("id") % 10 == 3, bad).otherwise(F.col("line")).alias("value")).write.text(path)
    good = P.read_points(spark, path, mode="DROPMALFORMED").groupBy("grp").agg(
        F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean_x"), F.avg("y").alias("mean_y"))
    lines = spark.read.text(path).withColumnRenamed("value", "line")
    nothing = F.lit(None).cast("double")
    rejects = P.malformed_lines(lines).groupBy(F.col("reason").alias("grp")).agg(
        F.count(F.lit(1)).alias("n"), nothing.alias("mean_x"), nothing.alias("mean_y"))
    return _round(good.unionByName(rejects), {"mean_x": D, "mean_y": D})


def q_kmeans_report_check(spark, sf_dir):
    """What holds for the k-means report whatever its start: K centres, all
    points counted, the per-cluster costs add up to Delta, which is not above
    that of the start."""
    pts = P.points2d(spark, sf_dir)
    start = cluster.init_centers(pts, fx.KMEANS_K, fx.KMEANS_SEED, id_col="id")
    end = cluster.kmeans(pts, fx.KMEANS_K, fx.KMEANS_ITER, fx.KMEANS_SEED, id_col="id")
    report = metrics.cluster_report(pts, end).agg(
        F.count(F.lit(1)).alias("n_centers"), F.sum("n").alias("n"), F.sum("cost").alias("cost"))
    before, after = (metrics.delta(pts, cs).select(F.col("delta").alias(name))
                     for cs, name in ((start, "before"), (end, "after")))
    one_row = report.crossJoin(before).crossJoin(after)         # three rows of one aggregate each
    return one_row.select(
        "n_centers", "n", (F.abs(F.col("cost") / F.col("n") - F.col("after")) <= F.col("after") * 1e-9)
        .alias("cost_adds_up"), (F.col("after") <= F.col("before")).alias("improved"))


def q_fair_rounds_any_order(spark, sf_dir):
    """Two fair rounds, their Delta and Phi on 3 and on 17 partitions: the centres, and
    whether every number agrees to the last bit."""
    pts, rounds = P.points2d(spark, sf_dir), []
    for parts in (3, 17):
        dealt = cluster.cache_points(pts, partitions=parts)
        try:
            grid = coordinate_grid(dealt, ("x", "y"))
            cs = fair.fair_rounds(dealt, fx.CENTERS_2D, 2, persist=False)
            costs = metrics.report(dealt, cs, grid=grid)
        finally:
            dealt.unpersist()
        rounds.append((cs, costs["delta"], costs["phi"]))
    same = rounds[0][1:] == rounds[1][1:]
    rows = [(i, *a, same and a == b) for i, (a, b) in enumerate(zip(rounds[0][0], rounds[1][0]))]
    return _round(spark.createDataFrame(rows, "cluster int, x double, y double, same_bits boolean"), {"x": D, "y": D})


def fixed_start_queries() -> dict[str, Query]:
    return {
        "fair_kmeans_3rounds": q_fair_kmeans_3rounds,
        "fair_kmeans_edge": q_fair_kmeans_edge,
        "fair_vs_standard_fixed": q_fair_vs_standard_fixed,
        "fair_rounds_any_order": q_fair_rounds_any_order,
        "assign_nearest_k500": q_assign_nearest_k500,
        "assign_nearest_k5000": q_assign_nearest_k5000,
        "assign_nearest_d3": q_assign_nearest_d3,
        "assign_nearest_d17": q_assign_nearest_d17,
        "read_points_text": q_read_points_text,
        "kmeans_report_check": q_kmeans_report_check,
    }


# --- sketches and heavy hitters ---------------------------------------------------


CM_SPEC = H.spec(fx.SKETCH_W, fx.CMS_PARAMS, p=fx.SKETCH_P)
CS_SPEC = H.spec(fx.SKETCH_W, fx.CS_PARAMS, fx.CS_SIGN_PARAMS, p=fx.SKETCH_P)
CS_SPEC_EVEN = H.spec(fx.SKETCH_W, fx.CS_PARAMS_EVEN, fx.CS_SIGN_PARAMS_EVEN, p=fx.SKETCH_P)


def q_cms_cells(spark, sf_dir):
    return sketch.cms_cells(I.skewed_items(spark, sf_dir), CM_SPEC)


def q_cs_cells(spark, sf_dir):
    return sketch.cs_cells(I.skewed_items(spark, sf_dir), CS_SPEC)


def q_cms_cells_wide(spark, sf_dir):
    """64-bit items of both signs: the hash family must not overflow."""
    return sketch.cms_cells(I.wide_items(spark, sf_dir, fx.WIDE_FACTOR), CM_SPEC)


def q_cs_cells_seeded(spark, sf_dir):
    """A seeded draw of the hash family on the same items."""
    return sketch.cs_cells(I.wide_items(spark, sf_dir, fx.WIDE_FACTOR), fx.SEEDED_CS)


def q_cms_estimate(spark, sf_dir):
    counts = topk.item_counts(I.skewed_items(spark, sf_dir))
    return sketch.cms_estimate(counts, sketch.cms_cells(counts, CM_SPEC, weight_col="cnt"), CM_SPEC)


def q_cs_estimate(spark, sf_dir):
    counts = topk.item_counts(I.skewed_items(spark, sf_dir))
    return sketch.cs_estimate(counts, sketch.cs_cells(counts, CS_SPEC, weight_col="cnt"), CS_SPEC)


def q_cs_estimate_even(spark, sf_dir):
    counts = topk.item_counts(I.skewed_items(spark, sf_dir))
    return sketch.cs_estimate(counts, sketch.cs_cells(counts, CS_SPEC_EVEN, weight_col="cnt"),
                              CS_SPEC_EVEN)


def q_item_counts(spark, sf_dir):
    return topk.item_counts(I.items(spark, sf_dir))


def q_kth_frequency(spark, sf_dir):
    return topk.kth_frequency(topk.item_counts(I.skewed_items(spark, sf_dir)), fx.TOP_K)


def q_heavy_hitters(spark, sf_dir):
    return topk.heavy_hitters(topk.item_counts(I.skewed_items(spark, sf_dir)), fx.TOP_K)


def q_heavy_hitters_flat(spark, sf_dir):
    return topk.heavy_hitters(topk.item_counts(I.items(spark, sf_dir)), fx.TOP_K)


def q_heavy_hitters_k1(spark, sf_dir):
    return topk.heavy_hitters(topk.item_counts(I.skewed_items(spark, sf_dir)), 1)


def q_heavy_hitters_all(spark, sf_dir):
    """K above the number of distinct items: every item is a hitter."""
    return topk.heavy_hitters(topk.item_counts(I.skewed_items(spark, sf_dir)), fx.TOP_K_ABOVE)


def q_hitter_listing(spark, sf_dir):
    counts = topk.item_counts(I.skewed_items(spark, sf_dir))
    return topk.hitter_listing(counts, fx.TOP_K, sketch.cms_cells(counts, CM_SPEC, weight_col="cnt"),
                               CM_SPEC)


CM = sketch.Sketch("cm", CM_SPEC)
CS = sketch.Sketch("cs", CS_SPEC, signed=True)


def q_sketch_error(spark, sf_dir):
    counts = topk.item_counts(I.skewed_items(spark, sf_dir))
    cells = sketch.build(counts, [CM, CS], weight_col="cnt")   # weighted adds, one scan
    e = topk.sketch_error(counts, fx.TOP_K, cells, CM, CS)
    return _round(e, {"cm_rel_err": D, "cs_rel_err": D})


def q_hitter_report(spark, sf_dir):
    r = topk.hitter_report(I.skewed_items(spark, sf_dir), fx.TOP_K, CM, CS)
    return _round(r, {"cm_rel_err": D, "cs_rel_err": D})


def q_distinct_summary(spark, sf_dir):
    return topk.distinct_summary(I.items(spark, sf_dir))


def sketch_queries() -> dict[str, Query]:
    return {
        "cms_cells": q_cms_cells,
        "cs_cells": q_cs_cells,
        "cms_cells_wide": q_cms_cells_wide,
        "cs_cells_seeded": q_cs_cells_seeded,
        "heavy_hitters_k1": q_heavy_hitters_k1,
        "heavy_hitters_all": q_heavy_hitters_all,
        "cms_estimate": q_cms_estimate,
        "cs_estimate": q_cs_estimate,
        "cs_estimate_even": q_cs_estimate_even,
        "item_counts": q_item_counts,
        "kth_frequency": q_kth_frequency,
        "heavy_hitters": q_heavy_hitters,
        "heavy_hitters_flat": q_heavy_hitters_flat,
        "hitter_listing": q_hitter_listing,
        "sketch_error": q_sketch_error,
        "hitter_report": q_hitter_report,
        "distinct_summary": q_distinct_summary,
    }


# --- streams ------------------------------------------------------------------------


_LANDED: dict[tuple, str] = {}


def _landing(spark, sf_dir, name, df, key):
    """A table replayed as a landing folder of ``STREAM_FILES`` files, written
    once per session and shared by every stream query that reads it (as
    several streaming queries share one landing area)."""
    k = (id(spark.sparkContext), sf_dir, name)
    if k not in _LANDED:
        _LANDED[k] = S.split_copy(df, key, fx.STREAM_FILES, scratch_path(spark, f"{name}-landing"))
    return _LANDED[k]


def _events_stream(spark, sf_dir):
    """The events' user ids as a file stream, one file per micro-batch."""
    ev = read_table(spark, sf_dir, "events").select(
        F.col("user_id").cast("bigint").alias("item"), "event_id")
    path = _landing(spark, sf_dir, "events", ev, "event_id")
    return S.file_stream(spark, path, "item bigint, event_id bigint, part int")


def _skewed_stream(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select(
        F.expr("1000 div (1 + l_partkey % 1000)").cast("bigint").alias("item"), "l_orderkey")
    path = _landing(spark, sf_dir, "lineitem", li, "l_orderkey")
    return S.file_stream(spark, path, "item bigint, l_orderkey bigint, part int")


def land_streams(spark, sf_dir):
    """Write the landing folders of the stream queries, so that timing them does not count it."""
    _events_stream(spark, sf_dir)
    _skewed_stream(spark, sf_dir)


def q_running_counts(spark, sf_dir):
    job = S.running_counts(_events_stream(spark, sf_dir)).wait()
    return S.counts_snapshot(spark, job.out)


def q_running_distinct(spark, sf_dir):
    job = S.running_distinct(_events_stream(spark, sf_dir)).wait()
    return S.distinct_snapshot(spark, job.out)


def q_stream_distinct_summary(spark, sf_dir):
    job = S.running_counts(_events_stream(spark, sf_dir)).wait()
    return S.stream_summary(spark, job.out)


def q_stream_distinct_estimate(spark, sf_dir):
    """Bounded-state distinct count (HyperLogLog++) of the events stream; the
    count is approximate, so this query has no SQL oracle."""
    job = S.distinct_estimate_stream(_events_stream(spark, sf_dir)).wait()
    return S.estimate_snapshot(spark, job.out)


def q_stream_distinct_estimate_check(spark, sf_dir):
    """The estimate's exact parts, and whether its count is within five standard
    deviations of the exact one."""
    job = S.distinct_estimate_stream(_events_stream(spark, sf_dir), fx.DISTINCT_RSD).wait()
    exact = topk.distinct_summary(I.items(spark, sf_dir)).select(F.col("n_distinct").alias("exact"))
    both = S.estimate_snapshot(spark, job.out).crossJoin(exact)         # one row each
    off = F.abs(F.col("n_distinct") - F.col("exact"))
    return both.select("n_items", "largest",
                       (off <= F.col("exact") * (5 * fx.DISTINCT_RSD)).alias("within_bound"))


def q_running_counts_compacted(spark, sf_dir):
    """The running histogram with a compaction after every second batch."""
    job = S.running_counts(_events_stream(spark, sf_dir), every=2).wait()
    return S.counts_snapshot(spark, job.out)


def q_running_distinct_compacted(spark, sf_dir):
    job = S.running_distinct(_events_stream(spark, sf_dir), every=2).wait()
    return S.distinct_snapshot(spark, job.out)


def q_stream_text_items(spark, sf_dir):
    """Items as lines of text, read on the 100 ms trigger until all have arrived."""
    k = (id(spark.sparkContext), sf_dir, "lines")
    if k not in _LANDED:
        ev = read_table(spark, sf_dir, "events").select("user_id", "event_id")
        _LANDED[k] = S.line_copy(ev, "user_id", "event_id", fx.STREAM_FILES, scratch_path(spark, "lines-landing"))
    items = I.parse_items(S.line_stream(spark, _LANDED[k]))
    job = S.running_counts(items, trigger=S.BATCH_INTERVAL).drain()
    return S.counts_snapshot(spark, job.out)


def q_stream_line_log(spark, sf_dir):
    """Items as lines of a landing log, in batches of a quarter of it at most, on the
    100 ms trigger."""
    k = (id(spark.sparkContext), sf_dir, "line-log")
    if k not in _LANDED:
        ev = read_table(spark, sf_dir, "events").select("user_id", "event_id")
        _LANDED[k] = linelog.log_copy(ev, "user_id", "event_id", fx.STREAM_FILES, scratch_path(spark, "line-log"))
    size = sum(n for _, n in linelog.segments(_LANDED[k]))
    lines = linelog.line_log_stream(spark, _LANDED[k], batch_bytes=max(1, size // 4))
    job = S.running_counts(I.parse_items(lines), trigger=S.BATCH_INTERVAL).drain()
    return S.counts_snapshot(spark, job.out)


def q_stream_heavy_hitters(spark, sf_dir):
    """The items above N / c of a skewed stream with their true counts, and whether the
    bounded summary has each of them within its bounds."""
    job = hitters.hitters_stream(_skewed_stream(spark, sf_dir), fx.HITTER_COUNTERS, fx.HITTER_BUCKETS).wait()
    found = hitters.hitters_snapshot(spark, job.out)
    exact = topk.item_counts(I.skewed_items(spark, sf_dir))
    total = exact.agg(F.sum("cnt")).scalar()
    heavy = exact.filter(F.col("cnt") * fx.HITTER_COUNTERS > total)
    within = (F.col("lower") <= F.col("cnt")) & (F.col("cnt") <= F.col("upper"))
    return heavy.join(found, "item", "left").select("item", "cnt", "n_items",
                                                    F.coalesce(within, F.lit(False)).alias("within_bounds"))


def q_stream_distinct_range(spark, sf_dir):
    """Batches 1 to 3 by their merged sketches: the length, and whether the distinct
    count is within five standard deviations of the exact one."""
    job = S.distinct_sketches(_events_stream(spark, sf_dir)).wait()
    ev = read_table(spark, sf_dir, "events").select(F.col("user_id").alias("item"), "event_id")
    landed = spark.read.parquet(_landing(spark, sf_dir, "events", ev, "event_id"))
    exact = topk.distinct_summary(landed.filter(F.col("part").between(1, 3))).select(F.col("n_distinct").alias("exact"))
    both = S.distinct_between(spark, job.out, 1, 3).crossJoin(exact)        # one row each
    off = F.abs(F.col("n_distinct") - F.col("exact"))
    return both.select("n_items", (off <= F.col("exact") * (5 * 1.04 / 2 ** (S.SKETCH_LG_K / 2))).alias("within_bound"))


def q_stream_report_log(spark, sf_dir):
    """The report of every batch in an exactly-once sink; the last one, and how many."""
    totals = S.read_items(_events_stream(spark, sf_dir)).agg(
        F.count("item").alias("n_items"), F.max("item").alias("largest"))
    job = sink.write_reports(totals).wait()
    log = sink.read_reports(spark, job.out, "n_items bigint, largest bigint")
    return log.agg(F.max_by("n_items", "batch").alias("n_items"), F.max_by("largest", "batch").alias("largest"),
                   F.count_distinct("batch").alias("n_reports"))


def q_stream_sketch_cells(spark, sf_dir):
    job = S.sketch_cells_stream(_skewed_stream(spark, sf_dir), CM).wait()
    return S.cells_snapshot(spark, job.out).drop("sketch")


def q_stream_cs_cells(spark, sf_dir):
    job = S.sketch_cells_stream(_skewed_stream(spark, sf_dir), CS).wait()
    return S.cells_snapshot(spark, job.out).drop("sketch")


def q_stream_prefix(spark, sf_dir):
    job = S.prefix(_events_stream(spark, sf_dir), fx.PREFIX_T).wait()
    return S.prefix_summary(spark, job.out)


def q_batch_sizes(spark, sf_dir):
    job = S.prefix(_events_stream(spark, sf_dir), None).wait()
    return S.batch_sizes(spark, job.out)


def q_batch_log(spark, sf_dir):
    """The batch log, its times as a fact: each batch at or after the one before."""
    job = S.prefix(_events_stream(spark, sf_dir), None).wait()
    log = S.batch_log(spark, job.out)                   # one row for each batch
    earlier = F.lag("batch_time").over(Window.orderBy("batch_id"))
    return log.select("batch_id", "n_rows",
                      (F.col("batch_time") >= F.coalesce(earlier, F.col("batch_time"))).alias("in_order"))


def q_stream_report(spark, sf_dir):
    """End-of-stream report: the stream's histogram feeds weighted sketch
    updates (each batch adds its item counts), then the heavy-hitter errors."""
    job = S.prefix(_skewed_stream(spark, sf_dir), None).wait()
    batch_counts = S.batch_counts(spark, job.out)        # item, cnt per batch
    cells = sketch.build(batch_counts, [CM, CS], weight_col="cnt")
    e = topk.sketch_error(S.prefix_counts(spark, job.out), fx.TOP_K, cells, CM, CS)
    return _round(e, {"cm_rel_err": D, "cs_rel_err": D})


def q_stream_hitter_report(spark, sf_dir):
    """Stop after at least T items, then the full report over what was read:
    the per-batch histograms give the exact counts and feed the sketches."""
    job = S.prefix(_events_stream(spark, sf_dir), fx.PREFIX_T).wait()
    batch_counts = S.batch_counts(spark, job.out)
    cells = sketch.build(batch_counts, [CM, CS], weight_col="cnt")
    r = topk.report_from_counts(S.prefix_counts(spark, job.out), fx.TOP_K, cells, CM, CS)
    return _round(r, {"cm_rel_err": D, "cs_rel_err": D})


def stream_queries() -> dict[str, Query]:
    return {
        "running_counts": q_running_counts,
        "running_distinct": q_running_distinct,
        "stream_distinct_summary": q_stream_distinct_summary,
        "stream_distinct_estimate": q_stream_distinct_estimate,
        "stream_distinct_estimate_check": q_stream_distinct_estimate_check,
        "running_counts_compacted": q_running_counts_compacted,
        "running_distinct_compacted": q_running_distinct_compacted,
        "stream_text_items": q_stream_text_items,
        "stream_line_log": q_stream_line_log,
        "stream_heavy_hitters": q_stream_heavy_hitters,
        "stream_distinct_range": q_stream_distinct_range,
        "stream_report_log": q_stream_report_log,
        "stream_sketch_cells": q_stream_sketch_cells,
        "stream_cs_cells": q_stream_cs_cells,
        "stream_prefix": q_stream_prefix,
        "batch_sizes": q_batch_sizes,
        "batch_log": q_batch_log,
        "stream_report": q_stream_report,
        "stream_hitter_report": q_stream_hitter_report,
    }


# --- synthetic points -----------------------------------------------------------------


def q_labelled_blobs(spark, sf_dir):
    """Blobs indexed by the order keys (0..N-1): points and coordinate sums (in
    units of the fourth decimal) of each cluster and label."""
    ids = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    n_total = ids.count()
    b = synth.labelled_blobs(ids, n_total, fx.KMEANS_K, seed=fx.KMEANS_SEED)
    return b.groupBy("grp", "cluster").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.round(F.col("x") * 10000).cast("bigint")).alias("sum_x"),
        F.sum(F.round(F.col("y") * 10000).cast("bigint")).alias("sum_y"))


def synth_queries() -> dict[str, Query]:
    return {"labelled_blobs": q_labelled_blobs}
