"""Exact frequencies, top-K heavy hitters with ties, and the sketch error report.

The K-th largest frequency comes from the table of frequencies (how many items
have each count, at most sqrt(2N) rows) and enters the filter as a scalar
subquery, so no sort or window runs over the distinct items.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fairstream.functions.hashing import SketchSpec
from fairstream.operators import sketch


def item_counts(items: DataFrame, item_col: str = "item") -> DataFrame:
    """Exact histogram ``item, cnt`` (partial counts are combined map-side, so a
    hot item costs one row per task in the shuffle)."""
    return items.groupBy(F.col(item_col).alias("item")).agg(F.count(F.lit(1)).alias("cnt"))


def _check_k(k: int) -> None:
    if k < 1:
        raise ValueError("K must be >= 1")


def kth_frequency(counts: DataFrame, k: int) -> DataFrame:
    """One row ``phi_k``: the K-th largest count (the smallest one if K exceeds
    the number of distinct items; null for an empty input).

    One route for every K: count how many items have each count value. The
    counts sum to N, so there are at most sqrt(2N) distinct values, and a
    running sum over that small table finds the largest value that at least K
    items reach.
    """
    _check_k(k)
    fof = counts.groupBy("cnt").agg(F.count(F.lit(1)).alias("items"))   # <= sqrt(2N) rows
    reach = fof.withColumn(
        "at_least", F.sum("items").over(Window.orderBy(F.col("cnt").desc())))
    hit = reach.filter(F.col("at_least") >= k).agg(F.max("cnt").alias("phi_k"))
    # K beyond the number of distinct items: every item counts, phi is the minimum
    return hit.select(F.coalesce(F.col("phi_k"), F.lit(fof.agg(F.min("cnt")).scalar()))
                      .alias("phi_k"))


def heavy_hitters(counts: DataFrame, k: int) -> DataFrame:
    """All items with count >= phi_K (ties included, so possibly more than K)."""
    phi = kth_frequency(counts, k).scalar()
    return counts.filter(F.col("cnt") >= phi)


def hitter_listing(counts: DataFrame, k: int, cm_cells: DataFrame,
                   cm_spec: SketchSpec) -> DataFrame:
    """Heavy hitters with their count-min estimate, sorted by item:
    ``item, cnt, cm_est``."""
    hh = heavy_hitters(counts, k)
    est = sketch.cms_estimate(hh, cm_cells, cm_spec).withColumnRenamed("est", "cm_est")
    return est.select("item", "cnt", "cm_est").orderBy("item")


def sketch_error(counts: DataFrame, k: int, cells: DataFrame,
                 cm: sketch.Sketch, cs: sketch.Sketch) -> DataFrame:
    """Mean relative error over the heavy hitters, one row: ``n_hitters``,
    ``cm_rel_err`` (signed, (est - true) / true) and ``cs_rel_err`` (absolute,
    |est - true| / true). ``cells`` holds both sketches (``sketch.build``); the
    hitters read them by index."""
    est = sketch.estimate(heavy_hitters(counts, k), cells, [cm, cs])
    true = F.col("cnt")
    return est.agg(
        F.count(F.lit(1)).alias("n_hitters"),
        F.avg((F.col(f"{cm.name}_est") - true) / true).alias("cm_rel_err"),
        F.avg(F.abs(F.col(f"{cs.name}_est") - true) / true).alias("cs_rel_err"),
    )


def hitter_report(items: DataFrame, k: int, cm: sketch.Sketch, cs: sketch.Sketch,
                  cells: DataFrame | None = None, item_col: str = "item") -> DataFrame:
    """The end-of-stream report in one row: ``n_items, n_distinct, phi_k,
    n_hitters, cm_rel_err, cs_rel_err``.

    The exact histogram is built once. Unless ``cells`` are given, both
    sketches are filled from it with weighted adds (each distinct item adds its
    count once, as a per-batch update does), so the input is scanned once and
    only distinct items are exploded."""
    counts = item_counts(items, item_col)
    if cells is None:
        cells = sketch.build(counts, [cm, cs], weight_col="cnt")
    return report_from_counts(counts, k, cells, cm, cs)


def report_from_counts(counts: DataFrame, k: int, cells: DataFrame, cm: sketch.Sketch,
                       cs: sketch.Sketch) -> DataFrame:
    """``hitter_report`` from an exact histogram (``item, cnt``) and the cells.
    The error row is the main plan; the totals and the threshold are scalar
    subqueries over the same histogram, whose exchange Spark reuses."""
    err = sketch_error(counts, k, cells, cm, cs)
    n_items = counts.agg(F.sum("cnt").cast("bigint")).scalar()
    n_distinct = counts.agg(F.count(F.lit(1))).scalar()
    phi = kth_frequency(counts, k).scalar()
    return err.select(n_items.alias("n_items"), n_distinct.alias("n_distinct"),
                      phi.alias("phi_k"), "n_hitters", "cm_rel_err", "cs_rel_err")


def distinct_summary(items: DataFrame, item_col: str = "item", approx: bool = False,
                     rsd: float = 0.01) -> DataFrame:
    """``n_items, n_distinct, largest``: stream length, distinct count and the
    largest distinct item (null when empty). The exact count is a two-level
    aggregate (items are deduplicated map-side, then counted); ``approx=True``
    uses a HyperLogLog++ sketch of relative error ``rsd`` instead, whose state
    per task is fixed whatever the number of distinct items."""
    c = F.col(item_col)
    n_distinct = F.approx_count_distinct(c, rsd) if approx else F.count_distinct(c)
    return items.agg(
        F.count(c).alias("n_items"),
        n_distinct.alias("n_distinct"),
        F.max(c).alias("largest"),
    )
