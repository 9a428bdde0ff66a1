"""Clustering costs and group reports, all derived from one grouped table.

``cluster_group_table`` assigns every point once and aggregates to one row
per (cluster, label): at most K x (number of labels) rows. Delta, Phi, the
per-cluster costs and the A/B statistics are all small computations on that
table, so a full report costs one scan and one tiny shuffle (partial
aggregation happens before the exchange, whatever the skew of the labels).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairstream.functions.distance import check_centers
from fairstream.functions.exact import Grid
from fairstream.operators.cluster import assign, exact_groups
from fairstream.sources.points import GROUP_A, GROUP_B


def cluster_group_table(points: DataFrame, centers: Sequence[Sequence[float]],
                        cols: Sequence[str] | None = ("x", "y"),
                        features: str = "features") -> DataFrame:
    """``cluster int, grp string, n bigint, cost double`` (cost = sum of dist2)."""
    a = assign(points.select(*(list(cols) if cols else [features]), "grp"), centers, cols, features)
    return a.groupBy("cluster", "grp").agg(F.count(F.lit(1)).alias("n"),
                                          F.sum("dist2").alias("cost"))


def delta(points: DataFrame, centers, cols=("x", "y"), features="features") -> DataFrame:
    """Standard objective: mean squared distance to the nearest centre (one row ``delta``)."""
    t = cluster_group_table(points, centers, cols, features)
    return t.agg((F.sum("cost") / F.sum("n")).alias("delta"))


def cluster_cost(points: DataFrame, centers, cols=("x", "y"), features="features") -> DataFrame:
    """Per cluster: ``cluster, n, cost`` (the sum that Delta divides by N)."""
    t = cluster_group_table(points, centers, cols, features)
    return t.groupBy("cluster").agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"))


def group_cost(points: DataFrame, centers, cols=("x", "y"), features="features") -> DataFrame:
    """Per group A and B: ``grp, n, cost, mean_cost``. Other labels are left out."""
    t = cluster_group_table(points, centers, cols, features)
    return (t.filter(F.col("grp").isin(GROUP_A, GROUP_B))
            .groupBy("grp")
            .agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"))
            .withColumn("mean_cost", F.col("cost") / F.col("n")))


def phi_from_table(t: DataFrame) -> DataFrame:
    """Phi from a cluster x group table; fails at run time if A or B is empty."""
    s = t.agg(
        F.sum(F.when(F.col("grp") == GROUP_A, F.col("n")).otherwise(0)).alias("n_a"),
        F.sum(F.when(F.col("grp") == GROUP_B, F.col("n")).otherwise(0)).alias("n_b"),
        F.sum(F.when(F.col("grp") == GROUP_A, F.col("cost")).otherwise(0.0)).alias("cost_a"),
        F.sum(F.when(F.col("grp") == GROUP_B, F.col("cost")).otherwise(0.0)).alias("cost_b"),
    )
    empty = F.coalesce(F.col("n_a"), F.lit(0)).eqNullSafe(0) | F.coalesce(F.col("n_b"), F.lit(0)).eqNullSafe(0)
    value = F.greatest(F.col("cost_a") / F.col("n_a"), F.col("cost_b") / F.col("n_b"))
    return s.select(
        F.when(empty, F.raise_error(F.lit("fairness cannot be computed: one group has no points")))
        .otherwise(value).cast("double").alias("phi"))


def phi(points: DataFrame, centers, cols=("x", "y"), features="features") -> DataFrame:
    """Fair objective: max over A, B of the group's mean squared distance (one row ``phi``)."""
    return phi_from_table(cluster_group_table(points, centers, cols, features))


def cluster_statistics(points: DataFrame, centers, cols=("x", "y"),
                       features="features") -> DataFrame:
    """Per cluster: ``cluster, <centre coords>, n_a, n_b``, sorted by cluster.

    A label other than A counts as B, and clusters without points have no row,
    as in the reference's report. Centre coordinates are looked up from literal
    arrays by cluster index: no join.
    """
    cs = check_centers(centers)
    dims = len(cs[0])
    names = list(cols) if cols else [f"c{j}" for j in range(dims)]
    t = cluster_group_table(points, cs, cols, features)
    g = t.groupBy("cluster").agg(
        F.sum(F.when(F.col("grp") == GROUP_A, F.col("n")).otherwise(0)).alias("n_a"),
        F.sum(F.when(F.col("grp").eqNullSafe(GROUP_A), 0).otherwise(F.col("n"))).alias("n_b"),
    )
    coord = [F.array(*[F.lit(c[j]) for c in cs])[F.col("cluster")].alias(names[j])
             for j in range(dims)]
    return g.select("cluster", *coord, "n_a", "n_b").orderBy("cluster")


def cluster_report(points: DataFrame, centers, cols=("x", "y"),
                   features="features") -> DataFrame:
    """Per cluster, from one aggregate: ``cluster, <centre coords>, n, n_a, n_b,
    cost`` (n_b counts every label other than A, as the statistics do)."""
    cs = check_centers(centers)
    dims = len(cs[0])
    names = list(cols) if cols else [f"c{j}" for j in range(dims)]
    t = cluster_group_table(points, cs, cols, features)
    g = t.groupBy("cluster").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("grp") == GROUP_A, F.col("n")).otherwise(0)).alias("n_a"),
        F.sum(F.when(F.col("grp").eqNullSafe(GROUP_A), 0).otherwise(F.col("n"))).alias("n_b"),
        F.sum("cost").alias("cost"),
    )
    coord = [F.array(*[F.lit(c[j]) for c in cs])[F.col("cluster")].alias(names[j])
             for j in range(dims)]
    return g.select("cluster", *coord, "n", "n_a", "n_b", "cost")


def summary(points: DataFrame, centers, cols=("x", "y"), features="features") -> DataFrame:
    """One row ``n, n_a, n_b, delta, phi`` from one grouped table (one scan,
    one shuffle of at most K x labels partial rows per task)."""
    t = cluster_group_table(points, centers, cols, features)
    s = t.agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("grp") == GROUP_A, F.col("n")).otherwise(0)).alias("n_a"),
        F.sum(F.when(F.col("grp") == GROUP_B, F.col("n")).otherwise(0)).alias("n_b"),
        F.sum("cost").alias("cost"),
        F.sum(F.when(F.col("grp") == GROUP_A, F.col("cost")).otherwise(0.0)).alias("cost_a"),
        F.sum(F.when(F.col("grp") == GROUP_B, F.col("cost")).otherwise(0.0)).alias("cost_b"),
    )
    empty = F.coalesce(F.least("n_a", "n_b"), F.lit(0)) == 0
    phi_value = F.greatest(F.col("cost_a") / F.col("n_a"), F.col("cost_b") / F.col("n_b"))
    return s.select(
        "n", "n_a", "n_b", (F.col("cost") / F.col("n")).alias("delta"),
        F.when(empty, F.raise_error(F.lit("fairness cannot be computed: one group has no points")))
        .otherwise(phi_value).cast("double").alias("phi"))


def report(points: DataFrame, centers, cols=("x", "y"), features="features", grid: Grid | None = None) -> dict:
    """All costs of one centre set from one job: N, NA, NB, Delta, Phi, per-cluster rows.

    The grouped table (at most K x labels rows) is the only thing collected. With
    ``grid`` (``exact.coordinate_grid``) no partitioning changes a bit of the costs.
    """
    if grid:
        rows = [{**g, "grp": g["label"]} for g in exact_groups(points, centers, grid, cols, features, "grp")]
    else:
        rows = cluster_group_table(points, centers, cols, features).collect()
    n = sum(r["n"] for r in rows)
    n_a = sum(r["n"] for r in rows if r["grp"] == GROUP_A)
    n_b = sum(r["n"] for r in rows if r["grp"] == GROUP_B)
    cost = sum(r["cost"] for r in rows)
    cost_a = sum(r["cost"] for r in rows if r["grp"] == GROUP_A)
    cost_b = sum(r["cost"] for r in rows if r["grp"] == GROUP_B)
    if n_a == 0 or n_b == 0:
        raise ValueError(f"fairness cannot be computed: NA={n_a}, NB={n_b}")
    per_cluster: dict[int, dict] = {}
    for r in rows:
        d = per_cluster.setdefault(r["cluster"], {"n_a": 0, "n_b": 0, "cost": 0.0})
        d["n_a" if r["grp"] == GROUP_A else "n_b"] += r["n"]
        d["cost"] += r["cost"]
    return {"n": n, "n_a": n_a, "n_b": n_b, "delta": cost / n,
            "phi": max(cost_a / n_a, cost_b / n_b),
            "clusters": dict(sorted(per_cluster.items()))}
