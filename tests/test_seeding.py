"""The keyed start and the sums that no partitioning changes."""
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fairstream.functions.exact import Grid, coordinate_grid
from fairstream.operators import cluster, fair, metrics, seeding
from fairstream.plans import fixtures as fx
from fairstream.sources import points as P
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("rows", [500, 10 ** 6, 2 ** 36])
def test_grid_sums_equal_exact_sums(rows):
    rnd = random.Random(rows)
    values = np.array([rnd.uniform(-300, 300) * 10 ** rnd.randint(-6, 0) for _ in range(400)] + [299.9, -299.9, 0.0])
    grid = Grid(9, rows)
    assert sum(grid.widths) >= 63 and max(grid.widths) + rows.bit_length() <= 63
    total = grid.total([int(v) for v in grid.split(values).sum(0)])
    assert total == pytest.approx(math.fsum(values), abs=len(values) * 2.0 ** (9 - 62))
    shuffled = np.random.default_rng(1).permutation(values)
    assert total == grid.total([int(v) for v in grid.split(shuffled).sum(0)])


def same_on(points, work):
    results = [work(points.repartition(n)) for n in (4, 8, 13)]
    assert results[0] == results[1] == results[2]
    return results[0]


def test_start_and_fit_do_not_depend_on_partitions(spark):
    pts = P.points2d(spark, SF_SMALL)
    same_on(pts, lambda p: cluster.init_centers(p, 4, 42, id_col="id"))
    start = same_on(pts, lambda p: cluster.init_centers(p, 4, 42))           # told apart by coordinates
    known = {(r["x"], r["y"]) for r in pts.collect()}
    assert len(start) == 4 and all(tuple(c) in known for c in start)
    fit = same_on(pts, lambda p: cluster.kmeans(p, 4, 8, 42, id_col="id"))
    assert metrics.report(pts, fit)["delta"] <= metrics.report(pts, start)["delta"]
    same_on(pts, lambda p: fair.fair_kmeans(p, 3, 2, 7, id_col="id"))
    assert cluster.init_centers(pts, 4, 42) != cluster.init_centers(pts, 4, 43)


def test_start_of_wide_points(spark):
    pts = P.pointsnd(spark, SF_SMALL)
    centers = same_on(pts, lambda p: cluster.kmeans(p, 5, 3, 1, cols=None))
    assert len(centers) == 5 and len(centers[0]) == 64


def test_start_prefers_far_points_and_counts_copies(spark):
    rows = [(float(x), 0.0) for x in [0] * 500 + [1] * 300 + [1000]]
    df = spark.createDataFrame(rows, "x double, y double")
    for seed in range(6):
        centers = cluster.init_centers(df, 2, seed)
        assert [1000.0, 0.0] in centers                     # nearly all the squared distance
    for seed in range(4):                                   # driver and Spark draw alike
        drawn = spark.range(1).select(seeding.uniform(f"{seed}:0", F.lit(17)).alias("u")).first()["u"]
        assert drawn == seeding.uniform_of(f"{seed}:0", 17)


def test_fewer_distinct_points_than_centres(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 0.0), (3.0, 4.0)], "x double, y double")
    assert sorted(cluster.init_centers(df, 5, 1)) == [[0.0, 0.0], [3.0, 4.0]]
    with pytest.raises(ValueError):
        cluster.init_centers(df.limit(0), 2, 1)


def test_race_is_drawn_in_proportion_to_weights():
    wins = sum(min((-math.log(seeding.uniform_of(f"{s}:0", i)) / w, i) for i, w in ((1, 1.0), (2, 3.0)))[1] == 2
               for s in range(4000))
    assert 0.71 < wins / 4000 < 0.79


def test_exact_groups_match_numpy(spark):
    for pts, cols, cs in ((P.points2d(spark, SF_SMALL), ("x", "y"), fx.CENTERS_2D),
                          (P.pointsnd(spark, SF_SMALL), None, fx.CENTERS_ND)):
        data = pts.collect()
        x = np.array([[r["x"], r["y"]] if cols else r["features"] for r in data])
        near, dist = cluster.nearest_rows(x, np.array(cs))
        grid = coordinate_grid(pts, cols)
        for g in cluster.exact_groups(pts.repartition(5), cs, grid, cols, label="grp"):
            mine = [i for i, r in enumerate(data) if near[i] == g["cluster"] and r["grp"] == g["label"]]
            assert g["n"] == len(mine)
            assert g["cost"] == pytest.approx(math.fsum(dist[mine]), rel=1e-14)
            assert g["sums"] == pytest.approx([math.fsum(c) for c in x[mine].T], rel=1e-12, abs=1e-12)


def test_exact_fair_rows_match_the_aggregate(spark):
    pts = P.points2d(spark, SF_SMALL)
    rows = fair.exact_group_rows(pts, fx.CENTERS_2D, coordinate_grid(pts, ("x", "y")), ["x", "y"])
    want = {(r["cluster"], r["grp"]): r for r in fair.cluster_group_stats(pts, fx.CENTERS_2D).collect()}
    assert len(rows) == len(want)
    for r in rows:
        w = want[r["cluster"], r["grp"]]
        assert (r["n"], r["sse"], r["mean_x"]) == pytest.approx((w["n"], w["sse"], w["mean_x"]), rel=1e-9)


def test_non_finite_and_null_labels(spark):
    bad = spark.createDataFrame([(float("nan"), 0.0)], "x double, y double")
    with pytest.raises(ValueError):
        coordinate_grid(bad, ("x", "y"))
    df = spark.createDataFrame([(1.0, 2.0, None), (3.0, 4.0, "A")], "x double, y double, grp string")
    groups = cluster.exact_groups(df, [[0.0, 0.0]], coordinate_grid(df, ("x", "y")), label="grp")
    assert {g["label"]: g["n"] for g in groups} == {None: 1, "A": 1}


def test_assign_keeps_every_column(spark):
    df = spark.createDataFrame([(0.0, 1.0, "a", "b")], "x double, y double, _nc string, _NC_ string")
    for method in ("columns", "pandas"):
        r = cluster.assign(df, [[0.0, 0.0]], method=method).first()
        assert (r["_nc"], r["_NC_"], r["cluster"], r["dist2"]) == ("a", "b", 0, 1.0)
    plan = cluster.assign(df, [[0.0, 0.0]])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
