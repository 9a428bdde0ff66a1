import numpy as np
import pytest

from fairstream.operators import cluster, metrics
from fairstream.plans import fixtures as fx
from fairstream.sources import points as P
from tests.conftest import SF_SMALL


def test_ties_go_to_lowest_index(spark):
    df = spark.createDataFrame([(0.0, 0.0)], "x double, y double")
    r = cluster.assign(df, [[1, 0], [0, 1], [-1, 0]]).first()
    assert r["cluster"] == 0 and r["dist2"] == 1.0


def test_empty_or_bad_centres(spark):
    df = spark.createDataFrame([(0.0, 0.0)], "x double, y double")
    with pytest.raises(ValueError):
        cluster.assign(df, [])
    with pytest.raises(ValueError):
        cluster.assign(df, [[float("nan"), 0.0]])
    with pytest.raises(ValueError):
        cluster.assign(df, [[0.0, 0.0], [1.0]])


def test_assign_matches_numpy_2d_and_nd(spark):
    p2 = P.points2d(spark, SF_SMALL).orderBy("id").toPandas()
    got = cluster.assign(P.points2d(spark, SF_SMALL), fx.CENTERS_2D).orderBy("id").toPandas()
    X = p2[["x", "y"]].to_numpy()
    d = ((X[:, None, :] - np.array(fx.CENTERS_2D)[None]) ** 2).sum(-1)
    assert (got["cluster"].to_numpy() == d.argmin(1)).all()
    assert np.allclose(got["dist2"].to_numpy(), d.min(1), rtol=1e-12)

    pn = P.pointsnd(spark, SF_SMALL).orderBy("id").toPandas()
    gotn = cluster.assign(P.pointsnd(spark, SF_SMALL), fx.CENTERS_ND, cols=None) \
        .orderBy("id").toPandas()
    Xn = np.stack(pn["features"].to_numpy())
    dn = ((Xn[:, None, :] - np.array(fx.CENTERS_ND)[None]) ** 2).sum(-1)
    assert (gotn["cluster"].to_numpy() == dn.argmin(1)).all()
    assert np.allclose(gotn["dist2"].to_numpy(), dn.min(1), rtol=1e-12)


def test_lloyd_matches_numpy(spark):
    pts = P.points2d(spark, SF_SMALL)
    X = pts.toPandas()[["x", "y"]].to_numpy()
    C = np.array(fx.CENTERS_2D)
    for _ in range(3):
        lab = ((X[:, None, :] - C[None]) ** 2).sum(-1).argmin(1)
        C = np.array([X[lab == i].mean(0) if (lab == i).any() else C[i] for i in range(len(C))])
    got = cluster.lloyd(pts, fx.CENTERS_2D, 3)
    assert np.allclose(np.array(got), C, atol=1e-9)
    frame = cluster.lloyd_rounds(pts, fx.CENTERS_2D, 3).orderBy("cluster").toPandas()
    assert np.allclose(frame[["x", "y"]].to_numpy(), C, atol=1e-9)


def test_lloyd_keeps_empty_cluster(spark):
    df = spark.createDataFrame([(0.0, 0.0, "A"), (1.0, 0.0, "B")], "x double, y double, grp string")
    c = cluster.lloyd(df, [[0.5, 0.0], [100.0, 100.0]], 2)
    assert c == [[0.5, 0.0], [100.0, 100.0]]
    f = cluster.lloyd_rounds(df, [[0.5, 0.0], [100.0, 100.0]], 1).orderBy("cluster").collect()
    assert [(r["cluster"], r["n"]) for r in f] == [(0, 2), (1, 0)]


def test_kmeans_seeded_and_init(spark):
    pts = P.points2d(spark, SF_SMALL)
    a = cluster.kmeans(pts, 4, 5, seed=1)
    b = cluster.kmeans(pts, 4, 5, seed=1)
    assert a == b and len(a) == 4
    init = cluster.init_centers(pts, 4, seed=1)
    assert len(init) == 4
    # Lloyd does not increase the cost of its start
    d0 = metrics.report(pts, init)["delta"]
    d1 = metrics.report(pts, cluster.lloyd(pts, init, 3))["delta"]
    assert d1 <= d0 + 1e-9
    with pytest.raises(ValueError):
        cluster.kmeans(pts, 0, 5, seed=1)


def test_pandas_path_matches_columns(spark):
    rows = [(0, [0.0, 0.0], "A"), (1, [5.0, 5.0], "B"), (2, [float("nan"), 1.0], "A"),
            (3, [2.0, 2.0], "B")]
    df = spark.createDataFrame(rows, "id long, features array<double>, grp string")
    cs = [[1.0, 0.0], [0.0, 1.0], [-1.0, 0.0], [5.0, 5.0]]
    a = {r["id"]: (r["cluster"], r["dist2"], r["grp"]) for r in
         cluster.assign(df, cs, cols=None, method="pandas", finite=False).collect()}
    b = {r["id"]: (r["cluster"], r["dist2"], r["grp"]) for r in
         cluster.assign(df, cs, cols=None, method="columns", finite=False).collect()}
    assert a[0] == b[0] == (0, 1.0, "A")          # tie between three centres: lowest index
    assert a[1] == b[1] == (3, 0.0, "B")
    assert a[3] == b[3]
    assert a[2][0] == b[2][0] == 0                # all distances NaN: first centre
    with pytest.raises(ValueError):
        cluster.assign(df, cs, cols=None, method="fast")


def test_lloyd_nd_matches_numpy(spark):
    pts = P.pointsnd(spark, SF_SMALL)
    X = np.stack(pts.toPandas()["features"].to_numpy())
    C = np.array(fx.CENTERS_ND)
    for _ in range(2):
        lab = ((X[:, None, :] - C[None]) ** 2).sum(-1).argmin(1)
        C = np.array([X[lab == i].mean(0) if (lab == i).any() else C[i] for i in range(len(C))])
    frame = cluster.lloyd_rounds(pts, fx.CENTERS_ND, 2, cols=None).orderBy("cluster").toPandas()
    assert np.allclose(frame[[f"c{j}" for j in range(fx.ND_DIMS)]].to_numpy(), C, atol=1e-12)


def test_non_finite_points_are_rejected(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [float("nan"), 1.0])],
                               "id long, features array<double>")
    for method in ("columns", "pandas"):
        with pytest.raises(Exception):
            cluster.assign(df, [[1.0, 0.0]], cols=None, method=method).collect()
    inf = spark.createDataFrame([(float("inf"), 0.0)], "x double, y double")
    with pytest.raises(Exception):
        cluster.assign(inf, [[1.0, 0.0]]).collect()


@pytest.mark.parametrize(("dims", "k"), [(2, 5000), (3, 700), (16, 300), (64, 64)])
def test_tree_of_centres_equals_the_plain_scan(dims, k):
    rnd = np.random.default_rng(dims)
    centers = np.round(rnd.uniform(-5, 5, (k, dims)), 1)           # a coarse grid: many ties
    centers[k // 2:k // 2 + 20] = centers[:20]
    x = np.concatenate([np.round(rnd.uniform(-6, 6, (3000, dims)), 1), centers[:200], rnd.normal(0, 40, (50, dims))])
    counted = []
    got = cluster.nearest_rows(x, centers, tree_from=2, counted=counted)
    want = cluster.nearest_rows(x, centers, tree_from=k + 1)
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all()
    if dims == 2:
        assert sum(counted) < 0.1 * len(x) * k


def test_tree_of_centres_with_odd_points():
    centers = np.array([[0.0, 0.0], [1.0, 1.0], [1.0, 1.0], [5.0, 5.0]])
    x = np.array([[1.0, 1.0], [np.nan, 1.0], [np.inf, 0.0], [0.5, 0.5]])
    with np.errstate(invalid="ignore"):
        got, want = cluster.nearest_rows(x, centers, tree_from=2), cluster.nearest_rows(x, centers, tree_from=9)
    assert got[0].tolist() == want[0].tolist() == [1, 0, 0, 0]
    assert len(cluster.nearest_rows(x[:0], centers, tree_from=2)[0]) == 0
