import numpy as np
import pytest

from fairstream.operators import metrics
from fairstream.plans import fixtures as fx
from fairstream.sources import points as P
from tests.conftest import SF_SMALL


def _np(spark):
    pdf = P.points2d(spark, SF_SMALL).toPandas()
    X, g = pdf[["x", "y"]].to_numpy(), pdf["grp"].to_numpy()
    d = ((X[:, None, :] - np.array(fx.CENTERS_2D)[None]) ** 2).sum(-1)
    return X, g, d.argmin(1), d.min(1)


def test_delta_phi_report(spark):
    X, g, lab, dist = _np(spark)
    pts = P.points2d(spark, SF_SMALL)
    assert metrics.delta(pts, fx.CENTERS_2D).first()["delta"] == pytest.approx(dist.mean(), rel=1e-12)
    phi = max(dist[g == "A"].mean(), dist[g == "B"].mean())
    assert metrics.phi(pts, fx.CENTERS_2D).first()["phi"] == pytest.approx(phi, rel=1e-12)
    rep = metrics.report(pts, fx.CENTERS_2D)
    assert rep["n"] == len(X) and rep["n_a"] == (g == "A").sum()
    assert rep["phi"] == pytest.approx(phi, rel=1e-12)
    stats = {r["cluster"]: (r["n_a"], r["n_b"])
             for r in metrics.cluster_statistics(pts, fx.CENTERS_2D).collect()}
    for i, (na, nb) in stats.items():
        assert na == ((lab == i) & (g == "A")).sum() and nb == ((lab == i) & (g != "A")).sum()


def test_other_labels(spark):
    rows = [(0.0, 0.0, "A"), (1.0, 0.0, "B"), (0.0, 1.0, "C")]
    pts = spark.createDataFrame(rows, "x double, y double, grp string")
    st = metrics.cluster_statistics(pts, [[0.0, 0.0]]).first()
    assert (st["n_a"], st["n_b"]) == (1, 2)          # C counts as B in the statistics
    assert metrics.phi(pts, [[0.0, 0.0]]).first()["phi"] == 1.0   # C ignored in Phi
    assert metrics.delta(pts, [[0.0, 0.0]]).first()["delta"] == pytest.approx(2 / 3)
    gc = P.group_counts(pts).first()
    assert (gc["n"], gc["n_a"], gc["n_b"]) == (3, 1, 1)


def test_phi_needs_both_groups(spark):
    pts = spark.createDataFrame([(0.0, 0.0, "A")], "x double, y double, grp string")
    with pytest.raises(Exception):
        metrics.phi(pts, [[0.0, 0.0]]).collect()
    with pytest.raises(ValueError):
        metrics.report(pts, [[0.0, 0.0]])
