"""The program-level functions, end to end on files and streams made from the tables."""
import pytest
from pyspark.sql import functions as F

from fairstream.plans import programs
from fairstream.session import scratch_path
from fairstream.sources import points as P
from fairstream.sources.tables import read_table
from fairstream.streaming import stream as S
from tests.conftest import SF_MID, SF_SMALL


def _points_file(spark):
    path = scratch_path(spark, "t-points")
    P.point_lines(spark, SF_SMALL).select("line").write.text(path)
    return path


def test_kmeans_report_job(spark):
    rep = programs.kmeans_report_job(spark, _points_file(spark), 4, 3, 5, seed=1)
    assert rep.n == 1500 and rep.n_a + rep.n_b == 1500 and len(rep.centers) == 3
    assert sum(c["n_a"] + c["n_b"] for c in rep.clusters) == 1500
    assert rep.phi >= 0 and rep.delta >= 0
    with pytest.raises(ValueError):
        programs.kmeans_report_job(spark, _points_file(spark), 4, 0, 5, seed=1)


def test_fair_comparison_job(spark):
    cmp = programs.fair_comparison_job(spark, _points_file(spark), None, 3, 2, seed=1, dims=2)
    assert len(cmp.standard) == len(cmp.fair) == 3
    assert set(cmp.ms) == {"standard_centers", "standard_phi", "fair_centers", "fair_phi"}


def test_stream_programs(spark):
    ev = read_table(spark, SF_MID, "events").select(F.col("user_id").alias("item"), "event_id")
    path = S.split_copy(ev, "event_id", 5, scratch_path(spark, "t-prog"))
    schema = "item bigint, event_id bigint, part int"
    rep = programs.heavy_hitters_job(S.file_stream(spark, path, schema), 5000, 5, 50, 5, seed=3)
    assert rep.n_items == 6000 and rep.n_hitters >= 5 and rep.listing.count() == rep.n_hitters
    assert all(est >= true for _, true, est in rep.listing.collect())      # count-min never under
    d = programs.distinct_items_job(S.file_stream(spark, path, schema), 5000)
    assert d["n_items"] == 6000 and d["batch_sizes"] == [(0, 2000), (1, 2000), (2, 2000)]


def test_write_blobs(spark):
    path = programs.write_blobs(spark, 101, 5, scratch_path(spark, "t-blobs"), seed=7)
    pts = P.read_points(spark, path)
    assert pts.count() == 101
    assert P.group_counts(pts).first()["n_b"] == 50


def test_fair_comparison_job_nd(spark):
    path = scratch_path(spark, "t-nd-points")
    P.nd_lines(spark, SF_SMALL).select("line").write.text(path)
    cmp = programs.fair_comparison_job(spark, path, 2, 3, 2, seed=4, dims=None)
    assert len(cmp.fair) == 3 and all(len(c) == 64 for c in cmp.fair)
    assert cmp.n == cmp.n_a + cmp.n_b and cmp.phi_fair > 0
