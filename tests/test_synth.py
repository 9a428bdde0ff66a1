import pytest
from pyspark.sql import functions as F

from fairstream.sources import synth


def test_blobs_labels_and_remainder(spark):
    ids = spark.range(0, 103)
    b = synth.labelled_blobs(ids, 103, 5, seed=1)      # n = 10 per group per cluster
    counts = {(r["grp"], r["cluster"]): r["n"] for r in
              b.groupBy("grp", "cluster").agg(F.count("*").alias("n")).collect()}
    for c in range(5):
        assert counts[("A", c)] == 10 and counts[("B", c)] == 10
    assert counts[("A", -1)] == 3
    m = b.filter("cluster = 2 and grp = 'B'").agg(F.avg("x"), F.avg("y")).first()
    assert m[0] == pytest.approx(30.0, abs=1.0) and m[1] == pytest.approx(10.0, abs=1.0)
    line = synth.to_lines(b).first()["line"]
    assert line.count(",") == 2 and len(line.split(",")[0].split(".")[1]) == 4
