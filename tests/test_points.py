import pytest

from fairstream.sources import points as P


def test_parse_2d(spark):
    lines = spark.createDataFrame([("1.5, 2.5 , A",), ("3,4,B,extra",), ("5,6,A,",), ("7,8, Bx",)],
                                  "line string")
    got = [tuple(r) for r in P.parse_points(lines).collect()]
    assert got == [(1.5, 2.5, "A"), (3.0, 4.0, "B"), (5.0, 6.0, "A"), (7.0, 8.0, "B")]


def test_parse_nd(spark):
    lines = spark.createDataFrame([("1,2,3,A",), ("4,5,B",)], "line string")
    got = [(list(r["features"]), r["grp"]) for r in P.parse_points(lines, dims=None).collect()]
    assert got == [([1.0, 2.0, 3.0], "A"), ([4.0, 5.0], "B")]


def test_malformed(spark):
    lines = spark.createDataFrame([("1,2,A",), ("x,2,B",)], "line string")
    with pytest.raises(Exception):
        P.parse_points(lines).collect()
    kept = P.parse_points(lines, mode="DROPMALFORMED").collect()
    assert [tuple(r) for r in kept] == [(1.0, 2.0, "A")]
    with pytest.raises(ValueError):
        P.parse_points(lines, mode="LENIENT")


def test_read_points(spark, tmp_path):
    f = tmp_path / "pts.csv"
    f.write_text("1,2,A\n3,4,B\n5,6,A\n")
    pts = P.read_points(spark, str(f), partitions=2)
    assert sorted(tuple(r) for r in pts.collect()) == [(1.0, 2.0, "A"), (3.0, 4.0, "B"), (5.0, 6.0, "A")]
    with pytest.raises(ValueError):
        P.read_points(spark, "  ")


def test_rejects_table(spark):
    lines = spark.createDataFrame([("1,2,A",), ("x,2,B",), ("",), ("3,4",), ("5,6, ",), ("7,8,B,9",)],
                                  "line string")
    bad = {r["line"]: r["reason"] for r in P.malformed_lines(lines).collect()}
    assert bad == {"x,2,B": "not a number", "": "missing field", "3,4": "missing field",
                   "5,6, ": "empty label"}
    good = P.parse_points(lines, mode="DROPMALFORMED").count()
    assert good + len(bad) == lines.count()
    nd = spark.createDataFrame([("1,2,3,A",), ("1,,3,B",), ("A",)], "line string")
    assert {r["line"] for r in P.malformed_lines(nd, dims=None).collect()} == {"1,,3,B", "A"}


def test_strict_labels(spark):
    ok = spark.createDataFrame([(0.0, 0.0, "A"), (1.0, 1.0, "B")], "x double, y double, grp string")
    assert P.strict_labels(ok).count() == 2
    bad = spark.createDataFrame([(0.0, 0.0, "A"), (1.0, 1.0, "C")], "x double, y double, grp string")
    with pytest.raises(Exception):
        P.strict_labels(bad).collect()
