from collections import Counter

import pytest

from fairstream.operators import topk
from fairstream.sources import items as I
from tests.conftest import SF_SMALL


def test_heavy_hitters_with_ties(spark):
    df = spark.createDataFrame([(x,) for x in [1, 1, 1, 2, 2, 3, 3, 4, 5]], "item bigint")
    c = topk.item_counts(df)
    assert topk.kth_frequency(c, 2).first()["phi_k"] == 2
    hh = sorted(tuple(r) for r in topk.heavy_hitters(c, 2).collect())
    assert hh == [(1, 3), (2, 2), (3, 2)]                      # three items for K = 2
    assert topk.kth_frequency(c, 99).first()["phi_k"] == 1     # K > distinct: everything
    assert topk.heavy_hitters(c, 99).count() == 5
    with pytest.raises(ValueError):
        topk.kth_frequency(c, 0)


def test_heavy_hitters_brute_force(spark):
    it = I.items(spark, SF_SMALL)
    cnt = Counter(r["item"] for r in it.collect())
    for k in (1, 5, 10):
        phi = sorted(cnt.values(), reverse=True)[k - 1]
        want = {x for x, f in cnt.items() if f >= phi}
        got = {r["item"] for r in topk.heavy_hitters(topk.item_counts(it), k).collect()}
        assert got == want


def test_distinct_summary(spark):
    df = spark.createDataFrame([(5,), (3,), (5,), (-1,)], "item bigint")
    r = topk.distinct_summary(df).first()
    assert (r["n_items"], r["n_distinct"], r["largest"]) == (4, 3, 5)
    e = topk.distinct_summary(spark.createDataFrame([], "item bigint")).first()
    assert (e["n_items"], e["n_distinct"], e["largest"]) == (0, 0, None)


def test_distinct_summary_approx(spark):
    df = spark.range(0, 5000).selectExpr("id % 1000 as item")
    r = topk.distinct_summary(df, approx=True, rsd=0.02).first()
    assert r["n_items"] == 5000 and abs(r["n_distinct"] - 1000) <= 60 and r["largest"] == 999


def test_kth_frequency_matches_sorted_counts(spark):
    it = I.skewed_items(spark, SF_SMALL)
    c = topk.item_counts(it)
    counts = sorted((r["cnt"] for r in c.collect()), reverse=True)
    ks = [1, 2, 5, 17, len(counts), len(counts) + 5]
    got = [topk.kth_frequency(c, k).first()["phi_k"] for k in ks]
    want = [counts[min(k, len(counts)) - 1] for k in ks]
    assert got == want
    hh = {r["item"] for r in topk.heavy_hitters(c, 5).collect()}
    assert hh == {r["item"] for r in c.collect() if r["cnt"] >= want[2]}
