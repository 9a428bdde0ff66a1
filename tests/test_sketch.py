from collections import Counter

import pytest

from fairstream.functions import hashing as H
from fairstream.operators import sketch, topk
from fairstream.sources import items as I
from tests.conftest import SF_SMALL


def _h(a, b, p, w, x):
    v = a * x + b
    t = abs(v) % p * (1 if v >= 0 else -1)
    return t % w, (1 if t % 2 == 0 else -1)


def _brute(items, cm, cs):
    cnt = Counter(items)
    cmt, cst = Counter(), Counter()
    for x, f in cnt.items():
        for i, h in enumerate(cm.rows):
            cmt[(i, _h(h.a, h.b, h.p, cm.width, x)[0])] += f
        for i, h in enumerate(cs.rows):
            sg = _h(cs.signs[i].a, cs.signs[i].b, h.p, cs.width, x)[1]
            cst[(i, _h(h.a, h.b, h.p, cs.width, x)[0])] += sg * f
    return cnt, cmt, cst


def _est(x, cm, cs, cmt, cst):
    e_cm = min(cmt[(i, _h(h.a, h.b, h.p, cm.width, x)[0])] for i, h in enumerate(cm.rows))
    v = sorted(cst[(i, _h(h.a, h.b, h.p, cs.width, x)[0])] * _h(cs.signs[i].a, cs.signs[i].b, h.p,
                                                                   cs.width, x)[1]
               for i, h in enumerate(cs.rows))
    d = len(v)
    e_cs = v[d // 2] if d % 2 else int((v[d // 2 - 1] + v[d // 2]) / 2)   # toward zero
    return e_cm, e_cs


@pytest.mark.parametrize("depth", [5, 4])
def test_cells_and_estimates_match_brute_force(spark, depth):
    cm, cs = H.hash_family(depth, 8, seed=3)
    it = I.skewed_items(spark, SF_SMALL)
    items = [r["item"] for r in it.collect()]
    cnt, cmt, cst = _brute(items, cm, cs)
    cmc, csc = sketch.cms_cells(it, cm), sketch.cs_cells(it, cs)
    assert {(r["row"], r["bucket"]): r["cnt"] for r in cmc.collect()} == {k: v for k, v in cmt.items()}
    assert {(r["row"], r["bucket"]): r["cnt"] for r in csc.collect()} == {k: v for k, v in cst.items()}
    q = topk.item_counts(it)
    got_cm = {r["item"]: r["est"] for r in sketch.cms_estimate(q, cmc, cm).collect()}
    got_cs = {r["item"]: r["est"] for r in sketch.cs_estimate(q, csc, cs).collect()}
    for x in cnt:
        e_cm, e_cs = _est(x, cm, cs, cmt, cst)
        assert got_cm[x] == e_cm and got_cs[x] == e_cs
        assert got_cm[x] >= cnt[x]                       # count-min never underestimates


def test_even_median_truncates_toward_zero(spark):
    # two rows; the item's cells hold -3 and 0 after signs -> (-3 + 0) / 2 -> -1
    s = H.spec(4, [(1, 0), (1, 1)], [(2, 0), (2, 0)], p=8191)
    cells = spark.createDataFrame([(0, 1, -3), (1, 2, 0)], "row int, bucket int, cnt bigint")
    q = spark.createDataFrame([(1,)], "item bigint")
    assert sketch.cs_estimate(q, cells, s).first()["est"] == -1


def test_unseen_item_reads_zero_and_merge(spark):
    cm, _ = H.hash_family(3, 16, seed=1)
    a = spark.createDataFrame([(1,), (2,), (2,)], "item bigint")
    b = spark.createDataFrame([(2,), (3,)], "item bigint")
    merged = sketch.merge_cells(sketch.cms_cells(a, cm), sketch.cms_cells(b, cm))
    whole = sketch.cms_cells(a.unionByName(b), cm)
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))
    q = spark.createDataFrame([(10**6 + 7,)], "item bigint")
    est = sketch.cms_estimate(q, sketch.cms_cells(spark.createDataFrame([], "item bigint"), cm), cm)
    assert est.first()["est"] == 0


def test_weighted_add_equals_unit_add(spark):
    cm, cs = H.hash_family(3, 16, seed=9)
    it = I.items(spark, SF_SMALL)
    counts = topk.item_counts(it)
    for build in (sketch.cms_cells, sketch.cs_cells):
        spec = cm if build is sketch.cms_cells else cs
        unit = sorted(map(tuple, build(it, spec).collect()))
        weighted = sorted(map(tuple, build(counts, spec, weight_col="cnt").collect()))
        assert unit == weighted


def test_wrap32_cells_match_32bit_arithmetic(spark):
    """With wrap32 the cells follow 32-bit int arithmetic (large items wrap)."""
    def h32(a, b, p, w, x):
        v = (a * x + b) & 0xFFFFFFFF
        v = v - (1 << 32) if v >= (1 << 31) else v
        t = abs(v) % p * (1 if v >= 0 else -1)
        return t % w, (1 if t % 2 == 0 else -1)

    xs = [0, 1, 8191, 2147483647, -2147483648, 123456789, 123456789, -7]
    cm = H.spec(10, [(8190, 77), (4099, 1)], p=8191, wrap32=True)
    cs = H.spec(10, [(3, 5), (17, 8000)], [(8190, 77), (11, 0)], p=8191, wrap32=True)
    df = spark.createDataFrame([(x,) for x in xs], "item bigint")
    want_cm, want_cs = Counter(), Counter()
    for x in xs:
        for i, h in enumerate(cm.rows):
            want_cm[(i, h32(h.a, h.b, h.p, 10, x)[0])] += 1
        for i, h in enumerate(cs.rows):
            sg = h32(cs.signs[i].a, cs.signs[i].b, h.p, 10, x)[1]
            want_cs[(i, h32(h.a, h.b, h.p, 10, x)[0])] += sg
    got_cm = {(r["row"], r["bucket"]): r["cnt"] for r in sketch.cms_cells(df, cm).collect()}
    got_cs = {(r["row"], r["bucket"]): r["cnt"] for r in sketch.cs_cells(df, cs).collect()}
    assert got_cm == dict(want_cm)
    assert got_cs == {k: v for k, v in want_cs.items()}


def _estimates(spark, most):
    cm, cs = H.hash_family(3, 16, seed=9)
    sk = [sketch.Sketch("cm", cm), sketch.Sketch("cs", cs, signed=True)]
    cells = sketch.build(I.skewed_items(spark, SF_SMALL), sk)
    names = ["_est", "_qid", "_cell", "_row", "_out", "sketch", "row", "bucket", "cnt", "arrays", "CM_est"]
    rows = [(x, *[f"{n}{x}" for n in names]) for x in (1, 1, 2, 500, -9, None)]
    query = spark.createDataFrame(rows, "item bigint, " + ", ".join(f"{n} string" for n in names))
    before = sketch.BROADCAST_MAX_CELLS
    sketch.BROADCAST_MAX_CELLS = most
    try:
        got = sketch.estimate(query, cells, sk)
    finally:
        sketch.BROADCAST_MAX_CELLS = before
    return rows, got


def test_both_lookups_agree_and_keep_every_column(spark):
    rows, by_index = _estimates(spark, 1000)
    _, by_join = _estimates(spark, 10)
    assert by_index.columns == by_join.columns
    assert sorted(map(tuple, by_index.collect()), key=repr) == sorted(map(tuple, by_join.collect()), key=repr)
    kept = [c for c in by_index.columns if not c.endswith(("cm_est", "cs_est"))]
    assert sorted(map(tuple, by_index.select(kept).collect()), key=repr) == sorted([r[:-1] for r in rows], key=repr)


def test_estimates_read_arrays_without_an_exchange(spark):
    _, got = _estimates(spark, 1000)
    plan = got._jdf.queryExecution().executedPlan().toString()
    whole = plan[:plan.index("Subquery")] if "Subquery" in plan else plan
    assert "Exchange" not in whole and "Join" not in whole and "Generate" not in whole
