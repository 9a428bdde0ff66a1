"""Property tests (hypothesis): pure-Python parts directly, Spark parts with
many random cases folded into one DataFrame per example."""
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fairstream.functions import hashing as H
from fairstream.operators import fair, sketch



@settings(max_examples=200, deadline=None)
@given(st.floats(0, 100), st.floats(0, 100), st.data())
def test_balance_weights_stay_on_the_segment(fixed_a, fixed_b, data):
    k = data.draw(st.integers(1, 6))
    alpha = data.draw(st.lists(st.floats(0.01, 1.0), min_size=k, max_size=k))
    beta = data.draw(st.lists(st.floats(0.01, 1.0), min_size=k, max_size=k))
    ell = data.draw(st.lists(st.floats(0.0, 50.0), min_size=k, max_size=k))
    x = fair.balance_weights(fixed_a, fixed_b, alpha, beta, ell)
    assert len(x) == k
    for xi, li in zip(x, ell):
        assert -1e-9 <= xi <= li + 1e-9          # the new centre lies between the two means


@settings(max_examples=100, deadline=None)
@given(st.floats(0, 100), st.floats(0, 100),
       st.lists(st.tuples(st.floats(0.01, 1), st.floats(0.01, 1), st.floats(0, 20)),
                min_size=1, max_size=5))
def test_balance_weights_match_a_plain_restatement(fixed_a, fixed_b, rows):
    # costs accumulate term by term from the fixed part, each term (w * d) * d:
    # the stop test is an exact equality, so the rounding order is part of the rule
    alpha, beta, ell = (list(t) for t in zip(*rows))
    gamma, step, last = 0.5, 0.5, None
    for _ in range(10):
        step /= 2
        x = [(1 - gamma) * b * l / (gamma * a + (1 - gamma) * b) for a, b, l in zip(alpha, beta, ell)]
        fa = fixed_a
        for a, v in zip(alpha, x):
            fa += a * v * v
        fb = fixed_b
        for b, l, v in zip(beta, ell, x):
            fb += b * (l - v) * (l - v)
        last = x
        if fa == fb:
            break
        gamma += step if fa > fb else -step
    assert fair.balance_weights(fixed_a, fixed_b, alpha, beta, ell) == last


@settings(max_examples=10, deadline=None)
@given(st.integers(1, 8190), st.integers(0, 8190), st.integers(1, 60),
       st.lists(st.integers(-(2**40), 2**40), min_size=1, max_size=50))
def test_bucket_and_sign_match_python(spark, a, b, w, xs):
    h = H.HashParams(a, b, 8191)
    df = spark.createDataFrame([(x,) for x in xs], "x bigint")
    got = df.select("x", H.bucket(F.col("x"), h, w).alias("b"), H.sign(F.col("x"), h).alias("s")).collect()
    for r in got:
        v = a * r["x"] + b
        t = abs(v) % 8191 * (1 if v >= 0 else -1)
        assert (r["b"], r["s"]) == (t % w, 1 if t % 2 == 0 else -1)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=1, max_size=200), st.integers(0, 10_000))
def test_count_min_never_underestimates(spark, items, seed):
    cm, _ = H.hash_family(3, 5, seed=seed)
    df = spark.createDataFrame([(x,) for x in items], "item bigint")
    q = spark.createDataFrame([(x, c) for x, c in Counter(items).items()], "item bigint, cnt bigint")
    for r in sketch.cms_estimate(q, sketch.cms_cells(df, cm), cm).collect():
        assert r["est"] >= r["cnt"]
