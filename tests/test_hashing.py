from pyspark.sql import functions as F

from fairstream.functions import hashing as H


def _java_like(a, b, p, w, x):
    """32-bit wrapped a*x+b, truncating %, then floor mod (the reference rule)."""
    v = (a * x + b) & 0xFFFFFFFF
    v = v - (1 << 32) if v >= (1 << 31) else v
    r = abs(v) % p * (1 if v >= 0 else -1)
    return r % w, (1 if r % 2 == 0 else -1)


# Worked examples (a=8190, b=77, p=8191, W=50, 32-bit wrap): x -> (bucket, sign).
EXAMPLES = {0: (27, -1), 1: (26, 1), 8191: (27, -1), 8192: (26, 1), -1: (37, -1),
            2147483647: (37, -1), -2147483648: (27, -1), 123456789: (23, -1)}


def test_worked_examples_wrap32(spark):
    h = H.HashParams(8190, 77, 8191)
    df = spark.createDataFrame([(x,) for x in EXAMPLES], "x bigint")
    rows = df.select("x", H.bucket(F.col("x"), h, 50, wrap32=True).alias("b"),
                     H.sign(F.col("x"), h, wrap32=True).alias("s")).collect()
    got = {r["x"]: (r["b"], r["s"]) for r in rows}
    assert got == EXAMPLES
    for x, want in EXAMPLES.items():
        assert _java_like(8190, 77, 8191, 50, x) == want


def test_without_wrap_matches_python(spark):
    h = H.HashParams(1234, 5678, 8191)
    xs = list(range(-50, 50)) + [10**9, -(10**9)]
    df = spark.createDataFrame([(x,) for x in xs], "x bigint")
    rows = df.select("x", H.bucket(F.col("x"), h, 17).alias("b")).collect()
    for r in rows:
        v = 1234 * r["x"] + 5678
        t = abs(v) % 8191 * (1 if v >= 0 else -1)   # truncating remainder
        assert r["b"] == t % 17


def test_family_is_seeded_and_valid():
    a1, b1 = H.hash_family(5, 50, seed=7)
    a2, b2 = H.hash_family(5, 50, seed=7)
    assert a1 == a2 and b1 == b2
    assert a1.depth == 5 and len(b1.signs) == 5
    for h in a1.rows + b1.rows + b1.signs:
        assert 1 <= h.a < h.p and 0 <= h.b < h.p


def test_bad_params():
    import pytest
    with pytest.raises(ValueError):
        H.HashParams(0, 1)
    with pytest.raises(ValueError):
        H.spec(0, [(1, 1)])
