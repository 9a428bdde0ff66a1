"""Fixed parameters of the registered queries (shared by the Spark side and the
SQL oracles, so both compute the same thing)."""

from __future__ import annotations

from fairstream.functions import hashing

# Start centres for the 2-D points (x = price / 1000 in 1..500,
# y = day of year in 1..366). Fractional parts keep points away from exact ties.
CENTERS_2D = [
    [100.123, 80.456],
    [250.789, 250.321],
    [400.654, 150.987],
    [60.321, 300.111],
]

# 500 centres from a rule: multiples of two irrational steps, spread over the same ranges.
CENTERS_K500 = [[1 + 499 * (i * 0.6180339887 % 1), 1 + 365 * (i * 0.7548776662 % 1)] for i in range(500)]
# 5,000 from the same rule, on whole numbers of the second coordinate, so that some
# points have several nearest centres; every seventh is a copy of the one before.
CENTERS_K5000 = [[1 + round(499 * (j * 0.6180339887 % 1), 2), 1.0 + round(365 * (j * 0.7548776662 % 1))]
                 for i in range(5000) for j in [i - (i % 7 == 6)]]

# With every point from day EDGE_Y on in group A, the third centre's
# cluster has no B point and the fourth has no point at all.
EDGE_Y = 150
CENTERS_EDGE = [
    [100.123, 80.456],
    [400.654, 90.987],
    [250.789, 330.321],
    [5000.5, 5000.5],
]

# 64-d start centres from a rule: c_i[j] = 0.05 * ((i+1)(j+1) mod 5 - 2) + 0.001 (i+1).
ND_DIMS = 64
ND_K = 4
CENTERS_ND = [
    [0.05 * (((i + 1) * (j + 1)) % 5 - 2) + 0.001 * (i + 1) for j in range(ND_DIMS)]
    for i in range(ND_K)
]

# Seeded k-means settings of the rows-only queries.
KMEANS_K = 4
KMEANS_ITER = 10
KMEANS_SEED = 42
FAIR_ROUNDS = 3

# Hash parameters (a in 1..p-1, b in 0..p-1) of the sketch queries,
# p = 8191 and width W = 12 so that cells collide; D = 5 rows (odd) for the
# count-min and count sketches, and a 4-row variant (even D) for the median rule.
SKETCH_P = 8191
SKETCH_W = 12
CMS_PARAMS = [(3301, 17), (1201, 4099), (7919, 123), (5003, 2718), (911, 6007)]
CS_PARAMS = [(2029, 311), (6143, 77), (4421, 5005), (1777, 999), (3539, 8000)]
CS_SIGN_PARAMS = [(7001, 42), (2663, 1313), (4937, 2500), (1103, 7777), (6277, 64)]
CS_PARAMS_EVEN = CS_PARAMS[:4]
CS_SIGN_PARAMS_EVEN = CS_SIGN_PARAMS[:4]

# Wide items: multiples (-500 to 499) of this odd number above 2^53.
WIDE_FACTOR = 9007199254740993
# A seeded draw of the family, with the width and prime of the others.
SEEDED_CM, SEEDED_CS = hashing.hash_family(5, SKETCH_W, seed=11, p=SKETCH_P)

# Heavy-hitter settings; the last is above the number of distinct skewed items.
TOP_K = 5
TOP_K_ABOVE = 1_000_000
# Relative standard deviation of the distinct estimate; a check allows 5 of them.
DISTINCT_RSD = 0.01
# Bounded heavy hitters: counters of each summary (fewer than the skewed items
# of a bucket, so that some are turned away) and buckets.
HITTER_COUNTERS = 12
HITTER_BUCKETS = 4
# Stream settings: the items stream is split into this many files, one per
# micro-batch, and the prefix stops after at least this many items.
STREAM_FILES = 5
PREFIX_T = 5000

# Decimal places that results are rounded to before comparison.
DIGITS = 6
COST_DIGITS = 4
