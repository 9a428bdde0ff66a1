"""A k-means start that depends on the data and the seed alone.

k-means|| with keyed draws. A point of weight w runs an exponential race,
``-ln(u) / w`` with u from ``md5(seed:round:id)``; the smallest keys win, so a
round draws its points without replacement and in proportion to their weights,
and neither the partitioning nor the order of the rows can change them.

1. Round 0 draws one point, all weights equal.
2. Each of ``steps`` rounds draws ``oversample * k`` points, the weight being the
   squared distance to the candidates so far: a map-only key and a top-k (each
   task hands over as many rows as are drawn).
3. The candidates are weighted with the points nearest to them (one aggregate),
   and k of them are drawn on the driver by the same races (k-means++).

Without an id column, points are identified by their coordinates: copies are
counted first (partial aggregates) and run one race with their summed weight.
Fewer distinct points than k give as many centres as there are distinct points.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEPS, OVERSAMPLE = 2, 2


def uniform(name: str, ident: Column) -> Column:
    """A number in (0, 1] from the first 48 bits of ``md5(name:ident)``."""
    digest = F.md5(F.concat(F.lit(f"{name}:"), ident.cast("string")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint") + F.lit(1.0)) / F.lit(2.0 ** 48)


def uniform_of(name: str, ident) -> float:
    """``uniform`` for one value on the driver."""
    return (int(hashlib.md5(f"{name}:{ident}".encode()).hexdigest()[:12], 16) + 1.0) / 2.0 ** 48


def draw(rows: DataFrame, name: str, weight: Column, count: int) -> list:
    """The ``count`` rows that win the race (rows of weight 0 do not run)."""
    raced = rows.withColumn("_key", F.when(weight > 0, -F.log(uniform(name, F.col("_id"))) / weight))
    return raced.filter(F.col("_key").isNotNull()).orderBy("_key", "_id").limit(count).collect()


def _distance(a: Sequence[float], b: Sequence[float]) -> float:
    return sum((x - y) * (x - y) for x, y in zip(a, b))


def reduce_candidates(candidates: list[tuple], k: int, seed: int) -> list[list[float]]:
    """k of the candidates (id, point, weight), drawn one by one with weight times
    the squared distance to those drawn before."""
    chosen: list[list[float]] = []
    for step in range(k):
        best = None
        for ident, point, weight in candidates:
            w = weight * (min(_distance(point, c) for c in chosen) if chosen else 1.0)
            if w > 0:
                key = (-math.log(uniform_of(f"{seed}:r{step}", ident)) / w, ident)
                best = min(best, (key, point)) if best else (key, point)
        if best is None:
            break
        chosen.append(list(best[1]))
    return chosen


def keyed_start(points: DataFrame, k: int, seed: int, cols: Sequence[str] | None = ("x", "y"),
                features: str = "features", id_col: str | None = None, steps: int = STEPS,
                oversample: int = OVERSAMPLE) -> list[list[float]]:
    """At most k start centres of ``points``, the same for every partitioning."""
    from fairstream.operators.cluster import assign
    if k <= 0:
        raise ValueError("k must be > 0")
    names = [f"_x{j}" for j in range(len(cols))] if cols else None
    coords = [F.col(c).cast("double").alias(n) for c, n in zip(cols, names)] if cols else [F.col(features).alias("_f")]
    if id_col:
        rows = points.select(F.col(id_col).alias("_id"), F.lit(1).alias("_n"), *coords)
    else:
        plain = names or ["_f"]
        rows = points.select(*coords).groupBy(*plain).agg(F.count(F.lit(1)).alias("_n"))
        rows = rows.select(F.xxhash64(*plain).alias("_id"), "_n", *plain).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        def point(r) -> list[float]:
            return [float(r[n]) for n in names] if names else [float(v) for v in r["_f"]]
        found = [(r["_id"], point(r)) for r in draw(rows, f"{seed}:0", F.col("_n"), 1)]
        if not found:
            raise ValueError("no points to start from")
        for step in range(1, steps + 1):
            near = assign(rows, [p for _, p in found], names, "_f", "pandas")
            found += [(r["_id"], point(r)) for r in
                      draw(near, f"{seed}:{step}", F.col("_n") * F.col("dist2"), oversample * k)]
        near = assign(rows, [p for _, p in found], names, "_f", "pandas")
        weights = {r["cluster"]: r["w"] for r in near.groupBy("cluster").agg(F.sum("_n").alias("w")).collect()}
        weighted = [(i, p, weights.get(at, 0)) for at, (i, p) in enumerate(found)]
        return reduce_candidates(weighted, k, seed)
    finally:
        if not id_col:
            rows.unpersist()
