"""Labelled Gaussian blobs with a built-in gap between the two groups.

Point ``i`` of N (``id`` = 0..N-1) with ``n = N div (2K)`` points per group per
cluster: for cluster c = i div 2n, the first n points are group A around
(10c, 0) and the next n are group B around (10c + 10, 10); points past 2nK
are group A around (0, 0). Noise is unit normal (Box-Muller on digits of
``md5(seed:id:axis)``), values are rounded to four decimals. Everything is
column arithmetic on the id, so any number of tasks gives the same points.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the generator: spacing of the cluster centres, offset of
# group B from group A, and the rounding of coordinates.
SPACING = 10.0
B_OFFSET_X = 10.0
B_OFFSET_Y = 10.0
DECIMALS = 4


def _uniform(key: Column, first: int) -> Column:
    """A number in (0, 1] from twelve hex digits of ``key``."""
    return (F.conv(F.substring(key, first, 12), 16, 10).cast("double") + 1.0) / float(1 << 48)


def noise(i: Column, seed: int, axis: str) -> Column:
    """Unit normal noise of point ``i``, independent between axes and seeds."""
    key = F.md5(F.concat(F.lit(f"{seed}:"), i.cast("string"), F.lit(f":{axis}")))
    return F.sqrt(F.log(_uniform(key, 1)) * -2.0) * F.cos(_uniform(key, 13) * (2.0 * math.pi))


def labelled_blobs(ids: DataFrame, n_total: int, k: int, seed: int = 42,
                   id_col: str = "id") -> DataFrame:
    """``id, x, y, grp, cluster`` for ids 0..n_total-1 (``cluster`` = -1 for
    the remainder points)."""
    if n_total <= 0 or k <= 0:
        raise ValueError("N and K must be positive")
    n = n_total // (2 * k)
    i = F.col(id_col).cast("bigint")
    in_blob = i < F.lit(2 * n * k) if n > 0 else F.lit(False)
    c = F.when(in_blob, ((i - i % F.lit(max(2 * n, 1))) / F.lit(max(2 * n, 1))).cast("bigint")).otherwise(F.lit(-1))
    is_b = in_blob & ((i % F.lit(max(2 * n, 1))) >= F.lit(n))
    cx = F.when(c < 0, F.lit(0.0)).otherwise(c.cast("double") * SPACING) + \
        F.when(is_b, F.lit(B_OFFSET_X)).otherwise(F.lit(0.0))
    cy = F.when(is_b, F.lit(B_OFFSET_Y)).otherwise(F.lit(0.0))
    return ids.select(
        i.alias("id"),
        F.round(cx + noise(i, seed, "x"), DECIMALS).alias("x"),
        F.round(cy + noise(i, seed, "y"), DECIMALS).alias("y"),
        F.when(is_b, F.lit("B")).otherwise(F.lit("A")).alias("grp"),
        c.cast("int").alias("cluster"),
    )


def to_lines(points: DataFrame) -> DataFrame:
    """``x,y,grp`` text lines with four decimals (the generator's output format)."""
    fmt = F.format_string("%.4f,%.4f,%s", "x", "y", "grp")
    return points.select(fmt.alias("line"))
