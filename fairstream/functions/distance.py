"""Column expressions for squared distances and nearest-centre lookup.

Centres are a short list of numbers on the driver (K x d), so they enter the
plan as literals: the assignment is a map-only projection, evaluated inside
whole-stage codegen, with no join and no shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# Up to this many coordinates the distance is written out term by term; above
# it the vector stays an array and a higher-order function folds it.
UNROLL_MAX_DIMS = 16


def check_centers(centers: Sequence[Sequence[float]]) -> list[list[float]]:
    """Validate a centre list: non-empty, one dimension, finite values."""
    cs = [[float(v) for v in c] for c in centers]
    if not cs:
        raise ValueError("centre list cannot be empty")
    dims = {len(c) for c in cs}
    if len(dims) != 1 or 0 in dims:
        raise ValueError(f"centres must share one positive dimension, got {sorted(dims)}")
    if any(not math.isfinite(v) for c in cs for v in c):
        raise ValueError("centres must be finite")
    return cs


def coordinate_columns(cols: Sequence[str] | None, dims: int,
                       features: str = "features") -> list[Column]:
    """Coordinates as columns: named scalar columns, or elements of an array."""
    if cols:
        if len(cols) != dims:
            raise ValueError(f"{len(cols)} coordinate columns for {dims}-d centres")
        return [F.col(c) for c in cols]
    return [F.col(features)[j] for j in range(dims)]


def sqdist_unrolled(coords: Sequence[Column], center: Sequence[float]) -> Column:
    """sum_j (x_j - c_j)^2, left to right, as plain arithmetic."""
    terms = []
    for x, c in zip(coords, center):
        diff = x - F.lit(float(c))
        terms.append(diff * diff)
    return reduce(add, terms)


def sqdist_array(features: Column, center: Sequence[float]) -> Column:
    """sum_j (x_j - c_j)^2 for an array column, folded left to right."""
    lit_center = F.array(*[F.lit(float(c)) for c in center])
    diffs = F.zip_with(features, lit_center, lambda a, b: (a - b) * (a - b))
    return F.aggregate(diffs, F.lit(0.0), lambda acc, v: acc + v)


def nearest(centers: Sequence[Sequence[float]], cols: Sequence[str] | None = None,
            features: str = "features") -> Column:
    """struct(dist2 double, cluster int) of the nearest centre.

    ``array_min`` over ``struct(dist2, index)`` orders by distance and then by
    index, so ties go to the lowest index, as the strict ``<`` scan does.
    """
    cs = check_centers(centers)
    dims = len(cs[0])
    if not cols:
        width = F.size(features) == dims
        whole = F.when(width, F.col(features)).otherwise(
            F.raise_error(F.lit("a point and the centres differ in size")).cast("array<double>"))
    if cols or dims <= UNROLL_MAX_DIMS:
        coords = coordinate_columns(cols, dims, features) if cols else [whole[j] for j in range(dims)]
        dists = [sqdist_unrolled(coords, c) for c in cs]
    else:
        dists = [sqdist_array(whole, c) for c in cs]
    cands = [F.struct(d.alias("dist2"), F.lit(i).alias("cluster")) for i, d in enumerate(dists)]
    return F.array_min(F.array(*cands))
