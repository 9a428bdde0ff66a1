"""Sums of doubles that do not depend on the order of the rows.

A value below 2^exponent is put on a grid of 62 binary places below that bound
(a bigint) and cut into parts narrow enough that the sum of all rows' parts is an
exact bigint. So any partitioning gives the same bits; each value is off by at
most 2^(exponent - 63).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PLACES = 62
NON_FINITE = "a point has a non-finite coordinate: no nearest centre"


@dataclass(frozen=True)
class Grid:
    """The bound (all absolute values are below 2^exponent) and the number of rows."""

    exponent: int
    rows: int

    @property
    def widths(self) -> list[int]:
        """Bits of the parts, lowest first, so that ``rows`` of them fit a bigint."""
        width = max(1, PLACES - max(1, self.rows).bit_length())
        return [min(width, PLACES + 1 - at) for at in range(0, PLACES + 1, width)]

    def split(self, values):
        """The parts of a numpy array of doubles, along a new last axis; the last
        part carries the sign."""
        import numpy as np
        at, out = np.rint(np.ldexp(values, PLACES - self.exponent)).astype(np.int64), []
        for width in self.widths[:-1]:
            out.append(at & ((1 << width) - 1))
            at = at >> width
        return np.stack([*out, at], axis=-1)

    def total(self, sums: Sequence[int]) -> float:
        """The sum as a double, from the summed parts."""
        whole, shift = 0, 0
        for part, width in zip(sums, self.widths, strict=True):
            whole += part << shift
            shift += width
        return math.ldexp(float(whole), self.exponent - PLACES)

    def squares(self, dims: int, centers: Sequence[Sequence[float]]) -> "Grid":
        """The grid of squared distances between such points and ``centers``."""
        far = 2.0 ** self.exponent + max(abs(v) for c in centers for v in c)
        return Grid(math.frexp(dims * far * far)[1], self.rows)


def coordinate_grid(points: DataFrame, cols: Sequence[str] | None, features: str = "features") -> Grid:
    """The grid of a point table's coordinates: one aggregate."""
    if cols:
        largest = F.greatest(*[F.abs(F.col(c)) for c in cols]) if len(cols) > 1 else F.abs(F.col(cols[0]))
    else:
        largest = F.array_max(F.transform(features, lambda v: F.abs(v)))
    seen = points.agg(F.max(largest.cast("double")).alias("most"), F.count(F.lit(1)).alias("n")).first()
    most = seen["most"] or 0.0
    if not math.isfinite(most):
        raise ValueError(NON_FINITE)
    return Grid(math.frexp(most)[1] if most else 1, seen["n"])
