"""Hash family of the sketches: h(x) = ((a*x + b) mod p) mod W and a +-1 sign.

``%`` is the truncating remainder (as in Java and SQL) and the final reduction
to a column is ``pmod`` (floor modulo). Arithmetic is 64-bit; under ANSI mode an
overflow raises instead of wrapping. ``wrap32=True`` reproduces 32-bit integer
arithmetic (the value of ``a*x + b`` wrapped to a signed int) for inputs that
are 32-bit ints.
"""

from __future__ import annotations

import random
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the prime of the hash family.
DEFAULT_P = 8191


@dataclass(frozen=True)
class HashParams:
    a: int
    b: int
    p: int = DEFAULT_P

    def __post_init__(self):
        if not (1 <= self.a <= self.p - 1) or not (0 <= self.b <= self.p - 1):
            raise ValueError(f"need 1 <= a < p and 0 <= b < p, got a={self.a}, b={self.b}")


@dataclass(frozen=True)
class SketchSpec:
    """D hash rows of width W; ``signs`` only for the count sketch."""
    width: int
    rows: tuple[HashParams, ...]
    signs: tuple[HashParams, ...] = ()
    wrap32: bool = False

    def __post_init__(self):
        if self.width <= 0:
            raise ValueError("width must be positive")
        if not self.rows:
            raise ValueError("need at least one hash row")
        if any(self.width > h.p for h in self.rows):
            raise ValueError("a width above p leaves columns that no item reaches")
        if self.signs and len(self.signs) != len(self.rows):
            raise ValueError("one sign hash per row")

    @property
    def depth(self) -> int:
        return len(self.rows)

    @property
    def cells(self) -> int:
        return self.depth * self.width


def spec(width: int, params: Sequence[tuple[int, int]],
         sign_params: Sequence[tuple[int, int]] = (), p: int = DEFAULT_P,
         wrap32: bool = False) -> SketchSpec:
    return SketchSpec(width, tuple(HashParams(a, b, p) for a, b in params),
                      tuple(HashParams(a, b, p) for a, b in sign_params), wrap32)


def hash_family(depth: int, width: int, seed: int, p: int = DEFAULT_P,
                wrap32: bool = False) -> tuple[SketchSpec, SketchSpec]:
    """Draw a count-min spec and a count-sketch spec (with signs) from one seeded
    generator, interleaved per row. Parameters are plain numbers, so every task
    and every run hashes alike."""
    if depth <= 0:
        raise ValueError("depth must be positive")
    rnd = random.Random(seed)
    cm, cs, sg = [], [], []
    for _ in range(depth):
        for target in (cm, cs, sg):
            target.append((rnd.randint(1, p - 1), rnd.randint(0, p - 1)))
    return spec(width, cm, p=p, wrap32=wrap32), spec(width, cs, sg, p=p, wrap32=wrap32)


def _linear(x: Column, h: HashParams, wrap32: bool) -> Column:
    if wrap32:
        v = F.lit(h.a).cast("bigint") * x.cast("int").cast("bigint") + F.lit(h.b)
        v = F.shiftright(F.shiftleft(v, 32), 32)
        return v % F.lit(h.p)
    # x is reduced first, so no 64-bit item overflows. The remainder keeps the sign
    # of a*x + b: below -p that is negative, from -p + 1 on nothing was reduced.
    wide = x.cast("bigint")
    v = (F.lit(h.a).cast("bigint") * (wide % F.lit(h.p)) + F.lit(h.b)) % F.lit(h.p)
    return F.when((wide <= -h.p) & (v > 0), v - F.lit(h.p)).otherwise(v)


def bucket(x: Column, h: HashParams, width: int, wrap32: bool = False) -> Column:
    """Column index in 0..W-1 (int)."""
    return F.pmod(_linear(x, h, wrap32), F.lit(width)).cast("int")


def sign(x: Column, h: HashParams, wrap32: bool = False) -> Column:
    """+1 when (a*x + b) mod p is even, else -1 (int)."""
    return F.when(_linear(x, h, wrap32) % 2 == 0, F.lit(1)).otherwise(F.lit(-1))
