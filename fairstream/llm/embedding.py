"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors with a cosine of at least t differ by at most eps = sqrt(2 - 2t), and
so do their coordinates along any orthonormal axes.

1. Axes: the leading principal dimensions, from the moments of all vectors
   (summed by task, then by Spark; d x d numbers reach the driver).
2. Order: vectors are sorted by label and then by the cells of side eps that
   their leading coordinates fall into, and numbered. ``block_rows`` consecutive
   vectors of one label are an interval of the sequence.
3. Recursive join in Spark: intervals are gathered 16 by 16 into longer ones, each
   with the box of its coordinates. From the whole sequence of a label joined with
   itself, every round joins the parts of the pairs that are left and skips pairs
   whose boxes are more than eps apart. What the axes leave out counts too, by the
   length of the rest.
4. Recursive join in the task: both intervals of a pair are halved in the same way
   down to ``LEAF`` vectors, whose cosines are one matrix product. A task returns
   for each vector its number of links and one link to the least vector it is
   tied to, never the pairs.
5. Links are added up by vector, and the ties become components.

Cosines within 1e-9 of the threshold are computed again with exactly rounded sums,
so the answer does not depend on the order of the blocks.

Defined results: a vector that is null, empty, zero or has a null or non-finite
component, and one without a label, links with nothing and is its own component;
vectors of different length never link; rows with one vec_id are vectors of their
own; the smallest vec_id ignores nulls; other columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairstream.llm.graph import components, join_counted
from fairstream.llm.shared import materialize

THRESHOLD = 0.93
DIMENSIONS = 8
LEAF = 256
FAN_OUT = 16
#: Vectors of an interval: one in so many of all, between these bounds, so that a
#: pair of intervals fits a task and few intervals are sent to many pairs.
BLOCK_SHARE, BLOCK_LEAST, BLOCK_MOST = 1024, 1024, 16384
_CLOSE, _SLACK = 1e-9, 1e-5


# --- vectors ---------------------------------------------------------------------

def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit_rows(column: pa.Array, width: int | None = None) -> np.ndarray:
    """The vectors of a list column (all of one length) over their lengths, padded
    with zeros to ``width``."""
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(n, -1) if n else np.zeros((0, width or 0))
    x = x / np.abs(x).max(1, initial=0, keepdims=True) if n else x
    x = x / np.sqrt((x * x).sum(1, keepdims=True))
    return x if width is None or width == x.shape[1] else np.pad(x, ((0, 0), (0, width - x.shape[1])))


def _same_length(column: pa.Array) -> Iterator[np.ndarray]:
    """Row numbers, by the length of their vectors."""
    sizes = column.value_lengths().to_numpy()
    for size in np.unique(sizes):
        yield np.flatnonzero(sizes == size)


def _units(column: pa.Array, width: int) -> np.ndarray:
    out = np.zeros((len(column), width))
    for rows in _same_length(column):
        out[rows] = unit_rows(column.take(pa.array(rows)), width)
    return out


def _list_rows(x: np.ndarray) -> pa.Array:
    offsets = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(x.ravel()))


def principal_axes(vectors: DataFrame, width: int, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """(mean, axes as columns) of the unit vectors in column ``vec``."""
    upper = np.triu_indices(width)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, square = 0, np.zeros(width), np.zeros((width, width))
        for batch in batches:
            u = _units(batch.column("vec"), width)
            n, total, square = n + len(u), total + u.sum(0), square + u.T @ u
        if n:
            values = np.concatenate([[n], total, square[upper]])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], names=["k", "v"])

    sums = vectors.select("vec").mapInArrow(moments, "k long, v double").groupBy("k").agg(F.sum("v").alias("v"))
    v = np.array([r["v"] for r in sorted(sums.collect(), key=lambda r: r["k"])])
    n, mean = v[0], v[1:width + 1] / v[0]
    square = np.zeros((width, width))
    square[upper] = v[width + 1:] / n
    square = square + square.T - np.diag(np.diag(square))
    values, axes = np.linalg.eigh(square - np.outer(mean, mean))
    return mean, axes[:, ::-1][:, :min(dimensions, width)]


def grid_order(vectors: DataFrame, width: int, eps: float, dimensions: int) -> DataFrame:
    """(label, size, row, vec, coords, g): ``coords`` are the coordinates on the
    leading axes and the length of the rest, ``g`` is the place in the sequence."""
    mean, axes = principal_axes(vectors, width, dimensions)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            centred = _units(batch.column("vec"), width) - mean
            at = centred @ axes
            rest = np.sqrt(np.maximum((centred ** 2).sum(1) - (at ** 2).sum(1), 0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("label", "size", "row", "vec")]
                + [_list_rows(np.floor(at / eps).astype(np.int32)), _list_rows(np.c_[at, rest])],
                names=["label", "size", "row", "vec", "cells", "coords"])

    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema.fields}
    placed = vectors.mapInArrow(project, f"label {kinds['label']}, size int, row long, vec {kinds['vec']}, "
                                         "cells array<int>, coords array<double>")
    order = ["label", "size", "cells", "row"]
    sequence = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    one_part = (1 << 33) - 1
    written = materialize(sequence.select(
        "label", "size", "row", "vec", "coords", F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(one_part)).alias("at")), "grid-order")
    counts = sorted((r["part"], r["n"]) for r in written.groupBy("part").agg(F.count("*").alias("n")).collect())
    starts = [0, *itertools.accumulate(n for _, n in counts)]
    first = written.sparkSession.createDataFrame(       # one row for each partition
        [(p, s) for (p, _), s in zip(counts, starts)], "part int, start long")
    return written.join(F.broadcast(first), "part").select(
        "label", "size", "row", "vec", "coords", (F.col("start") + F.col("at")).alias("g"))


# --- intervals of the sequence, joined by Spark --------------------------------------

def interval_pairs(sequence: DataFrame, rows: int, block_rows: int, eps: float, dimensions: int,
                   fan_out: int = FAN_OUT) -> DataFrame:
    """(label, size, i, j), i <= j: the pairs of intervals that may hold links.
    Interval b holds the places b * block_rows to (b + 1) * block_rows - 1 of one label."""
    axes = range(dimensions + 1)
    block = F.floor(F.col("g") / block_rows).cast("long")
    boxes = sequence.groupBy("label", "size", block.alias("b")).agg(
        *[F.min(F.col("coords")[k]).alias(f"lo{k}") for k in axes],
        *[F.max(F.col("coords")[k]).alias(f"hi{k}") for k in axes])
    levels = [materialize(boxes, "boxes")]
    last = max(rows - 1, 0) // block_rows
    while last >= fan_out ** (len(levels) - 1):
        up = F.floor(F.col("b") / fan_out).cast("long")
        levels.append(levels[-1].groupBy("label", "size", up.alias("b")).agg(
            *[F.min(f"lo{k}").alias(f"lo{k}") for k in axes], *[F.max(f"hi{k}").alias(f"hi{k}") for k in axes]))
    def side(level: DataFrame, name: str, parent: Column) -> DataFrame:
        return level.select("label", "size", F.col("b").alias(name), parent.alias(f"p{name}"),
                            F.array(*[f"lo{k}" for k in axes]).alias(f"{name}_lo"),
                            F.array(*[f"hi{k}" for k in axes]).alias(f"{name}_hi"))

    def gap(k: int) -> Column:
        return F.greatest(F.col("j_lo")[k] - F.col("i_hi")[k], F.col("i_lo")[k] - F.col("j_hi")[k], F.lit(0.0))

    apart = sum(gap(k) * gap(k) for k in axes)
    pairs = levels[-1].select("label", "size", F.col("b").alias("pi"), F.col("b").alias("pj"))
    for depth in range(len(levels) - 1, -1, -1):
        whole = depth == len(levels) - 1
        parent = F.col("b") if whole else F.floor(F.col("b") / fan_out).cast("long")
        pairs = (pairs.join(side(levels[depth], "i", parent), ["label", "size", "pi"])
                 .join(side(levels[depth], "j", parent), ["label", "size", "pj"])
                 .filter((F.col("i") <= F.col("j")) & (apart <= (eps + _SLACK) ** 2))
                 .select("label", "size", F.col("i").alias("pi"), F.col("j").alias("pj")))
    return materialize(pairs.select("label", "size", F.col("pi").alias("i"), F.col("pj").alias("j")), "interval-pairs")


# --- two intervals, joined in a task --------------------------------------------------

def _near_leaves(a: np.ndarray, b: np.ndarray, same: bool, eps: float, leaf: int) -> Iterator[tuple[slice, slice]]:
    """Recursive join of two sequences of coordinates: slices that are not provably apart."""
    def box(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x.min(0), x.max(0)

    def halves(s: slice) -> list[slice]:
        if s.stop - s.start <= leaf:
            return [s]
        mid = s.start + max(leaf, (s.stop - s.start) // 2 // leaf * leaf)
        return [slice(s.start, mid), slice(mid, s.stop)]

    todo = [(slice(0, len(a)), slice(0, len(b)))]
    while todo:
        s, t = todo.pop()
        if same and t.start < s.start:
            continue
        (lo, hi), (lo2, hi2) = box(a[s]), box(b[t])
        gap = np.maximum(np.maximum(lo2 - hi, lo - hi2), 0)
        if (gap * gap).sum() > (eps + _SLACK) ** 2:
            continue
        if s.stop - s.start <= leaf and t.stop - t.start <= leaf:
            yield s, t
        else:
            todo.extend(itertools.product(halves(s), halves(t)))


def _exact_cosine(x: np.ndarray, y: np.ndarray) -> float:
    dot = math.fsum((x * y).tolist())
    return dot / math.sqrt(math.fsum((x * x).tolist()) * math.fsum((y * y).tolist()))


def _ties(hit: np.ndarray, left: np.ndarray, right: np.ndarray) -> Iterator[tuple[int, int]]:
    """(node, least node it is tied to) by the links of ``hit`` between two sets of nodes."""
    far = np.iinfo(np.int64).max
    rows, cols = hit.any(1), hit.any(0)
    hit, a, b = hit[np.ix_(rows, cols)], left[rows], right[cols]
    low_a, low_b = a.copy(), b.copy()
    while True:
        new_a = np.minimum(low_a, np.where(hit, low_b[None, :], far).min(1))
        new_b = np.minimum(low_b, np.where(hit, new_a[:, None], far).min(0))
        if (new_a == low_a).all() and (new_b == low_b).all():
            break
        low_a, low_b = new_a, new_b
    for nodes, lows in ((a, low_a), (b, low_b)):
        yield from zip(nodes[nodes != lows].tolist(), lows[nodes != lows].tolist())


def join_intervals(left: tuple, right: tuple | None, threshold: float, eps: float, leaf: int = LEAF) -> list[tuple]:
    """(g, links, least g it is tied to) of every linked vector of two intervals, or
    of one with itself. An interval is (places, unit vectors, coordinates)."""
    same = right is None
    (ga, ua, ca), (gb, ub, cb) = left, left if same else right
    nodes = ga if same else np.concatenate([ga, gb])
    offset = 0 if same else len(ga)
    links, parent = np.zeros(len(nodes), np.int64), {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for s, t in _near_leaves(ca, cb, same, eps, leaf):
        cosines = ua[s] @ ub[t].T
        hit = cosines >= threshold
        for i, j in np.argwhere(np.abs(cosines - threshold) <= _CLOSE):
            hit[i, j] = _exact_cosine(ua[s][i], ub[t][j]) >= threshold
        if same and s == t:
            np.fill_diagonal(hit, False)
        if not hit.any():
            continue
        links[s] += hit.sum(1)
        if not (same and s == t):
            links[offset + t.start:offset + t.stop] += hit.sum(0)
        at = np.arange(len(nodes))
        for x, low in _ties(hit, at[s], at[offset + t.start:offset + t.stop]):
            a, b = root(x), root(low)
            if a != b:
                parent[max(a, b)] = min(a, b)
    found = np.flatnonzero(links)
    return [(int(nodes[x]), int(links[x]), int(nodes[root(int(x))])) for x in found]


def _read_pairs(batches: Iterator[pa.RecordBatch], threshold: float, eps: float, leaf: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (label, size, i, j, side, g): one pair of intervals at a time."""
    def answer(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        g = rows.column("g").to_numpy()
        vectors = unit_rows(pa.concat_arrays(rows.column("vec").chunks))
        coords = pa.concat_arrays(rows.column("coords").chunks).flatten().to_numpy().reshape(len(g), -1)
        second = rows.column("side").to_numpy() == 1
        sides = [(g[x], vectors[x], coords[x]) for x in (~second, second)]
        found = join_intervals(sides[0], sides[1] if second.any() else None, threshold, eps, leaf)
        columns = list(zip(*found)) if found else [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["g", "links", "low"])

    held, now = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        names = [batch.column("label").dictionary_encode().indices] + [batch.column(c) for c in ("size", "i", "j")]
        unit = np.stack([c.to_numpy() for c in names])
        cuts = np.r_[0, np.flatnonzero((unit[:, 1:] != unit[:, :-1]).any(0)) + 1, batch.num_rows]
        for a, b in itertools.pairwise(cuts.tolist()):
            name = (batch.column("label")[a].as_py(), *unit[1:, a].tolist())
            if held and name != now:
                yield answer(held)
                held = []
            now = name
            held.append(batch.slice(a, b - a))
    if held:
        yield answer(held)


# --- results ---------------------------------------------------------------------------

def links(sequence: DataFrame, pairs: DataFrame, block_rows: int, threshold: float, eps: float,
          leaf: int = LEAF) -> DataFrame:
    """(g, links, low): partial numbers of links, and ties, of the linked vectors."""
    block = F.floor(F.col("g") / block_rows).cast("long")
    rows = sequence.withColumn("b", block)
    sides = []
    for k, name in enumerate(("i", "j")):
        wanted = pairs.filter("i <> j") if k else pairs
        wanted = wanted.withColumn("b", F.col(name))
        sides.append(rows.join(wanted, ["label", "size", "b"]).select(
            "label", "size", "i", "j", F.lit(k).alias("side"), "g", "vec", "coords"))
    dealt = (sides[0].unionByName(sides[1]).repartition("label", "size", "i", "j")
             .sortWithinPartitions("label", "size", "i", "j", "side", "g"))
    return dealt.mapInArrow(lambda b: _read_pairs(b, threshold, eps, leaf), "g long, links long, low long")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", threshold: float = THRESHOLD, dimensions: int = DIMENSIONS,
                    block_rows: int | None = None, leaf: int = LEAF) -> DataFrame:
    """(id, n_links, component_id, kept) of every vector."""
    eps = math.sqrt(max(2 - 2 * threshold, 0))
    rows = materialize(vectors.select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vec"),
        F.monotonically_increasing_id().alias("row")), "vectors")
    usable = rows.filter(F.col("label").isNotNull() & _usable(F.col("vec"))).withColumn("size", F.size("vec"))
    seen = usable.agg(F.count("*").alias("n"), F.max("size").alias("width")).first()
    alone = F.col("id").alias("component_id")
    if not seen["n"]:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), alone,
                           F.lit(True).alias("kept"))
    dimensions = min(dimensions, seen["width"])
    block_rows = block_rows or min(BLOCK_MOST, max(BLOCK_LEAST, seen["n"] // BLOCK_SHARE))
    sequence = grid_order(usable.select("label", "size", "row", "vec"), seen["width"], eps, dimensions)
    pairs = interval_pairs(sequence, seen["n"], block_rows, eps, dimensions)
    found = materialize(links(sequence, pairs, block_rows, threshold, eps, leaf), "links")
    counts = found.groupBy("g").agg(F.sum("links").alias("n_links"))
    roots = materialize(components(found.select(F.col("g").alias("src"), F.col("low").alias("dst"))), "roots")
    names = sequence.select("g", "row").join(rows.select("row", "id"), "row")
    linked = materialize(names.join(counts, "g").join(roots.withColumnRenamed("node", "g"), "g")
                         .select("row", "id", "n_links", "root"), "linked")
    first = linked.groupBy("root").agg(F.min("id").alias("component_id"), F.count("*").alias("n"))
    named = join_counted(linked, first, "root", linked.count()).select("row", "n_links", "component_id")
    component = F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return rows.select("row", "id").join(named, "row", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
