"""Nearest-centre assignment, Lloyd rounds and k-means.

Only centre lists (K x d numbers) live on the driver. Each Lloyd round is one
Spark job: a map-only assignment (centres are literals in the plan) followed by
a grouped aggregate of at most K rows, so the shuffle carries K partial rows
per map task whatever the data size, and no cluster is ever gathered in one
task even when one holds most of the points.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType

from fairstream.functions.distance import check_centers, coordinate_columns, nearest
from fairstream.functions.exact import NON_FINITE, Grid, coordinate_grid
from fairstream.operators import seeding
from fairstream.session import spread

Centers = list[list[float]]


WRONG_WIDTH = "a point and the centres differ in size"
# Above this many numbers (centres x coordinates) a plan of literals costs more
# than Arrow batches; arrays of 64 coordinates are beyond it from two centres on.
COLUMNS_MAX_NUMBERS = 127
# From this many centres on the array path looks them up through a k-d tree.
TREE_MIN_CENTERS = 64


def free_name(name: str, taken: Sequence[str]) -> str:
    """``name``, longer if a column has it already."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name += "_"
    return name


def assign(points: DataFrame, centers: Sequence[Sequence[float]],
           cols: Sequence[str] | None = ("x", "y"), features: str = "features",
           method: str = "auto", finite: bool = True) -> DataFrame:
    """Add ``cluster int`` and ``dist2 double`` (squared distance to it).

    ``cols`` names scalar coordinate columns; pass ``cols=None`` to use the
    array column ``features``. Ties go to the lowest centre index. Both outputs
    come from one struct, so the distances are computed once per row.

    ``method``: ``"columns"`` keeps the work in JVM expressions (written out
    term by term up to 16 coordinates, folded over the array above that);
    ``"pandas"`` computes the K distances of an Arrow batch at once with numpy;
    ``"auto"`` picks by K x d, as the plan of the column form grows with it: 4
    centres in 2-D take 0.4 s there and 100 centres 13 s, against 1.2 s with
    numpy. Both add the terms from left to right, so they agree on ties. A point
    of another size than the centres fails the job.

    ``finite=True`` fails the job on a point whose nearest distance is NaN or
    infinite (a NaN or infinite coordinate), where a scan for the minimum
    would find no centre; ``finite=False`` keeps such rows (NaN sorts last,
    so they get centre 0).
    """
    cs = check_centers(centers)
    dims = len(cs[0])
    if method == "auto":
        method = "pandas" if len(cs) * dims > COLUMNS_MAX_NUMBERS else "columns"
    if method == "pandas":
        return _assign_pandas(points, cs, cols, features, finite)
    if method != "columns":
        raise ValueError(f"unknown method {method!r}")
    kept = [c for c in points.columns if c.lower() not in ("cluster", "dist2")]
    near = free_name("_nc", points.columns)
    dist = F.col(f"{near}.dist2")
    if finite:      # one comparison: false for NaN and for +inf
        dist = F.when(dist < float("inf"), dist).otherwise(
            F.raise_error(F.lit(NON_FINITE)).cast("double"))
    return points.withColumn(near, nearest(cs, cols, features)).select(
        *[F.col(f"`{c}`") for c in kept], F.col(f"{near}.cluster").alias("cluster"), dist.alias("dist2"))


def array_rows(column, dims: int):
    """The rows of an Arrow list column as a matrix; another width fails."""
    import numpy as np
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(flat) != len(column) * dims or (len(column) and (column.value_lengths().to_numpy() != dims).any()):
        raise ValueError(WRONG_WIDTH)
    return np.asarray(flat, np.float64).reshape(-1, dims)


def _distances(x, centers):
    """n x K squared distances. Terms are added left to right, as the column form
    does, so both see the same distances."""
    import numpy as np
    d = np.zeros((len(x), len(centers)))
    for j in range(x.shape[1]):
        diff = x[:, j, None] - centers[None, :, j]
        d += diff * diff
    return d


def center_leaves(centers, size: int) -> list:
    """Index arrays of a k-d tree's leaves: the centres are halved at the median of
    their widest coordinate until at most ``size`` are left."""
    import numpy as np
    todo, leaves = [np.arange(len(centers))], []
    while todo:
        at = todo.pop()
        if len(at) <= size:
            leaves.append(np.sort(at))
            continue
        axis = np.ptp(centers[at], axis=0).argmax()
        order = at[np.argsort(centers[at, axis], kind="stable")]
        todo += [order[:len(at) // 2], order[len(at) // 2:]]
    return leaves


def nearest_rows(x, centers, tree_from: int = TREE_MIN_CENTERS, counted: list | None = None):
    """(index, squared distance) of the nearest centre of each row of a matrix, the
    lowest index among equals.

    From ``tree_from`` centres on they are put into the leaves of a k-d tree, and a
    row looks only into leaves whose box is no further away than the nearest centre
    known; the answers are those of the plain scan. ``counted`` gets the number of
    distances taken."""
    import numpy as np
    n, k = len(x), len(centers)
    idx, dist = np.zeros(n, np.int64), np.zeros(n)
    use_tree = k >= tree_from
    leaves = center_leaves(centers, max(1, round(math.sqrt(k)))) if use_tree else []
    step = max(1, (1 << 24) // max(len(leaves) if use_tree else k, 1))       # 128 MB of distances at a time
    for lo in range(0, n, step):
        part = x[lo:lo + step]
        if use_tree and np.isfinite(part).all():
            idx[lo:lo + step], dist[lo:lo + step], taken = _nearest_by_leaf(part, centers, leaves)
        else:
            d = _distances(part, centers)
            at = np.where(np.isnan(d), np.inf, d).argmin(axis=1)   # NaN sorts last, as in SQL
            idx[lo:lo + step], dist[lo:lo + step], taken = at, d[np.arange(len(part)), at], d.size
        if counted is not None:
            counted.append(taken)
    return idx, dist


def _nearest_by_leaf(x, centers, leaves):
    import numpy as np
    best, at = np.full(len(x), np.inf), np.full(len(x), len(centers))
    low = np.stack([centers[m].min(0) for m in leaves])
    high = np.stack([centers[m].max(0) for m in leaves])
    gap = np.zeros((len(x), len(leaves)))                          # squared distance to each leaf's box
    for j in range(x.shape[1]):
        out = np.maximum(np.maximum(low[None, :, j] - x[:, j, None], x[:, j, None] - high[None, :, j]), 0)
        gap += out * out
    taken = 0

    def look(rows, members):
        d = _distances(x[rows], centers[members])
        k = d.argmin(axis=1)                                       # members are in order: the lowest index
        value, index = d[np.arange(len(rows)), k], members[k]
        better = (value < best[rows]) | ((value == best[rows]) & (index < at[rows]))
        best[rows[better]], at[rows[better]] = value[better], index[better]
        return d.size

    first = gap.argmin(axis=1)
    for g, members in enumerate(leaves):
        rows = np.flatnonzero(first == g)
        taken += look(rows, members) if len(rows) else 0
    for g, members in enumerate(leaves):                           # a little slack for rounding of the gaps
        rows = np.flatnonzero((first != g) & (gap[:, g] * (1 - 1e-9) <= best))
        taken += look(rows, members) if len(rows) else 0
    return at, best, taken


def _assign_pandas(points: DataFrame, centers: Centers, cols: Sequence[str] | None,
                   features: str, finite: bool = True) -> DataFrame:
    """The nearest centre of every row of each Arrow batch, with numpy."""
    import numpy as np
    import pandas as pd  # noqa: F401  (used by mapInPandas)

    c = np.asarray(centers, dtype="float64")
    out_schema = (points.drop("cluster", "dist2").schema
                  .add("cluster", IntegerType(), False).add("dist2", DoubleType(), True))
    names = list(cols) if cols else None

    def nearest_batches(batches):
        for pdf in batches:
            pdf = pdf.drop(columns=[n for n in ("cluster", "dist2") if n in pdf.columns])
            n = len(pdf)
            if names:
                x = pdf[names].to_numpy(dtype="float64")
            else:
                x = np.stack(pdf[features].to_numpy()).astype("float64").reshape(n, -1) if n else \
                    np.zeros((0, c.shape[1]))
            if x.shape[1] != c.shape[1]:
                raise ValueError(WRONG_WIDTH)
            idx, dist = nearest_rows(x, c)
            if finite and not np.isfinite(dist).all():
                raise ValueError(NON_FINITE)
            pdf["cluster"] = idx.astype("int32")
            pdf["dist2"] = dist
            yield pdf

    return points.drop("cluster", "dist2").mapInPandas(nearest_batches, out_schema)


def coordinate_exprs(cols: Sequence[str] | None, dims: int,
                     features: str = "features") -> list[Column]:
    return coordinate_columns(cols, dims, features)


def _mean_aggs(cols: Sequence[str] | None, dims: int, features: str) -> list[Column]:
    coords = coordinate_exprs(cols, dims, features)
    return [F.avg(c).alias(f"_m{j}") for j, c in enumerate(coords)]


def vector_stats(df: DataFrame, features: str, keys: Sequence[str]) -> DataFrame:
    """Per group of ``keys``: ``n``, ``_mean`` and ``_var`` (sample variance) of an
    array column, as arrays, with Spark ML's ``Summarizer``: one vector
    aggregate instead of two columns per coordinate."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    s = Summarizer.metrics("mean", "variance", "count")
    g = df.select(*keys, array_to_vector(features).alias("_vec")).groupBy(*keys) \
        .agg(s.summary(F.col("_vec")).alias("_s"))
    return g.select(*keys, F.col("_s.count").alias("n"),
                    vector_to_array("_s.mean").alias("_mean"),
                    vector_to_array("_s.variance").alias("_var"))


def exact_groups(points: DataFrame, centers: Sequence[Sequence[float]], grid: Grid,
                 cols: Sequence[str] | None = ("x", "y"), features: str = "features",
                 label: str | None = None) -> list[dict]:
    """One job: per cluster (and value of column ``label``) its ``n``, ``sums`` of the
    coordinates and ``cost`` (the sum of dist2), to the last bit the same for every
    partitioning. The K x labels groups come back to the driver.

    Each task adds up the fixed-point parts of its Arrow batches and hands over one
    number per group, coordinate and part; Spark adds these bigints. The plan is the
    same in every round (the centres travel with the function), so nothing is
    compiled anew.
    """
    cs = check_centers(centers)
    dims = len(cs[0])
    far = grid.squares(dims, cs)
    sums: dict = {}
    for r in _partial_sums(points, cs, grid, far, cols, features, label).collect():
        sums.setdefault((r["cluster"], r["label"]), {})[r["at"]] = r["v"]
    parts, out = len(grid.widths), []
    for (cluster, name), v in sorted(sums.items(), key=repr):
        total = [g.total([v[j * parts + k] for k in range(parts)]) for j, g in enumerate([grid] * dims + [far])]
        out.append({"cluster": cluster, "label": name, "n": v[-1], "sums": total[:dims], "cost": total[dims]})
    return out


def _partial_sums(points: DataFrame, centers: Centers, grid: Grid, far: Grid, cols: Sequence[str] | None,
                  features: str, label: str | None) -> DataFrame:
    """``cluster, label, at, v``: summed parts; ``at`` = -1 holds the number of rows."""
    import numpy as np
    import pyarrow as pa

    c = np.asarray(centers, dtype="float64")
    dims, names = c.shape[1], [f"_x{j}" for j in range(len(cols))] if cols else None

    def run(batches):
        held: dict = {}
        for batch in batches:
            if names:
                x = np.column_stack([batch.column(n).to_numpy(zero_copy_only=False) for n in names])
            else:
                x = array_rows(batch.column("_f"), dims)
            cluster, dist2 = nearest_rows(x, c)
            if not np.isfinite(dist2).all():
                raise ValueError(NON_FINITE)
            values = np.concatenate([grid.split(x), far.split(dist2)[:, None, :]], axis=1).reshape(len(x), -1)
            words = batch.column("_label").dictionary_encode()
            group = cluster * (len(words.dictionary) + 1) + words.indices.fill_null(len(words.dictionary)).to_numpy()
            order = np.argsort(group, kind="stable")
            found, starts, counts = np.unique(group[order], return_index=True, return_counts=True)
            added = np.add.reduceat(values[order], starts, axis=0) if len(found) else []
            for g, n, v in zip(found.tolist(), counts.tolist(), added):
                k, word = divmod(g, len(words.dictionary) + 1)
                key = (k, words.dictionary[word].as_py() if word < len(words.dictionary) else None)
                before = held.get(key, (0, 0))
                held[key] = (before[0] + n, before[1] + v)
        for (k, word), (n, v) in held.items():
            size = len(v) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([k] * size, pa.int32()), pa.array([word] * size, pa.string()),
                 pa.array([-1, *range(len(v))], pa.int32()), pa.array([n, *v.tolist()], pa.int64())],
                names=["cluster", "label", "at", "v"])

    coords = [F.col(x).cast("double").alias(n) for x, n in zip(cols, names)] if cols else \
        [F.col(features).cast("array<double>").alias("_f")]
    word = F.col(label).cast("string") if label else F.lit(None).cast("string")
    return (points.select(*coords, word.alias("_label")).mapInArrow(run, "cluster int, label string, at int, v long")
            .groupBy("cluster", "label", "at").agg(F.sum("v").alias("v")))


def lloyd_step(points: DataFrame, centers: Sequence[Sequence[float]],
               cols: Sequence[str] | None = ("x", "y"), features: str = "features") -> DataFrame:
    """One Lloyd update as a lazy DataFrame: ``cluster, n, _m0.._m{d-1}``.

    Only clusters that received points appear; callers keep the previous
    centre for the others (as Spark ML does for an empty cluster).
    """
    cs = check_centers(centers)
    dims = len(cs[0])
    a = assign(points, cs, cols, features)
    if not cols:
        g = vector_stats(a, features, ["cluster"])
        return g.select("cluster", "n", *[F.col("_mean")[j].alias(f"_m{j}") for j in range(dims)])
    return a.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"),
                                    *_mean_aggs(cols, dims, features))


def lloyd_round(points: DataFrame, centers: Centers, grid: Grid, cols: Sequence[str] | None = ("x", "y"),
                features: str = "features") -> Centers:
    """The centres after one Lloyd round with exact sums (one job, K rows back)."""
    new = [list(c) for c in centers]
    for g in exact_groups(points, centers, grid, cols, features):
        new[g["cluster"]] = [v / g["n"] for v in g["sums"]]
    return new


class RoundLog:
    """Centres after each finished round, written as K rows under ``path``
    (a folder in the shared ``spark.checkpoint.dir``), so that a restarted
    driver resumes an iterative job at the last finished round instead of
    repeating full passes over the data."""

    def __init__(self, spark, path: str | None, kind: str, start: Centers):
        self.spark, self.start = spark, start
        self.path = f"{path}/{kind}" if path else None

    def _round(self, rnd: int) -> Centers:
        rows = self.spark.read.parquet(f"{self.path}/round={rnd}").collect()     # K rows
        return [list(x["center"]) for x in sorted(rows, key=lambda x: x["cluster"])]

    def resume(self, rounds: int) -> tuple[int, Centers]:
        """The last finished round up to ``rounds`` and its centres. The log is
        tied to its start centres: those of another run or other data are an error."""
        if not self.path:
            return 0, self.start
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            self.write(0, self.start)
            return 0, self.start
        if self._round(0) != self.start:
            raise ValueError(f"the round log at {self.path} began from other centres")
        done = self.spark.read.parquet(self.path).agg(F.max("round")).first()[0]
        done = min(int(done), rounds)
        return done, self._round(done)

    def write(self, rnd: int, centers: Centers) -> None:
        if self.path:
            rows = [(i, [float(v) for v in c]) for i, c in enumerate(centers)]   # K rows
            self.spark.createDataFrame(rows, "cluster int, center array<double>") \
                .coalesce(1).write.mode("overwrite").parquet(f"{self.path}/round={rnd}")


def lloyd(points: DataFrame, centers: Sequence[Sequence[float]], rounds: int,
          cols: Sequence[str] | None = ("x", "y"), features: str = "features",
          persist: bool = True, log_path: str | None = None, tol: float | None = None) -> Centers:
    """``rounds`` Lloyd iterations from the given centres; returns the centres.
    With ``tol`` the loop ends when no centre has moved further than that. Sums are
    exact, so partitioning does not change the centres.

    The points are persisted once (memory, spilling to disk) around the loop
    and released afterwards; each round's plan carries the centres as literals,
    so the lineage does not grow with the number of rounds. With ``log_path``
    every finished round is logged and a rerun resumes after the last one.
    """
    if rounds < 0:
        raise ValueError("rounds must be >= 0")
    cs = check_centers(centers)
    log = RoundLog(points.sparkSession, log_path, "lloyd", cs)
    done, cs = log.resume(rounds)
    cached = cache_points(points, cols, features) if persist and rounds - done > 1 else points
    try:
        grid = coordinate_grid(cached, cols, features) if rounds > done else None
        for r in range(done, rounds):
            before, cs = cs, lloyd_round(cached, cs, grid, cols, features)
            log.write(r + 1, cs)
            if tol is not None and all(math.dist(a, b) <= tol for a, b in zip(before, cs)):
                break
    finally:
        if cached is not points:
            cached.unpersist()
    return cs


def lloyd_rounds(points: DataFrame, centers: Sequence[Sequence[float]], rounds: int,
                 cols: Sequence[str] | None = ("x", "y"),
                 features: str = "features") -> DataFrame:
    """Centres after ``rounds`` Lloyd rounds as a DataFrame ``cluster, n, <coords>``.

    The first ``rounds - 1`` rounds run as jobs (K rows come back each time);
    the last one is returned lazily, so the result is a Spark aggregate of the
    input. A cluster that received no points keeps its previous centre, n = 0.
    Scalar coordinates: K placeholder rows (one per cluster, null coordinates)
    join the assigned points through a union, so every cluster has a group and
    the data is scanned once. Array coordinates: the K cluster ids are
    left-joined with the Summarizer aggregate (at most K rows, broadcast).
    """
    if rounds < 1:
        raise ValueError("rounds must be >= 1")
    cs = lloyd(points, centers, rounds - 1, cols, features)
    k, dims = len(cs), len(cs[0])
    names = list(cols) if cols else [f"c{j}" for j in range(dims)]
    prev = [F.array(*[F.lit(c[j]) for c in cs])[F.col("cluster")] for j in range(dims)]
    holders = points.sparkSession.range(k).select(F.col("id").cast("int").alias("cluster"))
    if not cols:
        # K cluster ids left-joined with the (at most K-row) aggregate
        step = lloyd_step(points, cs, cols, features)
        g = holders.join(F.broadcast(step), "cluster", "left") \
            .withColumn("n", F.coalesce(F.col("n"), F.lit(0)).cast("long"))
        return g.select("cluster", "n", *[F.coalesce(F.col(f"_m{j}"), prev[j]).alias(names[j])
                                          for j in range(dims)])
    coords = coordinate_exprs(cols, dims, features)
    a = assign(points, cs, cols, features)
    real = a.select("cluster", F.lit(1).alias("_one"),
                    *[c.cast("double").alias(f"_x{j}") for j, c in enumerate(coords)])
    holders = holders.select("cluster", F.lit(None).cast("int").alias("_one"),
                             *[F.lit(None).cast("double").alias(f"_x{j}") for j in range(dims)])
    g = real.unionByName(holders).groupBy("cluster").agg(
        F.count("_one").alias("n"), *[F.avg(f"_x{j}").alias(f"_m{j}") for j in range(dims)])
    return g.select("cluster", "n", *[F.coalesce(F.col(f"_m{j}"), prev[j]).alias(names[j])
                                      for j in range(dims)])


def cache_points(points: DataFrame, cols: Sequence[str] | None = ("x", "y"),
                 features: str = "features", extra: Sequence[str] = ("grp",),
                 partitions: int | None = None) -> DataFrame:
    """Project the columns an iterative job needs and persist (memory, then disk),
    in ``partitions`` partitions if given."""
    keep = [*(list(cols) if cols else [features]), *[c for c in extra if c in points.columns]]
    return spread(points.select(*keep), partitions).persist(StorageLevel.MEMORY_AND_DISK)


def kmeans(points: DataFrame, k: int, max_iter: int, seed: int,
           cols: Sequence[str] | None = ("x", "y"), features: str = "features",
           id_col: str | None = None, init_steps: int = seeding.STEPS, tol: float = 1e-4) -> Centers:
    """k-means: a keyed k-means|| start (``seeding``), then Lloyd until no centre
    moves further than ``tol`` or ``max_iter`` rounds are done; returns the centres.

    The reference leaves the start unseeded; here ``seed`` is required, and the same
    seed and points give the same centres however they are partitioned. ``id_col``
    names a unique column; without it points are told apart by their coordinates.
    Points that the caller has persisted are used as they are.
    """
    if max_iter < 0:
        raise ValueError("max_iter must be >= 0")
    extra = [id_col] if id_col else []
    cached = points if points.is_cached else cache_points(points, cols, features, extra)
    try:
        start = seeding.keyed_start(cached, k, seed, cols, features, id_col, init_steps)
        return lloyd(cached, start, max_iter, cols, features, persist=False, tol=tol)
    finally:
        if cached is not points:
            cached.unpersist()


def init_centers(points: DataFrame, k: int, seed: int, cols: Sequence[str] | None = ("x", "y"),
                 features: str = "features", id_col: str | None = None) -> Centers:
    """The start alone (k-means with zero Lloyd iterations)."""
    return kmeans(points, k, 0, seed, cols, features, id_col)


def centers_frame(spark, centers: Sequence[Sequence[float]],
                  names: Sequence[str] | None = None) -> DataFrame:
    """A K-row DataFrame ``cluster int, <coords>`` of a centre list."""
    cs = check_centers(centers)
    dims = len(cs[0])
    names = list(names) if names else [f"c{j}" for j in range(dims)]
    rows = [(i, *c) for i, c in enumerate(cs)]
    df = spark.createDataFrame(rows, ["cluster", *names])
    return df.withColumn("cluster", F.col("cluster").cast("int"))
