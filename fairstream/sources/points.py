"""Labelled points: reading text files, parsing lines, and the points we derive
from the driver's tables.

A labelled point is ``x double, y double, grp string`` (2-D) or
``features array<double>, grp string`` (n-D). The label is one character;
``A`` and ``B`` are the two groups the fairness metrics compare.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fairstream.sources.tables import read_table

GROUP_A = "A"
GROUP_B = "B"

# Fixed values of the points2d fixture: order priorities that form group A.
PRIORITIES_A = ("1-URGENT", "2-HIGH")


def _fields(line: Column) -> Column:
    # A line split on commas; trailing empty fields are dropped, as the
    # reference's string split does ("1,2,A," has the label "A").
    return F.split(F.regexp_replace(line, ",+$", ""), ",")


def _label(field: Column) -> Column:
    return F.substring(F.trim(field), 1, 1)


def parse_points(lines: DataFrame, dims: int | None = 2, line_col: str = "line",
                 mode: str = "FAILFAST") -> DataFrame:
    """Parse ``"c_1,...,c_n,label"`` lines into labelled points.

    ``dims=2``: fields 0 and 1 are x and y, field 2 is the label, later fields
    are ignored. ``dims=None``: every field but the last is a coordinate and the
    last one is the label. Other columns of ``lines`` are kept.

    ``mode="FAILFAST"`` (default) fails on a malformed number, like the
    reference; ``mode="DROPMALFORMED"`` drops such lines instead.
    """
    if mode not in ("FAILFAST", "DROPMALFORMED"):
        raise ValueError(f"unknown mode {mode!r}")
    strict = mode == "FAILFAST"
    cast = "cast" if strict else "try_cast"

    def field(i: int) -> str:      # strict: a missing field fails; else it reads NULL
        return f"_p[{i}]" if strict else f"get(_p, {i})"

    parts = _fields(F.col(line_col))
    keep = [c for c in lines.columns if c != line_col]
    if dims == 2:
        split = lines.select(*keep, parts.alias("_p"))
        out = split.select(
            *keep,
            F.expr(f"{cast}(trim({field(0)}) as double)").alias("x"),
            F.expr(f"{cast}(trim({field(1)}) as double)").alias("y"),
            _label(F.expr(field(2))).alias("grp"),
        )
        if not strict:
            out = out.dropna(subset=["x", "y", "grp"]).filter(F.length("grp") > 0)
        return out
    if dims is not None:
        raise ValueError("dims must be 2 or None (all fields but the last)")
    split = lines.select(*keep, parts.alias("_p"))
    out = split.select(
        *keep,
        F.expr(f"transform(slice(_p, 1, size(_p) - 1), v -> {cast}(trim(v) as double))")
        .alias("features"),
        _label(F.element_at(F.col("_p"), -1)).alias("grp"),
    )
    if not strict:
        out = out.filter(F.size("features") > 0).filter(
            ~F.exists("features", lambda v: v.isNull())).filter(F.length("grp") > 0)
    return out


def malformed_lines(lines: DataFrame, dims: int | None = 2, line_col: str = "line") -> DataFrame:
    """The rejects table: lines that ``parse_points(mode="FAILFAST")`` would fail
    on (a coordinate that is not a number, a missing field or an empty label),
    with a ``reason``. Together with ``mode="DROPMALFORMED"`` this gives a
    permissive read that keeps every input line accounted for."""
    parts = _fields(F.col(line_col))
    if dims == 2:
        coords = F.array(F.expr("try_cast(trim(get(_p, 0)) as double)"),
                         F.expr("try_cast(trim(get(_p, 1)) as double)"))
        label = F.trim(F.expr("get(_p, 2)"))
        too_short = F.size("_p") < 3
    elif dims is None:
        coords = F.expr("transform(slice(_p, 1, size(_p) - 1), v -> try_cast(trim(v) as double))")
        label = F.trim(F.element_at(F.col("_p"), -1))
        too_short = F.size("_p") < 2
    else:
        raise ValueError("dims must be 2 or None (all fields but the last)")
    reason = (F.when(too_short, F.lit("missing field"))
              .when(F.exists(coords, lambda v: v.isNull()), F.lit("not a number"))
              .when(F.coalesce(F.length(label), F.lit(0)) == 0, F.lit("empty label")))
    return (lines.withColumn("_p", parts)
            .withColumn("reason", reason)
            .filter(F.col("reason").isNotNull())
            .drop("_p"))


def read_points(spark: SparkSession, path: str, dims: int | None = 2,
                partitions: int | None = None, mode: str = "FAILFAST") -> DataFrame:
    """Read a headerless ``x,y,label`` (or n-D) text file into labelled points.

    ``partitions`` plays the role of the reference's L; when it is left out the
    file splits decide, which is what a large input wants.
    """
    if not path or not path.strip():
        raise ValueError("path must not be blank")
    lines = spark.read.text(path).withColumnRenamed("value", "line")
    if partitions is not None:
        if partitions <= 0:
            raise ValueError("partitions must be positive")
        lines = lines.repartition(partitions)
    return parse_points(lines, dims=dims, mode=mode)


def points2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """2-D labelled points from ``orders``: ``id, x, y, grp``.

    x = o_totalprice / 1000, y = day of year of o_orderdate, group A = the two
    top order priorities. Only three columns are read from the scan.
    """
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"),
        (F.col("o_totalprice") / 1000.0).alias("x"),
        F.dayofyear("o_orderdate").cast("double").alias("y"),
        F.when(F.col("o_orderpriority").isin(*PRIORITIES_A), F.lit(GROUP_A))
        .otherwise(F.lit(GROUP_B)).alias("grp"),
    )


def points2d_edge(spark: SparkSession, sf_dir: str, first_day: int) -> DataFrame:
    """``points2d`` with every point from day ``first_day`` on in group A."""
    late = F.col("y") >= first_day
    return points2d(spark, sf_dir).withColumn("grp", F.when(late, F.lit(GROUP_A)).otherwise(F.col("grp")))


def point_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``points2d`` written back as ``"x,y,grp"`` text lines: ``id, line``."""
    p = points2d(spark, sf_dir)
    return p.select("id", F.concat_ws(",", F.col("x").cast("string"),
                                      F.col("y").cast("string"), "grp").alias("line"))


def pointsnd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """64-d labelled points from ``embeddings``: ``id, features, grp``."""
    e = read_table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").alias("id"),
        F.col("embedding").cast("array<double>").alias("features"),
        F.when(F.col("label") % 2 == 0, F.lit(GROUP_A)).otherwise(F.lit(GROUP_B)).alias("grp"),
    )


def nd_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pointsnd`` written back as ``"c_1,...,c_64,grp"`` lines: ``id, line``."""
    p = pointsnd(spark, sf_dir)
    return p.select("id", F.concat_ws(
        ",", F.array_join(F.transform("features", lambda v: v.cast("string")), ","),
        "grp").alias("line"))


def strict_labels(points: DataFrame) -> DataFrame:
    """The points unchanged, but the job fails on a label other than A or B
    (by default such labels count as B in the statistics, are left out of Phi
    and of the fair rounds, and count in N and Delta)."""
    ok = F.col("grp").isin(GROUP_A, GROUP_B)
    msg = F.concat(F.lit("label is neither A nor B: "), F.coalesce(F.col("grp"), F.lit("null")))
    return points.withColumn("grp", F.when(ok, F.col("grp")).otherwise(F.raise_error(msg)))


def group_counts(points: DataFrame) -> DataFrame:
    """One pass over the points: ``n, n_a, n_b`` (rows, rows labelled A, rows labelled B)."""
    return points.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("grp") == GROUP_A).alias("n_a"),
        F.count_if(F.col("grp") == GROUP_B).alias("n_b"),
    )
