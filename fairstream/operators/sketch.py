"""Count-min and count sketches as cell tables ``row int, bucket int, cnt bigint``.

Building a sketch is an explode to the D cells each item touches followed by a
grouped sum: the partial aggregate runs before the exchange, so each map task
ships at most D*W rows however many items (or however skewed) it read, and the
final table has at most D*W rows. Cell tables from different inputs (or
micro-batches) merge by another grouped sum.

Several sketches over the same items are built in one pass as one tagged table
(``sketch string, row, bucket, cnt``) and read in one pass too: the table becomes
one row of dense arrays whose size is bounded by the parameters (sum of D*W,
checked), and every query row reads its cells of all sketches by index, without
an exchange (min for count-min, median for count sketch).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairstream.functions.hashing import SketchSpec, bucket, sign

# Most cells that go to every task as arrays: 4M longs are 32 MB; beyond it the
# lookup is a shuffled join.
BROADCAST_MAX_CELLS = 4 * 1024 * 1024


@dataclass(frozen=True)
class Sketch:
    """A named sketch: count-min (``signed=False``) or count sketch (``signed=True``)."""
    name: str
    spec: SketchSpec
    signed: bool = False

    def __post_init__(self):
        if self.signed and not self.spec.signs:
            raise ValueError("count sketch needs sign hashes")


def _tagged_refs(item: Column, sketches: Sequence[Sketch]) -> Column:
    """array<struct<sketch, row, bucket, sign>>: every cell the item touches in
    every sketch (plain column arithmetic, no higher-order function)."""
    refs = []
    for s in sketches:
        sp = s.spec
        for i, h in enumerate(sp.rows):
            sg = sign(item, sp.signs[i], sp.wrap32) if s.signed else F.lit(1)
            refs.append(F.struct(F.lit(s.name).alias("sketch"), F.lit(i).alias("row"),
                                 bucket(item, h, sp.width, sp.wrap32).alias("bucket"),
                                 sg.alias("sign")))
    return F.array(*refs)


def _check_names(sketches: Sequence[Sketch]) -> None:
    if not sketches:
        raise ValueError("need at least one sketch")
    if len({s.name for s in sketches}) != len(sketches):
        raise ValueError("sketch names must be distinct")


def build(items: DataFrame, sketches: Sequence[Sketch], item_col: str = "item",
          weight_col: str | None = None) -> DataFrame:
    """Cells of all ``sketches`` in one pass: ``sketch, row, bucket, cnt``.

    Every item adds its weight (1 by default) times its sign to its D cells of
    each sketch.
    """
    _check_names(sketches)
    w = F.col(weight_col).cast("bigint") if weight_col else F.lit(1).cast("bigint")
    ex = items.select(F.inline(_tagged_refs(F.col(item_col), sketches)), w.alias("_w"))
    return ex.groupBy("sketch", "row", "bucket").agg(
        F.sum(F.col("sign").cast("bigint") * F.col("_w")).alias("cnt"))


def _single(items: DataFrame, s: Sketch, item_col: str, weight_col: str | None) -> DataFrame:
    return build(items, [s], item_col, weight_col).drop("sketch")


def cms_cells(items: DataFrame, s: SketchSpec, item_col: str = "item",
              weight_col: str | None = None) -> DataFrame:
    """Count-min cells: every item adds 1 (or its weight) to its D cells."""
    return _single(items, Sketch("cm", s), item_col, weight_col)


def cs_cells(items: DataFrame, s: SketchSpec, item_col: str = "item",
             weight_col: str | None = None) -> DataFrame:
    """Count-sketch cells: every item adds +-1 (or +-weight) to its D cells."""
    return _single(items, Sketch("cs", s, signed=True), item_col, weight_col)


def merge_cells(*cells: DataFrame) -> DataFrame:
    """Sum cell tables of one spec (sketches are linear)."""
    if not cells:
        raise ValueError("nothing to merge")
    keys = ["sketch", "row", "bucket"] if "sketch" in cells[0].columns else ["row", "bucket"]
    u = cells[0]
    for c in cells[1:]:
        u = u.unionByName(c)
    return u.groupBy(*keys).agg(F.sum("cnt").alias("cnt"))


def _median(values: Column, d: int) -> Column:
    """Median of a sorted array of D longs; even D: mean of the middle two,
    truncated toward zero."""
    if d % 2 == 1:
        return F.element_at(values, d // 2 + 1)
    mid = F.element_at(values, d // 2) + F.element_at(values, d // 2 + 1)
    # halve toward zero in exact integer arithmetic: drop the odd unit (which
    # carries the sign of mid), then shift the even value right by one
    return F.shiftright(mid - mid % 2, 1)


def dense(cells: DataFrame, sketches: Sequence[Sketch]) -> DataFrame:
    """One row: a struct column ``arrays`` with one array of W counts for each row of
    each sketch (``<name>_<i>``), read by index; a cell never hit holds 0.

    The size is that of the sketches (sum of D x W longs), whatever the stream."""
    _check_names(sketches)
    names = [(s, i, f"{s.name}_{i}") for s in sketches for i in range(s.spec.depth)]
    rows = F.array(*[F.struct(F.lit(s.name).alias("sketch"), F.lit(i).alias("row"),
                              F.lit(s.spec.width - 1).alias("last")) for s, i, _ in names])
    empty = cells.sparkSession.range(1).select(F.inline(rows)).select(
        "sketch", "row", F.explode(F.sequence(F.lit(0), "last")).alias("bucket"), F.lit(0).cast("bigint").alias("cnt"))
    every = empty.union(cells.select("sketch", "row", "bucket", "cnt"))
    by_row = every.repartition("sketch", "row")          # serves both groupings
    filled = by_row.groupBy("sketch", "row", "bucket").agg(F.sum("cnt").alias("cnt"))
    arrays = filled.groupBy("sketch", "row").agg(
        F.sort_array(F.collect_list(F.struct("bucket", "cnt"))).getField("cnt").alias("v"))
    one = arrays.agg(*[F.max(F.when((F.col("sketch") == s.name) & (F.col("row") == i), F.col("v"))).alias(n)
                       for s, i, n in names])
    return one.select(F.struct(*[n for _, _, n in names]).alias("arrays"))


def estimate(query: DataFrame, cells: DataFrame, sketches: Sequence[Sketch],
             item_col: str = "item") -> DataFrame:
    """Adds ``<name>_est`` per sketch to every query row (count-min: minimum over
    the D rows; count sketch: median of cell * sign). A cell never hit reads 0.

    ``cells`` is the tagged table from ``build``; the query's columns are kept
    (those with the name of an estimate are replaced) and every query row gets its
    own estimate. The sketches become one row of dense arrays, a scalar subquery:
    each query row reads its D cells by index, with no exchange of the query side.
    Above ``BROADCAST_MAX_CELLS`` cells they are looked up by a shuffled join.
    """
    _check_names(sketches)
    new = {f"{s.name}_est".lower() for s in sketches}
    keep = [F.col(f"`{c}`") for c in query.columns if c.lower() not in new]
    if sum(s.spec.cells for s in sketches) > BROADCAST_MAX_CELLS:
        return _estimate_by_join(query, cells, sketches, item_col, keep)
    arrays = dense(cells, sketches).scalar()
    item, outs = F.col(item_col), []
    for s in sketches:
        read = [F.coalesce(arrays.getField(f"{s.name}_{i}")[bucket(item, h, s.spec.width, s.spec.wrap32)],
                           F.lit(0).cast("bigint")) for i, h in enumerate(s.spec.rows)]       # a null item reads 0
        if s.signed:
            read = [v * sign(item, h, s.spec.wrap32).cast("bigint") for v, h in zip(read, s.spec.signs)]
        outs.append(_read_out(F.array(*read), s).alias(f"{s.name}_est"))
    return query.select(*keep, *outs)


def _read_out(values: Column, s: Sketch) -> Column:
    return _median(F.sort_array(values), s.spec.depth) if s.signed else F.array_min(values)


def _estimate_by_join(query: DataFrame, cells: DataFrame, sketches: Sequence[Sketch], item_col: str,
                      keep: list[Column]) -> DataFrame:
    """Estimates of the distinct items through a join of all their cells, brought
    back to the query rows by the item."""
    items = query.select(F.col(item_col).alias("item")).distinct()
    refs = items.select("item", F.inline(_tagged_refs(F.col("item"), sketches)))
    found = refs.join(cells.select("sketch", "row", "bucket", "cnt"), ["sketch", "row", "bucket"], "left")
    value = F.coalesce("cnt", F.lit(0).cast("bigint")) * F.col("sign").cast("bigint")
    grouped = found.groupBy("item").agg(*[      # D values for each item and sketch
        F.collect_list(F.when(F.col("sketch") == s.name, value)).alias(f"v_{s.name}") for s in sketches])
    outs = [f"{s.name}_est" for s in sketches]
    est = grouped.select(F.col("item").alias("_item"), F.struct(*[
        _read_out(F.col(f"v_{s.name}"), s).alias(n) for s, n in zip(sketches, outs)]).alias("_out"))
    row = query.select(F.col(item_col).alias("_item"), F.struct(*keep).alias("_row"))
    return row.join(est, F.col("_row").isNotNull() & row["_item"].eqNullSafe(est["_item"])).select(
        "_row.*", *[F.col(f"_out.{n}") for n in outs])


def cms_estimate(query: DataFrame, cells: DataFrame, s: SketchSpec,
                 item_col: str = "item") -> DataFrame:
    """Count-min estimate per query row: adds ``est``."""
    tagged = cells.withColumn("sketch", F.lit("cm"))
    return estimate(query, tagged, [Sketch("cm", s)], item_col).withColumnRenamed("cm_est", "est")


def cs_estimate(query: DataFrame, cells: DataFrame, s: SketchSpec,
                item_col: str = "item") -> DataFrame:
    """Count-sketch estimate per query row: adds ``est`` (median over the D rows;
    with an even D the two middle values are averaged, truncated toward zero)."""
    tagged = cells.withColumn("sketch", F.lit("cs"))
    return estimate(query, tagged, [Sketch("cs", s, signed=True)], item_col) \
        .withColumnRenamed("cs_est", "est")
