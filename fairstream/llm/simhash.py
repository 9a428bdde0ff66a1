"""SimHash near-duplicates with BK-trees.

1. Each text becomes a 64-bit fingerprint (map-only); equal ones are grouped.
2. Fingerprints are dealt into shards: the 64 bits are cut into blocks, and two
   fingerprints within the radius agree on all blocks but ``radius`` at least,
   so a shard is one choice of that many blocks and their value.
3. A shard is a BK-tree: children hang at their integer Hamming distance from
   the parent, and a search follows only edges within the radius. A shard above
   ``SHARD_LIMIT`` is cut into parts; the tree of each part is sent to every
   pair of parts, so no task holds more than two of them.
4. A task returns one link per fingerprint and local group, not all pairs;
   Spark joins the links of all shards into components (``graph``: the minima of
   hot centres are broadcast).

A shard's tree is built in the task that its rows reach: the trees of all
shards together grow with the data, so sending all of them to all executors
has no size bound.

Defined results: null and empty texts and texts without words have fingerprint
zero and link like any other; rows with one doc_id are documents of their own;
the smallest doc_id ignores nulls (null if a component has no other); input
columns with the name of a result are replaced; very long texts are hashed whole,
in chunks; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairstream.llm.graph import components
from fairstream.llm.shared import Renamed, add_arrow_columns, materialize, text_bytes

SHINGLE, RADIUS, SEED = 4, 4, 42
LEAST_BLOCKS, MOST_BLOCKS = 6, 8
SHARD_LIMIT = 1024
#: A fingerprint with more than one in so many rows is joined by broadcast.
HOT_SHARE = 1000

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_CHUNK = 1 << 15


def fingerprint(text: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Bit b is 1 if it is set in over half of the shingle hashes."""
    words = text.translate(_LOWER).split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, seed)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    first, last = (ends - lengths)[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(first, last, strict=True)), "<u8", len(first))
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _CHUNK):
        part = hashes[at:at + _CHUNK].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return sum(1 << int(b) for b in np.flatnonzero(2 * counts > len(hashes)))


def add_fingerprints(docs: DataFrame, text_col: str = "text", name: str = "_fp",
                     drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` plus the fingerprint as a signed long."""
    def make() -> Callable[[pa.RecordBatch], list]:
        def work(batch: pa.RecordBatch) -> list:
            prints = [fingerprint(t) for t in text_bytes(batch.column(text_col))]
            return [pa.array(np.array(prints, np.uint64).view(np.int64))]
        return work
    return add_arrow_columns(docs, [T.StructField(name, T.LongType())], make, drop)


class BKTree:
    """A tree of integers under Hamming distance."""

    def __init__(self, radius: int):
        self.radius, self.values, self.children = radius, [], []

    def add(self, value: int) -> None:
        self.values.append(value)
        self.children.append({})
        at, new = 0, len(self.values) - 1
        while at != new:
            d = (self.values[at] ^ value).bit_count()
            at = self.children[at].setdefault(d, new)

    def near(self, value: int) -> Iterator[int]:
        """The values within the radius; only edges that can lead to one are followed."""
        todo = [0] if self.values else []
        while todo:
            at = todo.pop()
            d = (self.values[at] ^ value).bit_count()
            if d <= self.radius:
                yield self.values[at]
            todo.extend(c for e, c in self.children[at].items() if abs(e - d) <= self.radius)


def shard_links(left: list[int], right: list[int] | None, radius: int) -> Iterator[tuple[int, int]]:
    """One link (value, root) for each value that the tree of ``left`` ties to
    another one; ``right`` (default: ``left`` itself) are the searched values."""
    tree, parent = BKTree(radius), {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    if right is not None:
        for value in left:
            tree.add(value)
    for value in left if right is None else right:
        for other in tree.near(value):
            a, b = root(value), root(other)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if right is None:
            tree.add(value)
    return ((x, r) for x in list(parent) if (r := root(x)) != x)


def _block_edges(blocks: int) -> list[tuple[int, int]]:
    cut = [round(64 * i / blocks) for i in range(blocks + 1)]
    return list(zip(cut, cut[1:], strict=False))


def shard_keys(fp: Column, radius: int, blocks: int) -> Column:
    """The shards of a fingerprint: for each choice of blocks, the choice and their bits."""
    edges = _block_edges(blocks)
    keys = []
    for k, chosen in enumerate(itertools.combinations(edges, blocks - radius)):
        mask = sum((1 << hi) - (1 << lo) for lo, hi in chosen)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.xxhash64(F.lit(k), fp.bitwiseAND(F.lit(signed))))
    return F.array(*keys)


def _read_shards(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, i, j): one tree at a time, whatever the batch borders."""
    def links(unit: tuple, rows: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
        _, i, j = unit
        if i == j:
            yield from shard_links([v for _, v in rows], None, radius)
        else:
            yield from shard_links([v for p, v in rows if p == i], [v for p, v in rows if p == j], radius)

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("key", "i", "j", "part", "fp")), strict=True)

    out: list[tuple[int, int]] = []
    for unit, members in itertools.groupby(rows(), key=lambda r: r[:3]):
        out.extend(links(unit, [(p, v & ((1 << 64) - 1)) for _, _, _, p, v in members]))
        if len(out) >= 1 << 16:
            yield _pairs(out)
            out = []
    yield _pairs(out)


def _pairs(links: list[tuple[int, int]]) -> pa.RecordBatch:
    flat = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(flat[:, 0].copy()), pa.array(flat[:, 1].copy())], names=["src", "dst"])


def blocks_for(count: int, radius: int = RADIUS, shard_limit: int = SHARD_LIMIT) -> int:
    """Blocks for ``count`` distinct fingerprints: the fewest (each more costs keys) whose
    shards, were the bits even, hold ``shard_limit`` or fewer. Any number is exact."""
    for blocks in range(max(LEAST_BLOCKS, radius + 1), MOST_BLOCKS):
        if count <= shard_limit << (64 * (blocks - radius) // blocks):
            return blocks
    return max(MOST_BLOCKS, radius + 1)


def links(prints: DataFrame, radius: int = RADIUS, blocks: int | None = None,
          shard_limit: int = SHARD_LIMIT) -> DataFrame:
    """Links (src, dst) whose components are those of all pairs within ``radius``.

    ``prints`` holds distinct fingerprints in ``_fp``.
    """
    blocks = blocks or blocks_for(prints.count(), radius, shard_limit)
    keyed = prints.select("_fp", F.explode(shard_keys(F.col("_fp"), radius, blocks)).alias("key"))
    full = (keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
            .select("key", F.ceil(F.col("n") / shard_limit).cast("int").alias("parts")))
    part = F.pmod(F.xxhash64("_fp", F.lit(SEED)), F.col("parts")).cast("int")
    member = keyed.join(full, "key").select("key", F.col("_fp").alias("fp"), part.alias("part"), "parts")
    units = member.select(
        "key", "fp", "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("_other")).select(
        "key", F.least("part", "_other").alias("i"), F.greatest("part", "_other").alias("j"), "part", "fp")
    dealt = units.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "fp")
    found = dealt.mapInArrow(lambda b: _read_shards(b, radius), "src long, dst long")
    return found.groupBy("src", "dst").agg(F.lit(1).alias("_")).select("src", "dst")


def classes(prints: DataFrame, id_col: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """(_fp, copies, component_id, keeper): for each distinct fingerprint of ``prints``
    its number of rows, the smallest id of its component, and the fingerprint that holds it."""
    first = F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col("_fp").alias("fp")))
    distinct = materialize(prints.groupBy("_fp").agg(first.alias("first"), F.count("*").alias("copies")),
                           "fingerprints")
    roots = components(links(distinct.select("_fp"), radius))
    linked = roots.join(distinct, roots["node"] == distinct["_fp"]).select("_fp", "root", "first")
    best = linked.groupBy("root").agg(F.min("first").alias("best"))
    named = linked.join(best, "root").select("_fp", "best")
    every = distinct.join(named, "_fp", "left").select("_fp", "copies", F.coalesce("best", "first").alias("best"))
    return every.select("_fp", "copies", F.col("best.id").alias("component_id"), F.col("best.fp").alias("keeper"))


def join_classes(prints: DataFrame, named: DataFrame, share: int = HOT_SHARE) -> DataFrame:
    """``prints`` with their classes. A fingerprint with more than one in ``share``
    of all rows is hot: there are fewer than ``share`` of these, so they are
    broadcast, and only the rows of the others meet their class in a shuffle."""
    rows = prints.count()
    hot = F.broadcast(named.filter(F.col("copies") * share > rows))
    cold = named.filter(F.col("copies") * share <= rows)
    return prints.join(hot, "_fp").unionByName(
        prints.join(hot.select("_fp"), "_fp", "left_anti").join(cold, "_fp"))


def near_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                    radius: int = RADIUS) -> DataFrame:
    """(id, fingerprint as 16 hex digits, component_id) of every document."""
    small = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    prints = materialize(add_fingerprints(small, "_text", drop=("_text",)), "prints")
    named = join_classes(prints, materialize(classes(prints, "_id", radius), "classes"))
    return named.select(F.col("_id").alias(id_col), F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"),
                        "component_id")


def keep_one(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """One document of each group: the row with the smallest id (of several such rows
    with one fingerprint, the one whose text and other columns come first)."""
    inside = Renamed(docs)
    text, ident = inside.of(text_col), inside.of(id_col)
    marked = materialize(add_fingerprints(inside.df, text), "marked")
    stays = (classes(marked.select(ident, "_fp"), ident, radius).filter("_fp = keeper")
             .select(F.col("_fp").alias("_k"), F.col("component_id").alias("_c")))
    kept = marked.join(stays, (F.col("_fp") == F.col("_k")) & F.col(ident).eqNullSafe(F.col("_c")), "left_semi")
    first = F.min(F.struct(text, *[c for c in inside.df.columns if c not in (text, ident)])).alias("_row")
    one = kept.groupBy("_fp", ident).agg(first)
    return inside.back(one.select(ident, "_row.*"))
