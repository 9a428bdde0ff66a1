"""Embedding near-duplicates against all pairs, and hot components."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairstream.llm import embedding, graph
from fairstream.llm import queries as llm
from tests.conftest import SF_SMALL

ROW = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                    T.StructField("label", T.IntegerType()), T.StructField("g", T.StringType()),
                    T.StructField("row", T.StringType()), T.StructField("n_links", T.StringType())])


def brute(rows, threshold=0.93):
    """{row number: (n_links, component_id)} by all pairs."""
    n, near = len(rows), {}
    units = []
    for _, v, label in rows:
        good = v and label is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
        x = np.array(v, np.float32).astype(float) if good else None
        units.append(x / np.linalg.norm(x) if good else None)
    for i in range(n):
        near[i] = [j for j in range(n) if i != j and units[i] is not None and units[j] is not None
                   and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j])
                   and float(units[i] @ units[j]) >= threshold]
    out, seen = {}, set()
    for i in range(n):
        if i in seen:
            continue
        todo, group = [i], {i}
        while todo:
            for j in near[todo.pop()]:
                if j not in group:
                    group.add(j)
                    todo.append(j)
        seen |= group
        low = min((rows[j][0] for j in group if rows[j][0] is not None), default=None)
        out |= {j: (len(near[j]), low) for j in group}
    return out


def made(seed, d=12):
    rnd = np.random.default_rng(seed)
    rows = []
    centres = rnd.normal(size=(9, d))
    for k in range(260):                        # one hot group holds a third
        c = centres[0] if k % 3 == 0 else centres[rnd.integers(9)]
        rows.append((k, (c + rnd.normal(scale=0.35, size=d)).tolist(), int(rnd.integers(3)) if k % 3 else 1))
    walk = rnd.normal(size=d)
    for k in range(60):                         # a chain: neighbours link, ends do not
        rows.append((1000 - k, walk.tolist(), 2))
        walk = walk + rnd.normal(scale=0.18, size=d)
    v = rows[0][1]
    rows += [(300, v, 1), (300, v, 1), (301, v, None), (302, None, 1), (303, [], 1), (304, [0.0] * d, 1),
             (305, [None] + v[1:], 1), (306, [math.nan] + v[1:], 1), (307, [math.inf] + v[1:], 1),
             (308, v[:5], 1), (309, v[:5], 1), (None, v, 1), (None, None, None), (-7, v, 1), (310, [x * 1e30 for x in v], 1)]
    return rows


def check(got, rows):
    want = sorted(((i, *brute_row) for (i, _, _), brute_row in
                   zip(rows, [v for _, v in sorted(brute(rows).items())])), key=repr)
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=repr) == want
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


@pytest.mark.parametrize(("block_rows", "leaf", "dimensions"), [(None, 256, 8), (16, 4, 3), (7, 3, 12)])
def test_links_and_components_equal_all_pairs(spark, block_rows, leaf, dimensions):
    rows = made(3)
    frame = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], ROW).repartition(5)
    check(embedding.near_duplicates(frame, block_rows=block_rows, leaf=leaf, dimensions=dimensions).collect(), rows)


def test_empty_and_unusable(spark):
    none = spark.createDataFrame([], ROW)
    assert embedding.near_duplicates(none).count() == 0
    rows = [(4, [0.0], 1), (5, None, 1), (None, [1.0], None)]
    frame = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], ROW)
    check(embedding.near_duplicates(frame).collect(), rows)


def test_distant_blocks_are_skipped(spark):
    rnd = np.random.default_rng(1)
    rows = [(k, (np.eye(6)[k % 6] * 5 + rnd.normal(scale=0.05, size=6)).tolist(), 1) for k in range(1200)]
    frame = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], ROW)
    usable = frame.select("label", F.lit(6).alias("size"), F.col("vec_id").alias("row"),
                          F.col("embedding").alias("vec"))
    eps = math.sqrt(2 - 2 * 0.93)
    pairs = embedding.interval_pairs(embedding.grid_order(usable, 6, eps, 5), 1200, 50, eps, 5)
    assert 24 <= pairs.count() < 24 * 25 / 2 / 3


def test_borderline_cosines_do_not_depend_on_blocks():
    u = np.array([[1.0, 0.0], [0.93, math.sqrt(1 - 0.93 ** 2)], [0.93, -math.sqrt(1 - 0.93 ** 2)]])
    one = (np.arange(3), u, u)
    whole = embedding.join_intervals(one, None, 0.93, 0.4)
    cut = embedding.join_intervals(one, None, 0.93, 0.4, leaf=1)
    assert whole == cut


def test_components_of_stars_chains_and_hot_centres(spark):
    edges = [(0, k) for k in range(1, 400)] + [(k, k + 1) for k in range(500, 560)] + [(900, 900), (7, 500)]
    got = graph.components(spark.createDataFrame(edges, "src long, dst long"), share=20).collect()
    assert {r["node"] for r in got} == {*range(400), *range(500, 561)} and len(got) == 461
    assert {r["root"] for r in got} == {0}


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF_SMALL}/embeddings.parquet')")
    rel = con.sql(llm.OP12_SQL)
    got = llm.op12_embedding_near_dedup(spark, SF_SMALL)
    assert sorted(rel.columns) == sorted(got.columns)
    assert sorted(map(tuple, got.select(rel.columns).collect())) == sorted(rel.fetchall())
