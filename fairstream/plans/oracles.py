"""DuckDB SQL oracles for the registered queries.

Each string runs on the driver's views (orders, embeddings, events, lineitem,
...). Centres and hash parameters are the same literals the Spark side uses;
the nearest centre is a CASE chain that prefers the lowest index on ties, as
``array_min(struct(dist2, index))`` does in Spark.
"""

from __future__ import annotations

from collections.abc import Sequence

from fairstream.operators import seeding
from fairstream.plans import fixtures as fx


def _num(v: float) -> str:
    return f"CAST({float(v)!r} AS DOUBLE)"


def points2d_cte() -> str:
    return (
        "points2d AS (SELECT o_orderkey AS id, o_totalprice / 1000.0 AS x, "
        "CAST(dayofyear(o_orderdate) AS DOUBLE) AS y, "
        "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'A' ELSE 'B' END AS grp "
        "FROM orders)"
    )


def pointsnd_cte() -> str:
    return (
        "pointsnd AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS features, "
        "CASE WHEN label % 2 = 0 THEN 'A' ELSE 'B' END AS grp FROM embeddings)"
    )


def sqdist_sql(coords: Sequence[str], center: Sequence[float]) -> str:
    terms = [f"(({c}) - {_num(v)}) * (({c}) - {_num(v)})" for c, v in zip(coords, center)]
    return "(" + " + ".join(terms) + ")"


def nd_coords(dims: int, col: str = "features") -> list[str]:
    return [f"{col}[{j + 1}]" for j in range(dims)]


def assign_select(coords: Sequence[str], centers: Sequence[Sequence[float]]) -> str:
    """``<d_0>, ..., <d_k-1>`` columns named _d0.. for an inner select."""
    return ", ".join(f"{sqdist_sql(coords, c)} AS _d{i}" for i, c in enumerate(centers))


def argmin_sql(k: int) -> str:
    """Lowest index among the minima of _d0.._d{k-1}."""
    parts = []
    for i in range(k - 1):
        cond = " AND ".join(f"_d{i} <= _d{j}" for j in range(i + 1, k))
        parts.append(f"WHEN {cond} THEN {i}")
    return f"CAST(CASE {' '.join(parts)} ELSE {k - 1} END AS INTEGER)"


def least_sql(k: int) -> str:
    return "least(" + ", ".join(f"_d{i}" for i in range(k)) + ")" if k > 1 else "_d0"


def assigned_cte(name: str, source: str, keep: str, coords: Sequence[str],
                 centers: Sequence[Sequence[float]]) -> str:
    k = len(centers)
    return (
        f"{name} AS (SELECT {keep}, {argmin_sql(k)} AS cluster, {least_sql(k)} AS dist2 "
        f"FROM (SELECT {keep}, {assign_select(coords, centers)} FROM {source}))"
    )


def _r(expr: str, digits: int) -> str:
    return f"round({expr}, {digits})"


D, CD = fx.DIGITS, fx.COST_DIGITS

PHI_EXPR = ("greatest(sum(cost) FILTER (WHERE grp = 'A') / sum(n) FILTER (WHERE grp = 'A'), "
            "sum(cost) FILTER (WHERE grp = 'B') / sum(n) FILTER (WHERE grp = 'B'))")


def clustering_oracles() -> dict[str, str]:
    c2 = fx.CENTERS_2D
    cnd = fx.CENTERS_ND
    p2 = points2d_cte()
    pnd = pointsnd_cte()
    a2 = assigned_cte("asg", "points2d", "id, x, y, grp", ["x", "y"], c2)
    and_ = assigned_cte("asg", "pointsnd", "id, grp", nd_coords(fx.ND_DIMS), cnd)
    cg = ("cg AS (SELECT cluster, grp, count(*) AS n, sum(dist2) AS cost "
          "FROM asg GROUP BY cluster, grp)")
    out: dict[str, str] = {}
    out["group_counts"] = (
        f"WITH {p2} SELECT count(*) AS n, count(*) FILTER (WHERE grp = 'A') AS n_a, "
        "count(*) FILTER (WHERE grp = 'B') AS n_b FROM points2d")
    out["parse_points_2d"] = (
        f"WITH {p2} SELECT id, x, y, grp FROM points2d")
    out["parse_points_nd"] = (
        f"WITH {pnd} SELECT id, grp, CAST(len(features) AS INTEGER) AS n_dims, "
        "features[1] AS c_first, features[len(features)] AS c_last, "
        f"{_r('list_sum(features)', D)} AS c_sum FROM pointsnd")
    out["assign_nearest"] = (
        f"WITH {p2}, {a2} SELECT id, cluster, {_r('dist2', D)} AS dist2 FROM asg")
    out["assign_nearest_nd"] = (
        f"WITH {pnd}, {and_} SELECT id, cluster, {_r('dist2', D)} AS dist2 FROM asg")
    out["kmeans_delta"] = (
        f"WITH {p2}, {a2} SELECT {_r('sum(dist2) / count(*)', D)} AS delta FROM asg")
    out["cluster_cost"] = (
        f"WITH {p2}, {a2} SELECT cluster, count(*) AS n, {_r('sum(dist2)', CD)} AS cost "
        "FROM asg GROUP BY cluster")
    out["fair_phi"] = f"WITH {p2}, {a2}, {cg} SELECT {_r(PHI_EXPR, D)} AS phi FROM cg"
    out["fair_phi_nd"] = f"WITH {pnd}, {and_}, {cg} SELECT {_r(PHI_EXPR, D)} AS phi FROM cg"
    out["group_cost"] = (
        f"WITH {p2}, {a2} SELECT grp, count(*) AS n, {_r('sum(dist2)', CD)} AS cost, "
        f"{_r('sum(dist2) / count(*)', D)} AS mean_cost FROM asg "
        "WHERE grp IN ('A', 'B') GROUP BY grp")
    xs = "[" + ", ".join(_num(c[0]) for c in c2) + "]"
    ys = "[" + ", ".join(_num(c[1]) for c in c2) + "]"
    out["cluster_statistics"] = (
        f"WITH {p2}, {a2} SELECT cluster, {xs}[cluster + 1] AS x, {ys}[cluster + 1] AS y, "
        "count(*) FILTER (WHERE grp = 'A') AS n_a, count(*) FILTER (WHERE grp <> 'A') AS n_b "
        "FROM asg GROUP BY cluster")
    out["cluster_group_stats"] = (
        f"WITH {p2}, {a2} SELECT cluster, grp, count(*) AS n, "
        f"{_r('count(*) / sum(count(*)) OVER (PARTITION BY grp)', D)} AS weight, "
        f"{_r('avg(x)', D)} AS mean_x, {_r('avg(y)', D)} AS mean_y, "
        f"{_r('count(*) * (var_pop(x) + var_pop(y))', CD)} AS sse "
        "FROM asg WHERE grp IN ('A', 'B') GROUP BY cluster, grp")
    out["lloyd_2rounds"] = lloyd_sql(2)
    out["fair_kmeans_1round"] = fair_rounds_sql()
    return out


class PointSet:
    """How the oracle sees a point table: its CTE, the coordinate expressions,
    the output names of centre coordinates, and the fixed start centres."""

    def __init__(self, cte: str, source: str, keep: str, coords: Sequence[str],
                 names: Sequence[str], centers: Sequence[Sequence[float]]):
        self.cte, self.source, self.keep = cte, source, keep
        self.coords, self.names, self.centers = list(coords), list(names), centers


def points2d_set() -> PointSet:
    return PointSet(points2d_cte(), "points2d", "id, x, y, grp", ["x", "y"], ["x", "y"],
                    fx.CENTERS_2D)


def pointsnd_set() -> PointSet:
    return PointSet(pointsnd_cte(), "pointsnd", "id, features, grp", nd_coords(fx.ND_DIMS),
                    [f"c{j}" for j in range(fx.ND_DIMS)], fx.CENTERS_ND)


def _centre_rows(ps: PointSet) -> str:
    return " UNION ALL ".join(
        f"SELECT {i} AS cluster, " + ", ".join(f"{_num(v)} AS k{j}" for j, v in enumerate(c))
        for i, c in enumerate(ps.centers))


def _lloyd_ctes(rounds: int, ps: PointSet, start: str | None = None) -> list[str]:
    """``rounds`` Lloyd rounds unrolled: the first from the literal centres (or the
    table ``start``), the next ones from the previous round's K-row centre table, read
    through scalar subqueries (no join of points with centres)."""
    dims = len(ps.coords)
    ks = range(dims)
    means = ", ".join(f"avg({c}) AS m{j}" for j, c in enumerate(ps.coords))
    if start:
        ctes = [f"c0 AS MATERIALIZED (SELECT * FROM {start})"]
    else:
        ctes = [ps.cte, assigned_cte("asg1", ps.source, ps.keep, ps.coords, ps.centers),
                f"c0 AS ({_centre_rows(ps)})"]
    for r in range(1, rounds + 1):
        prev = f"c{r - 1}"
        if r > 1 or start:
            # centre coordinates of the previous round as scalar subqueries
            k = len(ps.centers)
            ds = []
            if dims <= 8:
                ds.append(_distances(ps, prev))
            else:
                # one list-valued subquery per centre; only the order of the
                # distances matters here, so the (monotone) Euclidean distance
                # stands in for its square
                vec = "[" + ", ".join(ps.coords) + "]"
                for i in range(k):
                    cen = f"(SELECT [{', '.join(f'k{j}' for j in ks)}] FROM {prev} WHERE cluster = {i})"
                    ds.append(f"list_distance({vec}, {cen}) AS _d{i}")
            ctes.append(
                f"asg{r} AS (SELECT {ps.keep}, {argmin_sql(k)} AS cluster "
                f"FROM (SELECT {ps.keep}, {', '.join(ds)} FROM {ps.source}))")
        sel = ", ".join(f"coalesce(s.m{j}, {prev}.k{j}) AS k{j}" for j in ks)
        ctes.append(
            f"c{r} AS MATERIALIZED (SELECT {prev}.cluster, coalesce(s.n, 0) AS n, {sel} FROM {prev} "
            f"LEFT JOIN (SELECT cluster, count(*) AS n, {means} FROM asg{r} GROUP BY cluster) s "
            f"ON s.cluster = {prev}.cluster)")
    return ctes


def lloyd_sql(rounds: int, ps: PointSet | None = None) -> str:
    ps = ps or points2d_set()
    out = ", ".join(f"{_r(f'k{j}', D)} AS {n}" for j, n in enumerate(ps.names))
    return (f"WITH {', '.join(_lloyd_ctes(rounds, ps))} SELECT CAST(cluster AS INTEGER) AS cluster, n, {out} "
            f"FROM c{rounds}")


def _distances(ps: PointSet, table: str) -> str:
    """``_d0, ...``: squared distances to the centres of a K-row table (columns
    ``cluster, k0, ...``), read through scalar subqueries."""
    return ", ".join(
        "(" + " + ".join(f"({c} - (SELECT k{j} FROM {table} WHERE cluster = {i})) * "
                         f"({c} - (SELECT k{j} FROM {table} WHERE cluster = {i}))"
                         for j, c in enumerate(ps.coords)) + f") AS _d{i}"
        for i in range(len(ps.centers)))


def _fair_ctes(rounds: int, ps: PointSet, start: str | None = None) -> list[str]:
    """``rounds`` fair rounds from the literal centres: round r reads the centre
    table ``f{r-1}`` and ends in ``res{r}`` and ``f{r}``. The weight bisection is
    a recursive CTE over (step, gamma, step size)."""
    ks = range(len(ps.coords))
    mean_cols = ", ".join(f"avg({c}) AS m{j}" for j, c in enumerate(ps.coords))
    a_cols = ", ".join(f"coalesce(ga.m{j}, gb.m{j}) AS a{j}" for j in ks)
    b_cols = ", ".join(f"coalesce(gb.m{j}, ga.m{j}) AS b{j}" for j in ks)
    ell = "sqrt(" + " + ".join(f"(a{j} - b{j}) * (a{j} - b{j})" for j in ks) + ")"
    err_a = " + ".join(f"(q.{c} - cl.a{j}) * (q.{c} - cl.a{j})" for j, c in enumerate(ps.coords))
    err_b = " + ".join(f"(q.{c} - cl.b{j}) * (q.{c} - cl.b{j})" for j, c in enumerate(ps.coords))
    moved = ", ".join(
        f"CASE WHEN a0 IS NULL THEN k{j} WHEN ll = 0 THEN a{j} "
        f"ELSE ((ll - xx) * a{j} + xx * b{j}) / ll END AS k{j}" for j in ks)
    ctes = [f"f0 AS MATERIALIZED ({f'SELECT * FROM {start}' if start else _centre_rows(ps)})",
            f"tot AS MATERIALIZED (SELECT count(*) FILTER (WHERE grp = 'A') AS na, "
            f"count(*) FILTER (WHERE grp = 'B') AS nb FROM {ps.source})"]
    for r in range(1, rounds + 1):
        if r == 1 and not start:
            asg = assigned_cte("fasg1", ps.source, ps.keep, ps.coords, ps.centers)
        else:
            asg = (f"fasg{r} AS (SELECT {ps.keep}, {argmin_sql(len(ps.centers))} AS cluster "
                   f"FROM (SELECT {ps.keep}, {_distances(ps, f'f{r - 1}')} FROM {ps.source}))")
        ctes += [
            asg.replace(" AS (", " AS MATERIALIZED (", 1),
            f"ga{r} AS (SELECT cluster, count(*) AS n, {mean_cols} FROM fasg{r} WHERE grp = 'A' GROUP BY cluster)",
            f"gb{r} AS (SELECT cluster, count(*) AS n, {mean_cols} FROM fasg{r} WHERE grp = 'B' GROUP BY cluster)",
            # per cluster: weights, the two means with the substitution rule, and l
            f"cl{r} AS MATERIALIZED (SELECT *, {ell} AS l FROM ("
            "SELECT c.*, coalesce(ga.n, 0) / (SELECT na FROM tot) AS alpha, "
            f"coalesce(gb.n, 0) / (SELECT nb FROM tot) AS beta, {a_cols}, {b_cols} "
            f"FROM f{r - 1} c LEFT JOIN ga{r} ga ON ga.cluster = c.cluster "
            f"LEFT JOIN gb{r} gb ON gb.cluster = c.cluster))",
            f"act{r} AS MATERIALIZED (SELECT * FROM cl{r} WHERE a0 IS NOT NULL)",
            # squared error of each group around its own cluster mean, two passes
            f"fx{r} AS MATERIALIZED ("
            f"SELECT sum(CASE WHEN q.grp = 'A' THEN {err_a} ELSE 0 END) / (SELECT na FROM tot) AS fa0, "
            f"sum(CASE WHEN q.grp = 'B' THEN {err_b} ELSE 0 END) / (SELECT nb FROM tot) AS fb0 "
            f"FROM fasg{r} q JOIN cl{r} cl ON cl.cluster = q.cluster)",
            f"bis{r}(t, g_used, g, pw, done) AS ("
            "SELECT 0, 0.5::DOUBLE, 0.5::DOUBLE, 0.5::DOUBLE, false "
            "UNION ALL "
            "SELECT b.t + 1, b.g, "
            "CASE WHEN s.fa = s.fb THEN b.g WHEN s.fa > s.fb THEN b.g + b.pw / 2 ELSE b.g - b.pw / 2 END, "
            "b.pw / 2, s.fa = s.fb "
            f"FROM bis{r} b, LATERAL (SELECT (SELECT fa0 FROM fx{r}) + sum(act.alpha * xx * xx) AS fa, "
            f"(SELECT fb0 FROM fx{r}) + sum(act.beta * (act.l - xx) * (act.l - xx)) AS fb "
            "FROM (SELECT act.*, (1 - b.g) * act.beta * act.l / (b.g * act.alpha + (1 - b.g) * act.beta) AS xx "
            f"FROM act{r} act) act) s "
            "WHERE b.t < 10 AND NOT b.done)",
            f"fin{r} AS MATERIALIZED (SELECT g_used AS g FROM bis{r} WHERE t = (SELECT max(t) FROM bis{r}))",
            f"res{r} AS MATERIALIZED (SELECT cl.*, coalesce(cl.l, 0.0) AS ll, "
            "CASE WHEN cl.a0 IS NULL THEN 0.0 ELSE "
            f"(1 - (SELECT g FROM fin{r})) * cl.beta * cl.l / ((SELECT g FROM fin{r}) * cl.alpha "
            f"+ (1 - (SELECT g FROM fin{r})) * cl.beta) END AS xx FROM cl{r} cl)",
            f"f{r} AS MATERIALIZED (SELECT cluster, {moved} FROM res{r})",
        ]
    return ctes


def fair_rounds_sql(rounds: int = 1, ps: PointSet | None = None) -> str:
    """The centres after ``rounds`` fair rounds, with the last round's weights."""
    ps = ps or points2d_set()
    coords_out = ", ".join(f"{_r(f'f.k{j}', D)} AS {n}" for j, n in enumerate(ps.names))
    return (f"WITH RECURSIVE {', '.join([ps.cte, *_fair_ctes(rounds, ps)])} "
            f"SELECT CAST(f.cluster AS INTEGER) AS cluster, {coords_out}, "
            f"{_r('alpha', D)} AS alpha, {_r('beta', D)} AS beta, {_r('ll', D)} AS ell, "
            f"{_r('xx', D)} AS shift FROM res{rounds} r JOIN f{rounds} f ON f.cluster = r.cluster")


def edge_set() -> PointSet:
    """One cluster without group B, one without points (``points2d_edge``)."""
    cte = (points2d_cte() + ", edge AS (SELECT id, x, y, "
           f"CASE WHEN y >= {fx.EDGE_Y} THEN 'A' ELSE grp END AS grp FROM points2d)")
    return PointSet(cte, "edge", "id, x, y, grp", ["x", "y"], ["x", "y"], fx.CENTERS_EDGE)


def _uniform_sql(name: str, ident: str) -> str:
    digits = f"substr(md5('{name}:' || {ident}), 1, 12)"
    return f"((CAST('0x' || {digits} AS BIGINT) + 1.0::DOUBLE) / 281474976710656::DOUBLE)"


def keyed_start_ctes(k: int, seed: int) -> list[str]:
    """The keyed k-means|| start over ``points2d``: candidates ``cand(at, id, x, y)``
    in the order drawn, then the start centres ``start(cluster, k0, k1)``. Ties of
    the races go to the lower id."""
    steps, drawn = seeding.STEPS, seeding.OVERSAMPLE * k
    d2 = "((p.x - c.x) * (p.x - c.x) + (p.y - c.y) * (p.y - c.y))"
    ctes = [points2d_cte(),
            f"cand0 AS MATERIALIZED (SELECT 0 AS at, id, x, y FROM points2d p "
            f"ORDER BY -ln({_uniform_sql(f'{seed}:0', 'p.id')}), id LIMIT 1)"]
    for r in range(1, steps + 1):
        ctes += [
            f"far{r} AS MATERIALIZED (SELECT p.id, p.x, p.y, min({d2}) AS d "
            f"FROM points2d p, cand{r - 1} c GROUP BY p.id, p.x, p.y)",
            f"new{r} AS MATERIALIZED (SELECT id, x, y, -ln({_uniform_sql(f'{seed}:{r}', 'id')}) / d AS race "
            f"FROM far{r} WHERE d > 0 ORDER BY race, id LIMIT {drawn})",
            f"cand{r} AS MATERIALIZED (SELECT * FROM cand{r - 1} UNION ALL SELECT "
            f"(SELECT count(*) FROM cand{r - 1}) + row_number() OVER (ORDER BY race, id) - 1, id, x, y FROM new{r})"]
    ctes += [
        f"near AS (SELECT p.id, arg_min(c.at, [{d2}, c.at::DOUBLE]) AS at FROM points2d p, cand{steps} c GROUP BY p.id)",
        f"pick AS MATERIALIZED (SELECT c.*, (SELECT count(*) FROM near WHERE near.at = c.at) AS w FROM cand{steps} c)"]
    for r in range(k):
        if r:
            least = f"(SELECT min({d2}) FROM won{r - 1} c)"
            weight = f"w * {least}"
        else:
            weight = "w * 1.0::DOUBLE"
        earlier = f"SELECT * FROM won{r - 1} UNION ALL " if r else ""
        ctes.append(
            f"won{r} AS MATERIALIZED ({earlier}SELECT {r} AS cluster, id, x, y FROM (SELECT id, x, y, "
            f"-ln({_uniform_sql(f'{seed}:r{r}', 'id')}) / wt AS race FROM (SELECT p.id, p.x, p.y, {weight} AS wt "
            "FROM pick p) WHERE wt > 0 ORDER BY race, id LIMIT 1))")
    ctes.append(f"start AS MATERIALIZED (SELECT cluster, x AS k0, y AS k1 FROM won{k - 1})")
    return ctes


def started_oracles() -> dict[str, str]:
    """The reports that begin with the keyed start."""
    ps = points2d_set()
    k = fx.KMEANS_K
    start = keyed_start_ctes(k, fx.KMEANS_SEED)
    def assigned(name: str, table: str) -> str:
        return (f"{name} AS MATERIALIZED (SELECT grp, {argmin_sql(k)} AS cluster, {least_sql(k)} AS dist2 "
                f"FROM (SELECT grp, {_distances(ps, table)} FROM points2d))")
    a, b = "count(*) FILTER (WHERE e.grp = 'A') AS n_a", "count(*) FILTER (WHERE e.grp <> 'A') AS n_b"
    where = f"CAST(e.cluster AS INTEGER) AS cluster, {_r('c.k0', D)} AS x, {_r('c.k1', D)} AS y"
    fit = [*start, *_lloyd_ctes(fx.KMEANS_ITER, ps, "start"), assigned("ev", f"c{fx.KMEANS_ITER}")]
    return {
        "init_centers": (f"WITH {', '.join([*start, assigned('ev', 'start')])} SELECT {where}, {a}, {b} "
                         "FROM ev e JOIN start c ON c.cluster = e.cluster GROUP BY e.cluster, c.k0, c.k1"),
        "kmeans_report": (f"WITH {', '.join(fit)} SELECT {where}, count(*) AS n, {a}, {b}, "
                          f"{_r('sum(e.dist2)', CD)} AS cost FROM ev e "
                          f"JOIN c{fx.KMEANS_ITER} c ON c.cluster = e.cluster GROUP BY e.cluster, c.k0, c.k1"),
        "compare_centers": compare_fixed_sql(fx.FAIR_ROUNDS, start, "start"),
    }


def compare_fixed_sql(rounds: int, before: Sequence[str] = (), start: str | None = None) -> str:
    """Delta and Phi of the centres after ``rounds`` Lloyd and fair rounds, from the
    literal centres or from the table ``start`` that the CTEs ``before`` define."""
    ps = points2d_set()
    ctes = [*before, *_lloyd_ctes(rounds, ps, start), *_fair_ctes(rounds, ps, start)]
    parts = []
    for method, table in (("standard", f"c{rounds}"), ("fair", f"f{rounds}")):
        ctes.append(f"ev_{method} AS (SELECT grp, {least_sql(len(ps.centers))} AS dist2 "
                    f"FROM (SELECT grp, {_distances(ps, table)} FROM {ps.source}))")
        parts.append(f"SELECT '{method}' AS method, {_r('avg(dist2)', D)} AS delta, "
                     + _r("greatest(avg(dist2) FILTER (WHERE grp = 'A'), avg(dist2) FILTER (WHERE grp = 'B'))", D)
                     + f" AS phi FROM ev_{method}")
    return f"WITH RECURSIVE {', '.join(ctes)} {' UNION ALL '.join(parts)}"


def nearest_of_many_sql(centers: Sequence[Sequence[float]]) -> str:
    """Nearest of many centres: the smallest (distance, index) of each point."""
    rows = ", ".join(f"({i}, {_num(c[0])}, {_num(c[1])})" for i, c in enumerate(centers))
    return (f"WITH {points2d_cte()}, cen(i, cx, cy) AS (VALUES {rows}), "
            "best AS (SELECT id, min([(x - cx) * (x - cx) + (y - cy) * (y - cy), i::DOUBLE]) AS m "
            "FROM points2d, cen GROUP BY id) "
            f"SELECT id, CAST(m[2] AS INTEGER) AS cluster, {_r('m[1]', D)} AS dist2 FROM best")


def nearest_of_width_sql(dims: int) -> str:
    a = assigned_cte("asg", "pointsnd", "id", nd_coords(dims), [c[:dims] for c in fx.CENTERS_ND])
    return f"WITH {pointsnd_cte()}, {a} SELECT id, cluster, {_r('dist2', D)} AS dist2 FROM asg"


def fixed_start_oracles() -> dict[str, str]:
    """More rounds, more centres and other widths than the queries above; and
    facts that hold for any random start or estimate, as Boolean columns."""
    return {
        "fair_kmeans_3rounds": fair_rounds_sql(3),
        "fair_kmeans_edge": fair_rounds_sql(2, edge_set()),
        "fair_vs_standard_fixed": compare_fixed_sql(fx.FAIR_ROUNDS),
        "fair_rounds_any_order": f"SELECT cluster, x, y, true AS same_bits FROM ({fair_rounds_sql(2)})",
        "assign_nearest_k500": nearest_of_many_sql(fx.CENTERS_K500),
        "assign_nearest_k5000": nearest_of_many_sql(fx.CENTERS_K5000),
        "assign_nearest_d3": nearest_of_width_sql(3),
        "assign_nearest_d17": nearest_of_width_sql(17),
        "read_points_text": (
            f"WITH {points2d_cte()} SELECT grp, count(*) AS n, {_r('avg(x)', D)} AS mean_x, "
            f"{_r('avg(y)', D)} AS mean_y FROM points2d WHERE id % 10 <> 3 GROUP BY grp "
            "UNION ALL SELECT 'not a number', count(*), NULL, NULL FROM points2d WHERE id % 10 = 3"),
        "kmeans_report_check": (
            f"SELECT CAST({fx.KMEANS_K} AS BIGINT) AS n_centers, count(*) AS n, "
            "true AS cost_adds_up, true AS improved FROM orders"),
        "stream_distinct_estimate_check": (
            "SELECT count(*) AS n_items, CAST(max(user_id) AS BIGINT) AS largest, true AS within_bound "
            "FROM events"),
    }


def nd_oracles() -> dict[str, str]:
    nd = pointsnd_set()
    return {"lloyd_2rounds_nd": lloyd_sql(2, nd), "fair_kmeans_1round_nd": fair_rounds_sql(1, nd)}


def report_oracles() -> dict[str, str]:
    """Per-cluster report at fixed centres, in one aggregate."""
    c2 = fx.CENTERS_2D
    xs = "[" + ", ".join(_num(c[0]) for c in c2) + "]"
    ys = "[" + ", ".join(_num(c[1]) for c in c2) + "]"
    a2 = assigned_cte("asg", "points2d", "id, x, y, grp", ["x", "y"], c2)
    a = "grp = 'A'"
    b = "grp = 'B'"
    summary = (
        f"WITH {points2d_cte()}, {a2} SELECT count(*) AS n, count(*) FILTER (WHERE {a}) AS n_a, "
        f"count(*) FILTER (WHERE {b}) AS n_b, {_r('sum(dist2) / count(*)', D)} AS delta, "
        f"{_r(f'greatest(avg(dist2) FILTER (WHERE {a}), avg(dist2) FILTER (WHERE {b}))', D)} AS phi "
        "FROM asg")
    return {"kmeans_summary": summary, "cluster_report": (
        f"WITH {points2d_cte()}, {a2} SELECT cluster, {xs}[cluster + 1] AS x, "
        f"{ys}[cluster + 1] AS y, count(*) AS n, "
        "count(*) FILTER (WHERE grp = 'A') AS n_a, count(*) FILTER (WHERE grp <> 'A') AS n_b, "
        f"{_r('sum(dist2)', CD)} AS cost FROM asg GROUP BY cluster")}


# --- sketches and heavy hitters ---------------------------------------------------

SKEWED = "src AS (SELECT CAST(1000 // (1 + l_partkey % 1000) AS BIGINT) AS item FROM lineitem)"
FLAT = "src AS (SELECT CAST(user_id AS BIGINT) AS item FROM events)"


# Items of about 62 bits, of both signs; HUGEINT, so that a * item + b is exact here.
WIDE = (f"src AS (SELECT CAST(l_partkey % 1000 - 500 AS HUGEINT) * {fx.WIDE_FACTOR} AS item FROM lineitem)")


def _lin(a: int, b: int, p: int, x: str = "item") -> str:
    return f"(({a} * {x} + {b}) % {p})"


def bucket_sql(a: int, b: int, p: int, w: int, x: str = "item") -> str:
    return f"CAST(((({_lin(a, b, p, x)}) % {w}) + {w}) % {w} AS INTEGER)"


def sign_sql(a: int, b: int, p: int, x: str = "item") -> str:
    return f"(CASE WHEN {_lin(a, b, p, x)} % 2 = 0 THEN 1 ELSE -1 END)"


def refs_cte(name: str, source: str, keep: str, params, signs=None,
             p: int = fx.SKETCH_P, w: int = fx.SKETCH_W) -> str:
    parts = []
    for i, (a, b) in enumerate(params):
        sg = sign_sql(*signs[i], p) if signs else "1"
        parts.append(f"SELECT {keep}, {i} AS row, {bucket_sql(a, b, p, w)} AS bucket, "
                     f"{sg} AS sign FROM {source}")
    return f"{name} AS ({' UNION ALL '.join(parts)})"


def cells_cte(name: str, params, signs=None) -> str:
    return (f"{refs_cte('r_' + name, 'src', 'item', params, signs)}, "
            f"{name} AS (SELECT row, bucket, CAST(sum(sign) AS BIGINT) AS cnt "
            f"FROM r_{name} GROUP BY row, bucket)")


COUNTS = "cnts AS (SELECT item, count(*) AS cnt FROM src GROUP BY item)"


def phi_sql(k: int) -> str:
    return f"(SELECT min(cnt) FROM (SELECT cnt FROM cnts ORDER BY cnt DESC LIMIT {k}))"


def hitters_cte(k: int) -> str:
    return f"hh AS (SELECT item, cnt FROM cnts WHERE cnt >= {phi_sql(k)})"


def _q(keep: str) -> str:
    return ", ".join(f"q.{k.strip()}" for k in keep.split(","))


def cm_est_cte(name: str, query: str, keep: str, cells: str, params) -> str:
    return (f"{refs_cte('q_' + name, query, keep, params)}, "
            f"{name} AS (SELECT {_q(keep)}, CAST(min(coalesce(c.cell, 0) * q.sign) AS BIGINT) AS est "
            f"FROM q_{name} q LEFT JOIN (SELECT row, bucket, cnt AS cell FROM {cells}) c "
            f"ON c.row = q.row AND c.bucket = q.bucket GROUP BY {_q(keep)})")


def cs_est_cte(name: str, query: str, keep: str, cells: str, params, signs) -> str:
    d = len(params)
    if d % 2 == 1:
        med = f"v[{d // 2 + 1}]"
    else:
        med = f"(v[{d // 2}] + v[{d // 2 + 1}]) // 2"
    return (f"{refs_cte('q_' + name, query, keep, params, signs)}, "
            f"v_{name} AS (SELECT {_q(keep)}, list_sort(list(coalesce(c.cell, 0) * q.sign)) AS v "
            f"FROM q_{name} q LEFT JOIN (SELECT row, bucket, cnt AS cell FROM {cells}) c "
            f"ON c.row = q.row AND c.bucket = q.bucket GROUP BY {_q(keep)}), "
            f"{name} AS (SELECT {keep}, CAST({med} AS BIGINT) AS est FROM v_{name})")


def sketch_oracles() -> dict[str, str]:
    cm, cs, sg = fx.CMS_PARAMS, fx.CS_PARAMS, fx.CS_SIGN_PARAMS
    cse, sge = fx.CS_PARAMS_EVEN, fx.CS_SIGN_PARAMS_EVEN
    k = fx.TOP_K
    out: dict[str, str] = {}
    out["cms_cells"] = f"WITH {SKEWED}, {cells_cte('cells', cm)} SELECT * FROM cells"
    out["cs_cells"] = f"WITH {SKEWED}, {cells_cte('cells', cs, sg)} SELECT * FROM cells"
    out["cms_cells_wide"] = f"WITH {WIDE}, {cells_cte('cells', cm)} SELECT * FROM cells"
    drawn = [[(h.a, h.b) for h in part] for part in (fx.SEEDED_CS.rows, fx.SEEDED_CS.signs)]
    out["cs_cells_seeded"] = f"WITH {WIDE}, {cells_cte('cells', *drawn)} SELECT * FROM cells"
    for name, n in (("heavy_hitters_k1", 1), ("heavy_hitters_all", fx.TOP_K_ABOVE)):
        out[name] = f"WITH {SKEWED}, {COUNTS}, {hitters_cte(n)} SELECT item, cnt FROM hh"
    out["cms_estimate"] = (
        f"WITH {SKEWED}, {COUNTS}, {cells_cte('cells', cm)}, "
        f"{cm_est_cte('e', 'cnts', 'item, cnt', 'cells', cm)} SELECT item, cnt, est FROM e")
    out["cs_estimate"] = (
        f"WITH {SKEWED}, {COUNTS}, {cells_cte('cells', cs, sg)}, "
        f"{cs_est_cte('e', 'cnts', 'item, cnt', 'cells', cs, sg)} SELECT item, cnt, est FROM e")
    out["cs_estimate_even"] = (
        f"WITH {SKEWED}, {COUNTS}, {cells_cte('cells', cse, sge)}, "
        f"{cs_est_cte('e', 'cnts', 'item, cnt', 'cells', cse, sge)} SELECT item, cnt, est FROM e")
    out["item_counts"] = f"WITH {FLAT}, {COUNTS} SELECT item, cnt FROM cnts"
    out["kth_frequency"] = f"WITH {SKEWED}, {COUNTS} SELECT {phi_sql(k)} AS phi_k"
    out["heavy_hitters"] = f"WITH {SKEWED}, {COUNTS}, {hitters_cte(k)} SELECT item, cnt FROM hh"
    out["heavy_hitters_flat"] = (
        f"WITH {FLAT}, {COUNTS}, {hitters_cte(k)} SELECT item, cnt FROM hh")
    out["hitter_listing"] = (
        f"WITH {SKEWED}, {COUNTS}, {hitters_cte(k)}, {cells_cte('cells', cm)}, "
        f"{cm_est_cte('e', 'hh', 'item, cnt', 'cells', cm)} "
        "SELECT item, cnt, est AS cm_est FROM e ORDER BY item")
    out["sketch_error"] = (
        f"WITH {SKEWED}, {COUNTS}, {hitters_cte(k)}, {cells_cte('cmc', cm)}, "
        f"{cells_cte('csc', cs, sg)}, {cm_est_cte('e1', 'hh', 'item, cnt', 'cmc', cm)}, "
        f"{cs_est_cte('e2', 'hh', 'item', 'csc', cs, sg)} "
        "SELECT count(*) AS n_hitters, "
        f"{_r('avg((e1.est - e1.cnt) / e1.cnt)', D)} AS cm_rel_err, "
        f"{_r('avg(abs(e2.est - e1.cnt) / e1.cnt)', D)} AS cs_rel_err "
        "FROM e1 JOIN e2 ON e1.item = e2.item")
    out["hitter_report"] = hitter_report_sql(SKEWED)
    out["distinct_summary"] = (
        f"WITH {FLAT} SELECT count(item) AS n_items, count(DISTINCT item) AS n_distinct, "
        "max(item) AS largest FROM src")
    return out


def hitter_report_sql(src_cte: str) -> str:
    """The one-row heavy-hitter report over the items of ``src_cte`` (a CTE named src)."""
    cm, cs, sg = fx.CMS_PARAMS, fx.CS_PARAMS, fx.CS_SIGN_PARAMS
    k = fx.TOP_K
    return (
        f"WITH {src_cte}, {COUNTS}, {hitters_cte(k)}, {cells_cte('cmc', cm)}, "
        f"{cells_cte('csc', cs, sg)}, {cm_est_cte('e1', 'hh', 'item, cnt', 'cmc', cm)}, "
        f"{cs_est_cte('e2', 'hh', 'item', 'csc', cs, sg)} "
        "SELECT (SELECT CAST(sum(cnt) AS BIGINT) FROM cnts) AS n_items, "
        f"(SELECT count(*) FROM cnts) AS n_distinct, {phi_sql(k)} AS phi_k, "
        "count(*) AS n_hitters, "
        f"{_r('avg((e1.est - e1.cnt) / e1.cnt)', D)} AS cm_rel_err, "
        f"{_r('avg(abs(e2.est - e1.cnt) / e1.cnt)', D)} AS cs_rel_err "
        "FROM e1 JOIN e2 ON e1.item = e2.item")


# --- streams ------------------------------------------------------------------------

def _parts_cte(n: int) -> str:
    """Events split into n parts by ranges of event_id, as the replay copy is."""
    return (f"ev AS (SELECT CAST(user_id AS BIGINT) AS item, "
            f"CAST(floor((event_id - (SELECT min(event_id) FROM events)) * {n} / "
            "((SELECT max(event_id) FROM events) - (SELECT min(event_id) FROM events) + 1)) "
            "AS INTEGER) AS part FROM events)")


def stream_oracles() -> dict[str, str]:
    s = sketch_oracles()
    n, t = fx.STREAM_FILES, fx.PREFIX_T
    out: dict[str, str] = {}
    out["running_counts"] = s["item_counts"]
    out["running_distinct"] = f"WITH {FLAT} SELECT DISTINCT item FROM src"
    out["stream_distinct_summary"] = s["distinct_summary"]
    out["running_counts_compacted"] = out["stream_text_items"] = out["stream_line_log"] = s["item_counts"]
    out["running_distinct_compacted"] = out["running_distinct"]
    out["stream_heavy_hitters"] = (
        f"WITH {SKEWED}, {COUNTS} SELECT item, cnt, (SELECT CAST(sum(cnt) AS BIGINT) FROM cnts) AS n_items, "
        f"true AS within_bounds FROM cnts WHERE cnt * {fx.HITTER_COUNTERS} > (SELECT sum(cnt) FROM cnts)")
    out["stream_distinct_range"] = (
        f"WITH {_parts_cte(n)} SELECT count(*) AS n_items, true AS within_bound FROM ev WHERE part BETWEEN 1 AND 3")
    out["stream_report_log"] = (f"WITH {_parts_cte(n)} SELECT count(*) AS n_items, max(item) AS largest, "
                                "count(DISTINCT part) AS n_reports FROM ev")
    out["stream_sketch_cells"] = s["cms_cells"]
    out["stream_cs_cells"] = s["cs_cells"]
    # batches are taken in part order; the first batch whose running size
    # reaches T is the last one processed
    out["stream_prefix"] = (
        f"WITH {_parts_cte(n)}, sz AS (SELECT part, count(*) AS n FROM ev GROUP BY part), "
        "run AS (SELECT part, n, sum(n) OVER (ORDER BY part) - n AS before FROM sz), "
        f"acc AS (SELECT part FROM run WHERE before < {t}) "
        "SELECT count(DISTINCT ev.part) AS n_batches, count(*) AS n_items, "
        "count(DISTINCT item) AS n_distinct, max(item) AS largest "
        "FROM ev JOIN acc ON acc.part = ev.part")
    out["batch_sizes"] = (
        f"WITH {_parts_cte(n)} SELECT CAST(part AS BIGINT) AS batch_id, count(*) AS n_rows "
        "FROM ev GROUP BY part")
    out["batch_log"] = (
        f"WITH {_parts_cte(n)} SELECT CAST(part AS BIGINT) AS batch_id, count(*) AS n_rows, "
        "true AS in_order FROM ev GROUP BY part")
    out["stream_report"] = s["sketch_error"]
    prefix_src = (f"{_parts_cte(n)}, sz AS (SELECT part, count(*) AS n FROM ev GROUP BY part), "
                  "run AS (SELECT part, sum(n) OVER (ORDER BY part) - n AS before FROM sz), "
                  f"src AS (SELECT item FROM ev WHERE part IN (SELECT part FROM run WHERE before < {t}))")
    out["stream_hitter_report"] = hitter_report_sql(prefix_src)
    return out


def _noise_sql(axis: str) -> str:
    key = f"md5('{fx.KMEANS_SEED}:' || i || ':{axis}')"
    u, v = (f"(CAST('0x' || substr({key}, {at}, 12) AS BIGINT) + 1.0) / 281474976710656" for at in (1, 13))
    return f"sqrt(-2 * ln({u}::DOUBLE)) * cos(2 * pi() * ({v})::DOUBLE)"


def synth_oracles() -> dict[str, str]:
    k = fx.KMEANS_K
    per = f"((SELECT count(*) FROM orders) // {2 * k})"
    return {"labelled_blobs": (
        f"WITH ids AS (SELECT o_orderkey AS i, {per} AS n FROM orders), "
        f"lab AS (SELECT CASE WHEN i < 2 * n * {k} THEN CAST(i // (2 * n) AS INTEGER) ELSE -1 END AS cluster, "
        "CASE WHEN i < 2 * n * " + str(k) + " AND i % (2 * n) >= n THEN 'B' ELSE 'A' END AS grp, "
        f"{_noise_sql('x')} AS ex, {_noise_sql('y')} AS ey FROM ids) "
        "SELECT grp, cluster, count(*) AS n, "
        "CAST(sum(CAST(round(10000 * round(greatest(cluster, 0) * 10 + (grp = 'B')::INT * 10 + ex, 4)) AS BIGINT)) "
        "AS BIGINT) AS sum_x, "
        "CAST(sum(CAST(round(10000 * round((grp = 'B')::INT * 10 + ey, 4)) AS BIGINT)) AS BIGINT) AS sum_y "
        "FROM lab GROUP BY grp, cluster")}
