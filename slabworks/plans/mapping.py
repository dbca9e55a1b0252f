"""Queries of transport between neighbouring slices, surfaces and what they contain, fields of displacement, and trends of counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from slabworks.operators import field as L
from slabworks.operators import surface as U
from slabworks.operators import trends as D
from slabworks.operators import transport as O
from slabworks.operators import volume as V
from slabworks.operators.validators import unfolded
from slabworks.plans.registry import query, r6
from slabworks.session import held
from slabworks.sources import fixtures as X

#: Softness and rounds at which the plan in SQL has settled to more digits than are compared.
_SETTLED = O.Scaling(epsilon=0.1, tolerance=1e-9)


def stage_pairs(spark, sf_dir):
    """Every slice as the source of a pair with the next one."""
    c = X.cells(spark, sf_dir).select("slice_index", "cell_id", "x", "y", "z")
    s = c.withColumn("side", F.lit("s")).withColumnRenamed("slice_index", "boundary")
    return s.unionByName(c.withColumn("side", F.lit("t")).withColumn("boundary", F.col("slice_index") - 1).drop("slice_index"))


_PLAN = """RECURSIVE {cells}, c AS (SELECT s.slice_index AS b, s.cell_id AS i, t.cell_id AS j, s.x AS sx, s.y AS sy, s.z AS sz, t.x, t.y, t.z, sqrt((s.x - t.x) ** 2 + (s.y - t.y) ** 2 + (s.z - t.z) ** 2) AS c FROM cells s JOIN cells t ON t.slice_index = s.slice_index + 1),
    k AS (SELECT *, exp(-c / (0.1 * avg(c) OVER (PARTITION BY b))) AS k FROM c), n AS (SELECT b, count(DISTINCT i) AS n, count(DISTINCT j) AS m FROM k GROUP BY b),
    it(r, b, i, u) AS (
        SELECT DISTINCT 0, b, i, 1::DOUBLE FROM k
        UNION ALL
        SELECT v.r + 1, k.b, k.i, 1 / (any_value(n.n) * sum(k.k * v.v)) FROM k JOIN n USING (b)
            JOIN (SELECT it.r, k.b, k.j, 1 / (any_value(n.m) * sum(k.k * it.u)) AS v FROM it JOIN k USING (b, i) JOIN n USING (b) WHERE it.r < 240 GROUP BY it.r, k.b, k.j) v USING (b, j) GROUP BY v.r, k.b, k.i
    ), u AS (SELECT * FROM it WHERE r = 240), v AS (SELECT k.b, k.j, 1 / (any_value(n.m) * sum(k.k * u.u)) AS v FROM u JOIN k USING (b, i) JOIN n USING (b) GROUP BY k.b, k.j),
    p AS (SELECT k.*, u.u * k.k * v.v AS w FROM k JOIN u USING (b, i) JOIN v USING (b, j)),
    m AS (SELECT b, i, any_value(sx) AS sx, any_value(sy) AS sy, any_value(sz) AS sz, sum(w * x) / sum(w) AS tx, sum(w * y) / sum(w) AS ty, sum(w * z) / sum(w) AS tz, arg_max(j, w) AS best, sum(w) AS mass, sum(w * c) AS cost FROM p GROUP BY b, i),
    d AS (SELECT *, sqrt((tx - sx) ** 2 + (ty - sy) ** 2 + (tz - sz) ** 2) AS moved FROM m)""".format(cells=X.SQL["cells"])


def _mapping(spark, sf_dir):
    return O.mapped(stage_pairs(spark, sf_dir), ["boundary"], ["x", "y", "z"], _SETTLED)


@query("transport_mapping", f"WITH {_PLAN} SELECT CAST(b AS INTEGER) AS boundary, i AS cell_id, round(tx, 4) AS x_to, round(ty, 4) AS y_to, round(tz, 4) AS z_to, round(moved, 4) AS moved, best FROM d")
def transport_mapping(spark, sf_dir):
    return _mapping(spark, sf_dir).select("boundary", "cell_id", *[F.round(c, 4).alias(c) for c in ("x_to", "y_to", "z_to", "moved")], "best")


@query("transport_report", f"WITH {_PLAN} SELECT CAST(b AS INTEGER) AS boundary, count(*) AS n, round(sum(mass), 6) AS mass, round(sum(cost), 5) AS cost, true AS converged FROM d GROUP BY b")
def transport_report(spark, sf_dir):
    return O.pair_report(_mapping(spark, sf_dir), ["boundary"]).select("boundary", "n", r6("mass").alias("mass"), F.round("cost", 5).alias("cost"), "converged")


@query("transport_rules", "WITH b AS (SELECT count(DISTINCT slice_index) - 1 AS n FROM cells) SELECT boundary, rule, CASE WHEN tight THEN 0::BIGINT ELSE 1 END AS failed, tight AS ok FROM (SELECT unnest(generate_series(0, n - 1))::INTEGER AS boundary FROM b) x, (VALUES ('row_sums', true), ('column_sums', true), ('row_sums_after_a_few_rounds', false)) r(rule, tight)", "cells")
def transport_rules(spark, sf_dir):
    """Both marginals of every pair within 1e-4 of an even share; rows of a plan that is stopped after 8 rounds aren't."""
    rows = stage_pairs(spark, sf_dir)
    few = O.pair_report(O.mapped(rows, ["boundary"], ["x", "y", "z"], O.Scaling(epsilon=0.02, rounds=8)), ["boundary"]).select("boundary", F.col("row_error").alias("early"))
    got = O.pair_report(O.mapped(rows, ["boundary"], ["x", "y", "z"], O.Scaling(epsilon=0.05)), ["boundary"]).join(few, "boundary")
    sizes = rows.where("side = 't'").groupBy("boundary").agg(F.count("*").alias("m"))
    got = got.join(sizes, "boundary")
    rules = {"row_sums": F.col("row_error") <= 1e-4 / F.col("n"), "column_sums": F.col("column_error") <= 1e-4 / F.col("m"), "row_sums_after_a_few_rounds": F.col("early") <= 1e-4 / F.col("n")}
    return unfolded(got.select("boundary", *[F.when(ok, 0).otherwise(1).alias(name) for name, ok in rules.items()]), ["boundary"], list(rules))


@query("displacement_by_label", f"WITH {_PLAN} SELECT CAST(b AS INTEGER) AS boundary, celltype, count(*) AS n, round(avg(moved), 4) AS mean, round(median(moved), 4) AS median, round(quantile_cont(moved, 0.05), 4) AS p05, round(quantile_cont(moved, 0.95), 4) AS p95 FROM d JOIN cells ON cells.cell_id = d.i GROUP BY ALL")
def displacement_by_label(spark, sf_dir):
    out = O.displacement_summary(_mapping(spark, sf_dir), X.cells(spark, sf_dir), ["boundary"])
    return out.select("boundary", "celltype", "n", *[F.round(c, 4).alias(c) for c in ("mean", "median", "p05", "p95")])


#: Voxels and level of the surfaces.
SIZE, SIGMA, LEVEL = 0.08, 1.0, 0.25


def _kernel(sigma: float, reach: int) -> str:
    return f"k AS (SELECT o, exp(-0.5 * (o / {sigma}) ** 2) / (SELECT sum(exp(-0.5 * (u / {sigma}) ** 2)) FROM range(-{reach}, {reach + 1}) r(u)) AS w FROM range(-{reach}, {reach + 1}) t(o))"


_NODES = f"""{X.SQL["cells"]}, {_kernel(SIGMA, 4)}, v AS (SELECT DISTINCT celltype, round_even(x / {SIZE}, 0)::BIGINT AS ix, round_even(y / {SIZE}, 0)::BIGINT AS iy, round_even(z / {SIZE}, 0)::BIGINT AS iz FROM cells),
    a AS (SELECT celltype, ix + o AS ix, iy, iz, sum(w) AS d FROM v, k GROUP BY ALL), b AS (SELECT celltype, ix, iy + o AS iy, iz, sum(d * w) AS d FROM a, k GROUP BY ALL), c AS (SELECT celltype, ix, iy, iz + o AS iz, sum(d * w) AS d FROM b, k GROUP BY ALL),
    n AS (SELECT celltype, ix, iy, iz, d / max(d) OVER (PARTITION BY celltype) AS d FROM c)"""


def surfaces(spark, sf_dir):
    """The surface of each label's points."""
    nodes = V.smoothed(X.cells(spark, sf_dir), SIZE, SIGMA, ["celltype"])
    return U.isosurface(nodes, LEVEL, SIZE, ["celltype"])


@query(
    "surface_report",
    f"""WITH {_NODES}, ways AS (SELECT * FROM (SELECT unnest([-1, 0, 1]) AS dx) a, (SELECT unnest([-1, 0, 1]) AS dy) b, (SELECT unnest([-1, 0, 1]) AS dz) c WHERE (dx <> 0 OR dy <> 0 OR dz <> 0) AND NOT (least(dx, dy, dz) < 0 AND greatest(dx, dy, dz) > 0)),
    vertices AS (SELECT s.celltype, count(*) AS vertices FROM (SELECT * FROM n WHERE d >= {LEVEL}) s CROSS JOIN ways LEFT JOIN n t ON t.celltype = s.celltype AND t.ix = s.ix + dx AND t.iy = s.iy + dy AND t.iz = s.iz + dz WHERE coalesce(t.d, 0) < {LEVEL} GROUP BY s.celltype),
    cubes AS (SELECT DISTINCT celltype, ix - ox AS cx, iy - oy AS cy, iz - oz AS cz FROM n, (SELECT unnest([0, 1]) AS ox) p, (SELECT unnest([0, 1]) AS oy) q, (SELECT unnest([0, 1]) AS oz) r WHERE d >= {LEVEL}),
    corners AS (SELECT c.*, ox * 4 + oy * 2 + oz AS o, coalesce(n.d, 0) AS d FROM cubes c CROSS JOIN (SELECT unnest([0, 1]) AS ox) p CROSS JOIN (SELECT unnest([0, 1]) AS oy) q CROSS JOIN (SELECT unnest([0, 1]) AS oz) r LEFT JOIN n ON n.celltype = c.celltype AND n.ix = cx + ox AND n.iy = cy + oy AND n.iz = cz + oz),
    cube AS (SELECT celltype, cx, cy, cz, list(d ORDER BY o) AS d FROM corners GROUP BY ALL),
    tets AS (SELECT celltype, list_reverse_sort([d[1], d[1 + p], d[1 + q], d[8]]) AS s FROM cube, (VALUES (4, 6), (4, 5), (2, 6), (2, 3), (1, 5), (1, 3)) t(p, q)),
    parts AS (SELECT celltype, len(list_filter(s, lambda e: e >= {LEVEL})) AS k, s[1] AS a, s[2] AS b, s[3] AS c, s[4] AS e FROM tets),
    shares AS (SELECT celltype, k, CASE k WHEN 0 THEN 0::DOUBLE WHEN 4 THEN 1 WHEN 1 THEN ((a - {LEVEL}) / (a - b)) * ((a - {LEVEL}) / (a - c)) * ((a - {LEVEL}) / (a - e)) WHEN 3 THEN 1 - (({LEVEL} - e) / (a - e)) * (({LEVEL} - e) / (b - e)) * (({LEVEL} - e) / (c - e))
        ELSE ((a - {LEVEL}) / (a - c)) * ((a - {LEVEL}) / (a - e)) * (1 - (b - {LEVEL}) / (b - e)) + ((a - {LEVEL}) / (a - c)) * ((b - {LEVEL}) / (b - e)) * (1 - (b - {LEVEL}) / (b - c)) + ((b - {LEVEL}) / (b - c)) * ((b - {LEVEL}) / (b - e)) END AS share FROM parts),
    faces AS (SELECT celltype, CAST(sum(CASE k WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 1 ELSE 0 END) AS BIGINT) AS faces, sum(share) / 6 * {SIZE} ** 3 AS volume FROM shares GROUP BY ALL)
    SELECT celltype, vertices, faces * 3 // 2 AS edges, faces, vertices - faces * 3 // 2 + faces AS euler, 0::BIGINT AS open_edges, 0::BIGINT AS twisted_edges, true AS watertight, round(volume, 6) AS volume FROM faces JOIN vertices USING (celltype)""",
)
def surface_report(spark, sf_dir):
    out = U.surface_report(held(surfaces(spark, sf_dir)), ["celltype"])
    return out.select("celltype", "vertices", "edges", "faces", "euler", "open_edges", "twisted_edges", "watertight", r6("volume").alias("volume"))


@query(
    "points_inside_surface",
    f"""WITH {_NODES}, f AS (SELECT celltype, cell_id, floor(x / {SIZE})::BIGINT AS cx, floor(y / {SIZE})::BIGINT AS cy, floor(z / {SIZE})::BIGINT AS cz, x / {SIZE} - floor(x / {SIZE}) AS fx, y / {SIZE} - floor(y / {SIZE}) AS fy, z / {SIZE} - floor(z / {SIZE}) AS fz FROM cells),
    o AS (SELECT *, list_reverse_sort([fx, fy, fz]) AS s, [(0, 0, 0), CASE WHEN fx >= fy AND fx >= fz THEN (1, 0, 0) WHEN fy >= fz THEN (0, 1, 0) ELSE (0, 0, 1) END, CASE WHEN fx <= fy AND fx <= fz THEN (0, 1, 1) WHEN fy <= fz THEN (1, 0, 1) ELSE (1, 1, 0) END, (1, 1, 1)] AS w FROM f),
    e AS (SELECT celltype, cell_id, cx, cy, cz, unnest(w) AS w, unnest([1 - s[1], s[1] - s[2], s[2] - s[3], s[3]]) AS share FROM o),
    d AS (SELECT e.celltype, e.cell_id, sum(share * coalesce(n.d, 0)) AS d FROM e LEFT JOIN n ON n.celltype = e.celltype AND n.ix = cx + struct_extract_at(w, 1) AND n.iy = cy + struct_extract_at(w, 2) AND n.iz = cz + struct_extract_at(w, 3) GROUP BY ALL)
    SELECT celltype, cell_id, d >= {LEVEL} AS inside FROM d""",
)
def points_inside_surface(spark, sf_dir):
    return U.containment(X.cells(spark, sf_dir), held(surfaces(spark, sf_dir)), SIZE, ["celltype"]).select("celltype", "cell_id", "inside")


#: Coefficients of each gene after so many rounds of Fisher scoring, three normal equations solved by Cramer's rule.
_TRENDS = """RECURSIVE c AS (SELECT user_id AS cell_id, avg(value) AS x FROM events GROUP BY ALL), y AS (SELECT user_id AS cell_id, event_type AS gene, count(*)::DOUBLE AS y FROM events GROUP BY ALL),
    q AS (SELECT min(x) AS lo, median(x) AS mid, max(x) AS hi FROM (SELECT DISTINCT x FROM c)), t AS (SELECT cell_id, (x - lo) / (hi - lo) AS t, (mid - lo) / (hi - lo) AS k FROM c, q),
    g AS (SELECT DISTINCT gene FROM y), d AS (SELECT gene, t AS a, t ** 3 - greatest(t - k, 0) ** 3 / (1 - k) AS b, coalesce(y, 0) AS y FROM t CROSS JOIN g LEFT JOIN y USING (cell_id, gene)),
    it(r, gene, b0, b1, b2) AS (
        SELECT 0, gene, ln(avg(y)), 0::DOUBLE, 0::DOUBLE FROM d GROUP BY gene
        UNION ALL
        SELECT r + 1, gene, b0 + (s0 * (m11 * m22 - m12 * m12) - m01 * (s1 * m22 - m12 * s2) + m02 * (s1 * m12 - m11 * s2)) / det, b1 + (m00 * (s1 * m22 - m12 * s2) - s0 * (m01 * m22 - m12 * m02) + m02 * (m01 * s2 - s1 * m02)) / det, b2 + (m00 * (m11 * s2 - s1 * m12) - m01 * (m01 * s2 - s1 * m02) + s0 * (m01 * m12 - m11 * m02)) / det
        FROM (SELECT *, m00 * (m11 * m22 - m12 * m12) - m01 * (m01 * m22 - m12 * m02) + m02 * (m01 * m12 - m11 * m02) AS det FROM (
            SELECT r, gene, b0, b1, b2, sum(w) AS m00, sum(w * a) AS m01, sum(w * b) AS m02, sum(w * a * a) AS m11, sum(w * a * b) AS m12, sum(w * b * b) AS m22, sum(s) AS s0, sum(s * a) AS s1, sum(s * b) AS s2
            FROM (SELECT r, gene, b0, b1, b2, a, b, m / (1 + m) AS w, (y - m) / (1 + m) AS s FROM (SELECT it.*, d.a, d.b, d.y, exp(b0 + b1 * a + b2 * b) AS m FROM it JOIN d USING (gene) WHERE r < 25)) GROUP BY r, gene, b0, b1, b2))
    ), e AS (SELECT gene, sum(y * h - (y + 1) * ln(1 + exp(h))) AS llf, sum(y * n - (y + 1) * ln(1 + exp(n))) AS null_llf, count(*) FILTER (y > 0) AS cells FROM (SELECT gene, y, b0 + b1 * a + b2 * b AS h, ln(avg(y) OVER (PARTITION BY gene)) AS n FROM it JOIN d USING (gene) WHERE r = 25) GROUP BY gene),
    p AS (SELECT *, greatest(0, 2 * (llf - null_llf)) AS ratio, exp(-greatest(0, 2 * (llf - null_llf)) / 2) AS p FROM e), z AS (SELECT *, p * count(*) OVER () / row_number() OVER (ORDER BY p, gene) AS z FROM p)"""


def cell_feature(spark, sf_dir):
    return X.read(spark, sf_dir, "events").groupBy(F.col("user_id").alias("cell_id")).agg(F.avg("value").alias("x"))


@query("expression_trends", f"WITH {_TRENDS} SELECT gene, 'ok' AS status, cells, round(llf, 4) AS llf_full, round(null_llf, 4) AS llf_null, round(ratio, 4) AS ratio, round(p, 5) AS p, round(least(1, min(z) OVER (ORDER BY p DESC, gene DESC ROWS UNBOUNDED PRECEDING)), 5) AS q FROM z")
def expression_trends(spark, sf_dir):
    out = D.spline_trends(cell_feature(spark, sf_dir), X.expression(spark, sf_dir), "x")
    return out.select("gene", "status", "cells", *[F.round(c, 4).alias(c) for c in ("llf_full", "llf_null", "ratio")], *[F.round(c, 5).alias(c) for c in ("p", "q")])


def displacements(spark, sf_dir):
    """Each point and where the plan of its slice's pair moves it by."""
    moved = O.mapped(stage_pairs(spark, sf_dir), ["boundary"], ["x", "y", "z"]).select("cell_id", "x_to", "y_to", "z_to")
    return X.cells(spark, sf_dir).join(moved, "cell_id").select("cell_id", "celltype", "x", "y", "z", *[(F.col(f"{a}_to") - F.col(a)).alias(f"d{a}") for a in "xyz"])


_AXES, _VECTORS = ["x", "y", "z"], ["dx", "dy", "dz"]
#: Displacements of unrelated slices scatter: outliers are looked for far beyond them only.
_FIELD = L.FieldFit(outliers=200.0, smoothing=0.1)


@query("displacement_field")
def displacement_field(spark, sf_dir):
    """The smooth field of all displacements and its derivatives at every point."""
    d = held(displacements(spark, sf_dir))
    out = L.field_values(d, L.fit_field(d, _AXES, _VECTORS, _FIELD))
    return out.select("cell_id", *[F.round(c, 5).alias(c) for c in ("v_x", "v_y", "v_z", "speed", "divergence", "jacobian_norm")])


@query("field_paths")
def field_paths(spark, sf_dir):
    """Where every point is after following the field for one and two units of time."""
    d = held(displacements(spark, sf_dir))
    out = L.paths(d, L.fit_field(d, _AXES, _VECTORS, _FIELD), 2.0, 20, every=10)
    return out.select("cell_id", "step", "t", *[F.round(a, 5).alias(a) for a in _AXES])


@query("interpolated_speed")
def interpolated_speed(spark, sf_dir):
    """How far each point moves, smoothed over space by a process on inducing points."""
    d = held(displacements(spark, sf_dir).withColumn("moved", F.sqrt(sum((F.col(v) * F.col(v) for v in _VECTORS), F.lit(0.0)))))
    g = L.fit_interpolation(d, _AXES, ["moved"], L.Interpolation(inducing=64))
    return L.interpolated(d.select("cell_id", *_AXES, "moved"), g).select("cell_id", F.round("moved", 5).alias("moved"), F.round("moved_smooth", 5).alias("smooth"))
