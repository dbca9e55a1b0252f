"""Queries over aligned series: continuity scores, repairs, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from slabworks.operators import continuity as K
from slabworks.plans.registry import query, r6
from slabworks.sources import fixtures as X

PAIR = ["dataset_id", "boundary"]

_PAIRS = """sl AS (SELECT dataset_id, slice_index, row_number() OVER (PARTITION BY dataset_id ORDER BY slice_index) - 1 AS p, count(*) OVER (PARTITION BY dataset_id) AS k FROM (SELECT DISTINCT dataset_id, slice_index FROM cells)),
pt AS (SELECT dataset_id, p AS boundary, 'f' AS side, cell_id, x, y, celltype AS label FROM cells JOIN sl USING (dataset_id, slice_index) WHERE p < k - 1
  UNION ALL SELECT dataset_id, p - 1, 'm', cell_id, x, y, celltype FROM cells JOIN sl USING (dataset_id, slice_index) WHERE p > 0),
nn AS (SELECT a.boundary, a.side, a.cell_id, sqrt(min((a.x - b.x) ** 2 + (a.y - b.y) ** 2)) AS d FROM pt a JOIN pt b ON a.boundary = b.boundary AND a.side <> b.side GROUP BY ALL),
box AS (SELECT boundary, side, quantile_cont(x, 0.98) - quantile_cont(x, 0.02) AS w, quantile_cont(y, 0.98) - quantile_cont(y, 0.02) AS h FROM pt GROUP BY ALL),
sc AS (SELECT m.boundary, (greatest(sqrt(m.w ** 2 + m.h ** 2), 1e-8) + greatest(sqrt(f.w ** 2 + f.h ** 2), 1e-8)) / 2 AS scale, sqrt((m.w - f.w) ** 2 + (m.h - f.h) ** 2) AS ext FROM box m JOIN box f ON m.boundary = f.boundary AND m.side = 'm' AND f.side = 'f')"""
_LABELS = """ct AS (SELECT boundary, label, side, count(*) AS n FROM pt GROUP BY ALL), ok AS (SELECT a.boundary, a.label FROM ct a JOIN ct b USING (boundary, label) WHERE a.side = 'm' AND b.side = 'f' AND least(a.n, b.n) >= 8),
lp AS (SELECT pt.* FROM pt JOIN ok USING (boundary, label)),
ln AS (SELECT a.boundary, a.label, a.side, a.cell_id, sqrt(min((a.x - b.x) ** 2 + (a.y - b.y) ** 2)) AS d FROM lp a JOIN lp b ON a.boundary = b.boundary AND a.label = b.label AND a.side <> b.side GROUP BY ALL),
lt AS (SELECT boundary, label, avg(t) AS t FROM (SELECT boundary, label, side, avg(d) AS t FROM (SELECT *, quantile_cont(d, 0.85) OVER (PARTITION BY boundary, label, side) AS q FROM ln) WHERE d <= q GROUP BY ALL) GROUP BY ALL)"""


@query(
    "edge_alignment_scores",
    f"""WITH {_PAIRS}, {_LABELS},
    geo AS (SELECT boundary, avg(t) AS t FROM (SELECT boundary, side, avg(d) AS t FROM (SELECT *, quantile_cont(d, 0.90) OVER (PARTITION BY boundary, side) AS q FROM nn) WHERE d <= q GROUP BY ALL) GROUP BY ALL),
    lc AS (SELECT *, quantile_cont(x, 0.5) OVER w AS cx, quantile_cont(y, 0.5) OVER w AS cy, count(*) OVER w AS n FROM lp WINDOW w AS (PARTITION BY boundary, label, side)),
    ls AS (SELECT boundary, label, side, any_value(n) AS n, any_value(cx) AS cx, any_value(cy) AS cy, quantile_cont(sqrt((x - cx) ** 2 + (y - cy) ** 2), 0.5) AS spread FROM lc GROUP BY ALL),
    lw AS (SELECT boundary, label, sqrt((m.cx - f.cx) ** 2 + (m.cy - f.cy) ** 2) / scale AS dist, t / scale AS shp, least(30, sqrt(least(m.n, f.n)) / ((m.spread + f.spread) / 2 / scale + 0.08)) AS w1, least(18, sqrt(least(m.n, f.n)) / ((m.spread + f.spread) / 2 / scale + 0.10)) AS w2
        FROM ls m JOIN ls f USING (boundary, label) JOIN sc USING (boundary) JOIN lt USING (boundary, label) WHERE m.side = 'm' AND f.side = 'f'),
    la AS (SELECT boundary, count(*) AS labels, sum(w1 * dist) / sum(w1) AS a, sum(w2 * shp) / sum(w2) AS s FROM lw GROUP BY ALL),
    fx AS (SELECT boundary, x - median(x) OVER w AS dx, y - median(y) OVER w AS dy FROM pt WHERE side = 'f' WINDOW w AS (PARTITION BY boundary)),
    ax AS (SELECT boundary, atan2(2 * sum(dx * dy), sum(dx * dx) - sum(dy * dy)) / 2 AS turn FROM fx GROUP BY ALL),
    pr AS (SELECT boundary, side, x, y, cos(turn) * x + sin(turn) * y AS p1, cos(turn) * y - sin(turn) * x AS p2 FROM pt JOIN ax USING (boundary)),
    qs AS (SELECT *, quantile_cont(p1, 0.06) OVER w AS l1, quantile_cont(p1, 0.94) OVER w AS h1, quantile_cont(p2, 0.06) OVER w AS l2, quantile_cont(p2, 0.94) OVER w AS h2 FROM pr WINDOW w AS (PARTITION BY boundary, side)),
    en AS (SELECT boundary, side, 'low1' AS e, median(x) AS ex, median(y) AS ey FROM qs WHERE p1 <= l1 GROUP BY ALL UNION ALL SELECT boundary, side, 'high1', median(x), median(y) FROM qs WHERE p1 >= h1 GROUP BY ALL
        UNION ALL SELECT boundary, side, 'low2', median(x), median(y) FROM qs WHERE p2 <= l2 GROUP BY ALL UNION ALL SELECT boundary, side, 'high2', median(x), median(y) FROM qs WHERE p2 >= h2 GROUP BY ALL),
    gp AS (SELECT a.boundary, avg(sqrt((a.ex - b.ex) ** 2 + (a.ey - b.ey) ** 2)) AS al, max(sqrt((a.ex - b.ex) ** 2 + (a.ey - b.ey) ** 2)) FILTER (a.e IN ('low1', 'high1')) AS mx FROM en a JOIN en b ON a.boundary = b.boundary AND a.e = b.e WHERE a.side = 'm' AND b.side = 'f' GROUP BY ALL),
    v AS (SELECT boundary, ext / scale AS extent, geo.t / scale AS geometry, coalesce(a, geo.t / scale * 1.5) AS annotation, coalesce(s, coalesce(a, geo.t / scale * 1.5) * 1.25) AS shape, al / scale AS endpoint, mx / scale AS endpoint_max, coalesce(labels, 0) AS labels
        FROM sc JOIN geo USING (boundary) JOIN gp USING (boundary) LEFT JOIN la USING (boundary))
    SELECT boundary, labels, round(geometry, 6) AS geometry, round(annotation, 6) AS annotation, round(shape, 6) AS shape, round(endpoint, 6) AS endpoint, round(endpoint_max, 6) AS endpoint_max, round(extent, 6) AS extent,
        round(0.42 * geometry + 0.30 * annotation + 0.18 * endpoint + 0.10 * extent, 6) AS v1, round(0.22 * geometry + 0.18 * annotation + 0.18 * shape + 0.34 * endpoint_max + 0.08 * extent, 6) AS v2 FROM v""",
    "cells",
)
def edge_alignment_scores(spark, sf_dir):
    out = K.alignment_scores(K.adjacent_pairs(X.cells(spark, sf_dir)), PAIR)
    return out.select("boundary", "labels", *[r6(c).alias(c) for c in ("geometry", "annotation", "shape", "endpoint", "endpoint_max", "extent", "v1", "v2")])


@query("lineage_distances", f"WITH {_PAIRS}, {_LABELS} SELECT boundary, label, round(t / scale, 6) AS distance FROM lt JOIN sc USING (boundary)", "cells")
def lineage_distances(spark, sf_dir):
    return K.lineage_distances(K.adjacent_pairs(X.cells(spark, sf_dir)), PAIR).select("boundary", "label", r6("distance").alias("distance"))


@query(
    "registration_report",
    f"""WITH {_PAIRS},
    b AS (SELECT a.boundary, a.side, a.cell_id, a.x, a.y, a.label, b.label AS found, sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) AS d, row_number() OVER (PARTITION BY a.boundary, a.side, a.cell_id ORDER BY (a.x - b.x) ** 2 + (a.y - b.y) ** 2, b.cell_id) AS r
        FROM pt a JOIN pt b ON a.boundary = b.boundary AND a.side <> b.side)
    SELECT boundary, coalesce(label, 'all') AS label, count(*) FILTER (side = 'm') AS n_m, count(*) FILTER (side = 'f') AS n_f, round(avg(d), 6) AS nearest_mean, round(quantile_cont(d, 0.95), 6) AS nearest_p95,
        round(sqrt((avg(x) FILTER (side = 'm') - avg(x) FILTER (side = 'f')) ** 2 + (avg(y) FILTER (side = 'm') - avg(y) FILTER (side = 'f')) ** 2), 6) AS centre_gap, round(avg(CASE WHEN label = found THEN 1.0::DOUBLE ELSE 0 END), 6) AS agreement
    FROM b WHERE r = 1 GROUP BY GROUPING SETS ((boundary), (boundary, label))""",
    "cells",
)
def registration_report(spark, sf_dir):
    out = K.registration_report(X.cells(spark, sf_dir))
    return out.select("boundary", F.coalesce("label", F.lit("all")).alias("label"), "n_m", "n_f", *[r6(c).alias(c) for c in ("nearest_mean", "nearest_p95", "centre_gap", "agreement")])


@query("terminal_score", f"""WITH {_PAIRS}, {_LABELS} SELECT 'emb' AS dataset_id, round(avg(t / scale), 6) AS lineage, count(*) AS pairs FROM lt JOIN sc USING (boundary) WHERE label = (SELECT min(label) FROM lt)""", "cells")
def terminal_score(spark, sf_dir):
    lineage = K.lineage_distances(K.adjacent_pairs(X.cells(spark, sf_dir)), PAIR)
    first = lineage.agg(F.min("label").alias("label"))
    own = lineage.join(F.broadcast(first), "label", "left_semi")  # one row
    return own.agg(F.avg("distance").alias("d"), F.count("*").alias("pairs")).select(F.lit("emb").alias("dataset_id"), r6("d").alias("lineage"), "pairs")


@query("block_translations")
def block_translations(spark, sf_dir):
    return K.block_translations(K.adjacent_pairs(X.cells(spark, sf_dir)), PAIR)
