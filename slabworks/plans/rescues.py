"""Queries of rescues and of chains of transforms."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from slabworks.functions.columns import lit
from slabworks.operators import rescue as S
from slabworks.plans import alignment  # noqa: F401  its SQL is begun with
from slabworks.plans.registry import SQL, query, r6
from slabworks.sources import fixtures as X


def proposals(points):
    """For each slice but the last: a small turn, and the shift that brings its centre to the next one's."""
    c = points.groupBy("dataset_id", "slice_index").agg(F.avg("x").alias("mx"), F.avg("y").alias("my"))
    w = Window.partitionBy("dataset_id").orderBy("slice_index")
    c = c.withColumns({"place": F.row_number().over(w) - 1, "tx": F.lead("mx").over(w) - F.col("mx"), "ty": F.lead("my").over(w) - F.col("my")})
    return c.where("tx is not null").select("dataset_id", "place", ((F.col("place") % 3 - 1) * lit(0.03)).alias("theta"), "tx", "ty")


def _trial_scores() -> str:
    """The CTEs of the pair scores, over pairs that are named by place, boundary and share instead of boundary alone."""
    own = SQL["edge_alignment_scores"]
    own = own[: own.index("SELECT boundary, labels,")].rstrip()
    at = own.index("nn AS (")
    trial = """cm AS (SELECT p, avg(x) AS mx, avg(y) AS my FROM cells JOIN sl USING (dataset_id, slice_index) GROUP BY p), prop AS (SELECT p AS place, (p % 3 - 1) * 0.03::DOUBLE AS theta, lead(mx) OVER (ORDER BY p) - mx AS tx, lead(my) OVER (ORDER BY p) - my AS ty FROM cm),
    tried AS (SELECT dataset_id, boundary AS own, place, k, side, cell_id, label, x, y, k * 0.25 * theta AS th, k * 0.25 * tx AS tx, k * 0.25 * ty AS ty, place = boundary + CASE WHEN side = 'm' THEN 1 ELSE 0 END AS moves FROM pt0 JOIN prop ON boundary IN (place - 1, place) AND tx IS NOT NULL, (SELECT unnest([0, 1, 2, 3, 4]) AS k) s),
    pt AS (SELECT dataset_id, place * 100000 + own * 10 + k AS boundary, side, cell_id, CASE WHEN moves THEN cos(th) * x - sin(th) * y + tx ELSE x END AS x, CASE WHEN moves THEN sin(th) * x + cos(th) * y + ty ELSE y END AS y, label FROM tried),
    """
    return own[:at].replace("pt AS (", "pt0 AS (", 1) + trial + own[at:]


@query(
    "fractional_rescues",
    _trial_scores()
    + """,
    lo AS (SELECT a.boundary, max(sqrt((a.ex - b.ex) ** 2 + (a.ey - b.ey) ** 2)) FILTER (a.e = 'low1') AS low, max(sqrt((a.ex - b.ex) ** 2 + (a.ey - b.ey) ** 2)) FILTER (a.e = 'high1') AS high FROM en a JOIN en b ON a.boundary = b.boundary AND a.e = b.e WHERE a.side = 'm' AND b.side = 'f' GROUP BY ALL),
    w AS (SELECT boundary // 100000 AS place, boundary % 100000 // 10 AS own, boundary % 10 AS k, 0.22 * geometry + 0.18 * annotation + 0.18 * shape + 0.34 * endpoint_max + 0.08 * extent AS v2, low / scale AS low, high / scale AS high, annotation FROM v JOIN lo USING (boundary) JOIN sc USING (boundary)),
    g AS (SELECT place, k, avg(v2) AS score, max(low) FILTER (own = place) AS low, max(high) FILTER (own = place) AS high, max(annotation) FILTER (own = place) AS annotation FROM w GROUP BY ALL),
    h AS (SELECT g.*, z.score AS s0, (z.score - g.score) / greatest(z.score, 1e-12) AS gain, g.k > 0 AND (z.score - g.score) / greatest(z.score, 1e-12) >= 0.015 AND g.low <= z.low * 1.08 AND g.high <= z.high * 1.08 AND g.annotation <= z.annotation * 1.15 AS good FROM g JOIN g z ON z.place = g.place AND z.k = 0),
    j AS (SELECT place, min(k) FILTER (good) AS k, any_value(s0) AS s0, arg_min(k, (score, k)) AS best FROM h GROUP BY place)
    SELECT CAST(j.place AS INTEGER) AS place, j.k IS NOT NULL AS accepted, round(coalesce(j.k, 0) * 0.25, 2) AS share, round(s0, 6) AS score_before, round(coalesce(h.score, s0), 6) AS score_after, round(coalesce(h.gain, 0), 5) AS gain, round(best * 0.25, 2) AS best_share, round(coalesce(j.k, 0) * 0.25 * prop.tx, 6) AS tx
    FROM j JOIN prop USING (place) LEFT JOIN (SELECT place, k, score, gain FROM h) h ON h.place = j.place AND h.k = j.k""",
)
def fractional_rescues(spark, sf_dir):
    c = X.cells(spark, sf_dir)
    out = S.fractional_rescues(c, proposals(c))
    return out.select("place", "accepted", F.round("share", 2).alias("share"), r6("score_before").alias("score_before"), r6("score_after").alias("score_after"), F.round("gain", 5).alias("gain"), F.round("best_share", 2).alias("best_share"), r6("tx").alias("tx"))


@query("sparse_end_rescues")
def sparse_end_rescues(spark, sf_dir):
    """The last slice thinned to a third and shifted away, with the way back as its proposal."""
    c = X.cells(spark, sf_dir)
    last = c.agg(F.max("slice_index").alias("last"))
    c = c.crossJoin(F.broadcast(last))  # one row
    away = F.when(F.col("slice_index") == F.col("last"), lit(0.1)).otherwise(lit(0))
    c = c.where("slice_index < last or cell_id % 3 = 0").withColumn("x", F.col("x") + away)
    place = c.select("dataset_id", "slice_index").distinct().groupBy("dataset_id").agg((F.count("*") - 1).cast("int").alias("place"))
    back = place.select("dataset_id", "place", lit(0).alias("theta"), lit(-0.1).alias("tx"), lit(0).alias("ty"))
    out = S.sparse_end_rescues(c, back)
    return out.select("place", "triggered", "accepted", "share", *[r6(k).alias(k) for k in ("count_ratio", "score_before", "score_after", "gain", "turn", "ratio")])


@query("lineage_end_rescues")
def lineage_end_rescues(spark, sf_dir):
    """The series as it is with small proposals, and one whose last slice but one is shifted away with the way back proposed."""
    c = X.cells(spark, sf_dir).withColumn("celltype", F.when(F.col("celltype") == "9", "rest").otherwise("main"))
    last = c.agg(F.max("slice_index").alias("last"))
    away = c.crossJoin(F.broadcast(last)).withColumn("x", F.col("x") + F.when(F.col("slice_index") == F.col("last") - 1, lit(0.1)).otherwise(lit(0))).drop("last")  # one row
    away = away.withColumn("dataset_id", F.lit("shifted"))
    place = away.select("dataset_id", "slice_index").distinct().groupBy("dataset_id").agg((F.count("*") - 2).cast("int").alias("place"))
    back = place.select("dataset_id", "place", lit(0).alias("theta"), lit(-0.1).alias("tx"), lit(0).alias("ty"))
    out = S.lineage_end_rescues(c.unionByName(away), proposals(c).unionByName(back))
    return out.select("dataset_id", "label", "accepted", *[r6(k).alias(k) for k in ("lineage_before", "lineage_after", "gain", "full_before", "full_after", "turn", "ratio")])


_EDGES = "e AS (SELECT o_custkey AS dataset_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS edge, cos((o_orderkey % 7) * 0.1::DOUBLE) AS c, sin((o_orderkey % 7) * 0.1::DOUBLE) AS s, o_totalprice::DOUBLE / 100000 AS tx, (o_orderkey % 5)::DOUBLE AS ty FROM orders)"


@query(
    "chained_edges",
    f"""WITH RECURSIVE {_EDGES}, f(dataset_id, edge, m00, m01, m02, m10, m11, m12) AS (
        SELECT dataset_id, edge, c, -s, tx, s, c, ty FROM e WHERE edge = 1
        UNION ALL
        SELECT e.dataset_id, e.edge, m00 * c + m01 * s, m01 * c - m00 * s, m00 * tx + m01 * ty + m02, m10 * c + m11 * s, m11 * c - m10 * s, m10 * tx + m11 * ty + m12 FROM f JOIN e ON e.dataset_id = f.dataset_id AND e.edge = f.edge + 1
    ) SELECT dataset_id, CAST(edge AS INTEGER) AS edge, round(m00, 6) AS m00, round(m01, 6) AS m01, round(m02, 5) AS m02, round(m10, 6) AS m10, round(m11, 6) AS m11, round(m12, 5) AS m12 FROM f""",
)
def chained_edges(spark, sf_dir):
    o = X.read(spark, sf_dir, "orders")
    turn = (F.col("o_orderkey") % 7) * lit(0.1)
    edge = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    e = o.select(F.col("o_custkey").alias("dataset_id"), edge.alias("edge"), F.cos(turn).alias("m00"), (-F.sin(turn)).alias("m01"), (F.col("o_totalprice").cast("double") / 100000).alias("m02"), F.sin(turn).alias("m10"), F.cos(turn).alias("m11"), (F.col("o_orderkey") % 5).cast("double").alias("m12"))
    out = S.chained_edges(e)
    return out.select("dataset_id", "edge", *[F.round(m, 5 if m[2] == "2" else 6).alias(m) for m in ("m00", "m01", "m02", "m10", "m11", "m12")])


OPERATIONS = [
    {"operation_id": "first", "edge_id": "e3", "steps": [{"op": "translate", "dx": 2.0, "dy": -1.0, "slices": [3, 4, 5]}]},
    {"steps": [{"op": "affine", "matrix": ((1.0, 0.25, 1.0), (0.0, 1.0, -2.0)), "slices": [4]}, {"op": "scale", "factor": 1.5, "center": (0.0, 5.0), "slices": [12]}]},
    {"operation_id": "none", "edge_id": "e9", "steps": [{"op": "translate", "dx": 9.0, "dy": 9.0, "slices": [-7]}], "affected_slices": [9]},
]


@query(
    "chain_lineage",
    """WITH a AS (SELECT slice_index, x AS x0, y AS y0, CASE WHEN slice_index IN (3, 4, 5) THEN x + 2 ELSE x END AS x1, CASE WHEN slice_index IN (3, 4, 5) THEN y - 1 ELSE y END AS y1 FROM points),
    b AS (SELECT *, CASE slice_index WHEN 4 THEN x1 + 0.25 * y1 + 1 WHEN 12 THEN x1 * 1.5 ELSE x1 END AS x2, CASE slice_index WHEN 4 THEN y1 - 2 WHEN 12 THEN 5 + (y1 - 5) * 1.5 ELSE y1 END AS y2 FROM a),
    d AS (SELECT sqrt((x1 - x0) ** 2 + (y1 - y0) ** 2) AS d1, sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2) AS d2 FROM b)
    SELECT 1 AS step_order, 'first' AS operation_id, 'e3' AS edge_id, '3;4;5' AS affected, count(*) FILTER (d1 > 1e-9) AS changed, round(coalesce(avg(d1) FILTER (d1 > 1e-9), 0), 6) AS mean_shift, round(coalesce(max(d1), 0), 6) AS max_shift, 0.0::DOUBLE AS residual FROM d
    UNION ALL SELECT 2, 'op_002', NULL, '4;12', count(*) FILTER (d2 > 1e-9), round(coalesce(avg(d2) FILTER (d2 > 1e-9), 0), 6), round(coalesce(max(d2), 0), 6), 0.0 FROM d
    UNION ALL SELECT 3, 'none', 'e9', '9', 0, 0.0, 0.0, 0.0""",
    "points",
)
def chain_lineage(spark, sf_dir):
    _, log = S.chain_lineage(X.points(spark, sf_dir), OPERATIONS)
    return log.select("step_order", "operation_id", "edge_id", "affected", "changed", *[r6(c).alias(c) for c in ("mean_shift", "max_shift", "residual")])
