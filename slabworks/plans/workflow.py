"""Queries of the pairwise workflow."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from slabworks.functions.columns import hash_rank
from slabworks.operators import geometry as G
from slabworks.operators import workflow as K
from slabworks.plans.registry import query, r6
from slabworks.sources import fixtures as X

_MOVED = """mv AS (SELECT *, x AS x0, y AS y0, CASE WHEN slice_index IN (3, 4, 5) THEN x + 2 ELSE x END AS x1, CASE WHEN slice_index IN (3, 4, 5) THEN y - 1 ELSE y END AS y1 FROM points)"""
STEPS = [{"op": "translate", "dx": 2.0, "dy": -1.0, "slices": [3, 4, 5]}]


@query("clean_export", f"WITH {_MOVED} SELECT cell_id, CAST(slice_index AS INTEGER) AS slice_index, celltype, round(x1, 6) AS x, round(y1, 6) AS y, round(sqrt((x1 - x0) ** 2 + (y1 - y0) ** 2), 6) AS shift, sqrt((x1 - x0) ** 2 + (y1 - y0) ** 2) > 1e-6 OR celltype = 'error' AS changed FROM mv", "points")
def clean_export(spark, sf_dir):
    p = X.points(spark, sf_dir)
    out = K.clean_export(p, G.apply_recipe(p, STEPS), F.col("celltype") == "error")
    return out.select("cell_id", "slice_index", "celltype", r6("x").alias("x"), r6("y").alias("y"), r6("shift").alias("shift"), "changed")


@query("cell_id_map", "SELECT CAST(slice_index AS INTEGER) AS slice_index, concat_ws(':', slice_index, row_number() OVER (PARTITION BY slice_index ORDER BY cell_id) - 1) AS row_id, concat_ws('_', slice_index, cell_id) AS clean_id, false AS repeated FROM points", "points")
def cell_id_map(spark, sf_dir):
    return K.cell_id_map(X.points(spark, sf_dir).withColumn("name", F.concat(F.lit("CELL."), "cell_id")), ["slice_index"], "cell_id", "name", "slice_index")


@query("mapped_points", "SELECT 'c' || cell_id AS cell, CAST(slice_index AS INTEGER) AS slice_index FROM points WHERE slice_index < 5", "points")
def mapped_points(spark, sf_dir):
    p = X.points(spark, sf_dir)
    ids = p.select("cell_id", F.concat(F.lit("c"), "cell_id").alias("cell"))
    return K.mapped(p.where("slice_index < 5"), ids, "cell_id", "cell").select("cell", "slice_index")


@query("replay_differences", f"WITH {_MOVED}, s AS (SELECT * FROM mv WHERE cell_id % 7 = 0) SELECT 'same' AS source, count(*) AS points, 0::BIGINT AS missing, 0.0::DOUBLE AS greatest, true AS same FROM s UNION ALL SELECT 'changed', count(*), count(*) FILTER (cell_id % 11 = 0), max(CASE WHEN cell_id % 11 = 0 THEN 0 WHEN cell_id % 13 = 0 THEN 0.5::DOUBLE ELSE 0 END), false FROM s", "points")
def replay_differences(spark, sf_dir):
    p = X.points(spark, sf_dir)
    sample = p.where("cell_id % 7 = 0")  # a sampled replay is what this operator compares
    replayed = G.apply_recipe(sample, STEPS)
    one = K.replay_differences(G.apply_recipe(p, STEPS), replayed).withColumn("source", F.lit("same"))
    # a source that lacks points and has moved others
    other = p.where("cell_id % 11 <> 0").withColumn("y", F.when(F.col("cell_id") % 13 == 0, F.col("y") + 0.5).otherwise(F.col("y")))
    two = K.replay_differences(G.apply_recipe(other, STEPS), replayed).withColumn("source", F.lit("changed"))
    return one.unionByName(two).withColumn("greatest", F.round("greatest", 9))


@query("close_coordinates", "WITH a AS (SELECT cell_id, slice_index, x, y FROM points WHERE slice_index < 20), b AS (SELECT cell_id, slice_index, x * 1.00005 AS x, CASE WHEN slice_index = 12 THEN y + 1 ELSE y END AS y FROM points WHERE slice_index >= 10) SELECT CASE WHEN a.x IS NULL THEN 'right_only' WHEN b.x IS NULL THEN 'left_only' ELSE 'both' END AS side, count(*) AS rows, count(*) FILTER (abs(a.x - b.x) > abs(b.x) * 1e-4 + 1e-7 OR abs(a.y - b.y) > abs(b.y) * 1e-4 + 1e-7) AS far FROM a FULL JOIN b USING (cell_id, slice_index) GROUP BY ALL", "points")
def close_coordinates(spark, sf_dir):
    p = X.points(spark, sf_dir)
    b = p.where("slice_index >= 10").withColumn("x", F.col("x") * 1.00005).withColumn("y", F.when(F.col("slice_index") == 12, F.col("y") + 1).otherwise(F.col("y")))
    return K.close_coordinates(p.where("slice_index < 20"), b, ["cell_id", "slice_index"])


@query(
    "recipe_kinds",
    """WITH t AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Drop ' WHEN 'O' THEN 'mode=Spatial_Only ' ELSE '' END || 'sl0' || o_custkey || '__SL ' || (o_custkey + 1) || CASE WHEN o_orderkey % 2 = 0 THEN ' edge_transform' ELSE '' END AS t FROM orders)
    SELECT o_orderkey AS recipe, CASE WHEN regexp_matches(lower(t), 'drop|roi') THEN 'roi_drop_refine' WHEN contains(lower(t), 'spatial_only') THEN 'spatial_only_rescue' WHEN contains(t, 'edge_transform') THEN 'pairwise_transform' ELSE 'manual_recipe' END AS kind,
        'SL' || regexp_extract(t, '(?i)SL\\s*0*(\\d+)[_-]+SL\\s*0*(\\d+)', 1) || '__SL' || regexp_extract(t, '(?i)SL\\s*0*(\\d+)[_-]+SL\\s*0*(\\d+)', 2) AS edge, CASE WHEN contains(lower(t), 'spatial_only') THEN 'spatial_only' ELSE 'normal' END AS mode FROM t""",
)
def recipe_kinds(spark, sf_dir):
    o = X.read(spark, sf_dir, "orders")
    head = F.when(F.col("o_orderstatus") == "F", "Drop ").when(F.col("o_orderstatus") == "O", "mode=Spatial_Only ").otherwise("")
    text = F.concat(head, F.lit("sl0"), "o_custkey", F.lit("__SL "), F.col("o_custkey") + 1, F.when(F.col("o_orderkey") % 2 == 0, " edge_transform").otherwise(""))
    t = o.select(F.col("o_orderkey").alias("recipe"), text.alias("t"))
    return t.select("recipe", K.recipe_kind(F.col("t")).alias("kind"), K.recipe_edge(F.col("t")).alias("edge"), K.recipe_mode(F.col("t")).alias("mode"))


_EDGE = "ed AS (SELECT CASE WHEN slice_index = 6 THEN 'f' ELSE 'm' END AS side, cell_id, x, y, celltype AS label FROM points WHERE slice_index IN (6, 7))"


@query(
    "refine_candidates",
    f"""WITH {_EDGE}, g AS (SELECT d::DOUBLE AS degrees, a::DOUBLE AS dx, b::DOUBLE AS dy FROM unnest([-10, -5, 0, 5, 10]) t(d), unnest([-15, 0, 15]) u(a), unnest([-15, 0, 15]) v(b)),
    c AS (SELECT avg(x) AS cx, avg(y) AS cy FROM ed WHERE side = 'm' AND label = 'click'),
    t AS (SELECT degrees, dx, dy, side, label, CASE WHEN side = 'm' THEN cx + cos(radians(degrees)) * (x - cx) - sin(radians(degrees)) * (y - cy) + dx ELSE x END AS x, CASE WHEN side = 'm' THEN cy + sin(radians(degrees)) * (x - cx) + cos(radians(degrees)) * (y - cy) + dy ELSE y END AS y FROM ed, c, g
        UNION ALL SELECT NULL, NULL, NULL, side, label, x, y FROM ed),
    u AS (SELECT * FROM t UNION ALL SELECT degrees, dx, dy, side, 'all', x, y FROM t),
    m AS (SELECT degrees, dx, dy, label, side, count(*) AS n, avg(x) AS mx, avg(y) AS my FROM u GROUP BY ALL),
    r AS (SELECT u.degrees, u.dx, u.dy, u.label, u.side, any_value(n) AS n, any_value(mx) AS mx, any_value(my) AS my, median(sqrt((x - mx) ** 2 + (y - my) ** 2)) AS r FROM u JOIN m ON u.degrees IS NOT DISTINCT FROM m.degrees AND u.dx IS NOT DISTINCT FROM m.dx AND u.dy IS NOT DISTINCT FROM m.dy AND u.label = m.label AND u.side = m.side GROUP BY ALL),
    j AS (SELECT f.degrees, f.dx, f.dy, f.label, least(f.n, m.n) AS n, sqrt((f.mx - m.mx) ** 2 + (f.my - m.my) ** 2) / ((f.r + m.r) / 2) AS jump FROM r f JOIN r m ON f.degrees IS NOT DISTINCT FROM m.degrees AND f.dx IS NOT DISTINCT FROM m.dx AND f.dy IS NOT DISTINCT FROM m.dy AND f.label = m.label WHERE f.side = 'f' AND m.side = 'm'),
    w AS (SELECT a.degrees, a.dx, a.dy, a.label, a.n, a.jump - b.jump AS worse FROM j a JOIN j b ON a.label = b.label AND b.degrees IS NULL WHERE a.degrees IS NOT NULL),
    s AS (SELECT degrees, dx, dy, round(-max(worse) FILTER (label = 'click'), 9) + 0.0 AS improvement, max(worse) FILTER (label = 'all') AS all_worse, greatest(coalesce(max(worse) FILTER (label NOT IN ('all', 'click') AND n >= 30), 0), 0) AS other_worse FROM w GROUP BY ALL),
    k AS (SELECT *, -improvement + 0.5 * greatest(all_worse, 0) + 1.5 * other_worse AS rank_score FROM s)
    SELECT degrees, dx, dy, round(improvement, 6) + 0.0 AS improvement, round(all_worse, 6) + 0.0 AS all_worse, round(other_worse, 6) + 0.0 AS other_worse, round(rank_score, 6) + 0.0 AS rank_score,
        CASE WHEN improvement <= 0 THEN 'reject_no_target_improvement' WHEN all_worse > 1 OR other_worse > 1 THEN 'review_guardrail_degradation' WHEN improvement > 0.75 THEN 'promising_candidate' ELSE 'weak_candidate' END AS verdict,
        CAST(row_number() OVER (ORDER BY round(rank_score, 9), degrees, dx, dy) AS INTEGER) AS place FROM k QUALIFY place <= 20""",
    "points",
)
def refine_candidates(spark, sf_dir):
    rows = X.points(spark, sf_dir).where("slice_index in (6, 7)").select(F.when(F.col("slice_index") == 6, "f").otherwise("m").alias("side"), "cell_id", "x", "y", F.col("celltype").alias("label"))
    out = K.refine_candidates(rows, "click", shifts=(-15.0, 0.0, 15.0))
    return out.select("degrees", "dx", "dy", *[(r6(c) + 0.0).alias(c) for c in ("improvement", "all_worse", "other_worse", "rank_score")], "verdict", "place")


@query("initial_plan", "WITH s AS (SELECT DISTINCT dataset_id, slice_index FROM points), t AS (SELECT dataset_id, slice_index AS fixed, lead(slice_index) OVER w AS moving, row_number() OVER w AS edge_order FROM s WINDOW w AS (PARTITION BY dataset_id ORDER BY slice_index)) SELECT dataset_id, CAST(fixed AS INTEGER) AS fixed, CAST(moving AS INTEGER) AS moving, CAST(edge_order AS INTEGER) AS edge_order, 'SL' || lpad(fixed::VARCHAR, 3, '0') || '__SL' || lpad(moving::VARCHAR, 3, '0') AS edge_id FROM t WHERE moving IS NOT NULL", "points")
def initial_plan(spark, sf_dir):
    return K.initial_plan(X.points(spark, sf_dir).select("dataset_id", "slice_index").distinct())


@query("job_summary", "WITH p AS (SELECT c_custkey AS edge_id FROM customer), r AS (SELECT o_custkey AS edge_id, o_orderstatus AS status, o_totalprice / 1000 AS sigma2 FROM orders) SELECT coalesce(status, 'missing') AS status, count(*) AS jobs, round(avg(sigma2), 6) AS mean, round(quantile_cont(sigma2, 0.5), 6) AS median, round(max(sigma2), 6) AS most FROM p LEFT JOIN r USING (edge_id) GROUP BY ALL")
def job_summary(spark, sf_dir):
    plan = X.read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("edge_id"))
    done = X.read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("edge_id"), F.col("o_orderstatus").alias("status"), (F.col("o_totalprice") / 1000).alias("sigma2"))
    out = K.job_summary(plan, done)
    return out.select("status", "jobs", *[r6(c).alias(c) for c in ("mean", "median", "most")])


@query("refine_lookup", "SELECT c_custkey AS candidate_id, max(o_orderkey) AS job, max(o_orderkey) IS NOT NULL AS found FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL")
def refine_lookup(spark, sf_dir):
    jobs = X.read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("candidate_id")).agg(F.max("o_orderkey").alias("job"))
    return X.read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("candidate_id")).join(jobs, "candidate_id", "left").withColumn("found", F.col("job").isNotNull())


@query(
    "inventory_changes",
    """WITH p AS (SELECT p_partkey, lower(p_name) || '-' || p_partkey AS name, p_brand AS v FROM part), a AS (SELECT name, v FROM p WHERE p_partkey % 3 <> 0), b AS (SELECT name, CASE WHEN p_partkey % 5 = 0 THEN 'x' ELSE v END AS v FROM p WHERE p_partkey % 4 <> 0)
    SELECT name, a.v AS before, b.v AS after, CASE WHEN a.v IS NULL THEN 'added' WHEN b.v IS NULL THEN 'removed' WHEN a.v = b.v THEN 'same' ELSE 'changed' END AS change FROM a FULL JOIN b USING (name)""",
)
def inventory_changes(spark, sf_dir):
    p = X.read(spark, sf_dir, "part").select("p_partkey", F.concat_ws("_", "p_name", "p_partkey").alias("name"), F.col("p_brand").alias("v"))
    after = p.where("p_partkey % 4 <> 0").withColumn("v", F.when(F.col("p_partkey") % 5 == 0, "x").otherwise(F.col("v")))  # the two inventories that are compared
    return K.inventory_changes(p.where("p_partkey % 3 <> 0"), after, "name", "v")


_RANKS = """rk AS (SELECT slice_index, celltype, row_number() OVER (PARTITION BY slice_index ORDER BY count(*) DESC, celltype) AS rank FROM points GROUP BY slice_index, celltype), rp AS (SELECT dataset_id, p.slice_index, CAST(rank AS INTEGER) AS rank, cell_id, x, y FROM points p JOIN rk USING (slice_index, celltype))"""


def _ranked_points(spark, sf_dir):
    p = X.points(spark, sf_dir)
    k = p.groupBy("slice_index", "celltype").agg(F.count("*").alias("n"))
    k = k.withColumn("rank", F.row_number().over(Window.partitionBy("slice_index").orderBy(F.desc("n"), "celltype"))).drop("n")
    return p.join(k, ["slice_index", "celltype"]).select("dataset_id", "slice_index", "rank", "cell_id", "x", "y")


@query("component_boxes", f"WITH {_RANKS}, b AS (SELECT slice_index, rank, count(*) AS points, max(x) - min(x) AS width, max(y) - min(y) AS height FROM rp GROUP BY ALL) SELECT CAST(slice_index AS INTEGER) AS slice_index, rank, points, round(width, 6) AS width, round(width * height, 6) AS area, round(sqrt(width ** 2 + height ** 2), 6) AS diag, round(width / greatest(height, 1e-6), 6) AS aspect FROM b WHERE points >= 5", "points")
def component_boxes(spark, sf_dir):
    s = _ranked_points(spark, sf_dir).groupBy("slice_index", "rank").agg(F.count("*").alias("points"), F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    return K.component_boxes(s, 5).select("slice_index", "rank", "points", *[r6(c).alias(c) for c in ("width", "area", "diag", "aspect")])


@query(
    "triad_preview",
    f"""WITH {_RANKS}, c AS (SELECT slice_index, rank, avg(x) AS cx, avg(y) AS cy FROM rp GROUP BY ALL),
    s AS (SELECT m.slice_index, m.rank, (a.cx + b.cx) / 2 - m.cx AS dx, (a.cy + b.cy) / 2 - m.cy AS dy FROM c m JOIN c a ON a.slice_index = m.slice_index - 1 AND a.rank = m.rank JOIN c b ON b.slice_index = m.slice_index + 1 AND b.rank = m.rank WHERE m.slice_index % 4 = 1 AND m.rank = 2)
    SELECT dataset_id, CAST(slice_index AS INTEGER) AS slice_index, rank, cell_id, round(x + coalesce(dx, 0), 6) AS x, round(y + coalesce(dy, 0), 6) AS y, dx IS NOT NULL AS moved FROM rp LEFT JOIN s USING (slice_index, rank)""",
    "points",
)
def triad_preview(spark, sf_dir):
    p = _ranked_points(spark, sf_dir)
    scan = p.select("dataset_id", F.col("slice_index").alias("slice_m")).distinct().where("slice_m % 4 = 1")  # a made-up scan: these middles are flagged
    scan = scan.select("dataset_id", (F.col("slice_m") - 1).alias("slice_a"), "slice_m", (F.col("slice_m") + 1).alias("slice_b"), F.lit(2).alias("rank"), F.lit("flagged").alias("status"))
    out = K.triad_preview(p, scan)
    return out.select("dataset_id", "slice_index", "rank", "cell_id", r6("x").alias("x"), r6("y").alias("y"), "moved")


@query("slice_offsets", "WITH s AS (SELECT slice_index, count(*) AS n, min(x) AS x_least, max(x) AS x_most, min(y) AS y_least, max(y) AS y_most FROM points GROUP BY ALL) SELECT CAST(slice_index AS INTEGER) AS slice_index, n, x_least, x_most, y_least, y_most, CAST(coalesce(sum(n) OVER (ORDER BY slice_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first FROM s", "points")
def slice_offsets(spark, sf_dir):
    return K.slice_offsets(X.points(spark, sf_dir))


@query("slice_order_table", "WITH s AS (SELECT DISTINCT dataset_id, slice_index FROM cells) SELECT dataset_id, slice_index, CAST(row_number() OVER w AS INTEGER) AS place, slice_index - min(slice_index) OVER (PARTITION BY dataset_id) AS relative_z, (row_number() OVER w - 1) * 12.5::DOUBLE AS z_display FROM s WINDOW w AS (PARTITION BY dataset_id ORDER BY slice_index)", "cells")
def slice_order_table(spark, sf_dir):
    return K.slice_order_table(X.cells(spark, sf_dir), 12.5)


_MOTION = "mo AS (SELECT DISTINCT slice_index, slice_index * 0.1::DOUBLE AS theta, slice_index::DOUBLE AS tx, 2.0::DOUBLE AS ty FROM cells)"


def _motions(spark, sf_dir):
    return X.cells(spark, sf_dir).select("slice_index").distinct().select("slice_index", (F.col("slice_index") * 0.1).alias("theta"), F.col("slice_index").cast("double").alias("tx"), F.lit(2.0).alias("ty"))


@query("roi_corners", f"WITH {_MOTION}, c AS (SELECT * FROM (VALUES (0, -1.0::DOUBLE, 0.0::DOUBLE), (1, 3.0, 0.0), (2, 3.0, 5.0), (3, -1.0, 5.0)) v(corner, u, v)) SELECT slice_index, corner, round(cos(theta) * (u - tx) + sin(theta) * (v - ty), 6) AS x, round(cos(theta) * (v - ty) - sin(theta) * (u - tx), 6) AS y FROM mo, c", "cells")
def roi_corners(spark, sf_dir):
    return K.roi_corners(_motions(spark, sf_dir), -1.0, 0.0, 3.0, 5.0).select("slice_index", "corner", r6("x").alias("x"), r6("y").alias("y"))


@query("roi_export", f"WITH {_MOTION}, d AS (SELECT slice_index, cell_id, cos(theta) * x - sin(theta) * y + tx AS u, sin(theta) * x + cos(theta) * y + ty AS v FROM cells JOIN mo USING (slice_index)) SELECT slice_index, cell_id, round(u, 6) AS x, round(v, 6) AS y FROM d WHERE u BETWEEN -1 AND 3 AND v BETWEEN 1.5 AND 2.5", "cells")
def roi_export(spark, sf_dir):
    moved = K.display_motion(X.cells(spark, sf_dir), _motions(spark, sf_dir), ["slice_index"])
    return moved.where("x between -1 and 3 and y between 1.5 and 2.5").select("slice_index", "cell_id", r6("x").alias("x"), r6("y").alias("y"))


@query("aligned_rows", "SELECT cell_id, CAST(slice_index AS VARCHAR) AS slice_id, celltype AS anno, printf('%.10f', x) AS aligned_x, printf('%.10f', y) AS aligned_y FROM points WHERE slice_index = 3", "points")
def aligned_rows(spark, sf_dir):
    p = X.points(spark, sf_dir).where("slice_index = 3")
    return p.select("cell_id", F.col("slice_index").cast("string").alias("slice_id"), F.col("celltype").alias("anno"), *[F.format_string("%.10f", c).alias(f"aligned_{c}") for c in "xy"])


@query("capped_slice_ids", "SELECT slice_index || ':' || cell_id AS id FROM (SELECT *, row_number() OVER (PARTITION BY slice_index ORDER BY substr(sha1('3|' || cell_id), 1, 16), cell_id) AS r FROM points) WHERE r <= 40", "points")
def capped_slice_ids(spark, sf_dir):
    r = F.row_number().over(Window.partitionBy("slice_index").orderBy(hash_rank(3, F.col("cell_id")), "cell_id"))
    return X.points(spark, sf_dir).withColumn("r", r).where("r <= 40").select(F.concat_ws(":", "slice_index", "cell_id").alias("id"))  # the cap is the operator


@query(
    "selected_lines",
    "WITH g AS (SELECT gene, row_number() OVER (ORDER BY gene) - 1 AS minor FROM (SELECT DISTINCT gene FROM expression)) SELECT cell_id AS major, minor, value::DOUBLE AS value FROM expression JOIN g USING (gene) WHERE cell_id % 10 = 3 OR cell_id BETWEEN 40 AND 60",
    "expression",
)
def selected_lines(spark, sf_dir):
    """The counts as a compressed matrix, of which some cells' lines are read back."""
    import uuid

    from slabworks.session import held, run_dir
    from slabworks.sources.compressed import read_compressed, write_compressed

    e = held(X.expression(spark, sf_dir))
    genes = sorted(r.gene for r in e.select("gene").distinct().collect())  # the kinds of events
    minor = F.element_at(F.create_map(*[F.lit(v) for i, g in enumerate(genes) for v in (g, i)]), F.col("gene"))
    lines = e.agg(F.max("cell_id").alias("n")).first().n + 1
    path = f"{run_dir(spark)}/matrix-{uuid.uuid4().hex}"
    write_compressed(e.select(F.col("cell_id").alias("major"), minor.alias("minor"), "value"), path, lines, 6)
    wanted = [i for i in range(lines) if i % 10 == 3 or 40 <= i <= 60]
    return read_compressed(spark, path, wanted)
