"""Queries of joined tables, reviews and payloads."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from slabworks.functions.columns import lit
from slabworks.operators import assembly as A
from slabworks.plans import quality
from slabworks.plans.registry import query, r6
from slabworks.sources import fixtures as X


@query("component_labels", "SELECT cell_id, CAST(slice_index AS INTEGER) AS slice_index, CASE WHEN celltype = 'error' THEN 0 ELSE CAST(slice_index AS INTEGER) % 3 + 1 END AS rank FROM points", "points")
def component_labels(spark, sf_dir):
    p = X.points(spark, sf_dir)
    found = p.where("celltype <> 'error'").select("cell_id", "slice_index", (F.col("slice_index") % 3 + 1).cast("int").alias("rank"))
    return A.with_components(p, found).select("cell_id", "slice_index", "rank")


@query("pair_costs", "SELECT a.cell_id AS a, b.cell_id AS b, round(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2), 6) AS cost FROM cells a, cells b WHERE a.slice_index = 1 AND b.slice_index = 2", "cells")
def pair_costs(spark, sf_dir):
    c = X.cells(spark, sf_dir)
    return A.pair_costs(c.where("slice_index = 1"), c.where("slice_index = 2")).withColumn("cost", r6("cost"))


@query("payload_agrees", "SELECT count(*) FILTER (cell_id % 11 = 0) AS unknown, count(*) FILTER (cell_id % 11 <> 0 AND cell_id % 13 = 0) AS elsewhere FROM points", "points")
def payload_agrees(spark, sf_dir):
    p = X.points(spark, sf_dir)
    payload = p.withColumn("x", F.when(F.col("cell_id") % 13 == 0, F.col("x") + 1).otherwise(F.col("x")))
    return A.payload_agrees(payload, p.where("cell_id % 11 <> 0"))  # the reference that is compared lacks some


@query("slice_window", "WITH s AS (SELECT DISTINCT dataset_id, slice_index FROM points) SELECT dataset_id, CAST(slice_index AS INTEGER) AS slice_index, CAST(row_number() OVER (ORDER BY slice_index) AS INTEGER) AS place FROM s WHERE slice_index BETWEEN 5 AND 14", "points")
def slice_window(spark, sf_dir):
    s = X.points(spark, sf_dir).select("dataset_id", "slice_index").distinct().where(F.col("slice_index").between(5, 14))
    return s.withColumn("place", F.row_number().over(Window.partitionBy("dataset_id").orderBy("slice_index")))


@query(
    "edge_transforms",
    "SELECT 'e' || o_orderkey AS edge_id, o_custkey::VARCHAR AS fixed, (o_custkey + 1)::VARCHAR AS moving, 1.0::DOUBLE AS m00, 0.0::DOUBLE AS m01, o_custkey::DOUBLE AS m02, 0.0::DOUBLE AS m10, 1.0::DOUBLE AS m11, -2.5::DOUBLE AS m12, CASE WHEN o_orderkey % 2 = 0 THEN 0.25::DOUBLE END AS sigma2 FROM orders",
)
def edge_transforms(spark, sf_dir):
    o = X.read(spark, sf_dir, "orders")
    matrix = F.concat(F.lit('[[1,0,'), "o_custkey", F.lit('],[0,1,-2.5],[0,0,1]]'))
    sigma = F.when(F.col("o_orderkey") % 2 == 0, ',"sigma2":0.25').otherwise("")
    text = F.concat(F.lit('{"edge_id":"e'), "o_orderkey", F.lit('","fixed_slice":"'), "o_custkey", F.lit('","moving_slice":"'), F.col("o_custkey") + 1, F.lit('","matrix":'), matrix, sigma, F.lit("}"))
    return A.edge_transforms(o.select(text.alias("text")))


@query("residual_summary", "WITH d AS (SELECT a.slice_index, sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) AS d FROM cells a JOIN cells b ON b.cell_id = a.cell_id + 50 AND b.slice_index = a.slice_index + 1) SELECT slice_index, count(*) AS n, round(median(d), 6) AS median, round(quantile_cont(d, 0.95), 6) AS p95, round(max(d), 6) AS most FROM d GROUP BY ALL", "cells")
def residual_summary(spark, sf_dir):
    c = X.cells(spark, sf_dir)
    b = c.select((F.col("slice_index") - 1).alias("slice_index"), (F.col("cell_id") - 50).alias("cell_id"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    pairs = c.select("slice_index", "cell_id", F.col("x").alias("x1"), F.col("y").alias("y1")).join(b, ["slice_index", "cell_id"])
    out = A.residual_summary(pairs, ["slice_index"])
    return out.select("slice_index", "n", *[r6(m).alias(m) for m in ("median", "p95", "most")])


@query("mesh_acceptance", "SELECT s_suppkey, CASE WHEN s_suppkey % 10 = 0 THEN 'not_watertight' WHEN s_acctbal / 10000 < 0.3 THEN 'low_coverage' WHEN s_nationkey / 25.0::DOUBLE < 0.2 THEN 'low_regional_coverage' END AS reason, s_suppkey % 10 <> 0 AND s_acctbal / 10000 >= 0.3 AND s_nationkey / 25.0::DOUBLE >= 0.2 AS accepted FROM supplier")
def mesh_acceptance(spark, sf_dir):
    s = X.read(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_suppkey") % 10 != 0).alias("watertight"), (F.col("s_acctbal") / 10000).alias("coverage"), (F.col("s_nationkey") / 25.0).alias("region_coverage"))
    return A.acceptance(s, 0.3, 0.2).select("s_suppkey", "reason", "accepted")


@query("label_summary", "SELECT celltype, n FROM (SELECT celltype, count(*) AS n FROM points GROUP BY ALL) ORDER BY n DESC, celltype LIMIT 100", "points")
def label_summary(spark, sf_dir):
    return X.points(spark, sf_dir).groupBy("celltype").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "celltype").limit(100)


@query("expressed_in_both", "WITH h AS (SELECT gene, cell_id % 2 AS stage, sum(value) AS t FROM expression GROUP BY ALL) SELECT gene FROM h WHERE t > 0 GROUP BY gene HAVING count(*) = 2", "expression")
def expressed_in_both(spark, sf_dir):
    h = X.expression(spark, sf_dir).groupBy("gene", (F.col("cell_id") % 2).alias("stage")).agg(F.sum("value").alias("t")).where("t > 0")
    return h.groupBy("gene").agg(F.count("*").alias("n")).where("n = 2").select("gene")


@query("decoded_labels", "SELECT cell_id, coalesce(CASE WHEN celltype <> 'error' THEN celltype END, 'NA') AS label FROM points", "points")
def decoded_labels(spark, sf_dir):
    return X.points(spark, sf_dir).select("cell_id", F.coalesce(F.when(F.col("celltype") != "error", F.col("celltype")), F.lit("NA")).alias("label"))


@query("plain_values", "SELECT cell_id, CASE WHEN x > 30 THEN round(ln(x), 6) END AS v FROM points", "points")
def plain_values(spark, sf_dir):
    v = F.when(F.col("x") > 60, F.log("x")).when(F.col("x") > 30, F.log("x")).when(F.col("x") > 20, lit(float("nan"))).otherwise(lit(float("inf")))
    return X.points(spark, sf_dir).select("cell_id", F.round(A.plain_value(v), 6).alias("v"))


def _defects(spark, sf_dir):
    return quality.with_defects(quality.held(quality.series_metrics(spark, sf_dir)), quality.series_continuity(spark, sf_dir))


@query("defect_policy")
def defect_policy(spark, sf_dir):
    """The policy over series with made-up defects of several kinds and strengths: the slices that are hurt or not simply kept."""
    calls = quality.policy(*_defects(spark, sf_dir))
    return calls.where("slice_index in (10, 20) or call <> 'keep' or triage <> 'clear'")


@query("defect_policy_summary")
def defect_policy_summary(spark, sf_dir):
    return quality.call_summary(quality.policy(*_defects(spark, sf_dir)))


@query("review_audit")
def review_audit(spark, sf_dir):
    """Slices of the review band, in series with made-up defects, with what their tier asks for and the reasons why it isn't met."""
    from slabworks.operators.review import tier_verdict

    slices, continuity = _defects(spark, sf_dir)
    scored = quality.held(quality.score_windows(slices, continuity=continuity))
    band = scored.where((F.col("window") == quality.PRIMARY) & (F.col("quality_anomaly_score") > quality.KEEP_BELOW)).select(*quality.KEYS)
    return tier_verdict(quality.window_evidence(scored).join(band, quality.KEYS, "left_semi"), quality.KEEP_BELOW, 2, 0.65).select(*quality.KEYS, "median_score", "stability", "supported", "reasons")


@query("quality_table", "WITH s AS (SELECT slice_index, count(*)::DOUBLE AS n, median(total_counts) AS c FROM points GROUP BY ALL), l AS (SELECT 'n_locations' AS metric, n AS v FROM s UNION ALL SELECT 'median_total_counts', c FROM s) SELECT metric, count(v) AS slices, round(median(v), 6) AS median, round(quantile_cont(v, 0.25), 6) AS q25, round(quantile_cont(v, 0.75), 6) AS q75, round(min(v), 6) AS least, round(max(v), 6) AS most FROM l GROUP BY ALL", "points")
def quality_table(spark, sf_dir):
    s = X.points(spark, sf_dir).groupBy("slice_index").agg(F.count("*").cast("double").alias("n_locations"), F.percentile("total_counts", lit(0.5)).alias("median_total_counts"))
    long = s.unpivot("slice_index", ["n_locations", "median_total_counts"], "metric", "v")
    q = F.percentile("v", F.array(lit(0.25), lit(0.5), lit(0.75)))
    return long.groupBy("metric").agg(F.count("v").alias("slices"), r6(F.get(q, F.lit(1))).alias("median"), r6(F.get(q, F.lit(0))).alias("q25"), r6(F.get(q, F.lit(2))).alias("q75"), r6(F.min("v")).alias("least"), r6(F.max("v")).alias("most"))


@query("series_repairs")
def series_repairs(spark, sf_dir):
    return A.repaired_in_passes(X.cells(spark, sf_dir), passes=1, ratio=1.0, k=0.0)[1]


@query("group_alignment")
def group_alignment(spark, sf_dir):
    from slabworks.operators.continuity import adjacent_pairs

    return A.align_groups(adjacent_pairs(X.cells(spark, sf_dir)), ["dataset_id", "boundary"])


@query("before_and_after")
def before_and_after(spark, sf_dir):
    c = X.cells(spark, sf_dir)
    return A.before_and_after(c, A.repaired_in_passes(c, passes=1, ratio=1.0, k=0.0)[0])
