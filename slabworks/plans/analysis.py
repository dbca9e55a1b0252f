"""Queries of densities, volumes, simulations and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from slabworks.functions.columns import lit
from slabworks.operators import density as D
from slabworks.operators import simulation as M
from slabworks.operators import statistics as T
from slabworks.operators import volume as V
from slabworks.plans import quality
from slabworks.plans.registry import query, r6
from slabworks.sources import fixtures as X


@query("false_discovery_rates", "WITH t AS (SELECT p_partkey AS gene, p_brand AS family, (p_retailprice - 900) / 1500 AS p FROM part), r AS (SELECT *, p * count(*) OVER (PARTITION BY family) / row_number() OVER (PARTITION BY family ORDER BY p, gene) AS q FROM t) SELECT gene, round(least(1, min(q) OVER (PARTITION BY family ORDER BY p DESC, gene DESC ROWS UNBOUNDED PRECEDING)), 9) AS q FROM r")
def false_discovery_rates(spark, sf_dir):
    t = X.read(spark, sf_dir, "part").select(F.col("p_partkey").alias("gene"), F.col("p_brand").alias("family"), ((F.col("p_retailprice") - 900) / 1500).alias("p"))
    return T.benjamini_hochberg(t, ["family"]).select("gene", F.round("q", 9).alias("q"))


@query("rank_correlations", "WITH r AS (SELECT celltype, rank() OVER (PARTITION BY celltype ORDER BY x) + (count(*) OVER (PARTITION BY celltype, x) - 1) / 2.0::DOUBLE AS rx, rank() OVER (PARTITION BY celltype ORDER BY y) + (count(*) OVER (PARTITION BY celltype, y) - 1) / 2.0::DOUBLE AS ry FROM points) SELECT celltype, count(*) AS n, round(corr(rx, ry), 6) AS rho FROM r GROUP BY ALL", "points")
def rank_correlations(spark, sf_dir):
    return T.spearman(X.points(spark, sf_dir), ["celltype"], "x", "y").select("celltype", "n", r6("rho").alias("rho"))


@query(
    "field_report",
    """WITH v AS (SELECT vec_id, list_transform(embedding[1:3], lambda e: e::DOUBLE) AS a, list_transform(embedding[2:4], lambda e: e::DOUBLE) AS b FROM embeddings),
    d AS (SELECT a[1] * b[1] + a[2] * b[2] + a[3] * b[3] AS d, sqrt(a[1] ** 2 + a[2] ** 2 + a[3] ** 2) AS la, sqrt(b[1] ** 2 + b[2] ** 2 + b[3] ** 2) AS lb, (a[1] - b[1]) ** 2 + (a[2] - b[2]) ** 2 + (a[3] - b[3]) ** 2 AS e FROM v)
    SELECT round(median(d / greatest(la * lb, 1e-12)), 6) AS median_cosine, round(sqrt(sum(e) / (3 * count(*))), 6) AS rmse, round(quantile_cont(la, 0.95), 6) AS raw_95, round(max(lb), 6) AS fitted_most FROM d""",
)
def field_report(spark, sf_dir):
    e = X.read(spark, sf_dir, "embeddings").select(F.transform("embedding", lambda v: v.cast("double")).alias("v"))
    out = T.field_report(e.select(F.slice("v", 1, 3).alias("a"), F.slice("v", 2, 3).alias("b")), "a", "b")
    return out.select(r6("median_cosine").alias("median_cosine"), r6("rmse").alias("rmse"), r6(F.get("raw_lengths", F.lit(2))).alias("raw_95"), r6(F.get("fitted_lengths", F.lit(3))).alias("fitted_most"))


_CALLS = "CASE WHEN {0} >= 0.7 THEN 'exclude' WHEN {0} >= 0.4 THEN 'review' ELSE 'keep' END"
_PAIRED = f"""b AS (SELECT slice_index, count(*) FILTER (celltype = 'error') / count(*)::DOUBLE * 1.9 AS s0, count(*) FILTER (celltype = 'view') / count(*)::DOUBLE * 2.2 AS s1 FROM points GROUP BY ALL),
pc AS (SELECT *, slice_index % 3 = 0 AS inj, {_CALLS.format("s0")} AS c0, {_CALLS.format("s1")} AS c1 FROM b),
pr AS (SELECT *, c0 <> 'keep' AS sus, c1 <> 'keep' AS det, CASE c1 WHEN 'exclude' THEN 2 WHEN 'review' THEN 1 ELSE 0 END > CASE c0 WHEN 'exclude' THEN 2 WHEN 'review' THEN 1 ELSE 0 END AS wor FROM pc)"""


@query(
    "paired_summary",
    f"""WITH {_PAIRED} SELECT count(*) FILTER (inj) AS injected, count(*) FILTER (inj AND det) AS detected, round(coalesce(count(*) FILTER (inj AND det) / nullif(count(*) FILTER (inj), 0)::DOUBLE, 0), 6) AS detection_rate, count(*) FILTER (inj AND sus) AS suspicious_before, count(*) FILTER (inj AND NOT sus) AS clean_before,
    count(*) FILTER (inj AND NOT sus AND det) AS newly, round(count(*) FILTER (inj AND NOT sus AND det) / nullif(count(*) FILTER (inj AND NOT sus), 0)::DOUBLE, 6) AS new_rate, count(*) FILTER (inj AND s1 > s0) AS score_rose, round(median(s1 - s0) FILTER (inj), 6) AS median_gain, count(*) FILTER (inj AND wor) AS worsened,
    count(*) FILTER (NOT inj AND NOT sus AND det) AS others_newly, count(*) FILTER (sus) AS nonkeep_before, count(*) FILTER (det) AS nonkeep_after FROM pr""",
    "points",
)
def paired_summary(spark, sf_dir):
    share = lambda kind, k: F.count_if(F.col("celltype") == kind) / F.count("*") * k
    s = X.points(spark, sf_dir).groupBy("dataset_id", "slice_index").agg(share("error", 1.9).alias("s0"), share("view", 2.2).alias("s1"))
    call = lambda c: F.when(F.col(c) >= 0.7, "exclude").when(F.col(c) >= 0.4, "review").otherwise("keep")
    side = lambda c: s.select("dataset_id", "slice_index", F.col(c).alias("score"), call(c).alias("recommendation"))
    out = T.paired_summary(T.paired_calls(side("s0"), side("s1"), s.where("slice_index % 3 = 0")))
    return out.withColumns({c: r6(c) for c in ("detection_rate", "new_rate", "median_gain")})


@query(
    "evidence_groups",
    """WITH s AS (SELECT slice_index, count(*) FILTER (celltype = 'error') / count(*)::DOUBLE * 2.5 AS a, count(*) FILTER (celltype = 'view') / count(*)::DOUBLE AS b FROM points GROUP BY ALL), k AS (SELECT count(*) AS k FROM s),
    g AS (SELECT 'expression_capture' AS grp, a AS v, slice_index FROM s UNION ALL SELECT 'tissue_amount', b, slice_index FROM s UNION ALL SELECT unnest(['fragmentation', 'expression_continuity', 'regional_low_capture', 'damage']), 0, slice_index FROM s)
    SELECT grp AS "group", count(*) FILTER (v >= 0.45) AS slices, round(count(*) FILTER (v >= 0.45) * 100.0::DOUBLE / any_value(k), 6) AS percent, coalesce(string_agg(lpad(slice_index::VARCHAR, 4, '0'), ',' ORDER BY slice_index) FILTER (v >= 0.45), '') AS names FROM g, k GROUP BY grp""",
    "points",
)
def evidence_groups(spark, sf_dir):
    share = lambda kind, k: F.count_if(F.col("celltype") == kind) / F.count("*") * k
    s = X.points(spark, sf_dir).groupBy("slice_index").agg(share("error", 2.5).alias("zero_fraction_anomaly"), share("view", 1).alias("cell_density_anomaly"))
    return T.evidence_groups(s).withColumn("percent", r6("percent"))


@query("quartile_texts", "WITH q AS (SELECT celltype, 'x' AS metric, quantile_cont(x, [0.25, 0.5, 0.75]) AS q FROM points GROUP BY ALL UNION ALL SELECT celltype, 'y', quantile_cont(y, [0.25, 0.5, 0.75]) FROM points GROUP BY ALL) SELECT celltype, metric, printf('%.1f [%.1f, %.1f]', round(q[2], 1), round(q[1], 1), round(q[3], 1)) AS text FROM q", "points")
def quartile_texts(spark, sf_dir):
    return T.quartile_text(X.points(spark, sf_dir), ["celltype"], ["x", "y"])


@query(
    "block_coverage",
    "WITH b AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1, min(z) AS z0, max(z) AS z1 FROM cells) SELECT CAST((least(floor((x - x0) / (x1 - x0) * 6), 5) * 6 + least(floor((y - y0) / (y1 - y0) * 6), 5)) * 3 + least(floor((z - z0) / (z1 - z0) * 3), 2) AS INTEGER) AS block, count(*) AS cells, round(avg(CASE WHEN x > 0 THEN 1.0::DOUBLE ELSE 0 END), 6) AS coverage, count(*) >= 30 AS supported FROM cells, b GROUP BY ALL",
    "cells",
)
def block_coverage(spark, sf_dir):
    return T.block_coverage(X.cells(spark, sf_dir), F.col("x") > 0).withColumn("coverage", r6("coverage"))


@query("point_densities", "SELECT a.cell_id, round(sum(exp(-0.5 * ((a.x - b.x) ** 2 + (a.y - b.y) ** 2) / 0.01)) / (2 * pi() * 0.01), 5) AS density FROM cells a JOIN cells b USING (dataset_id, slice_index) GROUP BY ALL", "cells")
def point_densities(spark, sf_dir):
    return D.point_densities(X.cells(spark, sf_dir), 0.1).select("cell_id", F.round("density", 5).alias("density"))


@query("density_deficits")
def density_deficits(spark, sf_dir):
    return D.density_deficits(X.cells(spark, sf_dir), 0.04)


def _kernel(sigma: float, reach: int) -> str:
    return f"k AS (SELECT o, exp(-0.5 * (o / {sigma}) ** 2) / (SELECT sum(exp(-0.5 * (u / {sigma}) ** 2)) FROM range(-{reach}, {reach + 1}) r(u)) AS w FROM range(-{reach}, {reach + 1}) t(o))"


@query(
    "smoothed_voxels",
    f"""WITH {_kernel(0.8, 3)}, v AS (SELECT DISTINCT round_even(x / 0.08, 0)::BIGINT AS ix, round_even(y / 0.08, 0)::BIGINT AS iy, round_even(z / 0.08, 0)::BIGINT AS iz FROM cells),
    a AS (SELECT ix + o AS ix, iy, iz, sum(w) AS d FROM v, k GROUP BY ALL), b AS (SELECT ix, iy + o AS iy, iz, sum(d * w) AS d FROM a, k GROUP BY ALL), c AS (SELECT ix, iy, iz + o AS iz, sum(d * w) AS d FROM b, k GROUP BY ALL)
    SELECT ix, iy, iz, round(d / (SELECT max(d) FROM c), 6) AS density FROM c WHERE round(d / (SELECT max(d) FROM c), 6) >= 0.1""",
    "cells",
)
def smoothed_voxels(spark, sf_dir):
    out = V.smoothed(X.cells(spark, sf_dir), 0.08, 0.8, ["dataset_id"]).select("ix", "iy", "iz", r6("density").alias("density"))
    return out.where("density >= 0.1")


@query("density_levels")
def density_levels(spark, sf_dir):
    return V.levels(X.cells(spark, sf_dir), 0.08, 1.2, ["celltype"])


_UNIFORM = "('0x' || substr(sha1(concat_ws('|', '13', {})), 1, 8))::UBIGINT::DOUBLE / 4294967296"
_REGION = """sp AS (SELECT *, x - median(x) OVER w AS dx, y - median(y) OVER w AS dy FROM points WINDOW w AS (PARTITION BY slice_index)),
ss AS (SELECT *, sqrt((dx / greatest(quantile_cont(abs(dx), 0.75) OVER w, 2.220446049250313e-16)) ** 2 + (dy / greatest(quantile_cont(abs(dy), 0.75) OVER w, 2.220446049250313e-16)) ** 2) AS rad FROM sp WINDOW w AS (PARTITION BY slice_index)),
sr AS (SELECT *, rad <= quantile_cont(rad, 0.35) OVER (PARTITION BY slice_index) AS region, row_number() OVER (PARTITION BY slice_index ORDER BY substr(sha1('13|' || cell_id), 1, 16), cell_id) AS place, count(*) OVER (PARTITION BY slice_index) AS n FROM ss),
sk AS (SELECT * FROM sr WHERE NOT (slice_index = 23 AND region) AND NOT (slice_index = 17 AND place > greatest(1, round_even(n * 0.35, 0))))"""
PLAN = [("ev", 6, "depth", 0.2, None), ("ev", 12, "regional_depth", 0.1, 0.35), ("ev", 17, "cell_dropout", 0.35, None), ("ev", 23, "spatial_hole", None, 0.35)]


@query(
    "simulated_slices",
    f"""WITH {_REGION}, e AS (SELECT cell_id, slice_index, region, CAST(floor(abs(x)) AS BIGINT) % 40 AS value FROM sk),
    u AS (SELECT cell_id, slice_index, CASE slice_index WHEN 6 THEN 0.2 ELSE 0.1 END AS rate, unnest(generate_series(1, value)) AS i FROM e WHERE slice_index = 6 OR (slice_index = 12 AND region)),
    t AS (SELECT cell_id, count(*) FILTER ({_UNIFORM.format("cell_id, 'g', i")} < rate) AS k FROM u GROUP BY ALL),
    r AS (SELECT slice_index, CASE WHEN slice_index = 6 OR (slice_index = 12 AND region) THEN coalesce(k, 0) ELSE value END AS value FROM e LEFT JOIN t USING (cell_id))
    SELECT CAST(slice_index AS INTEGER) AS slice_index, count(*) AS cells, CAST(sum(value) AS BIGINT) AS counts, count(*) FILTER (value > 0) AS expressed FROM r GROUP BY ALL""",
    "points",
)
def simulated_slices(spark, sf_dir):
    p = X.points(spark, sf_dir)
    counts = p.select("cell_id", F.lit("g").alias("gene"), (F.floor(F.abs("x")) % 40).alias("value"))
    plan = spark.createDataFrame(PLAN, "dataset_id string, slice_index int, kind string, rate double, quantile double")
    cells, expression = M.simulated(p, counts.where("value > 0"), plan)
    both = cells.select("slice_index", "cell_id").join(expression, "cell_id", "left")
    return both.groupBy("slice_index").agg(F.count("*").alias("cells"), F.sum(F.coalesce("value", F.lit(0))).alias("counts"), F.count("value").alias("expressed"))


@query("defect_plan", "WITH s AS (SELECT DISTINCT slice_index FROM points), p AS (SELECT slice_index, row_number() OVER (ORDER BY slice_index) - 1 AS p, count(*) OVER () AS n FROM s), k AS (SELECT * FROM (VALUES ('depth', 0.22::DOUBLE), ('regional_depth', 0.42), ('cell_dropout', 0.62), ('spatial_hole', 0.80)) v(kind, share)) SELECT CAST(slice_index AS INTEGER) AS slice_index, kind FROM p, k WHERE n >= 9 AND p = floor(share * (n - 1))", "points")
def defect_plan(spark, sf_dir):
    return M.defect_plan(X.points(spark, sf_dir)).select("slice_index", "kind")


@query("window_choice")
def window_choice(spark, sf_dir):
    return quality.choose_window(quality.held(quality.series_metrics(spark, sf_dir)))


@query("policy_summary")
def policy_summary(spark, sf_dir):
    return quality.call_summary(quality.policy(quality.series_metrics(spark, sf_dir), quality.series_continuity(spark, sf_dir)))


@query("support_windows", "WITH s AS (SELECT o_custkey AS dataset_id, count(*) AS n FROM orders GROUP BY ALL) SELECT dataset_id, CAST(greatest(5, 3, least(9, CASE WHEN n % 2 = 1 THEN n ELSE n - 1 END)) AS INTEGER) AS support FROM s")
def support_windows(spark, sf_dir):
    n = X.read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("dataset_id")).agg(F.count("*").alias("n"))
    return n.select("dataset_id", quality.support_window(F.lit(5), F.col("n")).alias("support"))


@query(
    "loss_evidence",
    """WITH s AS (SELECT slice_index, count(*)::DOUBLE AS n, median(total_counts) AS c, count(DISTINCT user_id)::DOUBLE AS g FROM points GROUP BY ALL), h AS (SELECT slice_index, CASE WHEN slice_index = 11 THEN n * 0.2 ELSE n END AS n, CASE WHEN slice_index = 11 THEN n * 0.02 ELSE n / 10 END AS d, CASE WHEN slice_index = 19 THEN c * 0.1 ELSE c END AS c, CASE WHEN slice_index = 19 THEN g * 0.5 ELSE g END AS g FROM s),
    w AS (SELECT slice_index, n, d, c, g, median(n) OVER l AS nl, median(n) OVER r AS nr, median(d) OVER l AS dl, median(d) OVER r AS dr, median(c) OVER l AS cl, median(c) OVER r AS cr, median(g) OVER l AS gl, median(g) OVER r AS gr FROM h WINDOW l AS (ORDER BY slice_index ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING), r AS (ORDER BY slice_index ROWS BETWEEN 1 FOLLOWING AND 2 FOLLOWING))
    SELECT CAST(slice_index AS INTEGER) AS slice_index, coalesce(nl IS NOT NULL AND nr IS NOT NULL AND least(nl, nr) >= 20 AND 1 - n / least(nl, nr) >= 0.5 AND 1 - d / least(dl, dr) >= 0.35, false) AS geometry_loss_candidate, coalesce(cl IS NOT NULL AND cr IS NOT NULL AND 1 - c / least(cl, cr) >= 0.5 AND 1 - g / least(gl, gr) >= 0.3, false) AS capture_loss_candidate FROM w""",
    "points",
)
def loss_evidence(spark, sf_dir):
    s = X.points(spark, sf_dir).groupBy("dataset_id", "slice_index").agg(F.count("*").cast("double").alias("n"), F.percentile("total_counts", lit(0.5)).alias("c"), F.countDistinct("user_id").cast("double").alias("g"))
    hurt = lambda i, k, c: F.when(F.col("slice_index") == i, F.col(c) * k).otherwise(F.col(c))
    rows = s.select("dataset_id", "slice_index", hurt(11, 0.2, "n").alias("n_locations"), F.when(F.col("slice_index") == 11, F.col("n") * 0.02).otherwise(F.col("n") / 10).alias("cell_density"), hurt(19, 0.1, "c").alias("median_total_counts"), hurt(19, 0.5, "g").alias("median_n_genes"))
    return quality.loss_evidence(rows, (5,)).select("slice_index", "geometry_loss_candidate", "capture_loss_candidate")
