"""Queries over the domain tables, each with the SQL that says the same.

``QUERIES`` maps a name to a function of (session, folder); ``SQL`` maps the same name to a DuckDB statement.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slabworks.functions.columns import MAD_SCALE, hash_rank, lit, natural_key, over, slice_number
from slabworks.operators import geometry as G
from slabworks.operators import relational as R
from slabworks.operators import review as V
from slabworks.operators import windows as W
from slabworks.plans import quality
from slabworks.plans.registry import QUERIES, SQL, query, r6  # noqa: F401  the lists are read from here
from slabworks.sources import files as S
from slabworks.sources import fixtures as X

def slice_metrics(p: DataFrame) -> DataFrame:
    """n, median and mean counts, valid share and label entropy of each slice."""
    kinds = p.groupBy("dataset_id", "slice_index", "celltype").agg(F.count("*").alias("k"))
    share = F.col("k") / F.sum("k").over(Window.partitionBy("dataset_id", "slice_index"))
    mix = kinds.withColumn("p", share).groupBy("dataset_id", "slice_index").agg((-F.sum(F.col("p") * F.ln("p")) / F.ln(F.greatest(F.count("*"), F.lit(2)).cast("double"))).alias("entropy"))
    main = p.groupBy("dataset_id", "slice_index").agg(
        F.count("*").alias("n_locations"),
        F.percentile("total_counts", F.lit(0.5)).alias("median_total_counts"),
        F.avg("total_counts").alias("mean_total_counts"),
        F.avg((F.col("x").isNotNull() & F.col("y").isNotNull()).cast("double")).alias("coordinate_valid_fraction"),
    )
    return main.join(mix, ["dataset_id", "slice_index"])


METRICS_SQL = """m AS (
    SELECT dataset_id, slice_index, count(*) AS n_locations, quantile_cont(total_counts, 0.5) AS median_total_counts, avg(total_counts) AS mean_total_counts,
           avg(CASE WHEN x IS NOT NULL AND y IS NOT NULL THEN 1.0::DOUBLE ELSE 0 END) AS coordinate_valid_fraction FROM points GROUP BY ALL),
k AS (SELECT dataset_id, slice_index, celltype, count(*)::DOUBLE AS k FROM points GROUP BY ALL),
e AS (SELECT dataset_id, slice_index, -sum(p * ln(p)) / ln(greatest(count(*), 2)::DOUBLE) AS entropy
      FROM (SELECT *, k / sum(k) OVER (PARTITION BY dataset_id, slice_index) AS p FROM k) GROUP BY ALL)"""


@query(
    "slice_quality_overview",
    f"""WITH {METRICS_SQL},
    s AS (SELECT * FROM m JOIN e USING (dataset_id, slice_index)),
    w AS (SELECT *, median(CASE WHEN n_locations > 0 THEN n_locations END) OVER (PARTITION BY dataset_id ORDER BY slice_index ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING) AS l,
                    median(CASE WHEN n_locations > 0 THEN n_locations END) OVER (PARTITION BY dataset_id ORDER BY slice_index ROWS BETWEEN 1 FOLLOWING AND 2 FOLLOWING) AS r FROM s)
    SELECT dataset_id, CAST(slice_index AS INTEGER) AS slice_index, n_locations, round(median_total_counts, 6) AS median_total_counts, round(mean_total_counts, 6) AS mean_total_counts,
           coordinate_valid_fraction, round(entropy, 6) AS entropy,
           round(CASE WHEN l IS NOT NULL AND r IS NOT NULL THEN least(greatest(1 - n_locations / least(l, r), 0), 1) END, 6) AS point_loss FROM w""",
    "points",
)
def slice_quality_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = slice_metrics(X.points(spark, sf_dir))
    rows = m.withColumn("metric", F.lit("n_locations")).withColumn("value", F.col("n_locations").cast("double"))
    out = W.bilateral_loss(rows, 5)
    return out.select("dataset_id", "slice_index", "n_locations", r6("median_total_counts").alias("median_total_counts"), r6("mean_total_counts").alias("mean_total_counts"), "coordinate_valid_fraction", r6("entropy").alias("entropy"), r6("loss").alias("point_loss"))


# ------------------------------------------------------------------ aggregations


@query("cell_totals", "WITH c AS (SELECT DISTINCT user_id AS cell_id FROM events UNION SELECT o_custkey FROM orders) SELECT c.cell_id, CAST(coalesce(sum(value), 0) AS BIGINT) AS total, count(value) AS n_genes FROM c LEFT JOIN expression USING (cell_id) GROUP BY ALL", "expression")
def cell_totals(spark, sf_dir):
    ids = X.read(spark, sf_dir, "events").select(F.col("user_id").alias("cell_id")).union(X.read(spark, sf_dir, "orders").select("o_custkey")).distinct()
    per = X.expression(spark, sf_dir).groupBy("cell_id").agg(F.sum("value").alias("t"), F.count("*").alias("g"))
    return ids.join(per, "cell_id", "left").select("cell_id", F.coalesce("t", F.lit(0)).alias("total"), F.coalesce("g", F.lit(0)).alias("n_genes"))


@query("pseudobulk", "SELECT slice_index, gene, round(value, 6) AS value FROM slice_genes", "slice_genes")
def pseudobulk(spark, sf_dir):
    return X.slice_genes(spark, sf_dir).select("slice_index", "gene", r6("value").alias("value"))


@query(
    "slice_expression_metrics",
    """WITH per AS (SELECT slice_index, cell_id, sum(total_counts) AS total, count(DISTINCT celltype) AS genes FROM (SELECT slice_index, user_id AS cell_id, total_counts, celltype FROM points) GROUP BY ALL),
    nv AS (SELECT count(DISTINCT celltype) AS n_vars FROM points)
    SELECT CAST(slice_index AS INTEGER) AS slice_index, count(*) AS n, round(quantile_cont(total, 0.5), 6) AS median_total, round(avg(total), 6) AS mean_total, quantile_cont(genes, 0.5)::DOUBLE AS median_genes,
           round(1 - sum(genes)::DOUBLE / (count(*) * any_value(n_vars)), 6) AS zero_fraction, round(quantile_cont(genes / greatest(ln(1 + total), 2.220446049250313e-16), 0.5), 6) AS library_complexity
    FROM per, nv GROUP BY slice_index""",
    "points",
)
def slice_expression_metrics(spark, sf_dir):
    p = X.points(spark, sf_dir)
    n_vars = p.select("celltype").distinct().agg(F.count("*").alias("n_vars"))
    per = p.groupBy("slice_index", F.col("user_id").alias("cell_id")).agg(F.sum("total_counts").alias("total"), F.countDistinct("celltype").alias("genes"))
    out = per.crossJoin(F.broadcast(n_vars)).groupBy("slice_index").agg(
        F.count("*").alias("n"), r6(F.percentile("total", F.lit(0.5))).alias("median_total"), r6(F.avg("total")).alias("mean_total"), F.percentile("genes", F.lit(0.5)).alias("median_genes"),
        r6(1 - F.sum("genes") / (F.count("*") * F.first("n_vars"))).alias("zero_fraction"), r6(F.percentile(over(F.col("genes"), F.log1p("total")), F.lit(0.5))).alias("library_complexity"),
    )
    return out


@query(
    "shape_by_slice",
    """WITH m AS (SELECT slice_index, count(*) AS n, avg(x) AS cx, avg(y) AS cy, var_samp(x) AS vx, var_samp(y) AS vy, covar_samp(x, y) AS vxy FROM points GROUP BY ALL),
    r AS (SELECT slice_index, median(sqrt((x - cx) ** 2 + (y - cy) ** 2)) AS mr FROM points JOIN m USING (slice_index) GROUP BY ALL)
    SELECT CAST(slice_index AS INTEGER) AS slice_index, n, round(cx, 6) AS cx, round(cy, 6) AS cy, round(degrees(atan2(2 * vxy, vx - vy) / 2), 4) AS angle,
           round(sqrt(((vx + vy) / 2 + sqrt(((vx - vy) / 2) ** 2 + vxy ** 2)) / ((vx + vy) / 2 - sqrt(((vx - vy) / 2) ** 2 + vxy ** 2))), 6) AS aspect, round(mr, 6) AS median_radius
    FROM m JOIN r USING (slice_index)""",
    "points",
)
def shape_by_slice(spark, sf_dir):
    s = G.shape_summary(X.points(spark, sf_dir), ["slice_index"])
    return s.select("slice_index", "n", r6("cx").alias("cx"), r6("cy").alias("cy"), F.round("angle", 4).alias("angle"), r6("aspect").alias("aspect"), r6("median_radius").alias("median_radius"))


@query("report_statistics", "SELECT celltype, count(x) AS n, round(quantile_cont(x, 0.25), 6) AS q25, round(quantile_cont(x, 0.5), 6) AS q50, round(quantile_cont(x, 0.75), 6) AS q75, min(x) AS least, max(x) AS most FROM points GROUP BY ALL", "points")
def report_statistics(spark, sf_dir):
    q = F.percentile("x", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return X.points(spark, sf_dir).groupBy("celltype").agg(F.count("x").alias("n"), *[r6(F.get(q, F.lit(i))).alias(c) for i, c in enumerate(("q25", "q50", "q75"))], F.min("x").alias("least"), F.max("x").alias("most"))


@query(
    "confusion_summary",
    """WITH c AS (SELECT count(*) FILTER (quality = 0 AND n_chars < 500) AS tp, count(*) FILTER (quality = 1 AND n_chars < 500) AS fp, count(*) FILTER (quality = 0 AND n_chars >= 500) AS fn, count(*) FILTER (quality = 1 AND n_chars >= 500) AS tn FROM labels JOIN documents USING (doc_id))
    SELECT tp, fp, fn, tn, round(tp / greatest(tp + fp, 1), 6) AS precision, round(tp / greatest(tp + fn, 1), 6) AS recall, round(2 * tp / greatest(2 * tp + fp + fn, 1), 6) AS f1 FROM c""",
)
def confusion_summary(spark, sf_dir):
    both = X.read(spark, sf_dir, "labels").join(X.read(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id")
    bad, called = F.col("quality") == 0, F.col("n_chars") < 500
    c = both.agg(F.count_if(bad & called).alias("tp"), F.count_if(~bad & called).alias("fp"), F.count_if(bad & ~called).alias("fn"), F.count_if(~bad & ~called).alias("tn"))
    ratio = lambda a, b: r6(a / F.greatest(b, F.lit(1)))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return c.select("tp", "fp", "fn", "tn", ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))


@query(
    "label_centres",
    """WITH c AS (SELECT slice_index, celltype, count(*) AS n, median(x) AS cx, median(y) AS cy FROM points GROUP BY ALL HAVING count(*) >= 8)
    SELECT CAST(slice_index AS INTEGER) AS slice_index, celltype, any_value(n) AS n, round(any_value(cx), 6) AS cx, round(any_value(cy), 6) AS cy, round(median(sqrt((x - cx) ** 2 + (y - cy) ** 2)), 6) AS radius
    FROM points JOIN c USING (slice_index, celltype) GROUP BY slice_index, celltype""",
    "points",
)
def label_centres(spark, sf_dir):
    p = X.points(spark, sf_dir)
    keys = ["slice_index", "celltype"]
    c = p.groupBy(*keys).agg(F.count("*").alias("n"), F.percentile("x", F.lit(0.5)).alias("cx"), F.percentile("y", F.lit(0.5)).alias("cy")).where("n >= 8")
    r = F.percentile(F.hypot(F.col("x") - F.col("cx"), F.col("y") - F.col("cy")), F.lit(0.5))
    return p.join(c, keys).groupBy(*keys).agg(F.first("n").alias("n"), r6(F.first("cx")).alias("cx"), r6(F.first("cy")).alias("cy"), r6(r).alias("radius"))


@query("trimmed_means", "WITH q AS (SELECT slice_index, quantile_cont(x, 0.85) AS q FROM points GROUP BY ALL) SELECT CAST(slice_index AS INTEGER) AS slice_index, round(avg(x) FILTER (x <= q), 6) AS trimmed FROM points JOIN q USING (slice_index) GROUP BY ALL", "points")
def trimmed_means(spark, sf_dir):
    p = X.points(spark, sf_dir)
    q = p.groupBy("slice_index").agg(F.percentile("x", F.lit(0.85)).alias("q"))
    return p.join(q, "slice_index").groupBy("slice_index").agg(r6(F.avg(F.when(F.col("x") <= F.col("q"), F.col("x")))).alias("trimmed"))


@query("robust_diagonal", "SELECT CAST(slice_index AS INTEGER) AS slice_index, round(greatest(sqrt((quantile_cont(x, 0.98) - quantile_cont(x, 0.02)) ** 2 + (quantile_cont(y, 0.98) - quantile_cont(y, 0.02)) ** 2), 1e-8), 6) AS diagonal FROM points GROUP BY ALL", "points")
def robust_diagonal(spark, sf_dir):
    side = lambda c: F.percentile(c, F.lit(0.98)) - F.percentile(c, F.lit(0.02))
    return X.points(spark, sf_dir).groupBy("slice_index").agg(r6(F.greatest(F.hypot(side("x"), side("y")), lit(1e-8))).alias("diagonal"))


@query(
    "edge_celltype_table",
    """WITH c AS (SELECT slice_index, celltype, count(*) AS n, avg(x) AS cx, avg(y) AS cy FROM points GROUP BY ALL),
    s AS (SELECT DISTINCT slice_index FROM points), e AS (SELECT slice_index AS fixed, lead(slice_index) OVER (ORDER BY slice_index) AS moving FROM s), k AS (SELECT DISTINCT celltype FROM points)
    SELECT CAST(fixed AS INTEGER) AS fixed, CAST(moving AS INTEGER) AS moving, k.celltype, coalesce(a.n, 0) AS n_fixed, coalesce(b.n, 0) AS n_moving, round(sqrt((a.cx - b.cx) ** 2 + (a.cy - b.cy) ** 2), 6) AS jump
    FROM e CROSS JOIN k LEFT JOIN c a ON a.slice_index = fixed AND a.celltype = k.celltype LEFT JOIN c b ON b.slice_index = moving AND b.celltype = k.celltype WHERE moving IS NOT NULL""",
    "points",
)
def edge_celltype_table(spark, sf_dir):
    p = X.points(spark, sf_dir)
    c = p.groupBy("slice_index", "celltype").agg(F.count("*").alias("n"), F.avg("x").alias("cx"), F.avg("y").alias("cy"))
    edges = R.adjacent_edges(p.select("dataset_id", "slice_index").distinct())
    grid = edges.crossJoin(p.select("celltype").distinct())  # edges of a series by its label set
    a = c.select(F.col("slice_index").alias("fixed"), "celltype", F.col("n").alias("n1"), F.col("cx").alias("x1"), F.col("cy").alias("y1"))
    b = c.select(F.col("slice_index").alias("moving"), "celltype", F.col("n").alias("n2"), F.col("cx").alias("x2"), F.col("cy").alias("y2"))
    out = grid.join(a, ["fixed", "celltype"], "left").join(b, ["moving", "celltype"], "left")
    return out.select("fixed", "moving", "celltype", F.coalesce("n1", F.lit(0)).alias("n_fixed"), F.coalesce("n2", F.lit(0)).alias("n_moving"), r6(F.hypot(F.col("x1") - F.col("x2"), F.col("y1") - F.col("y2"))).alias("jump"))


@query(
    "component_summary",
    """WITH k AS (SELECT slice_index, celltype, count(*) AS n FROM points GROUP BY ALL), t AS (SELECT slice_index, string_agg(celltype || ':' || n, ';' ORDER BY n DESC, celltype) AS top FROM (SELECT *, row_number() OVER (PARTITION BY slice_index ORDER BY n DESC, celltype) AS r FROM k) WHERE r <= 3 GROUP BY ALL)
    SELECT CAST(slice_index AS INTEGER) AS slice_index, count(*) AS n, round(avg(x), 6) AS cx, round(avg(y), 6) AS cy, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1, any_value(top) AS top_celltypes FROM points JOIN t USING (slice_index) GROUP BY slice_index""",
    "points",
)
def component_summary(spark, sf_dir):
    p = X.points(spark, sf_dir)
    k = p.groupBy("slice_index", "celltype").agg(F.count("*").alias("n"))
    k = k.withColumn("r", F.row_number().over(Window.partitionBy("slice_index").orderBy(F.desc("n"), "celltype"))).where("r <= 3")
    top = k.groupBy("slice_index").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "celltype", "n"))), lambda s: F.concat_ws(":", s.celltype, s.n.cast("string"))), ";").alias("top_celltypes"))
    box = p.groupBy("slice_index").agg(F.count("*").alias("n"), r6(F.avg("x")).alias("cx"), r6(F.avg("y")).alias("cy"), F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    return box.join(top, "slice_index")


@query("displacement_quantiles", "SELECT celltype, count(*) AS n, round(avg(d), 6) AS mean, round(quantile_cont(d, 0.05), 6) AS p05, round(quantile_cont(d, 0.5), 6) AS median, round(quantile_cont(d, 0.95), 6) AS p95 FROM (SELECT celltype, sqrt(x * x + y * y + z * z) AS d FROM cells) GROUP BY ALL", "cells")
def displacement_quantiles(spark, sf_dir):
    d = X.cells(spark, sf_dir).select("celltype", F.sqrt(F.col("x") ** 2 + F.col("y") ** 2 + F.col("z") ** 2).alias("d"))
    q = F.percentile("d", F.array(F.lit(0.05), F.lit(0.5), F.lit(0.95)))
    return d.groupBy("celltype").agg(F.count("*").alias("n"), r6(F.avg("d")).alias("mean"), *[r6(F.get(q, F.lit(i))).alias(c) for i, c in enumerate(("p05", "median", "p95"))])


_NORMAL_SQL = """t AS (SELECT cell_id, sum(value) AS total FROM expression GROUP BY ALL), n AS (SELECT count(*) AS n FROM t),
    v AS (SELECT cell_id, gene, ln(1 + value * 10000.0::DOUBLE / total) AS v FROM expression JOIN t USING (cell_id))"""


def normalized_expression(e: DataFrame) -> DataFrame:
    """ln(1 + counts per 10,000) of a long table."""
    totals = e.groupBy("cell_id").agg(F.sum("value").alias("total"))
    return e.join(totals, "cell_id").select("cell_id", "gene", F.log1p(F.col("value") * 10000.0 / F.col("total")).alias("value"))


@query("gene_moments", f"WITH {_NORMAL_SQL} SELECT gene, round(sum(v) / any_value(n), 6) AS mean, round(greatest(sum(v * v) / any_value(n) - (sum(v) / any_value(n)) ** 2, 0), 6) AS variance FROM v, n GROUP BY gene", "expression")
def gene_moments(spark, sf_dir):
    e = normalized_expression(X.expression(spark, sf_dir))
    n = e.select("cell_id").distinct().agg(F.count("*").alias("n"))
    out = e.groupBy("gene").agg(F.sum("value").alias("s"), F.sum(F.col("value") ** 2).alias("q")).crossJoin(F.broadcast(n))
    mean = F.col("s") / F.col("n")
    return out.select("gene", r6(mean).alias("mean"), r6(F.greatest(F.col("q") / F.col("n") - mean * mean, lit(0))).alias("variance"))


@query("variable_genes", f"WITH {_NORMAL_SQL}, g AS (SELECT gene, greatest(sum(v * v) / any_value(n) - (sum(v) / any_value(n)) ** 2, 0) AS variance FROM v, n GROUP BY gene) SELECT gene FROM (SELECT gene, row_number() OVER (ORDER BY round(variance, 9) DESC, gene) AS r FROM g) WHERE r <= 3", "expression")
def variable_genes(spark, sf_dir):
    e = normalized_expression(X.expression(spark, sf_dir))
    n = e.select("cell_id").distinct().agg(F.count("*").alias("n"))
    out = e.groupBy("gene").agg(F.sum("value").alias("s"), F.sum(F.col("value") ** 2).alias("q")).crossJoin(F.broadcast(n))
    mean = F.col("s") / F.col("n")
    v = out.select("gene", F.round(F.greatest(F.col("q") / F.col("n") - mean * mean, lit(0)), 9).alias("variance"))
    return v.orderBy(F.desc("variance"), "gene").limit(3).select("gene")


@query("coverage_bins", "WITH s AS (SELECT min(x) AS a, max(x) AS b FROM cells) SELECT CAST(least(floor((x - a) / (b - a) * 10), 9) AS INTEGER) AS bin, count(*) AS n, round(avg(CASE WHEN z > 0 THEN 1.0::DOUBLE ELSE 0 END), 6) AS covered FROM cells, s GROUP BY ALL", "cells")
def coverage_bins(spark, sf_dir):
    c = X.cells(spark, sf_dir)
    s = c.agg(F.min("x").alias("a"), F.max("x").alias("b"))
    b = F.least(F.floor((F.col("x") - F.col("a")) / (F.col("b") - F.col("a")) * 10), F.lit(9)).cast("int")
    return c.crossJoin(F.broadcast(s)).groupBy(b.alias("bin")).agg(F.count("*").alias("n"), r6(F.avg((F.col("z") > 0).cast("double"))).alias("covered"))


@query("status_summary", "SELECT o_orderstatus AS status, count(*) AS n, round(avg(o_totalprice), 4) AS mean, round(quantile_cont(o_totalprice, 0.5), 4) AS median, max(o_totalprice) AS most FROM orders GROUP BY ALL")
def status_summary(spark, sf_dir):
    return X.read(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"), F.round(F.avg("o_totalprice"), 4).alias("mean"), F.round(F.percentile("o_totalprice", F.lit(0.5)), 4).alias("median"), F.max("o_totalprice").alias("most"))


@query(
    "collection_rollup",
    "SELECT coalesce(celltype, 'all') AS grp, count(DISTINCT slice_index) AS slices, count(*) AS n, count(*) FILTER (x > 50) AS flagged, round(100.0::DOUBLE * count(*) FILTER (x > 50) / count(*), 6) AS rate FROM points GROUP BY GROUPING SETS ((celltype), ())",
    "points",
)
def collection_rollup(spark, sf_dir):
    p = X.points(spark, sf_dir)
    out = p.rollup("celltype").agg(F.countDistinct("slice_index").alias("slices"), F.count("*").alias("n"), F.count_if(F.col("x") > 50).alias("flagged"))
    return out.select(F.coalesce("celltype", F.lit("all")).alias("grp"), "slices", "n", "flagged", r6(F.col("flagged") * 100.0 / F.col("n")).alias("rate"))


@query("count_like", "SELECT celltype, avg(CASE WHEN abs(x - round_even(x, 0)) < 1e-6 THEN 1.0::DOUBLE ELSE 0 END) >= 0.98 AND min(x) >= 0 AS x_is_counts, avg(CASE WHEN abs(y - round_even(y, 0)) < 1e-6 THEN 1.0::DOUBLE ELSE 0 END) >= 0.98 AND min(y) >= 0 AS y_is_counts FROM (SELECT celltype, CASE WHEN celltype IN ('click', 'view') THEN floor(x) ELSE x END AS x, CASE WHEN celltype IN ('error', 'view') THEN -y ELSE y END AS y FROM points) GROUP BY ALL", "points")
def count_like(spark, sf_dir):
    test = lambda c: (F.avg((F.abs(F.col(c) - F.rint(c)) < 1e-6).cast("double")) >= 0.98) & (F.min(c) >= 0)
    p = X.points(spark, sf_dir)
    p = p.withColumns({"x": F.when(F.col("celltype").isin("click", "view"), F.floor("x")).otherwise(F.col("x")), "y": F.when(F.col("celltype").isin("error", "view"), -F.col("y")).otherwise(F.col("y"))})
    return p.groupBy("celltype").agg(test("x").alias("x_is_counts"), test("y").alias("y_is_counts"))


# ------------------------------------------------------------------ joins and sets


@query("one_to_one_calls", "WITH a AS (SELECT slice_index, count(*) AS n FROM points WHERE x > 20 AND slice_index % 5 <> 0 GROUP BY ALL), b AS (SELECT slice_index, count(*) AS m FROM points WHERE x > 60 AND slice_index % 7 <> 0 GROUP BY slice_index, slice_index % 6 = 1 AND celltype = 'error'), k AS (SELECT *, count(*) OVER (PARTITION BY slice_index) AS k FROM b) SELECT CAST(slice_index AS INTEGER) AS slice_index, n, m, CASE WHEN n IS NULL THEN 'right_only' WHEN m IS NULL THEN 'left_only' ELSE 'both' END AS side, coalesce(k, 1) > 1 AS duplicated FROM a FULL JOIN k USING (slice_index)", "points")
def one_to_one_calls(spark, sf_dir):
    p = X.points(spark, sf_dir)
    a = p.where("x > 20 and slice_index % 5 <> 0").groupBy("slice_index").agg(F.count("*").alias("n"))
    twice = (F.col("slice_index") % 6 == 1) & (F.col("celltype") == "error")  # some slices have two calls
    b = p.where("x > 60 and slice_index % 7 <> 0").groupBy("slice_index", twice.alias("t")).agg(F.count("*").alias("m")).drop("t")
    return R.outer_one_to_one(a, b, ["slice_index"])


@query("exact_cover", "SELECT *, missing = 0 AND extra = 0 AND duplicate = 0 AS exact FROM (SELECT (SELECT count(*) FROM documents d ANTI JOIN labels l USING (doc_id)) AS missing, (SELECT count(*) FROM labels l ANTI JOIN documents d USING (doc_id)) AS extra, (SELECT count(*) FROM (SELECT doc_id FROM labels GROUP BY ALL HAVING count(*) > 1)) AS duplicate)")
def exact_cover(spark, sf_dir):
    return R.cover_report(X.read(spark, sf_dir, "documents").select("doc_id"), X.read(spark, sf_dir, "labels").select("doc_id"), "doc_id")


@query("left_with_fallback", "SELECT d.doc_id, coalesce(CAST(quality AS VARCHAR), 'unlabelled') AS label FROM documents d LEFT JOIN labels USING (doc_id)")
def left_with_fallback(spark, sf_dir):
    d = X.read(spark, sf_dir, "documents").select("doc_id")
    return d.join(X.read(spark, sf_dir, "labels"), "doc_id", "left").select("doc_id", F.coalesce(F.col("quality").cast("string"), F.lit("unlabelled")).alias("label"))


@query("wanted_cells", "SELECT cell_id, gene, value FROM expression SEMI JOIN (SELECT o_custkey AS cell_id FROM orders WHERE o_orderstatus = 'F') w USING (cell_id)", "expression")
def wanted_cells(spark, sf_dir):
    w = X.read(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("cell_id"))
    return X.expression(spark, sf_dir).join(w, "cell_id", "left_semi")


@query("common_genes", "WITH g AS (SELECT DISTINCT gene, slice_index FROM slice_genes) SELECT gene FROM g GROUP BY gene HAVING count(*) = (SELECT count(DISTINCT slice_index) FROM slice_genes)", "slice_genes")
def common_genes(spark, sf_dir):
    return R.common_keys(X.slice_genes(spark, sf_dir), "gene", "slice_index")


@query("adjacent_edges", "WITH s AS (SELECT DISTINCT dataset_id, slice_index FROM cells) SELECT dataset_id, slice_index AS fixed, moving FROM (SELECT *, lead(slice_index) OVER (PARTITION BY dataset_id ORDER BY slice_index) AS moving FROM s) WHERE moving IS NOT NULL", "cells")
def adjacent_edges(spark, sf_dir):
    return R.adjacent_edges(X.cells(spark, sf_dir).select("dataset_id", "slice_index").distinct())


@query(
    "component_triads",
    """WITH c AS (SELECT slice_index, celltype, count(*) AS n, avg(x) AS cx, avg(y) AS cy FROM points GROUP BY ALL)
    SELECT CAST(m.slice_index AS INTEGER) AS slice_index, m.celltype, p.n AS n_prev, m.n AS n_mid, q.n AS n_next, round(sqrt((m.cx - (p.cx + q.cx) / 2) ** 2 + (m.cy - (p.cy + q.cy) / 2) ** 2), 6) AS mid_offset, round(sqrt((p.cx - q.cx) ** 2 + (p.cy - q.cy) ** 2), 6) AS gap
    FROM c m JOIN c p ON p.slice_index = m.slice_index - 1 AND p.celltype = m.celltype JOIN c q ON q.slice_index = m.slice_index + 1 AND q.celltype = m.celltype""",
    "points",
)
def component_triads(spark, sf_dir):
    c = X.points(spark, sf_dir).groupBy("slice_index", "celltype").agg(F.count("*").alias("n"), F.avg("x").alias("cx"), F.avg("y").alias("cy"))
    side = lambda step, tag: c.select((F.col("slice_index") - step).alias("slice_index"), "celltype", F.col("n").alias(f"n_{tag}"), F.col("cx").alias(f"x_{tag}"), F.col("cy").alias(f"y_{tag}"))
    t = c.join(side(-1, "prev"), ["slice_index", "celltype"]).join(side(1, "next"), ["slice_index", "celltype"])
    off = F.hypot(F.col("cx") - (F.col("x_prev") + F.col("x_next")) / 2, F.col("cy") - (F.col("y_prev") + F.col("y_next")) / 2)
    return t.select("slice_index", "celltype", "n_prev", F.col("n").alias("n_mid"), "n_next", r6(off).alias("mid_offset"), r6(F.hypot(F.col("x_prev") - F.col("x_next"), F.col("y_prev") - F.col("y_next"))).alias("gap"))


@query("radius_pairs", "SELECT a.slice_index, a.cell_id AS a, b.cell_id AS b, round((a.x - b.x) ** 2 + (a.y - b.y) ** 2, 9) AS d2 FROM cells a JOIN cells b ON a.slice_index = b.slice_index AND a.cell_id < b.cell_id AND (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= 0.05 * 0.05", "cells")
def radius_pairs(spark, sf_dir):
    return R.radius_pairs(X.cells(spark, sf_dir), 0.05, ["slice_index"]).withColumn("d2", F.round("d2", 9))


@query(
    "nearest_neighbours",
    "WITH p AS (SELECT a.slice_index, a.cell_id, b.cell_id AS other, (a.x - b.x) ** 2 + (a.y - b.y) ** 2 AS d2 FROM cells a JOIN cells b ON a.slice_index = b.slice_index AND a.cell_id <> b.cell_id) SELECT slice_index, cell_id, other, CAST(r AS INTEGER) AS rank, round(d2, 9) AS d2 FROM (SELECT *, row_number() OVER (PARTITION BY slice_index, cell_id ORDER BY d2, other) AS r FROM p) WHERE r <= 12",
    "cells",
)
def nearest_neighbours(spark, sf_dir):
    return R.nearest(X.cells(spark, sf_dir), 12, ["slice_index"]).withColumn("d2", F.round("d2", 9))


@query(
    "neighbour_spacing",
    "WITH d AS (SELECT a.slice_index, a.cell_id, sqrt(min((a.x - b.x) ** 2 + (a.y - b.y) ** 2)) AS d FROM cells a JOIN cells b ON a.slice_index = b.slice_index AND a.cell_id <> b.cell_id GROUP BY ALL) SELECT slice_index, round(quantile_cont(d, 0.5), 6) AS nn_median, round(greatest(quantile_cont(d, 0.95) / quantile_cont(d, 0.5) - 1, 0), 6) AS knn_tail FROM d WHERE d > 0 GROUP BY ALL",
    "cells",
)
def neighbour_spacing(spark, sf_dir):
    d = R.nearest(X.cells(spark, sf_dir), 1, ["slice_index"]).select("slice_index", F.sqrt("d2").alias("d")).where("d > 0")
    mid, high = F.percentile("d", F.lit(0.5)), F.percentile("d", F.lit(0.95))
    return d.groupBy("slice_index").agg(r6(mid).alias("nn_median"), r6(F.greatest(high / mid - 1, lit(0))).alias("knn_tail"))


@query(
    "label_agreement",
    "WITH p AS (SELECT a.slice_index, a.celltype AS l, b.celltype AS m, row_number() OVER (PARTITION BY a.cell_id ORDER BY (a.x - b.x) ** 2 + (a.y - b.y) ** 2, b.cell_id) AS r FROM cells a JOIN cells b ON b.slice_index = a.slice_index + 1) SELECT slice_index, count(*) AS n, round(avg(CASE WHEN l = m THEN 1.0::DOUBLE ELSE 0 END), 6) AS agreement FROM p WHERE r = 1 GROUP BY ALL",
    "cells",
)
def label_agreement(spark, sf_dir):
    c = X.cells(spark, sf_dir)
    following = c.withColumn("slice_index", F.col("slice_index") - 1)
    near = R.nearest_between(c, following, 1, ["slice_index"])
    both = near.join(c.select("cell_id", F.col("celltype").alias("l")), "cell_id").join(c.select(F.col("cell_id").alias("other"), F.col("celltype").alias("m")), "other")
    return both.groupBy("slice_index").agg(F.count("*").alias("n"), r6(F.avg((F.col("l") == F.col("m")).cast("double"))).alias("agreement"))


@query("unknown_ids", "SELECT o_custkey AS cell_id FROM orders EXCEPT SELECT user_id FROM events")
def unknown_ids(spark, sf_dir):
    return X.read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("cell_id")).subtract(X.read(spark, sf_dir, "events").select("user_id"))


@query("shared_ids", "SELECT o_custkey AS cell_id FROM orders INTERSECT SELECT user_id FROM events")
def shared_ids(spark, sf_dir):
    return X.read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("cell_id")).intersect(X.read(spark, sf_dir, "events").select("user_id"))


@query("repeated_ids", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def repeated_ids(spark, sf_dir):
    return X.read(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).where("n > 1")


@query("stacked_series", "SELECT dataset_id, cell_id, CAST(slice_index AS INTEGER) AS slice_index, x, y, total_counts, celltype, NULL::DOUBLE AS z FROM points UNION ALL BY NAME SELECT dataset_id, cell_id, slice_index, x, y, celltype, z FROM cells", "points cells")
def stacked_series(spark, sf_dir):
    return R.stacked([X.points(spark, sf_dir).drop("user_id"), X.cells(spark, sf_dir)])


# ------------------------------------------------------------------ order, samples, resolvers


@query("natural_order", "SELECT p_name, p_brand, CAST(dense_rank() OVER (ORDER BY lpad(regexp_extract(p_brand, '(\\d+)', 1), 20, '0')) AS INTEGER) AS place, CAST(regexp_extract(p_brand, '(\\d+)', 1) AS INTEGER) AS number FROM (SELECT DISTINCT p_name, p_brand FROM part)")
def natural_order(spark, sf_dir):
    p = X.read(spark, sf_dir, "part").select("p_name", "p_brand").distinct()
    brands = p.select("p_brand").distinct().withColumn("place", F.dense_rank().over(Window.orderBy(natural_key(F.col("p_brand")))))
    return p.join(F.broadcast(brands), "p_brand").select("p_name", "p_brand", "place", slice_number(F.col("p_brand")).alias("number"))


@query("slice_order", "WITH o AS (SELECT celltype, quantile_cont(slice_index, 0.5) AS m FROM points GROUP BY ALL) SELECT celltype, CAST(row_number() OVER (ORDER BY m, celltype) AS INTEGER) AS place FROM o", "points")
def slice_order(spark, sf_dir):
    o = X.points(spark, sf_dir).groupBy("celltype").agg(F.percentile("slice_index", F.lit(0.5)).alias("m"))
    return o.select("celltype", F.row_number().over(Window.orderBy("m", "celltype")).alias("place"))


@query("keep_rules", "SELECT CAST(slice_index AS INTEGER) AS slice_index, count(*) AS before, count(*) FILTER (CASE WHEN slice_index < 10 THEN x > 20 WHEN slice_index = 12 THEN y <= 50 ELSE true END) AS after FROM points GROUP BY ALL", "points")
def keep_rules(spark, sf_dir):
    keep = F.when(F.col("slice_index") < 10, F.col("x") > 20).when(F.col("slice_index") == 12, F.col("y") <= 50).otherwise(F.lit(True))
    return X.points(spark, sf_dir).groupBy("slice_index").agg(F.count("*").alias("before"), F.count_if(keep).alias("after"))


@query("excluded_labels", "SELECT cell_id, celltype FROM points WHERE NOT regexp_matches(celltype, '^(err|sig)')", "points")
def excluded_labels(spark, sf_dir):
    return X.points(spark, sf_dir).where(~F.col("celltype").rlike("^(err|sig)")).select("cell_id", "celltype")


@query("display_rectangle", "SELECT cell_id FROM points WHERE 0.8 * x - 0.6 * y + 3 BETWEEN -20 AND 40 AND 0.6 * x + 0.8 * y - 1 BETWEEN 10 AND 70", "points")
def display_rectangle(spark, sf_dir):
    u, v = F.col("x") * 0.8 - F.col("y") * 0.6 + 3, F.col("x") * 0.6 + F.col("y") * 0.8 - 1
    return X.points(spark, sf_dir).where(u.between(-20, 40) & v.between(10, 70)).select("cell_id")


@query("even_sample", "WITH n AS (SELECT count(*) AS n FROM cells), i AS (SELECT CAST(floor(k * (n - 1) / 19) AS BIGINT) AS i FROM n, range(20) t(k)) SELECT cell_id FROM (SELECT cell_id, row_number() OVER (ORDER BY cell_id) - 1 AS i FROM cells) WHERE i IN (SELECT i FROM i)", "cells")
def even_sample(spark, sf_dir):
    return R.even_sample(X.cells(spark, sf_dir).select("cell_id"), ["cell_id"], 20)


@query("hash_sample", "SELECT slice_index, cell_id FROM (SELECT slice_index, cell_id, row_number() OVER (PARTITION BY slice_index ORDER BY substr(sha1('17|' || cell_id), 1, 16), cell_id) AS r FROM cells) WHERE r <= 10", "cells")
def hash_sample(spark, sf_dir):
    r = F.row_number().over(Window.partitionBy("slice_index").orderBy(hash_rank(17, F.col("cell_id")), "cell_id"))
    return X.cells(spark, sf_dir).withColumn("r", r).where("r <= 10").select("slice_index", "cell_id")


@query(
    "grid_balanced_sample",
    """WITH b AS (SELECT *, min(x) OVER w AS x0, max(x) OVER w AS x1, min(y) OVER w AS y0, max(y) OVER w AS y1 FROM cells WINDOW w AS (PARTITION BY slice_index)),
    g AS (SELECT *, CASE WHEN x1 > x0 THEN least(floor((x - x0) / (x1 - x0) * 4), 3) ELSE 0 END AS gx, CASE WHEN y1 > y0 THEN least(floor((y - y0) / (y1 - y0) * 4), 3) ELSE 0 END AS gy FROM b),
    t AS (SELECT *, row_number() OVER (PARTITION BY slice_index, gx, gy ORDER BY substr(sha1('5|' || cell_id), 1, 16), cell_id) AS turn FROM g)
    SELECT slice_index, cell_id FROM (SELECT *, row_number() OVER (PARTITION BY slice_index ORDER BY turn, gx, gy) AS p FROM t) WHERE p <= 20""",
    "cells",
)
def grid_balanced_sample(spark, sf_dir):
    return R.grid_balanced(X.cells(spark, sf_dir), ["slice_index"], 20, 5).select("slice_index", "cell_id")


@query("component_ranks", "SELECT CAST(slice_index AS INTEGER) AS slice_index, celltype, n, CAST(row_number() OVER (PARTITION BY slice_index ORDER BY n DESC, celltype) AS INTEGER) AS rank FROM (SELECT slice_index, celltype, count(*) AS n FROM points GROUP BY ALL)", "points")
def component_ranks(spark, sf_dir):
    k = X.points(spark, sf_dir).groupBy("slice_index", "celltype").agg(F.count("*").alias("n"))
    return k.withColumn("rank", F.row_number().over(Window.partitionBy("slice_index").orderBy(F.desc("n"), "celltype")))


@query("manifest_conflicts", "SELECT o_custkey AS dataset_id, count(DISTINCT o_orderpriority) AS n_values, count(DISTINCT o_orderpriority) > 1 AS conflict FROM orders GROUP BY ALL")
def manifest_conflicts(spark, sf_dir):
    return X.read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("dataset_id")).agg(F.countDistinct("o_orderpriority").alias("n_values")).withColumn("conflict", F.col("n_values") > 1)


@query("manifest_first", "SELECT o_custkey AS path, min(o_orderkey) AS first_order FROM orders GROUP BY ALL")
def manifest_first(spark, sf_dir):
    first = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    return X.read(spark, sf_dir, "orders").withColumn("r", first).where("r = 1").select(F.col("o_custkey").alias("path"), F.col("o_orderkey").alias("first_order"))


@query("rule_audit", "SELECT unnest(['finite_xy', 'known_label', 'positive_counts']) AS rule, unnest([count(*) FILTER (x IS NULL OR y IS NULL), count(*) FILTER (NOT (celltype IN ('click', 'view', 'error', 'signup', 'purchase'))), count(*) FILTER (total_counts <= 0)]) AS failed, failed = 0 AS ok FROM points", "points")
def rule_audit(spark, sf_dir):
    rules = {"finite_xy": F.col("x").isNotNull() & F.col("y").isNotNull(), "known_label": F.col("celltype").isin("click", "view", "error", "signup", "purchase"), "positive_counts": F.col("total_counts") > 0}
    return R.rule_table(X.points(spark, sf_dir), rules)


# ------------------------------------------------------------------ windows


_LONG = f"{METRICS_SQL}, long AS (SELECT dataset_id, slice_index, 'n_locations' AS metric, n_locations::DOUBLE AS value FROM m UNION ALL SELECT dataset_id, slice_index, 'median_total_counts', median_total_counts FROM m)"
_EXPECTED = (
    _LONG
    + """,
pos AS (SELECT *, (row_number() OVER (PARTITION BY dataset_id, metric ORDER BY slice_index) - 1)::DOUBLE AS pos FROM long),
nb AS (SELECT a.dataset_id, a.metric, a.slice_index, a.pos, a.value, b.pos AS bp, b.value AS bv FROM pos a JOIN pos b ON a.dataset_id = b.dataset_id AND a.metric = b.metric AND b.pos <> a.pos AND abs(b.pos - a.pos) <= 2 AND b.value IS NOT NULL),
sl AS (SELECT p.dataset_id, p.metric, p.slice_index, median((q.bv - p.bv) / (q.bp - p.bp)) AS slope FROM nb p JOIN nb q ON p.dataset_id = q.dataset_id AND p.metric = q.metric AND p.slice_index = q.slice_index AND q.bp > p.bp GROUP BY ALL),
ex AS (SELECT dataset_id, metric, slice_index, any_value(value) AS value, count(*) FILTER (bp < pos) > 0 AND count(*) FILTER (bp > pos) > 0 AS two_sided,
        CASE WHEN count(*) FILTER (bp < pos) > 0 AND count(*) FILTER (bp > pos) > 0 THEN median(bv - slope * bp) + any_value(slope) * any_value(pos) ELSE median(bv) END AS expected,
        CASE WHEN count(*) FILTER (bp < pos) > 0 AND count(*) FILTER (bp > pos) > 0 THEN abs(median(bv) FILTER (bp < pos) - median(bv) FILTER (bp > pos)) END AS disagreement
    FROM nb LEFT JOIN sl USING (dataset_id, metric, slice_index) GROUP BY ALL)"""
)


def long_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = slice_metrics(X.points(spark, sf_dir))
    return m.select("dataset_id", "slice_index", F.col("n_locations").cast("double").alias("n_locations"), "median_total_counts").unpivot(["dataset_id", "slice_index"], ["n_locations", "median_total_counts"], "metric", "value")


@query("local_expectation", f"WITH {_EXPECTED} SELECT metric, CAST(slice_index AS INTEGER) AS slice_index, round(expected, 6) AS expected, two_sided, round(disagreement, 6) AS disagreement FROM ex", "points")
def local_expectation(spark, sf_dir):
    return W.local_expected(long_metrics(spark, sf_dir), 5).select("metric", "slice_index", r6("expected").alias("expected"), "two_sided", r6("disagreement").alias("disagreement"))


@query(
    "metric_anomaly",
    f"""WITH {_EXPECTED},
    res AS (SELECT *, expected - value AS residual FROM ex),
    c AS (SELECT dataset_id, metric, median(residual) AS rc, stddev_pop(residual) AS rsd, median(value) AS vc, stddev_pop(value) AS vsd FROM res GROUP BY ALL),
    s AS (SELECT dataset_id, metric, any_value(rc) AS rc, median(abs(residual - rc)) * {MAD_SCALE} AS rm, any_value(rsd) AS rsd, median(abs(value - vc)) * {MAD_SCALE} AS vm, any_value(vsd) AS vsd FROM res JOIN c USING (dataset_id, metric) GROUP BY ALL),
    t AS (SELECT dataset_id, metric, rc, CASE WHEN rm > 1e-15 THEN rm WHEN rsd > 1e-15 THEN rsd ELSE 1 END AS rs, CASE WHEN vm > 1e-15 THEN vm WHEN vsd > 1e-15 THEN vsd ELSE 1 END AS vs FROM s)
    SELECT metric, CAST(slice_index AS INTEGER) AS slice_index, round(CASE WHEN value IS NULL OR expected IS NULL THEN 0 ELSE
        greatest(least(greatest((greatest(residual / greatest(abs(expected), 2.220446049250313e-16), 0) - 0.25) / 0.37, 0), 1), least(greatest((greatest((residual - rc) / rs, 0) - 1.5) / 3, 0), 1))
        * CASE WHEN two_sided THEN 1 ELSE 0.72 END * least(greatest(exp(-coalesce(disagreement, 0) / greatest(vs * 2.5, 2.220446049250313e-16)), 0.35), 1) END, 6) AS score
    FROM res JOIN t USING (dataset_id, metric)""",
    "points",
)
def metric_anomaly(spark, sf_dir):
    return W.metric_anomaly(long_metrics(spark, sf_dir), 5, True, 0.25, 0.62).select("metric", "slice_index", r6("score").alias("score"))


@query("smooth_taper", f"WITH {METRICS_SQL} SELECT CAST(slice_index AS INTEGER) AS slice_index, coalesce(least(a, b, n_locations) > 0 AND a IS NOT NULL AND b IS NOT NULL AND n_locations BETWEEN least(a, b) AND greatest(a, b), false) AS smooth_taper FROM (SELECT *, lag(n_locations) OVER w AS a, lead(n_locations) OVER w AS b FROM m WINDOW w AS (PARTITION BY dataset_id ORDER BY slice_index))", "points")
def smooth_taper(spark, sf_dir):
    return W.smooth_taper(slice_metrics(X.points(spark, sf_dir)), ("n_locations",)).select("slice_index", "smooth_taper")


@query(
    "profile_divergence",
    """WITH p AS (SELECT slice_index, row_number() OVER (ORDER BY slice_index) AS p FROM (SELECT DISTINCT slice_index FROM slice_genes)),
    o AS (SELECT p, gene, value FROM slice_genes JOIN p USING (slice_index)), g AS (SELECT DISTINCT gene FROM slice_genes),
    d AS (SELECT p.p, g.gene, coalesce(o.value, 0) AS value FROM p CROSS JOIN g LEFT JOIN o ON o.p = p.p AND o.gene = g.gene),
    n AS (SELECT a.p, a.gene, any_value(a.value) AS v, sum(b.value) AS s, sum(b.value) FILTER (b.p < a.p) AS sl, sum(b.value) FILTER (b.p > a.p) AS sr FROM d a JOIN d b ON a.gene = b.gene AND a.p <> b.p AND abs(a.p - b.p) <= 2 GROUP BY a.p, a.gene),
    t AS (SELECT p, sum(v * s) / greatest(sqrt(sum(v * v)) * sqrt(sum(s * s)), 2.220446049250313e-16) AS c, sum(sl * sr) / greatest(sqrt(sum(sl * sl)) * sqrt(sum(sr * sr)), 2.220446049250313e-16) AS lr FROM n GROUP BY p)
    SELECT slice_index, round(1 - c, 6) AS divergence, round(lr, 6) AS similarity FROM t JOIN p USING (p)""",
    "slice_genes",
)
def profile_divergence(spark, sf_dir):
    d = W.profile_divergence(X.slice_genes(spark, sf_dir).withColumn("dataset_id", F.lit("li")), 5)
    return d.select("slice_index", r6("divergence").alias("divergence"), r6("similarity").alias("similarity"))


@query(
    "composition_divergence",
    """WITH k AS (SELECT slice_index, celltype, count(*)::DOUBLE AS n FROM points GROUP BY ALL), s AS (SELECT slice_index, sum(n) AS total FROM k GROUP BY ALL), l AS (SELECT DISTINCT celltype FROM k),
    d AS (SELECT s.slice_index, l.celltype, coalesce(n, 0) / total AS p, row_number() OVER (PARTITION BY l.celltype ORDER BY s.slice_index) AS i FROM s CROSS JOIN l LEFT JOIN k ON k.slice_index = s.slice_index AND k.celltype = l.celltype),
    q AS (SELECT a.slice_index, a.celltype, any_value(a.p) AS p, avg(b.p) AS q FROM d a JOIN d b ON a.celltype = b.celltype AND a.i <> b.i AND abs(a.i - b.i) <= 2 GROUP BY ALL),
    e AS (SELECT slice_index, (p + 2.220446049250313e-16) / sum(p + 2.220446049250313e-16) OVER w AS a, (q + 2.220446049250313e-16) / sum(q + 2.220446049250313e-16) OVER w AS b FROM q WINDOW w AS (PARTITION BY slice_index))
    SELECT CAST(slice_index AS INTEGER) AS slice_index, round(0.5 * sum(a * log2(a / ((a + b) / 2))) + 0.5 * sum(b * log2(b / ((a + b) / 2))), 6) AS js FROM e GROUP BY slice_index""",
    "points",
)
def composition_divergence(spark, sf_dir):
    k = X.points(spark, sf_dir).groupBy("dataset_id", "slice_index", F.col("celltype").alias("label")).agg(F.count("*").alias("n"))
    return W.composition_divergence(k, 5).select("slice_index", r6("js").alias("js"))


@query(
    "edge_threshold",
    """WITH c AS (SELECT slice_index, avg(CASE WHEN slice_index = 13 THEN x + 80 ELSE x END) AS cx, avg(y) AS cy FROM points GROUP BY ALL), e AS (SELECT slice_index AS fixed, sqrt((cx - lead(cx) OVER w) ** 2 + (cy - lead(cy) OVER w) ** 2) AS jump FROM c WINDOW w AS (ORDER BY slice_index)),
    f AS (SELECT * FROM e WHERE jump IS NOT NULL), m AS (SELECT median(jump) AS mid FROM f), d AS (SELECT any_value(mid) AS mid, median(abs(jump - mid)) AS mad FROM f, m)
    SELECT CAST(fixed AS INTEGER) AS fixed, round(jump, 6) AS jump, jump > greatest(1.5 * mid, mid + 3 * 1.4826 * mad) AS high FROM f, d""",
    "points",
)
def edge_threshold(spark, sf_dir):
    away = F.when(F.col("slice_index") == 13, F.col("x") + 80).otherwise(F.col("x"))  # one slice lies elsewhere
    c = X.points(spark, sf_dir).groupBy("dataset_id", "slice_index").agg(F.avg(away).alias("cx"), F.avg("y").alias("cy"))
    w = Window.partitionBy("dataset_id").orderBy("slice_index")
    e = c.select("dataset_id", F.col("slice_index").alias("fixed"), F.hypot(F.col("cx") - F.lead("cx").over(w), F.col("cy") - F.lead("cy").over(w)).alias("jump")).where("jump is not null")
    return W.robust_threshold(e, "jump", ["dataset_id"], 1.5, 3.0).select("fixed", r6("jump").alias("jump"), (F.col("jump") > F.col("threshold")).alias("high"))


# ------------------------------------------------------------------ registration, recipes


@query(
    "rigid_fit",
    """WITH p AS (SELECT a.slice_index, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM cells a JOIN cells b ON b.cell_id = a.cell_id + 50 AND b.slice_index = a.slice_index + 1),
    m AS (SELECT slice_index, avg(x1) AS mx1, avg(y1) AS my1, avg(x2) AS mx2, avg(y2) AS my2 FROM p GROUP BY ALL),
    t AS (SELECT slice_index, atan2(sum((x1 - mx1) * (y2 - my2) - (y1 - my1) * (x2 - mx2)), sum((x1 - mx1) * (x2 - mx2) + (y1 - my1) * (y2 - my2))) AS theta, any_value(mx1) AS mx1, any_value(my1) AS my1, any_value(mx2) AS mx2, any_value(my2) AS my2 FROM p JOIN m USING (slice_index) GROUP BY ALL),
    u AS (SELECT *, mx2 - (cos(theta) * mx1 - sin(theta) * my1) AS tx, my2 - (sin(theta) * mx1 + cos(theta) * my1) AS ty FROM t)
    SELECT slice_index, round(any_value(theta), 6) AS theta, round(any_value(tx), 6) AS tx, round(any_value(ty), 6) AS ty, round(sqrt(avg((cos(theta) * x1 - sin(theta) * y1 + tx - x2) ** 2 + (sin(theta) * x1 + cos(theta) * y1 + ty - y2) ** 2)), 6) AS rmse
    FROM p JOIN u USING (slice_index) GROUP BY slice_index""",
    "cells",
)
def rigid_fit(spark, sf_dir):
    c = X.cells(spark, sf_dir)
    b = c.select((F.col("slice_index") - 1).alias("slice_index"), (F.col("cell_id") - 50).alias("cell_id"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    pairs = c.select("slice_index", "cell_id", F.col("x").alias("x1"), F.col("y").alias("y1")).join(b, ["slice_index", "cell_id"])
    return G.rigid_fit(pairs, ["slice_index"]).select("slice_index", *[r6(k).alias(k) for k in ("theta", "tx", "ty", "rmse")])


RECIPE = [
    {"op": "translate", "dx": 2.0, "dy": -1.0, "slices": [3, 4, 5]},
    {"op": "rotate", "degrees": 30.0, "center": (10.0, 20.0), "celltypes": ["click"]},
    {"op": "scale", "factor": 1.5, "center": (0.0, 5.0)},
    {"op": "affine", "matrix": ((1.0, 0.25, 1.0), (0.0, 1.0, -2.0)), "slices": [7]},
    {"op": "mirror", "axis": "x", "center": (50.0, 0.0), "slices": [8], "celltypes": ["view", "error"]},
]


@query(
    "recipe_replay",
    """WITH a AS (SELECT cell_id, slice_index, celltype, x AS x0, y AS y0, CASE WHEN slice_index IN (3, 4, 5) THEN x + 2 ELSE x END AS x, CASE WHEN slice_index IN (3, 4, 5) THEN y - 1 ELSE y END AS y FROM points),
    b AS (SELECT * REPLACE (CASE WHEN celltype = 'click' THEN 10 + cos(radians(30)) * (x - 10) - sin(radians(30)) * (y - 20) ELSE x END AS x, CASE WHEN celltype = 'click' THEN 20 + sin(radians(30)) * (x - 10) + cos(radians(30)) * (y - 20) ELSE y END AS y) FROM a),
    c AS (SELECT * REPLACE (x * 1.5 AS x, 5 + (y - 5) * 1.5 AS y) FROM b),
    d AS (SELECT * REPLACE (CASE WHEN slice_index = 7 THEN x + 0.25 * y + 1 ELSE x END AS x, CASE WHEN slice_index = 7 THEN y - 2 ELSE y END AS y) FROM c),
    e AS (SELECT * REPLACE (CASE WHEN slice_index = 8 AND celltype IN ('view', 'error') THEN 100 - x ELSE x END AS x) FROM d)
    SELECT CAST(slice_index AS INTEGER) AS slice_index, count(*) AS n, count(*) FILTER (sqrt((x - x0) ** 2 + (y - y0) ** 2) > 1e-6) AS changed, round(avg(sqrt((x - x0) ** 2 + (y - y0) ** 2)), 6) AS mean_shift, round(max(sqrt((x - x0) ** 2 + (y - y0) ** 2)), 6) AS max_shift FROM e GROUP BY slice_index""",
    "points",
)
def recipe_replay(spark, sf_dir):
    p = X.points(spark, sf_dir)
    out = G.changed_rows(p, G.apply_recipe(p, RECIPE))
    return out.select("slice_index", "n", "changed", r6("mean_shift").alias("mean_shift"), r6("max_shift").alias("max_shift"))


@query("voxel_counts", "SELECT CAST(round_even(x / 0.05, 0) AS BIGINT) AS ix, CAST(round_even(y / 0.05, 0) AS BIGINT) AS iy, CAST(round_even(z / 0.05, 0) AS BIGINT) AS iz, count(*) AS n FROM cells GROUP BY ALL", "cells")
def voxel_counts(spark, sf_dir):
    at = [F.rint(F.col(a) / 0.05).cast("long").alias(f"i{a}") for a in "xyz"]
    return X.cells(spark, sf_dir).groupBy(*at).agg(F.count("*").alias("n"))


@query("gene_colour", "SELECT cell_id, CAST(sum(value) FILTER (gene IN ('click', 'view')) AS BIGINT) AS gene_sum FROM expression GROUP BY ALL", "expression")
def gene_colour(spark, sf_dir):
    return X.expression(spark, sf_dir).groupBy("cell_id").agg(F.sum(F.when(F.col("gene").isin("click", "view"), F.col("value"))).alias("gene_sum"))


@query("display_depth", "SELECT cell_id, CAST((dense_rank() OVER (ORDER BY slice_index) - 1) * 5.0 AS DOUBLE) AS z_display FROM cells", "cells")
def display_depth(spark, sf_dir):
    c = X.cells(spark, sf_dir)
    z = c.select("slice_index").distinct().withColumn("z_display", (F.row_number().over(Window.orderBy("slice_index")) - 1) * lit(5.0))
    return c.join(F.broadcast(z), "slice_index").select("cell_id", "z_display")


# ------------------------------------------------------------------ review


def _ranked_components(p: DataFrame) -> DataFrame:
    c = p.groupBy("dataset_id", "slice_index", "celltype").agg(F.count("*").alias("points"), F.avg("x").alias("cx"), F.avg("y").alias("cy"), (F.max("x") - F.min("x")).alias("width"), (F.max("y") - F.min("y")).alias("height"))
    return c.withColumn("rank", F.row_number().over(Window.partitionBy("dataset_id", "slice_index").orderBy(F.desc("points"), "celltype")))


@query(
    "triad_scan",
    """WITH k AS (SELECT slice_index, celltype, count(*)::DOUBLE AS n, avg(x) AS cx, avg(y) AS cy, max(x) - min(x) AS w, max(y) - min(y) AS h FROM points GROUP BY ALL),
    c AS (SELECT *, row_number() OVER (PARTITION BY slice_index ORDER BY n DESC, celltype) AS rank, dense_rank() OVER (ORDER BY slice_index) AS p, sqrt(w * w + h * h) AS diag, w * h AS area, w / greatest(h, 1e-6) AS aspect FROM k),
    t AS (SELECT a.slice_index AS sa, m.slice_index AS sm, b.slice_index AS sb, m.rank, m.n, greatest(a.diag, m.diag, b.diag, 100) AS scale,
        sqrt((a.cx - m.cx) ** 2 + (a.cy - m.cy) ** 2) AS am, sqrt((m.cx - b.cx) ** 2 + (m.cy - b.cy) ** 2) AS mb, sqrt((a.cx - b.cx) ** 2 + (a.cy - b.cy) ** 2) AS ab,
        sqrt((m.cx - (a.cx + b.cx) / 2) ** 2 + (m.cy - (a.cy + b.cy) / 2) ** 2) AS off, (m.cx - a.cx) * (b.cx - m.cx) + (m.cy - a.cy) * (b.cy - m.cy) AS dot,
        least(0.65 * least(a.n, b.n) / greatest(a.n, b.n, 1) + 0.35 * least(a.area, b.area) / greatest(a.area, b.area, 1), 0.65 * least(a.n, m.n) / greatest(a.n, m.n, 1) + 0.35 * least(a.area, m.area) / greatest(a.area, m.area, 1), 0.65 * least(b.n, m.n) / greatest(b.n, m.n, 1) + 0.35 * least(b.area, m.area) / greatest(b.area, m.area, 1)) AS stable,
        greatest(abs(ln(greatest(a.aspect, 1e-6) / greatest(m.aspect, 1e-6))) + abs(ln(greatest(a.diag, 1e-6) / greatest(m.diag, 1e-6))), abs(ln(greatest(m.aspect, 1e-6) / greatest(b.aspect, 1e-6))) + abs(ln(greatest(m.diag, 1e-6) / greatest(b.diag, 1e-6)))) AS shape
        FROM c m JOIN c a ON a.p = m.p - 1 AND a.rank = m.rank JOIN c b ON b.p = m.p + 1 AND b.rank = m.rank),
    u AS (SELECT *, off / scale AS o, greatest(0, am + mb - greatest(ab, 1)) / scale AS gap, CASE WHEN am > 1e-6 AND mb > 1e-6 THEN greatest(0, -dot / (am * mb)) ELSE 0 END AS back FROM t),
    v AS (SELECT *, (70 * o + 20 * gap + 16 * back + 8 * greatest(0, 1 - stable) + 4 * least(shape, 2.5)) * (0.45 + 0.55 * least(1, log10(greatest(n, 10)) / 4)) AS score,
        CASE WHEN o >= 0.18 AND ab / scale <= 0.35 THEN 'mid_outlier' WHEN greatest(am, mb) / scale >= 0.35 AND abs(am - mb) / scale >= 0.2 THEN 'edge_issue' ELSE 'normal' END AS issue FROM u)
    SELECT CAST(sa AS INTEGER) AS slice_a, CAST(sm AS INTEGER) AS slice_m, CAST(sb AS INTEGER) AS slice_b, CAST(rank AS INTEGER) AS rank, round(score, 5) AS score, issue,
        CASE WHEN issue = 'mid_outlier' AND score >= 22 AND n >= 200 THEN 'flagged' WHEN issue <> 'normal' AND score >= 12 THEN 'watch' ELSE 'normal' END AS status FROM v""",
    "points",
)
def triad_scan(spark, sf_dir):
    return V.triad_scan(_ranked_components(X.points(spark, sf_dir))).select("slice_a", "slice_m", "slice_b", "rank", F.round("score", 5).alias("score"), "issue", "status")


@query(
    "edge_review",
    """WITH c AS (SELECT slice_index, celltype, count(*) AS n, avg(x) AS cx, avg(y) AS cy, stddev_pop(x) AS r FROM points GROUP BY ALL),
    e AS (SELECT a.slice_index AS fixed, a.celltype, a.n AS n_fixed, b.n AS n_moving, sqrt((a.cx - b.cx) ** 2 + (a.cy - b.cy) ** 2) / 20 AS jump, b.r / nullif(a.r, 0) AS ratio FROM c a JOIN c b ON b.slice_index = a.slice_index + 1 AND a.celltype = b.celltype)
    SELECT CAST(fixed AS INTEGER) AS fixed, celltype, CASE WHEN least(n_fixed, n_moving) < 5 THEN 'low_cell_count' ELSE concat_ws(',', CASE WHEN jump >= 1 THEN 'centroid_jump' END, CASE WHEN ratio <= 0.5 OR ratio >= 2 THEN 'radius_ratio_shift' END) END AS flags,
        round((least(jump, 10) * 2 + coalesce(CASE WHEN ratio > 0 THEN abs(log2(ratio)) END, 0) + least(log10(greatest(least(n_fixed, n_moving)::DOUBLE, 1)), 4) * 0.2) * CASE WHEN least(n_fixed, n_moving) < 5 THEN 0.1 ELSE 1 END, 5) AS priority FROM e""",
    "points",
)
def edge_review(spark, sf_dir):
    c = X.points(spark, sf_dir).groupBy("slice_index", "celltype").agg(F.count("*").alias("n"), F.avg("x").alias("cx"), F.avg("y").alias("cy"), F.stddev_pop("x").alias("r"))
    b = c.select((F.col("slice_index") - 1).alias("slice_index"), "celltype", F.col("n").alias("n_moving"), F.col("cx").alias("bx"), F.col("cy").alias("b_y"), F.col("r").alias("br"))
    e = c.withColumnRenamed("n", "n_fixed").join(b, ["slice_index", "celltype"])
    e = e.select(F.col("slice_index").alias("fixed"), "celltype", "n_fixed", "n_moving", (F.hypot(F.col("cx") - F.col("bx"), F.col("cy") - F.col("b_y")) / 20).alias("jump"), F.try_divide("br", "r").alias("ratio"), F.lit(None).cast("double").alias("angle"), F.lit(None).cast("double").alias("sigma2"))
    return V.edge_flags(e, least_cells=5).select("fixed", "celltype", F.array_join("flags", ",").alias("flags"), F.round("priority", 5).alias("priority"))


@query("result_status", "SELECT o_custkey AS result, CASE WHEN bad = n THEN 'failed' WHEN bad > 0 THEN 'partial' WHEN ready = n THEN 'ok' ELSE 'pending' END AS status, ready, bad, n AS entries FROM (SELECT o_custkey, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS ready, count(*) FILTER (o_orderstatus = 'P') AS bad FROM orders GROUP BY ALL)")
def result_status(spark, sf_dir):
    kind = F.when(F.col("o_orderstatus") == "F", "ready").when(F.col("o_orderstatus") == "P", "failed").otherwise("deferred")
    return S.entry_status(X.read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("result"), kind.alias("status")))


# ------------------------------------------------------------------ composites without an SQL form


@query("slice_geometry")
def slice_geometry(spark, sf_dir):
    from slabworks.operators.morphology import slice_geometry as geometry

    return geometry(X.cells(spark, sf_dir))


@query("quality_scores")
def quality_scores(spark, sf_dir):
    scored = quality.score_windows(quality.series_metrics(spark, sf_dir), (5,), quality.series_continuity(spark, sf_dir, (5,)))
    return scored.drop("window")


@query("quality_policy")
def quality_policy(spark, sf_dir):
    return quality.policy(quality.series_metrics(spark, sf_dir), quality.series_continuity(spark, sf_dir))


@query("expression_pca")
def expression_pca(spark, sf_dir):
    from slabworks.operators.morphology import expression_components

    e = X.expression(spark, sf_dir)
    n = e.select("cell_id").distinct().count()
    scores, _ = expression_components(normalized_expression(e), n, 3)
    return scores


@query("quality_window_evidence")
def quality_window_evidence(spark, sf_dir):
    scored = quality.score_windows(quality.series_metrics(spark, sf_dir), continuity=quality.series_continuity(spark, sf_dir))
    return V.tier_verdict(quality.window_evidence(scored), 0.129, 2, 0.65)


@query("series_registration")
def series_registration(spark, sf_dir):
    from slabworks.operators.registration import register_series

    return register_series(X.cells(spark, sf_dir))


@query("tissue_components")
def tissue_components(spark, sf_dir):
    from slabworks.operators.registration import slice_components

    return slice_components(X.cells(spark, sf_dir), 0.05)


# the other modules register themselves
from slabworks.plans import alignment, analysis, assembly, checks, mapping, rescues, selection, workflow  # noqa: E402, F401
