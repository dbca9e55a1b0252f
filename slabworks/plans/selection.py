"""Queries of samples, resolvers and small texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from slabworks.operators import resolvers as V
from slabworks.operators import samples as S
from slabworks.plans.registry import query, r6
from slabworks.sources import fixtures as X


def _h(seed: int) -> str:
    return f"substr(sha1('{seed}|' || cell_id), 1, 16)"


@query(
    "root_stratified_sample",
    f"""WITH n AS (SELECT celltype, count(*) AS n FROM points GROUP BY ALL), t AS (SELECT *, greatest(1, floor(500 * sqrt(n) / sum(sqrt(n)) OVER ()))::BIGINT AS t, sum(n) OVER () AS a FROM n), u AS (SELECT *, 500 - sum(t) OVER () AS l, row_number() OVER (ORDER BY n DESC, celltype) AS o FROM t),
    v AS (SELECT celltype, CASE WHEN a <= 500 THEN n ELSE t + CASE WHEN o <= l THEN 1 ELSE 0 END END AS target FROM u)
    SELECT cell_id, celltype FROM (SELECT p.*, target, row_number() OVER (PARTITION BY celltype ORDER BY {_h(7)}, cell_id) AS r FROM points p JOIN v USING (celltype)) WHERE r <= target""",
    "points",
)
def root_stratified_sample(spark, sf_dir):
    return S.root_stratified(X.points(spark, sf_dir), "celltype", 500, 7).select("cell_id", "celltype")


@query("proportional_sample", f"WITH n AS (SELECT celltype, count(*) AS n FROM points GROUP BY ALL), t AS (SELECT celltype, greatest(1, round_even(300 * n / sum(n) OVER (), 0))::BIGINT AS t FROM n) SELECT cell_id, celltype FROM (SELECT p.*, t, row_number() OVER (PARTITION BY celltype ORDER BY {_h(9)}, cell_id) AS r FROM points p JOIN t USING (celltype)) WHERE r <= t", "points")
def proportional_sample(spark, sf_dir):
    return S.proportional(X.points(spark, sf_dir), "celltype", 300, 9).select("cell_id", "celltype")


@query(
    "label_guaranteed_sample",
    f"""WITH k AS (SELECT slice_index, count(DISTINCT celltype) AS k, count(*) AS n FROM points GROUP BY ALL), f AS (SELECT p.*, k, n, row_number() OVER (PARTITION BY slice_index, celltype ORDER BY {_h(11)}, cell_id) <= greatest(4, least(18, floor(60 / (3 * k)))) AS g FROM points p JOIN k USING (slice_index)),
    o AS (SELECT *, row_number() OVER (PARTITION BY slice_index ORDER BY g DESC, {_h(11)}, cell_id) AS o, sum(g::INT) OVER (PARTITION BY slice_index) AS s FROM f) SELECT cell_id FROM o WHERE n <= 60 OR o <= greatest(60, s)""",
    "points",
)
def label_guaranteed_sample(spark, sf_dir):
    return S.label_guaranteed(X.points(spark, sf_dir), ["slice_index"], "celltype", 60, 11).select("cell_id")


@query(
    "strided_sample",
    """WITH h AS (SELECT *, celltype = 'error' AS h, count(*) OVER (PARTITION BY slice_index) AS n, count(*) FILTER (celltype = 'error') OVER (PARTITION BY slice_index) AS nh FROM points), p AS (SELECT *, row_number() OVER (PARTITION BY slice_index, h ORDER BY cell_id) - 1 AS p FROM h),
    q AS (SELECT *, CASE WHEN h THEN 10 ELSE greatest(0, 50 - least(nh, 10)) END AS room, CASE WHEN h THEN nh ELSE n - nh END AS size FROM p), s AS (SELECT *, CASE WHEN size > room THEN greatest(1, floor(size / greatest(room, 1)))::BIGINT ELSE 1 END AS step FROM q)
    SELECT cell_id FROM s WHERE n <= 50 OR (p % step = 0 AND p / step < room)""",
    "points",
)
def strided_sample(spark, sf_dir):
    return S.strided(X.points(spark, sf_dir).withColumn("hot", F.col("celltype") == "error"), ["slice_index"], "hot", 50, 10).select("cell_id")


@query(
    "display_sample",
    f"""WITH d AS (SELECT *, ln(1 + greatest(total_counts, 0)) AS d FROM points), q AS (SELECT slice_index, quantile_cont(d, 0.02) AS a, quantile_cont(d, 0.98) AS b FROM d GROUP BY ALL)
    SELECT cell_id, round(least(greatest((d - a) / (b - a), 0), 1), 6) AS depth FROM (SELECT *, row_number() OVER (PARTITION BY slice_index ORDER BY {_h(13)}, cell_id) AS r FROM d) JOIN q USING (slice_index) WHERE r <= 30""",
    "points",
)
def display_sample(spark, sf_dir):
    return S.display_sample(X.points(spark, sf_dir), 30, 13).select("cell_id", r6("depth").alias("depth"))


@query("profile_genes", "WITH k AS (SELECT count(DISTINCT slice_index) AS k FROM slice_genes), t AS (SELECT slice_index, sum(value) AS t FROM slice_genes GROUP BY ALL), v AS (SELECT gene, ln(1 + value * 10000.0::DOUBLE / t) AS v FROM slice_genes JOIN t USING (slice_index)), g AS (SELECT gene, round(var_pop(v), 9) AS variance, count(*) AS n FROM v GROUP BY ALL) SELECT gene, variance FROM (SELECT gene, variance, row_number() OVER (ORDER BY variance DESC, gene) AS r FROM g, k WHERE n = k) WHERE r <= 20", "slice_genes")
def profile_genes(spark, sf_dir):
    return S.profile_genes(X.slice_genes(spark, sf_dir), 20)


@query("curve_choice", "SELECT p_partkey AS gene, p_size / 50.0::DOUBLE AS rho FROM part ORDER BY p_size > 45 DESC, abs(p_size / 50.0::DOUBLE) DESC, p_retailprice, p_partkey LIMIT 25")
def curve_choice(spark, sf_dir):
    p = X.read(spark, sf_dir, "part").select(F.col("p_partkey").alias("gene"), (F.col("p_size") / 50.0).alias("rho"), F.col("p_retailprice").alias("q"), (F.col("p_size") > 45).alias("selected"))
    return p.orderBy(F.desc("selected"), F.desc(F.abs("rho")), "q", "gene").limit(25).select("gene", "rho")


@query("suspicious_top", "WITH c AS (SELECT slice_index, celltype, count(*) AS n, stddev_pop(x) AS r FROM points GROUP BY ALL) SELECT CAST(slice_index AS INTEGER) AS slice_index, celltype, round(r, 6) AS priority FROM c ORDER BY round(r, 6) DESC, slice_index, celltype LIMIT 50", "points")
def suspicious_top(spark, sf_dir):
    c = X.points(spark, sf_dir).groupBy("slice_index", "celltype").agg(r6(F.stddev_pop("x")).alias("priority"))
    return c.orderBy(F.desc("priority"), "slice_index", "celltype").limit(50)


@query("slice_labels", "WITH k AS (SELECT count(DISTINCT slice_index) AS k, count(*) AS n FROM points) SELECT cell_id, CASE WHEN celltype = 'error' THEN 'error' WHEN k > 1 AND k <= greatest(500, 4 * floor(sqrt(n))) THEN 'z' || regexp_replace(printf('%.6f', slice_index * 0.5), '\\.?0+$', '') ELSE 'file' END AS slice_label FROM points, k", "points")
def slice_labels(spark, sf_dir):
    p = X.points(spark, sf_dir).withColumn("z", F.col("slice_index") * 0.5).withColumn("section", F.when(F.col("celltype") == "error", "error"))
    return V.slice_labels(p, ("section", "slide"), "file").select("cell_id", "slice_label")


@query("mito_genes", "WITH g AS (SELECT DISTINCT CASE p_partkey % 6 WHEN 0 THEN 'MT-' WHEN 1 THEN 'mt_' WHEN 2 THEN 'Mito-' WHEN 3 THEN 'mtx' WHEN 4 THEN 'x-mt-' ELSE '' END || p_name AS gene FROM part) SELECT gene, regexp_matches(lower(gene), '^(mt[-.:_]|mito-)') AS mito FROM g")
def mito_genes(spark, sf_dir):
    before = F.element_at(F.array(*map(F.lit, ("MT-", "mt_", "Mito-", "mtx", "x-mt-", ""))), (F.col("p_partkey") % 6 + 1).cast("int"))
    return X.read(spark, sf_dir, "part").select(F.concat(before, "p_name").alias("gene")).distinct().withColumn("mito", V.is_mito(F.col("gene")))


@query("mito_share", "WITH m AS (SELECT median(x) AS m FROM points) SELECT cell_id, round(CASE WHEN m > 1.5 THEN x / 100 ELSE x END, 9) AS pct_mito FROM points, m", "points")
def mito_share(spark, sf_dir):
    return V.mito_share(X.points(spark, sf_dir).withColumn("pct_mito", F.col("x"))).select("cell_id", F.round("pct_mito", 9).alias("pct_mito"))


@query("capture_available", "SELECT CAST(slice_index AS INTEGER) AS slice_index, CASE WHEN any_value(slice_index) % 3 > 0 THEN round(median(total_counts), 6) END AS median_total_counts, count(*) AS n FROM points GROUP BY slice_index", "points")
def capture_available(spark, sf_dir):
    s = X.points(spark, sf_dir).groupBy("slice_index").agg(r6(F.percentile("total_counts", F.lit(0.5))).alias("median_total_counts"), F.count("*").alias("n"))
    return V.capture_available(s.withColumn("capture_available", F.col("slice_index") % 3 > 0)).drop("capture_available")


@query("ground_truth", "SELECT o_orderkey, lower(trim(CASE o_orderkey % 4 WHEN 0 THEN 'TRUE' WHEN 1 THEN ' y' WHEN 2 THEN '0' ELSE o_orderstatus END)) IN ('1', 'true', 'yes', 'y', 't') AS bad, lower(trim(CASE WHEN o_orderkey % 2 = 0 THEN ' Yes ' ELSE 'no' END)) IN ('1', 'true', 'yes', 'y', 't') AS damaged FROM orders")
def ground_truth(spark, sf_dir):
    o = X.read(spark, sf_dir, "orders")
    return o.select("o_orderkey", V.truth(F.coalesce(F.element_at(F.array(F.lit("TRUE"), F.lit(" y"), F.lit("0"), F.lit(None).cast("string")), (F.col("o_orderkey") % 4 + 1).cast("int")), "o_orderstatus")).alias("bad"), V.truth(F.when(F.col("o_orderkey") % 2 == 0, " Yes ").otherwise("no")).alias("damaged"))


@query("count_semantics", "SELECT o_custkey, count(*) AS files, CASE WHEN bool_and(o_orderstatus = 'F') THEN 'all_count_like' WHEN NOT bool_or(o_orderstatus = 'F') THEN 'none_count_like' ELSE 'mixed' END AS semantics FROM orders GROUP BY ALL")
def count_semantics(spark, sf_dir):
    return V.count_semantics(X.read(spark, sf_dir, "orders").withColumn("f", F.col("o_orderstatus") == "F"), "o_custkey", "f")


@query(
    "source_contracts",
    "WITH t AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'obs:' || p_brand WHEN 1 THEN 'obsm:spatial[:,' || p_size || ']' WHEN 2 THEN 'layer:counts' ELSE p_brand END AS t FROM part) SELECT p_partkey, nullif(regexp_extract(t, '^(obs|obsm|layer):([^\\[]+)(?:\\[:,\\s*(\\d+)\\])?$', 1), '') AS place, nullif(regexp_extract(t, '^(obs|obsm|layer):([^\\[]+)(?:\\[:,\\s*(\\d+)\\])?$', 2), '') AS name, CAST(nullif(regexp_extract(t, '^(obs|obsm|layer):([^\\[]+)(?:\\[:,\\s*(\\d+)\\])?$', 3), '') AS INTEGER) AS axes FROM t",
)
def source_contracts(spark, sf_dir):
    p = X.read(spark, sf_dir, "part")
    k = F.col("p_partkey") % 4
    text = F.when(k == 0, F.concat(F.lit("obs:"), "p_brand")).when(k == 1, F.concat(F.lit("obsm:spatial[:,"), "p_size", F.lit("]"))).when(k == 2, "layer:counts").otherwise(F.col("p_brand"))
    return p.select("p_partkey", V.source_contract(text).alias("c")).select("p_partkey", "c.place", "c.name", "c.axes")


@query("category_selections", "SELECT * FROM (SELECT 'front' AS name, count(*) FILTER (celltype IN ('click', 'view')) AS points, count(*) FILTER (celltype IN ('click', 'view')) >= 100 AS ok FROM points UNION ALL SELECT 'back', count(*) FILTER (celltype IN ('error', 'nothing')), count(*) FILTER (celltype IN ('error', 'nothing')) >= 100 FROM points UNION ALL SELECT 'none', count(*) FILTER (celltype = 'nothing'), count(*) FILTER (celltype = 'nothing') >= 100 FROM points)", "points")
def category_selections(spark, sf_dir):
    return V.category_selections(X.points(spark, sf_dir), "celltype", ["front=click|view", "back=error|nothing", "none=nothing"], 100)


@query("group_subset", "SELECT cell_id, celltype FROM points WHERE celltype IN ('click', 'error')", "points")
def group_subset(spark, sf_dir):
    return V.group_subset(X.points(spark, sf_dir), "celltype", ["click", "error"]).select("cell_id", "celltype")


@query("displacement_feature", "SELECT vec_id AS cell_id, round(sqrt(list_sum(list_transform(embedding, lambda v: v::DOUBLE * v::DOUBLE))), 4) AS length, round(sqrt(embedding[1]::DOUBLE ** 2 + embedding[2]::DOUBLE ** 2 + embedding[3]::DOUBLE ** 2), 6) AS moved FROM embeddings")
def displacement_feature(spark, sf_dir):
    e = X.read(spark, sf_dir, "embeddings").withColumn("v", F.transform("embedding", lambda v: v.cast("double")))
    e = e.withColumns({a: F.lit(0.0) for a in "xyz"} | {f"m{a}": F.get("v", F.lit(i)) for i, a in enumerate("xyz")})
    return e.select(F.col("vec_id").alias("cell_id"), F.round(V.displacement(e, vector="v"), 4).alias("length"), r6(V.displacement(e, mapped=("mx", "my", "mz"))).alias("moved"))


@query("id_digests", "SELECT CAST(slice_index AS INTEGER) AS slice_index, sha256('[' || string_agg('\"' || cell_id || '\"', ',' ORDER BY cell_id::VARCHAR) || ']') AS digest FROM points GROUP BY ALL", "points")
def id_digests(spark, sf_dir):
    return V.sorted_id_digest(X.points(spark, sf_dir), ["slice_index"], "cell_id")


@query(
    "evidence_texts",
    """WITH e AS (SELECT slice_index, median(x) AS v, lag(median(x)) OVER (ORDER BY slice_index) AS e FROM points GROUP BY slice_index),
    f AS (SELECT *, CASE WHEN abs(v) >= 1000 THEN format('{:,.0f}', round(v, 0)) WHEN abs(v) >= 10 THEN printf('%.1f', round(v, 1)) ELSE printf('%.3f', round(v, 3)) END AS tv, CASE WHEN abs(e) >= 1000 THEN format('{:,.0f}', round(e, 0)) WHEN abs(e) >= 10 THEN printf('%.1f', round(e, 1)) ELSE printf('%.3f', round(e, 3)) END AS te FROM e)
    SELECT CAST(slice_index AS INTEGER) AS slice_index, CASE WHEN e IS NULL THEN 'counts: no comparison' ELSE 'counts is ' || tv || ', ' || printf('%.0f', round(abs((v - e) / abs(e) * 100), 0)) || '% ' || CASE WHEN v < e THEN 'below' ELSE 'above' END || ' ' || te END AS text FROM f""",
    "points",
)
def evidence_texts(spark, sf_dir):
    from pyspark.sql import Window

    m = X.points(spark, sf_dir).groupBy("dataset_id", "slice_index").agg(F.percentile("x", F.lit(0.5)).alias("v"))
    e = m.withColumn("e", F.lag("v").over(Window.partitionBy("dataset_id").orderBy("slice_index")))
    return e.select("slice_index", V.evidence_text(F.lit("counts"), F.col("v"), F.col("e")).alias("text"))


@query("palette", "WITH l AS (SELECT DISTINCT celltype AS label FROM points), o AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS i, count(*) OVER () AS n FROM l) SELECT label, CASE WHEN label = 'error' THEN '#ff0000' ELSE 'hsl(' || CAST(floor(i * 360 / n) AS INTEGER) || ',65%,50%)' END AS colour FROM o", "points")
def palette(spark, sf_dir):
    return V.palette(X.points(spark, sf_dir), "celltype", {"error": "#ff0000"})


@query("set_equality", "SELECT (SELECT count(*) FROM (SELECT DISTINCT celltype FROM points EXCEPT SELECT DISTINCT event_type FROM events)) AS only_left, (SELECT count(*) FROM (SELECT event_type FROM events EXCEPT SELECT celltype FROM points WHERE celltype <> 'error')) AS only_right", "points")
def set_equality(spark, sf_dir):
    left = X.points(spark, sf_dir).select(F.col("celltype").alias("label"), F.lit(True).alias("left"), F.coalesce(F.col("celltype") != "error", F.lit(False)).alias("kept"), F.lit(False).alias("right"))
    right = X.read(spark, sf_dir, "events").select(F.col("event_type").alias("label"), F.lit(False).alias("left"), F.lit(False).alias("kept"), F.lit(True).alias("right"))
    labels = left.union(right).groupBy("label").agg(*[F.bool_or(c).alias(c) for c in ("left", "kept", "right")])  # no join: Spark's EXCEPT joins all rows before it drops repetitions
    return labels.agg(F.count_if(F.col("left") & ~F.col("right")).alias("only_left"), F.count_if(F.col("right") & ~F.col("kept")).alias("only_right"))


@query("settings_json", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, '{\"id\":' || event_id || ',\"k\":' || json_extract_string(props, '$.k') || '}' AS packed FROM events")
def settings_json(spark, sf_dir):
    e = X.read(spark, sf_dir, "events").withColumn("p", F.from_json("props", "k bigint"))
    return e.select("event_id", F.col("p.k").alias("k"), F.to_json(F.struct(F.col("event_id").alias("id"), F.col("p.k").alias("k"))).alias("packed"))


@query("stage_frames", "SELECT celltype, count(*) AS n, round(min(x), 6) AS x_least, round(max(x), 6) AS x_most, round(avg(x), 6) AS x_mean, round(avg(y), 6) AS y_mean, count(DISTINCT slice_index) AS slices FROM points GROUP BY ALL", "points")
def stage_frames(spark, sf_dir):
    return X.points(spark, sf_dir).groupBy("celltype").agg(F.count("*").alias("n"), r6(F.min("x")).alias("x_least"), r6(F.max("x")).alias("x_most"), r6(F.avg("x")).alias("x_mean"), r6(F.avg("y")).alias("y_mean"), F.countDistinct("slice_index").alias("slices"))
