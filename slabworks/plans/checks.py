"""Queries that hold tables against rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from slabworks.functions.columns import lit
from slabworks.operators import validators as V
from slabworks.plans.registry import query
from slabworks.sources import fixtures as X


def rules(*pairs: tuple[str, str], source: str, by: str = "") -> str:
    """SQL of a rule table: a row for each (rule, failures)."""
    comma = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    return " UNION ALL ".join(f"SELECT {comma}'{name}' AS rule, CAST({count} AS BIGINT) AS failed, ({count}) = 0 AS ok FROM {source}{group}" for name, count in pairs)


_FINITE = "NOT (x IS NOT NULL AND y IS NOT NULL AND isfinite(x) AND isfinite(y))"
_FINITE3 = "NOT (x IS NOT NULL AND y IS NOT NULL AND z IS NOT NULL AND isfinite(x) AND isfinite(y) AND isfinite(z))"
_REPEATS = "count(*) - count(DISTINCT cell_id)"


@query(
    "alignment_preflight",
    "WITH s AS (SELECT dataset_id, slice_index, count(DISTINCT z) AS k, min(z) AS z FROM cells GROUP BY ALL), t AS (SELECT *, lag(z) OVER (PARTITION BY dataset_id ORDER BY slice_index) AS b FROM s) "
    + rules(("two_slices", "CASE WHEN count(DISTINCT slice_index) < 2 THEN 1 ELSE 0 END"), ("unique_ids", _REPEATS), ("finite_xy", f"count(*) FILTER ({_FINITE})"), source="cells", by="dataset_id")
    + " UNION ALL "
    + rules(("constant_z", "count(*) FILTER (k <> 1)"), ("rising_z", "count(*) FILTER (z <= b)"), source="t", by="dataset_id"),
    "cells",
)
def alignment_preflight(spark, sf_dir):
    return V.alignment_preflight(X.cells(spark, sf_dir))


@query(
    "slice_inspection",
    "WITH b AS (SELECT dataset_id, slice_index, CASE WHEN cell_id % 70 <> 0 THEN x END AS x, y, CASE WHEN slice_index % 4 <> 1 OR cell_id % 3 <> 0 THEN (CASE WHEN slice_index < 4 THEN slice_index // 2 ELSE slice_index END)::DOUBLE END AS z FROM cells), s AS (SELECT dataset_id, slice_index, count(*) FILTER (x IS NULL OR y IS NULL) AS f, count(*) - count(z) AS w, median(z) AS z FROM b GROUP BY ALL), t AS (SELECT *, count(*) OVER (PARTITION BY dataset_id, z) - 1 AS o FROM s) "
    + " UNION ALL ".join(f"SELECT dataset_id, slice_index, '{n}' AS rule, CAST({c} AS BIGINT) AS failed, {c} = 0 AS ok FROM t" for n, c in (("finite_xy", "f"), ("whole_z", "w"), ("own_z", "o"))),
    "cells",
)
def slice_inspection(spark, sf_dir):
    shared = F.when(F.col("slice_index") < 4, F.floor(F.col("slice_index") / 2)).otherwise(F.col("slice_index")).cast("double")  # pairs of slices at one z
    bad = {"x": F.when(F.col("cell_id") % 70 != 0, F.col("x")), "z": F.when((F.col("slice_index") % 4 != 1) | (F.col("cell_id") % 3 != 0), shared)}
    return V.slice_inspection(X.cells(spark, sf_dir).withColumns(bad))


@query(
    "matrix_rules",
    "WITH c AS (SELECT DISTINCT o_custkey AS cell_id FROM orders), p AS (SELECT cell_id, sum(value) AS t, count(*) AS k, max(value) AS top FROM expression GROUP BY ALL), q AS (SELECT c.cell_id, t, k, top FROM c LEFT JOIN p USING (cell_id)) "
    + rules(("large_enough", "CASE WHEN least(count(DISTINCT cell_id), count(DISTINCT gene)) < 3 THEN 1 ELSE 0 END"), ("finite", "count(*) FILTER (value IS NULL)"), ("non_negative", "count(*) FILTER (value < 0)"), ("whole_numbers", "count(*) FILTER (value <> round(value))"), source="expression")
    + " UNION ALL "
    + rules(("positive_totals", "count(*) FILTER (t IS NULL OR t <= 0)"), ("not_one_hot", "CASE WHEN bool_and(k = 1 AND top = 1) THEN 1 ELSE 0 END"), source="q"),
    "expression",
)
def matrix_rules(spark, sf_dir):
    return V.matrix_rules(X.expression(spark, sf_dir), X.read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("cell_id")))


@query(
    "score_rules",
    "WITH a AS (SELECT var_pop(x) AS va, var_pop(y) AS vb, covar_pop(x, y) AS vab, count(*) FILTER (x IS NULL OR y IS NULL) AS f, count(*) FILTER (x = 0 AND y = 0) AS z, bool_and(x IN (0, 1) AND y IN (0, 1) AND x + y <= 1) AS h FROM (SELECT CASE WHEN cell_id % 50 = 0 THEN 0 WHEN cell_id % 77 <> 3 THEN x END AS x, CASE WHEN cell_id % 50 = 0 THEN 0 WHEN cell_id % 77 <> 3 THEN 2 * x END AS y FROM cells)) "
    + " UNION ALL ".join(f"SELECT '{n}' AS rule, CAST({c} AS BIGINT) AS failed, ({c}) = 0 AS ok FROM a" for n, c in (("finite", "f"), ("no_zero_rows", "z"), ("varies", "CASE WHEN va <= 0 OR vb <= 0 THEN 1 ELSE 0 END"), ("rank_two", "CASE WHEN va * vb - vab * vab <= 1e-12 * va * vb THEN 1 ELSE 0 END"), ("not_one_hot", "CASE WHEN h THEN 1 ELSE 0 END"))),
    "cells",
)
def score_rules(spark, sf_dir):
    x = F.when(F.col("cell_id") % 50 == 0, lit(0)).when(F.col("cell_id") % 77 != 3, F.col("x"))  # rows of zeros, missing ones, and a second score that is the first
    return V.score_rules(X.cells(spark, sf_dir).withColumns({"x": x, "y": x * 2}), "x", "y")


@query(
    "clean_rules",
    "WITH dirty AS (SELECT CASE WHEN cell_id % 83 = 0 THEN 'row:' || cell_id WHEN cell_id % 71 = 0 THEN (cell_id + 1)::VARCHAR ELSE cell_id::VARCHAR END AS cell_id, CASE WHEN cell_id % 97 = 0 THEN NULL ELSE x END AS x, y, CASE cell_id % 89 WHEN 0 THEN 'None' WHEN 1 THEN NULL ELSE celltype END AS celltype FROM points) "
    + rules(("finite_xyz", "count(*) FILTER (x IS NULL OR y IS NULL)"), ("no_row_index_ids", "count(*) FILTER (regexp_matches(CAST(cell_id AS VARCHAR), '^.+:\\d+$'))"), ("sound_labels", "count(*) FILTER (celltype IS NULL OR lower(celltype) IN ('nan', 'none', 'null', ''))"), ("unique_ids", _REPEATS), ("row_count", "abs(count(*) - 10000)"), source="dirty"),
    "points",
)
def clean_rules(spark, sf_dir):
    p = X.points(spark, sf_dir).withColumn("z", lit(0))
    i, own = F.col("cell_id"), F.col("cell_id").cast("string")
    dirty = {"cell_id": F.when(i % 83 == 0, F.concat(F.lit("row:"), own)).when(i % 71 == 0, (i + 1).cast("string")).otherwise(own), "x": F.when(i % 97 != 0, F.col("x")), "celltype": F.when(i % 89 == 0, "None").when(i % 89 != 1, F.col("celltype"))}
    return V.clean_rules(p.withColumns(dirty), 10000)


@query(
    "stage_rules",
    f"""WITH m AS (SELECT dataset_id, covar_samp(x, x) AS xx, covar_samp(y, y) AS yy, covar_samp(z, z) AS zz, covar_samp(x, y) AS xy, covar_samp(x, z) AS xz, covar_samp(y, z) AS yz FROM cells GROUP BY ALL),
    d AS (SELECT *, xx * (yy * zz - yz * yz) - xy * (xy * zz - yz * xz) + xz * (xy * yz - yy * xz) AS det FROM m),
    t AS (SELECT cell_id, sum(value) AS t FROM expression GROUP BY ALL), e AS (SELECT dataset_id, t FROM cells LEFT JOIN t USING (cell_id)) """
    + rules(("unique_ids", _REPEATS), ("finite_xyz", f"count(*) FILTER ({_FINITE3})"), source="cells", by="dataset_id")
    + " UNION ALL SELECT dataset_id, 'three_dimensions', CAST(CASE WHEN det <= 1e-12 * xx * yy * zz THEN 1 ELSE 0 END AS BIGINT), NOT det <= 1e-12 * xx * yy * zz FROM d UNION ALL "
    + rules(("counts", "0"), ("no_empty_library", "count(*) FILTER (coalesce(t, 0) <= 0)"), source="e", by="dataset_id"),
    "cells expression",
)
def stage_rules(spark, sf_dir):
    return V.stage_rules(X.cells(spark, sf_dir), X.expression(spark, sf_dir))


@query("cloud_rules", "WITH a AS (SELECT count(*) AS n, count(*) FILTER (NOT (isfinite(x) AND isfinite(y) AND isfinite(z))) AS f, stddev_pop(x) AS sx, stddev_pop(y) AS sy, stddev_pop(z) AS sz FROM cells) SELECT 'points' AS rule, CAST(CASE WHEN n = 0 THEN 1 ELSE 0 END AS BIGINT) AS failed, n > 0 AS ok FROM a UNION ALL SELECT 'finite_xyz', f, f = 0 FROM a UNION ALL SELECT 'volume', CAST(CASE WHEN least(sx, sy, sz) <= 1e-12 THEN 1 ELSE 0 END AS BIGINT), least(sx, sy, sz) > 1e-12 FROM a", "cells")
def cloud_rules(spark, sf_dir):
    return V.cloud_rules(X.cells(spark, sf_dir))


@query(
    "marginal_rules",
    """WITH w AS (SELECT c_nationkey AS i, c_custkey % 5 AS j, count(*)::DOUBLE AS n FROM customer GROUP BY ALL), p AS (SELECT i, j, n / sum(n) OVER () AS w FROM w),
    a AS (SELECT i, sum(w) AS s FROM p GROUP BY i), b AS (SELECT j, sum(w) AS s FROM p GROUP BY j)
    SELECT 'non_negative' AS rule, count(*) FILTER (w < 0) AS failed, count(*) FILTER (w < 0) = 0 AS ok FROM p
    UNION ALL SELECT 'i_sums', count(*) FILTER (abs(s - 1.0::DOUBLE / 25) > 0.0001 / 25) + 25 - count(*), count(*) FILTER (abs(s - 1.0::DOUBLE / 25) > 0.0001 / 25) + 25 - count(*) = 0 FROM a
    UNION ALL SELECT 'j_sums', count(*) FILTER (abs(s - 1.0::DOUBLE / 5) > 0.0001 / 5) + 5 - count(*), count(*) FILTER (abs(s - 1.0::DOUBLE / 5) > 0.0001 / 5) + 5 - count(*) = 0 FROM b""",
)
def marginal_rules(spark, sf_dir):
    w = X.read(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("i"), (F.col("c_custkey") % 5).alias("j")).agg(F.count("*").alias("n"))
    total = w.agg(F.sum("n").alias("t"))
    plan = w.crossJoin(F.broadcast(total)).select("i", "j", (F.col("n") / F.col("t")).alias("w"))  # one row
    return V.marginal_rules(plan, 25, 5)


@query("feature_id_rules", "SELECT 'unique_ids' AS rule, CAST(sum(n - 1) AS BIGINT) AS failed, sum(n - 1) = 0 AS ok FROM (SELECT p_brand, count(*) AS n FROM (SELECT DISTINCT p_name, p_brand FROM part) GROUP BY ALL)")
def feature_id_rules(spark, sf_dir):
    genes = X.read(spark, sf_dir, "part").select(F.col("p_name").alias("gene"), F.col("p_brand").alias("new_id")).distinct()
    return V.feature_ids(genes)[0]


@query(
    "representation_rules",
    """WITH p AS (SELECT DISTINCT event_type AS l, length(event_type) AS v FROM events), a AS (SELECT count(*) FILTER (n > 1) AS f FROM (SELECT l, count(*) AS n FROM p GROUP BY ALL)), b AS (SELECT count(*) FILTER (n > 1) AS f FROM (SELECT v, count(*) AS n FROM p GROUP BY ALL))
    SELECT 'one_vector' AS rule, f AS failed, f = 0 AS ok FROM a UNION ALL SELECT 'own_vector', f, f = 0 FROM b""",
)
def representation_rules(spark, sf_dir):
    return V.representation_rules(X.read(spark, sf_dir, "events").select(F.col("event_type").alias("celltype"), F.array(F.length("event_type")).alias("rep")))
