"""Summaries over calls, features and fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slabworks.functions.columns import lit
from slabworks.operators.relational import numbered

#: Groups of evidence that an exclusion is reported under: fixed values.
EVIDENCE_GROUPS = {
    "expression_capture": ("median_total_counts", "median_n_genes", "detected_gene_fraction", "library_complexity", "zero_fraction"),
    "tissue_amount": ("cell_density", "n_locations"),
    "fragmentation": ("fragmentation", "largest_component_fraction"),
    "expression_continuity": ("expression_profile", "celltype_composition"),
    "regional_low_capture": ("local_low_depth_fraction", "regional_low_depth_cluster_fraction"),
    "damage": ("median_pct_mito",),
}


#: Rows of a stretch of a ranking that one task goes through in order.
STRETCH = 65_536


def benjamini_hochberg(tests: DataFrame, family: list[str], p: str = "p", key: str = "gene") -> DataFrame:
    """Adds q: the false discovery rate at which a test would be called, within its family; missing p values count as 1.

    Tests are ranked over all tasks, and the least value from a test on is that of its stretch and of the later ones:
    a family of any size is never brought to one task.  No family columns: all tests are one.
    """
    value = F.coalesce(F.col(p), lit(1))
    placed = numbered(tests.withColumn("_p", value), [*family, "_p", key], "_i")
    sizes = placed.groupBy(*family).agg(F.min("_i").alias("_first"), F.count("*").alias("_n"))
    placed = placed.join(sizes, family) if family else placed.crossJoin(F.broadcast(sizes))  # one row
    placed = placed.withColumn("_q", F.col("_p") * F.col("_n") / (F.col("_i") - F.col("_first") + 1)).withColumn("_s", F.floor(F.col("_i") / STRETCH))
    later = Window.partitionBy(*family).orderBy(F.desc("_s")).rowsBetween(Window.unboundedPreceding, -1)  # a row a stretch
    beyond = placed.groupBy(*family, "_s").agg(F.min("_q").alias("_m")).select(*family, "_s", F.min("_m").over(later).alias("_later"))
    own = Window.partitionBy(*family, "_s").orderBy(F.desc("_i")).rowsBetween(Window.unboundedPreceding, 0)
    out = placed.withColumn("_own", F.min("_q").over(own)).join(beyond, [*family, "_s"])
    return out.withColumn("q", F.least(lit(1), "_own", "_later")).select(*tests.columns, "q")


def spearman(rows: DataFrame, by: list[str], x: str, y: str) -> DataFrame:
    """(by, n, rho): correlation of average ranks; NULL where either doesn't vary.  Ranks are places over all tasks."""
    known = rows.select(*by, F.col(x).alias("_x"), F.col(y).alias("_y")).where("_x is not null and _y is not null")
    for c in ("_x", "_y"):
        placed = numbered(known, [*by, c], "_i")
        ranks = placed.groupBy(*by, c).agg((F.min("_i") + (F.count("*") - 1) / 2).alias(f"_rank{c}"))
        known = placed.drop("_i").join(ranks, [*by, c])  # a group's first place changes no correlation
    rho = F.try_divide(F.covar_pop("_rank_x", "_rank_y"), F.stddev_pop("_rank_x") * F.stddev_pop("_rank_y"))
    return known.groupBy(*by).agg(F.count("*").alias("n"), rho.alias("rho"))


def field_report(rows: DataFrame, raw: str, fitted: str) -> DataFrame:
    """One row: median cosine and root mean square error of fitted vectors, and quantiles (0, 0.5, 0.95, 1) of both lengths."""
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda u, v: u * v), lit(0), lambda acc, t: acc + t)
    each = rows.select(dot(raw, fitted).alias("d"), F.sqrt(dot(raw, raw)).alias("lr"), F.sqrt(dot(fitted, fitted)).alias("lf"), F.size(raw).alias("k"), F.aggregate(F.zip_with(raw, fitted, lambda u, v: (u - v) * (u - v)), lit(0), lambda acc, t: acc + t).alias("e"))
    q = lambda c: F.percentile(c, F.array(*[lit(x) for x in (0, 0.5, 0.95, 1)]))
    return each.agg(F.percentile(F.col("d") / F.greatest(F.col("lr") * F.col("lf"), lit(1e-12)), lit(0.5)).alias("median_cosine"), F.sqrt(F.sum("e") / F.sum("k")).alias("rmse"), q("lr").alias("raw_lengths"), q("lf").alias("fitted_lengths"))


def paired_calls(before: DataFrame, after: DataFrame, injected: DataFrame) -> DataFrame:
    """Each slice's calls without and with made-up defects: (dataset_id, slice_index, ..., injected, suspicious, detected, newly, worsened, gain).

    Calls must pair one to one; a slice on one side only is an error when it is read.
    """
    keys = ["dataset_id", "slice_index"]
    side = lambda d, t: d.select(*keys, F.col("score").alias(f"score_{t}"), F.col("recommendation").alias(f"call_{t}"))
    both = side(before, "0").join(side(after, "1"), keys, "full_outer").join(injected.select(*keys).distinct().withColumn("injected", F.lit(True)), keys, "left")
    paired = F.col("call_0").isNotNull() & F.col("call_1").isNotNull()
    both = both.withColumn("call_0", F.when(paired, F.col("call_0")).otherwise(F.raise_error(F.lit("calls don't pair"))))
    rank = lambda c: F.when(F.col(c) == "exclude", 2).when(F.col(c) == "review", 1).otherwise(0)
    suspicious, detected = F.col("call_0") != "keep", F.col("call_1") != "keep"
    return both.withColumns({"injected": F.coalesce("injected", F.lit(False)), "suspicious": suspicious, "detected": detected, "newly": ~suspicious & detected, "worsened": rank("call_1") > rank("call_0"), "gain": F.col("score_1") - F.col("score_0")})


def paired_summary(paired: DataFrame) -> DataFrame:
    """One row of counts over paired_calls."""
    i, clean = F.col("injected"), ~F.col("suspicious")
    rate = lambda a, b: F.when(F.count_if(b) > 0, F.count_if(a & b) / F.count_if(b))
    return paired.agg(
        F.count_if(i).alias("injected"), F.count_if(i & F.col("detected")).alias("detected"), F.coalesce(rate(F.col("detected"), i), lit(0)).alias("detection_rate"), F.count_if(i & ~clean).alias("suspicious_before"), F.count_if(i & clean).alias("clean_before"),
        F.count_if(i & F.col("newly")).alias("newly"), rate(F.col("newly"), i & clean).alias("new_rate"), F.count_if(i & (F.col("gain") > 0)).alias("score_rose"), F.percentile(F.when(i, F.col("gain")), lit(0.5)).alias("median_gain"), F.count_if(i & F.col("worsened")).alias("worsened"),
        F.count_if(~i & F.col("newly")).alias("others_newly"), F.count_if(~clean).alias("nonkeep_before"), F.count_if(F.col("detected")).alias("nonkeep_after"),
    )


def evidence_groups(excluded: DataFrame, least: float = 0.45) -> DataFrame:
    """(group, slices, percent, names) of excluded slices with an anomaly of at least ``least`` in a group's metrics; groups without one have 0.

    excluded(slice_index, <metric>_anomaly...) may lack metrics.
    """
    total = excluded.agg(F.count("*").alias("total"))
    found = []
    for name, metrics in EVIDENCE_GROUPS.items():
        have = [F.coalesce(F.col(f"{m}_anomaly"), lit(0)) for m in metrics if f"{m}_anomaly" in excluded.columns]
        found.append(F.struct(F.lit(name).alias("group"), (F.greatest(*have, lit(0)) >= least if have else F.lit(False)).alias("hit")))
    rows = excluded.select("slice_index", F.explode(F.array(*found)).alias("g")).select("slice_index", "g.*")
    per = rows.groupBy("group").agg(F.count_if("hit").alias("slices"), F.array_join(F.array_sort(F.collect_list(F.when(F.col("hit"), F.lpad(F.col("slice_index").cast("string"), 4, "0")))), ",").alias("names"))
    return per.crossJoin(F.broadcast(total)).select("group", "slices", (F.col("slices") * 100.0 / F.greatest("total", F.lit(1))).alias("percent"), "names")  # one row


def quartile_text(rows: DataFrame, by: list[str], metrics: list[str]) -> DataFrame:
    """(by, metric, text): ``median [Q1, Q3]`` with one decimal."""
    long = rows.select(*by, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(by, metrics, "metric", "value")
    q = F.percentile("value", F.array(lit(0.25), lit(0.5), lit(0.75)))
    out = long.groupBy(*by, "metric").agg(q.alias("q"))
    n = lambda i: F.format_string("%.1f", F.round(F.get("q", F.lit(i)), 1))
    return out.select(*by, "metric", F.when(F.col("q").isNotNull(), F.concat(n(1), F.lit(" ["), n(0), F.lit(", "), n(2), F.lit("]"))).alias("text"))


def block_coverage(points: DataFrame, hit: Column, shape: tuple[int, int, int] = (6, 6, 3), least: int = 30) -> DataFrame:
    """(block, cells, coverage, supported) over equal blocks of the points' box; blocks with fewer than ``least`` cells aren't supported."""
    box = points.agg(*[f(a).alias(f"{a}{i}") for a in "xyz" for i, f in (("0", F.min), ("1", F.max))])
    part = lambda a, k: F.least(F.floor((F.col(a) - F.col(f"{a}0")) / F.greatest(F.col(f"{a}1") - F.col(f"{a}0"), lit(1e-12)) * k), F.lit(k - 1))
    block = (part("x", shape[0]) * shape[1] + part("y", shape[1])) * shape[2] + part("z", shape[2])
    out = points.withColumn("_hit", hit.cast("double")).crossJoin(F.broadcast(box)).groupBy(block.cast("int").alias("block")).agg(F.count("*").alias("cells"), F.avg("_hit").alias("coverage"))  # one row
    return out.withColumn("supported", F.col("cells") >= least)
