"""Rule tables: each validator returns (rule, failed, ok), or the same by group, computed in a pass or two.

Nothing is raised: callers stop on a rule that isn't ok.  Rules over settings, which are few, are plain functions that
list what is wrong.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slabworks.functions.columns import lit
from slabworks.operators.relational import rule_table

#: Columns that must not come with clean coordinates: fixed values.
FORBIDDEN = ("gene", "expression", "counts", "matrix", "embedding")
CLEAN_HEADER = ("cell_id", "slice_id", "sl_number", "celltype", "x", "y", "z", "changed", "operation")
TOLERANCE = 1e-6


def number(c: Column | str) -> Column:
    """Whether a value is there and finite."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < lit(float("inf")))


def unfolded(one: DataFrame, by: list[str], names: list[str]) -> DataFrame:
    """(by, rule, failed, ok) from a row with a count of failures for each rule."""
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).cast("long").alias("failed")) for n in names])
    return one.select(*by, F.explode(pairs).alias("r")).select(*by, "r.rule", "r.failed", (F.col("r.failed") == 0).alias("ok"))


def _repeats(rows: DataFrame, key: str, by: list[str], name: str) -> DataFrame:
    """Ids beyond the first of each value, and missing or empty ones."""
    n = rows.groupBy(*by, key).agg(F.count("*").alias("n"))
    bad = F.col("n") - F.when(F.col(key).isNull() | (F.col(key).cast("string") == ""), F.lit(0)).otherwise(F.lit(1))
    return n.groupBy(*by).agg(F.sum(bad).alias(name))


def alignment_preflight(cells: DataFrame) -> DataFrame:
    """(dataset_id, rule, failed, ok) of series about to be aligned: slices, ids, coordinates, a constant z a slice that rises with the order."""
    by = ["dataset_id"]
    main = cells.groupBy(*by).agg(F.when(F.countDistinct("slice_index") < 2, F.lit(1)).otherwise(F.lit(0)).alias("two_slices"), F.count_if(~(number("x") & number("y"))).alias("finite_xy"))
    slices = cells.groupBy(*by, "slice_index").agg(F.countDistinct("z").alias("kinds"), F.min("z").alias("z"), F.count_if(~number("z")).alias("lost"))
    before = F.lag("z").over(Window.partitionBy(*by).orderBy("slice_index"))
    slices = slices.withColumn("before", before).groupBy(*by).agg(F.count_if((F.col("kinds") != 1) | (F.col("lost") > 0)).alias("constant_z"), F.count_if(F.col("z") <= F.col("before")).alias("rising_z"))
    one = main.join(slices, by).join(_repeats(cells, "cell_id", by, "unique_ids"), by)
    return unfolded(one, by, ["two_slices", "unique_ids", "finite_xy", "constant_z", "rising_z"])


def slice_inspection(cells: DataFrame) -> DataFrame:
    """(dataset_id, slice_index, rule, failed, ok): finite coordinates, z for all points or none, and a z of the slice's own."""
    by = ["dataset_id", "slice_index"]
    one = cells.groupBy(*by).agg(F.count_if(~(number("x") & number("y"))).alias("finite_xy"), F.count("*").alias("n"), F.count_if(number("z")).alias("nz"), F.percentile("z", lit(0.5)).alias("z"))
    one = one.withColumn("whole_z", F.when((F.col("nz") > 0) & (F.col("nz") < F.col("n")), F.col("n") - F.col("nz")).otherwise(F.lit(0)))
    shared = F.count("*").over(Window.partitionBy("dataset_id", "z")) - 1
    return unfolded(one.withColumn("own_z", F.when(F.col("z").isNull(), F.lit(0)).otherwise(shared)), by, ["finite_xy", "whole_z", "own_z"])


def matrix_rules(expression: DataFrame, cells: DataFrame, least: int = 3) -> DataFrame:
    """Rules of a count matrix in long form and its cells(cell_id): size, signs, whole numbers, totals, and not just one label a cell."""
    size = expression.agg(F.countDistinct("cell_id").alias("c"), F.countDistinct("gene").alias("g"), F.count_if(~number(F.col("value").cast("double"))).alias("finite"), F.count_if(F.col("value") < 0).alias("non_negative"), F.count_if(F.abs(F.col("value") - F.rint("value")) > TOLERANCE).alias("whole_numbers"))
    totals = cells.select("cell_id").distinct().join(expression.groupBy("cell_id").agg(F.sum("value").alias("t"), F.count_if(F.col("value") != 0).alias("k"), F.max("value").alias("top")), "cell_id", "left")
    totals = totals.agg(F.count_if(F.coalesce(F.col("t") <= 0, F.lit(True))).alias("positive_totals"), F.coalesce(F.bool_and((F.col("k") == 1) & (F.col("top") == 1)), F.lit(False)).cast("int").alias("not_one_hot"))
    one = size.crossJoin(totals).withColumn("large_enough", (F.least("c", "g") < least).cast("int"))  # one row each
    return unfolded(one, [], ["large_enough", "finite", "non_negative", "whole_numbers", "positive_totals", "not_one_hot"])


def score_rules(scores: DataFrame, first: str = "p0", second: str = "p1") -> DataFrame:
    """Rules of component scores in columns: finite, no row of zeros, two directions that vary and aren't the same one, not one-hot."""
    a, b = F.col(first), F.col(second)
    one = scores.agg(
        F.count_if(~(number(first) & number(second))).alias("finite"), F.count_if((a == 0) & (b == 0)).alias("no_zero_rows"), F.var_pop(first).alias("va"), F.var_pop(second).alias("vb"), F.covar_pop(first, second).alias("vab"),
        F.coalesce(F.bool_and(a.isin(0.0, 1.0) & b.isin(0.0, 1.0) & (a + b <= 1)), F.lit(False)).cast("int").alias("not_one_hot"),
    )
    one = one.withColumn("varies", ((F.col("va") <= 0) | (F.col("vb") <= 0)).cast("int")).withColumn("rank_two", (F.col("va") * F.col("vb") - F.col("vab") ** 2 <= 1e-12 * F.col("va") * F.col("vb")).cast("int"))
    return unfolded(one, [], ["finite", "no_zero_rows", "varies", "rank_two", "not_one_hot"])


def clean_table_problems(columns: list[str]) -> list[str]:
    """What is wrong with the header of a clean coordinate table."""
    out = [] if tuple(columns) == CLEAN_HEADER else ["the header isn't the clean one"]
    return out + [f"forbidden column: {c}" for c in columns if any(t in c.lower() for t in FORBIDDEN)]


def clean_rules(rows: DataFrame, expected: int) -> DataFrame:
    """Rules of clean coordinates: all rows, ids that are there once and aren't row numbers in disguise, numeric coordinates, sound labels."""
    own = F.col("cell_id").cast("string")
    plain = rule_table(rows, {
        "finite_xyz": number("x") & number("y") & number("z"),
        "no_row_index_ids": ~own.rlike(r"^.+:\d+$"),
        "sound_labels": F.col("celltype").isNotNull() & ~F.lower("celltype").isin("nan", "none", "null", ""),
    })
    ids = unfolded(_repeats(rows, "cell_id", [], "unique_ids"), [], ["unique_ids"])
    count = unfolded(rows.agg(F.abs(F.count("*") - F.lit(expected)).alias("row_count")), [], ["row_count"])
    return plain.unionByName(ids).unionByName(count)


def stage_rules(cells: DataFrame, expression: DataFrame) -> DataFrame:
    """(dataset_id, rule, failed, ok) of a stage in space: ids, coordinates that span three dimensions, counts, no empty library."""
    by = ["dataset_id"]
    axes = "xyz"
    moments = {f"{a}{b}": F.covar_samp(a, b) for i, a in enumerate(axes) for b in axes[i:]}
    main = cells.groupBy(*by).agg(F.count_if(~(number("x") & number("y") & number("z"))).alias("finite_xyz"), *[m.alias(f"c_{k}") for k, m in moments.items()])
    c = lambda k: F.col(f"c_{k}")
    det = c("xx") * (c("yy") * c("zz") - c("yz") ** 2) - c("xy") * (c("xy") * c("zz") - c("yz") * c("xz")) + c("xz") * (c("xy") * c("yz") - c("yy") * c("xz"))
    main = main.withColumn("three_dimensions", (F.coalesce(det <= 1e-12 * c("xx") * c("yy") * c("zz"), F.lit(True))).cast("int"))
    totals = expression.groupBy("cell_id").agg(F.sum("value").alias("t"), F.count_if((F.col("value") < 0) | (F.abs(F.col("value") - F.rint("value")) > TOLERANCE)).alias("odd"))
    counts = cells.select(*by, "cell_id").join(totals, "cell_id", "left").groupBy(*by).agg(F.count_if(F.coalesce("t", F.lit(0)) <= 0).alias("no_empty_library"), F.coalesce(F.sum("odd"), F.lit(0)).alias("counts"))
    return unfolded(main.join(counts, by).join(_repeats(cells, "cell_id", by, "unique_ids"), by), by, ["unique_ids", "finite_xyz", "three_dimensions", "counts", "no_empty_library"])


def cloud_rules(points: DataFrame, planar: bool = False) -> DataFrame:
    """Rules of a point cloud: points, finite coordinates, and a volume unless a plane is allowed."""
    spread = lambda a: F.stddev_pop(a)
    one = points.agg((F.count("*") == 0).cast("int").alias("points"), F.count_if(~(number("x") & number("y") & number("z"))).alias("finite_xyz"), *[spread(a).alias(f"s{a}") for a in "xyz"])
    flat = F.lit(0) if planar else sum(((F.coalesce(f"s{a}", lit(0)) <= 1e-12).cast("int") for a in "xyz"), F.lit(0))
    return unfolded(one.withColumn("volume", flat), [], ["points", "finite_xyz", "volume"])


def marginal_rules(plan: DataFrame, rows: int, columns: int, tolerance: float = 1e-4) -> DataFrame:
    """Rules of a transport plan(i, j, w): weights not negative, and sums by row and column that differ from an even share by ``tolerance`` of one at most."""
    off = lambda key, n: plan.groupBy(key).agg(F.sum("w").alias("s")).agg((F.count_if(F.abs(F.col("s") - 1.0 / n) > tolerance / n) + F.lit(n) - F.count("*")).alias(f"{key}_sums"))
    one = plan.agg(F.count_if(F.col("w") < 0).alias("non_negative")).crossJoin(off("i", rows)).crossJoin(off("j", columns))  # one row each
    return unfolded(one, [], ["non_negative", "i_sums", "j_sums"])


def feature_ids(genes: DataFrame, new: str = "new_id", old: str = "gene") -> tuple[DataFrame, DataFrame]:
    """(rules, renamed): ids that may replace the names of genes are there and unique; the old name is kept as symbol."""
    return unfolded(_repeats(genes, new, [], "unique_ids"), [], ["unique_ids"]), genes.withColumn("symbol", F.col(old)).withColumn(old, F.col(new)).drop(new)


def representation_rules(rows: DataFrame, label: str = "celltype", vector: str = "rep") -> DataFrame:
    """Rules of labels' vectors: one label always has the same one, and no two labels share one."""
    per = rows.select(label, F.to_json(F.struct(vector)).alias("v")).distinct()
    same = per.groupBy(label).agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") > 1).alias("one_vector"))
    other = per.groupBy("v").agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") > 1).alias("own_vector"))
    return unfolded(same.crossJoin(other), [], ["one_vector", "own_vector"])  # one row each


def manifest_problems(slices: set[str], entries: list[dict]) -> list[str]:
    """What is wrong with a component manifest: entries must cover the slices exactly, share a basis and name their content."""
    names = [e.get("slice") for e in entries]
    out = [f"missing slice: {s}" for s in sorted(slices - set(names))] + [f"unknown slice: {s}" for s in sorted(set(names) - slices, key=str)]
    out += [f"slice stands twice: {s}" for s in sorted({n for n in names if names.count(n) > 1}, key=str)]
    if len({e.get("basis") for e in entries}) > 1:
        out.append("slices don't share a basis")
    return out + [f"no digest: {e.get('slice')}" for e in entries if len(str(e.get("sha256", ""))) != 64]


#: Strength of what a policy tier asks of the detector: fixed values.
DETECTOR = {"ignore": 0, "candidate": 1, "exclude": 2}


def tier_problems(tiers: list[dict], keep_below: float) -> list[str]:
    """What is wrong with a policy's tiers: names, ranges, gaps between bands, and lower bands that don't ask for more."""
    out = []
    names = [t.get("name") for t in tiers]
    if not all(names) or len(set(names)) < len(names):
        out.append("names must be there and differ")
    for t in tiers:
        if not 2 <= t["domains"] <= 4:
            out.append(f"{t['name']}: two to four domains")
        if any(not 0 <= t[k] <= 1 for k in ("severity", "stability", "confidence")):
            out.append(f"{t['name']}: shares lie between 0 and 1")
        if t["detector"] not in DETECTOR:
            out.append(f"{t['name']}: unknown detector mode")
    edges = [keep_below, *[t["high"] for t in tiers]]
    if any(e is None for e in edges[:-1]) or (tiers and edges[-1] is not None):
        out.append("only the last band is open")
    elif any(abs(t["low"] - e) > 1e-12 or (t["high"] is not None and not t["low"] < t["high"] <= 1) for t, e in zip(tiers, edges)):
        out.append("bands must be contiguous")
    strength = [(t["domains"], t["severity"], t["stability"], t["confidence"], DETECTOR.get(t["detector"], 0)) for t in tiers]
    for low, high, name in zip(strength, strength[1:], names):
        if any(a < b for a, b in zip(low, high)) or low == high:
            out.append(f"{name}: a lower band must ask for strictly more")
    return out


def config_problems(config: dict, known: dict[str, tuple[type, float, float] | type]) -> list[str]:
    """Unknown keys, wrong kinds and values out of range; ``known`` gives a kind, or a kind with its least and greatest value."""
    out = [f"unknown key: {k}" for k in sorted(set(config) - set(known))]
    for k in sorted(set(config) & set(known)):
        kind, low, high = known[k] if isinstance(known[k], tuple) else (known[k], None, None)
        v = config[k]
        if isinstance(v, bool) != (kind is bool) or not isinstance(v, (int, float) if kind is float else kind):
            out.append(f"{k}: wrong kind")
        elif low is not None and not low <= v <= high:
            out.append(f"{k}: out of range")
    return out


def layout_problems(paths: set[str], required: tuple[str, ...]) -> list[str]:
    """Required files and folders (with a final slash) that a listing lacks."""
    return [r for r in required if not any(p == r or (r.endswith("/") and p.startswith(r)) for p in paths)]
