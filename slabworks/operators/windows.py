"""Operators over ordered slices: local expectation, anomaly, bilateral loss, taper, continuity.

Metrics are rows (dataset_id, slice_index, metric, value), not columns, so that one window serves all of them and
partitions are (dataset, metric).  A slice series is short; the number of datasets and metrics is what grows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slabworks.functions.columns import EPS, MAD_SCALE, array_median, both_min, clip, lit, over

#: (mild, severe) effects by metric and direction: fixed values of the scoring rules.
LOW_IS_BAD = {
    "n_locations": (0.35, 0.68),
    "cell_density": (0.25, 0.58),
    "largest_component_fraction": (0.08, 0.32),
    "median_total_counts": (0.25, 0.62),
    "median_n_genes": (0.22, 0.55),
    "library_complexity": (0.15, 0.42),
    "detected_gene_fraction": (0.15, 0.45),
}
HIGH_IS_BAD = {
    "hole_fraction": (0.04, 0.24),
    "fragmentation": (0.03, 0.24),
    "knn_tail_ratio": (0.35, 1.50),
    "local_low_depth_fraction": (0.05, 0.32),
    "regional_low_depth_cluster_fraction": (0.03, 0.20),
    "zero_fraction": (0.08, 0.32),
    "median_pct_mito": (0.05, 0.25),
}

SERIES = ("dataset_id", "metric")


def positioned(rows: DataFrame) -> DataFrame:
    """Adds pos, the place of a slice in its dataset's order."""
    w = Window.partitionBy(*SERIES).orderBy("slice_index")
    return rows.withColumn("pos", (F.row_number().over(w) - 1).cast("double"))


def _sides(window: int) -> tuple[Window, Window]:
    half = max(window // 2, 1)
    w = Window.partitionBy(*SERIES).orderBy("slice_index")
    return w.rowsBetween(-half, -1), w.rowsBetween(1, half)


def neighbours(rows: DataFrame, windows: tuple[int, ...], value: str = "value") -> DataFrame:
    """A row for each window: adds window, and l and r, the (pos, value) of present neighbours on either side.

    All frames have one order, so a single pass over each series serves all windows.
    """
    pair = F.when(F.col(value).isNotNull(), F.struct("pos", F.col(value).alias("value")))
    sides = [(w, *_sides(w)) for w in windows]
    near = F.array(*[F.struct(F.lit(w).alias("window"), F.collect_list(pair).over(left).alias("l"), F.collect_list(pair).over(right).alias("r")) for w, left, right in sides])
    out = positioned(rows).withColumn("near", near)
    return out.select("*", F.explode("near").alias("_n")).select(*out.columns, "_n.*").drop("near")


def expectations(rows: DataFrame, windows: tuple[int, ...]) -> DataFrame:
    """Adds window, expected, two_sided and disagreement from the neighbours of each slice, never from the slice itself.

    With neighbours on both sides: the median of pairwise slopes and the median intercept, evaluated at the slice;
    on one side: their median; none: NULL.
    """
    near = neighbours(rows, windows).withColumn("n", F.concat("l", "r"))
    slopes = F.flatten(F.transform("n", lambda a: F.transform(F.filter("n", lambda b: b.pos > a.pos), lambda b: (b.value - a.value) / (b.pos - a.pos))))
    near = near.withColumn("slope", array_median(slopes))
    intercept = array_median(F.transform("n", lambda a: a.value - F.col("slope") * a.pos))
    two = (F.size("l") > 0) & (F.size("r") > 0)
    lm, rm = array_median(F.col("l.value")), array_median(F.col("r.value"))
    out = near.withColumn("two_sided", two).withColumn("expected", F.when(two, intercept + F.col("slope") * F.col("pos")).otherwise(array_median(F.col("n.value"))))
    return out.withColumn("disagreement", F.when(two, F.abs(lm - rm))).drop("l", "r", "n", "slope")


def local_expected(rows: DataFrame, window: int) -> DataFrame:
    """``expectations`` under one window."""
    return expectations(rows, (window,)).drop("window")


def _with_scale(rows: DataFrame, value: str, center: str, scale: str) -> DataFrame:
    """Adds the median of a value over its series and window, and MAD x 1.4826, else the deviation, else 1."""
    w = Window.partitionBy(*SERIES, "window")
    out = rows.withColumn(center, F.percentile(value, F.lit(0.5)).over(w)).withColumn("_sd", F.stddev_pop(value).over(w))
    mad = F.percentile(F.abs(F.col(value) - F.col(center)), F.lit(0.5)).over(w) * MAD_SCALE
    out = out.withColumn("_mad", mad)
    return out.withColumn(scale, F.when(F.col("_mad") > EPS, F.col("_mad")).when(F.col("_sd") > EPS, F.col("_sd")).otherwise(lit(1.0))).withColumn(center, F.coalesce(center, lit(0.0))).drop("_sd", "_mad")


def anomalies(rows: DataFrame, windows: tuple[int, ...]) -> DataFrame:
    """Scores rows that carry their rule (low boolean, mild, severe) under each window.

    Adds window, expected, two_sided, disagreement and score, 0 to 1; 0 where the value or its expectation is missing.
    """
    near = expectations(rows, windows)
    near = near.withColumn("residual", F.when(F.col("low"), F.col("expected") - F.col("value")).otherwise(F.col("value") - F.col("expected")))
    near = _with_scale(_with_scale(near, "residual", "rs_center", "rs"), "value", "gs_center", "gs")
    z = F.greatest(over(F.col("residual") - F.col("rs_center"), F.col("rs")), lit(0))
    magnitude = F.greatest(F.when(F.col("low"), over(F.col("residual"), F.abs("expected"))).otherwise(F.col("residual")), lit(0))
    ratio = clip(over(magnitude - F.col("mild"), F.col("severe") - F.col("mild")), 0, 1)
    steep = clip((z - 1.5) / 3.0, 0, 1) * F.when(F.col("low"), lit(1)).otherwise(clip(over(magnitude, F.col("mild")), 0, 1))
    calm = clip(F.exp(-over(F.coalesce("disagreement", lit(0)), F.col("gs") * 2.5)), 0.35, 1)
    score = F.greatest(ratio, steep) * F.when(F.col("two_sided"), lit(1.0)).otherwise(lit(0.72)) * calm
    valid = F.col("value").isNotNull() & F.col("expected").isNotNull()
    return near.withColumn("score", F.when(valid, score).otherwise(lit(0))).drop("residual", "rs", "rs_center", "gs", "gs_center")


def metric_anomaly(rows: DataFrame, window: int, low: bool, mild: float, severe: float) -> DataFrame:
    """``anomalies`` of rows that share one rule, under one window."""
    return anomalies(rows.withColumns({"low": F.lit(low), "mild": lit(mild), "severe": lit(severe)}), (window,)).drop("low", "mild", "severe", "window")


def losses(rows: DataFrame, windows: tuple[int, ...]) -> DataFrame:
    """Adds window, reference and loss: the deficit against the lower of both sides' medians of positive neighbours."""
    positive = lambda side: array_median(F.transform(F.filter(side, lambda x: x.value > 0), lambda x: x.value))
    out = neighbours(rows, windows)
    out = out.withColumn("reference", F.when(F.col("value") >= 0, both_min(positive("l"), positive("r"))))
    return out.withColumn("loss", clip(1 - over(F.col("value"), F.col("reference")), 0, 1)).drop("l", "r", "pos")


def bilateral_loss(rows: DataFrame, window: int) -> DataFrame:
    """``losses`` under one window."""
    return losses(rows, (window,)).drop("window")


def smooth_taper(slices: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Adds smooth_taper: every column lies between its neighbours' values, all of them positive and present."""
    w = Window.partitionBy("dataset_id").orderBy("slice_index")
    ok = F.lit(True)
    for c in columns:
        before, after = F.lag(c).over(w), F.lead(c).over(w)
        present = before.isNotNull() & after.isNotNull() & F.col(c).isNotNull()
        ok = ok & present & (F.least(before, after, F.col(c)) > 0) & F.col(c).between(F.least(before, after), F.greatest(before, after))
    return slices.withColumn("smooth_taper", F.coalesce(ok, F.lit(False)))


def _framed(w: Window, windows: tuple[int, ...], make) -> Column:
    """An array of (window, what ``make`` gives for the frames left and right of the slice)."""
    parts = []
    for k in windows:
        half = max(k // 2, 1)
        parts.append(F.struct(F.lit(k).alias("window"), *make(w.rowsBetween(-half, -1), w.rowsBetween(1, half))))
    return F.array(*parts)


def profile_divergences(profile: DataFrame, windows: tuple[int, ...]) -> DataFrame:
    """A row a slice and window: divergence from the neighbours' mean profile (1 - cosine), and similarity of both sides' means.

    profile(dataset_id, slice_index, gene, value) is long and is filled up with zeros for the genes that a slice of
    its dataset lacks; slices are neighbours by place in their dataset.
    """
    keys = ["dataset_id", "slice_index"]
    genes = profile.select("dataset_id", "gene").distinct()
    dense = profile.select(*keys).distinct().join(genes, "dataset_id").join(profile, [*keys, "gene"], "left").withColumn("value", F.coalesce(F.col("value").cast("double"), lit(0)))
    w = Window.partitionBy("dataset_id", "gene").orderBy("slice_index")
    sums = _framed(w, windows, lambda left, right: (F.sum("value").over(left).alias("sl"), F.sum("value").over(right).alias("sr")))
    each = dense.withColumn("_f", sums).select(*keys, "value", F.explode("_f").alias("f")).select(*keys, "value", "f.window", "f.sl", "f.sr")
    each = each.withColumn("s", F.when(F.col("sl").isNotNull() | F.col("sr").isNotNull(), F.coalesce("sl", lit(0)) + F.coalesce("sr", lit(0))))
    dot = lambda a, b: F.sum(F.col(a) * F.col(b))
    both = each.groupBy(*keys, "window").agg(*[dot(a, b).alias(name) for name, a, b in (("vs", "value", "s"), ("vv", "value", "value"), ("ss", "s", "s"), ("lr", "sl", "sr"), ("ll", "sl", "sl"), ("rr", "sr", "sr"))])
    cosine = lambda d, a, b: over(F.col(d), F.sqrt(a) * F.sqrt(b))
    return both.select(*keys, "window", (1 - cosine("vs", "vv", "ss")).alias("divergence"), cosine("lr", "ll", "rr").alias("similarity"))


def profile_divergence(profile: DataFrame, window: int) -> DataFrame:
    """``profile_divergences`` under one window."""
    return profile_divergences(profile, (window,)).drop("window")


def composition_divergences(counts: DataFrame, windows: tuple[int, ...]) -> DataFrame:
    """A row a slice and window: Jensen-Shannon divergence (base 2) of its label shares from the neighbours' mean shares.

    counts(dataset_id, slice_index, label, n).
    """
    keys = ["dataset_id", "slice_index"]
    labels = counts.select("dataset_id", "label").distinct()
    slices = counts.groupBy(*keys).agg(F.sum("n").alias("total"))
    dense = slices.join(labels, "dataset_id").join(counts, [*keys, "label"], "left")
    dense = dense.withColumn("p", F.coalesce(F.col("n"), F.lit(0)) / F.col("total"))
    w = Window.partitionBy("dataset_id", "label").orderBy("slice_index")
    both = lambda left, right: ((F.coalesce(F.sum("p").over(left), lit(0)) + F.coalesce(F.sum("p").over(right), lit(0))).alias("s"), (F.count("p").over(left) + F.count("p").over(right)).alias("k"))
    dense = dense.withColumn("_f", _framed(w, windows, both)).select(*keys, "p", F.explode("_f").alias("f"))
    dense = dense.select(*keys, "p", "f.window", F.when(F.col("f.k") > 0, F.col("f.s") / F.col("f.k")).alias("q"))
    kinds = Window.partitionBy(*keys, "window")
    share = lambda c: (F.col(c) + EPS) / F.sum(F.col(c) + EPS).over(kinds)
    dense = dense.withColumn("a", share("p")).withColumn("b", share("q"))
    m = (F.col("a") + F.col("b")) / 2
    half_of = lambda c: F.sum(F.col(c) * F.log2(F.col(c) / m))
    return dense.groupBy(*keys, "window").agg((0.5 * half_of("a") + 0.5 * half_of("b")).alias("js"))


def composition_divergence(counts: DataFrame, window: int) -> DataFrame:
    """``composition_divergences`` under one window."""
    return composition_divergences(counts, (window,)).drop("window")


def robust_threshold(edges: DataFrame, value: str, by: list[str], ratio: float, k: float) -> DataFrame:
    """Adds threshold: max(ratio x median, median + k x 1.4826 x MAD) over the edges of a series."""
    center = edges.groupBy(*by).agg(F.percentile(value, F.lit(0.5)).alias("mid"))
    mad = edges.join(center, by).groupBy(*by).agg(F.first("mid").alias("mid"), F.percentile(F.abs(F.col(value) - F.col("mid")), F.lit(0.5)).alias("mad"))
    return edges.join(mad.select(*by, F.greatest(F.col("mid") * ratio, F.col("mid") + F.col("mad") * (k * MAD_SCALE)).alias("threshold")), by)
