"""Slice quality: metrics, anomaly domains, score, recommendation and the two-stage policy, one job for all datasets.

Everything is scored under several windows at once: metrics are rows, a series is ordered once, and a slice has a row
for each window from there on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slabworks.functions.columns import clip, lit, over
from slabworks.operators import windows as W
from slabworks.operators.morphology import slice_geometry
from slabworks.operators.review import confirmed_loss, supporting_share
from slabworks.session import held
from slabworks.sources import fixtures as X

# Fixed values of the scoring rules: weights of each domain's metrics, and of the domains in the score.
DENSITY = {"cell_density": 0.28, "n_locations": 0.10, "hole_fraction": 0.27, "knn_tail_ratio": 0.13, "fragmentation": 0.12, "largest_component_fraction": 0.10}
EXPRESSION = {"median_total_counts": 0.27, "median_n_genes": 0.24, "zero_fraction": 0.14, "library_complexity": 0.11, "detected_gene_fraction": 0.08, "local_low_depth_fraction": 0.08, "regional_low_depth_cluster_fraction": 0.08}
DAMAGE = {"median_pct_mito": 0.65, "fragmentation": 0.35}
CONTINUITY = {"expression_profile": 0.58, "celltype_composition": 0.22, "hole_fraction": 0.20}
SCORE = {"density": 0.31, "expression": 0.39, "damage": 0.12, "continuity": 0.18}
DIVERGENCE = (0.03, 0.18)
REVIEW, EXCLUDE, SEVERE = 0.38, 0.64, 0.78
STRONG = 0.45

# Fixed values of the policy: bands of the score, and what each band asks for.
KEEP_BELOW, EXCLUDE_FROM = 0.129, 0.70
TIERS = (("low", 0.129, 0.54, 2, 0.65), ("high", 0.54, float("inf"), 2, 0.60))
STABILITY, CONFIDENCE = 1.0, 0.9

#: Windows that the policy compares, its primary one, and the widths that a support window can have.
WINDOWS, PRIMARY, SUPPORT = (3, 5, 7), 5, (3, 5, 7, 9)
KEYS = ["dataset_id", "slice_index"]
LOSSES = ("n_locations", "hull_area", "cell_density", "median_total_counts", "median_n_genes")


def capture_metrics(cells: DataFrame, n_genes: Column | int) -> DataFrame:
    """Capture metrics of each slice from cells(dataset_id, slice_index, total, genes); n_genes is the size of the gene list."""
    per = cells.groupBy(*KEYS).agg(
        F.percentile("total", F.lit(0.5)).alias("median_total_counts"), F.percentile("genes", F.lit(0.5)).cast("double").alias("median_n_genes"),
        F.sum("genes").alias("_g"), F.count("*").alias("_n"), F.percentile(over(F.col("genes"), F.log1p("total")), F.lit(0.5)).alias("library_complexity"),
    )
    return per.withColumn("zero_fraction", 1 - F.col("_g") / (F.col("_n") * n_genes)).drop("_g", "_n")


def series_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a slice of the point series: counts, capture, geometry and local depth."""
    p = X.points(spark, sf_dir)
    n_genes = p.select("celltype").distinct().count()
    base = p.groupBy(*KEYS).agg(
        F.count("*").cast("double").alias("n_locations"), F.avg((F.col("x").isNotNull() & F.col("y").isNotNull()).cast("double")).alias("coordinate_valid_fraction"),
        (F.countDistinct("celltype") / F.lit(max(n_genes, 1))).alias("detected_gene_fraction"),
    )
    cells = p.groupBy(*KEYS, "user_id").agg(F.sum("total_counts").alias("total"), F.countDistinct("celltype").alias("genes"))
    geo = slice_geometry(p.where("x is not null and y is not null")).drop("n")
    out = base.join(capture_metrics(cells, max(n_genes, 1)), KEYS).join(geo, KEYS, "left")
    return out.withColumn("cell_density", F.when(F.col("hull_area") > 0, F.col("n_locations") / F.col("hull_area")))


def series_continuity(spark: SparkSession, sf_dir: str, windows: tuple[int, ...] = WINDOWS) -> DataFrame:
    """(dataset_id, slice_index, window, divergence, similarity, js) of the point series."""
    counts = X.points(spark, sf_dir).groupBy(*KEYS, F.col("celltype").alias("label")).agg(F.count("*").alias("n"), F.sum("total_counts").alias("value"))
    mix = W.composition_divergences(counts.select(*KEYS, "label", "n"), windows)
    return mix.join(W.profile_divergences(counts.select(*KEYS, F.col("label").alias("gene"), "value"), windows), [*KEYS, "window"], "full_outer")


def _long(slices: DataFrame, continuity: DataFrame | None) -> tuple[DataFrame, list[str]]:
    """(dataset_id, slice_index, metric, value, low, mild, severe) of all metrics that are there, and their names."""
    rules = {m: (True, *r) for m, r in W.LOW_IS_BAD.items()} | {m: (False, *r) for m, r in W.HIGH_IS_BAD.items()}
    have = [m for m in rules if m in slices.columns]
    long = slices.select(*KEYS, *[F.col(m).cast("double").alias(m) for m in have]).unpivot(KEYS, have, "metric", "value")
    rule = F.create_map(*[x for m in have for x in (F.lit(m), F.struct(F.lit(rules[m][0]).alias("low"), lit(rules[m][1]).alias("mild"), lit(rules[m][2]).alias("severe")))])
    return long.withColumn("_r", F.element_at(rule, F.col("metric"))).select(*KEYS, "metric", "value", "_r.*"), have


def support_window(window: Column, n: Column) -> Column:
    """The primary window, widened to the series' odd length, nine slices at most and three at least."""
    odd = F.when(n % 2 == 1, n).otherwise(n - 1)
    return F.greatest(window, F.lit(3), F.least(F.lit(9), odd)).cast("int")


def _metric_scores(slices: DataFrame, windows: tuple[int, ...]) -> tuple[DataFrame, list[str]]:
    """A row a slice and window with <metric>_anomaly and internal; a metric takes the greater of its window's and the support window's score."""
    long, have = _long(slices, None)
    known = tuple(sorted(set(windows) | set(SUPPORT)))
    scored = W.anomalies(long, known).withColumn("n", F.count("*").over(Window.partitionBy(*W.SERIES, "window")))
    view = F.struct("window", "score", "expected", "two_sided")
    per = scored.repartition(*KEYS).groupBy(*KEYS, "metric").agg(F.collect_list(view).alias("views"), F.first("value").alias("value"), F.first("mild").alias("mild"), F.first("severe").alias("severe"), F.first("n").alias("n"))
    per = per.withColumn("window", F.explode(F.array(*map(F.lit, windows)))).withColumn("support", support_window(F.col("window"), F.col("n")))
    pick = lambda c: F.element_at(F.filter("views", lambda v: v.window == F.col(c)), 1)
    per = per.withColumn("own", pick("window")).withColumn("sup", pick("support"))
    dropped = lambda e: F.coalesce(F.greatest(over(e - F.col("value"), F.abs(e)), lit(0)), lit(0))
    drop = F.greatest(dropped(F.col("own.expected")), dropped(F.col("sup.expected")))
    direct = clip((drop - F.col("mild")) / (F.col("severe") - F.col("mild")), 0, 1) * F.when(F.col("own.two_sided"), lit(1)).otherwise(lit(0.72))
    score = F.greatest("own.score", "sup.score", F.when(F.col("metric").isin("median_total_counts", "median_n_genes"), direct).otherwise(lit(0)))
    per = per.withColumn("anomaly", score)
    wide = per.groupBy(*KEYS, "window").agg(*[F.max(F.when(F.col("metric") == m, F.col("anomaly"))).alias(f"{m}_anomaly") for m in have], F.bool_or("own.two_sided").alias("internal"))
    return wide, [f"{m}_anomaly" for m in have]


def loss_evidence(slices: DataFrame, windows: tuple[int, ...]) -> DataFrame:
    """(dataset_id, slice_index, window, geometry_loss_candidate, capture_loss_candidate) from losses against both sides."""
    trusted = F.coalesce(F.col("coordinate_valid_fraction") >= 0.99, F.lit(True)) if "coordinate_valid_fraction" in slices.columns else F.lit(True)
    column = lambda m: F.col(m).cast("double") if m in slices.columns else F.lit(None).cast("double")
    seen = slices.select(*KEYS, *[F.when(trusted | F.lit(m.startswith("median")), column(m)).alias(m) for m in LOSSES])
    loss = W.losses(seen.unpivot(KEYS, list(LOSSES), "metric", "value"), windows)
    of = lambda m, c="loss": F.max(F.when(F.col("metric") == m, F.col(c)))
    wide = loss.groupBy(*KEYS, "window").agg(*[of(m).alias(f"{m}_loss") for m in LOSSES], of("n_locations", "reference").alias("point_reference"))
    some = lambda c: F.coalesce(c, F.lit(False))
    geometry = some(F.col("point_reference") >= 20) & some(F.col("n_locations_loss") >= 0.5) & (some(F.col("hull_area_loss") >= 0.35) | some(F.col("cell_density_loss") >= 0.35))
    capture = some(F.col("median_total_counts_loss") >= 0.5) & some(F.col("median_n_genes_loss") >= 0.3)
    return wide.select(*KEYS, "window", geometry.alias("geometry_loss_candidate"), capture.alias("capture_loss_candidate"))


def taper_evidence(slices: DataFrame) -> DataFrame:
    """(dataset_id, slice_index, smooth_taper): points and hull area lie between the neighbours', coordinates valid on all three."""
    trusted = F.coalesce(F.col("coordinate_valid_fraction") >= 0.99, F.lit(True)) if "coordinate_valid_fraction" in slices.columns else F.lit(True)
    area = F.when(trusted, F.col("hull_area")) if "hull_area" in slices.columns else F.lit(None).cast("double")
    seen = slices.select(*KEYS, F.when(trusted, F.col("n_locations")).alias("n_locations"), area.alias("hull_area"))
    return W.smooth_taper(seen, ("n_locations", "hull_area")).select(*KEYS, "smooth_taper")


def _continuity(rows: DataFrame, windows: tuple[int, ...]) -> DataFrame:
    """(dataset_id, slice_index, window, expression_profile_anomaly, celltype_composition_anomaly)."""
    out = None
    for w in windows:  # a window's divergences are a series of their own
        own = rows.where(F.col("window") == w)
        value = own.select(*KEYS, F.lit("divergence").alias("metric"), F.col("divergence").alias("value"))
        scored = W.metric_anomaly(value, w, False, *DIVERGENCE).select(*KEYS, "score")
        out = scored.withColumn("window", F.lit(w)) if out is None else out.union(scored.withColumn("window", F.lit(w)))
    both = rows.join(out, [*KEYS, "window"])
    plain = clip((F.coalesce("divergence", lit(0)) - 0.06) / 0.24, 0, 1)
    agreement = clip((F.coalesce("similarity", lit(0.5)) - 0.25) / 0.6, 0.25, 1)
    return both.select(*KEYS, "window", (F.greatest("score", plain) * agreement).alias("expression_profile_anomaly"), clip((F.coalesce("js", lit(0)) - 0.08) / 0.32, 0, 1).alias("celltype_composition_anomaly"))


def _weighted(columns: list[str], weights: dict[str, float]) -> Column:
    have = [(f"{m}_anomaly", w) for m, w in weights.items() if f"{m}_anomaly" in columns]
    if not have:
        return lit(0)
    return sum((F.coalesce(F.col(c), lit(0)) * w for c, w in have), lit(0)) / sum(w for _, w in have)


def _two_strongest(columns: list[str], weights: dict[str, float]) -> Column:
    have = [F.coalesce(F.col(f"{m}_anomaly"), lit(0)) for m in weights if f"{m}_anomaly" in columns]
    if not have:
        return lit(0)
    s = F.sort_array(F.array(*have, lit(0)), asc=False)
    return F.get(s, F.lit(0)) * 0.65 + F.get(s, F.lit(1)) * 0.35


def score_windows(slices: DataFrame, windows: tuple[int, ...] = WINDOWS, continuity: DataFrame | None = None) -> DataFrame:
    """A row a slice and window: the slice's metrics, their anomalies, domain scores, score, protection and recommendation.

    slices(dataset_id, slice_index, metrics...) may lack any metric: an absent column is left out of its domain's
    weights, a missing value scores 0 and keeps its weight.  continuity(dataset_id, slice_index, window, divergence,
    similarity, js) may be missing too: then both continuity anomalies are 0.
    """
    if any(w < 3 or w % 2 == 0 for w in windows):
        raise ValueError("windows are odd and at least three")
    slices = held(slices)  # a row a slice, read four times: what it is made of is computed once
    continuity = None if continuity is None else held(continuity)
    both, names = _metric_scores(slices, windows)
    if continuity is not None:
        both = both.join(_continuity(continuity, windows), [*KEYS, "window"], "left")
    else:
        both = both.withColumns({"expression_profile_anomaly": lit(0), "celltype_composition_anomaly": lit(0)})
    names = [*names, "expression_profile_anomaly", "celltype_composition_anomaly"]
    out = slices.join(taper_evidence(slices), KEYS).join(both, KEYS).join(loss_evidence(slices, windows), [*KEYS, "window"])
    density = F.greatest(_weighted(names, DENSITY), _two_strongest(names, DENSITY))
    expression = F.greatest(_weighted(names, EXPRESSION), _two_strongest(names, EXPRESSION))
    out = out.withColumns({"density": density, "expression": expression, "damage": _weighted(names, DAMAGE), "continuity": _weighted(names, CONTINUITY)})
    domains = [F.col(d) for d in SCORE]
    raw = sum((F.col(d) * w for d, w in SCORE.items()), lit(0))
    raw = F.greatest(raw, clip((F.greatest(*domains) - 0.68) * 0.78 + 0.48, 0, 1))
    d, e, m, c = domains
    calm = (e < 0.32) & (m < 0.38) & (c < 0.45)
    only_density = (d >= 0.48) & calm
    of = lambda x: F.coalesce(F.col(f"{x}_anomaly"), lit(0)) if f"{x}_anomaly" in names else lit(0)
    taper = (of("n_locations") >= 0.45) & (of("cell_density") < 0.30) & (of("hole_fraction") < 0.30) & (e < 0.35)
    protected = (only_density | taper) & F.col("smooth_taper") & calm & ~F.col("geometry_loss_candidate") & ~F.col("capture_loss_candidate")
    score = F.when(protected, F.least(raw, lit(EXCLUDE - 0.02))).otherwise(raw) * F.when(F.col("internal"), lit(1)).otherwise(lit(0.82))
    strong = sum(((x >= STRONG).cast("int") for x in domains), F.lit(0))
    out = out.withColumns({"protected": protected, "n_strong": strong, "quality_anomaly_score": clip(score, 0, 1), "score_confidence": F.when(F.col("internal"), lit(1)).otherwise(lit(0.72)), "severity": F.greatest(*domains)})
    severe_metric = F.greatest(*[F.coalesce(F.col(x), lit(0)) for x in names], lit(0)) >= 0.75
    q = F.col("quality_anomaly_score")
    exclude = F.col("internal") & ~F.col("protected") & (((q >= EXCLUDE) & (F.col("n_strong") >= 2)) | (e >= SEVERE) | ((d >= 0.82) & (of("hole_fraction") >= 0.55) & (c >= 0.42)))
    review = (q >= REVIEW) | (F.col("n_strong") > 0) | severe_metric | F.col("protected") | F.col("geometry_loss_candidate") | F.col("capture_loss_candidate")
    return out.withColumn("recommendation", F.when(F.coalesce(exclude, F.lit(False)), "exclude").when(review, "review").otherwise("keep"))


#: Made-up defects of a middle slice: what its metrics are multiplied by, and what is added to them, at full strength.
DEFECTS = {
    "capture": {"median_total_counts": (0.05, 0.0), "median_n_genes": (0.3, 0.0), "library_complexity": (0.4, 0.0), "detected_gene_fraction": (0.5, 0.0), "zero_fraction": (1.0, 0.35)},
    "tissue": {"n_locations": (0.1, 0.0), "cell_density": (0.2, 0.0), "hull_area": (0.5, 0.0)},
    "damage": {"cell_density": (0.3, 0.0), "hole_fraction": (1.0, 0.5), "fragmentation": (1.0, 0.6), "median_total_counts": (0.55, 0.0), "zero_fraction": (1.0, 0.3), "library_complexity": (0.5, 0.0)},
    "apart": {"fragmentation": (1.0, 0.5), "hole_fraction": (1.0, 0.2)},
}
STRENGTHS = (0.2, 0.35, 0.5, 0.65, 0.8, 1.0)


def with_defects(slices: DataFrame, continuity: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Metrics and continuity of a copy of every series for each defect and strength, its slices numbered 10 and 20 hurt.

    Slice 20 of a series that is damaged or apart also differs from its neighbours in expression and composition; values that are missing stay so.
    """
    cases = F.array(*[F.struct(F.lit(k).alias("kind"), lit(s).alias("strength")) for k in DEFECTS for s in STRENGTHS])
    name = F.concat_ws("-", "dataset_id", "_c.kind", F.format_string("%.2f", F.col("_c.strength")))
    hit = F.col("slice_index").isin(10, 20)
    out = slices.withColumn("_c", F.explode(cases))
    for m in sorted({m for d in DEFECTS.values() for m in d} & set(slices.columns)):
        value = F.col(m)
        for kind, change in DEFECTS.items():
            if m in change:
                times, plus = change[m]
                value = F.when(hit & (F.col("_c.kind") == kind), F.col(m) * (1 - F.col("_c.strength") * (1 - times)) + F.col("_c.strength") * plus).otherwise(value)
        out = out.withColumn(m, value)
    apart = (F.col("slice_index") == 20) & F.col("_c.kind").isin("damage", "apart")
    links = continuity.withColumn("_c", F.explode(cases))
    links = links.withColumns({"divergence": F.when(apart, F.greatest("divergence", F.col("_c.strength") * 0.3)).otherwise(F.col("divergence")), "js": F.when(apart, F.greatest("js", F.col("_c.strength") * 0.3)).otherwise(F.col("js")), "similarity": F.when(apart, F.least("similarity", 1 - F.col("_c.strength") * 0.6)).otherwise(F.col("similarity"))})
    return (x.withColumn("dataset_id", name).drop("_c") for x in (out, links))


def window_evidence(scored: DataFrame) -> DataFrame:
    """One row a slice from its scores under several windows: details (array by window), least and median score, support share.

    A window wider than its series is left out, the narrowest one excepted.
    """
    fields = ["recommendation", "n_strong", "severity", "internal", "protected", "geometry_loss_candidate", "capture_loss_candidate"]
    rows = scored.select(*KEYS, "window", F.col("quality_anomaly_score").alias("score"), *fields)
    length, narrowest = F.count("*").over(Window.partitionBy("dataset_id", "window")), F.min("window").over(Window.partitionBy("dataset_id"))
    rows = rows.withColumn("length", length).withColumn("narrowest", narrowest).where((F.col("window") <= F.col("length")) | (F.col("window") == F.col("narrowest")))
    detail = F.struct("window", "score", *fields)
    support = ((F.col("recommendation") == "exclude") & F.col("internal") & ~F.col("protected") & (F.col("n_strong") >= 2) & (F.col("severity") >= 0.85)).cast("double")
    return rows.groupBy(*KEYS).agg(F.array_sort(F.collect_list(detail)).alias("details"), F.min("score").alias("least_score"), F.percentile("score", F.lit(0.5)).alias("median_score"), F.avg(support).alias("stability"))


def policy(slices: DataFrame, continuity: DataFrame | None = None, primary: int = PRIMARY, windows: tuple[int, ...] = WINDOWS) -> DataFrame:
    """The two-stage policy over the scores of the primary window and the evidence of all windows, which include it."""
    scored = held(score_windows(slices, windows, continuity))
    return two_stage_policy(scored.where(F.col("window") == primary), window_evidence(scored), primary)


def two_stage_policy(scored: DataFrame, windows: DataFrame, primary: int = PRIMARY) -> DataFrame:
    """dataset_id, slice_index, score, band, severity, n_strong, triage, basis and call.

    scored is score_windows under the primary window, windows the evidence of all of them.  A slice of the upper band is
    excluded if the detector says so too, otherwise it's uncertain like those in between.  An uncertain one is excluded
    only if the detector doesn't keep it and its tier's number of strong domains and severity are met with full confidence,
    here and in every window.  A loss that the primary window and one more (if there is one) show excludes in any band.
    What stays unresolved is kept.  basis names the route that decided: standard, the tier, a loss, or none.
    """
    q = F.col("quality_anomaly_score")
    band = F.when(q <= KEEP_BELOW, "keep").when(q >= EXCLUDE_FROM, "exclude").otherwise("review")
    whole = F.col("internal") & ~F.col("protected")
    some = lambda c: F.coalesce(c, F.lit(False))
    standard = some((q >= EXCLUDE_FROM) & (F.col("recommendation") == "exclude") & whole)
    open_ = (q > KEEP_BELOW) & F.col("recommendation").isin("review", "exclude") & whole & (F.col("score_confidence") >= CONFIDENCE)
    basis = F.when(standard, "standard")
    for name, low, high, strong, least in TIERS:
        agreed = supporting_share(low, strong, least) + 1e-9 >= STABILITY
        basis = basis.when(some(open_ & (q >= low) & (q < high) & (F.col("n_strong") >= strong) & (F.col("severity") >= least) & agreed), f"tier_{name}")
    for route in ("geometry", "capture"):
        basis = basis.when(some(confirmed_loss(route, primary)), f"{route}_loss")
    rows = scored.join(windows.select(*KEYS, "details"), KEYS, "left").withColumn("basis", basis.otherwise("none"))
    triage = F.when(standard, "decided").when(band == "keep", "clear").otherwise("uncertain")
    call = F.when(F.col("basis") == "none", "keep").otherwise("exclude")
    return rows.select(*KEYS, F.round(q, 6).alias("score"), band.alias("band"), F.round("severity", 6).alias("severity"), "n_strong", triage.alias("triage"), "basis", call.alias("call"))


def withheld(calls: DataFrame) -> DataFrame:
    """The slices that the policy takes out of the analysis, with why."""
    return calls.where("call = 'exclude'").select(*KEYS, "score", "basis")


def call_summary(calls: DataFrame) -> DataFrame:
    """One row a dataset: slices, and how many of each call, triage and basis."""
    n = lambda c, v: F.count_if(F.col(c) == v)
    return calls.groupBy("dataset_id").agg(
        F.count("*").alias("slices"), n("call", "keep").alias("kept"), n("call", "exclude").alias("excluded"), n("triage", "uncertain").alias("uncertain"),
        n("basis", "standard").alias("by_score"), F.count_if(F.col("basis").startswith("tier_")).alias("by_tier"), F.count_if(F.col("basis").endswith("_loss")).alias("by_loss"),
    )


#: What a synthetic capture defect does to a slice's metrics, and the windows that are tried for it: fixed values.
DEFECT, EXTRA_ZEROS = 0.24, 0.35
DEFECT_COLUMNS = ("median_total_counts", "median_n_genes", "library_complexity", "detected_gene_fraction")


def choose_window(slices: DataFrame, candidates: tuple[int, ...] = WINDOWS, targets: int = 8, continuity: DataFrame | None = None) -> DataFrame:
    """(dataset_id, window, recall, gain, flagged, utility, chosen): how well each window finds a capture defect.

    A defect is put into one of at most ``targets`` evenly spaced inner slices at a time; every such series is a dataset of its
    own, so that all trials are scored in one job.  Windows longer than a series aren't tried on it (3 is, if all are).
    """
    order = Window.partitionBy("dataset_id").orderBy("slice_index")
    placed = held(slices.withColumn("_p", F.row_number().over(order) - 1).withColumn("_n", F.count("*").over(Window.partitionBy("dataset_id"))))
    sizes = placed.groupBy("dataset_id").agg(F.first("_n").alias("n"))
    tries = sizes.select("dataset_id", "n", F.explode(F.array(*map(F.lit, candidates))).alias("window")).where((F.col("window") <= F.col("n")) | ((F.col("window") == min(candidates)) & (F.col("n") < min(candidates))))
    half = F.floor(F.col("window") / 2)
    lo, hi = F.greatest(half, F.lit(1)), F.greatest(F.col("n") - half, F.lit(1))
    lo, k = F.when(hi > lo, lo).otherwise(F.lit(0)), F.when(hi > lo, hi - lo).otherwise(F.col("n"))
    spot = lambda i: F.when(k > targets, F.floor(i * (k - 1) / (targets - 1))).otherwise(i)
    tries = tries.withColumn("target", F.explode(F.transform(F.sequence(F.lit(0), F.least(k, F.lit(targets)) - 1), lambda i: (lo + spot(i)).cast("int"))))
    kinds = tries.select("dataset_id", "target").distinct()
    hurt = {c: F.when(F.col("_p") == F.col("target"), F.col(c) * DEFECT).otherwise(F.col(c)) for c in DEFECT_COLUMNS if c in slices.columns}
    if "zero_fraction" in slices.columns:
        hurt["zero_fraction"] = F.when(F.col("_p") == F.col("target"), F.least(lit(0.999), F.col("zero_fraction") + EXTRA_ZEROS)).otherwise(F.col("zero_fraction"))
    trial = placed.join(kinds, "dataset_id").withColumns(hurt)
    both = trial.unionByName(placed.withColumn("target", F.lit(-1)))
    named = both.withColumn("dataset_id", F.to_json(F.struct("dataset_id", "target"))).drop("_n")
    extra = None
    if continuity is not None:
        extra = continuity.join(both.select("dataset_id", "target").distinct(), "dataset_id").withColumn("dataset_id", F.to_json(F.struct("dataset_id", "target"))).drop("target")
    scored = held(score_windows(named, candidates, extra).select("window", "target", "_p", F.get_json_object("dataset_id", "$.dataset_id").alias("dataset_id"), "recommendation", F.col("quality_anomaly_score").alias("q")))
    base = scored.where("target = -1")
    flagged = base.groupBy("dataset_id", "window").agg(F.avg((F.col("recommendation") != "keep").cast("double")).alias("flagged"))
    hits = scored.where("target = _p").join(base.select("dataset_id", "window", "_p", F.col("q").alias("q0")), ["dataset_id", "window", "_p"]).join(tries.select("dataset_id", "window", "target"), ["dataset_id", "window", "target"], "left_semi")
    hits = hits.groupBy("dataset_id", "window").agg(F.avg(F.col("recommendation").isin("review", "exclude").cast("double")).alias("recall"), F.avg(F.col("q") - F.col("q0")).alias("gain"))
    out = hits.join(flagged, ["dataset_id", "window"]).withColumn("utility", F.col("recall") + 0.35 * F.col("gain") - 0.35 * F.col("flagged") - 0.012 * (F.col("window") - 3))
    best = F.row_number().over(Window.partitionBy("dataset_id").orderBy(F.desc("utility"), "window")) == 1
    return out.withColumn("chosen", best)
