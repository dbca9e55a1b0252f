"""The pairwise workflow: id maps, clean exports, replays, recipes, refine candidates, plans, triads, before and after."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slabworks.functions.columns import lit, over, rotate

TOLERANCE = 1e-6


# ------------------------------------------------------------------ ids and exports


def normalized_id(cell: Column, slice_label: Column | None = None) -> Column:
    """An id without a leading ``CELL.``, and with its slice before it where one is given."""
    plain = F.regexp_replace(cell.cast("string"), r"^CELL\.", "")
    return plain if slice_label is None else F.concat_ws("_", slice_label.cast("string"), plain)


def cell_id_map(rows: DataFrame, by: list[str], order: str, cell: str = "cell_id", slice_label: str | None = None) -> DataFrame:
    """(by, row_id, clean_id, repeated): each row's place in its file as ``file:place``, and the id that stands for it.

    The order of rows is a column, never their place in a table; repeated is true for clean ids that stand twice.
    """
    place = F.row_number().over(Window.partitionBy(*by).orderBy(order, cell)) - 1
    out = rows.select(*by, F.concat_ws(":", *[F.col(b).cast("string") for b in by], place.cast("string")).alias("row_id"), normalized_id(F.col(cell), None if slice_label is None else F.col(slice_label)).alias("clean_id"))
    return out.withColumn("repeated", F.count("*").over(Window.partitionBy("clean_id")) > 1)


def mapped(rows: DataFrame, ids: DataFrame, key: str, name: str) -> DataFrame:
    """Rows with the id that ``ids`` has for theirs; a key without one, or with two, is an error when the row is read."""
    one = ids.groupBy(key).agg(F.min(name).alias(name), F.count("*").alias("_n"))
    found = F.when(F.col("_n") == 1, F.col(name)).otherwise(F.raise_error(F.concat(F.lit(f"not exactly one {name}: "), F.coalesce(F.col(key).cast("string"), F.lit("NULL")))))
    return rows.join(one, key, "left").withColumn(name, found).drop("_n")


def clean_export(before: DataFrame, after: DataFrame, edited: Column | None = None, tolerance: float = TOLERANCE) -> DataFrame:
    """(cell_id, slice_index, celltype, x, y, shift, changed) of all points after edits.

    changed is true for a point that has moved by more than the tolerance, or that an edit label names even if it hasn't.
    """
    old = before.select("cell_id", F.col("x").alias("x0"), F.col("y").alias("y0"))
    shift = F.hypot(F.col("x") - F.col("x0"), F.col("y") - F.col("y0"))
    out = after.join(old, "cell_id").withColumn("shift", shift)
    return out.select("cell_id", "slice_index", "celltype", "x", "y", "shift", (F.coalesce(F.col("shift") > tolerance, F.lit(False)) | F.coalesce(edited if edited is not None else F.lit(False), F.lit(False))).alias("changed"))


def replay_differences(full: DataFrame, sample: DataFrame, key: str = "cell_id", tolerance: float = TOLERANCE) -> DataFrame:
    """One row: sampled points, those the full replay lacks, the greatest difference of a coordinate, and whether it's a replay of it."""
    both = sample.select(key, F.col("x").alias("xs"), F.col("y").alias("ys")).join(full.select(key, "x", "y"), key, "left")
    off = F.greatest(F.abs(F.col("x") - F.col("xs")), F.abs(F.col("y") - F.col("ys")))
    out = both.agg(F.count("*").alias("points"), F.count_if(F.col("x").isNull()).alias("missing"), F.max(off).alias("greatest"))
    return out.withColumn("same", (F.col("missing") == 0) & F.coalesce(F.col("greatest") <= tolerance, F.lit(True)))


def close_coordinates(left: DataFrame, right: DataFrame, keys: list[str], rtol: float = 1e-4, atol: float = 1e-7) -> DataFrame:
    """(side, rows, far): a full one-to-one join's rows by side, and how many on both sides are farther apart than atol + rtol x size."""
    a = left.select(*keys, F.col("x").alias("ax"), F.col("y").alias("ay"))
    b = right.select(*keys, F.col("x").alias("bx"), F.col("y").alias("b_y"))
    far = lambda p, q: F.abs(F.col(p) - F.col(q)) > F.abs(F.col(q)) * rtol + atol
    side = F.when(F.col("ax").isNull(), "right_only").when(F.col("bx").isNull(), "left_only").otherwise("both")
    return a.join(b, keys, "full_outer").groupBy(side.alias("side")).agg(F.count("*").alias("rows"), F.count_if(far("ax", "bx") | far("ay", "b_y")).alias("far"))


# ------------------------------------------------------------------ recipes

_EDGE = r"(?i)SL\s*0*(\d+)[_-]+SL\s*0*(\d+)"


def recipe_kind(text: Column) -> Column:
    """What kind of edit a recipe's text tells of."""
    low = F.lower(text)
    return F.when(low.rlike("drop|roi"), "roi_drop_refine").when(low.contains("spatial_only"), "spatial_only_rescue").when(low.rlike("edge_transform|pairwise"), "pairwise_transform").otherwise("manual_recipe")


def recipe_edge(text: Column) -> Column:
    """The edge that a text names, as SLa__SLb; empty without one."""
    a, b = F.regexp_extract(text, _EDGE, 1), F.regexp_extract(text, _EDGE, 2)
    return F.when(a != "", F.concat(F.lit("SL"), a, F.lit("__SL"), b)).otherwise("")


def recipe_mode(text: Column) -> Column:
    return F.when(F.lower(text).contains("spatial_only"), "spatial_only").otherwise("normal")


# ------------------------------------------------------------------ refine candidates

# Fixed values of the search and its verdicts.
ROTATIONS, SHIFTS = (-10.0, -5.0, 0.0, 5.0, 10.0), (-1500.0, 0.0, 1500.0)
ALL_WEIGHT, OTHER_WEIGHT, TOO_WORSE, PROMISING = 0.5, 1.5, 1.0, 0.75


def label_centres(rows: DataFrame) -> DataFrame:
    """Both sides' centres and radii by label: (label, fx, fy, rf, nf) and (mx, my, rm, nm); a radius is the median distance from the centre.

    A turn leaves nothing of a point with a missing coordinate: ux, uy and ru are of the moving side without such points.
    """
    of = lambda c, s: F.when(F.col("side") == s, F.col(c))
    whole = lambda c: F.when(F.col("x").isNotNull() & F.col("y").isNotNull(), of(c, "m"))
    means = [F.avg(of(c, s)).alias(f"{s}{c}") for s in "fm" for c in "xy"] + [F.avg(whole(c)).alias(f"u{c}") for c in "xy"]
    centre = rows.groupBy("label").agg(*means, *[F.count_if(F.col("side") == s).alias(f"n{s}") for s in "fm"])
    far = lambda s: F.hypot(F.col("x") - F.col(f"{s}x"), F.col("y") - F.col(f"{s}y"))
    moving = F.col("side") == "m"
    r = rows.join(centre, "label").select("label", F.when(~moving, far("f")).alias("rf"), F.when(moving, far("m")).alias("rm"), F.when(moving, far("u")).alias("ru"))
    r = r.groupBy("label", "rf", "rm", "ru").agg(F.count("*").alias("n"))  # equal distances go to the median as one row
    return centre.join(r.groupBy("label").agg(*[F.percentile(c, F.lit(0.5), F.col("n")).alias(c) for c in ("rf", "rm", "ru")]), "label")


def _jump(x: Column, y: Column, radius: str) -> Column:
    """Distance of a centre from the fixed side's, over the mean of both radii."""
    return over(F.hypot(F.col("fx") - x, F.col("fy") - y), (F.col("rf") + F.col(radius)) / 2)


def refine_candidates(rows: DataFrame, label: str, base: tuple[float, float, float] = (0.0, 0.0, 0.0), rotations: tuple[float, ...] = ROTATIONS, shifts: tuple[float, ...] = SHIFTS, guard: int = 30, top: int = 20) -> DataFrame:
    """The best rigid corrections of an edge's moving slice for one label: degrees, dx, dy, improvement, all_worse, other_worse, rank_score, verdict and place.

    rows(side, cell_id, x, y, label) of one edge.  Candidates are a grid of turns (about the moving label's centre) and
    shifts around ``base``; equal ones count once.  A candidate improves the label's jump; it is marked down for what it
    does to all cells, and more for the label that it harms most among those with ``guard`` points on both sides.

    A rigid motion takes centres along and keeps distances from them, so candidates are tried on the labels' centres.
    """
    spark = rows.sparkSession
    grid = spark.createDataFrame(sorted({(round(base[0] + r, 6), round(base[1] + dx, 3), round(base[2] + dy, 3)) for r in rotations for dx in shifts for dy in shifts}), "degrees double, dx double, dy double")
    centre = rows.where((F.col("side") == "m") & (F.col("label") == label)).agg(F.avg("x").alias("cx"), F.avg("y").alias("cy"))
    keys = ["degrees", "dx", "dy"]
    labels = label_centres(rows.unionByName(rows.withColumn("label", F.lit("\x00all"))))
    tx, ty = rotate(F.col("ux"), F.col("uy"), F.radians("degrees"), F.col("cx"), F.col("cy"))
    tried = labels.crossJoin(F.broadcast(centre)).crossJoin(F.broadcast(grid))  # one centre, and a grid of fixed size
    after = tried.select(*keys, "label", "nf", "nm", _jump(tx + F.col("dx"), ty + F.col("dy"), "ru").alias("jump"), _jump(F.col("mx"), F.col("my"), "rm").alias("before"))
    worse = F.coalesce(F.col("jump") - F.col("before"), lit(0))
    is_all, is_own = F.col("label") == "\x00all", F.col("label") == label
    other = ~is_all & ~is_own & (F.col("nf") >= guard) & (F.col("nm") >= guard)
    out = after.groupBy(*keys).agg((-F.max(F.when(is_own, worse))).alias("improvement"), F.max(F.when(is_all, worse)).alias("all_worse"), F.greatest(F.max(F.when(other, worse)), lit(0)).alias("other_worse"))
    # a turn about the label's own centre changes nothing but the last digits
    out = out.withColumns({"other_worse": F.coalesce("other_worse", lit(0)), "improvement": F.round("improvement", 9) + 0.0})
    out = out.withColumn("rank_score", -F.col("improvement") + F.greatest("all_worse", lit(0)) * ALL_WEIGHT + F.col("other_worse") * OTHER_WEIGHT)
    verdict = F.when(F.col("improvement") <= 0, "reject_no_target_improvement").when((F.col("all_worse") > TOO_WORSE) | (F.col("other_worse") > TOO_WORSE), "review_guardrail_degradation").when(F.col("improvement") > PROMISING, "promising_candidate").otherwise("weak_candidate")
    place = F.row_number().over(Window.orderBy(F.round("rank_score", 9), *keys))  # a grid of fixed size
    return out.withColumn("verdict", verdict).withColumn("place", place).where(F.col("place") <= top)


# ------------------------------------------------------------------ plans and summaries


def initial_plan(slices: DataFrame) -> DataFrame:
    """(dataset_id, edge_order, edge_id, fixed, moving): a job for each pair of neighbours, in order."""
    w = Window.partitionBy("dataset_id").orderBy("slice_index")
    rows = slices.select("dataset_id", F.col("slice_index").alias("fixed"), F.lead("slice_index").over(w).alias("moving"), F.row_number().over(w).alias("edge_order")).where("moving is not null")
    return rows.withColumn("edge_id", F.concat(F.lit("SL"), F.lpad(F.col("fixed").cast("string"), 3, "0"), F.lit("__SL"), F.lpad(F.col("moving").cast("string"), 3, "0")))


def job_summary(plan: DataFrame, results: DataFrame, key: str = "edge_id") -> DataFrame:
    """Per status (missing for jobs without a result): jobs, and the mean, median and greatest sigma2."""
    both = plan.select(key).join(results.select(key, "status", "sigma2"), key, "left")
    return both.groupBy(F.coalesce("status", F.lit("missing")).alias("status")).agg(F.count("*").alias("jobs"), F.avg("sigma2").alias("mean"), F.percentile("sigma2", F.lit(0.5)).alias("median"), F.max("sigma2").alias("most"))


def inventory_changes(before: DataFrame, after: DataFrame, key: str, value: str) -> DataFrame:
    """(key, before, after, change): added, removed, changed or same; names are compared in lower case with dashes."""
    name = F.regexp_replace(F.lower(key), "_", "-")
    side = lambda d, tag: d.groupBy(name.alias("name")).agg(F.max(value).alias(tag), F.lit(True).alias(f"_{tag}"))
    both = side(before, "before").join(side(after, "after"), "name", "full_outer")
    change = F.when(F.col("_before").isNull(), "added").when(F.col("_after").isNull(), "removed").when(F.col("before").eqNullSafe(F.col("after")), "same").otherwise("changed")
    return both.select("name", "before", "after", change.alias("change"))


# ------------------------------------------------------------------ triads


def component_boxes(summary: DataFrame, least_points: int = 0) -> DataFrame:
    """Component rows that count (rank above 0, enough points) with width, height, area, diagonal and aspect."""
    w, h = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    return summary.where((F.col("rank") > 0) & (F.col("points") >= least_points)).withColumns({"width": w, "height": h, "area": w * h, "diag": F.hypot(w, h), "aspect": w / F.greatest(h, lit(1e-6))})


def triad_summary(scan: DataFrame) -> DataFrame:
    """Per status: triads, slices in the middle, and the greatest score."""
    return scan.groupBy("status").agg(F.count("*").alias("triads"), F.countDistinct("slice_m").alias("slices"), F.max("score").alias("most"))


def triad_preview(points: DataFrame, scan: DataFrame) -> DataFrame:
    """Points of flagged middle components moved so that their centre lies between their neighbours'; others stay.

    points(dataset_id, slice_index, rank, cell_id, x, y); scan(dataset_id, slice_a, slice_m, slice_b, rank, status).
    """
    centres = points.where("rank > 0").groupBy("dataset_id", "slice_index", "rank").agg(F.avg("x").alias("cx"), F.avg("y").alias("cy"))
    of = lambda s: centres.select("dataset_id", F.col("slice_index").alias(f"slice_{s}"), "rank", F.col("cx").alias(f"x_{s}"), F.col("cy").alias(f"y_{s}"))
    flagged = scan.where("status = 'flagged'").select("dataset_id", "slice_a", "slice_m", "slice_b", "rank")
    for s in "amb":
        flagged = flagged.join(of(s), ["dataset_id", f"slice_{s}", "rank"])
    shift = flagged.select("dataset_id", F.col("slice_m").alias("slice_index"), "rank", ((F.col("x_a") + F.col("x_b")) / 2 - F.col("x_m")).alias("dx"), ((F.col("y_a") + F.col("y_b")) / 2 - F.col("y_m")).alias("dy"))
    out = points.join(shift, ["dataset_id", "slice_index", "rank"], "left")
    return out.select("dataset_id", "slice_index", "rank", "cell_id", (F.col("x") + F.coalesce("dx", lit(0))).alias("x"), (F.col("y") + F.coalesce("dy", lit(0))).alias("y"), F.col("dx").isNotNull().alias("moved"))


# ------------------------------------------------------------------ before and after


def slice_offsets(points: DataFrame) -> DataFrame:
    """(slice_index, first, n, bounds): where each slice's points begin if slices are laid end to end in order."""
    s = points.groupBy("slice_index").agg(F.count("*").alias("n"), *[f(c).alias(f"{c}_{name}") for c in "xy" for name, f in (("least", F.min), ("most", F.max))])
    before = F.coalesce(F.sum("n").over(Window.orderBy("slice_index").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row a slice
    return s.withColumn("first", before)


def slice_order_table(slices: DataFrame, spacing: float) -> DataFrame:
    """(dataset_id, slice_index, place, relative_z, z_display) of the slices of each series."""
    w = Window.partitionBy("dataset_id")
    place = F.row_number().over(w.orderBy("slice_index"))
    return slices.select("dataset_id", "slice_index").distinct().select("dataset_id", "slice_index", place.alias("place"), (F.col("slice_index") - F.min("slice_index").over(w)).alias("relative_z"), ((place - 1) * lit(spacing)).alias("z_display"))


def display_motion(points: DataFrame, motions: DataFrame, keys: list[str]) -> DataFrame:
    """Points in the common frame: motions(keys, theta, tx, ty)."""
    c, s = F.cos("theta"), F.sin("theta")
    both = points.join(motions.select(*keys, "theta", "tx", "ty"), keys)
    return both.withColumns({"x": c * F.col("x") - s * F.col("y") + F.col("tx"), "y": s * F.col("x") + c * F.col("y") + F.col("ty")}).drop("theta", "tx", "ty")


def roi_corners(motions: DataFrame, x0: float, y0: float, x1: float, y1: float) -> DataFrame:
    """The four corners of a rectangle of the common frame in each slice's own coordinates: (keys..., corner, x, y)."""
    corners = F.array(*[F.struct(F.lit(i).alias("corner"), lit(x).alias("u"), lit(y).alias("v")) for i, (x, y) in enumerate(((x0, y0), (x1, y0), (x1, y1), (x0, y1)))])
    rows = motions.withColumn("_c", F.explode(corners))
    u, v = F.col("_c.u") - F.col("tx"), F.col("_c.v") - F.col("ty")
    c, s = F.cos("theta"), F.sin("theta")
    return rows.withColumns({"corner": F.col("_c.corner"), "x": c * u + s * v, "y": c * v - s * u}).drop("_c", "theta", "tx", "ty")
