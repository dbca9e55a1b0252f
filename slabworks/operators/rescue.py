"""Rescues of badly placed slices from proposed rigid motions: how much of a proposal is taken, and by which gates.

Proposals come from outside as rows (dataset_id, place, theta, tx, ty): what a fit would turn and shift the slice at
that place of its series by.  All shares of all proposals of all series are scored in the same joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slabworks.functions.columns import lit
from slabworks.operators import continuity as K
from slabworks.session import held

# Shares of a motion that are tried, and the gates of each rescue.
SHARES = (0.0, 0.25, 0.5, 0.75, 1.0)
GAIN, ENDPOINT_LIMIT, LABEL_LIMIT = 0.015, 1.08, 1.15
SPARSE_RATIO, SPARSE_SCORE, SPARSE_GAIN, SPARSE_TURN, SPARSE_SHIFT = 0.50, 1.45, 0.08, 20.0, 0.25
LINEAGE_POINTS, LINEAGE_SUPPORT, LINEAGE_GAIN, LINEAGE_TURN, LINEAGE_SHIFT = 40, 8, 0.15, 12.0, 0.18

PAIR = ["dataset_id", "boundary"]


def part_of_motion(share: Column) -> tuple[Column, Column, Column]:
    """A share of the rigid motion theta, tx, ty: of its angle, taken the short way round, and of its shift."""
    return share * F.atan2(F.sin("theta"), F.cos("theta")), share * F.col("tx"), share * F.col("ty")


def _moved(theta: Column, tx: Column, ty: Column) -> tuple[Column, Column]:
    x, y = F.col("x"), F.col("y")
    return F.cos(theta) * x - F.sin(theta) * y + tx, F.sin(theta) * x + F.cos(theta) * y + ty


def _trials(points: DataFrame, proposals: DataFrame, boundaries: Column) -> DataFrame:
    """Rows of the pairs whose score a proposal changes, once a share: (dataset_id, place, boundary, share, side, cell_id, x, y, label, shift of a point)."""
    rows = K.adjacent_pairs(points)
    p = proposals.withColumn("boundary", F.explode(boundaries))
    t = rows.join(p, PAIR).withColumn("share", F.explode(F.array(*map(lit, SHARES))))
    own = F.col("place") == F.col("boundary") + F.when(F.col("side") == "m", 1).otherwise(0)
    nx, ny = _moved(*part_of_motion(F.col("share")))
    return t.withColumns({"x": F.when(own, nx).otherwise(F.col("x")), "y": F.when(own, ny).otherwise(F.col("y"))})


def _gain(before: Column, after: Column) -> Column:
    return (before - after) / F.greatest(before, lit(1e-12))


def fractional_rescues(points: DataFrame, proposals: DataFrame) -> DataFrame:
    """(dataset_id, place, accepted, share, score_before, score_after, gain, best_share, best_score, theta, tx, ty): the smallest share of each proposal that passes all gates.

    The slice at ``place`` moves towards the next one; the objective is the mean score of its boundary with that slice and of
    the one before.  A share has to lower it by 1.5 % without worsening either end by more than 8 % or the labels by
    more than 15 %; the smallest such share is taken, since the slice belongs to a block that is coherent in itself.  Without one the
    slice stays, and best_ tells which share would have scored best.  Proposals of a place that is the last or not there have no row.
    """
    scored = K.alignment_scores(_trials(points, proposals, F.array_distinct(F.array(F.greatest(F.col("place") - 1, F.lit(0)), F.col("place")))), ["dataset_id", "place", "boundary", "share"])
    at = lambda c: F.max(F.when(F.col("boundary") == F.col("place"), F.col(c))).alias(c)
    each = held(scored.groupBy("dataset_id", "place", "share").agg(F.avg("v2").alias("score"), at("endpoint_low"), at("endpoint_high"), at("annotation")).where("annotation is not null"))
    base = each.where("share = 0").select("dataset_id", "place", *[F.col(c).alias(f"{c}_0") for c in ("score", "endpoint_low", "endpoint_high", "annotation")])
    each = each.join(base, ["dataset_id", "place"]).withColumn("gain", _gain(F.col("score_0"), F.col("score")))
    ends = (F.col("endpoint_low") <= F.col("endpoint_low_0") * ENDPOINT_LIMIT) & (F.col("endpoint_high") <= F.col("endpoint_high_0") * ENDPOINT_LIMIT)
    good = (F.col("share") > 0) & (F.col("gain") >= GAIN) & ends & (F.col("annotation") <= F.col("annotation_0") * LABEL_LIMIT)
    one = each.groupBy("dataset_id", "place").agg(
        F.min(F.when(good, F.struct("share", "score", "gain"))).alias("g"), F.min(F.struct("score", "share")).alias("b"), F.first("score_0").alias("score_before")
    )
    accepted = F.col("g").isNotNull()
    one = one.join(proposals, ["dataset_id", "place"]).withColumn("share", F.coalesce("g.share", lit(0)))
    theta, tx, ty = part_of_motion(F.col("share"))
    return one.select("dataset_id", "place", accepted.alias("accepted"), "share", "score_before", F.coalesce("g.score", "score_before").alias("score_after"), F.coalesce("g.gain", lit(0)).alias("gain"), F.col("b.share").alias("best_share"), F.col("b.score").alias("best_score"), theta.alias("theta"), tx.alias("tx"), ty.alias("ty"))


def _robust_diagonal(by: list[str], rows: DataFrame) -> DataFrame:
    """(by, diagonal, mx, my): extent between the 2nd and 98th percentiles, and coordinate medians."""
    q = lambda c: F.percentile(c, F.array(lit(0.02), lit(0.98)))
    wide = lambda c: F.get(q(c), F.lit(1)) - F.get(q(c), F.lit(0))
    return rows.groupBy(*by).agg(F.greatest(F.hypot(wide("x"), wide("y")), lit(1e-8)).alias("diagonal"), F.percentile("x", lit(0.5)).alias("mx"), F.percentile("y", lit(0.5)).alias("my"))


def _placed(points: DataFrame) -> DataFrame:
    """points with place and last_place in their series."""
    s = points.select("dataset_id", "slice_index").distinct().withColumn("place", F.row_number().over(Window.partitionBy("dataset_id").orderBy("slice_index")) - 1)
    s = s.withColumn("last_place", F.max("place").over(Window.partitionBy("dataset_id")))
    return points.where("x is not null and y is not null").join(s, ["dataset_id", "slice_index"])


def _centre_shift(points: DataFrame, motions: DataFrame) -> DataFrame:
    """(dataset_id, place, share, turn, ratio): degrees that a motion turns a slice by, and how far its median centre goes, over its robust diagonal."""
    at = _placed(points).join(motions, ["dataset_id", "place"])
    nx, ny = _moved(F.col("theta"), F.col("tx"), F.col("ty"))
    by = ["dataset_id", "place", "share"]
    before, after = _robust_diagonal(by, at), _robust_diagonal(by, at.withColumn("_x", nx).withColumn("_y", ny).drop("x", "y").withColumnsRenamed({"_x": "x", "_y": "y"}))
    both = before.join(after.select(*by, F.col("mx").alias("nx"), F.col("my").alias("ny")), by).join(motions, by)
    turn = F.abs(F.degrees(F.atan2(F.sin("theta"), F.cos("theta"))))
    return both.select(*by, turn.alias("turn"), (F.hypot(F.col("nx") - F.col("mx"), F.col("ny") - F.col("my")) / F.col("diagonal")).alias("ratio"))


def sparse_end_rescues(points: DataFrame, proposals: DataFrame) -> DataFrame:
    """(dataset_id, place, triggered, accepted, share, count_ratio, score_before, score_after, gain, turn, ratio) of proposals for a series' first or last slice.

    Such a slice is looked at if it has less than half of its neighbour's points and their score is above 1.45 times the
    series' median.  The best scoring share is taken if it lowers the score by 8 % and neither turns the slice by more
    than 20 degrees nor moves its centre by more than a quarter of its diagonal.
    """
    placed = _placed(points)
    counts = placed.groupBy("dataset_id", "place").agg(F.count("*").alias("n"), F.first("last_place").alias("last_place"))
    ends = proposals.join(counts, ["dataset_id", "place"]).where("last_place > 0 and (place = 0 or place = last_place)")
    fixed = F.when(F.col("place") == 0, 1).otherwise(F.col("place") - 1)
    ends = held(ends.withColumn("fixed", fixed).join(counts.select("dataset_id", F.col("place").alias("fixed"), F.col("n").alias("m")), ["dataset_id", "fixed"]).withColumn("count_ratio", F.col("n") / F.col("m")))
    all_scores = K.alignment_scores(K.adjacent_pairs(points), PAIR)
    median = all_scores.groupBy("dataset_id").agg(F.percentile("v2", lit(0.5)).alias("median_score"))
    p = ends.select("dataset_id", "place", "theta", "tx", "ty")
    scored = K.alignment_scores(_trials(points, p, F.array(F.greatest(F.lit(0), F.when(F.col("place") == 0, 0).otherwise(F.col("place") - 1)))), ["dataset_id", "place", "boundary", "share"])
    each = held(scored.select("dataset_id", "place", "share", F.col("v2").alias("score")))
    one = each.groupBy("dataset_id", "place").agg(F.min(F.struct("score", "share")).alias("b"), F.max(F.when(F.col("share") == 0, F.col("score"))).alias("score_before"))
    one = one.join(ends, ["dataset_id", "place"]).join(median, "dataset_id").withColumn("best", F.col("b.share"))
    theta, tx, ty = part_of_motion(F.col("best"))
    motions = one.select("dataset_id", "place", F.col("best").alias("share"), theta.alias("theta"), tx.alias("tx"), ty.alias("ty"))
    one = one.join(_centre_shift(points, motions).drop("share"), ["dataset_id", "place"])
    gain = _gain(F.col("score_before"), F.col("b.score"))
    triggered = (F.col("count_ratio") < SPARSE_RATIO) & (F.col("score_before") > SPARSE_SCORE * F.col("median_score"))
    accepted = triggered & (F.col("best") > 0) & (gain >= SPARSE_GAIN) & (F.col("turn") <= SPARSE_TURN) & (F.col("ratio") <= SPARSE_SHIFT)
    return one.select(
        "dataset_id", "place", triggered.alias("triggered"), accepted.alias("accepted"), F.when(accepted, F.col("best")).otherwise(lit(0)).alias("share"), "count_ratio", "score_before",
        F.when(accepted, F.col("b.score")).otherwise(F.col("score_before")).alias("score_after"), F.when(accepted, gain).otherwise(lit(0)).alias("gain"), "turn", "ratio",
    )


def lineage_labels(points: DataFrame, last: int, priority: str | None = None) -> DataFrame:
    """(dataset_id, label): the label that the last slices of a series are aligned by.

    It has 40 points or more in each of them.  ``priority`` is taken where it qualifies, else the label of the most support
    for its spread: the root of its least count over 0.15 and the median share of its diagonal in the slices' (the last in order on a tie).
    """
    t = _placed(points).where((F.col("place") > F.col("last_place") - last) & F.col("celltype").isNotNull())
    whole = _robust_diagonal(["dataset_id", "place"], _placed(points).where(F.col("place") > F.col("last_place") - last))
    own = t.groupBy("dataset_id", "place", "celltype").agg(F.count("*").alias("n")).join(_robust_diagonal(["dataset_id", "place", "celltype"], t).select("dataset_id", "place", "celltype", F.col("diagonal").alias("d")), ["dataset_id", "place", "celltype"])
    slices = whole.groupBy("dataset_id").agg(F.count("*").alias("k"))
    own = own.join(whole.select("dataset_id", "place", "diagonal"), ["dataset_id", "place"])
    ranked = own.groupBy("dataset_id", "celltype").agg(F.count("*").alias("have"), F.min("n").alias("least"), F.percentile(F.col("d") / F.col("diagonal"), lit(0.5)).alias("spread")).join(slices, "dataset_id")
    ranked = ranked.where((F.col("have") == F.col("k")) & (F.col("least") >= LINEAGE_POINTS))
    first = F.col("celltype") == F.lit(priority) if priority is not None else F.lit(False)
    rank = F.struct(first.alias("p"), (F.sqrt("least") / (F.col("spread") + 0.15)).alias("r"), F.col("celltype").alias("label"))
    return ranked.groupBy("dataset_id").agg(F.max(rank).alias("b")).select("dataset_id", "b.label")


def lineage_end_rescues(points: DataFrame, proposals: DataFrame, last: int = 3, priority: str | None = None) -> DataFrame:
    """(dataset_id, label, accepted, lineage_before, lineage_after, gain, full_before, full_after, turn, ratio): whether a series' last slices take their proposals.

    The last slice stays; every proposal for one of the ``last`` before it is applied whole.  They are taken together, if the mean
    distance within the label falls by 15 % and no slice turns by more than 12 degrees or moves its centre by
    more than 0.18 of its diagonal.  Series without a label that qualifies have no row.
    """
    placed = _placed(points)
    label = held(lineage_labels(points, last, priority))
    ends = placed.where(F.col("place") > F.col("last_place") - last)
    movable = proposals.join(ends.where("place < last_place").select("dataset_id", "place").distinct(), ["dataset_id", "place"], "left_semi").join(label, "dataset_id", "left_semi")
    movable = held(movable.select("dataset_id", "place", lit(1).alias("share"), "theta", "tx", "ty"))
    nx, ny = _moved(F.coalesce("theta", lit(0)), F.coalesce("tx", lit(0)), F.coalesce("ty", lit(0)))
    moved = ends.join(movable.drop("share"), ["dataset_id", "place"], "left").withColumn("_x", nx).withColumn("_y", ny).drop("x", "y").withColumnsRenamed({"_x": "x", "_y": "y"})
    out = label
    for tag, frame in (("before", ends), ("after", moved)):
        rows = held(K.adjacent_pairs(frame))
        scores = K.alignment_scores(rows, PAIR).join(label, "dataset_id")
        distances = K.lineage_distances(rows, PAIR)
        s = scores.join(distances, [*PAIR, "label"], "left").groupBy("dataset_id").agg(F.avg("v2").alias(f"full_{tag}"), F.avg("distance").alias("l"))
        out = out.join(s.select("dataset_id", f"full_{tag}", F.coalesce("l", f"full_{tag}").alias(f"lineage_{tag}")), "dataset_id")
    most = _centre_shift(points, movable).groupBy("dataset_id").agg(F.max("turn").alias("turn"), F.max("ratio").alias("ratio"))
    out = out.join(most, "dataset_id", "left").withColumns({"turn": F.coalesce("turn", lit(0)), "ratio": F.coalesce("ratio", lit(0))})
    gain = _gain(F.col("lineage_before"), F.col("lineage_after"))
    accepted = (gain >= LINEAGE_GAIN) & (F.col("turn") <= LINEAGE_TURN) & (F.col("ratio") <= LINEAGE_SHIFT)
    return out.select("dataset_id", "label", accepted.alias("accepted"), "lineage_before", "lineage_after", gain.alias("gain"), "full_before", "full_after", "turn", "ratio")


def chained_edges(edges: DataFrame, most: int = 20) -> DataFrame:
    """(dataset_id, edge, m00 ... m12): each edge's matrix folded with those of all edges before it in its series, in order.

    edges(dataset_id, edge, m00 ... m12) take a slice into the one before, so that the fold takes slice ``edge`` + 1
    into the first.  Matrices are folded by doubling: after k rounds a row holds the product of 2^k of them, so a
    series of n edges takes log n joins and no task sees more than pairs; at most 2^most edges a series.  A series with a gap or a
    missing number has NULLs from there on.
    """
    m = [f"m{i}{j}" for i in (0, 1) for j in (0, 1, 2)]
    out = held(edges.select("dataset_id", "edge", *m).withColumn("first", F.col("edge")))
    start = F.min("edge").over(Window.partitionBy("dataset_id"))
    out = held(out.withColumn("start", start))
    for _ in range(most):
        if out.where("first > start").limit(1).count() == 0:
            break
        before = out.select("dataset_id", (F.col("edge") + 1).alias("first"), F.col("first").alias("_first"), *[F.col(c).alias(f"_{c}") for c in m])
        both = out.where("first > start").join(before, ["dataset_id", "first"], "left")
        cell = {}
        for i in (0, 1):
            for j in (0, 1, 2):
                value = F.col(f"_m{i}0") * F.col(f"m0{j}") + F.col(f"_m{i}1") * F.col(f"m1{j}")
                cell[f"m{i}{j}"] = value + F.col(f"_m{i}2") if j == 2 else value
        joined = both.select("dataset_id", "edge", *[cell[c].alias(c) for c in m], F.coalesce("_first", "start").alias("first"), "start")
        out = held(out.where("first = start").unionByName(joined))
    return out.select("dataset_id", "edge", *m)


def chain_lineage(points: DataFrame, operations: list[dict], tolerance: float = 1e-9) -> tuple[DataFrame, DataFrame]:
    """(points after all operations, a row an operation: order, operation_id, edge_id, affected, changed, mean_shift, max_shift, residual).

    Operations {operation_id, edge_id, steps, affected_slices} are replayed in order; ids that are missing are op_001 and so on, and without affected_slices
    those of the steps' scopes are told.  changed counts points that moved by more than ``tolerance``, shifts are of those.  residual is the greatest
    distance between the points so far and those that a replay from the source gives.
    """
    from slabworks.operators.geometry import apply_recipe

    spark = points.sparkSession
    now, log, steps = held(points), [], []
    for i, op in enumerate(operations, 1):
        steps = [*steps, *op["steps"]]
        after = held(apply_recipe(now, op["steps"]))
        d = F.hypot(F.col("x") - F.col("x0"), F.col("y") - F.col("y0"))
        both = after.join(now.select("cell_id", F.col("x").alias("x0"), F.col("y").alias("y0")), "cell_id")
        moved = both.agg(F.count_if(d > tolerance).alias("n"), F.avg(F.when(d > tolerance, d)).alias("mean"), F.max(F.when(d > tolerance, d)).alias("most")).first()
        again = apply_recipe(points, steps).select("cell_id", F.col("x").alias("x0"), F.col("y").alias("y0"))
        residual = after.join(again, "cell_id").agg(F.max(d).alias("r")).first().r
        named = op.get("affected_slices") or sorted({s for step in op["steps"] for s in step.get("slices", ())})
        log.append((i, op.get("operation_id") or f"op_{i:03d}", op.get("edge_id"), ";".join(map(str, named)), int(moved.n), float(moved.mean or 0), float(moved.most or 0), float(residual or 0)))
        now = after
    return now, spark.createDataFrame(log, "step_order int, operation_id string, edge_id string, affected string, changed long, mean_shift double, max_shift double, residual double")
