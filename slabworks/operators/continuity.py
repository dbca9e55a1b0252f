"""How well neighbouring slices continue each other: geometry, label, shape, endpoint and extent terms of an alignment score.

Pairs are rows (pair columns, side, cell_id, x, y, label) with side 'm' for the moving slice and 'f' for the fixed
one, so that every pair of every series, and every candidate of a repair, is scored in the same joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slabworks.functions.columns import lit
from slabworks.operators.relational import nearest_between
from slabworks.session import held

# Fixed values of the scores: weights of their terms, label support, caps and cuts.
V1 = {"geometry": 0.42, "annotation": 0.30, "endpoint": 0.18, "extent": 0.10}
V2 = {"geometry": 0.22, "annotation": 0.18, "shape": 0.18, "endpoint_max": 0.34, "extent": 0.08}
LABEL_POINTS, CENTRE_CAP, SHAPE_CAP = 8, 30.0, 18.0
ENDS = (0.06, 0.94)


def adjacent_pairs(points: DataFrame) -> DataFrame:
    """(dataset_id, boundary, side, cell_id, x, y, label): each slice as the fixed one before and the moving one after a boundary.

    boundary is the fixed slice's place in its series, from 0.
    """
    places = points.select("dataset_id", "slice_index").distinct().withColumn("_p", F.row_number().over(Window.partitionBy("dataset_id").orderBy("slice_index")) - 1)
    last = F.max("_p").over(Window.partitionBy("dataset_id"))
    roles = F.array(F.struct(F.col("_p").alias("boundary"), F.lit("f").alias("side")), F.struct((F.col("_p") - 1).alias("boundary"), F.lit("m").alias("side")))
    places = places.withColumn("_last", last).select("dataset_id", "slice_index", "_last", F.explode(roles).alias("_r")).where((F.col("_r.boundary") >= 0) & (F.col("_r.boundary") < F.col("_last")))
    p = points.select("dataset_id", "slice_index", "cell_id", "x", "y", F.col("celltype").alias("label")).where("x is not null and y is not null")
    return p.join(places, ["dataset_id", "slice_index"]).select("dataset_id", "_r.boundary", "_r.side", "cell_id", "x", "y", "label")


def _by_side(rows: DataFrame, pair: list[str], columns: list[str]) -> DataFrame:
    """One row a pair with each column of both sides, named <column>_m and <column>_f."""
    return rows.groupBy(*pair).agg(*[F.max(F.when(F.col("side") == s, F.col(c))).alias(f"{c}_{s}") for c in columns for s in "mf"])


def _trimmed(rows: DataFrame, by: list[str], value: str, quantile: float, name: str) -> DataFrame:
    """Mean of the values up to their quantile."""
    cut = F.percentile(value, F.lit(quantile)).over(Window.partitionBy(*by))
    return rows.withColumn("_cut", cut).where(F.col(value) <= F.col("_cut")).groupBy(*by).agg(F.avg(value).alias(name))


def _nearest_both(rows: DataFrame, within: list[str]) -> DataFrame:
    """(within, side, d): each point's distance to the other side's nearest point."""
    m, f = (rows.where(F.col("side") == s).drop("side") for s in "mf")
    there = nearest_between(m, f, 1, within).select(*within, F.lit("m").alias("side"), F.sqrt("d2").alias("d"))
    return there.union(nearest_between(f, m, 1, within).select(*within, F.lit("f").alias("side"), F.sqrt("d2").alias("d")))


def endpoints(rows: DataFrame, pair: list[str]) -> DataFrame:
    """(pair, side, end, ex, ey): median centres of the four ends of a slice's outline along the fixed slice's axes.

    Ends are low1, high1 (long axis), low2 and high2; axes come from the second moments about the coordinate medians.
    """
    fixed = rows.where("side = 'f'")
    w = Window.partitionBy(*pair)
    off = fixed.withColumn("dx", F.col("x") - F.percentile("x", F.lit(0.5)).over(w)).withColumn("dy", F.col("y") - F.percentile("y", F.lit(0.5)).over(w))
    turn = (F.atan2(F.sum(F.col("dx") * F.col("dy")) * 2, F.sum(F.col("dx") ** 2) - F.sum(F.col("dy") ** 2)) / 2).alias("turn")
    c, s = F.cos("turn"), F.sin("turn")
    on = rows.join(off.groupBy(*pair).agg(turn), pair).withColumn("p1", c * F.col("x") + s * F.col("y")).withColumn("p2", c * F.col("y") - s * F.col("x"))
    side = Window.partitionBy(*pair, "side")
    q = lambda p: F.percentile(p, F.array(*[lit(e) for e in ENDS])).over(side)
    on = on.withColumn("q1", q("p1")).withColumn("q2", q("p2"))
    within = lambda i, low: F.col(f"p{i}") <= F.get(f"q{i}", F.lit(0)) if low else F.col(f"p{i}") >= F.get(f"q{i}", F.lit(1))
    ends = F.array_compact(F.array(*[F.when(within(i, low), F.lit(f"{'low' if low else 'high'}{i}")) for i in (1, 2) for low in (True, False)]))
    return on.withColumn("end", F.explode(ends)).groupBy(*pair, "side", "end").agg(F.percentile("x", F.lit(0.5)).alias("ex"), F.percentile("y", F.lit(0.5)).alias("ey"))


def alignment_scores(rows: DataFrame, pair: list[str]) -> DataFrame:
    """A row a pair: scale, geometry, annotation, endpoint, extent, shape, endpoint_low, _high and _max, and the scores v1 and v2.

    All distances are divided by the mean of both slices' robust diagonals.  Labels count where both sides have eight
    points of them; without such a label annotation is 1.5 times the geometry, and shape 1.25 times the annotation.
    """
    rows = held(rows)
    q = lambda c: F.percentile(c, F.array(lit(0.02), lit(0.98)))
    wide = lambda c: F.get(q(c), F.lit(1)) - F.get(q(c), F.lit(0))
    sides = rows.groupBy(*pair, "side").agg(wide("x").alias("w"), wide("y").alias("h"))
    sides = _by_side(sides.withColumn("diag", F.greatest(F.hypot("w", "h"), lit(1e-8))), pair, ["w", "h", "diag"])
    scale = (F.col("diag_m") + F.col("diag_f")) / 2
    out = sides.select(*pair, scale.alias("scale"), (F.hypot(F.col("w_m") - F.col("w_f"), F.col("h_m") - F.col("h_f")) / scale).alias("extent"))
    near = _trimmed(_nearest_both(rows.drop("label"), pair), [*pair, "side"], "d", 0.90, "t").groupBy(*pair).agg(F.avg("t").alias("t"))
    out = out.join(near, pair).withColumn("geometry", F.col("t") / F.col("scale")).drop("t")

    keys = [*pair, "label"]
    counted = rows.where("label is not null").withColumn("n", F.count("*").over(Window.partitionBy(*keys, "side")))
    counted = counted.where(F.col("n") >= LABEL_POINTS)
    both = counted.withColumn("sides", F.size(F.collect_set("side").over(Window.partitionBy(*keys)))).where("sides = 2").drop("sides")
    own = Window.partitionBy(*keys, "side")
    both = held(both.withColumn("cx", F.percentile("x", F.lit(0.5)).over(own)).withColumn("cy", F.percentile("y", F.lit(0.5)).over(own)))
    stats = both.groupBy(*keys, "side").agg(F.first("n").alias("n"), F.first("cx").alias("cx"), F.first("cy").alias("cy"), F.percentile(F.hypot(F.col("x") - F.col("cx"), F.col("y") - F.col("cy")), F.lit(0.5)).alias("spread"))
    stats = _by_side(stats, keys, ["n", "cx", "cy", "spread"]).join(out.select(*pair, "scale"), pair)
    support, spread = F.sqrt(F.least("n_m", "n_f").cast("double")), (F.col("spread_m") + F.col("spread_f")) / 2 / F.col("scale")
    stats = stats.withColumn("dist", F.hypot(F.col("cx_m") - F.col("cx_f"), F.col("cy_m") - F.col("cy_f")) / F.col("scale"))
    stats = stats.withColumn("w1", F.least(lit(CENTRE_CAP), support / (spread + 0.08))).withColumn("w2", F.least(lit(SHAPE_CAP), support / (spread + 0.10)))
    shape = _trimmed(_nearest_both(both.select(*keys, "side", "cell_id", "x", "y"), keys), [*keys, "side"], "d", 0.85, "t").groupBy(*keys).agg(F.avg("t").alias("t"))
    labels = stats.join(shape, keys).groupBy(*pair).agg(
        F.count("*").alias("labels"), (F.sum(F.col("w1") * F.col("dist")) / F.sum("w1")).alias("a"), (F.sum(F.col("w2") * F.col("t") / F.col("scale")) / F.sum("w2")).alias("s")
    )
    out = out.join(labels, pair, "left").withColumn("annotation", F.coalesce("a", F.col("geometry") * 1.5)).withColumn("shape", F.coalesce("s", F.col("annotation") * 1.25)).drop("a", "s")

    ends = endpoints(rows, pair)
    gaps = _by_side(ends, [*pair, "end"], ["ex", "ey"]).withColumn("gap", F.hypot(F.col("ex_m") - F.col("ex_f"), F.col("ey_m") - F.col("ey_f")))
    of = lambda e: F.max(F.when(F.col("end") == e, F.col("gap")))
    gaps = gaps.groupBy(*pair).agg(F.avg("gap").alias("_all"), of("low1").alias("_low"), of("high1").alias("_high"))
    out = out.join(gaps, pair).withColumns({"endpoint": F.col("_all") / F.col("scale"), "endpoint_low": F.col("_low") / F.col("scale"), "endpoint_high": F.col("_high") / F.col("scale")})
    out = out.withColumn("endpoint_max", F.greatest("endpoint_low", "endpoint_high")).withColumn("labels", F.coalesce("labels", F.lit(0)))
    total = lambda weights: sum((F.col(c) * w for c, w in weights.items()), lit(0))
    return out.withColumns({"v1": total(V1), "v2": total(V2)}).drop("_all", "_low", "_high")


def lineage_distances(rows: DataFrame, pair: list[str]) -> DataFrame:
    """(pair, label, distance): trimmed nearest distance between the points of one label, both ways, over the scale; labels with eight points on both sides."""
    q = lambda c: F.percentile(c, F.array(lit(0.02), lit(0.98)))
    wide = lambda c: F.get(q(c), F.lit(1)) - F.get(q(c), F.lit(0))
    scale = rows.groupBy(*pair, "side").agg(F.greatest(F.hypot(wide("x"), wide("y")), lit(1e-8)).alias("d")).groupBy(*pair).agg(F.avg("d").alias("scale"))
    keys = [*pair, "label"]
    enough = rows.groupBy(*keys).agg(F.least(F.count_if(F.col("side") == "m"), F.count_if(F.col("side") == "f")).alias("n")).where(F.col("n") >= LABEL_POINTS)
    own = held(rows.join(enough.drop("n"), keys).select(*keys, "side", "cell_id", "x", "y"))
    t = _trimmed(_nearest_both(own, keys), [*keys, "side"], "d", 0.85, "t").groupBy(*keys).agg(F.avg("t").alias("t"))
    return t.join(scale, pair).select(*keys, (F.col("t") / F.col("scale")).alias("distance"))


def terminal_scores(scores: DataFrame, lineage: DataFrame, pair: list[str], series: list[str], label: str) -> DataFrame:
    """(series, full, lineage, score) of a stretch of pairs: 0.52 of the mean v2 and 0.48 of the mean distance within one label, which the former replaces where it is missing."""
    own = scores.join(lineage.where(F.col("label") == label).select(*pair, "distance"), pair, "left").groupBy(*series).agg(F.avg("v2").alias("full"), F.avg("distance").alias("lineage"))
    own = own.withColumn("lineage", F.coalesce("lineage", "full"))
    return own.withColumn("score", F.col("full") * 0.52 + F.col("lineage") * 0.48)


# Fixed values of the block repair: shares of the balanced offset that are tried, and what a repair must bring.
MULTIPLIERS = (0.0, 0.5, 0.75, 1.0, 1.25)
ENDPOINT_GAIN, MEAN_GAIN, TOTAL_GAIN, LABEL_LIMIT = 0.15, 0.05, 0.02, 1.12


def block_translations(rows: DataFrame, pair: list[str]) -> DataFrame:
    """A row a pair: whether shifting the fixed slice's block (that slice and all before it) mends the boundary, and by how much.

    The shift is a share of the offset that brings both ends of the long axis together; of the shares that improve the
    endpoints, their mean and the score enough without hurting the labels, the one with the best score is taken.
    multiplier is 0 and the shift nothing where none does.
    """
    rows = held(rows)
    # the block that moves lies before the boundary: its slice is the moving side of this score
    swapped = rows.withColumn("side", F.when(F.col("side") == "f", "m").otherwise("f"))
    ends = _by_side(endpoints(swapped, pair).where("end in ('low1', 'high1')"), [*pair, "end"], ["ex", "ey"])
    offset = ends.groupBy(*pair).agg(F.avg(F.col("ex_f") - F.col("ex_m")).alias("ox"), F.avg(F.col("ey_f") - F.col("ey_m")).alias("oy"))
    tried = F.array(*map(lit, MULTIPLIERS))
    moved = swapped.join(offset, pair).withColumn("multiplier", F.explode(tried))
    for c, o in (("x", "ox"), ("y", "oy")):
        moved = moved.withColumn(c, F.when(F.col("side") == "m", F.col(c) + F.col("multiplier") * F.col(o)).otherwise(F.col(c)))
    scored = alignment_scores(moved.drop("ox", "oy"), [*pair, "multiplier"])
    base = scored.where("multiplier = 0").select(*pair, F.col("v2").alias("before"), *[F.col(c).alias(f"{c}_0") for c in ("endpoint_max", "endpoint_low", "endpoint_high", "annotation")])
    gain = lambda old, new: (old - new) / F.greatest(old, lit(1e-12))
    both = scored.join(base, pair)
    end_gain = gain(F.col("endpoint_max_0"), F.col("endpoint_max"))
    mean_gain = gain((F.col("endpoint_low_0") + F.col("endpoint_high_0")) / 2, (F.col("endpoint_low") + F.col("endpoint_high")) / 2)
    good = (F.col("multiplier") > 0) & (end_gain >= ENDPOINT_GAIN) & (mean_gain >= MEAN_GAIN) & (F.col("annotation") <= F.col("annotation_0") * LABEL_LIMIT) & (gain(F.col("before"), F.col("v2")) >= TOTAL_GAIN)
    pick = F.struct(F.when(good, F.lit(0)).otherwise(F.lit(1)), F.when(good, F.col("v2")).otherwise(F.col("multiplier")))
    one = both.groupBy(*pair).agg(F.min_by(F.struct("multiplier", "v2", "before", "endpoint_max", "endpoint_max_0"), pick).alias("b"))
    return one.join(offset, pair).select(
        *pair, (F.col("b.multiplier") > 0).alias("accepted"), "b.multiplier", F.col("b.before").alias("score_before"), F.col("b.v2").alias("score_after"),
        F.col("b.endpoint_max_0").alias("endpoint_before"), F.col("b.endpoint_max").alias("endpoint_after"), (F.col("b.multiplier") * F.col("ox")).alias("dx"), (F.col("b.multiplier") * F.col("oy")).alias("dy"),
    )


def cumulative_shifts(repairs: DataFrame) -> DataFrame:
    """(dataset_id, place, dx, dy): what each slice moves by if every accepted boundary shifts the block before it."""
    spread = repairs.where("accepted").select("dataset_id", F.explode(F.sequence(F.lit(0), F.col("boundary"))).alias("place"), "dx", "dy")
    return spread.groupBy("dataset_id", "place").agg(F.sum("dx").alias("dx"), F.sum("dy").alias("dy"))


def registration_report(points: DataFrame) -> DataFrame:
    """(dataset_id, boundary, label, n_m, n_f, nearest_mean, nearest_p95, centre_gap, agreement): both directions' nearest distances of a pair, by label and (NULL label) as a whole.

    agreement is the share of points whose nearest point of the other slice has their label.
    """
    pair = ["dataset_id", "boundary"]
    rows = held(adjacent_pairs(points))
    names = rows.select(*pair, F.col("cell_id").alias("other"), F.col("label").alias("found"))
    m, f = (rows.where(F.col("side") == s) for s in "mf")
    near = []
    for a, b in ((m, f), (f, m)):
        d = nearest_between(a.drop("label", "side"), b.drop("label", "side"), 1, pair).select(*pair, "cell_id", "other", F.sqrt("d2").alias("d"))
        near.append(d.join(names, [*pair, "other"]).join(a.select(*pair, "cell_id", "label", "side", "x", "y"), [*pair, "cell_id"]))
    both = near[0].unionByName(near[1])
    mean = lambda c, s: F.avg(F.when(F.col("side") == s, F.col(c)))
    sums = [
        F.count_if(F.col("side") == "m").alias("n_m"), F.count_if(F.col("side") == "f").alias("n_f"), F.avg("d").alias("nearest_mean"), F.percentile("d", F.lit(0.95)).alias("nearest_p95"),
        F.hypot(mean("x", "m") - mean("x", "f"), mean("y", "m") - mean("y", "f")).alias("centre_gap"), F.avg(F.col("label").eqNullSafe(F.col("found")).cast("double")).alias("agreement"),
    ]
    whole = both.groupBy(*pair).agg(*sums).withColumn("label", F.lit(None).cast("string"))
    return whole.unionByName(both.where("label is not null").groupBy(*pair, "label").agg(*sums))


def mean_objective(scores: DataFrame, by: list[str]) -> DataFrame:
    """The mean v2 of the pairs of each group: what repairs lower."""
    return scores.groupBy(*by).agg(F.avg("v2").alias("objective"), F.max("v2").alias("worst"), F.count("*").alias("pairs"))
