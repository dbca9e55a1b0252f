"""Samples that depend on ids and seeds alone: stratified, proportional, label-guaranteed, strided.

Each is a feature that asks for fewer rows; ranks come from hashes, so a sample is the same on every cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slabworks.functions.columns import hash_rank, lit


def _ranked(rows: DataFrame, by: list[str], seed: int, key: str) -> DataFrame:
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(hash_rank(seed, F.col(key)), key)))


def _targets(rows: DataFrame, group: str, target) -> DataFrame:
    """Rows of each group with its target, from (group, n) and what ``target`` makes of it."""
    return rows.join(target(rows.groupBy(group).agg(F.count("*").alias("_n"))).select(group, "_target"), group)


def root_stratified(rows: DataFrame, group: str, most: int, seed: int, key: str = "cell_id") -> DataFrame:
    """At most about ``most`` rows, shared among groups by the square roots of their sizes, one a group at least.

    What cutting off fractions leaves goes to the largest groups, one each; what the least of one adds is taken from
    the largest targets.  A table that is small enough stays whole.  There is a row a group in every window.
    """

    def target(n: DataFrame) -> DataFrame:
        every = Window.partitionBy()
        root = F.sqrt(F.col("_n").cast("double"))
        n = n.withColumn("_t", F.greatest(F.lit(1), F.floor(lit(most) * root / F.sum(root).over(every)).cast("long"))).withColumn("_all", F.sum("_n").over(every)).withColumn("_left", F.lit(most) - F.sum("_t").over(every))
        n = n.withColumn("_up", (F.row_number().over(every.orderBy(F.desc("_n"), group)) <= F.col("_left")).cast("long"))
        taken = F.coalesce(F.sum(F.col("_t") - 1).over(every.orderBy(F.desc("_t"), group).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        down = F.greatest(F.lit(0), F.least(F.col("_t") - 1, -F.col("_left") - taken))
        return n.withColumn("_target", F.when(F.col("_all") <= most, F.col("_n")).otherwise(F.col("_t") + F.col("_up") - down))

    return _ranked(_targets(rows, group, target), [group], seed, key).where("_r <= _target").drop("_r", "_target")


def proportional(rows: DataFrame, group: str, most: int, seed: int, key: str = "cell_id") -> DataFrame:
    """About ``most`` rows, each group's share of them (rounded half to even, one at least); a small table stays whole."""

    def target(n: DataFrame) -> DataFrame:
        total = F.sum("_n").over(Window.partitionBy())
        return n.withColumn("_target", F.when(total <= most, F.col("_n")).otherwise(F.greatest(F.lit(1), F.bround(lit(most) * F.col("_n") / total).cast("long"))))

    return _ranked(_targets(rows, group, target), [group], seed, key).where("_r <= _target").drop("_r", "_target")


def label_guaranteed(rows: DataFrame, by: list[str], label: str, most: int, seed: int, key: str = "cell_id") -> DataFrame:
    """At most ``most`` rows of each group: some of every label first (4 to 18, a third of an even share), then the first by hash."""
    kinds = rows.groupBy(*by).agg(F.count_distinct(F.coalesce(label, F.lit(""))).alias("_k"), F.count("*").alias("_n"))
    least = F.greatest(F.lit(4), F.least(F.lit(18), F.floor(F.lit(most) / (3 * F.col("_k")))))
    h = hash_rank(seed, F.col(key))
    own = F.row_number().over(Window.partitionBy(*by, label).orderBy(h, key))
    ranked = rows.join(kinds, by).withColumn("_first", own <= least)
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("_first"), h, key))
    guaranteed = F.sum(F.col("_first").cast("int")).over(Window.partitionBy(*by))
    ranked = ranked.withColumn("_place", place).withColumn("_g", guaranteed)
    return ranked.where((F.col("_n") <= most) | (F.col("_place") <= F.greatest(F.lit(most), F.col("_g")))).drop("_k", "_n", "_first", "_place", "_g")


def strided(rows: DataFrame, by: list[str], highlight: str, most: int, most_highlighted: int, order: str = "cell_id") -> DataFrame:
    """At most ``most`` rows of each group in even strides: highlighted rows first (at most so many), others in the room that is left."""
    h = F.coalesce(F.col(highlight), F.lit(False))
    n = F.count("*").over(Window.partitionBy(*by))
    nh = F.count_if(h).over(Window.partitionBy(*by))
    place = F.row_number().over(Window.partitionBy(*by, "_h").orderBy(order)) - 1
    out = rows.withColumn("_h", h).withColumn("_n", n).withColumn("_nh", nh).withColumn("_p", place)
    kept_h = F.least(F.col("_nh"), F.lit(most_highlighted))
    room = F.when(F.col("_h"), F.lit(most_highlighted)).otherwise(F.greatest(F.lit(0), F.lit(most) - kept_h))
    size = F.when(F.col("_h"), F.col("_nh")).otherwise(F.col("_n") - F.col("_nh"))
    step = F.when(size > room, F.greatest(F.lit(1), F.floor(size / F.greatest(room, F.lit(1))))).otherwise(F.lit(1))
    good = (F.col("_p") % step == 0) & (F.col("_p") / step < room)
    return out.where((F.col("_n") <= most) | good).drop("_h", "_n", "_nh", "_p")


def display_sample(points: DataFrame, most: int, seed: int) -> DataFrame:
    """(dataset_id, slice_index, cell_id, x, y, depth): at most ``most`` points a slice, depth being log(1 + count) scaled from its 2 % to its 98 % quantile."""
    by = ["dataset_id", "slice_index"]
    depth = F.log1p(F.greatest(F.col("total_counts").cast("double"), lit(0)))
    q = F.percentile(depth, F.array(lit(0.02), lit(0.98)))
    limits = points.groupBy(*by).agg(q.alias("q"))
    low, high = F.get("q", F.lit(0)), F.get("q", F.lit(1))
    out = _ranked(points, by, seed, "cell_id").where(F.col("_r") <= most).join(limits, by)
    return out.select(*by, "cell_id", "x", "y", F.when(high > low, F.least(F.greatest((depth - low) / (high - low), lit(0)), lit(1))).otherwise(lit(0.5)).alias("depth"))


def profile_genes(profile: DataFrame, most: int = 3000) -> DataFrame:
    """Genes of profile(slice_index, gene, value) that all slices share, the most variable ones by log-normalised pseudobulk: gene, variance."""
    slices = profile.select("slice_index").distinct().agg(F.count("*").alias("k"))
    totals = profile.groupBy("slice_index").agg(F.sum("value").alias("t"))
    v = profile.join(totals, "slice_index").withColumn("v", F.log1p(F.col("value") * 10000.0 / F.col("t")))
    stats = v.groupBy("gene").agg(F.count("*").alias("have"), F.var_pop("v").alias("variance")).join(F.broadcast(slices), F.col("have") == F.col("k"))  # one row
    return stats.select("gene", F.round("variance", 9).alias("variance")).orderBy(F.desc("variance"), "gene").limit(most)
