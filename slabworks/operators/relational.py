"""Joins, sets, samples and checks with stated cardinality."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slabworks.functions.columns import hash_rank
from slabworks.operators.neighbours import nearest, nearest_between  # noqa: F401  joins too
from slabworks.session import held


def outer_one_to_one(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join with side (both, left_only, right_only) and duplicated, true where a key isn't unique on a side."""
    a = left.withColumn("_l", F.count("*").over(Window.partitionBy(*keys)))
    b = right.withColumn("_r", F.count("*").over(Window.partitionBy(*keys)))
    side = F.when(F.col("_l").isNull(), "right_only").when(F.col("_r").isNull(), "left_only").otherwise("both")
    return a.join(b, keys, "full_outer").withColumn("side", side).withColumn("duplicated", (F.coalesce("_l", F.lit(1)) > 1) | (F.coalesce("_r", F.lit(1)) > 1)).drop("_l", "_r")


def cover_report(ids: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """One row: missing, extra and duplicate ids of labels against the ids that they must cover exactly."""
    missing = ids.join(labels, key, "left_anti").agg(F.count("*").alias("missing"))
    extra = labels.join(ids, key, "left_anti").agg(F.count("*").alias("extra"))
    twice = labels.groupBy(key).count().where("count > 1").agg(F.count("*").alias("duplicate"))
    out = missing.crossJoin(extra).crossJoin(twice)  # one row each
    return out.withColumn("exact", (F.col("missing") == 0) & (F.col("extra") == 0) & (F.col("duplicate") == 0))


def adjacent_edges(slices: DataFrame, series: str = "dataset_id", order: str = "slice_index") -> DataFrame:
    """(series, fixed, moving): each slice and the next one of its series."""
    following = F.lead(order).over(Window.partitionBy(series).orderBy(order))
    return slices.select(series, F.col(order).alias("fixed"), following.alias("moving")).where("moving is not null")


def common_keys(rows: DataFrame, key: str, group: str) -> DataFrame:
    """Keys that every group has."""
    groups = rows.select(group).distinct().agg(F.count("*").alias("n"))
    return rows.select(key, group).distinct().groupBy(key).agg(F.count("*").alias("have")).join(F.broadcast(groups), F.col("have") == F.col("n")).select(key)


def radius_pairs(points: DataFrame, radius: float, within: list[str]) -> DataFrame:
    """(within, a, b, d2) of points at most a radius apart, each pair once, by a grid of that cell size.

    Each point meets the points of nine grid cells only, in an equi-join that can be shuffled and split.
    """
    grid = points.select(*within, F.col("cell_id"), "x", "y", F.floor(F.col("x") / radius).alias("gx"), F.floor(F.col("y") / radius).alias("gy"))
    around = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    a = grid.select(*within, F.col("cell_id").alias("a"), F.col("x").alias("ax"), F.col("y").alias("ay"), "gx", "gy", F.explode(around).alias("o"))
    a = a.withColumn("gx", F.col("gx") + F.col("o.i")).withColumn("gy", F.col("gy") + F.col("o.j")).drop("o")
    b = grid.select(*within, F.col("cell_id").alias("b"), F.col("x").alias("bx"), F.col("y").alias("by_"), "gx", "gy")
    d2 = (F.col("ax") - F.col("bx")) ** 2 + (F.col("ay") - F.col("by_")) ** 2
    return a.join(b, [*within, "gx", "gy"]).withColumn("d2", d2).where((F.col("a") < F.col("b")) & (F.col("d2") <= radius * radius)).select(*within, "a", "b", "d2")


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """Adds ``name``, each row's place from 0 in a total order, without bringing all rows to one task.

    Rows are dealt into ranges, numbered within them, and shifted by the sizes of the ranges before.
    """
    ranged = held(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_size"))
    before = F.coalesce(F.sum("_size").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = sizes.select("_range", before.alias("_first"))  # a row a range
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return ranged.withColumn("_within", within).join(F.broadcast(first), "_range").withColumn(name, F.col("_first") + F.col("_within")).drop("_range", "_within", "_first")


def even_sample(rows: DataFrame, order: list[str], k: int) -> DataFrame:
    """k rows at even places of an order (first and last included), or all rows if there are no more."""
    placed = numbered(rows, order, "_i")
    n = rows.count()
    if n <= k:
        return placed.drop("_i")
    wanted = sorted({i * (n - 1) // (k - 1) for i in range(k)}) if k > 1 else [0]
    places = rows.sparkSession.createDataFrame([(i,) for i in wanted], "_i long")
    return placed.join(F.broadcast(places), "_i", "left_semi").drop("_i")  # k rows


def grid_balanced(rows: DataFrame, group: list[str], target: int, seed: int, key: str = "cell_id") -> DataFrame:
    """At most ``target`` rows a group, taken in turns from the bins of a square grid over the group's extent."""
    bins = max(int(target**0.5), 1)
    w = Window.partitionBy(*group)
    spread = rows.withColumns({"_x0": F.min("x").over(w), "_x1": F.max("x").over(w), "_y0": F.min("y").over(w), "_y1": F.max("y").over(w)})

    def place(c: str, lo: str, hi: str) -> Column:
        return F.when(F.col(hi) > F.col(lo), F.least(F.floor((F.col(c) - F.col(lo)) / (F.col(hi) - F.col(lo)) * bins), F.lit(bins - 1))).otherwise(F.lit(0)).cast("int")

    spread = spread.withColumn("gx", place("x", "_x0", "_x1")).withColumn("gy", place("y", "_y0", "_y1")).withColumn("_h", hash_rank(seed, F.col(key)))
    turn = F.row_number().over(Window.partitionBy(*group, "gx", "gy").orderBy("_h", key))
    spread = spread.withColumn("turn", turn)
    place_ = F.row_number().over(Window.partitionBy(*group).orderBy("turn", "gx", "gy"))
    return spread.withColumn("_p", place_).where(F.col("_p") <= target).drop("_x0", "_x1", "_y0", "_y1", "_h", "_p")


def rule_table(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, failed, ok): rows that break each rule, all rules in one pass."""
    one = rows.agg(*[F.count_if(~F.coalesce(c, F.lit(False))).alias(name) for name, c in rules.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("failed")) for n in rules])
    return one.select(F.explode(pairs).alias("r")).select("r.rule", "r.failed", (F.col("r.failed") == 0).alias("ok"))


def stacked(frames: list[DataFrame]) -> DataFrame:
    """Rows of several frames over the union of their columns, in order of first appearance."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
