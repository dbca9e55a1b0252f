"""Made-up slice defects: thinned counts, thinned regions, lost locations, holes.  Hashes of ids decide, so results repeat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slabworks.functions.columns import EPS, hash_rank, lit

KINDS = ("depth", "regional_depth", "cell_dropout", "spatial_hole")


def uniform(seed: int, *keys: Column) -> Column:
    """A number from 0 up to 1 that depends on a seed and ids alone: 32 bits of SHA-1."""
    text = F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys])
    return F.conv(F.substring(F.sha1(text.cast("binary")), 1, 8), 16, 10).cast("double") / lit(2.0**32)


def thinned(value: Column, rate: Column, seed: int, *keys: Column) -> Column:
    """Each of ``value`` counts is kept with a chance of ``rate``: a binomial draw."""
    n = F.greatest(F.rint(value), F.lit(0)).cast("int")
    return F.when(n > 0, F.size(F.filter(F.sequence(F.lit(1), n), lambda i: uniform(seed, *keys, i) < rate))).otherwise(F.lit(0)).cast("long")


def central_region(cells: DataFrame, quantile: Column) -> DataFrame:
    """Adds region: points within a quantile (0.05 to 0.9) of the elliptical radius about their slice's median centre."""
    w = Window.partitionBy("dataset_id", "slice_index")
    out = cells
    for a in "xy":
        out = out.withColumn(f"_{a}", F.col(a) - F.percentile(a, lit(0.5)).over(w))
        out = out.withColumn(f"_{a}", F.col(f"_{a}") / F.greatest(F.percentile(F.abs(f"_{a}"), lit(0.75)).over(w), lit(EPS)))
    out = out.withColumn("_radius", F.hypot("_x", "_y"))
    # a window's share is a constant: the quantile of each slice is looked up on a fine grid of shares
    steps = [i / 100 for i in range(5, 91)]
    grid = F.percentile("_radius", F.array(*map(lit, steps))).over(w)
    at = (F.rint(F.least(F.greatest(quantile, lit(0.05)), lit(0.9)) * 100) - 5).cast("int")
    return out.withColumn("_grid", grid).withColumn("region", F.col("_radius") <= F.get("_grid", at)).drop("_x", "_y", "_radius", "_grid")


def simulated(cells: DataFrame, expression: DataFrame, plan: DataFrame, seed: int = 13) -> tuple[DataFrame, DataFrame]:
    """(cells, expression) with the plan's defects; sources stay as they are.

    plan(dataset_id, slice_index, kind, rate, quantile): at most one defect a slice.  depth thins all counts of the
    slice by rate, regional_depth those of its central region; cell_dropout keeps a share ``rate`` of its locations
    (one at least), spatial_hole removes those of the central region.  Quantiles are taken in hundredths.  A kind that
    isn't known is an error; counts thinned to nothing leave the table.
    """
    keys = ["dataset_id", "slice_index"]
    known = plan.withColumn("kind", F.when(F.col("kind").isin(*KINDS), F.col("kind")).otherwise(F.raise_error(F.concat(F.lit("unknown defect: "), F.coalesce("kind", F.lit("NULL"))))))
    marked = central_region(cells.join(known, keys, "left"), F.coalesce("quantile", lit(0.35)))
    w = Window.partitionBy(*keys)
    place = F.row_number().over(w.orderBy(hash_rank(seed, F.col("cell_id")), "cell_id"))
    marked = marked.withColumn("_place", place).withColumn("_n", F.count("*").over(w))
    lost = F.coalesce((F.col("kind") == "spatial_hole") & F.col("region"), F.lit(False)) | F.coalesce((F.col("kind") == "cell_dropout") & (F.col("_place") > F.greatest(F.lit(1), F.bround(F.col("_n") * F.col("rate")))), F.lit(False))
    kept = marked.where(~lost)
    rate = F.when(F.col("kind") == "depth", F.col("rate")).when((F.col("kind") == "regional_depth") & F.col("region"), F.col("rate"))
    rates = kept.select("cell_id", rate.alias("_rate"))
    counts = expression.join(rates, "cell_id").withColumn("value", F.when(F.col("_rate").isNull(), F.col("value")).otherwise(thinned(F.col("value"), F.col("_rate"), seed, F.col("cell_id"), F.col("gene"))))
    return kept.select(*cells.columns), counts.where("value <> 0").drop("_rate")


def defect_plan(slices: DataFrame, shares: tuple[float, ...] = (0.22, 0.42, 0.62, 0.80), least: int = 9) -> DataFrame:
    """A benchmark's plan: one defect of each kind at fixed shares of every series with at least ``least`` slices."""
    w = Window.partitionBy("dataset_id")
    placed = slices.select("dataset_id", "slice_index").distinct().withColumn("_p", F.row_number().over(w.orderBy("slice_index")) - 1).withColumn("_n", F.count("*").over(w))
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), lit(s).alias("share"), lit(r).alias("rate"), lit(q).alias("quantile")) for k, s, r, q in zip(KINDS, shares, (0.2, 0.1, 0.35, 1.0), (0.35,) * 4)])
    rows = placed.where(F.col("_n") >= least).withColumn("_k", F.explode(kinds)).where(F.col("_p") == F.floor(F.col("_k.share") * (F.col("_n") - 1)))
    return rows.select("dataset_id", "slice_index", "_k.kind", "_k.rate", "_k.quantile")
