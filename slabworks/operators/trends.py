"""How counts follow a continuous feature: a natural cubic spline in a log-linear model for each gene, against a constant.

Counts are negative binomial with dispersion 1 (variance m + m^2), the mean's logarithm is a natural cubic spline with
knots at the feature's least, middle and greatest distinct value, and both are fitted to all cells, those without a
count of the gene included.  All genes are fitted at once: a round is one job in which every block of cells brings each gene's
3 x 3 normal equations, which are added up by gene; between rounds only those sums and the coefficients are on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slabworks.functions.columns import lit
from slabworks.operators.statistics import benjamini_hochberg
from slabworks.session import held, ship

#: Cells of a block, genes whose sums may be on the driver, and strips that the genes are dealt to; a task holds 256 genes of a block at once.
CELLS, MOST_GENES, STRIP = 4_096, 500_000, 64
#: Fixed values of the fit: rounds, change of the log-likelihood that ends it, least distinct values of the feature.
ROUNDS, CHANGE, LEAST_VALUES = 60, 1e-10, 4


def basis(x: np.ndarray, low: float, middle: float, high: float) -> np.ndarray:
    """(n, 3): constant, place between the outer knots, and the natural spline's bend."""
    t, k = (x - low) / (high - low), (middle - low) / (high - low)
    return np.column_stack([np.ones(len(x)), t, np.maximum(t, 0) ** 3 - np.maximum(t - k, 0) ** 3 / (1 - k) + k / (1 - k) * np.maximum(t - 1, 0) ** 3])


def log_likelihood(y: np.ndarray, eta: np.ndarray) -> np.ndarray:
    """Of counts under means exp(eta), without the terms that depend on the counts alone (there are none at dispersion 1)."""
    return y * eta - (y + 1) * np.logaddexp(0, eta)


def _blocks(cells: DataFrame, counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Blocks of cells (block, xs), and each block's counts by strip of genes (block, strip, genes, sizes, places, ys): places are those of the cells in xs."""
    parts = max(1, -(-cells.count() // CELLS))
    dealt = cells.withColumn("block", F.pmod(F.xxhash64("cell_id"), F.lit(parts)).cast("int"))
    dealt = held(dealt.withColumn("place", F.row_number().over(Window.partitionBy("block").orderBy("cell_id")) - 1), "trend-cells")
    xs = dealt.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("place", "x"))).alias("c")).select("block", F.col("c.x").alias("xs"))
    y = counts.join(dealt, "cell_id").groupBy("block", "gene").agg(F.collect_list(F.struct("place", "y")).alias("p"))
    y = y.groupBy("block", _strip().alias("strip")).agg(F.collect_list("gene").alias("genes"), F.collect_list(F.size("p")).alias("sizes"), F.flatten(F.collect_list("p.place")).alias("places"), F.flatten(F.collect_list("p.y")).alias("ys"))
    return held(xs, "trend-xs"), y


def _strip():
    return F.pmod(F.xxhash64("gene", F.lit(1)), F.lit(STRIP)).cast("int")


def _whole(xs: DataFrame, y: DataFrame, genes: DataFrame) -> DataFrame:
    """Every block with every strip: a gene without counts in a block stands there too, for its sums run over all cells."""
    strips = genes.groupBy(_strip().alias("strip")).agg(F.sort_array(F.collect_list("gene")).alias("all"))
    out = xs.withColumn("strip", F.explode(F.sequence(F.lit(0), F.lit(STRIP - 1)))).join(strips, "strip").join(y, ["block", "strip"], "left")
    or_none = lambda c, kind: F.coalesce(c, F.array().cast(f"array<{kind}>"))
    missing = F.array_except("all", or_none("genes", "string"))
    sizes = F.concat(or_none("sizes", "int"), F.array_repeat(F.lit(0), F.size(missing)))
    return held(out.select("xs", F.concat(or_none("genes", "string"), missing).alias("genes"), sizes.alias("sizes"), or_none("places", "int").alias("places"), or_none("ys", "double").alias("ys")), "trend-blocks")


_SUMS = "gene string, " + ", ".join(f"s{i} double" for i in range(10))


def _round(blocks: DataFrame, knots: tuple, state: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Each gene's log-likelihood, gradient (3) and information (6) at its coefficients, over all cells."""
    spark = blocks.sparkSession
    b = spark.sparkContext.broadcast(state)  # three numbers a gene, at most MOST_GENES of them

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for xs, genes, sizes, places, ys in zip(pdf["xs"], pdf["genes"], pdf["sizes"], pdf["places"], pdf["ys"]):
                design = basis(np.asarray(xs, float), *knots)
                outer = np.stack([design[:, i] * design[:, j] for i in range(3) for j in range(i, 3)], axis=1)
                at = np.concatenate([[0], np.cumsum(np.asarray(sizes, int))])
                open_ = [(i, g) for i, g in enumerate(genes) if g in b.value]
                for k in range(0, len(open_), 256):
                    some = open_[k : k + 256]
                    y = np.zeros((len(design), len(some)))
                    for j, (i, _) in enumerate(some):
                        y[np.asarray(places[at[i] : at[i + 1]], int), j] = ys[at[i] : at[i + 1]]
                    yield _sums([g for _, g in some], y, design, outer, np.stack([b.value[g] for _, g in some], axis=1))

    return {r.gene: np.array(r[1:]) for r in blocks.mapInPandas(run, _SUMS).groupBy("gene").agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(10)]).collect()}


def _sums(genes: list[str], y: np.ndarray, design: np.ndarray, outer: np.ndarray, beta: np.ndarray) -> pd.DataFrame:
    eta = np.clip(design @ beta, -60, 60)
    mean = np.exp(eta)
    score = (y - mean) / (1 + mean)
    columns = np.column_stack([log_likelihood(y, eta).sum(0), (design.T @ score).T, (outer.T @ (mean / (1 + mean))).T])
    return pd.DataFrame({"gene": genes} | {f"s{i}": columns[:, i] for i in range(10)})


def spline_trends(cells: DataFrame, counts: DataFrame, feature: str, least_cells: int = 1, rounds: int = ROUNDS) -> DataFrame:
    """A row a gene: gene, status (ok or fail), cells, mean, b0, b1, b2, llf_full, llf_null, ratio, p and q.

    cells(cell_id, <feature>) gives every cell once, counts(cell_id, gene, value) the values above 0; cells without a feature,
    and counts of cells that aren't there, are left out, and repeated counts add up.  ratio is twice the difference of the log-likelihoods and
    p its chance under a constant mean (two degrees of freedom); q is the false discovery rate among all genes
    with counts in ``least_cells`` cells or more.  A fit that doesn't settle fails and has p and q 1.  A feature
    with fewer than four distinct values is an error.
    """
    known = cells.select("cell_id", F.col(feature).cast("double").alias("x")).where("x is not null and not isnan(x)")
    k = known.select("x").distinct().agg(F.min("x").alias("low"), F.percentile("x", lit(0.5)).alias("middle"), F.max("x").alias("high"), F.count("*").alias("n")).first()
    if k.n < LEAST_VALUES:
        raise ValueError(f"{feature} needs {LEAST_VALUES} distinct values")
    spark, knots = cells.sparkSession, (k.low, k.middle, k.high)
    ship(spark)
    y = counts.where("value > 0").join(known.select("cell_id"), "cell_id", "left_semi").groupBy("cell_id", "gene").agg(F.sum(F.col("value").cast("double")).alias("y"))
    y = held(y, "trend-counts")
    per = held(y.groupBy("gene").agg(F.count("*").alias("cells"), F.sum("y").alias("y")).where(F.col("cells") >= least_cells), "trend-genes")
    found = {r.gene: r for r in per.limit(MOST_GENES + 1).collect()}
    if len(found) > MOST_GENES:
        raise ValueError(f"more than {MOST_GENES} genes")
    n, names = known.count(), sorted(found)
    whole = _whole(*_blocks(known, y.join(per.select("gene"), "gene", "left_semi")), per.select("gene"))
    means = {g: found[g].y / n for g in names}
    null = {g: n * float(log_likelihood(np.array(means[g]), np.log(means[g]))) for g in names}
    beta = {g: np.array([np.log(means[g]), 0.0, 0.0]) for g in names}
    step = {g: np.zeros(3) for g in names}
    best = {g: -np.inf for g in names}
    settled: dict[str, bool] = {}
    open_ = set(names)
    for _ in range(rounds):
        if not open_:
            break
        sums = _round(whole, knots, {g: beta[g] for g in open_})
        for g, s in sums.items():
            if not np.isfinite(s).all() or s[0] < best[g] - 1e-9 * abs(best[g]):  # too far: half of the last step back
                step[g] = step[g] / 2
                beta[g] = beta[g] - step[g]
                continue
            if abs(s[0] - best[g]) <= CHANGE * (abs(s[0]) + 1e-3):
                settled[g], best[g] = True, s[0]
                open_.discard(g)
                continue
            best[g] = s[0]
            info = np.empty((3, 3))
            info[np.triu_indices(3)] = s[4:]
            info[np.tril_indices(3, -1)] = info.T[np.tril_indices(3, -1)]
            step[g] = np.linalg.lstsq(info + 1e-12 * np.trace(info) * np.eye(3), s[1:4], rcond=None)[0]
            beta[g] = beta[g] + step[g]
    rows = []
    for g in names:
        ratio = max(0.0, 2 * float(best[g] - null[g]))
        ok = settled.get(g, False)
        rows.append((g, "ok" if ok else "fail", found[g].cells, float(means[g]), *map(float, beta[g]), float(best[g]), float(null[g]), ratio if ok else None, float(np.exp(-ratio / 2)) if ok else 1.0))
    out = spark.createDataFrame(rows, "gene string, status string, cells long, mean double, b0 double, b1 double, b2 double, llf_full double, llf_null double, ratio double, p double")
    return benjamini_hochberg(out, [])


def fitted_curves(trends: DataFrame, knots: tuple[float, float, float], points: int = 50) -> DataFrame:
    """(gene, x, mean): each fitted gene's mean at evenly spaced values of the feature."""
    low, middle, high = map(float, knots)
    k = (middle - low) / (high - low)
    t = F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("_i")
    rows = trends.where("status = 'ok'").select("gene", "b0", "b1", "b2", t).withColumn("_t", F.col("_i") / max(points - 1, 1))
    bend = F.pow("_t", lit(3)) - F.pow(F.greatest(F.col("_t") - k, lit(0)), lit(3)) / (1 - k)
    return rows.select("gene", (F.col("_t") * (high - low) + low).alias("x"), F.exp(F.col("b0") + F.col("b1") * F.col("_t") + F.col("b2") * bend).alias("mean"))
