"""Voxel grids of point clouds: smoothed densities as joins with a kernel, connected parts, and the level that covers enough points."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slabworks.functions.columns import lit
from slabworks.operators.morphology import components
from slabworks.session import ship

#: Voxels that a grid may have, reach of the kernel, levels tried, coverage asked for, least parts.
MOST_VOXELS, REACH = 32_000_000, 4.0
LEVELS = (0.35, 0.015, 28)
COVERAGE, LEAST_VOXELS, LEAST_SHARE = 0.97, 12, 0.005


def check_grid(points: DataFrame, size: float, sigma: float) -> None:
    """Refuses a grid that is too large, before anything is built."""
    box = points.agg(*[(F.max(a) - F.min(a)).alias(a) for a in "xyz"]).first()
    pad = math.ceil(4 * sigma) + 2
    n = math.prod(math.ceil((box[a] or 0) / size) + 1 + 2 * pad for a in "xyz")
    if n > MOST_VOXELS:
        raise ValueError(f"{n} voxels are more than {MOST_VOXELS}")


def voxels(points: DataFrame, size: float) -> DataFrame:
    """Points with their nearest grid node: adds ix, iy, iz."""
    return points.withColumns({f"i{a}": F.rint(F.col(a) / size).cast("long") for a in "xyz"})


def smoothed(points: DataFrame, size: float, sigma: float, by: list[str]) -> DataFrame:
    """(by, ix, iy, iz, density): occupied voxels under a Gaussian kernel, an axis at a time, over the group's greatest."""
    reach = int(REACH * sigma + 0.5)
    weights = [math.exp(-0.5 * (i / sigma) ** 2) for i in range(-reach, reach + 1)]
    kernel = F.array(*[F.struct(F.lit(i).alias("o"), lit(w / sum(weights)).alias("w")) for i, w in zip(range(-reach, reach + 1), weights)])
    axes = ["ix", "iy", "iz"]
    out = voxels(points, size).select(*by, *axes).distinct().withColumn("d", lit(1))
    for a in axes:
        out = out.withColumn("_k", F.explode(kernel)).withColumn(a, F.col(a) + F.col("_k.o")).withColumn("d", F.col("d") * F.col("_k.w")).groupBy(*by, *axes).agg(F.sum("d").alias("d"))
    most = out.groupBy(*by).agg(F.max("d").alias("_m"))
    return out.join(most, by).select(*by, *axes, (F.col("d") / F.col("_m")).alias("density"))


def connected(keys: np.ndarray) -> np.ndarray:
    """Least place of each voxel's part; rows of keys are voxels, neighbours share a face."""
    low = keys.min(axis=0) - 1
    wide = keys.max(axis=0) - low + 2
    code = np.ravel_multi_index((keys - low).T, wide)
    order = np.argsort(code)
    ranked = code[order]
    a, b = [], []
    for step in (wide[1] * wide[2], wide[2], 1):
        at = np.searchsorted(ranked, ranked + step)
        hit = (at < len(ranked)) & (ranked[np.minimum(at, len(ranked) - 1)] == ranked + step)
        a.append(order[hit])
        b.append(order[at[hit]])
    return components(len(keys), np.concatenate(a), np.concatenate(b))


def cover(keys: np.ndarray, density: np.ndarray, weight: np.ndarray, level: float) -> tuple[float, int, int, int]:
    """(coverage, parts, parts kept, voxels kept) at a level: parts below the least size don't count."""
    above = density >= level
    if not above.any():
        return 0.0, 0, 0, 0
    label, n = np.unique(connected(keys[above]), return_inverse=True, return_counts=True)[1:]
    keep = n >= max(LEAST_VOXELS, math.ceil(n.max() * LEAST_SHARE))
    return float(weight[above][keep[label]].sum() / max(weight.sum(), 1)), len(n), int(keep.sum()), int(n[keep].sum())


def levels(points: DataFrame, size: float, sigma: float, by: list[str], coverage: float = COVERAGE) -> DataFrame:
    """(by, level, coverage, parts, kept, voxels, met): the highest of the levels tried whose parts hold enough of the points, else the lowest.

    A group's grid is checked against its bound and held by one task.
    """
    check_grid(points, size, sigma)
    schema = ", ".join([*[f"{points.schema[c].name} {points.schema[c].dataType.simpleString()}" for c in by], "level double", "coverage double", "parts int", "kept int", "voxels int", "met boolean"])
    axes = ["ix", "iy", "iz"]
    held = voxels(points, size).groupBy(*by, *axes).agg(F.count("*").alias("n"))
    rows = smoothed(points, size, sigma, by).where(F.col("density") >= LEVELS[1]).join(held, [*by, *axes], "full_outer").select(*by, *axes, F.coalesce("density", lit(0)).alias("density"), F.coalesce("n", F.lit(0)).alias("n"))

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        keys, d, n = pdf[axes].to_numpy(np.int64), pdf["density"].to_numpy(float), pdf["n"].to_numpy(float)
        for level in np.geomspace(LEVELS[0], LEVELS[1], LEVELS[2]):
            found = cover(keys, d, n, level)
            if found[0] >= coverage and found[2] > 0:
                break
        return pd.DataFrame([dict(zip(by, key)) | {"level": float(level), "coverage": found[0], "parts": found[1], "kept": found[2], "voxels": found[3], "met": bool(found[0] >= coverage and found[2] > 0)}])

    ship(points.sparkSession)
    return rows.groupBy(*by).applyInPandas(one, schema)
