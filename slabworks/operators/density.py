"""Kernel densities of slices and where a slice is thinner than its neighbours; a slice and its neighbours to a task."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slabworks.functions.columns import EPS
from slabworks.operators.morphology import label_cells
from slabworks.session import ship, spread

# Grid of the comparison, margin, what counts as dense and as thin.
GRID, MARGIN, DENSE, THIN, LEAST_CELLS = (42, 32), 0.035, 0.58, 0.48, 3


#: Bandwidths beyond which a point adds nothing (less than 2e-14 of its peak), tile of a task in such reaches, and distances held at once.
CUT, TILE, BLOCK = 8.0, 4, 2_000_000


def kernel_density(points: np.ndarray, at: np.ndarray, bandwidth: float) -> np.ndarray:
    """Gaussian density of points at places, each place from the points of the grid cells around it that the kernel reaches."""
    h = max(bandwidth, EPS**0.5)
    out = np.zeros(len(at))
    if not len(points) or not len(at):
        return out
    low = np.minimum(points.min(axis=0), at.min(axis=0))
    cell, place = (np.floor((x - low) / (CUT * h)).astype(np.int64) + 1 for x in (points, at))
    wide = max(cell[:, 1].max(), place[:, 1].max()) + 2
    order = np.argsort(cell[:, 0] * wide + cell[:, 1], kind="stable")
    code, sorted_points = (cell[:, 0] * wide + cell[:, 1])[order], points[order]
    names, of = np.unique(place[:, 0] * wide + place[:, 1], return_inverse=True)
    by = np.argsort(of, kind="stable")
    ends = np.searchsorted(of[by], np.arange(len(names) + 1))
    for i, name in enumerate(names):
        # the three cells of a row are neighbours in the order of codes
        parts = [sorted_points[np.searchsorted(code, name + r * wide - 1) : np.searchsorted(code, name + r * wide + 1, side="right")] for r in (-1, 0, 1)]
        near, mine = np.concatenate(parts), by[ends[i] : ends[i + 1]]
        step = max(1, BLOCK // max(len(near), 1))
        for k in range(0, len(mine), step):
            d = ((at[mine[k : k + step], None] - near[None]) ** 2).sum(axis=2)
            out[mine[k : k + step]] = np.exp(-0.5 * d / (h * h)).sum(axis=1)
    return out / (2 * np.pi * h * h)


def point_densities(points: DataFrame, bandwidth: float) -> DataFrame:
    """(dataset_id, slice_index, cell_id, density) of each point within its slice, itself included.

    A slice is cut into tiles of a few reaches of the kernel; a point goes to its own tile and to those that it reaches,
    so that large slices are many tasks.
    """
    schema = "dataset_id string, slice_index int, cell_id long, density double"
    reach = CUT * max(bandwidth, EPS**0.5)

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        xy, own = pdf[["x", "y"]].to_numpy(float), pdf["own"].to_numpy(bool)
        return pd.DataFrame({"dataset_id": key[0], "slice_index": key[1], "cell_id": pdf["cell_id"].to_numpy()[own], "density": kernel_density(xy, xy[own], bandwidth)})

    ship(points.sparkSession)
    p = points.select("dataset_id", F.col("slice_index").cast("int").alias("slice_index"), F.col("cell_id").cast("long").alias("cell_id"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    p = p.where("x is not null and y is not null and not isnan(x) and not isnan(y)")
    own = lambda c, by: F.floor((F.col(c) + by) / (reach * TILE))
    for c in "xy":
        p = p.withColumn(f"_{c}", F.explode(F.array_distinct(F.array(own(c, -reach), own(c, 0.0), own(c, reach)))))
    p = p.withColumn("own", (F.col("_x") == own("x", 0.0)) & (F.col("_y") == own("y", 0.0)))
    keys = ["dataset_id", "slice_index", "_x", "_y"]
    return spread(p, *keys).groupBy(*keys).applyInPandas(one, schema)


def largest_deficit(focal: np.ndarray, others: list[np.ndarray], bandwidth: float) -> dict | None:
    """The largest connected part of the dense area that neighbours let expect where the slice has less than THIN of it; None without one."""
    others = [o for o in others if len(o)]
    if len(focal) < 3 or len(others) < 2:
        return None
    pooled = np.vstack([focal, *others])
    low, high = pooled.min(axis=0), pooled.max(axis=0)
    span = np.maximum(high - low, bandwidth) * MARGIN
    gx, gy = (np.linspace(low[i] - span[i], high[i] + span[i], GRID[i]) for i in (0, 1))
    at = np.column_stack([np.repeat(gx, len(gy)), np.tile(gy, len(gx))])
    own = kernel_density(focal, at, bandwidth)
    expected = np.mean([kernel_density(o, at, bandwidth) for o in others], axis=0)
    if not (expected > 0).any():
        return None
    dense = expected >= np.quantile(expected[expected > 0], DENSE)
    ratio = own / np.maximum(expected, EPS)
    label = label_cells((dense & (ratio <= THIN)).reshape(GRID))
    names, n = np.unique(label[label >= 0], return_counts=True)
    if not len(n) or n.max() < LEAST_CELLS:
        return None
    region = label == names[n.argmax()]
    ix, iy = np.nonzero(region)
    return {"x0": gx[ix.min()], "x1": gx[ix.max()], "y0": gy[iy.min()], "y1": gy[iy.max()], "deficit": n.max() / max(dense.sum(), 1), "ratio": float(np.median(ratio.reshape(GRID)[region]))}


def density_deficits(points: DataFrame, bandwidth: float, half: int = 2) -> DataFrame:
    """(dataset_id, slice_index, x0, x1, y0, y1, deficit, ratio) of the slices that have such a region; a task holds a slice and ``half`` neighbours on each side."""
    schema = "dataset_id string, slice_index int, x0 double, x1 double, y0 double, y1 double, deficit double, ratio double"

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        sides = {k: g[["x", "y"]].to_numpy(float) for k, g in pdf.dropna(subset=["x", "y"]).groupby("place")}
        focal = int(key[1])
        found = largest_deficit(sides.pop(focal, np.zeros((0, 2))), [sides[k] for k in sorted(sides)], bandwidth)
        name = pdf.loc[pdf["place"] == focal, "slice_index"]
        rows = [] if found is None else [{"dataset_id": key[0], "slice_index": int(name.iloc[0])} | found]
        return pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")]).astype({"slice_index": "int32"})

    ship(points.sparkSession)
    s = points.select("dataset_id", F.col("slice_index").cast("int").alias("slice_index")).distinct()
    s = s.withColumn("place", F.row_number().over(Window.partitionBy("dataset_id").orderBy("slice_index")))
    p = points.select("dataset_id", F.col("slice_index").cast("int").alias("slice_index"), "x", "y").join(s, ["dataset_id", "slice_index"])
    p = p.withColumn("focal", F.explode(F.sequence(F.col("place") - half, F.col("place") + half))).join(s.select("dataset_id", F.col("place").alias("focal")), ["dataset_id", "focal"], "left_semi")
    return spread(p, "dataset_id", "focal").groupBy("dataset_id", "focal").applyInPandas(one, schema)
