"""Geometry without an SQL form, a slice at a time in NumPy: hull, components, holes, depth, expression components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slabworks.functions.columns import EPS, lit
from slabworks.operators.nearness import Grid
from slabworks.session import ship, spread


#: Points of a block whose hull is taken at once, pairs of near points held at once, and queries answered at once.
HULL, PAIRS, QUERIES = 50_000, 1_000_000, 50_000


def places_of(xy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different places of points, in order, and the number of each point's place."""
    order = np.lexsort((xy[:, 1], xy[:, 0]))
    new = np.ones(len(xy), bool)
    new[1:] = (np.diff(xy[order], axis=0) != 0).any(axis=1)
    of = np.empty(len(xy), np.int64)
    of[order] = np.cumsum(new) - 1
    return xy[order[new]], of


def hull_area(xy: np.ndarray) -> float | None:
    """Area of the convex hull by the monotone chain, block by block; None for points on a line."""
    p = places_of(xy)[0]
    if len(p) < 3:
        return None

    def chain(points) -> list:
        out: list = []
        for q in points:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (q[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (q[0] - out[-2][0]):
                out.pop()
            out.append(q)
        return out

    def half(p: np.ndarray) -> list:
        return chain(q for i in range(0, len(p), HULL) for q in chain(p[i : i + HULL].tolist()))[:-1]

    ring = np.array(half(p) + half(p[::-1]))
    x, y = ring[:, 0], ring[:, 1]
    area = abs(np.dot(x, np.roll(y, -1)) - np.dot(y, np.roll(x, -1))) / 2
    return float(area) if area > 0 else None


def neighbour_blocks(xy: np.ndarray, radius: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of points at most a radius apart, by sorted grid cells, in blocks: a point's pairs with one cell stay together."""
    cell = np.floor(xy / radius).astype(np.int64)
    cell -= cell.min(axis=0)
    width = int(cell[:, 1].max()) + 3
    key = (cell[:, 0] + 1) * width + cell[:, 1] + 1
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    for shift in (0, 1, width - 1, width, width + 1):
        lo, n = np.searchsorted(ordered, key + shift, "left"), np.searchsorted(ordered, key + shift, "right")
        n -= lo
        total = np.cumsum(n)
        first = 0
        while first < len(xy):
            last = max(first + 1, int(np.searchsorted(total, (total[first - 1] if first else 0) + PAIRS, "right")))
            k, begin = n[first:last], lo[first:last]
            a = np.repeat(np.arange(first, last), k)
            b = order[np.repeat(begin - np.cumsum(k) + k, k) + np.arange(k.sum())]
            if shift == 0:
                keep = a < b
                a, b = a[keep], b[keep]
            near = ((xy[a] - xy[b]) ** 2).sum(axis=1) <= radius * radius
            yield a[near], b[near]
            first = last


def grid_neighbours(xy: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of points at most a radius apart."""
    left, right = zip(*neighbour_blocks(xy, radius))
    return np.concatenate(left), np.concatenate(right)


def components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least node of each node's component: hooking and shortcuts until nothing changes."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def clusters(xy: np.ndarray, radius: float) -> np.ndarray:
    """Least point of each point's component, points at most a radius apart being linked; pairs are held in blocks."""
    label = np.arange(len(xy))
    for a, b in neighbour_blocks(xy, radius):
        a, b = label[a], label[b]
        apart = a != b
        if apart.any():
            label = components(len(xy), a[apart], b[apart])[label]
    return label


def weighted_median(values: np.ndarray, times: np.ndarray) -> float:
    """The median of values that stand several times each."""
    if np.isnan(values).any():
        return float("nan")
    order = np.argsort(values)
    upto = np.cumsum(times[order])
    at = np.searchsorted(upto, [(upto[-1] - 1) // 2, upto[-1] // 2], "right")
    return float(values[order[at]].mean())


#: Neighbours that a point's depth is compared with.
DEPTH_K = 12


def low_depth(xy: np.ndarray, counts: np.ndarray, spacing: float, k: int = DEPTH_K, times: np.ndarray | None = None) -> tuple[float, float]:
    """Share of points of low depth, and the share that the largest cluster of them takes; (0, 0) for few points.

    Depth is log(1 + count).  A point is low if it lies far below the median of its k neighbours (against the spread
    of such differences), or below the slice's median by a factor of 2.5; low points cluster within 2.75 spacings.
    Points with equal distances come in their order.  With ``times`` a row of 0 is the head of its place: one of its
    first k + 1 points.  Others stand for as many of the points behind them, which all have the first k for neighbours.
    """
    head = np.ones(len(xy), bool) if times is None else times == 0
    times = np.ones(len(xy), np.int64) if times is None else np.where(head, 1, times)
    total = int(times.sum())
    if total < max(8, k + 2):
        return 0.0, 0.0
    depth = np.log1p(np.maximum(counts, 0))
    heads = np.flatnonzero(head)
    grid, around = Grid(xy[heads]), np.empty(len(xy))
    for i in range(0, len(heads), QUERIES):
        some = np.arange(i, min(i + QUERIES, len(heads)))
        near, _ = grid.nearest(xy[heads[some]], min(k, len(heads) - 1), own=some)
        around[heads[some]] = np.median(depth[heads[near]], axis=1)
    if len(heads) < len(xy):
        place = places_of(xy)[1]
        heads = heads[np.argsort(place[heads], kind="stable")]
        tails = np.flatnonzero(~head)
        first = np.searchsorted(place[heads], place[tails])
        for i in range(0, len(tails), QUERIES):
            around[tails[i : i + QUERIES]] = np.median(depth[heads[first[i : i + QUERIES, None] + np.arange(k)]], axis=1)
    off = depth - around
    mid = weighted_median(off, times)
    spread = 1.4826 * weighted_median(np.abs(off - mid), times)
    local = (off - mid) / spread < -2.75 if spread > EPS else off < -np.log(2.5)
    low = local | (depth < weighted_median(depth, times) - np.log(2.5))
    n = int(times[low].sum())
    if n < 2 or not spacing > 0:
        return n / total, min(n, 1) / total
    places, of = places_of(xy[low])
    largest = np.bincount(clusters(places, 2.75 * spacing), np.bincount(of, times[low])).max()
    return n / total, float(largest) / total


def grown(grid: np.ndarray) -> np.ndarray:
    out = grid.copy()
    out[1:] |= grid[:-1]
    out[:-1] |= grid[1:]
    out[:, 1:] |= grid[:, :-1]
    out[:, :-1] |= grid[:, 1:]
    return out


def label_cells(grid: np.ndarray) -> np.ndarray:
    """4-connected labels of True cells, -1 elsewhere."""
    at = np.flatnonzero(grid.ravel())
    place = np.full(grid.size, -1)
    place[at] = np.arange(len(at))
    place = place.reshape(grid.shape)
    pairs = [(place[1:], place[:-1]), (place[:, 1:], place[:, :-1])]
    a = np.concatenate([x[(x >= 0) & (y >= 0)] for x, y in pairs])
    b = np.concatenate([y[(x >= 0) & (y >= 0)] for x, y in pairs])
    out = np.full(grid.size, -1)
    out[at] = components(len(at), a, b)
    return out.reshape(grid.shape)


def hole_fraction(xy: np.ndarray, spacing: float, least_cells: int = 3, most_cells: int = 300_000) -> float:
    """Share of a slice's filled raster that enclosed holes of at least three cells take."""
    span = np.ptp(xy, axis=0)
    size = max(1.8 * spacing, span.max() / 220, 2.220446049250313e-16)
    cell = np.floor((xy - xy.min(axis=0)) / size).astype(int) + 3
    shape = cell.max(axis=0) + 4
    if shape.prod() > most_cells:
        return 0.0
    grid = np.zeros(shape, bool)
    grid[cell[:, 0], cell[:, 1]] = True
    solid = grown(grid)
    for _ in range(2):
        solid = grown(solid)
    for _ in range(2):
        solid = ~grown(~solid)
    outside = label_cells(~solid)
    border = np.unique(np.concatenate([outside[0], outside[-1], outside[:, 0], outside[:, -1]]))
    holes = (outside >= 0) & ~np.isin(outside, border)
    if not holes.any():
        return 0.0
    names, n = np.unique(outside[holes], return_counts=True)
    return float(n[n >= least_cells].sum() / (solid | holes).sum())


GEOMETRY = (
    "dataset_id string, slice_index int, n long, hull_area double, nn_median double, knn_tail_ratio double, n_components int, largest_component_fraction double, "
    "fragmentation double, hole_fraction double, local_low_depth_fraction double, regional_low_depth_cluster_fraction double"
)


def geometry_of(xy: np.ndarray, counts: np.ndarray | None = None, times: np.ndarray | None = None) -> dict:
    """The geometry of one slice's finite points; fewer than two points have none.

    Coincident points count for components but not for the spacing; points on a line have no hull.  ``times`` is that of
    low_depth, or how often each point stands if there are no counts.
    """
    each = np.ones(len(xy), np.int64) if times is None else np.maximum(times, 1)
    row = {"n": int(each.sum())}
    if row["n"] < 2:
        return row
    places, of = places_of(xy)
    many = np.bincount(of, each)
    row["hull_area"] = hull_area(places)
    alone = np.flatnonzero(many == 1)  # a point that shares its place has no positive distance
    d = Grid(places).nearest(places[alone], 1, own=alone)[1][:, 0] if len(places) > 1 else np.empty(0)
    positive = d[d > 0]
    if len(positive):
        mid = float(np.median(positive))
        size = np.bincount(clusters(places, 3.25 * mid), many)
        share = float(size.max() / row["n"])
        row |= {"nn_median": mid, "knn_tail_ratio": max(float(np.quantile(positive, 0.95)) / mid - 1, 0.0), "n_components": int((size > 0).sum()), "largest_component_fraction": share, "fragmentation": 1 - share, "hole_fraction": hole_fraction(places, mid)}
        if counts is not None:
            row["local_low_depth_fraction"], row["regional_low_depth_cluster_fraction"] = low_depth(xy, counts, mid, times=times)
    return row


def kinds_of_points(points: DataFrame) -> DataFrame:
    """(dataset_id, slice_index, x, y, times) of a slice's different places, or with total_counts (..., count, cell_id, times) of what low_depth asks for."""
    rows = points.select("dataset_id", F.col("slice_index").cast("int").alias("slice_index"), *[F.col(c).cast("double").alias(c) for c in "xy"], *[c for c in ("total_counts", "cell_id") if "total_counts" in points.columns])
    at = ["dataset_id", "slice_index", "x", "y"]
    if "total_counts" not in points.columns:
        return rows.groupBy(*at).agg(F.count("*").alias("times"))
    nth = F.row_number().over(Window.partitionBy(*at).orderBy("cell_id"))
    rows = rows.withColumn("_nth", nth).withColumn("count", F.coalesce(F.nanvl(F.col("total_counts").cast("double"), lit(0)), lit(0)))
    rows = rows.withColumn("head", F.when(F.col("_nth") <= DEPTH_K + 1, F.col("_nth")))
    kinds = rows.groupBy(*at, "count", "head").agg(F.count("*").alias("times"), F.min("cell_id").alias("cell_id"))
    return kinds.select(*at, "count", "cell_id", F.when(F.col("head").isNotNull(), 0).otherwise(F.col("times")).alias("times"))


def slice_geometry(points: DataFrame) -> DataFrame:
    """A row a slice of GEOMETRY; depth columns are NULL without total_counts, which ask for cell_id too.

    Spark counts points that share a place; a task holds a slice's different places at a time, and works on blocks of
    a fixed size of their pairs.  Of neighbours at equal distances the one with the least cell_id comes first.
    """
    kinds = kinds_of_points(points)
    counted = "count" in kinds.columns
    names = [c.split() for c in GEOMETRY.split(", ")]
    schema = pa.schema([(n, {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64()}[t]) for n, t in names])

    def one(key: tuple, table: pa.Table) -> pa.Table:
        if counted:
            table = table.sort_by([(c, "ascending") for c in ("cell_id", "x", "y")])
        column = lambda c: table[c].to_numpy()
        xy = np.column_stack([column("x"), column("y")]).astype(float)
        good = np.isfinite(xy).all(axis=1)
        row = geometry_of(xy[good], column("count")[good] if counted else None, column("times")[good])
        return pa.Table.from_pylist([{"dataset_id": key[0].as_py(), "slice_index": key[1].as_py()} | row], schema)

    ship(points.sparkSession)
    return spread(kinds, "dataset_id", "slice_index").groupBy("dataset_id", "slice_index").applyInArrow(one, GEOMETRY)


#: Genes that principal components are taken of, at most: their Gram matrix is held by a task and by the driver.
MOST_GENES = 2000


def gram(normalized: DataFrame, genes: list[str]) -> np.ndarray:
    """Sum over cells of the outer products of their gene vectors, zeros implied.

    Cells are dealt whole over tasks; a task adds up dense blocks of them and sends its sums' non-zero upper half.
    """
    place = {g: i for i, g in enumerate(genes)}
    n = len(genes)

    def run(batches):
        total, cells, rows = np.zeros((n, n)), [], 0

        def flush() -> None:
            frame = pd.concat(cells)
            code, _ = pd.factorize(frame["cell_id"])
            dense = np.zeros((code.max() + 1, n))
            np.add.at(dense, (code, frame["gene"].map(place).to_numpy()), frame["value"].to_numpy())
            total.__iadd__(dense.T @ dense)

        for batch in batches:
            frame = batch.to_pandas()
            if rows > 200_000 and len(frame):
                last = cells[-1]["cell_id"].iloc[-1]  # rows come sorted by cell: the last cell may go on
                going = pd.concat(cells)
                open_ = going["cell_id"] == last
                cells = [going[~open_]]
                if len(cells[0]):
                    flush()
                cells, rows = [going[open_]], int(open_.sum())
            cells.append(frame)
            rows += len(frame)
        if rows:
            flush()
        i, j = np.nonzero(np.triu(total))
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], names=["i", "j", "s"])

    ship(normalized.sparkSession)
    rows = normalized.select("cell_id", "gene", F.col("value").cast("double").alias("value")).repartition("cell_id").sortWithinPartitions("cell_id")
    sums = rows.mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).toPandas()  # n * n / 2 rows at most
    out = np.zeros((n, n))
    out[sums["i"], sums["j"]] = sums["s"]
    return out + np.triu(out, 1).T


def expression_components(normalized: DataFrame, n_cells: int, k: int, most: int = MOST_GENES) -> tuple[DataFrame, np.ndarray]:
    """Centred principal scores (cell_id, scores) of a sparse long table, and the loadings.

    The table is of chosen genes already (variable ones): more than ``most`` are refused.  Eigenvectors of the Gram
    matrix are found on the driver and go back as a table of loadings.  Signs make each largest loading positive, and
    directions without variance are left out.
    """
    stats = normalized.groupBy("gene").agg(F.sum("value").alias("s")).orderBy("gene").limit(most + 1).collect()
    if len(stats) > most:
        raise ValueError(f"more than {most} genes: choose the variable ones first")
    genes, mean = [r.gene for r in stats], np.array([r.s / n_cells for r in stats])
    values, vectors = np.linalg.eigh(gram(normalized, genes) - n_cells * np.outer(mean, mean))
    order = np.argsort(values)[::-1][:k]
    keep = [i for i in order if values[i] > 1e-10 * max(values.max(), 1e-300)]
    load = vectors[:, keep]
    load = load * np.where(load[np.abs(load).argmax(axis=0), np.arange(load.shape[1])] < 0, -1.0, 1.0)
    offset = mean @ load
    table = normalized.sparkSession.createDataFrame([(g, row.tolist()) for g, row in zip(genes, load)], "gene string, load array<double>")
    parts = [F.sum(F.col("value") * F.get("load", F.lit(j))).alias(f"p{j}") for j in range(load.shape[1])]
    scores = normalized.join(F.broadcast(table), "gene").groupBy("cell_id").agg(*parts)  # ``most`` rows at most
    return scores.select("cell_id", F.array(*[F.col(f"p{j}") - float(offset[j]) for j in range(load.shape[1])]).alias("scores")), load
