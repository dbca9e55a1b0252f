"""Exact nearest neighbours between two tables of points in the plane, whatever their density, outliers or repetitions.

Targets are cut into tiles by quantiles, first of x into strips, then of y within a strip, so that every tile holds about
as many of them and no point, however far, changes the others' tiles.  A probe is first answered by the tile it lies in; the
distance of the last neighbour found there bounds the circle that can hold nearer ones, and the probe then visits the
other tiles that this circle touches.  Groups of a bounded size are one tile, whose answers are final.  Both steps send the probes to the tiles' tasks, where tiles are small and probes stream by.
Targets at one place are one entry with as many of their least ids as can be asked for.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slabworks.operators.nearness import Grid
from slabworks.session import held, ship, spread

#: Strips of a group and tiles of a strip at most, places of a tile, and probes of a tile that one task answers.
CUTS, TILE, PROBES = 64, 2_048, 16_384
#: Targets and probes of a group up to which the whole group is one tile and needs neither cuts nor a second step.
WHOLE = 16_384


def _bounds(c: str, n: str, tile: int) -> list[Column]:
    """Aggregates: how many parts a group of n is cut into, its least value and its quantiles."""
    return [F.count("*").alias(n), F.min(c).alias("_low"), F.percentile_approx(c, [i / CUTS for i in range(1, CUTS)], 4_000).alias("_cuts")]


def _chosen(parts: Column) -> Column:
    """The cuts that a number of parts (a power of two) takes, without repetitions and those at the least value."""
    step = (F.lit(CUTS) / parts).cast("int")
    own = F.filter("_cuts", lambda v, i: ((i + 1) % step == 0) & (v > F.col("_low")))
    return F.array_distinct(own)


def _parts(n: Column, tile: Column) -> Column:
    """The least power of two, at most CUTS, that leaves no more than a tile's places in a part."""
    return F.least(F.lit(CUTS), F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(n / tile, F.lit(1.0)))))).cast("int")


def _part(c: str, bounds: str) -> Column:
    return F.size(F.filter(bounds, lambda b: b <= F.col(c)))


def _answers(k: int) -> Callable:
    """Tiles in a row, each its places (kind 0) and then its probes (kind 1): a row for each probe and near place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, places, grid, ids, points = None, [], None, None, None
        for batch in batches:
            keys, kinds = batch.column("key").to_numpy(zero_copy_only=False), batch.column("kind").to_numpy()
            change = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (kinds[1:] != kinds[:-1]), [True]]))
            for a, b in zip(change, change[1:]):
                part = batch.slice(a, b - a)
                if keys[a] != key:
                    key, places, grid = keys[a], [], None
                if kinds[a] == 0:
                    places.append(part)
                    continue
                if not places:
                    continue
                if grid is None:
                    t = pa.Table.from_batches(places).combine_chunks().sort_by("first")
                    points = np.column_stack([t["x"].to_numpy(), t["y"].to_numpy()])
                    ids, grid = t["ids"].combine_chunks(), Grid(points)
                q = np.column_stack([part.column("x").to_numpy(), part.column("y").to_numpy()])
                have = min(k, len(points))
                at, _ = grid.nearest(q, have)
                flat, of = at.ravel(), np.repeat(np.arange(len(q)), have)
                d2 = (q[of, 0] - points[flat, 0]) ** 2 + (q[of, 1] - points[flat, 1]) ** 2
                last = np.repeat(d2.reshape(-1, have)[:, -1] if have == k else np.full(len(q), np.inf), have)
                near = d2 <= np.repeat(part.column("reach").to_numpy(), have)
                of, flat = of[near], flat[near]
                probe = part.take(pa.array(of))
                yield pa.RecordBatch.from_arrays([probe.column("probe"), pa.array(d2[near]), ids.take(pa.array(flat)), pa.array(last[near]), pa.array((np.tile(np.arange(have), len(q)) == 0)[near])], names=["probe", "d2", "ids", "last", "first"])

    return run


def _ranked(k: int, own: bool) -> Callable:
    """Whole groups in a row, each its targets (kind 0) and then its probes (kind 1): the ranked neighbours of each probe."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, targets, grid, ids, points = None, [], None, None, None
        for batch in batches:
            keys, kinds = batch.column("key").to_numpy(zero_copy_only=False), batch.column("kind").to_numpy()
            change = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (kinds[1:] != kinds[:-1]), [True]]))
            for a, b in zip(change, change[1:]):
                part = batch.slice(a, b - a)
                if keys[a] != key:
                    key, targets, grid = keys[a], [], None
                if kinds[a] == 0:
                    targets.append(part)
                    continue
                if not targets:
                    continue
                if grid is None:
                    t = pa.Table.from_batches(targets).combine_chunks().sort_by("other")
                    points = np.column_stack([t["x"].to_numpy(), t["y"].to_numpy()])
                    ids, grid = t["other"].combine_chunks(), Grid(points)
                q = np.column_stack([part.column("x").to_numpy(), part.column("y").to_numpy()])
                have = min(k + own, len(points))
                at, _ = grid.nearest(q, have)
                flat, of = at.ravel(), np.repeat(np.arange(len(q)), have)
                probe, other = part.column("probe").take(pa.array(of)), ids.take(pa.array(flat))
                keep = np.ones(at.shape, bool)
                if own:
                    keep = np.asarray(pc.not_equal(pc.struct_field(probe, "cell_id"), other)).reshape(at.shape)
                rank = keep.cumsum(axis=1)
                chosen = pa.array((keep & (rank <= k)).ravel())
                d2 = (q[of, 0] - points[flat, 0]) ** 2 + (q[of, 1] - points[flat, 1]) ** 2
                yield pa.RecordBatch.from_arrays([x.filter(chosen) for x in (probe, other, pa.array(rank.ravel().astype(np.int32)), pa.array(d2))], names=["probe", "other", "rank", "d2"])

    return run


def _by_group(p: DataFrame, t: DataFrame, k: int, within: list[str], own: bool) -> DataFrame:
    name = F.to_json(F.struct(*within)).alias("key")
    a = t.select(name, F.lit(0).alias("kind"), "x", "y", "other")
    b = p.select(name, F.lit(1).alias("kind"), "x", "y", F.struct(*within, "cell_id").alias("probe"))
    both = spread(a.unionByName(b, allowMissingColumns=True), "key").sortWithinPartitions("key", "kind")
    out = both.mapInArrow(_ranked(k, own), f"probe {both.schema['probe'].dataType.simpleString()}, other {both.schema['other'].dataType.simpleString()}, rank int, d2 double")
    return out.select(*[F.col(f"probe.{c}").alias(c) for c in (*within, "cell_id")], "other", "rank", "d2")


def nearest_between(probes: DataFrame, targets: DataFrame, k: int, within: list[str], own: bool = False) -> DataFrame:
    """(within, cell_id, other, rank, d2): the k nearest targets of each probe in the same group, ties by id; all, if there are fewer.

    Both tables have the group's columns, cell_id, x and y; ``own``: a point is not its own neighbour.  Points with a
    missing coordinate or group take no part, probes of a group without targets have no row.
    """
    ship(probes.sparkSession)
    most = k + 1 if own else k
    tile = F.lit(max(TILE, 4 * most))
    known = " and ".join(["x is not null and y is not null and not isnan(x) and not isnan(y)", *[f"`{c}` is not null" for c in within]])
    t = targets.select(*within, F.col("cell_id").alias("other"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).where(known)
    p = probes.select(*within, "cell_id", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).where(known)
    sizes = t.select(*within, F.lit(0).alias("_k")).union(p.select(*within, F.lit(1).alias("_k"))).groupBy(*within, "_k").agg(F.count("*").alias("_n"))
    if (sizes.agg(F.max("_n")).first()[0] or 0) <= WHOLE:
        return _by_group(p, t, k, within, own)
    at = [*within, "x", "y"]
    t = t.withColumn("_n", F.row_number().over(Window.partitionBy(*at).orderBy("other"))).where(F.col("_n") <= most)
    t = held(t.groupBy(*at).agg(F.sort_array(F.collect_list("other")).alias("ids")), "places")

    strips = t.groupBy(*within).agg(*_bounds("x", "_n", tile))
    # as many strips as tiles in a strip: their product is the number of tiles
    strips = held(strips.select(*within, _chosen(_parts(F.sqrt(F.col("_n") / tile) * tile, tile)).alias("_xs")), "strips")
    t = t.join(strips, within).withColumn("strip", _part("x", "_xs")).drop("_xs")
    rows = t.groupBy(*within, "strip").agg(*_bounds("y", "_n", tile))
    rows = held(rows.select(*within, "strip", _chosen(_parts(F.col("_n"), tile)).alias("_ys")), "rows")
    t = held(t.join(rows, [*within, "strip"]).withColumn("tile", _part("y", "_ys")).drop("_ys"), "tiled")

    p = p.join(strips, within).withColumn("strip", _part("x", "_xs")).drop("_xs").join(rows, [*within, "strip"]).withColumn("tile", _part("y", "_ys")).drop("_ys")
    keys = [*within, "strip", "tile"]
    id_kind = targets.schema["cell_id"].dataType.simpleString()

    def answered(p: DataFrame) -> DataFrame:
        """Each probe's near places in the tile that it comes to; tiles that many probes come to are copied for them."""
        p = held(p, "probes")
        crowds = p.groupBy(*keys).agg(F.ceil(F.count("*") / PROBES).cast("int").alias("_m"))
        name = lambda salt: F.to_json(F.struct(*keys, salt.alias("_salt")))
        probe = F.struct(*[F.col(c) for c in (*within, "cell_id", "x", "y", "strip", "tile")]).alias("probe")
        a = t.join(crowds, keys).withColumn("_s", F.explode(F.sequence(F.lit(0), F.col("_m") - 1)))
        a = a.select(name(F.col("_s")).alias("key"), F.lit(0).alias("kind"), "x", "y", F.lit(0.0).alias("reach"), F.element_at("ids", 1).alias("first"), "ids")
        b = p.join(crowds, keys).select(name(F.pmod(F.xxhash64("cell_id", "x"), "_m")).alias("key"), F.lit(1).alias("kind"), "x", "y", "reach", probe)
        both = spread(a.unionByName(b, allowMissingColumns=True), "key").sortWithinPartitions("key", "kind")
        kind = both.schema["probe"].dataType.simpleString()
        return both.mapInArrow(_answers(most), f"probe {kind}, d2 double, ids array<{id_kind}>, last double, first boolean")

    home = held(answered(p.withColumn("reach", F.lit(float("inf")))), "answers")
    found = home.select("probe", "d2", "ids")
    tiles = t.groupBy(*keys).agg(*[f(c).alias(f"{c}{i}") for c in "xy" for i, f in ((0, F.min), (1, F.max))])
    if t.select(*keys).distinct().groupBy(*within).agg(F.count("*").alias("n")).where("n > 1").limit(1).count():
        found = found.union(answered(_visits(home, tiles, within)).select("probe", "d2", "ids"))
    out = found.select(*[F.col(f"probe.{c}").alias(c) for c in (*within, "cell_id")], "d2", F.explode("ids").alias("other"))
    if own:
        out = out.where("cell_id <> other")
    rank = F.row_number().over(Window.partitionBy(*within, "cell_id").orderBy("d2", "other"))
    return out.withColumn("rank", rank).where(F.col("rank") <= k).select(*within, "cell_id", "other", "rank", "d2")


def _visits(home: DataFrame, tiles: DataFrame, within: list[str]) -> DataFrame:
    """The tiles, besides its own, that the circle around each probe touches."""
    p = home.where("first").select(*[F.col(f"probe.{c}").alias(c) for c in (*within, "cell_id", "x", "y")], F.col("probe.strip").alias("_strip"), F.col("probe.tile").alias("_tile"), F.col("last").alias("reach"))
    gap = lambda c, low, high: F.greatest(low - c, c - high, F.lit(0.0))
    # a group has at most CUTS strips, and a strip as many tiles
    strip = F.struct("strip", "x0", "x1")
    wide = tiles.groupBy(*within, "strip").agg(F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.collect_list(F.struct("tile", "x0", "x1", "y0", "y1")).alias("_tiles"))
    wide = held(wide, "strips")
    p = p.join(wide.groupBy(*within).agg(F.collect_list(strip).alias("_strips")), within)
    p = p.withColumn("_one", F.explode(F.filter("_strips", lambda s: F.pow(gap(F.col("x"), s.x0, s.x1), F.lit(2.0)) <= F.col("reach")))).withColumn("strip", F.col("_one.strip")).drop("_one", "_strips")
    p = p.join(wide.select(*within, "strip", "_tiles"), [*within, "strip"])
    near = F.filter("_tiles", lambda u: (F.pow(gap(F.col("x"), u.x0, u.x1), F.lit(2.0)) + F.pow(gap(F.col("y"), u.y0, u.y1), F.lit(2.0)) <= F.col("reach")) & ((F.col("strip") != F.col("_strip")) | (u.tile != F.col("_tile"))))
    return p.withColumn("_one", F.explode(near)).select(*within, "cell_id", "x", "y", "strip", F.col("_one.tile").alias("tile"), "reach")


def nearest(points: DataFrame, k: int, within: list[str]) -> DataFrame:
    """(within, cell_id, other, rank, d2): the k nearest other points of the same group, ties by id."""
    return nearest_between(points, points, k, within, own=True)
