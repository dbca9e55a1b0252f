"""Closed surfaces of voxel densities, their checks, and which points lie inside.

A surface is the level set of the density interpolated linearly on tetrahedra: every cube between eight grid nodes is
cut along its main diagonal into the six tetrahedra of the axes' permutations, so faces of neighbouring cubes agree
and no case is ambiguous.  A vertex lies on a grid edge and is named by that edge (lower node and direction), so that
blocks of cubes, worked on by different tasks, share vertices without a seam.  Nodes that are not in the table have
density 0; a node at the level counts as inside.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slabworks.functions.columns import lit
from slabworks.session import ship, spread

#: Cubes along an edge of a block; grid nodes from the middle that a vertex's name has room for.
SIDE, REACH = 16, 1 << 19

_AXES = np.eye(3, dtype=np.int64)


def _tetrahedra() -> np.ndarray:
    """(6, 4, 3) corners of a cube's tetrahedra, all of one orientation."""
    out = []
    for p in permutations(range(3)):
        corners = np.cumsum([np.zeros(3, np.int64), *_AXES[list(p)]], axis=0)
        turn = np.linalg.det(corners[1:])
        out.append(corners if turn > 0 else corners[[0, 2, 1, 3]])
    return np.array(out)


def _patterns() -> dict[int, list[list[tuple[int, int]]]]:
    """Triangles of each set of inside corners (a bit a corner), as pairs (inside corner, outside corner), seen from outside in turn."""
    out = {}
    for mask in range(1, 15):
        inside, outside = [c for c in range(4) if mask >> c & 1], [c for c in range(4) if not mask >> c & 1]
        if len(inside) == 2:
            (a, b), (c, d) = inside, outside
            ring = [(a, c), (a, d), (b, d), (b, c)]
            triangles = [[ring[0], ring[1], ring[2]], [ring[0], ring[2], ring[3]]]
        else:
            triangles = [[(i, o) for i in inside for o in outside]]
        # corners at the unit tetrahedron: a triangle's normal has to point from inside to outside
        at = np.array([[0, 0, 0], [1, 0, 0], [0, 1, 0], [0, 0, 1]], float)
        way = at[outside].mean(axis=0) - at[inside].mean(axis=0)
        fixed = []
        for t in triangles:
            p = np.array([(at[i] + at[o]) / 2 for i, o in t])
            fixed.append(t if np.cross(p[1] - p[0], p[2] - p[0]) @ way > 0 else [t[0], t[2], t[1]])
        out[mask] = fixed
    return out


TETRAHEDRA, PATTERNS = _tetrahedra(), _patterns()


def names(nodes: np.ndarray, ways: np.ndarray) -> np.ndarray:
    """63-bit names of the edges from nodes in directions of 0 and 1."""
    n = nodes + REACH
    return (n[:, 0] << 43) | (n[:, 1] << 23) | (n[:, 2] << 3) | (ways[:, 0] << 2) | (ways[:, 1] << 1) | ways[:, 2]


def triangles_of(field: np.ndarray, low: np.ndarray, level: float) -> tuple[np.ndarray, np.ndarray]:
    """(names, places): the corners of the triangles of a block of nodes whose first is ``low``; (n, 3) and (n, 3, 3), in grid units."""
    shape = np.array(field.shape) - 1
    cubes = np.stack(np.meshgrid(*[np.arange(k) for k in shape], indexing="ij"), axis=-1).reshape(-1, 3)
    corner = lambda o: field[cubes[:, 0] + o[0], cubes[:, 1] + o[1], cubes[:, 2] + o[2]]
    all_names, all_places = [], []
    for tet in TETRAHEDRA:
        d = np.stack([corner(o) for o in tet], axis=1)
        mask = ((d >= level) * (1 << np.arange(4))).sum(axis=1)
        for m, triangles in PATTERNS.items():
            at = np.flatnonzero(mask == m)
            if not len(at):
                continue
            for triangle in triangles:
                own_names, own_places = [], []
                for i, o in triangle:
                    # the same two nodes in the same order whichever tetrahedron asks: the same place to the last bit
                    a, b = (i, o) if tuple(tet[i]) <= tuple(tet[o]) else (o, i)
                    node, way = cubes[at] + tet[a] + low, tet[b] - tet[a]
                    share = (level - d[at, a]) / (d[at, b] - d[at, a])
                    own_names.append(names(node, np.broadcast_to(way, node.shape)))
                    own_places.append(node + share[:, None] * way)
                all_names.append(np.stack(own_names, axis=1))
                all_places.append(np.stack(own_places, axis=1))
    if not all_names:
        return np.zeros((0, 3), np.int64), np.zeros((0, 3, 3))
    return np.concatenate(all_names), np.concatenate(all_places)


def isosurface(nodes: DataFrame, level: float | Column, size: float, by: list[str]) -> DataFrame:
    """(by, v1, v2, v3, x1 ... z3): the triangles around nodes(by, ix, iy, iz, density) at or above a level, seen from outside counter-clockwise.

    ``level`` may be a column of nodes that is the same for all of a group.  A node goes to the block of cubes that it
    begins and, at a block's edge, to the neighbours as well; blocks without a crossing cost nothing more.  Repeated nodes
    count with their greatest density, those with a missing one aren't there; a group of no node above the level has
    no triangle.
    """
    schema = ", ".join([*[f"{nodes.schema[c].name} {nodes.schema[c].dataType.simpleString()}" for c in by], "v1 long, v2 long, v3 long", *[f"{a}{i} double" for i in (1, 2, 3) for a in "xyz"]])
    axes = ["ix", "iy", "iz"]
    n = nodes.where("density is not null").withColumn("_level", lit(level) if isinstance(level, (int, float)) else level).groupBy(*by, *axes).agg(F.max("density").alias("density"), F.first("_level").alias("_level"))
    fits = F.greatest(*[F.abs(a) for a in axes]) < REACH - 2
    n = n.withColumn("density", F.when(fits, F.col("density")).otherwise(F.raise_error(F.lit("the grid is too wide")).cast("double")))
    # a node is a corner of the cubes of its own place and of the one before on each axis
    for a in axes:
        n = n.withColumn(f"_b{a[1]}", F.explode(F.array_distinct(F.array(F.floor(F.col(a) / SIDE), F.floor((F.col(a) - 1) / SIDE)))))
    blocks = [*by, "_bx", "_by", "_bz"]
    crossed = n.groupBy(*blocks).agg((F.max("density") >= F.first("_level")).alias("some")).where("some").select(*blocks)
    n = n.join(crossed, blocks, "left_semi")

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        low = np.array(key[len(by) :], np.int64) * SIDE
        field = np.zeros((SIDE + 1,) * 3)
        at = pdf[axes].to_numpy(np.int64) - low
        field[at[:, 0], at[:, 1], at[:, 2]] = pdf["density"].to_numpy(float)
        v, p = triangles_of(field, low, float(pdf["_level"].iloc[0]))
        out = {c: [k] * len(v) for c, k in zip(by, key)} | {f"v{i + 1}": v[:, i] for i in range(3)}
        return pd.DataFrame(out | {f"{a}{i + 1}": p[:, i, j] * size for i in range(3) for j, a in enumerate("xyz")})

    ship(nodes.sparkSession)
    return spread(n.select(*blocks, *axes, "density", "_level"), *blocks).groupBy(*blocks).applyInPandas(one, schema)


def surface_report(triangles: DataFrame, by: list[str]) -> DataFrame:
    """(by, vertices, edges, faces, euler, open_edges, twisted_edges, watertight, area, volume) of each group's surface.

    An edge is open if it doesn't belong to two triangles and twisted if they run through it the same way; without
    either the surface is watertight and of one orientation.  volume is that enclosed, positive if seen from outside.
    """
    t = triangles
    ends = F.explode(F.array(*[F.struct(F.col(f"v{i}").alias("a"), F.col(f"v{j}").alias("b")) for i, j in ((1, 2), (2, 3), (3, 1))])).alias("e")
    edges = t.select(*by, ends).select(*by, F.least("e.a", "e.b").alias("a"), F.greatest("e.a", "e.b").alias("b"), F.when(F.col("e.a") < F.col("e.b"), 1).otherwise(-1).alias("way"))
    edges = edges.groupBy(*by, "a", "b").agg(F.count("*").alias("n"), F.sum("way").alias("way"))
    edges = edges.groupBy(*by).agg(F.count("*").alias("edges"), F.count_if(F.col("n") != 2).alias("open_edges"), F.count_if((F.col("n") == 2) & (F.col("way") != 0)).alias("twisted_edges"))
    vertices = t.select(*by, F.explode(F.array("v1", "v2", "v3")).alias("v")).groupBy(*by, "v").agg(F.lit(1).alias("one")).groupBy(*by).agg(F.count("*").alias("vertices"))
    u, w = ([F.col(f"{a}{i}") - F.col(f"{a}1") for a in "xyz"] for i in (2, 3))
    cross = lambda p, q: (p[1] * q[2] - p[2] * q[1], p[2] * q[0] - p[0] * q[2], p[0] * q[1] - p[1] * q[0])
    normal = cross(u, w)
    area = F.sqrt(sum((c * c for c in normal), lit(0))) / 2
    volume = sum((F.col(f"{a}1") * c for a, c in zip("xyz", normal)), lit(0)) / 6
    faces = t.groupBy(*by).agg(F.count("*").alias("faces"), F.sum(area).alias("area"), F.sum(volume).alias("volume"))
    out = faces.join(edges, by).join(vertices, by) if by else faces.crossJoin(edges).crossJoin(vertices)  # one row each
    tight = (F.col("open_edges") == 0) & (F.col("twisted_edges") == 0)
    return out.select(*by, "vertices", "edges", "faces", (F.col("vertices") - F.col("edges") + F.col("faces")).alias("euler"), "open_edges", "twisted_edges", tight.alias("watertight"), "area", "volume")


def _crosses(px: Column, py: Column, i: int, j: int) -> Column:
    """Whether a triangle's edge crosses the line from a point to greater x, in the plane of x and y.

    Half-open: an edge has its lower end but not its upper one.  Ends are taken in one order, so that the two
    triangles of an edge get the same number, and of all triangles around a point exactly one holds it, however it lies.
    """
    lower = (F.col(f"y{i}") < F.col(f"y{j}")) | ((F.col(f"y{i}") == F.col(f"y{j}")) & (F.col(f"x{i}") <= F.col(f"x{j}")))
    pick = lambda a, first: F.when(lower, F.col(f"{a}{i if first else j}")).otherwise(F.col(f"{a}{j if first else i}"))
    x1, y1, x2, y2 = pick("x", True), pick("y", True), pick("x", False), pick("y", False)
    return (y1 <= py) & (py < y2) & (px < x1 + (py - y1) / (y2 - y1) * (x2 - x1))


def containment(points: DataFrame, triangles: DataFrame, width: float, by: list[str]) -> DataFrame:
    """points with crossings (triangles above the point) and inside (whether their number is odd).

    ``by`` are columns of both tables.  Triangles are dealt to the columns of a grid of this width in x and y that
    their boxes touch, and points meet those of their own column in an equi-join that can be split; the width is best
    about that of a triangle.  A point straight below an edge or a corner belongs to exactly one of the triangles
    there, and one that lies on the surface is not below it.  Points with a missing coordinate have NULLs; a group
    without triangles contains nothing.  Repeated points are told one by one.
    """
    key = F.struct(*[F.col(c) for c in by], "x", "y", "z")
    p = points.where("x is not null and y is not null and z is not null").select(*by, "x", "y", "z").distinct()
    cell = lambda c: F.floor(c / width)
    corner = lambda a, f: f(*[F.col(f"{a}{i}") for i in (1, 2, 3)])
    t = triangles.select(*by, *[f"{a}{i}" for i in (1, 2, 3) for a in "xyz"])
    for a in "xy":
        t = t.withColumn(f"g{a}", F.explode(F.sequence(cell(corner(a, F.least)), cell(corner(a, F.greatest)))))
    p = p.select(*by, F.col("x").alias("px"), F.col("y").alias("py"), F.col("z").alias("pz"), cell(F.col("x")).alias("gx"), cell(F.col("y")).alias("gy"))
    held_by = _crosses(F.col("px"), F.col("py"), 1, 2) != _crosses(F.col("px"), F.col("py"), 2, 3)
    held_by = held_by != _crosses(F.col("px"), F.col("py"), 3, 1)
    x1, y1, z1 = (F.col(f"{a}1") for a in "xyz")
    ux, uy, uz = (F.col(f"{a}2") - F.col(f"{a}1") for a in "xyz")
    wx, wy, wz = (F.col(f"{a}3") - F.col(f"{a}1") for a in "xyz")
    flat = ux * wy - uy * wx
    dx, dy = F.col("px") - x1, F.col("py") - y1
    height = z1 + ((dx * wy - dy * wx) * uz + (dy * ux - dx * uy) * wz) / flat
    above = p.join(t, [*by, "gx", "gy"]).where(held_by & (flat != 0)).where(height > F.col("pz"))
    found = above.groupBy(*by, "px", "py", "pz").agg(F.count("*").alias("_n"))
    found = found.select(F.struct(*[F.col(c) for c in by], F.col("px").alias("x"), F.col("py").alias("y"), F.col("pz").alias("z")).alias("_k"), "_n")
    known = F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("z").isNotNull()
    out = points.withColumn("_k", key).join(found, "_k", "left")
    crossings = F.when(known, F.coalesce("_n", F.lit(0)))
    return out.withColumn("crossings", crossings).withColumn("inside", F.when(known, crossings % 2 == 1)).drop("_k", "_n")
