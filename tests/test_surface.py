import numpy as np
import pytest

from slabworks.operators import surface as U


def grid(spark, f, low, high, name="a"):
    at = [(name, i, j, k, float(f(i, j, k))) for i in range(low, high) for j in range(low, high) for k in range(low, high)]
    return spark.createDataFrame([x for x in at if x[4] > 0], "name string, ix long, iy long, iz long, density double")


def ellipsoid(i, j, k):
    return max(0.0, 1 - ((i / 9) ** 2 + (j / 7) ** 2 + (k / 5) ** 2) / 2)


def ring(i, j, k):
    return max(0.0, 1 - ((np.hypot(i, j) - 7) ** 2 + k * k) / 18)


def shell(i, j, k):
    r = np.sqrt(i * i + j * j + k * k)
    return max(0.0, 1 - abs(r - 7) / 6)


def test_ellipsoid_ring_and_hollow_ball(spark):
    g = grid(spark, ellipsoid, -13, 14).unionByName(grid(spark, ring, -13, 14, "ring")).unionByName(grid(spark, shell, -15, 16, "shell")).unionByName(grid(spark, lambda *_: 0.3, 0, 2, "low"))
    got = {r.name: r for r in U.surface_report(U.isosurface(g, 0.5, 0.5, ["name"]), ["name"]).collect()}
    assert set(got) == {"a", "ring", "shell"} and all(r.watertight and not r.open_edges and not r.twisted_edges for r in got.values())
    assert [got[n].euler for n in ("a", "ring", "shell")] == [2, 0, 4]
    assert got["a"].volume == pytest.approx(4 / 3 * np.pi * 9 * 7 * 5 / 8, rel=0.02)
    assert got["ring"].volume == pytest.approx(2 * np.pi**2 * 7 * 9 / 8, rel=0.04)
    assert got["shell"].volume == pytest.approx(4 / 3 * np.pi * (10**3 - 4**3) / 8, rel=0.04)


def test_blocks_join_without_seams(spark, monkeypatch):
    rng = np.random.default_rng(4)
    field = {(i, j, k): rng.random() for i in range(-6, 7) for j in range(-6, 7) for k in range(-6, 7)}
    g = grid(spark, lambda i, j, k: field[i, j, k], -6, 7)
    whole = {tuple(r) for r in U.isosurface(g, 0.6, 1.0, ["name"]).collect()}
    r = U.surface_report(U.isosurface(g, 0.6, 1.0, ["name"]), ["name"]).first()
    assert r.watertight and r.edges * 2 == r.faces * 3
    monkeypatch.setattr(U, "SIDE", 3)
    assert {tuple(r) for r in U.isosurface(g.repartition(3), 0.6, 1.0, ["name"]).collect()} == whole and len(whole) == r.faces


def test_a_hole_in_a_surface_is_open(spark):
    t = U.isosurface(grid(spark, ellipsoid, -13, 14), 0.5, 1.0, ["name"])
    first = t.orderBy("v1", "v2", "v3").limit(1)
    r = U.surface_report(t.subtract(first), ["name"]).first()
    assert r.open_edges == 3 and not r.watertight
    turned = first.selectExpr("name", "v1", "v3 as v2", "v2 as v3", "x1", "y1", "z1", "x3 as x2", "y3 as y2", "z3 as z2", "x2 as x3", "y2 as y3", "z2 as z3")
    assert U.surface_report(t.subtract(first).unionByName(turned), ["name"]).first().twisted_edges == 3


def linear(field, p):
    """The density at a point, linear on the tetrahedra that order its fractions."""
    base = np.floor(p).astype(int)
    f = p - base
    at, value, left = base.copy(), 0.0, 1.0
    for axis in np.argsort(-f, kind="stable"):
        value += (left - f[axis]) * field(*at)
        left = f[axis]
        at = at + np.eye(3, dtype=int)[axis]
    return value + left * field(*at)


def test_points_inside_are_those_above_the_level(spark):
    rng = np.random.default_rng(7)
    random = {(i, j, k): rng.random() for i in range(-5, 6) for j in range(-5, 6) for k in range(-5, 6)}
    field = lambda i, j, k: random.get((i, j, k), 0.0)
    t = U.isosurface(grid(spark, field, -5, 6), 0.55, 1.0, ["name"]).cache()
    points = rng.uniform(-6.5, 6.5, (600, 3))
    points[:200, 0] = np.round(points[:200, 0])  # straight below grid planes, edges and corners
    points[100:300, 1] = np.round(points[100:300, 1])
    rows = [("a", i, *map(float, p)) for i, p in enumerate(points)] + [("none", 1000, 0.0, 0.0, 0.0), ("a", 1001, None, 0.0, 0.0), ("a", 1002, *map(float, points[0]))]
    df = spark.createDataFrame(rows, "name string, cell_id long, x double, y double, z double")
    want = {i: linear(field, p) >= 0.55 for i, p in enumerate(points)}
    for width in (1.0, 0.4, 100.0):
        got = {r.cell_id: r for r in U.containment(df, t, width, ["name"]).collect()}
        assert {i: got[i].inside for i in want} == want
        assert got[1000].inside is False and got[1001].inside is None and got[1002].crossings == got[0].crossings
    assert 100 < sum(want.values()) < 500


def test_a_point_below_an_edge_counts_once(spark):
    corners = np.array([[x, y, z] for x in (0.0, 2.0) for y in (0.0, 2.0) for z in (0.0, 2.0)])
    quads = [(0, 1, 3, 2), (4, 6, 7, 5), (0, 4, 5, 1), (2, 3, 7, 6), (0, 2, 6, 4), (1, 5, 7, 3)]
    faces = [(a, b, c) for q in quads for a, b, c in ((q[0], q[1], q[2]), (q[0], q[2], q[3]))]
    t = spark.createDataFrame([("a", *map(int, f), *[float(x) for v in f for x in corners[v]]) for f in faces], "name string, v1 long, v2 long, v3 long, " + ", ".join(f"{a}{i} double" for i in (1, 2, 3) for a in "xyz"))
    inside = {(1.0, 1.0, 1.0), (0.5, 0.5, 1.9), (1.5, 0.5, 0.1), (0.0, 0.5, 1.0)}  # lower x and y sides belong to the box
    outside = {(1.0, 1.0, 2.5), (1.0, 1.0, -1.0), (3.0, 1.0, 1.0), (2.0, 0.5, 1.0), (-1.0, 2.0, 1.0), (1.0, 1.0, 2.0)}
    df = spark.createDataFrame([("a", *p) for p in inside | outside], "name string, x double, y double, z double")
    r = U.surface_report(t, ["name"]).first()
    assert r.watertight and r.euler == 2 and abs(r.volume) == pytest.approx(8)
    assert {(p.x, p.y, p.z) for p in U.containment(df, t, 0.7, ["name"]).where("inside").collect()} == inside


def test_odd_nodes_are_told(spark):
    g = spark.createDataFrame([("a", 0, 0, 0, 1.0), ("a", 0, 0, 0, 0.2), ("a", 1, 0, 0, None)], "name string, ix long, iy long, iz long, density double")
    r = U.surface_report(U.isosurface(g, 0.5, 1.0, ["name"]), ["name"]).first()
    assert (r.euler, r.vertices, r.faces) == (2, 14, 24)
    wide = spark.createDataFrame([("a", 1 << 20, 0, 0, 1.0)], g.schema)
    with pytest.raises(Exception, match="too wide"):
        U.isosurface(wide, 0.5, 1.0, ["name"]).count()
    assert U.isosurface(g.limit(0), 0.5, 1.0, ["name"]).count() == 0
