import math

import numpy as np
import pytest

from slabworks.operators import field as L


def swirl(n=400, wrong=0, seed=1):
    """Points, vectors of a rotation with a drift, and some vectors that are anything."""
    rng = np.random.default_rng(seed)
    x = rng.uniform(-3, 3, (n, 2))
    v = np.column_stack([-x[:, 1] + 0.5, x[:, 0]])
    v[:wrong] = rng.uniform(-12, 12, (wrong, 2))
    return x, v


def frame(spark, x, v):
    return spark.createDataFrame([(i, *map(float, p), *map(float, q)) for i, (p, q) in enumerate(zip(x, v))], "cell_id long, x double, y double, u double, w double").repartition(3)


CFG = L.FieldFit(centres=60, beta=0.5, smoothing=0.01, rounds=40)


def by_hand(x, v, cfg, centres):
    """The same iteration on dense arrays, residuals taken from the points."""
    n, d = x.shape
    middle = x.mean(0)
    scale, unit = math.sqrt(((x - middle) ** 2).sum() / n), math.sqrt((v**2).sum() / n)
    z, y, c = (x - middle) / scale, v / unit, (centres - middle) / scale
    k = lambda a, b: np.exp(-cfg.beta * ((a[:, None] - b[None]) ** 2).sum(-1))
    u, g = k(z, c), k(c, c)
    w, s2, gamma, last = np.zeros((len(c), d)), 1 / d, cfg.inliers, None
    for _ in range(cfg.rounds):
        r2 = ((y - u @ w) ** 2).sum(1)
        a = np.exp(-r2 / (2 * s2))
        p = a / (a + (2 * np.pi * s2) ** (d / 2) * (1 - gamma) / (gamma * cfg.outliers))
        e = (p * r2).sum() / (2 * s2) + p.sum() * math.log(s2) * d / 2 + cfg.smoothing / 2 * np.trace(w.T @ g @ w)
        if last is not None and abs(e - last) <= cfg.change * abs(e):
            break
        last, q = e, np.maximum(p, cfg.least_weight)
        left = (u * q[:, None]).T @ u + cfg.smoothing * s2 * g
        w = np.linalg.lstsq(left + 1e-10 * np.trace(left) / len(left) * np.eye(len(left)), (u * q[:, None]).T @ y, rcond=None)[0]
        s2 = max((q * ((y - u @ w) ** 2).sum(1)).sum() / (q.sum() * d), 1e-10)
        gamma = min(0.95, max(0.05, (p > cfg.certain).mean()))
    return u @ w * unit


def test_field_equals_the_iteration_by_hand(spark):
    x, v = swirl(300, 40)
    df = frame(spark, x, v)
    f = L.fit_field(df, ["x", "y"], ["u", "w"], CFG)
    centres = L.centres_of(df, ["x", "y"], 60)
    assert np.allclose(np.sort(centres, axis=0), np.sort(f.centres * f.scale + f.middle, axis=0))
    assert np.abs(f.at(x) - by_hand(x, v, CFG, centres)).max() < 1e-5


def test_wrong_vectors_are_ignored(spark):
    x, v = swirl(500, 100)
    f = L.fit_field(frame(spark, x, v), ["x", "y"], ["u", "w"], CFG)
    off = np.sqrt(((f.at(x) - swirl(500)[1]) ** 2).sum(1))
    assert np.quantile(off, 0.9) < 0.2 and 0.7 < f.inliers < 0.9


def test_derivatives_and_columns(spark):
    x, v = swirl()
    df = frame(spark, x, v)
    f = L.fit_field(df, ["x", "y"], ["u", "w"], CFG)
    at, h = np.array([[0.3, -1.0], [2.0, 0.1]]), 1e-5
    j = f.jacobian(at)
    for b in range(2):
        step = np.eye(2)[b] * h
        assert np.allclose(j[:, :, b], (f.at(at + step) - f.at(at - step)) / (2 * h), atol=1e-6)
    more = df.unionByName(spark.createDataFrame([(9999, None, 1.0, None, None)], df.schema))
    got = {r.cell_id: r for r in L.field_values(more, f).collect()}
    assert got[9999].speed is None and got[9999].j_xx is None and len(got) == 401
    inner = [i for i in range(400) if np.abs(x[i]).max() < 2]
    assert np.median([abs(got[i].divergence) for i in inner]) < 0.05
    assert np.median([got[i].j_xy for i in inner]) == pytest.approx(-1, abs=0.05) and np.median([got[i].jacobian_norm for i in inner]) == pytest.approx(math.sqrt(2), abs=0.05)


def test_paths_of_a_rotation(spark):
    x, v = swirl(800)
    f = L.fit_field(frame(spark, x, v), ["x", "y"], ["u", "w"], L.FieldFit(centres=200, beta=0.5, smoothing=1e-6, rounds=40))
    start = spark.createDataFrame([(1, 1.0, 0.5), (2, 0.0, 0.5), (3, None, 0.0)], "cell_id long, x double, y double")
    p = {(r.cell_id, r.step): (r.x, r.y) for r in L.paths(start, f, 2 * math.pi, 100, every=50).collect()}
    assert set(p) == {(c, s) for c in (1, 2) for s in (0, 50, 100)}
    assert np.allclose(p[1, 100], (1, 0.5), atol=0.05) and np.allclose(p[1, 50], (-1, 0.5), atol=0.05) and np.allclose(p[2, 50], (0, 0.5), atol=0.05)
    back = {(r.cell_id, r.step): (r.x, r.y, r.t) for r in L.paths(start, f, math.pi / 2, 50, every=50, forward=False).collect()}
    assert np.allclose(back[1, 50], (0, -0.5, -math.pi / 2), atol=0.05)
    all_paths = L.paths(start, f, 2 * math.pi, 20)
    r = L.outside_share(all_paths, spark.createDataFrame([(0.0, 0.0), (1.0, 1.0)], "x double, y double"), ["x", "y"]).first()
    want = sum(q.x < -0.1 or q.x > 1.1 or q.y < -0.1 or q.y > 1.1 for q in all_paths.collect())
    assert (r.points, r.outside) == (42, want) and 0 < want < 42


def test_interpolation_with_all_points_is_the_full_process(spark):
    rng = np.random.default_rng(2)
    x = rng.uniform(-1, 1, (60, 2))
    y = np.sin(3 * x[:, 0]) + x[:, 1] + 0.05 * rng.normal(size=60)
    df = spark.createDataFrame([(i, *map(float, p), float(q), None if i == 0 else 1.0) for i, (p, q) in enumerate(zip(x, y))], "cell_id long, x double, y double, g double, c double").repartition(3)
    cfg = L.Interpolation(inducing=60, lengths=(0.3, 0.9), noises=(0.01, 0.3))
    s = L.fit_interpolation(df.select("cell_id", "x", "y", "g"), ["x", "y"], ["g"], cfg)
    z, t, best = (x - x.mean(0)) / math.sqrt(((x - x.mean(0)) ** 2).sum() / 60), y - y.mean(), None
    for length in cfg.lengths:
        k = np.exp(-0.5 * ((z[:, None] - z[None]) ** 2).sum(-1) / length**2)
        for noise in cfg.noises:
            c = k + noise * np.eye(60)
            evidence = -0.5 * (60 * math.log(t @ np.linalg.solve(c, t) / 60) + np.linalg.slogdet(c)[1])
            if best is None or evidence > best[0]:
                best = evidence, length, noise, k @ np.linalg.solve(c, t) + y.mean()
    assert (s.lengths[0], s.noises[0]) == best[1:3] and s.evidence[0] == pytest.approx(best[0], abs=1e-2)
    got = {r.cell_id: r.g_smooth for r in L.interpolated(df, s).collect()}
    assert max(abs(got[i] - best[3][i]) for i in got) < 1e-3
    few = L.fit_interpolation(df.select("cell_id", "x", "y", "g"), ["x", "y"], ["g"], L.Interpolation(inducing=25))
    assert np.sqrt(np.mean([(r.g_smooth - y[r.cell_id]) ** 2 for r in L.interpolated(df, few).collect()])) < 0.1
    assert len(L.fit_interpolation(df, ["x", "y"], ["g", "c"], cfg).names) == 2


def test_nothing_to_fit_is_an_error(spark):
    none = frame(spark, *swirl(3)).limit(0)
    with pytest.raises(ValueError):
        L.fit_field(none, ["x", "y"], ["u", "w"])
    with pytest.raises(ValueError):
        L.centres_of(none, ["x", "y"], 5_000)
