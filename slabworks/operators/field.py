"""Smooth functions of space on few centres: robust vector fields, their derivatives and paths, and Gaussian-process interpolation.

Both are regressions on M kernel functions, M a parameter.  What a fit needs of the points is M x M and M x D sums, which
tasks build from their own rows and a second level adds up, so that the driver gets a handful of matrices a round and
never a point; only the centres, which are chosen by hash, and the coefficients are sent to tasks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slabworks.functions.columns import hash_rank
from slabworks.session import held, ship

#: Centres at most, rows of a kernel block, and partial sums that reach the driver.
MOST_CENTRES, BLOCK, PARTS = 2_000, 4_096, 8


def kernel(x: np.ndarray, centres: np.ndarray, beta: float) -> np.ndarray:
    """exp(-beta |x - c|^2)."""
    d = np.zeros((len(x), len(centres)))
    for i in range(x.shape[1]):
        d += (x[:, i, None] - centres[None, :, i]) ** 2
    return np.exp(-beta * d)


def summed(rows: DataFrame, function: Callable[[pd.DataFrame], dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    """The sum over all batches of the arrays that ``function`` makes of one; empty without rows.

    Arrays are added within tasks, then within PARTS tasks, then on the driver.
    """
    ship(rows.sparkSession)

    def packed(total: dict[str, np.ndarray]) -> pd.DataFrame:
        return pd.DataFrame({"name": list(total), "shape": [list(v.shape) for v in total.values()], "data": [np.ascontiguousarray(v, "<f8").tobytes() for v in total.values()]})

    def add(total: dict, more: dict) -> dict:
        return total | {k: total[k] + v if k in total else v for k, v in more.items()}

    def unpacked(pdf: pd.DataFrame) -> Iterator[tuple[str, np.ndarray]]:
        for name, shape, data in zip(pdf["name"], pdf["shape"], pdf["data"]):
            yield name, np.frombuffer(data, "<f8").reshape([int(s) for s in shape])

    def first(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for pdf in parts:
            for i in range(0, len(pdf), BLOCK):
                total = add(total, {k: np.asarray(v, float) for k, v in function(pdf.iloc[i : i + BLOCK]).items()})
        if total:
            yield packed(total)

    def second(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for pdf in parts:
            for name, v in unpacked(pdf):
                total = add(total, {name: v})
        if total:
            yield packed(total)

    schema = "name string, shape array<long>, data binary"
    out: dict[str, np.ndarray] = {}
    parts = rows.mapInPandas(first, schema)
    if rows.rdd.getNumPartitions() > PARTS:
        parts = parts.repartition(PARTS).mapInPandas(second, schema)
    for name, v in unpacked(parts.toPandas()):
        out = add(out, {name: v})
    return out


def centres_of(rows: DataFrame, axes: list[str], m: int, seed: int = 0) -> np.ndarray:
    """At most m different places of the rows, by hash of their coordinates: the same ones however the rows are dealt."""
    if m > MOST_CENTRES:
        raise ValueError(f"more than {MOST_CENTRES} centres")
    at = rows.select(*axes).dropna().distinct()
    return at.orderBy(hash_rank(seed, F.concat_ws("|", *axes)), *axes).limit(m).toPandas()[axes].to_numpy(float).reshape(-1, len(axes))


@dataclass(frozen=True)
class FieldFit:
    """Settings of a robust field: kernel width and smoothing, prior density of outliers, share of inliers at the start, ends of the iteration."""

    centres: int = 100
    beta: float = 0.1
    smoothing: float = 3.0
    outliers: float = 5.0
    inliers: float = 0.9
    least_weight: float = 1e-5
    certain: float = 0.75
    change: float = 1e-5
    rounds: int = 100
    seed: int = 0


@dataclass(frozen=True)
class VectorField:
    """v(x) = sum_m c_m exp(-beta |z - z_m|^2) with z the standardised x, in the units of the data."""

    axes: list[str]
    centres: np.ndarray
    coefficients: np.ndarray
    beta: float
    middle: np.ndarray
    scale: float
    unit: float
    rounds: int = 0
    sigma2: float = 0.0
    inliers: float = 0.0
    converged: bool = False
    energies: list[float] = field(default_factory=list)

    def at(self, x: np.ndarray) -> np.ndarray:
        return kernel((x - self.middle) / self.scale, self.centres, self.beta) @ self.coefficients * self.unit

    def jacobian(self, x: np.ndarray) -> np.ndarray:
        """(n, D, D): derivative of component i by coordinate j."""
        z = (x - self.middle) / self.scale
        k = kernel(z, self.centres, self.beta)
        out = np.empty((len(x), x.shape[1], x.shape[1]))
        for j in range(x.shape[1]):
            slope = -2 * self.beta * (z[:, j, None] - self.centres[None, :, j]) * k
            out[:, :, j] = slope @ self.coefficients * (self.unit / self.scale)
        return out


def fit_field(rows: DataFrame, axes: list[str], vectors: list[str], cfg: FieldFit = FieldFit()) -> VectorField:
    """The field that fits the vectors at the points, by expectation maximisation with an outlier class.

    A round weighs every vector by how likely it is no outlier under the present field, then solves the regularised
    weighted regression on the centres; variance and share of inliers follow from the same sums.  It ends when the
    energy changes by less than ``change`` of itself.  Points are centred and scaled to unit mean square length, vectors
    to unit mean square.  Rows with a missing number take no part; without rows the field is an error.
    """
    known = held(rows.select(*[F.col(c).cast("double").alias(c) for c in (*axes, *vectors)]).dropna(), "field")
    d = len(axes)
    s = summed(known, lambda p: {"n": np.array([len(p)]), "x": p[axes].to_numpy().sum(0), "y2": np.array([(p[vectors].to_numpy() ** 2).sum()])})
    if not s:
        raise ValueError("a field needs points")
    n, middle = float(s["n"][0]), s["x"] / s["n"][0]
    spread = float(summed(known, lambda p: {"x2": np.array([((p[axes].to_numpy() - middle) ** 2).sum()])})["x2"][0])
    scale, unit = math.sqrt(spread / n) or 1.0, math.sqrt(float(s["y2"][0]) / n) or 1.0
    centres = (centres_of(known, axes, cfg.centres, cfg.seed) - middle) / scale
    gram = kernel(centres, centres, cfg.beta)
    c, sigma2, gamma, energy = np.zeros((len(centres), d)), 1.0 / d, cfg.inliers, None
    energies, done = [], False
    for _ in range(cfg.rounds):

        def weigh(pdf: pd.DataFrame, c=c, sigma2=sigma2, gamma=gamma) -> dict[str, np.ndarray]:
            u = kernel((pdf[axes].to_numpy() - middle) / scale, centres, cfg.beta)
            y = pdf[vectors].to_numpy() / unit
            r2 = ((y - u @ c) ** 2).sum(1)
            likely = np.exp(-r2 / (2 * sigma2))
            p = likely / (likely + (2 * np.pi * sigma2) ** (d / 2) * (1 - gamma) / (gamma * cfg.outliers))
            w = np.maximum(p, cfg.least_weight)
            uw = u * w[:, None]
            return {"uu": uw.T @ u, "uy": uw.T @ y, "yy": np.array([(w * (y**2).sum(1)).sum()]), "w": np.array([w.sum()]), "p": np.array([p.sum()]), "pr": np.array([(p * r2).sum()]), "sure": np.array([(p > cfg.certain).sum()])}

        t = summed(known, weigh)
        now = float(t["pr"][0]) / (2 * sigma2) + float(t["p"][0]) * math.log(sigma2) * d / 2 + cfg.smoothing / 2 * float(np.trace(c.T @ gram @ c))
        energies.append(now)
        if energy is not None and abs(now - energy) <= cfg.change * abs(now):
            done = True
            break
        energy = now
        left = t["uu"] + cfg.smoothing * sigma2 * gram
        c = np.linalg.lstsq(left + 1e-10 * np.trace(left) / len(left) * np.eye(len(left)), t["uy"], rcond=None)[0]
        # the weighted residuals of the new coefficients, from the same sums
        rest = float(t["yy"][0]) - 2 * float((c * t["uy"]).sum()) + float((c * (t["uu"] @ c)).sum())
        sigma2 = max(rest / (float(t["w"][0]) * d), 1e-10)
        gamma = min(0.95, max(0.05, float(t["sure"][0]) / n))
        if sigma2 <= 1e-8:
            done = True
            break
    return VectorField(list(axes), centres, c, cfg.beta, middle, scale, unit, len(energies), sigma2 * unit**2, gamma, done, energies)


def field_values(rows: DataFrame, f: VectorField) -> DataFrame:
    """rows with v_<axis>, speed, divergence, jacobian_norm, and j_<axis><axis> (component, coordinate); NULLs where a coordinate is missing."""
    axes = f.axes
    names = [f"v_{a}" for a in axes] + ["speed", "divergence", "jacobian_norm"] + [f"j_{a}{b}" for a in axes for b in axes]
    schema = ", ".join([*[f"`{c.name}` {c.dataType.simpleString()}" for c in rows.schema], *[f"{c} double" for c in names]])

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            x = pdf[axes].to_numpy(float)
            v, j = f.at(x), f.jacobian(x)
            values = np.column_stack([v, np.sqrt((v**2).sum(1)), np.trace(j, axis1=1, axis2=2), np.sqrt((j**2).sum((1, 2))), j.reshape(len(x), -1)])
            values[np.isnan(x).any(1)] = np.nan
            more = pd.DataFrame(values, columns=names, index=pdf.index).astype(object)
            yield pd.concat([pdf, more.where(more.notna(), None)], axis=1)

    ship(rows.sparkSession)
    return rows.mapInPandas(run, schema)


def paths(rows: DataFrame, f: VectorField, t_end: float, steps: int, every: int = 1, forward: bool = True) -> DataFrame:
    """(cell_id, step, t, <axes>): where each point goes along the field, by the classical Runge-Kutta rule of fourth order; all kept steps, the start included.

    Backward, time runs from 0 to -t_end.  Points with a missing coordinate have no path.
    """
    axes, h = f.axes, (1 if forward else -1) * t_end / steps
    kind = rows.schema["cell_id"].dataType.simpleString()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in parts:
            for i in range(0, len(whole), BLOCK):
                pdf = whole.iloc[i : i + BLOCK].dropna()
                x = pdf[axes].to_numpy(float)
                for k in range(steps + 1):
                    if k % every == 0 or k == steps:
                        yield pd.DataFrame({"cell_id": pdf["cell_id"].to_numpy(), "step": k, "t": k * h} | {a: x[:, j] for j, a in enumerate(axes)})
                    if k < steps:
                        a = f.at(x)
                        b = f.at(x + h / 2 * a)
                        c = f.at(x + h / 2 * b)
                        x = x + h / 6 * (a + 2 * b + 2 * c + f.at(x + h * c))

    ship(rows.sparkSession)
    return rows.select("cell_id", *[F.col(a).cast("double").alias(a) for a in axes]).mapInPandas(run, f"cell_id {kind}, step int, t double, " + ", ".join(f"{a} double" for a in axes))


def outside_share(path: DataFrame, rows: DataFrame, axes: list[str], margin: float = 0.1) -> DataFrame:
    """One row: points of all paths, how many leave the rows' box widened by ``margin`` of each side, and their share."""
    box = rows.agg(*[f(a).alias(f"{a}{i}") for a in axes for i, f in ((0, F.min), (1, F.max))])
    wide = {a: F.greatest(F.col(f"{a}1") - F.col(f"{a}0"), F.lit(1e-9)) * margin for a in axes}
    out = F.lit(False)
    for a in axes:
        out = out | (F.col(a) < F.col(f"{a}0") - wide[a]) | (F.col(a) > F.col(f"{a}1") + wide[a])
    one = path.crossJoin(F.broadcast(box)).agg(F.count("*").alias("points"), F.count_if(out).alias("outside"))  # one row
    return one.withColumn("share", F.try_divide("outside", "points"))


@dataclass(frozen=True)
class Interpolation:
    """A Gaussian process on inducing points: noise as a share of the signal's variance, and length scales that are tried (in standardised units)."""

    inducing: int = 128
    lengths: tuple[float, ...] = (0.1, 0.2, 0.4, 0.8, 1.6)
    noises: tuple[float, ...] = (0.01, 0.1, 1.0)
    seed: int = 0


@dataclass(frozen=True)
class Surrogate:
    axes: list[str]
    names: list[str]
    inducing: np.ndarray
    weights: np.ndarray
    means: np.ndarray
    lengths: np.ndarray
    noises: np.ndarray
    middle: np.ndarray
    scale: float
    evidence: np.ndarray

    def at(self, x: np.ndarray) -> np.ndarray:
        z, out = (x - self.middle) / self.scale, np.empty((len(x), len(self.names)))
        for i, length in enumerate(self.lengths):
            out[:, i] = kernel(z, self.inducing, 0.5 / length**2) @ self.weights[:, i] + self.means[i]
        return out


def fit_interpolation(rows: DataFrame, axes: list[str], values: list[str], cfg: Interpolation = Interpolation()) -> Surrogate:
    """For each value column the process on inducing points whose length scale and noise have the greatest evidence.

    The process is the subset-of-regressors one: with K the inducing points' kernel matrix and U the points', the mean is
    u (s K + U'U)^-1 U'y for noise s.  U'U and U'y of all lengths come from one pass, evidences and weights from them.
    A missing value leaves its row out of all; the values' mean is taken off and added again.
    """
    known = held(rows.select(*[F.col(c).cast("double").alias(c) for c in (*axes, *values)]).dropna(), "process")
    s = summed(known, lambda p: {"n": np.array([len(p)]), "x": p[axes].to_numpy().sum(0), "y": p[values].to_numpy().sum(0)})
    if not s:
        raise ValueError("an interpolation needs points")
    n, middle, means = float(s["n"][0]), s["x"] / s["n"][0], s["y"] / s["n"][0]
    scale = math.sqrt(float(summed(known, lambda p: {"x2": np.array([((p[axes].to_numpy() - middle) ** 2).sum()])})["x2"][0]) / n) or 1.0
    z = (centres_of(known, axes, cfg.inducing, cfg.seed) - middle) / scale
    m = len(z)

    def sums(pdf: pd.DataFrame) -> dict[str, np.ndarray]:
        x, y = (pdf[axes].to_numpy() - middle) / scale, pdf[values].to_numpy() - means
        out = {"yy": (y**2).sum(0)}
        for i, length in enumerate(cfg.lengths):
            u = kernel(x, z, 0.5 / length**2)
            out |= {f"uu{i}": u.T @ u, f"uy{i}": u.T @ y}
        return out

    t = summed(known, sums)
    best = [(-np.inf, 0.0, 0.0, np.zeros(m))] * len(values)
    for i, length in enumerate(cfg.lengths):
        k = kernel(z, z, 0.5 / length**2) + 1e-8 * np.eye(m)
        low = np.linalg.cholesky(k)
        # in the basis of K's root: the evidence of Q + s I for Q = U K^-1 U'
        a = np.linalg.solve(low, np.linalg.solve(low, t[f"uu{i}"]).T)
        b = np.linalg.solve(low, t[f"uy{i}"])
        for noise in cfg.noises:
            inner = np.linalg.cholesky(noise * np.eye(m) + (a + a.T) / 2)
            h = np.linalg.solve(inner, b)
            logdet = 2 * np.log(np.diag(inner)).sum() + (n - m) * math.log(noise)
            for j in range(len(values)):
                fit = max(float(t["yy"][j] - (h[:, j] ** 2).sum()) / noise, 1e-300)
                # the signal's variance at its best value
                evidence = -0.5 * (n * math.log(fit / n) + logdet)
                if evidence > best[j][0]:
                    best[j] = (evidence, length, noise, np.linalg.solve(low.T, np.linalg.solve(inner.T, h[:, j])))
    return Surrogate(list(axes), list(values), z, np.column_stack([x[3] for x in best]), means, np.array([x[1] for x in best]), np.array([x[2] for x in best]), middle, scale, np.array([x[0] for x in best]))


def interpolated(rows: DataFrame, g: Surrogate) -> DataFrame:
    """rows with <value>_smooth for each value of the interpolation; NULLs where a coordinate is missing."""
    names = [f"{v}_smooth" for v in g.names]
    schema = ", ".join([*[f"`{c.name}` {c.dataType.simpleString()}" for c in rows.schema], *[f"`{c}` double" for c in names]])

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            values = np.concatenate([g.at(pdf[g.axes].iloc[i : i + BLOCK].to_numpy(float)) for i in range(0, len(pdf), BLOCK)] or [np.zeros((0, len(names)))])
            more = pd.DataFrame(values, columns=names, index=pdf.index).astype(object)
            yield pd.concat([pdf, more.where(more.notna(), None)], axis=1)

    ship(rows.sparkSession)
    return rows.mapInPandas(run, schema)
