"""Optimal transport between two sets of points: entropic matrix scaling, barycentric displacements, marginals.

The plan P of a pair has P_ij = exp((f_i + g_j - c_ij) / e), where rows and columns are scaled in turn until both
marginals are right.  e shrinks from the scale of the costs to its final value, each time starting from the potentials
before, and costs are rebuilt from coordinates in blocks of rows, so that no table of all pairs is ever written.

``mapped`` solves many pairs at once, a pair a task; ``mapped_spread`` solves one large pair with its rows over all
tasks, of which only the potentials (a number a point) pass through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slabworks.functions.columns import lit
from slabworks.operators.assembly import MOST_PAIRS
from slabworks.session import held, ship, spread


@dataclass(frozen=True)
class Scaling:
    """epsilon: final softness as a share of the pair's mean cost; tolerance: largest error of a marginal as a share of 1 / n (fixed value of the acceptance rule)."""

    epsilon: float = 0.05
    tolerance: float = 1e-4
    rounds: int = 20_000
    shrink: float = 4.0


#: Costs held at once in blocks, and points of a side of a spread pair.
BLOCK, MOST_POINTS = 2_000_000, 2_000_000


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = np.zeros((len(a), len(b)))
    for i in range(a.shape[1]):  # differences first: no cancellation
        d += (a[:, i, None] - b[None, :, i]) ** 2
    return np.sqrt(d)


def _softnesses(cost: float, cfg: Scaling) -> list[float]:
    """From the mean cost down to the final softness."""
    out = [max(cost, 1e-300) * cfg.epsilon]
    while out[-1] * cfg.shrink < cost:
        out.append(out[-1] * cfg.shrink)
    return out[::-1]


def scaled(costs: np.ndarray, cfg: Scaling = Scaling()) -> tuple[np.ndarray, int, float, float]:
    """(plan, rounds, row error, column error) of one pair with uniform marginals; errors are absolute."""
    n, m = costs.shape
    a, b = 1 / n, 1 / m
    f, g, used = np.zeros(n), np.zeros(m), 0
    levels = _softnesses(float(costs.mean()), cfg)
    for e in levels:
        last = e == levels[-1]
        limit = cfg.tolerance if last else 0.05
        done = False
        while not done and used < cfg.rounds:
            # what the scalings have gathered goes into the potentials, so that the kernel never under- or overflows
            f = e * np.log(a) + _soft_least(costs, g, e)
            kernel = np.exp((f[:, None] + g[None, :] - costs) / e)
            u, v = np.ones(n), np.ones(m)
            for _ in range(100):
                v = b / np.maximum(kernel.T @ u, 1e-300)
                rows = kernel @ v
                used += 1
                done = float(np.abs(u * rows - a).max()) <= limit * a
                if done or used >= cfg.rounds or max(v.max(), 1 / max(v.min(), 1e-300)) > 1e100:
                    break
                u = a / np.maximum(rows, 1e-300)
            plan = u[:, None] * kernel * v[None, :]
            f, g = f + e * np.log(u), g + e * np.log(np.maximum(v, 1e-300))
    return plan, used, float(np.abs(plan.sum(1) - a).max()), float(np.abs(plan.sum(0) - b).max())


def _soft_least(costs: np.ndarray, g: np.ndarray, e: float) -> np.ndarray:
    """-e log sum_j exp((g_j - c_ij) / e) of each row."""
    s = (g[None, :] - costs) / e
    top = s.max(axis=1)
    return -e * (top + np.log(np.exp(s - top[:, None]).sum(axis=1)))


_REPORT = "rounds int, row_error double, column_error double, mass double, cost double, converged boolean"


def mapped(rows: DataFrame, by: list[str], axes: list[str], cfg: Scaling = Scaling(), most: int = MOST_PAIRS) -> DataFrame:
    """(by, cell_id, <axis>_to, moved, best, rounds, row_error, column_error, mass, cost, converged): where each source point of a pair goes.

    rows(by, side, cell_id, <axes>) with side 's' (source) and 't' (target).  <axis>_to is the mean of the targets
    under the point's row of the plan, moved its distance from there and best its target of the most mass (ties by id).
    Points with a missing coordinate take no part, a pair without points on a side has no row, and a pair with more than ``most``
    costs is refused; see ``mapped_spread``.  The errors are the largest of a marginal's, converged whether both are
    within the tolerance of 1 / n.
    """
    kind = rows.schema["cell_id"].dataType.simpleString()
    names = [rows.schema[c].name + " " + rows.schema[c].dataType.simpleString() for c in by]
    schema = ", ".join([*names, f"cell_id {kind}", *[f"{a}_to double" for a in axes], "moved double", f"best {kind}", _REPORT])

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.dropna(subset=axes).sort_values("cell_id")
        s, t = pdf[pdf["side"] == "s"], pdf[pdf["side"] == "t"]
        if not len(s) or not len(t):
            return pd.DataFrame(columns=[x.split(" ")[0] for x in schema.split(", ")])
        if len(s) * len(t) > most:
            raise ValueError(f"{len(s)} x {len(t)} pairs are more than {most}")
        p, q = s[axes].to_numpy(float), t[axes].to_numpy(float)
        costs = distances(p, q)
        plan, rounds, rows_off, columns_off = scaled(costs, cfg)
        to = (plan @ q) / plan.sum(1)[:, None]
        out = {c: k for c, k in zip(by, key)} | {"cell_id": s["cell_id"].to_numpy()} | {f"{a}_to": to[:, i] for i, a in enumerate(axes)}
        out |= {"moved": np.sqrt(((to - p) ** 2).sum(1)), "best": t["cell_id"].to_numpy()[plan.argmax(1)], "rounds": rounds, "row_error": rows_off, "column_error": columns_off}
        good = rows_off <= cfg.tolerance / len(s) and columns_off <= cfg.tolerance / len(t)
        return pd.DataFrame(out | {"mass": float(plan.sum()), "cost": float((plan * costs).sum()), "converged": good})

    ship(rows.sparkSession)
    return spread(rows.select(*by, "side", "cell_id", *axes), *by).groupBy(*by).applyInPandas(one, schema)


def mapped_spread(source: DataFrame, target: DataFrame, axes: list[str], cfg: Scaling = Scaling()) -> DataFrame:
    """As ``mapped`` for one pair of any shape of up to MOST_POINTS points a side, its source points dealt over all tasks; without best.

    A round is one job: every task scales its rows with the targets' potentials and returns what its rows bring to
    each column, a number a target.
    """
    spark = source.sparkSession
    ship(spark)
    keep = " and ".join(f"{a} is not null" for a in axes)
    t = target.where(keep).orderBy("cell_id").select(*axes).limit(MOST_POINTS + 1).toPandas().to_numpy(float)
    s = held(source.where(keep).select("cell_id", *axes).repartition(max(1, spark.sparkContext.defaultParallelism)), "transport")
    n, m = s.count(), len(t)
    if max(n, m) > MOST_POINTS:
        raise ValueError(f"more than {MOST_POINTS} points")
    kind = source.schema["cell_id"].dataType.simpleString()
    out = f"cell_id {kind}, " + ", ".join(f"{a}_to double" for a in axes) + ", moved double, " + _REPORT
    if not n or not m:
        return spark.createDataFrame([], out)
    b_t, step = spark.sparkContext.broadcast(t), max(1, BLOCK // m)

    def blocks(parts: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
        for pdf in parts:
            for i in range(0, len(pdf), step):
                yield pdf.iloc[i : i + step], distances(pdf[axes].iloc[i : i + step].to_numpy(float), b_t.value)

    def total(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"s": [sum(float(c.sum()) for _, c in blocks(parts))]})

    def columns(g: np.ndarray, e: float):
        """Each task's soft least costs of the columns, given its rows scaled to their marginal under g."""

        def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            top, low = np.full(m, -np.inf), np.zeros(m)
            for _, c in blocks(parts):
                x = (e * np.log(1 / n) + _soft_least(c, g, e)[:, None] - c) / e
                new = np.maximum(top, x.max(axis=0))
                low = low * np.exp(top - new) + np.exp(x - new).sum(axis=0)
                top = new
            if np.isfinite(top).all():
                yield pd.DataFrame({"top": [top.tobytes()], "low": [low.tobytes()]})

        return run

    cost = s.mapInPandas(total, "s double").agg(F.sum("s")).first()[0] / (n * m)
    g, used, e = np.zeros(m), 0, cost
    for e in _softnesses(cost, cfg):
        limit = cfg.tolerance if e == _softnesses(cost, cfg)[-1] else 0.05
        while used < cfg.rounds:
            parts = [(np.frombuffer(r.top), np.frombuffer(r.low)) for r in s.mapInPandas(columns(g, e), "top binary, low binary").collect()]
            top = np.max([x for x, _ in parts], axis=0)
            sums = top + np.log(np.sum([w * np.exp(x - top) for x, w in parts], axis=0))
            used += 1
            # with rows exact, the columns' sums are exp(sums + g / e)
            off = float(np.abs(np.exp(sums + g / e) - 1 / m).max())
            if off <= limit / m:
                break
            g = e * (np.log(1 / m) - sums)
    good = off <= cfg.tolerance / m

    def ends(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, c in blocks(parts):
            p = np.exp((e * np.log(1 / n) + _soft_least(c, g, e)[:, None] + g[None, :] - c) / e)
            to = (p @ b_t.value) / p.sum(1)[:, None]
            moved = np.sqrt(((to - pdf[axes].to_numpy(float)) ** 2).sum(1))
            yield pd.DataFrame({"cell_id": pdf["cell_id"].to_numpy()} | {f"{a}_to": to[:, i] for i, a in enumerate(axes)} | {"moved": moved, "rounds": used, "row_error": np.abs(p.sum(1) - 1 / n), "column_error": off, "mass": p.sum(1), "cost": (p * c).sum(1), "converged": good})

    return s.mapInPandas(ends, out)


def pair_report(mapping: DataFrame, by: list[str]) -> DataFrame:
    """(by, n, rounds, row_error, column_error, mass, cost, converged): a row a pair, which is what an acceptance looks at."""
    one = [F.first(c).alias(c) for c in ("rounds", "row_error", "column_error", "mass", "cost", "converged")]
    return mapping.groupBy(*by).agg(F.count("*").alias("n"), *one)


def displacement_summary(mapping: DataFrame, labels: DataFrame, by: list[str], label: str = "celltype") -> DataFrame:
    """(by, label, n, mean, median, p05, p95) of how far the points of each label move; points without a label form a row of their own."""
    rows = mapping.select(*by, "cell_id", "moved").join(labels.select("cell_id", label), "cell_id", "left")
    q = lambda p: F.percentile("moved", lit(p))
    return rows.groupBy(*by, label).agg(F.count("*").alias("n"), F.avg("moved").alias("mean"), q(0.5).alias("median"), q(0.05).alias("p05"), q(0.95).alias("p95"))
