"""Rigid transforms, recipes and shape summaries as column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slabworks.functions.columns import lit, rotate


def rigid_fit(pairs: DataFrame, by: list[str]) -> DataFrame:
    """The rigid motion that takes (x1, y1) to (x2, y2) best, a row a group: theta, tx, ty, rmse.

    Closed form of the least-squares rotation in the plane (never a reflection), from grouped sums alone.
    """
    s = pairs.groupBy(*by).agg(F.avg("x1").alias("mx1"), F.avg("y1").alias("my1"), F.avg("x2").alias("mx2"), F.avg("y2").alias("my2"))
    c = pairs.join(s, by)
    a1, b1, a2, b2 = F.col("x1") - F.col("mx1"), F.col("y1") - F.col("my1"), F.col("x2") - F.col("mx2"), F.col("y2") - F.col("my2")
    t = c.groupBy(*by).agg(F.atan2(F.sum(a1 * b2 - b1 * a2), F.sum(a1 * a2 + b1 * b2)).alias("theta"), *[F.first(m).alias(m) for m in ("mx1", "my1", "mx2", "my2")])
    co, si = F.cos("theta"), F.sin("theta")
    t = t.withColumn("tx", F.col("mx2") - (co * F.col("mx1") - si * F.col("my1"))).withColumn("ty", F.col("my2") - (si * F.col("mx1") + co * F.col("my1")))
    fit = pairs.join(t.select(*by, "theta", "tx", "ty"), by)
    ex = co * F.col("x1") - si * F.col("y1") + F.col("tx") - F.col("x2")
    ey = si * F.col("x1") + co * F.col("y1") + F.col("ty") - F.col("y2")
    return fit.groupBy(*by).agg(F.first("theta").alias("theta"), F.first("tx").alias("tx"), F.first("ty").alias("ty"), F.sqrt(F.avg(ex * ex + ey * ey)).alias("rmse"), F.sqrt(F.max(ex * ex + ey * ey)).alias("max_error"))


def shape_summary(points: DataFrame, by: list[str]) -> DataFrame:
    """n, centre, principal angle (mod 180), aspect and median radius of each group of points."""
    m = points.groupBy(*by).agg(F.count("*").alias("n"), F.avg("x").alias("cx"), F.avg("y").alias("cy"), F.var_samp("x").alias("vx"), F.var_samp("y").alias("vy"), F.covar_samp("x", "y").alias("vxy"))
    half, gap = (F.col("vx") + F.col("vy")) / 2, F.sqrt(((F.col("vx") - F.col("vy")) / 2) ** 2 + F.col("vxy") ** 2)
    m = m.withColumn("angle", F.degrees(F.atan2(2 * F.col("vxy"), F.col("vx") - F.col("vy")) / 2)).withColumn("aspect", F.sqrt((half + gap) / F.greatest(half - gap, lit(2.220446049250313e-16))))
    r = points.join(m, by).groupBy(*by).agg(F.percentile(F.hypot(F.col("x") - F.col("cx"), F.col("y") - F.col("cy")), F.lit(0.5)).alias("median_radius"))
    return m.join(r, by).drop("vx", "vy", "vxy")


def scope_mask(step: dict) -> Column:
    """Rows that a recipe's step is for: its labels and slices, where given."""
    mask = F.lit(True)
    if step.get("slices"):
        mask = mask & F.col("slice_index").isin(list(step["slices"]))
    if step.get("celltypes"):
        mask = mask & F.col("celltype").isin(list(step["celltypes"]))
    return F.coalesce(mask, F.lit(False))


def apply_recipe(points: DataFrame, steps: Iterable[dict]) -> DataFrame:
    """Replays translate, rotate, scale and affine steps, each within its scope, about a stated centre."""
    out = points
    for step in steps:
        x, y = F.col("x"), F.col("y")
        cx, cy = (lit(v) for v in step.get("center", (0.0, 0.0)))
        kind = step["op"]
        if kind == "translate":
            nx, ny = x + step["dx"], y + step["dy"]
        elif kind == "rotate":
            nx, ny = rotate(x, y, F.radians(lit(step["degrees"])), cx, cy)
        elif kind == "scale":
            nx, ny = cx + (x - cx) * step["factor"], cy + (y - cy) * step["factor"]
        elif kind == "affine":
            (a, b, tx), (c, d, ty) = step["matrix"]
            nx, ny = x * a + y * b + tx, x * c + y * d + ty
        elif kind == "mirror":
            nx, ny = (2 * cx - x, y) if step["axis"] == "x" else (x, 2 * cy - y)
        else:
            raise ValueError(f"unknown step: {kind}")
        mask = scope_mask(step)
        out = out.withColumns({"x": F.when(mask, nx).otherwise(x), "y": F.when(mask, ny).otherwise(y)})
    return out


def changed_rows(before: DataFrame, after: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """(slice_index, n, changed, mean and max displacement) of replayed points."""
    both = before.select("slice_index", "cell_id", F.col("x").alias("x0"), F.col("y").alias("y0")).join(after.select("cell_id", "x", "y"), "cell_id")
    d = F.hypot(F.col("x") - F.col("x0"), F.col("y") - F.col("y0"))
    return both.groupBy("slice_index").agg(F.count("*").alias("n"), F.count_if(d > tolerance).alias("changed"), F.avg(d).alias("mean_shift"), F.max(d).alias("max_shift"))


def rigid_matrix_rules() -> dict[str, Column]:
    """Rules of a 2 x 3 rigid matrix in columns m00 to m12: finite, orthonormal, no reflection."""
    a, b, c, d = (F.col(m) for m in ("m00", "m01", "m10", "m11"))
    tol = 1e-7
    return {
        "finite": F.forall(F.array("m00", "m01", "m02", "m10", "m11", "m12"), lambda v: v.isNotNull() & ~F.isnan(v)),
        "orthonormal": (F.abs(a * a + c * c - 1) <= tol) & (F.abs(b * b + d * d - 1) <= tol) & (F.abs(a * b + c * d) <= tol),
        "no_reflection": F.abs(a * d - b * c - 1) <= tol,
    }
