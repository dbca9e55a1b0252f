"""Column helpers with the engine's numeric conventions: NULL is missing evidence, divisions never fail."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Guards divisions: the double machine epsilon.
EPS = 2.220446049250313e-16
#: Turns a median absolute deviation into a normal standard deviation.
MAD_SCALE = 1.4826


def lit(x) -> Column:
    return F.lit(x).cast("double")


def over(a: Column, b: Column) -> Column:
    """a / max(b, EPS); NULL if either is."""
    return F.when(b.isNotNull(), a / F.greatest(b, lit(EPS)))


def clip(x: Column, low: float, high: float) -> Column:
    """x within bounds; NULL stays NULL."""
    return F.when(x.isNotNull(), F.least(F.greatest(x, lit(low)), lit(high)))


def both_min(a: Column, b: Column) -> Column:
    """The lesser of two values, NULL unless both are there (``least`` skips NULLs)."""
    return F.when(a.isNotNull() & b.isNotNull(), F.least(a, b))


def finite(x: Column) -> Column:
    """NaN and infinities become NULL."""
    return F.when(~F.isnan(x) & (F.abs(x) < lit(float("inf"))), x)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once a row, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def array_median(xs: Column) -> Column:
    """Median of an array of doubles without NULLs; NULL for an empty one."""

    def middle(s: Column) -> Column:
        n = F.size(s)
        half = F.floor((n - 1) / 2).cast("int") + 1
        return F.when(n > 0, (F.get(s, half - 1) + F.get(s, n - half)) / 2)

    return let(F.array_sort(xs), middle)


def natural_key(text: Column) -> Column:
    """A sort key: text in lower case, every run of digits padded so that numbers compare as numbers."""
    pieces = F.regexp_extract_all(F.lower(text), F.lit(r"(\d+|\D+)"), F.lit(1))
    return F.array_join(F.transform(pieces, lambda p: F.when(p.rlike(r"^\d"), F.lpad(p, 20, "0")).otherwise(p)), "")


def slice_number(text: Column) -> Column:
    """The last run of digits of a slice label; NULL without one."""
    found = F.regexp_extract(text, r"(\d+)\D*$", 1)
    return F.when(found != "", found.cast("int"))


def hash_rank(seed: int, key: Column) -> Column:
    """A sampling order that depends on a seed and an id alone: sixteen hex digits of SHA-1."""
    return F.substring(F.sha1(F.concat(F.lit(f"{seed}|"), key.cast("string")).cast("binary")), 1, 16)


def entropy(shares: Column, kinds: Column) -> Column:
    """Shannon entropy of an array of shares over ln(max(kinds, 2))."""
    total = F.aggregate(shares, lit(0.0), lambda acc, p: acc - F.when(p > 0, p * F.ln(p)).otherwise(lit(0.0)))
    return total / F.ln(F.greatest(kinds, F.lit(2)).cast("double"))


def rotate(x: Column, y: Column, radians: Column, cx: Column, cy: Column) -> tuple[Column, Column]:
    """Points turned about a centre."""
    c, s = F.cos(radians), F.sin(radians)
    return cx + c * (x - cx) - s * (y - cy), cy + s * (x - cx) + c * (y - cy)
