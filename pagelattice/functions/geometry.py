"""Geometry functions over columns named x0, y0, x1, y1, with an optional prefix."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cx(p: str = "") -> Column:
    return (F.col(f"{p}x0") + F.col(f"{p}x1")) / 2


def cy(p: str = "") -> Column:
    return (F.col(f"{p}y0") + F.col(f"{p}y1")) / 2


def width(p: str = "") -> Column:
    return F.col(f"{p}x1") - F.col(f"{p}x0")


def height(p: str = "") -> Column:
    return F.col(f"{p}y1") - F.col(f"{p}y0")


def area(p: str = "") -> Column:
    return width(p) * height(p)


def overlap_x(a: str, b: str) -> Column:
    return F.least(F.col(f"{a}x1"), F.col(f"{b}x1")) - F.greatest(F.col(f"{a}x0"), F.col(f"{b}x0"))


def overlap_y(a: str, b: str) -> Column:
    return F.least(F.col(f"{a}y1"), F.col(f"{b}y1")) - F.greatest(F.col(f"{a}y0"), F.col(f"{b}y0"))


def intersection(a: str, b: str) -> Column:
    return F.greatest(overlap_x(a, b), F.lit(0.0)) * F.greatest(overlap_y(a, b), F.lit(0.0))


def iou(a: str, b: str) -> Column:
    both = intersection(a, b)
    return both / F.nullif(area(a) + area(b) - both, F.lit(0.0))


def cover(a: str, b: str) -> Column:
    """Share of a that b covers."""
    return intersection(a, b) / F.nullif(area(a), F.lit(0.0))


def x_aligned(w: str, r: str, slack: float = 2.0) -> Column:
    return cx(w).between(F.col(f"{r}x0") - slack, F.col(f"{r}x1") + slack)


def y_aligned(w: str, r: str, slack: float = 2.0) -> Column:
    return cy(w).between(F.col(f"{r}y0") - slack, F.col(f"{r}y1") + slack)


def fold(page_width: Column, page_height: Column, ratio: float = 1.2) -> Column:
    """x of a spread's fold; null on a single page."""
    return F.when(page_width > ratio * page_height, page_width / 2)


def side(x: Column, fold_x: Column) -> Column:
    """Left of the fold; null where there is none.  Compare with <=>."""
    return x < fold_x


def same_row(a: str, b: str, factor: float = 1.5) -> Column:
    """b's centre within `factor` heights of a (a's height counts, 1 at least)."""
    return F.abs(cy(a) - cy(b)) <= factor * F.greatest(height(a), F.lit(1.0))


def icon_suspect(size: Column, median: Column, repeated: Column, small: float = 0.05, share: float = 0.5) -> Column:
    return F.coalesce((median > 0) & ((size < small * median) | (repeated & (size < share * median))), F.lit(False))


def key20(p: str = "") -> Column:
    """Bounding box in 20 pt steps, rounded half to even."""
    return F.struct(*(F.bround(F.col(f"{p}{k}") / 20, 0).cast("long").alias(k) for k in ("x0", "y0", "x1", "y1")))


def upper_median(x: Column) -> Column:
    """The element at n // 2 of the sorted values (neither the mean of the middles nor the lower one)."""
    values = F.sort_array(F.collect_list(x))
    return F.get(values, F.floor(F.size(values) / 2).cast("int"))
