"""Column functions on boxes (x0, y0, x1, y1) as arrays of doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def area(b: Column) -> Column:
    return F.greatest(b[2] - b[0], F.lit(0.0)) * F.greatest(b[3] - b[1], F.lit(0.0))


def intersection(a: Column, b: Column) -> Column:
    w = F.least(a[2], b[2]) - F.greatest(a[0], b[0])
    h = F.least(a[3], b[3]) - F.greatest(a[1], b[1])
    return F.greatest(w, F.lit(0.0)) * F.greatest(h, F.lit(0.0))


def iou(a: Column, b: Column) -> Column:
    n = intersection(a, b)
    u = area(a) + area(b) - n
    return F.when(u > 0, n / u).otherwise(0.0)


def contained(a: Column, b: Column) -> Column:
    """Share of a's area inside b."""
    return F.when(area(a) > 0, intersection(a, b) / area(a)).otherwise(0.0)


def valid(b: Column) -> Column:
    return b.isNotNull() & (F.size(b) == 4) & (b[2] > b[0]) & (b[3] > b[1])
