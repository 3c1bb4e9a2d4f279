"""Numeric expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparksignal.functions.text import col_


def clamp(x: str | Column, lo: float = 0.0, hi: float = 1.0) -> Column:
    """``max(lo, min(hi, x))``."""
    return F.greatest(F.lit(lo), F.least(F.lit(hi), col_(x)))


def sigmoid(x: str | Column) -> Column:
    """Logistic ``1 / (1 + exp(-x))``."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col_(x)))


def weighted_sum(terms: Sequence[tuple[float, str | Column]]) -> Column:
    """``sum(w_i * x_i)`` in the given order."""
    out = None
    for w, x in terms:
        t = F.lit(w) * col_(x)
        out = t if out is None else out + t
    return out


def band_months(p: str | Column, bands: Sequence[tuple[float, int]], otherwise: int) -> Column:
    """Months ahead chosen by the first band whose inclusive floor ``p`` reaches."""
    v = col_(p)
    expr = None
    for floor, months in bands:
        expr = (F.when(v >= floor, F.lit(months)) if expr is None
                else expr.when(v >= floor, F.lit(months)))
    return expr.otherwise(F.lit(otherwise))


def month_label(as_of: str | Column, months: str | Column, snap_quarter: bool = False) -> Column:
    """``"Month YYYY"`` of ``as_of + months`` (F17), optionally snapped to the quarter start."""
    d = F.add_months(col_(as_of), col_(months))
    if snap_quarter:
        d = F.trunc(d, "quarter")
    return F.date_format(d, "MMMM yyyy")
