"""Binning (B1-B7): right-closed cuts and threshold ladders as ``when`` chains.

``Bucketizer`` is left-closed, so ``pd.cut``-style right-closed intervals are
generated as a ``CASE`` chain; it has no shuffle and stays in codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..core import col_of


def cut_right(c, edges: Sequence[float], labels: Sequence | None = None,
              include_lowest: bool = False) -> Column:
    """``pd.cut``: intervals (e0,e1], (e1,e2], ...; outside -> NULL (B1).

    ``labels`` default to integer codes 0..k-1.  ``include_lowest`` closes the
    first interval on the left (as ``pd.qcut`` does).
    """
    if list(edges) != sorted(edges) or len(set(edges)) != len(edges):
        raise ValueError(f"bin edges must be strictly increasing: {list(edges)}")
    x = col_of(c)
    labels = list(labels) if labels is not None else list(range(len(edges) - 1))
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per interval")
    expr = None
    for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
        low_ok = (x >= F.lit(lo)) if (i == 0 and include_lowest) else (x > F.lit(lo))
        cond = low_ok & (x <= F.lit(hi))
        expr = F.when(cond, F.lit(labels[i])) if expr is None else expr.when(cond, F.lit(labels[i]))
    return expr


def ladder(c, thresholds: Sequence[float], values: Sequence, default, closed: str = "right") -> Column:
    """Threshold ladder: first ``x <= t_i`` (closed='right') or ``x < t_i``
    (closed='left') picks ``values[i]``; otherwise ``default`` (B3-B6)."""
    if len(thresholds) != len(values):
        raise ValueError("need one value per threshold")
    x = col_of(c)
    expr = None
    for t, v in zip(thresholds, values):
        cond = (x <= F.lit(t)) if closed == "right" else (x < F.lit(t))
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return expr.otherwise(F.lit(default))


def band(c, bands: Sequence[tuple[float, float, object]], default, closed: str = "right") -> Column:
    """Explicit bands (lo, hi, value): ``lo < x <= hi`` (right) or ``lo <= x < hi``
    (left); first match wins, else ``default``."""
    x = col_of(c)
    expr = None
    for lo, hi, v in bands:
        if closed == "right":
            cond = (x > F.lit(lo)) & (x <= F.lit(hi))
        else:
            cond = (x >= F.lit(lo)) & (x < F.lit(hi))
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return expr.otherwise(F.lit(default))


def round_cap(c, divisor: float, cap: float) -> Column:
    """``min(round_half_even(x / divisor), cap)``."""
    return F.least(F.bround(col_of(c) / F.lit(float(divisor)), 0), F.lit(float(cap)))
