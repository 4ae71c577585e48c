"""Row-local Column expressions: remaps, flags, arithmetic, row statistics, math.

Everything here returns a ``Column`` built from Spark built-ins, so it stays
inside whole-stage codegen and needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..core import col_of

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


# ---- column typing (P2, P3, P4) -------------------------------------------------

def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in exclude]


def categorical_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.StringType, T.BooleanType)) and f.name not in exclude]


def cast_numeric(df: DataFrame, fill: float | None = None, exclude: Sequence[str] = ()) -> DataFrame:
    """Every numeric column to double, optionally null -> ``fill`` first."""
    cols = numeric_columns(df, exclude)
    def conv(c):
        x = F.col(c).cast("double")
        return F.coalesce(x, F.lit(float(fill))) if fill is not None else x
    return df.withColumns({c: conv(c) for c in cols})


def to_number(c) -> Column:
    """Tolerant numeric parse: unparseable text becomes NULL."""
    return F.trim(col_of(c).cast("string")).try_cast("double")


# ---- remaps (P8-P12) ---------------------------------------------------------------

def remap(c, mapping: Mapping, keep_unmatched: bool = True) -> Column:
    """Value remap.  ``keep_unmatched=True`` is ``Series.replace``; False is
    ``Series.map(dict)`` (unmatched -> NULL)."""
    c = col_of(c)
    expr = None
    for k, v in mapping.items():
        cond = c.isNull() if k is None else (c == F.lit(k))
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    if expr is None:
        return c if keep_unmatched else F.lit(None)
    return expr.otherwise(c) if keep_unmatched else expr


def categorise_by_substring(c, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """First rule whose substring occurs wins, else ``default``."""
    c = col_of(c)
    expr = None
    for sub, label in rules:
        cond = c.contains(sub)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


def flag(pred: Column) -> Column:
    """0/1 int from a predicate; NULL predicate counts as 0."""
    return F.coalesce(pred.cast("int"), F.lit(0))


def any_positive(cols: Sequence) -> Column:
    """Any column non-null and > 0."""
    return reduce(lambda a, b: a | b, [F.coalesce(col_of(c), F.lit(0)) > 0 for c in cols])


def count_positive(cols: Sequence) -> Column:
    """Number of columns > 0 in the row (P15); NULL counts as not positive."""
    return reduce(lambda a, b: a + b, [flag(col_of(c) > 0) for c in cols])


def bitpack(flags: Sequence) -> Column:
    """Sum of flag_k * 2^k."""
    return reduce(lambda a, b: a + b,
                  [col_of(f).cast("long") * F.lit(1 << k) for k, f in enumerate(flags)])


def rule_flag_with_fallback(measure, threshold, fallback: Column) -> Column:
    """``measure >= threshold`` when the measure is known, else the fallback rule (P20)."""
    m = col_of(measure)
    return F.when(m.isNotNull(), (m >= threshold).cast("int")).otherwise(fallback.cast("int"))


def guarded_ratio(n, d, eps: float | None = None) -> Column:
    """n / d; with ``eps`` the denominator is d + eps (pandas style), otherwise a
    zero denominator gives NULL instead of an ANSI error."""
    if eps is not None:
        return F.try_divide(col_of(n), col_of(d) + F.lit(eps))
    return F.try_divide(col_of(n), col_of(d))


# ---- row-wise (horizontal) statistics, skipping nulls (A10) --------------------------

def _arr(cols) -> Column:
    """Non-null values of a column family (list of columns) or of an array column."""
    if isinstance(cols, (str, Column)):
        arr = F.transform(col_of(cols), lambda x: x.cast("double"))
    else:
        arr = F.array(*[col_of(c).cast("double") for c in cols])
    return F.filter(arr, lambda x: x.isNotNull())


def row_sum(cols) -> Column:
    return F.aggregate(_arr(cols), F.lit(0.0), lambda acc, x: acc + x)


def row_count(cols) -> Column:
    return F.size(_arr(cols))


def row_mean(cols) -> Column:
    n = row_count(cols)
    return F.when(n > 0, row_sum(cols) / n)


def row_std(cols) -> Column:
    """Sample standard deviation (ddof=1) across columns, nulls skipped.

    One pass of Welford's update over the row's values (count, mean, sum of
    squared deviations), numerically stable and linear in the row width."""
    init = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("m"), F.lit(0.0).alias("q"))

    def step(acc, x):
        n1 = acc["n"] + 1
        m1 = acc["m"] + (x - acc["m"]) / n1
        return F.struct(n1.alias("n"), m1.alias("m"), (acc["q"] + (x - acc["m"]) * (x - m1)).alias("q"))

    return F.aggregate(_arr(cols), init, step, lambda acc: F.when(acc["n"] > 1, F.sqrt(acc["q"] / (acc["n"] - 1))))


def row_min(cols) -> Column:
    if isinstance(cols, (str, Column)):
        return F.array_min(_arr(cols))
    return F.least(*[col_of(c).cast("double") for c in cols])


def row_max(cols) -> Column:
    if isinstance(cols, (str, Column)):
        return F.array_max(_arr(cols))
    return F.greatest(*[col_of(c).cast("double") for c in cols])


def row_range(cols) -> Column:
    return row_max(cols) - row_min(cols)


# ---- math (N1-N5) -------------------------------------------------------------------

def log1p(c) -> Column:
    """log(1+x); NULL for x <= -1 (numpy gives -inf/NaN)."""
    c = col_of(c)
    return F.when(c > -1, F.log1p(c))


def ln(c) -> Column:
    c = col_of(c)
    return F.when(c > 0, F.log(c))


def round_half_even(c, places: int = 0) -> Column:
    return F.bround(col_of(c), places)


def floor_at(c, bound) -> Column:
    """max(x, bound)."""
    return F.greatest(col_of(c), F.lit(bound))


def clip(c, lower=None, upper=None) -> Column:
    c = col_of(c)
    if lower is not None:
        c = F.greatest(c, F.lit(lower))
    if upper is not None:
        c = F.least(c, F.lit(upper))
    return c


def substitute_below(c, bound, value) -> Column:
    """``x if x >= bound else value``."""
    c = col_of(c)
    return F.when(c >= bound, c).otherwise(F.lit(value))
