"""Group statistics (A1-A12) and their "broadcast to rows" form.

A pandas ``groupby().transform()`` becomes *aggregate, then join back*: the
aggregation combines map-side, so a hot key never lands whole in one task,
and the statistics table (one row per key) is joined by broadcast when its
size is proven small, else by a shuffle join that AQE can split for skew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..core import Estimator, Model, StatsTable, col_of, materialize
from .quantile import group_quantiles
from .ranges import attach_offsets, offsets, with_bucket


def _agg_expr(stat: str, value: Column) -> Column:
    if stat == "mean":
        return F.avg(value)
    if stat == "sum":
        return F.sum(value)
    if stat == "min":
        return F.min(value)
    if stat == "max":
        return F.max(value)
    if stat == "count":
        return F.count(value)
    if stat == "rate":  # share of target == 1 among non-null targets
        return F.avg(F.when(value.isNotNull(), (value == 1).cast("double")))
    if stat == "std":
        return F.stddev_samp(value)
    if stat == "std_pop":
        return F.stddev_pop(value)
    raise ValueError(f"unknown statistic {stat!r}")


def group_stat_table(df: DataFrame, by: Sequence[str], value, stat: str, name: str,
                     where: Column | None = None) -> DataFrame:
    """One row per group with the statistic of ``value`` (nulls skipped)."""
    by = list(by)
    src = df if where is None else df.where(where)
    v = col_of(value)
    if stat == "median":
        return group_quantiles(src, v, [0.5], by=by, names=[name]).drop("n")
    if stat == "mode":
        return group_mode_table(src, by, v, name)
    return src.groupBy(*by).agg(_agg_expr(stat, v).alias(name))


def group_mode_table(df: DataFrame, by: Sequence[str], value, name: str) -> DataFrame:
    """Most frequent non-null value per group, ties -> smallest value.

    Two partial aggregations instead of ``mode()`` (whose value->count map for
    a hot group would sit in one task): counts per (group, value), then the
    value with the smallest (-count, value) per group.
    """
    by = list(by)
    counts = (df.select(*by, col_of(value).alias("__val")).where(F.col("__val").isNotNull())
                .groupBy(*by, "__val").agg(F.count(F.lit(1)).alias("__cnt")))
    # the most frequent value, ties to the smallest: one more partial aggregation
    best = F.min_by("__val", F.struct((-F.col("__cnt")).alias("c"), "__val"))
    return counts.groupBy(*by).agg(best.alias(name))


class GroupStat(Estimator):
    """Fit a per-group statistic; the model attaches it to rows as ``name``.

    ``where`` restricts the rows the statistic is fitted on (e.g. known target,
    train part); the transform applies to every row (missing key -> NULL).
    """

    def __init__(self, by: Sequence[str], value, stat: str, name: str, where: Column | None = None):
        self.by, self.value, self.stat, self.name, self.where = list(by), value, stat, name, where

    def fit(self, df: DataFrame) -> "GroupStatModel":
        table = group_stat_table(df, self.by, self.value, self.stat, self.name, self.where)
        if not self.by:
            row = table.collect()
            return GroupStatModel(self.by, self.name, None, scalar=row[0][self.name] if row else None)
        return GroupStatModel(self.by, self.name, materialize(table))


class GroupStatModel(Model):
    def __init__(self, by, name, stats: StatsTable | None, scalar=None):
        self.by, self.name, self.stats, self.scalar = by, name, stats, scalar

    def transform(self, df: DataFrame) -> DataFrame:
        if self.stats is None:
            return df.withColumn(self.name, F.lit(self.scalar))
        return self.stats.attach(df, self.by, "left")


ALGEBRAIC = ("mean", "sum", "min", "max", "count", "rate")


def attach_group_stats(df: DataFrame, keys: Sequence[str], value, stat: str, names: Sequence[str],
                       where: Column | None = None, fit_on: DataFrame | None = None) -> DataFrame:
    """One statistic of ``value`` by each of several single keys (A3, A4): one
    scan computes all of them as GROUPING SETS; the small result is split per
    key and each part is attached by a size-checked broadcast join."""
    keys, names = list(keys), list(names)
    if stat not in ALGEBRAIC:
        for k, n in zip(keys, names):
            df = attach_group_stat(df, [k], value, stat, n, where, fit_on)
        return df
    src = df if fit_on is None else fit_on
    src = src if where is None else src.where(where)
    table = (src.groupingSets([[k] for k in keys], *keys)
                .agg(_agg_expr(stat, col_of(value)).alias("__v"), F.grouping_id().alias("__gid")))
    stats = materialize(table)
    out = df
    for i, (k, n) in enumerate(zip(keys, names)):
        # grouping_id has a 1 bit for every key not grouped in the set
        gid = sum(1 << (len(keys) - 1 - j) for j in range(len(keys)) if j != i)
        part = stats.df.where(F.col("__gid") == gid).select(k, F.col("__v").alias(n))
        out = StatsTable(part, stats.small).attach(out, [k], "left")
    return out


def attach_stats(df: DataFrame, specs: Sequence[tuple], fit_on: DataFrame | None = None) -> DataFrame:
    """Several algebraic statistics, each by its own single key and with its own
    row filter, in ONE scan: ``specs`` holds ``(key, value, stat, name, where)``.
    Filters become conditional aggregates, keys become GROUPING SETS, and each
    statistic is attached by a size-checked join."""
    keys: list[str] = []
    for k, *_ in specs:
        if k not in keys:
            keys.append(k)
    aggs = []
    for i, (k, v, stat, name, where) in enumerate(specs):
        if stat not in ALGEBRAIC:
            raise ValueError(f"{stat} is not algebraic; use attach_group_stat")
        val = col_of(v) if where is None else F.when(where, col_of(v))
        aggs.append(_agg_expr(stat, val).alias(f"__s{i}"))
    src = df if fit_on is None else fit_on
    stats = materialize(src.groupingSets([[k] for k in keys], *keys)
                           .agg(*aggs, F.grouping_id().alias("__gid")))
    out = df
    for i, (k, _v, _stat, name, _where) in enumerate(specs):
        j = keys.index(k)
        gid = sum(1 << (len(keys) - 1 - m) for m in range(len(keys)) if m != j)
        part = stats.df.where(F.col("__gid") == gid).select(k, F.col(f"__s{i}").alias(name))
        out = StatsTable(part, stats.small).attach(out, [k], "left")
    return out


def attach_group_stat(df: DataFrame, by, value, stat: str, name: str,
                      where: Column | None = None, fit_on: DataFrame | None = None) -> DataFrame:
    """Fit on ``fit_on`` (default ``df``) and attach."""
    return GroupStat(by, value, stat, name, where).fit(df if fit_on is None else fit_on).transform(df)


def global_stat(df: DataFrame, value, stat: str, where: Column | None = None):
    """A global statistic as a Python scalar."""
    return GroupStat([], value, stat, "__g", where).fit(df).scalar


# ---- ordering within groups (W3, W4, E1, V3) ------------------------------------------

def ordinal_index(df: DataFrame, order: Sequence[str], by: Sequence[str] = (),
                  name: str = "__idx", with_count: bool = False) -> DataFrame:
    """0-based position of each row in ``order`` within its ``by`` group (null
    groups are groups of their own).

    Skew-safe: rows get a range bucket of the first order column, counts per
    (group, bucket) give offsets, and ``row_number`` runs inside a bucket, so a
    hot group is spread over all buckets.  ``order`` (with ``by``) must be
    unique.  ``with_count`` adds the size of the group as ``{name}_n``.
    """
    by, order = list(by), list(order)
    s = with_bucket(df, order[0], "__bucket")
    table = offsets(s, by, "__bucket", {"__c": F.count(F.lit(1))})
    w = Window.partitionBy(*by, "__bucket").orderBy(*order)
    out = attach_offsets(s, table, by, "__bucket").withColumn(name, F.col("__c_before") + F.row_number().over(w) - 1)
    if with_count:
        out = out.withColumn(f"{name}_n", F.col("__c_all"))
    return out.drop("__bucket", "__c_before", "__c_all")


def dense_rank_in_group(df: DataFrame, by: Sequence[str], order: str, name: str) -> DataFrame:
    """Dense rank (1-based) of ``order`` within ``by`` (W4): rank the distinct
    (group, value) pairs with :func:`ordinal_index`, then join back."""
    pairs = df.select(*by, order).where(F.col(order).isNotNull()).distinct()
    ranked = ordinal_index(pairs, [order], by, "__r").withColumn(name, F.col("__r") + 1).drop("__r")
    return df.join(ranked, [*by, order], "left")


def days_since_first(df: DataFrame, by: Sequence[str], date_col: str, name: str) -> DataFrame:
    """Days between each row's date and its group's first date."""
    first = GroupStat(by, date_col, "min", "__first").fit(df)
    return first.transform(df).withColumn(
        name, F.datediff(F.to_date(F.col(date_col)), F.to_date(F.col("__first")))).drop("__first")


def running_totals(df: DataFrame, order: Sequence[str], sums: Sequence[str],
                   prefix: str = "cum_", inclusive: bool = True) -> DataFrame:
    """Global running sums of ``sums`` along ``order`` (unique), skew-safe: sums
    per range bucket give offsets, a window inside each bucket adds the rest."""
    order, sums = list(order), list(sums)
    s = with_bucket(df, order[0], "__bucket")
    value = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in sums}
    table = offsets(s, [], "__bucket", {f"__t{i}": F.sum(value[c]) for i, c in enumerate(sums)})
    w = Window.partitionBy("__bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = attach_offsets(s, table, [], "__bucket")
    for i, c in enumerate(sums):
        total = F.col(f"__t{i}_before") + F.sum(value[c]).over(w)
        out = out.withColumn(prefix + c, total if inclusive else total - value[c])
    return out.drop("__bucket", *[f"__t{i}_{k}" for i in range(len(sums)) for k in ("before", "all")])
