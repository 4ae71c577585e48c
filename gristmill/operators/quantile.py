"""Exact quantiles (linear interpolation, as numpy/pandas/`percentile`) per group,
in bounded memory per task, by one method at every size.

``percentile`` keeps a value -> count map per group, and a hot group holding a
third of 100 TB would put all its distinct values into one task.  Instead:

1. values get a range bucket (boundaries from a fixed-size sketch, drawn once);
2. rows are counted per (group, bucket, value), which combines map-side and
   spreads a hot group, and equal values collapse to one row;
3. counts per (group, bucket) tell in which buckets the wanted ranks lie; only
   those buckets' distinct values are put in order, inside the bucket, and the
   values at the ranks are interpolated.

The result is exact whatever the boundaries are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..core import col_of
from .ranges import attach_offsets, bucket_of, default_buckets, offsets


def group_quantiles(df: DataFrame, value, probs: Sequence[float], by: Sequence[str] = (),
                    names: Sequence[str] | None = None, buckets: int | None = None) -> DataFrame:
    """Return ``by`` columns, ``n`` (non-null count) and one column per prob.

    ``buckets`` only sets how the work is dealt out, never the result."""
    by = list(by)
    probs = [float(p) for p in probs]
    names = list(names) if names else [f"q{i}" for i in range(len(probs))]
    base = df.select(*[F.col(b) for b in by], col_of(value).cast("double").alias("__v")).where(F.col("__v").isNotNull())
    n_buckets = buckets or default_buckets(df)
    bounds = []
    if n_buckets > 1:  # a sketch of fixed size, whatever the input
        shares = [i / n_buckets for i in range(1, n_buckets)]
        sketch = base.agg(F.percentile_approx("__v", shares, 10 * n_buckets).alias("s")).first()["s"]
        bounds = sorted(set(sketch or []))
    counts = (base.withColumn("__b", bucket_of(F.col("__v"), bounds, "double"))
              .groupBy(*by, "__b", "__v").agg(F.count(F.lit(1)).alias("__c")))
    return quantiles_of_counts(counts, probs, by, names)


def quantiles_of_counts(counts: DataFrame, probs: Sequence[float], by: Sequence[str] = (),
                        names: Sequence[str] | None = None) -> DataFrame:
    """:func:`group_quantiles` of values that are counted already: rows (``by``, bucket ``__b``,
    value ``__v``) with the count ``__c``; a value may have several rows, and buckets are monotone
    in the value."""
    by = list(by)
    names = list(names) if names else [f"q{i}" for i in range(len(probs))]
    table = offsets(counts, by, "__b", {"__k": F.sum("__c")})
    table = table.withColumn("__upto", F.lead("__k_before").over(_by(table).orderBy("__at")))
    table = table.withColumn("__upto", F.coalesce("__upto", "__k_all"))
    _, lo, hi = _positions(probs)
    wanted = F.lit(False)
    for rank in lo + hi:
        wanted = wanted | ((F.col("__k_before") <= rank) & (rank < F.col("__upto")))
    return values_at(attach_offsets(counts, table.where(wanted), by, "__b"), by, probs, names)


def _positions(probs: Sequence[float]):
    at = [F.lit(p) * (F.col("__k_all") - 1) for p in probs]  # from 0
    return at, [F.floor(a) for a in at], [F.ceil(a) for a in at]


def values_at(placed: DataFrame, by: Sequence[str], probs: Sequence[float], names: Sequence[str]) -> DataFrame:
    """Quantiles from the counted values of the buckets that hold the wanted ranks; ``__k_before``
    values lie in front of a row's bucket and ``__k_all`` in its group."""
    at, lo, hi = _positions(probs)
    w = Window.partitionBy(*by, "__b").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    last = F.col("__k_before") + F.sum("__c").over(w)
    placed = placed.withColumns({"__last": last}).withColumn("__first", F.col("__last") - F.col("__c"))

    def value_at(rank):
        return F.max(F.when((F.col("__first") <= rank) & (rank < F.col("__last")), F.col("__v")))

    got = placed.groupBy(*by, "__k_all").agg(*[x for i in range(len(probs)) for x in (
        value_at(lo[i]).alias(f"__l{i}"), value_at(hi[i]).alias(f"__h{i}"))])
    out = [F.col(b) for b in by] + [F.col("__k_all").alias("n")]
    for i, name in enumerate(names):
        low, high = F.col(f"__l{i}"), F.col(f"__h{i}")
        between = (hi[i] - at[i]) * low + (at[i] - lo[i]) * high
        out.append(F.when(low == high, low).otherwise(between).alias(name))
    return got.select(*out)


def _by(table: DataFrame):
    names = [c for c in table.columns if c.startswith("__by")]
    return Window.partitionBy(*names) if names else Window.partitionBy(F.lit(0))


def global_quantiles(df: DataFrame, value, probs: Sequence[float], **kw) -> list[float | None]:
    """Exact global quantiles as Python floats (a bounded, one-row result)."""
    row = group_quantiles(df, value, probs, by=(), **kw).collect()
    if not row:
        return [None] * len(probs)
    return [row[0][f"q{i}"] for i in range(len(probs))]
