"""One table of value counts that answers many statistics of many columns.

Cascaded fills ask for medians, modes, means and distinct counts of many columns, and each
statistic would be a job over all rows.  Here the rows are read once: equal values of a
(column, group) collapse map-side to one row (column, group, bucket, value, n), the table is
written, and every statistic is a small job over it.  Buckets are monotone in the value
(boundaries from one fixed-size sketch of all columns), so exact quantiles order one bucket at a time
and a hot group is spread over all buckets.

NULLs (and NaN, for numbers) are counted too, as one row per (column, group): a fill moves them to
the fill value (:meth:`filled`), and the statistics after the fill need no second scan.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..core import StatsTable, cut_lineage
from .quantile import quantiles_of_counts, values_at
from .ranges import bucket_of, default_buckets


#: Bucket totals (column, group, bucket) that may be looked at on the driver; beyond it the ranks
#: are found by a distributed plan.
DRIVER_CELLS = 100_000


class ValueCounts:
    """``table``: (column, ``by`` columns, b, v, s, n); v is a number's value, s a text's, both
    NULL for missing values."""

    def __init__(self, table: DataFrame, by: Sequence[str], bounds: dict[str, list[float]], texts: Sequence[str] = ()):
        self.table, self.by, self.bounds, self.texts = table, list(by), bounds, list(texts)

    @classmethod
    def fit(cls, df: DataFrame, numbers: Sequence[str] = (), texts: Sequence[str] = (), by: Sequence[str] = ()) -> "ValueCounts":
        number = {c: F.when(~F.isnan(F.col(f"`{c}`").cast("double")), F.col(f"`{c}`").cast("double")) for c in numbers}
        bounds: dict[str, list[float]] = {c: [] for c in numbers}
        n_buckets = default_buckets(df)
        if n_buckets > 1 and numbers:
            shares = [i / n_buckets for i in range(1, n_buckets)]
            sketch = df.agg(*[F.percentile_approx(x, shares, 10 * n_buckets).alias(f"s{i}") for i, x in enumerate(number.values())]).first()
            bounds = {c: sorted(set(sketch[f"s{i}"] or [])) for i, c in enumerate(numbers)}
        none_v, none_s = F.lit(None).cast("double"), F.lit(None).cast("string")
        cells = [F.struct(F.lit(c).alias("column"), bucket_of(x, bounds[c], "double").alias("b"), x.alias("v"), none_s.alias("s"))
                 for c, x in number.items()]
        cells += [F.struct(F.lit(c).alias("column"), F.lit(0).alias("b"), none_v.alias("v"), F.col(f"`{c}`").cast("string").alias("s"))
                  for c in texts]
        long = df.select(*by, F.explode(F.array(*cells)).alias("e")).select("e.column", *by, "e.b", "e.v", "e.s")
        counts = long.groupBy("column", *by, "b", "v", "s").agg(F.count(F.lit(1)).alias("n"))
        return cls(cut_lineage(counts), by, bounds, texts)

    def _present(self) -> DataFrame:
        return self.table.where("v is not null or s is not null")

    def quantiles(self, probs: Sequence[float], names: Sequence[str] | None = None, by: Sequence[str] | None = None) -> DataFrame:
        """(column, by, n, one column per prob) of the numbers; ``by`` may be a part of the table's."""
        by = self.by if by is None else list(by)
        counts = self.table.where("v is not null").select("column", *by, F.col("b").alias("__b"), F.col("v").alias("__v"), F.col("n").alias("__c"))
        probs, keys = [float(p) for p in probs], ["column", *by]
        names = list(names) if names else [f"q{i}" for i in range(len(probs))]
        cells = counts.groupBy(*keys, "__b").agg(F.sum("__c").alias("k")).limit(DRIVER_CELLS + 1).collect()
        if len(cells) > DRIVER_CELLS:
            return quantiles_of_counts(counts, probs, keys, names)
        # the few cells that hold the wanted ranks are found here; only their values are put in order
        wanted = []
        groups: dict[tuple, list] = {}
        for c in cells:
            groups.setdefault(tuple(c[:-2]), []).append((c["__b"], c["k"]))
        for group, parts in groups.items():
            total, before = sum(k for _, k in parts), 0
            ranks = {r for p in probs for r in (math.floor(p * (total - 1)), math.ceil(p * (total - 1)))}
            for b, k in sorted(parts):
                if any(before <= r < before + k for r in ranks):
                    wanted.append((*group, b, before, total))
                before += k
        fields = [counts.schema[c] for c in keys]
        at = [T.StructField(f"__k{i}", f.dataType) for i, f in enumerate(fields)]
        at += [T.StructField("__at", T.IntegerType()), T.StructField("__k_before", T.LongType()), T.StructField("__k_all", T.LongType())]
        few = self.table.sparkSession.createDataFrame(wanted, T.StructType(at))
        on = F.col("__b") == F.col("__at")
        for i, c in enumerate(keys):
            on = on & F.col(c).eqNullSafe(F.col(f"__k{i}"))
        placed = counts.join(F.broadcast(few), on).drop("__at", *[f"__k{i}" for i in range(len(keys))])
        return values_at(placed, keys, probs, names)

    def modes(self, by: Sequence[str] | None = None) -> DataFrame:
        """(column, by, mode): the most frequent value, ties to the smallest; a text where the column is one."""
        by = self.by if by is None else list(by)
        totals = self._present().groupBy("column", *by, "v", "s").agg(F.sum("n").alias("n"))
        best = totals.groupBy("column", *by).agg(F.min_by(F.struct("v", "s"), F.struct(-F.col("n"), "v", "s")).alias("m"))
        value = F.col("m.v") if not self.texts else F.coalesce("m.s", F.col("m.v").cast("string"))
        return best.select("column", *by, value.alias("mode"))

    def means(self, by: Sequence[str] | None = None) -> DataFrame:
        """(column, by, mean) of the numbers."""
        by = self.by if by is None else list(by)
        return (self.table.where("v is not null").groupBy("column", *by)
                .agg((F.sum(F.col("v") * F.col("n")) / F.sum("n")).alias("mean")))

    def counts(self, by: Sequence[str] | None = None) -> DataFrame:
        """(column, by, n_values, n_missing, n_distinct)."""
        by = self.by if by is None else list(by)
        present = F.col("v").isNotNull() | F.col("s").isNotNull()
        per = self.table.groupBy("column", *by, "v", "s").agg(F.sum("n").alias("n"))
        return per.groupBy("column", *by).agg(
            F.coalesce(F.sum(F.when(present, F.col("n"))), F.lit(0)).alias("n_values"),
            F.coalesce(F.sum(F.when(~present, F.col("n"))), F.lit(0)).alias("n_missing"),
            F.count(F.when(present, F.lit(1))).alias("n_distinct"))

    def filled(self, fills: StatsTable, name: str) -> "ValueCounts":
        """The counts after the missing numbers of each group took the group's value in ``fills``
        (``by`` columns, ``name``); without a value they stay missing.  For one number column."""
        (column,) = self.bounds
        filled = fills.attach(self.table, self.by).withColumn("v", F.coalesce("v", F.col(name))).drop(name)
        return ValueCounts(filled.withColumn("b", bucket_of(F.col("v"), self.bounds[column], "double")), self.by, self.bounds)
