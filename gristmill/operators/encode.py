"""Encoding and scaling.

One-hot columns need their level list, one name per output column; codes for
unbounded level sets stay in a distributed table joined back.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..core import Estimator, Model, col_of, materialize, scalar_row
from .groupstats import ordinal_index


def level_column(prefix: str, level) -> str:
    """``prefix_level`` with characters outside [0-9A-Za-z] turned into '_'."""
    import re
    return f"{prefix}_{re.sub(r'[^0-9A-Za-z]+', '_', str(level))}"


def levels(df: DataFrame, column: str, where: Column | None = None) -> list:
    """Sorted distinct non-null levels of a categorical column.  They name the
    output's columns, so the schema holds as many; for a high-cardinality column
    use :class:`OneHotVector`."""
    src = df if where is None else df.where(where)
    return [r["v"] for r in src.select(F.col(column).alias("v")).where(F.col("v").isNotNull()).distinct().orderBy("v").collect()]


class Factorizer(Estimator):
    """Codes by first appearance along ``order`` (0, 1, ...), NULL -> -1.

    Distinct levels with their first position are ranked by a skew-safe
    ordinal index, so the level table may be large; it is joined back.
    """

    def __init__(self, column: str, order: str, name: str | None = None):
        self.column, self.order, self.name = column, order, name or column

    def fit(self, df: DataFrame) -> "CodeTableModel":
        first = (df.where(F.col(self.column).isNotNull())
                   .groupBy(self.column).agg(F.min(self.order).alias("__first")))
        codes = ordinal_index(first, ["__first"], (), "__code").select(self.column, "__code")
        return CodeTableModel(self.column, self.name, materialize(codes))


class CategoryCoder(Estimator):
    """Alphabetical codes (pandas ``category`` codes), NULL -> -1."""

    def __init__(self, column: str, name: str | None = None):
        self.column, self.name = column, name or column

    def fit(self, df: DataFrame) -> "CodeTableModel":
        distinct = df.select(self.column).where(F.col(self.column).isNotNull()).distinct()
        codes = ordinal_index(distinct, [self.column], (), "__code")
        return CodeTableModel(self.column, self.name, materialize(codes))


class CodeTableModel(Model):
    def __init__(self, column, name, table):
        self.column, self.name, self.table = column, name, table

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.table.attach(df, [self.column], "left")
        code = F.coalesce(F.col("__code"), F.lit(-1)).cast("long")
        return out.withColumn(self.name, code).drop("__code")


def ordinal(c, ordered_levels: Sequence, start: int = 0) -> Column:
    """Position of the value in a declared level list; unlisted -> NULL."""
    c = col_of(c)
    expr = None
    for i, lvl in enumerate(ordered_levels):
        expr = F.when(c == F.lit(lvl), F.lit(i + start)) if expr is None else expr.when(c == F.lit(lvl), F.lit(i + start))
    return expr


class OneHotTimes(Estimator):
    """Dummy column per level multiplied by a measure, ``prefix_level`` (E5)."""

    def __init__(self, column: str, measure, prefix: str | None = None):
        self.column, self.measure, self.prefix = column, measure, prefix or column

    def fit(self, df: DataFrame) -> "OneHotTimesModel":
        return OneHotTimesModel(self.column, self.measure, self.prefix, levels(df, self.column))


class OneHotTimesModel(Model):
    def __init__(self, column, measure, prefix, lvls):
        self.column, self.measure, self.prefix, self.levels = column, measure, prefix, lvls

    def transform(self, df: DataFrame) -> DataFrame:
        m = col_of(self.measure)
        return df.withColumns({level_column(self.prefix, lvl): F.when(F.col(self.column) == F.lit(lvl), m)
                               .otherwise(F.lit(0))
                               for lvl in self.levels})


class OneHot(Estimator):
    """One-hot columns for levels fitted on ``where`` rows; an unknown level or
    NULL gives all zeros (E6; ``handle_unknown='ignore'``)."""

    def __init__(self, column: str, prefix: str | None = None, where: Column | None = None):
        self.column, self.prefix, self.where = column, prefix or column, where

    def fit(self, df: DataFrame) -> "OneHotModel":
        return OneHotModel(self.column, self.prefix, levels(df, self.column, self.where))


class OneHotModel(Model):
    def __init__(self, column, prefix, lvls):
        self.column, self.prefix, self.levels = column, prefix, lvls

    def transform(self, df: DataFrame) -> DataFrame:
        c = F.col(self.column)
        return df.withColumns({level_column(self.prefix, lvl): F.coalesce((c == F.lit(lvl)).cast("int"), F.lit(0))
                               for lvl in self.levels})


class OneHotVector(Estimator):
    """One-hot as a sparse vector column for any number of levels: codes come
    from the distributed code table (:class:`CategoryCoder`), so no level list
    reaches the driver; an unknown level or NULL gives the zero vector."""

    def __init__(self, column: str, output: str, where: Column | None = None):
        self.column, self.output, self.where = column, output, where

    def fit(self, df: DataFrame) -> "OneHotVectorModel":
        src = df if self.where is None else df.where(self.where)
        size = src.where(F.col(self.column).isNotNull()).agg(F.count_distinct(F.col(self.column)).alias("n")).first()["n"]
        return OneHotVectorModel(CategoryCoder(self.column, "__level").fit(src), size, self.output)


class OneHotVectorModel(Model):
    def __init__(self, codes, size, output):
        self.codes, self.size, self.output = codes, size, output

    def transform(self, df: DataFrame) -> DataFrame:
        from pyspark.ml.feature import OneHotEncoder
        coded = self.codes.transform(df)
        # the encoder drops its last category: the one that stands for unknown levels
        code = F.when(F.col("__level") >= 0, F.col("__level")).otherwise(F.lit(self.size)).cast("double")
        encoder = OneHotEncoder(inputCol="__level", outputCol=self.output, dropLast=True)
        known = df.sparkSession.range(self.size, self.size + 1).select(F.col("id").cast("double").alias("__level"))
        return encoder.fit(known).transform(coded.withColumn("__level", code)).drop("__level")


class Standardizer(Estimator):
    """z-score ``(x - mean) / std`` with sample (ddof=1, E7) or population
    (ddof=0, E8) standard deviation fitted on ``where`` rows."""

    def __init__(self, columns: Sequence[str], ddof: int = 1, where: Column | None = None,
                 suffix: str = ""):
        self.columns, self.ddof, self.where, self.suffix = list(columns), ddof, where, suffix

    def fit(self, df: DataFrame) -> "StandardizerModel":
        src = df if self.where is None else df.where(self.where)
        std = F.stddev_samp if self.ddof == 1 else F.stddev_pop
        aggs = []
        for c in self.columns:
            aggs += [F.avg(c).alias(f"m_{c}"), std(c).alias(f"s_{c}")]
        row = scalar_row(src.agg(*aggs))
        return StandardizerModel({c: (row[f"m_{c}"], row[f"s_{c}"]) for c in self.columns}, self.suffix)


class StandardizerModel(Model):
    def __init__(self, stats, suffix):
        self.stats, self.suffix = stats, suffix

    def transform(self, df: DataFrame) -> DataFrame:
        out = {}
        for c, (m, s) in self.stats.items():
            # sklearn leaves a zero-variance column centred only (scale 1)
            scale = s if s not in (None, 0.0) else 1.0
            out[c + self.suffix] = (F.col(c) - F.lit(m)) / F.lit(scale)
        return df.withColumns(out)


@dataclass
class PcaModel(Model):
    """Principal components: ``components[i]`` is a unit vector, ``variances[i]`` the variance along it."""
    columns: str | Sequence[str]
    mean: list[float]
    components: list[list[float]]
    variances: list[float]
    covariance: np.ndarray
    output: str

    def transform(self, df: DataFrame) -> DataFrame:
        """``output``: the array of projections; NULL where a component of the row is missing."""
        number = lambda v: f"double('{float(v)!r}')"
        lit = lambda row: "array(" + ", ".join(map(number, row)) + ")"
        centred = F.zip_with(vector_of(self.columns), F.expr(lit(self.mean)), lambda x, m: x - m)
        axes = F.expr("array(" + ", ".join(map(lit, self.components)) + ")")
        out = F.transform(axes, lambda a: F.aggregate(F.zip_with(F.col("__centred"), a, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x))
        whole = F.forall("__centred", lambda x: x.isNotNull() & ~F.isnan(x))
        return df.withColumn("__centred", centred).withColumn(self.output, F.when(whole, out)).drop("__centred")


def vector_of(columns: str | Sequence[str]) -> Column:
    """One array of doubles from numeric columns or an array column."""
    if isinstance(columns, str):
        return F.transform(columns, lambda x: x.cast("double"))
    return F.array(*[F.col(f"`{c}`").cast("double") for c in columns])


def fit_pca(df: DataFrame, columns: str | Sequence[str], k: int, output: str = "pca") -> PcaModel:
    """Top ``k`` principal components of the complete rows.

    One pass: every task sums its rows and their outer products around a common shift (the
    mean of a few rows, so nothing cancels), Spark adds the d (d + 3) / 2 sums up, and the driver
    solves the d x d eigenproblem.  A component's largest entry is positive (ties: the first),
    so signs are the same on every run."""
    vectors = df.select(vector_of(columns).alias("v")).where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x)))
    few = np.array([r["v"] for r in vectors.limit(100).collect()], float)
    if not few.size:
        raise ValueError("no complete rows")
    shift = few.mean(axis=0)
    d = len(shift)
    rows, cols = np.triu_indices(d)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, product = np.zeros(d + 1), np.zeros((d, d))
        for batch in batches:
            x = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) - shift
            total[0] += len(x)
            total[1:] += x.sum(axis=0)
            product += x.T @ x
        at = np.concatenate([total, product[rows, cols]])
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(len(at)), pa.int32()), "x": pa.array(at, pa.float64())})
    got = {r["i"]: r["x"] for r in vectors.mapInArrow(sums, "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).collect()}
    n, total = got[0], np.array([got[1 + i] for i in range(d)])
    product = np.zeros((d, d))
    product[rows, cols] = [got[1 + d + i] for i in range(len(rows))]
    product = product + np.triu(product, 1).T
    covariance = (product - np.outer(total, total) / n) / max(n - 1, 1)
    values, axes = np.linalg.eigh(covariance)
    chosen = axes[:, ::-1][:, :k].T
    chosen = chosen * np.sign([[a[np.argmax(np.abs(np.round(a, 12)))]] for a in chosen])
    return PcaModel(columns, (shift + total / n).tolist(), chosen.tolist(), values[::-1][:k].tolist(), covariance, output)


def pca_project(df: DataFrame, columns: str | Sequence[str], k: int, output: str = "pca"):
    """Centre, then project on the top ``k`` principal components (E10): (model, df with ``output``)."""
    model = fit_pca(df, columns, k, output)
    return model, model.transform(df)


# executors need no copy of this package on their import path
cloudpickle.register_pickle_by_value(sys.modules[__name__])
