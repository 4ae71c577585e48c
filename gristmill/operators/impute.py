"""Imputation.

Fill values are statistics fitted by distributed aggregation; filling is a
``coalesce`` against a literal (global statistics) or against a joined
statistics table (group statistics).  Cascades fit the second statistic on
the output of the first stage, exactly as the sequential pandas code does.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..core import Estimator, Model, col_of, materialize, scalar_row
from ..functions.columns import numeric_columns
from ..sources.io import spread
from .groupstats import GroupStat, global_stat
from .quantile import group_quantiles
from .valuecounts import ValueCounts

#: Rows that one task of a forest's fit holds, at most, once there are more of them.
FOREST_ROWS = 50_000


def fill_constant(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Constant fill per column."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


class GlobalImputer(Estimator):
    """Fill with a global statistic per column: mean, median (exact) or mode
    (ties -> smallest) (I2, I3, I13).  ``where`` selects the fitting rows."""

    def __init__(self, columns: Sequence[str] | None, strategy: str = "median",
                 where: Column | None = None, exclude: Sequence[str] = ()):
        self.columns, self.strategy, self.where, self.exclude = columns, strategy, where, exclude

    def fit(self, df: DataFrame) -> "ConstantFillModel":
        cols = list(self.columns) if self.columns else numeric_columns(df, self.exclude)
        src = df if self.where is None else df.where(self.where)
        if self.strategy == "mean":
            vals = scalar_row(src.agg(*[F.avg(c).alias(c) for c in cols]))
        elif self.strategy == "median":
            vals = _global_medians(src, cols)
        elif self.strategy == "mode":
            texts = [f.name for f in src.schema.fields if f.name in cols and isinstance(f.dataType, T.StringType)]
            vals = {c: global_stat(src, c, "mode") for c in cols if c not in texts}
            if texts:  # one job for all text columns
                vals |= {r["column"]: r["mode"] for r in ValueCounts.fit(src, texts=texts).modes().collect()}
        else:
            raise ValueError(self.strategy)
        return ConstantFillModel({c: v for c, v in vals.items() if v is not None})


def _global_medians(df, cols):
    """Exact medians of many columns in one pass: unpivot to (column, value) and
    take a per-column quantile; one result row per column reaches the driver."""
    if not cols:
        return {}
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    long = df.selectExpr(f"stack({len(cols)}, {pairs}) AS (__col, __val)")
    rows = group_quantiles(long, "__val", [0.5], by=["__col"]).collect()
    return {r["__col"]: r["q0"] for r in rows}


class ConstantFillModel(Model):
    def __init__(self, values: Mapping[str, object]):
        self.values = dict(values)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in self.values.items()})


class GroupImputer(Estimator):
    """Fill ``column`` with its own group's statistic (I5, W5, I8); rows whose
    group has no statistic keep NULL unless ``fallback`` is set."""

    def __init__(self, column: str, by: Sequence[str], stat: str = "median",
                 where: Column | None = None, fallback=None, cast: str | None = None):
        self.column, self.by, self.stat, self.where = column, list(by), stat, where
        self.fallback, self.cast = fallback, cast

    def fit(self, df: DataFrame) -> "GroupFillModel":
        m = GroupStat(self.by, self.column, self.stat, "__fill", self.where).fit(df)
        return GroupFillModel(self.column, m, self.fallback, self.cast)


class GroupFillModel(Model):
    def __init__(self, column, stat_model, fallback, cast):
        self.column, self.stat_model, self.fallback, self.cast = column, stat_model, fallback, cast

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.stat_model.transform(df)
        fill = F.col("__fill") if self.cast is None else F.col("__fill").cast(self.cast)
        parts = [F.col(self.column), fill]
        if self.fallback is not None:
            parts.append(F.lit(self.fallback))
        return out.withColumn(self.column, F.coalesce(*parts)).drop("__fill")


def fill_groups(df: DataFrame, columns: Sequence[str], by: Sequence[str], stat: str = "median") -> DataFrame:
    """Fill several numeric columns with their group's median, mean or mode (I5, I8): one
    value-count table for all of them, and one join."""
    columns, by = list(columns), list(by)
    counts = ValueCounts.fit(df, numbers=columns, by=by)
    long = {"median": lambda: counts.quantiles([0.5], ["x"]), "mean": lambda: counts.means().withColumnRenamed("mean", "x"),
            "mode": lambda: counts.modes().withColumnRenamed("mode", "x")}[stat]()
    names = {c: f"__fill{i}" for i, c in enumerate(columns)}
    table = long.groupBy(*by).agg(*[F.max(F.when(F.col("column") == c, F.col("x"))).alias(n) for c, n in names.items()])
    out = materialize(table).attach(df, by, "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.col(n)) for c, n in names.items()}).drop(*names.values())


def impute_cascade(df: DataFrame, column: str, stages: Sequence[tuple], fit_on=None) -> DataFrame:
    """Run fills in order; each stage is ``(by, stat)`` or ``(by, stat, cast)``
    and is fitted on the previous stage's output (I4, I6).  An empty ``by``
    is a global statistic."""
    out = df
    for st in stages:
        by, stat = st[0], st[1]
        cast = st[2] if len(st) > 2 else None
        out = GroupImputer(column, by, stat, cast=cast).fit(out).transform(out)
    return out


def fill_from_column(c, other, valid: Column | None = None) -> Column:
    """``c`` where valid (default: non-null), else ``other``."""
    c = col_of(c)
    cond = c.isNotNull() if valid is None else valid
    return F.when(cond, c).otherwise(col_of(other))


def impute_category_mean_rounded(df: DataFrame, column: str, by: str, half_up_levels: Sequence,
                                 default: float, where: Column | None = None) -> DataFrame:
    """Per-category mean, floored, +0.5 for the listed categories, fallback
    ``default`` for categories without a mean (I7)."""
    stat = GroupStat([by], column, "mean", "__m", where).fit(df)
    out = stat.transform(df)
    rounded = F.floor(F.col("__m")) + F.when(F.col(by).isin(list(half_up_levels)), F.lit(0.5)).otherwise(F.lit(0.0))
    return out.withColumn(column, F.coalesce(F.col(column), rounded, F.lit(float(default)))).drop("__m")


def flag_from_threshold(df: DataFrame, flag_col: str, measure: str, where: Column | None = None) -> DataFrame:
    """Fill a NULL 0/1 flag with ``measure >= global mean``."""
    mean = global_stat(df, measure, "mean", where)
    return df.withColumn(flag_col, F.coalesce(F.col(flag_col),
                                              (F.col(measure) >= F.lit(mean)).cast("int")))


class ModelImputer(Estimator):
    """Predict missing values of ``target`` from other columns with a random
    forest trained on the rows where it is known (I12); rounds half-even."""

    def __init__(self, target: str, categorical: Sequence[str], numeric: Sequence[str],
                 num_trees: int = 100, seed: int = 0, round_result: bool = True):
        self.target, self.categorical, self.numeric = target, list(categorical), list(numeric)
        self.num_trees, self.seed, self.round_result = num_trees, seed, round_result

    def fit(self, df: DataFrame):
        from pyspark.ml import Pipeline
        from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
        from pyspark.ml.regression import RandomForestRegressor
        idx = [f"__i_{c}" for c in self.categorical]
        ohe = [f"__o_{c}" for c in self.categorical]
        stages = []
        if self.categorical:
            stages += [StringIndexer(inputCols=self.categorical, outputCols=idx, handleInvalid="keep"),
                       OneHotEncoder(inputCols=idx, outputCols=ohe, dropLast=True, handleInvalid="error")]
        stages += [VectorAssembler(inputCols=ohe + self.numeric, outputCol="__feat", handleInvalid="keep"),
                   RandomForestRegressor(featuresCol="__feat", labelCol="__label", predictionCol="__pred",
                                         numTrees=self.num_trees, seed=self.seed)]
        train = df.where(F.col(self.target).isNotNull()).withColumn("__label", F.col(self.target).cast("double"))
        # the forest keeps its rows, with a weight per tree, in the tasks they come in, and reads them once a level
        train = train.select("__label", *dict.fromkeys(self.categorical + self.numeric))
        rows = train.count()
        if rows > FOREST_ROWS:
            train = spread(train, max(-(-rows // FOREST_ROWS), df.sparkSession.sparkContext.defaultParallelism))
        return _ModelFill(Pipeline(stages=stages).fit(train), self.target, self.round_result)


class _ModelFill(Model):
    def __init__(self, pipe, target, round_result):
        self.pipe, self.target, self.round_result = pipe, target, round_result

    def transform(self, df: DataFrame) -> DataFrame:
        scored = self.pipe.transform(df)
        pred = F.bround(F.col("__pred"), 0) if self.round_result else F.col("__pred")
        keep = [c for c in df.columns]
        return scored.withColumn(self.target, F.coalesce(F.col(self.target).cast("double"), pred)).select(*keep)
