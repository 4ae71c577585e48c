"""Population z-score of a vector column, and the fill of categories, as pipeline stages."""

from __future__ import annotations

import math

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.feature import ElementwiseProduct, SQLTransformer, StandardScaler
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F


class PopulationScaler(Estimator):
    """``(x - mean) / population std``; a constant component becomes 0.

    Spark's scaler divides by the sample std, so its output is multiplied by
    sqrt(n / (n - 1)).  The fitted model is made of Spark's own stages only and
    can be saved and loaded.
    """

    def __init__(self, input_col: str, output_col: str):
        super().__init__()
        self.input_col, self.output_col = input_col, output_col

    def _fit(self, dataset):
        middle = f"{self.output_col}__sample"
        model = StandardScaler(inputCol=self.input_col, outputCol=middle, withMean=True, withStd=True).fit(dataset)
        n = dataset.count()
        factor = math.sqrt(n / (n - 1)) if n > 1 else 1.0
        size = len(model.mean)
        scale = ElementwiseProduct(scalingVec=Vectors.dense([factor] * size), inputCol=middle, outputCol=self.output_col)
        return PipelineModel(stages=[model, scale])


class CategoryFill(Estimator):
    """NULL categories become the fitted rows' most frequent value (ties: the smallest) or a constant.

    One job counts the values of all columns; the fitted model is a SQL projection that
    can be saved and loaded."""

    def __init__(self, input_cols: list[str], output_cols: list[str], strategy: str, constant: str = "missing"):
        super().__init__()
        if strategy not in ("most_frequent", "constant"):
            raise ValueError(strategy)
        self.input_cols, self.output_cols, self.strategy, self.constant = input_cols, output_cols, strategy, constant

    def _fit(self, dataset):
        fills = {c: self.constant for c in self.input_cols}
        if self.strategy == "most_frequent":
            long = dataset.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"`{c}`").cast("string").alias("v"))
                                                      for i, c in enumerate(self.input_cols)])).alias("e"))
            counts = long.select("e.i", "e.v").where("v is not null").groupBy("i", "v").agg(F.count("*").alias("n"))
            modes = counts.groupBy("i").agg(F.min_by("v", F.struct(-F.col("n"), "v")).alias("v")).collect()
            fills |= {self.input_cols[r["i"]]: r["v"] for r in modes}  # a column of NULLs only takes the constant
        return SQLTransformer(statement="SELECT *, " + ", ".join(
            f"coalesce(CAST(`{c}` AS STRING), {_sql_text(fills[c])}) AS `{o}`" for c, o in zip(self.input_cols, self.output_cols))
            + " FROM __THIS__")


def _sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
