"""How the rows of a model fill are dealt to tasks."""

import pyspark.ml
from pyspark.sql import functions as F

from gristmill.operators import impute


def test_a_large_fit_is_dealt_to_many_tasks(spark, monkeypatch):
    df = spark.range(1200, numPartitions=1).select(
        "id", F.when(F.col("id") % 6 > 0, F.col("id") % 7).alias("t"), (F.col("id") % 3).cast("string").alias("c"), (F.col("id") % 7 * 1.0).alias("x"))
    fits, fit = [], pyspark.ml.Pipeline.fit

    def seen(self, rows, params=None):
        fits.append((rows.rdd.getNumPartitions(), rows.count()))
        return fit(self, rows, params)
    monkeypatch.setattr(pyspark.ml.Pipeline, "fit", seen)
    small = impute.ModelImputer("t", ["c"], ["x"], num_trees=3).fit(df).transform(df)
    monkeypatch.setattr(impute, "FOREST_ROWS", 50)
    large = impute.ModelImputer("t", ["c"], ["x"], num_trees=3).fit(df).transform(df)
    assert fits == [(1, 1000), (max(20, spark.sparkContext.defaultParallelism), 1000)]
    for out in (small, large):
        assert out.columns == df.columns and out.where("t is null").count() == 0
        assert out.join(df.where("t is not null").withColumnRenamed("t", "u"), "id").where("t = u").count() == 1000
