"""Helpers shared by the corpus operators."""

from __future__ import annotations

import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def ship_by_value(module_name: str) -> None:
    """Pickle a module's functions by value, so that executors need no copy of
    this package on their import path."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


class Scratch:
    """Intermediate tables of one operator call, as Parquet in the shared
    checkpoint folder.

    A written table cuts the lineage and survives lost executors.  The folder
    is private to the call; the cluster's clean-up of its checkpoint folder
    (or the caller, through ``path``) removes it.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.path = f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
        self._n = 0

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return the written table."""
        self._n += 1
        path = f"{self.path}/{self._n:03d}-{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_or_empty(c) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def same(left: DataFrame, right: DataFrame, *cols: str) -> Column:
    """Null-safe equality of the named columns of two frames."""
    out = F.lit(True)
    for c in cols:
        out = out & left[c].eqNullSafe(right[c])
    return out
