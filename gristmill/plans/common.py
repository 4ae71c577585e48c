"""Steps shared by the domain plans: mutual-information selection (F1/F2 + P7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..core import cut_lineage
from ..operators.score import mi_binned, mi_discrete, select_by_score

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)
FLOATING = (T.FloatType, T.DoubleType, T.DecimalType)


def mi_scores(df: DataFrame, target: str, known: Column, exclude: Sequence[str] = (),
              target_discrete: bool = True, bins: int = 10) -> DataFrame:
    """MI of every feature against the target on the rows where it is known.

    Text and integer columns are scored as discrete (exact contingency MI);
    floating columns by quantile bins.  A continuous target is binned too."""
    src = df.where(known)
    skip = set(exclude) | {target}
    discrete = [f.name for f in df.schema.fields if f.name not in skip
                and isinstance(f.dataType, (T.StringType,) + INTEGRAL)]
    continuous = [f.name for f in df.schema.fields if f.name not in skip and isinstance(f.dataType, FLOATING)]
    parts = []
    if target_discrete:
        if discrete:
            parts.append(mi_discrete(src, discrete, target))
        if continuous:
            parts.append(mi_binned(src, continuous, target, bins))
    else:
        tb = [i / bins for i in range(1, bins)]
        from ..operators.quantile import global_quantiles
        edges = global_quantiles(src, target, tb)
        ybin = F.aggregate(F.array(*[F.lit(e) for e in edges]), F.lit(0),
                           lambda acc, e: acc + F.when(F.col(target) > e, 1).otherwise(0))
        src = src.withColumn("__ybin", ybin)
        if discrete:
            parts.append(mi_discrete(src, discrete, "__ybin"))
        if continuous:
            parts.append(mi_binned(src, continuous, "__ybin", bins))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def drop_uninformative(df: DataFrame, target: str, known: Column, keep: Sequence[str], threshold: float = 0.0,
                       exclude: Sequence[str] = (), target_discrete: bool = True) -> tuple[DataFrame, DataFrame]:
    """Keep features with MI > threshold plus the protected columns."""
    df = cut_lineage(df)
    scores = mi_scores(df, target, known, exclude=list(exclude) + list(keep), target_discrete=target_discrete)
    kept, _ = select_by_score(df, scores, threshold, keep=list(keep))
    return kept, scores
