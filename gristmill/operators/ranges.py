"""Range buckets: a monotone bucket number for an order key, without a sort.

``splitters`` draws boundaries from a bounded random sample of the key, once.
They become literals, so whatever is computed from a bucket number is the same
on a re-run, and it is exact whatever the boundaries are: they only decide how
even the buckets get.  A hot group is spread over the buckets its keys span.

Positions and running sums are then two-level: one small aggregate per bucket
(and group) gives offsets, a window inside the bucket gives the rest.  Nothing
is cached, and no task gathers a whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS_PER_PARTITION = 2
SAMPLE_PER_BUCKET = 8
_MARK = "\x01"


def default_buckets(df: DataFrame) -> int:
    """Buckets follow the shuffle partitions, which the user sizes for the data."""
    return BUCKETS_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def splitters(df: DataFrame, key: str, buckets: int) -> list:
    """At most ``buckets - 1`` distinct boundaries of the non-null ``key`` (collected: a bounded sample)."""
    if buckets < 2:
        return []
    sample = (df.select(F.col(key).alias("k")).where(F.col("k").isNotNull())
              .orderBy(F.rand(7)).limit(buckets * SAMPLE_PER_BUCKET).orderBy("k").collect())
    keys = [r["k"] for r in sample]
    picked = [keys[len(keys) * i // buckets] for i in range(1, buckets)] if keys else []
    return [k for i, k in enumerate(picked) if i == 0 or k != picked[i - 1]]


def bucket_of(key: Column, bounds: Sequence, dtype: str) -> Column:
    """Number of boundaries below ``key`` (null -> 0), by binary search over a literal array."""
    texts = [str(b) for b in bounds]
    texts = [t for t in texts if _MARK not in t]  # one boundary less only makes buckets less even
    if not texts:
        return F.lit(0)
    # one short expression that folds to an array literal, instead of a literal per boundary
    array = F.split(F.lit(_MARK.join(texts)), _MARK).cast(f"array<{dtype}>")
    steps = [1 << i for i in reversed(range(len(texts).bit_length()))]
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0),
                       lambda at, step: at + F.when(F.get(array, at + step - 1) < key, step).otherwise(0))


def with_bucket(df: DataFrame, key: str, name: str, buckets: int | None = None) -> DataFrame:
    n = buckets or default_buckets(df)
    return df.withColumn(name, bucket_of(F.col(key), splitters(df, key, n), dict(df.dtypes)[key]))


def offsets(df: DataFrame, by: Sequence[str], bucket: str, sums: dict[str, Column]) -> DataFrame:
    """Per (group, bucket): for each of ``sums`` the total of the group's earlier
    buckets, ``{name}_before``, and the group's total, ``{name}_all``.  Group
    columns come back as ``__by0`` ..., the bucket as ``__at``."""
    keys = [F.col(b).alias(f"__by{i}") for i, b in enumerate(by)]
    names = [f"__by{i}" for i in range(len(by))]
    per = df.groupBy(*keys, F.col(bucket).alias("__at")).agg(*[c.alias(n) for n, c in sums.items()])
    whole = Window.partitionBy(*names) if names else Window.partitionBy(F.lit(0))
    before = whole.orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    return per.select(*names, "__at", *[F.coalesce(F.sum(n).over(before), zero).alias(f"{n}_before") for n in sums],
                      *[F.sum(n).over(whole).alias(f"{n}_all") for n in sums])


def attach_offsets(df: DataFrame, table: DataFrame, by: Sequence[str], bucket: str) -> DataFrame:
    """Join :func:`offsets` back (null groups match each other) and drop its keys."""
    on = F.col(bucket) == F.col("__at")
    for i, b in enumerate(by):
        on = on & F.col(b).eqNullSafe(F.col(f"__by{i}"))
    return df.join(table, on).drop("__at", *[f"__by{i}" for i in range(len(by))])
