"""Lookup joins (J1-J5): key -> value tables attached with a left join.

Lookup tables are user data (region lists, code books, side tables).  Their
size is checked when fitted: small ones are broadcast, large ones shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..core import materialize
from .quantile import global_quantiles


def first_match_lookup(df: DataFrame, key: str, table: DataFrame, table_key: str, value: str,
                       pos: str, name: str, default=None) -> DataFrame:
    """Attach ``value`` for ``key`` where a key may be listed under several
    values: the entry with the lowest ``pos`` wins; no entry -> ``default`` (J2)."""
    best = (table.groupBy(table_key)
                 .agg(F.min_by(F.col(value), F.col(pos)).alias(name))
                 .withColumnRenamed(table_key, key))
    out = materialize(best).attach(df, [key], "left")
    if default is not None:
        out = out.withColumn(name, F.coalesce(F.col(name), F.lit(default)))
    return out


def composite_lookup(df: DataFrame, keys: Sequence[str], table: DataFrame, values: Mapping[str, object],
                     pos: str) -> DataFrame:
    """Attach several values by a composite key; the entry listed first (smallest
    ``pos``) wins; missing -> the given defaults (J3)."""
    keys = list(keys)
    best = table.groupBy(*keys).agg(*[F.min_by(F.col(v), F.col(pos)).alias(v) for v in values])
    out = materialize(best).attach(df, keys, "left")
    return out.withColumns({v: F.coalesce(F.col(v), F.lit(d)) for v, d in values.items()})


def range_lookup(df: DataFrame, keys: Sequence[str], number: str, table: DataFrame, low: str, high: str,
                 values: Mapping[str, object], pos: str, width: int | None = None) -> DataFrame:
    """Attach several values by a composite key and a whole number that lies in a listed range
    ``low..high`` (closed); of overlapping ranges the one listed first (smallest ``pos``) wins; no
    range -> the given defaults (J3).

    Ranges are filed under every bin of ``width`` numbers that they cover (by default the mean
    range, so a range covers about two), and inside a bin overlapping ranges are cut into
    disjoint segments with one winner each.  A row meets only its own bin's segments, by key and
    bin, and at most one of them holds it: rows are neither repeated nor compared with all
    ranges of their key."""
    keys, names = list(keys), list(values)
    lo, hi = F.col(low).cast("long"), F.col(high).cast("long")
    ranges = table.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], lo.alias("__lo"), hi.alias("__hi"),
                          F.col(pos).alias("__pos"), *[F.col(v).alias(f"__v{i}") for i, v in enumerate(names)]).where("__lo <= __hi")
    if width is None:
        mean = ranges.agg(F.avg(F.col("__hi") - F.col("__lo") + 1)).first()[0]
        width = max(1, int(mean or 1))
    by = [f"__k{i}" for i in range(len(keys))] + ["__bin"]

    def bin_of(c):
        return F.floor(c / F.lit(width)).cast("long")
    first = F.col("__bin") * width
    binned = (ranges.withColumn("__bin", F.explode(F.sequence(bin_of(F.col("__lo")), bin_of(F.col("__hi")))))
              .withColumns({"__lo": F.greatest("__lo", first), "__hi": F.least("__hi", first + (width - 1))}))
    points = binned.select(*by, F.explode(F.array(F.col("__lo"), F.col("__hi") + 1)).alias("__from")).distinct()
    after = F.lead("__from").over(Window.partitionBy(*by).orderBy("__from"))
    cuts = points.withColumn("__to", after).where("__to is not null")
    covers = (F.col("__lo") <= F.col("__from")) & (F.col("__hi") >= F.col("__to") - 1)
    winner = F.min_by(F.struct(*[f"__v{i}" for i in range(len(names))]), F.col("__pos"))
    segments = cuts.join(binned, by).where(covers).groupBy(*by, "__from", "__to").agg(winner.alias("__w"))
    x = F.col(number).cast("long")
    on = (bin_of(x) == F.col("__bin")) & (F.col("__from") <= x) & (x < F.col("__to"))
    for i, k in enumerate(keys):
        on = on & (F.col(k) == F.col(f"__k{i}"))
    out = materialize(segments).attach(df, on, "left")
    return out.withColumns({v: F.coalesce(F.col("__w")[f"__v{i}"], F.lit(values[v])) for i, v in enumerate(names)}) \
              .drop(*by, "__from", "__to", "__w")


def dedup_by_key(side: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key: the one with the smallest ``order`` (J4 side table).

    ``min_by`` over a struct combines map-side, so a hot key is reduced in
    parallel before the shuffle."""
    others = [c for c in side.columns if c != key]
    packed = F.struct(*[F.col(c) for c in others])
    return (side.groupBy(key).agg(F.min_by(packed, F.col(order)).alias("__row"))
                .select(key, *[F.col("__row")[c].alias(c) for c in others]))


def quantile_flags(df: DataFrame, column: str, flags: Mapping[str, float]) -> DataFrame:
    """0/1 flags ``column > global quantile p`` for each (name, p) (J4 weather flags)."""
    names, probs = list(flags), list(flags.values())
    qs = global_quantiles(df, column, probs)
    return df.withColumns({n: (F.col(column) > F.lit(q)).cast("int") for n, q in zip(names, qs)})
