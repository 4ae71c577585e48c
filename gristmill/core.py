"""Shared building blocks: the estimator/model pattern and size-checked lookups.

Every fitted operator computes its statistic with a distributed aggregation in
``fit`` and keeps either a few scalars (literals) or a statistics DataFrame.
``transform`` is always a lazy projection or a left join, so Catalyst sees the
whole plan and a streaming DataFrame can be transformed too.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Statistics tables fetched to the driver (``materialize``) are capped at this
# many rows; beyond it they stay distributed.
BROADCAST_MAX_ROWS = 100_000
# ... and at this many bytes.
BROADCAST_MAX_BYTES = 32 << 20


class Estimator:
    def fit(self, df: DataFrame) -> "Model":  # pragma: no cover - interface
        raise NotImplementedError

    def fit_transform(self, df: DataFrame, apply_to: DataFrame | None = None) -> DataFrame:
        return self.fit(df).transform(df if apply_to is None else apply_to)


class Model:
    def transform(self, df: DataFrame) -> DataFrame:  # pragma: no cover - interface
        raise NotImplementedError


@dataclass
class StatsTable:
    """A fitted statistics table and whether its size was proven small.

    ``small=True``: the rows were counted (at most ``BROADCAST_MAX_ROWS``) and
    the table is joined by broadcast.  ``small=False``: the table stays a lazy
    plan; adaptive execution measures its real size when the join runs and
    broadcasts it only under ``spark.sql.adaptive.autoBroadcastJoinThreshold``,
    otherwise it shuffle-joins (splitting skewed keys).  No extra job is run.
    """

    df: DataFrame
    small: bool

    def attach(self, df: DataFrame, on, how: str = "left") -> DataFrame:
        side = F.broadcast(self.df) if self.small else self.df
        return df.join(side, on=on, how=how)


def lazy(stats: DataFrame) -> StatsTable:
    """A statistics table joined under adaptive execution's runtime size check."""
    return StatsTable(stats, False)


def materialize(stats: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> StatsTable:
    """Compute a statistics table once, if it is small, and decide how it is joined.

    At most ``max_rows + 1`` rows are fetched.  If they fit, in number and in
    bytes, the table becomes a driver-held relation with a broadcast hint: the
    lineage is cut and the big side is never shuffled.  Otherwise the fetched
    rows are dropped and the table stays a lazy plan, joined by a shuffle join
    (AQE splits skewed keys).  Nothing unbounded reaches the driver, and
    nothing is cached.
    """
    rows = stats.limit(max_rows + 1).collect()
    if len(rows) <= max_rows and _bytes_of(rows) <= BROADCAST_MAX_BYTES:
        return StatsTable(stats.sparkSession.createDataFrame(rows, stats.schema), True)
    return lazy(stats)


def _bytes_of(rows: list) -> int:
    """Rough size of collected rows: 16 bytes a value, and texts' and lists' lengths."""
    size = 0
    for row in rows:
        for v in row:
            size += 16 + (len(v) * (8 if isinstance(v, list) else 2) if isinstance(v, (str, bytes, list)) else 0)
    return size


def scalar_row(df: DataFrame) -> dict:
    """Collect a one-row aggregate as a dict (a bounded result by construction)."""
    rows = df.collect()
    if len(rows) != 1:
        raise ValueError(f"expected one aggregate row, got {len(rows)}")
    return rows[0].asDict()


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(n, d) -> Column:
    """n / d with NULL for a zero denominator (ANSI-safe)."""
    return F.try_divide(col_of(n), col_of(d))


def r6(c, places: int = 6) -> Column:
    return F.round(col_of(c).cast("double"), places)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into the session's checkpoint folder and continue from
    the written data.

    Cascaded fits (fill, then fit the next statistic on the filled data) would
    otherwise re-run the whole growing plan for every statistic.  A reliable
    checkpoint in the shared folder survives executor loss; ``localCheckpoint``
    would not.
    """
    from .session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
