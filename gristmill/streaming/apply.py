"""Apply fitted feature models to a stream.

The reference works on batches only; nothing here adds stream semantics.  A
fitted model's ``transform`` is a projection or a left join against a static
statistics table, so it is valid on a streaming DataFrame as is (a
stream-static join keeps no state).  Statistics are fitted on a batch
DataFrame first; the stream is then transformed and written incrementally.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..core import Model


def read_parquet_stream(spark: SparkSession, path: str, schema: T.StructType,
                        max_files_per_trigger: int | None = None, glob: str | None = None) -> DataFrame:
    """A parquet folder as a stream (schema declared, as streams require);
    ``glob`` keeps only the matching file names."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def transform_stream(stream: DataFrame, models: Sequence[Model]) -> DataFrame:
    """Run fitted models over a streaming DataFrame, in order."""
    out = stream
    for m in models:
        out = m.transform(out)
    return out


def write_available(df: DataFrame, sink: str, checkpoint: str, fmt: str = "parquet"):
    """Process everything available now, append to ``sink`` and stop.  The
    checkpoint folder makes the run restartable after a failure."""
    q = (df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
           .trigger(availableNow=True).start(sink))
    q.awaitTermination()
    return q
