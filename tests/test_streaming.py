"""Fitted models applied to a stream give the batch result."""

import uuid

from pyspark.sql import functions as F

from gristmill.operators.impute import GroupImputer
from gristmill.session import ensure_checkpoint_dir
from gristmill.streaming.apply import read_parquet_stream, transform_stream, write_available

from conftest import SF_SMALL


def test_stream_matches_batch(spark):
    path = f"{SF_SMALL}/orders.parquet"
    batch = spark.read.parquet(path).withColumn(
        "price_n", F.when(F.col("o_orderkey") % 7 == 0, F.lit(None)).otherwise(F.col("o_totalprice")))
    model = GroupImputer("price_n", ["o_orderpriority"], "mean").fit(batch)
    schema = spark.read.parquet(path).schema
    stream = read_parquet_stream(spark, SF_SMALL, schema, glob="orders.parquet").withColumn(
        "price_n", F.when(F.col("o_orderkey") % 7 == 0, F.lit(None)).otherwise(F.col("o_totalprice")))
    base = ensure_checkpoint_dir(spark).rstrip("/") + f"/stream-{uuid.uuid4().hex}"
    write_available(transform_stream(stream, [model]).select("o_orderkey", "price_n"), base + "/out", base + "/ckpt")
    got = {r.o_orderkey: r.price_n for r in spark.read.parquet(base + "/out").collect()}
    want = {r.o_orderkey: r.price_n for r in model.transform(batch).select("o_orderkey", "price_n").collect()}
    assert got == want and len(got) == 15000
