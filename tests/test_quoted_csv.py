"""Splittable CSV with quoted newlines against Python's csv module."""

import csv
import random

import pytest
from pyspark.sql import types as T

from gristmill.sources import io
from gristmill.sources.quoted import quoted_records

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("t", T.StringType()), T.StructField("u", T.StringType())])


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    yield spark
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def rows_of(rng, n):
    def cell():
        kind = rng.random()
        if kind < 0.3:
            return "".join(rng.choice(['a', '"', ',', '\n', 'é', ' ', '""', '\n\n']) for _ in range(rng.randint(1, 40)))
        if kind < 0.33:
            return "long\n" * 500  # spans several splits
        return rng.choice(["plain", "x" * 300, '"', "\n", "a,b", " lead"])
    return [(i, cell(), cell()) for i in range(n)]


def write(path, rows):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator="\n", quoting=csv.QUOTE_ALL if len(rows) % 2 else csv.QUOTE_MINIMAL)
        w.writerow(["id", "t", "u"])
        w.writerows(rows)


@pytest.mark.parametrize("seed", range(3))
def test_records_of_split_files(small_splits, tmp_path, seed):
    rng = random.Random(seed)
    whole = []
    for k in range(3):
        rows = [(i + 1000 * k, t, u) for i, t, u in rows_of(rng, 60 + k)]
        write(tmp_path / f"{k}.csv", rows)
        whole += rows
    records = quoted_records(small_splits, str(tmp_path))
    assert records.rdd.getNumPartitions() > 20
    assert records.where("first").count() == 3
    got = io.read_csv(small_splits, str(tmp_path), SCHEMA, na_tokens=["NA"])
    assert sorted(tuple(r) for r in got.collect()) == sorted(whole)
    headless = io.read_csv(small_splits, str(tmp_path), T.StructType([T.StructField(n, T.StringType()) for n in "abc"]), header=False)
    assert headless.count() == len(whole) + 3


def test_header_longer_than_a_split(small_splits, tmp_path):
    (tmp_path / "a.csv").write_text('"id","' + "t\n" * 900 + '","u"\n1,"a\nb",c\n', encoding="utf-8")
    got = io.read_csv(small_splits, str(tmp_path), SCHEMA)
    assert [tuple(r) for r in got.collect()] == [(1, "a\nb", "c")]


def test_blank_lines_and_empty_files(small_splits, tmp_path):
    (tmp_path / "a.csv").write_text('id,t,u\n\n1,"",x\n\n2,"\n\n",\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text("", encoding="utf-8")
    (tmp_path / "c.csv").write_text("id,t,u", encoding="utf-8")
    got = io.read_csv(small_splits, str(tmp_path), SCHEMA, na_tokens=[])
    assert sorted((r["id"], r["t"]) for r in got.collect()) == [(1, ""), (2, "\n\n")]


def test_open_quotes_fail(small_splits, tmp_path):
    (tmp_path / "a.csv").write_text('id,t,u\n1,"open,x\n', encoding="utf-8")
    with pytest.raises(ValueError, match="inside of quotes"):
        io.read_csv(small_splits, str(tmp_path), SCHEMA)


def test_wrong_number_of_cells_fails(small_splits, tmp_path):
    (tmp_path / "a.csv").write_text('id,t,u\n1,x\n', encoding="utf-8")
    with pytest.raises(Exception, match="(?i)malformed"):
        io.read_csv(small_splits, str(tmp_path), SCHEMA).collect()
