"""Sources and sinks.

CSV is read with a declared schema (no inference pass over 100 TB), quoted
fields, and pandas' default NA tokens turned into NULL by one projection.
Train and test sources are stacked by name with an ``is_train`` flag.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .quoted import quoted_records

# Text read as missing by default (pandas read_csv NA tokens).
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
             "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: T.StructType, na_tokens: Sequence[str] = NA_TOKENS,
             header: bool = True, multiline: bool | None = None) -> DataFrame:
    """Header CSV with a declared schema; NA tokens -> NULL for every column.

    Columns are read as text first so that tokens such as ``NA`` in numeric
    columns become NULL instead of failing the parse, then cast with
    ``try_cast`` to the declared types.  Text cells are compared with the NA
    tokens as they stand (a blank cell is not missing).

    Quoted cells may hold newlines when ``multiline`` (by default: if the schema
    has a text column); such files are split by quote parity (``quoted.py``) and read by
    many tasks.  A record with the wrong number of cells fails the read.
    """
    if multiline is None:
        multiline = any(isinstance(f.dataType, T.StringType) for f in schema.fields)
    text_schema = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])
    options = {"quote": '"', "escape": '"', "nullValue": "\u0000", "emptyValue": "", "ignoreLeadingWhiteSpace": "false",
               "ignoreTrailingWhiteSpace": "false", "maxCharsPerColumn": "-1", "mode": "FAILFAST"}
    if multiline:
        records = quoted_records(spark, path).where("record <> ''")
        records = records.where("NOT first") if header else records
        # a record has one line for the parser: newlines stand inside its cells
        parsed = F.from_csv("record", _ddl(text_schema), options | {"lineSep": "\u0001"})
        raw = records.select(parsed.alias("r")).select("r.*")
    else:
        raw = spark.read.schema(text_schema).options(**options).option("header", header).option("lineSep", "\n").csv(path)
    na = list(na_tokens)
    cols = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            cols.append(F.when(~c.isin(na), c).alias(f.name))
            continue
        cleaned = F.when(~F.trim(c).isin(na), c)
        if isinstance(f.dataType, T.BooleanType):
            low = F.lower(F.trim(cleaned))
            cols.append(F.when(low == "true", True).when(low == "false", False).alias(f.name))
        else:
            cols.append(F.trim(cleaned).try_cast(f.dataType).alias(f.name))
    return raw.select(*cols)


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Processed table as header CSV, no index (S4, S5, S6); a directory of parts.
    Cells with quotes, commas or newlines are quoted; white space stays."""
    (df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"').option("lineSep", "\n")
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """The default hand-off between steps: types survive."""
    df.write.mode(mode).parquet(path)
    return path


def stack_train_test(train: DataFrame, test: DataFrame, flag: str = "is_train") -> DataFrame:
    """Union by name, columns missing on one side -> NULL, plus a train flag."""
    return (train.withColumn(flag, F.lit(1))
                 .unionByName(test.withColumn(flag, F.lit(0)), allowMissingColumns=True))


def stack_renamed(first: DataFrame, second: DataFrame, renames: Mapping[str, str],
                  drop: Sequence[str] = ()) -> DataFrame:
    """Rename the second source's columns, drop some, append by name."""
    second = second.withColumnsRenamed(dict(renames)).drop(*drop)
    return first.unionByName(second, allowMissingColumns=True)


def prediction_table(df: DataFrame, id_col: str, pred_col: str, id_name: str | None = None,
                     pred_name: str | None = None) -> DataFrame:
    """(id, prediction) with the domain's names."""
    return df.select(F.col(id_col).alias(id_name or id_col), F.col(pred_col).alias(pred_name or pred_col))


def spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """Round-robin ``df`` over ``partitions`` tasks before heavy row-local work, for
    inputs in one unsplittable file.  The caller decides; None leaves it alone."""
    return df.repartition(partitions) if partitions else df
