"""Splittable scan of CSV text whose quoted cells hold newlines.

Spark reads a ``multiLine`` file in one task, because a newline ends a record only outside of
quotes, and whether a split starts inside of quotes depends on all bytes before it.  Here a
file's splits are read in parallel, twice, and only their states are put in order:

1. Every split sums up its lines for both start states: the parity of its quotes, the
   lines up to the first record end (if it starts inside of quotes), and the lines after its
   last record end (either way).  One small row per split.
2. A prefix over a file's splits fixes each start state.  Records that cross a
   split's edge are joined from these rows: one record can span any number of splits.
3. With the start states known, every split cuts its lines into whole records, in order, and
   leaves out the pieces that step 2 has joined.

Quotes must be doubled inside quoted cells, so that their parity tells inside from outside; a file
that ends inside of quotes fails the scan.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..core import cut_lineage

SPLIT = ("file long, start long, odd boolean, lines long, head string, head_ends boolean, "
         "tail_outside string, tail_inside string")


def _lines(spark: SparkSession, path) -> DataFrame:
    """(line, odd, file, start): physical lines, in the order of their split inside a task."""
    text = spark.read.option("lineSep", "\n").text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return text.select(F.col("value").alias("line"), (quotes % 2 == 1).alias("odd"),
                       F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], pa.Array, np.ndarray]]:
    """(split, lines, odd) runs of each batch that belong to one split."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, start = batch.column("file").to_numpy(), batch.column("start").to_numpy()
        odd = batch.column("odd").to_numpy(zero_copy_only=False).astype(np.int64)
        cuts = np.flatnonzero((np.diff(file) != 0) | (np.diff(start) != 0)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            yield (int(file[a]), int(start[a])), batch.column("line").slice(a, b - a), odd[a:b]


class _Summary:
    """What is known of a split before its start state is."""

    def __init__(self):
        self.odd, self.lines, self.head, self.head_ends = 0, 0, [], False
        self.tails: list[list[str]] = [[], []]  # lines since the last record end, by start state

    def add(self, lines: pa.Array, odd: np.ndarray) -> None:
        after = (self.odd + odd.cumsum()) % 2  # parity behind each line
        self.lines += len(lines)
        if not self.head_ends:
            turn = np.flatnonzero(after == 1)
            stop = int(turn[0]) + 1 if len(turn) else len(lines)
            self.head += lines.slice(0, stop).to_pylist()
            self.head_ends = bool(len(turn))
        for inside in (0, 1):
            ends = np.flatnonzero(after == inside)
            if len(ends):
                self.tails[inside] = lines.slice(int(ends[-1]) + 1).to_pylist()
            else:
                self.tails[inside] += lines.to_pylist()
        self.odd = int(after[-1])

    def row(self, split: tuple[int, int]) -> dict:
        join = "\n".join
        tails = [join(t) if t else None for t in self.tails]
        return {"file": split[0], "start": split[1], "odd": bool(self.odd), "lines": self.lines, "head": join(self.head),
                "head_ends": self.head_ends, "tail_outside": tails[0], "tail_inside": tails[1]}


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("file", pa.int64()), ("start", pa.int64()), ("odd", pa.bool_()), ("lines", pa.int64()), ("head", pa.string()),
                        ("head_ends", pa.bool_()), ("tail_outside", pa.string()), ("tail_inside", pa.string())])
    at, summary = None, None
    for split, lines, odd in _runs(batches):
        if split != at:
            if at is not None:
                yield pa.RecordBatch.from_pylist([summary.row(at)], schema)
            at, summary = split, _Summary()
        summary.add(lines, odd)
    if at is not None:
        yield pa.RecordBatch.from_pylist([summary.row(at)], schema)


def _records(inside: dict[int, np.ndarray]):
    """Whole records of each split; ``inside`` lists the splits of a file that start inside of quotes."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, held, first, skip = None, 0, [], False, False
        for split, lines, odd in _runs(batches):
            if split != at:
                at, held = split, []
                state = int(split[1] in inside.get(split[0], ()))
                first, skip = split[1] == 0, bool(state)  # the head belongs to a record of an earlier split
            after = (state + odd.cumsum()) % 2
            if not state and not odd.any() and not held:  # every line is a record
                out, marks = lines, np.zeros(len(lines), bool)
                marks[0], first = first, False
            else:
                records, marks, texts, begin = [], [], lines.to_pylist(), 0
                for end in np.flatnonzero(after == 0).tolist():
                    record = "\n".join(held + texts[begin:end + 1]) if held or begin < end else texts[end]
                    if not skip:
                        records.append(record)
                        marks.append(first)
                        first = False
                    begin, held, skip = end + 1, [], False
                held = held + texts[begin:] if not skip else []
                state = int(after[-1])
                out, marks = pa.array(records, pa.string()), np.array(marks, bool)
            yield pa.RecordBatch.from_pydict({"record": out.cast(pa.string()), "first": pa.array(marks)})
    return cut


def quoted_records(spark: SparkSession, path) -> DataFrame:
    """(record, first) per CSV record of the files at ``path``; ``first`` marks a file's first record."""
    lines = _lines(spark, path)
    splits = cut_lineage(lines.mapInArrow(_summaries, SPLIT))
    in_order = Window.partitionBy("file").orderBy("start")  # one row per split
    before = F.coalesce(F.sum(F.col("odd").cast("long")).over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2 == 1
    states = splits.withColumn("inside", before)
    open_files = states.groupBy("file").agg((F.sum(F.col("odd").cast("long")) % 2).alias("left")).where("left = 1")
    if open_files.limit(1).count():
        raise ValueError("a CSV file ends inside of quotes")

    # pieces of records that cross a split's edge, in order: the end of one, then the start of the next
    tail = F.when(F.col("inside"), F.col("tail_inside")).otherwise(F.col("tail_outside"))
    through = F.col("inside") & ~F.col("head_ends")  # the whole split is inside one record
    pieces = states.select("file", "start", F.explode(F.array(
        F.when(F.col("inside"), F.struct(F.lit(0).alias("kind"), F.col("head").alias("text"))),
        F.when(tail.isNotNull() & ~through, F.struct(F.lit(1).alias("kind"), tail.alias("text"))))).alias("p"))
    pieces = pieces.where("p is not null").select("file", "start", "p.kind", "p.text")
    number = F.sum("kind").over(Window.partitionBy("file").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, 0))
    joined = (pieces.withColumn("record_number", number).groupBy("file", "record_number")
              .agg(F.sort_array(F.collect_list(F.struct("start", "kind", "text"))).alias("parts")))
    whole_split = (F.col("parts")[0]["start"] == 0) & (F.col("record_number") == 1)
    joined = joined.select(F.array_join(F.col("parts")["text"], "\n").alias("record"), whole_split.alias("opens"), "file")
    firsts = states.where("start = 0").select("file", (F.col("tail_outside").isNotNull() & (
        F.col("lines") == F.size(F.split("tail_outside", "\n", -1)))).alias("all_tail"))
    joined = joined.join(firsts, "file").select("record", (F.col("opens") & F.col("all_tail")).alias("first"))
    joined = cut_lineage(joined)

    inside: dict[int, list[int]] = {}
    for r in states.where("inside").select("file", "start").collect():  # at most one number per split
        inside.setdefault(r["file"], []).append(r["start"])
    known = {f: frozenset(s) for f, s in inside.items()}
    return lines.mapInArrow(_records(known), "record string, first boolean").unionByName(joined)


# executors need no copy of this package on their import path
cloudpickle.register_pickle_by_value(sys.modules[__name__])
