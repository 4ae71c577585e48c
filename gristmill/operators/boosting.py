"""Gradient boosting of many candidates in one training loop (V3, V8, V9, M1, M2).

A grid of candidates over folds is hundreds of models that read the same rows.  They are
trained together: features are binned once into blocks of rows, every model is at the same
round, and one job per tree level carries the gradient histograms of all live models.  So a
grid costs about rounds x depth small jobs instead of candidates x folds x rounds x depth.

Trees are symmetric (one split per level, as in ordered-boosting libraries' default): a model
has ``2 ** depth`` leaves a tree, an L2 penalty of leaf values, and Bayesian bootstrap weights
``(-ln u) ** bagging_temperature`` per row and round.  ``u`` is mixed from the row's key, so a
model does not depend on the partitions, on the other candidates, or on task retries.

Rows of equal bins, label and fold (a cell) have equal margins in every model, so a model learns
from the cells and from the sum of its rows' bootstrap weights per cell and round.  Binned
features have few cells however many the rows; there are two layouts.

Cells, up to ``MAX_CELLS``: rows are dealt out evenly in cell order and keep their keys; per chunk
of rounds one pass over them sums the weights, once per temperature, and sends the sums to the
groups of models that use them.  A task grows a chunk's trees of its group: its work does not grow
with the rows.  Margins (models x cells) are checkpointed into the session's shared folder after
every chunk.

Blocks, for more cells: a unit is one block of rows x one group of models; it holds the block's
bins (one byte a value) and the group's margins.  A task holds one unit at a time and one histogram
per model.  Histograms are summed per model by a shuffle (bounded by models x leaves x bins,
whatever the rows); the reducers choose the splits, so the driver sees a few numbers per model and
level.  Units stay persisted between jobs of a round and are checkpointed every
``CHECKPOINT_ROUNDS`` rounds; a lost executor's units are computed again from there.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..core import cut_lineage
from ..session import ensure_checkpoint_dir

BLOCK_ROWS = 1 << 14
#: Models whose margins share a unit, at most.
GROUP_MODELS = 64
CHECKPOINT_ROUNDS = 25
#: Distinct (bins, label, fold) up to which every task may hold all of them, in number and in bytes.
MAX_CELLS = 1 << 17
MAX_CELL_BYTES = 16 << 20
#: Bytes of weight sums of one temperature and chunk of rounds.
WEIGHT_BYTES = 8 << 20
#: Rows whose keys one task holds, at most.
KEY_ROWS = 1 << 20


@dataclass(frozen=True)
class Candidate:
    depth: int = 6
    learning_rate: float = 0.1
    l2: float = 3.0
    bagging_temperature: float = 1.0
    min_gain: float = 1e-9  # a split with no more gain than this is not made and the tree ends


@dataclass(frozen=True)
class Job:
    """One model: a candidate fitted on the rows outside ``held_out`` (None: on all rows)."""
    candidate: Candidate
    held_out: int | None = None


@dataclass
class Tree:
    features: list[int]
    bins: list[int]  # a row goes right where its bin is larger
    values: list[float]


@dataclass
class Booster:
    """A fitted model: symmetric trees over borders; ``score`` is a Column expression."""
    job: Job
    loss: str
    start: float
    borders: list[list[float]]
    trees: list[Tree] = field(default_factory=list)

    def margin(self, features, rounds: int | None = None) -> Column:
        """The raw score of an array column, from built-in functions (no UDF)."""
        trees = [t for t in self.trees[:rounds] if t.features]
        flat = self.start + sum(t.values[0] for t in self.trees[:rounds] if not t.features)
        if not trees:
            return F.lit(float(flat))
        x = features if isinstance(features, Column) else F.col(features)
        number = lambda v: f"double('{float(v)!r}')"
        literal = "array(" + ", ".join(
            "named_struct('f', array({}), 'b', array({}), 'v', array({}))".format(
                ", ".join(map(str, t.features)), ", ".join(number(self.borders[f][b]) for f, b in zip(t.features, t.bins)),
                ", ".join(map(number, t.values))) for t in trees) + ")"

        def value(t: Column) -> Column:
            # NULL and NaN are below every border
            right = F.zip_with(t["f"], t["b"], lambda f, b: F.coalesce((F.get(x, f) > b) & ~F.isnan(F.get(x, f)), F.lit(False)).cast("int"))
            return F.get(t["v"], F.aggregate(right, F.lit(0), lambda leaf, bit: leaf * 2 + bit))
        return F.aggregate(F.expr(literal), F.lit(float(flat)), lambda s, t: s + value(t))

    def score(self, features, rounds: int | None = None) -> Column:
        """The probability of class 1, or the predicted value."""
        m = self.margin(features, rounds)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-m)) if self.loss == "logistic" else m


@dataclass
class Boosted:
    models: list[Booster]  # as the jobs
    #: Per job and finished round: rows, right ones (at 0.5; logistic) and the loss sum of its held-out rows.
    staged: list[list[tuple[float, float, float]]]

    def accuracy(self, i: int, rounds: int | None = None) -> float:
        n, right, _ = self.staged[i][(rounds or len(self.staged[i])) - 1]
        return right / n if n else 0.0

    def mean_loss(self, i: int, rounds: int | None = None) -> float:
        n, _, loss = self.staged[i][(rounds or len(self.staged[i])) - 1]
        return loss / n if n else math.inf


def borders_of(df: DataFrame, features: str, max_bins: int = 32) -> list[list[float]]:
    """Split borders of every component: its smallest value and quantiles, without its largest
    value; one job, sketches of bounded size.  Missing values are below every border."""
    x = F.col("x").cast("double")
    long = df.select(F.posexplode(features).alias("i", "x")).where(F.col("x").isNotNull() & ~F.isnan(x))
    cuts = F.array(*[F.lit(q / max_bins) for q in range(1, max_bins)])
    rows = long.groupBy("i").agg(F.min(x).alias("lo"), F.max(x).alias("hi"), F.percentile_approx(x, cuts, 10_000).alias("q")).collect()
    size = df.agg(F.max(F.size(features))).first()[0] or 0
    out: list[list[float]] = [[] for _ in range(size)]
    for r in rows:
        out[r["i"]] = sorted({v for v in [r["lo"], *r["q"]] if v < r["hi"]})
    return out


def _blocks(df: DataFrame, features: str, label: str, fold: str | None, key: str, borders: list[list[float]]) -> DataFrame:
    """One row per block of rows: bins (feature-major bytes), labels, folds and keys."""
    width = len(borders)
    edges = [np.array(b) for b in borders]

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= BLOCK_ROWS:
                table = pa.Table.from_batches(held)
                yield table.slice(0, BLOCK_ROWS).combine_chunks()
                held = table.slice(BLOCK_ROWS).to_batches()
        if any(b.num_rows for b in held):
            yield pa.Table.from_batches(held).combine_chunks()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in full(batches):
            for part in table.to_batches():
                x = part.column("x").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(part.num_rows, width)
                x = np.where(np.isnan(x), -np.inf, x)
                bins = np.empty((width, part.num_rows), np.uint8)
                for f in range(width):
                    bins[f] = np.searchsorted(edges[f], x[:, f], side="left")
                cells = {"bins": bins.tobytes(), "y": part.column("y").to_numpy(zero_copy_only=False).astype(np.float64).tobytes(),
                         "fold": part.column("fold").to_numpy(zero_copy_only=False).astype(np.int32).tobytes(),
                         "key": part.column("key").to_numpy(zero_copy_only=False).astype(np.int64).tobytes()}
                yield pa.RecordBatch.from_pydict({"n": pa.array([part.num_rows], pa.int32()),
                                                  **{k: pa.array([v], pa.binary()) for k, v in cells.items()}})
    rows = df.select(F.transform(features, lambda v: v.cast("double")).alias("x"), F.col(label).cast("double").alias("y"),
                     (F.coalesce(F.col(fold).cast("int"), F.lit(-1)) if fold else F.lit(-1)).alias("fold"),
                     F.xxhash64(key).alias("key")).where((F.size("x") == width) & F.col("y").isNotNull())
    return rows.mapInArrow(pack, "n int, bins binary, y binary, fold binary, key binary")


def _exponentials(key: np.ndarray, round_: int, seed: int) -> np.ndarray:
    """-ln u per row, from the row's key."""
    z = key.view(np.uint64) + np.uint64(((round_ + 1) * 0x9E3779B97F4A7C15 + seed * 0xD1B54A32D192ED03) % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    return -np.log(((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(float) / 2.0**53 + 2.0**-54)


def _gradients(margin: np.ndarray, y: np.ndarray, loss: str) -> tuple[np.ndarray, np.ndarray]:
    if loss == "squared":
        return margin - y, np.ones_like(y)
    p = 1.0 / (1.0 + np.exp(-margin))
    return p - y, p * (1.0 - p)


def _leaves(bins: np.ndarray, splits: Sequence[tuple[int, int]]) -> np.ndarray:
    leaf = np.zeros(bins.shape[1], np.int64)
    for f, b in splits:
        leaf = leaf * 2 + (bins[f] > b)
    return leaf


def _values(c: Candidate, sums: np.ndarray) -> np.ndarray:
    """Leaf values from the sums of g and h."""
    return -c.learning_rate * sums[0] / np.maximum(sums[1] + c.l2, 1e-12)


def _advance(unit: dict, trees: dict[int, Tree]) -> dict:
    """The unit after one more tree per model."""
    margins = unit["margins"].copy()
    for at, i in enumerate(unit["models"]):
        if i in trees:
            t = trees[i]
            margins[at] += np.array(t.values, np.float32)[_leaves(unit["bins"], list(zip(t.features, t.bins)))]
    return unit | {"margins": margins}


def _held_out(unit: dict, jobs: Sequence[Job], going: frozenset[int], loss: str) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
    """Rows, right ones and loss sum of each model's held-out rows."""
    for at, i in enumerate(unit["models"]):
        if jobs[i].held_out is None or i not in going:
            continue
        rows = unit["fold"] == jobs[i].held_out
        m, y = unit["margins"][at][rows].astype(float), unit["y"][rows]
        if loss == "squared":
            sums = [len(y), 0.0, ((m - y) ** 2).sum()]
        else:
            sums = [len(y), ((m > 0) == (y > 0.5)).sum(), (np.logaddexp(0.0, m) - y * m).sum()]
        yield (i, 1), np.array(sums, float)


class _Rows:
    """The rows of a unit that a model learns from: their numbers, and the (row, cell) entries of
    all bins but each feature's first, whose sums follow from the leaf's total."""

    def __init__(self, unit: dict, held_out: int | None, starts: np.ndarray):
        keep = unit["fold"] != held_out if held_out is not None else np.ones(len(unit["y"]), bool)
        self.rows = np.flatnonzero(keep)
        feature, self.row = np.nonzero(unit["bins"][:, self.rows])
        self.cell = unit["bins"][feature, self.rows[self.row]] + starts[feature]

    def histogram(self, g: np.ndarray, h: np.ndarray, leaf: np.ndarray, leaves: int, starts: np.ndarray, ends: np.ndarray,
                  only: np.ndarray | None = None) -> np.ndarray:
        """Sums of g and h per (leaf, cell): (2, leaves, cells); of the rows marked in ``only``."""
        n_cells, row, cell = int(ends[-1]), self.row, self.cell
        if only is not None:
            entries = np.flatnonzero(only[row])
            row, cell, rows = row[entries], cell[entries], np.flatnonzero(only)
        at = leaf[row] * n_cells + cell
        out = np.empty((2, leaves, n_cells))
        for k, x in enumerate((g, h)):
            out[k] = np.bincount(at, x[row], leaves * n_cells).reshape(leaves, n_cells)
            total = np.bincount(leaf, x, leaves) if only is None else np.bincount(leaf[rows], x[rows], leaves)
            out[k][:, starts] = total[:, None] - np.add.reduceat(out[k], starts, axis=1)
        return out


def _held_out_sums(margin: np.ndarray, y: np.ndarray, n: np.ndarray, loss: str) -> list[float]:
    """Rows, right ones and loss sum of cells of ``n`` rows."""
    m = margin.astype(float)
    if loss == "squared":
        return [float(n.sum()), 0.0, float((n * (m - y) ** 2).sum())]
    return [float(n.sum()), float((n * ((m > 0) == (y > 0.5))).sum()), float((n * (np.logaddexp(0.0, m) - y * m)).sum())]


class _Trainer:
    """What the models of a unit have in common in one round."""

    def __init__(self, unit: dict, jobs: Sequence[Job], starts: np.ndarray, ends: np.ndarray, round_: int, loss: str, seed: int):
        self.unit, self.jobs, self.starts, self.ends, self.round, self.loss, self.seed = unit, jobs, starts, ends, round_, loss, seed
        self._rows: dict = {}
        self._draws = None

    def gradients(self, at: int) -> tuple[_Rows, np.ndarray, np.ndarray]:
        job, unit = self.jobs[self.unit["models"][at]], self.unit
        if job.held_out not in self._rows:
            self._rows[job.held_out] = _Rows(unit, job.held_out, self.starts)
        mine = self._rows[job.held_out]
        g, h = _gradients(unit["margins"][at][mine.rows].astype(float), unit["y"][mine.rows], self.loss)
        if job.candidate.bagging_temperature:
            if self._draws is None:
                self._draws = _exponentials(unit["key"], self.round, self.seed)
            w = self._draws[mine.rows] ** job.candidate.bagging_temperature
            g, h = g * w, h * w
        return mine, g, h

    def partial(self, live: dict[int, list[tuple[int, int]]]) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
        """Histograms of the next level of each live model, to be summed over the blocks."""
        for at, i in enumerate(self.unit["models"]):
            if i in live:
                mine, g, h = self.gradients(at)
                leaf = _leaves(self.unit["bins"], live[i])[mine.rows]
                yield (i, 0), mine.histogram(g, h, leaf, 1 << len(live[i]), self.starts, self.ends)


def _best_split(hist: np.ndarray, starts: np.ndarray, ends: np.ndarray, l2: float) -> tuple[float, int, np.ndarray]:
    """Gain, cell and child sums (2, leaves, 2) of the best split of all leaves at once."""
    feature = np.repeat(np.arange(len(starts)), ends - starts)
    run = hist.cumsum(axis=2)
    before = np.where(starts > 0, run[:, :, starts - 1], 0.0)  # all cells of the features in front
    left = run - before[:, :, feature]
    total = run[:, :, ends[0] - 1][:, :, None]

    def quality(x):
        return x[0] ** 2 / np.maximum(x[1] + l2, 1e-12)
    right = total - left
    gain = (quality(left) + quality(right) - quality(total)).sum(axis=0)
    gain[ends - 1] = -np.inf  # behind a feature's last bin nothing is left
    # equal gains differ in their last bits with the order of summation: the first of them
    cell = int((gain >= gain.max() - 1e-9 * (1.0 + abs(gain.max()))).argmax())
    return float(gain[cell]), cell, np.stack([left[:, :, cell], right[:, :, cell]], axis=2)


def _cell_codes(bins: np.ndarray, y: np.ndarray, fold: np.ndarray) -> np.ndarray:
    """One fixed-width byte string per row; its last byte keeps closing zeros."""
    width, n = bins.shape
    codes = np.empty((n, width + 13), np.uint8)
    codes[:, :width] = bins.T
    codes[:, width:width + 8] = np.ascontiguousarray(y, np.float64).view(np.uint8).reshape(n, 8)
    codes[:, width + 8:-1] = np.ascontiguousarray(fold, np.int32).view(np.uint8).reshape(n, 4)
    codes[:, -1] = 1
    return codes.view(f"S{width + 13}").ravel()


def _arrays(row, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins, labels and folds of a block."""
    return (np.frombuffer(row["bins"], np.uint8).reshape(width, row["n"]), np.frombuffer(row["y"], np.float64),
            np.frombuffer(row["fold"], np.int32))


def _find_cells(blocks: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Codes (sorted) and row counts of all cells; None where they are more than a task should hold."""
    most = min(MAX_CELLS, MAX_CELL_BYTES // (width + 13))

    def count(rows):
        codes, n = np.empty(0, f"S{width + 13}"), np.empty(0, np.int64)
        for row in rows:
            more, m = np.unique(_cell_codes(*_arrays(row, width)), return_counts=True)
            codes, at = np.unique(np.concatenate([codes, more]), return_inverse=True)
            n = np.bincount(at, np.concatenate([n, m]), len(codes)).astype(np.int64)
            if len(codes) > most:
                break
        yield from zip(codes.tolist(), n.tolist())
    per = blocks.sparkSession.createDataFrame(blocks.select("n", "bins", "y", "fold").rdd.mapPartitions(count), "cell binary, n long")
    found = per.groupBy("cell").agg(F.sum("n").alias("n")).limit(most + 1).collect()
    if len(found) > most:
        return None
    codes, n = np.array([bytes(r["cell"]) for r in found], f"S{width + 13}"), np.array([r["n"] for r in found], np.int64)
    order = codes.argsort()
    return codes[order], n[order]


class _Cells:
    """A task's view of all cells: bins, labels, folds, row counts and the rows each fold leaves."""

    def __init__(self, codes: np.ndarray, n: np.ndarray, starts: np.ndarray):
        width = codes.dtype.itemsize - 13
        raw = codes.view(np.uint8).reshape(len(codes), width + 13)
        self.bins = np.ascontiguousarray(raw[:, :width].T)
        self.y = np.ascontiguousarray(raw[:, width:width + 8]).view(np.float64).ravel()
        self.fold = np.ascontiguousarray(raw[:, width + 8:-1]).view(np.int32).ravel()
        self.n, self.starts = n.astype(float), starts
        self._rows: dict = {}

    def rows(self, held_out: int | None) -> _Rows:
        if held_out not in self._rows:
            self._rows[held_out] = _Rows({"bins": self.bins, "fold": self.fold, "y": self.y}, held_out, self.starts)
        return self._rows[held_out]

    def tree(self, job: Job, margin: np.ndarray, weight: np.ndarray, ends: np.ndarray, loss: str) -> Tree:
        """The next tree of a model, by the cells' weights."""
        c, mine, starts = job.candidate, self.rows(job.held_out), self.starts
        g, h = _gradients(margin[mine.rows].astype(float), self.y[mine.rows], loss)
        g, h = g * weight[mine.rows], h * weight[mine.rows]
        splits, leaf, sums, hist = [], np.zeros(len(mine.rows), np.int64), np.array([[g.sum()], [h.sum()]]), None
        while len(splits) < c.depth:
            if hist is None:
                hist = mine.histogram(g, h, leaf, 1, starts, ends)
            else:  # the smaller side is summed, the other one is what it leaves of the parent
                right = self.bins[splits[-1][0]][mine.rows] > splits[-1][1]
                less = int(2 * np.count_nonzero(right) <= len(right))
                part = mine.histogram(g, h, leaf >> 1, hist.shape[1], starts, ends, right if less else ~right)
                hist = np.stack([hist - part, part] if less else [part, hist - part], axis=2).reshape(2, -1, hist.shape[2])
            gain, cell, children = _best_split(hist, starts, ends, c.l2)
            if gain <= c.min_gain:
                break
            f = int(np.searchsorted(ends, cell, side="right"))
            splits.append((f, cell - int(starts[f])))
            sums = children.reshape(2, -1)
            leaf = leaf * 2 + (self.bins[f][mine.rows] > splits[-1][1])
        return Tree([f for f, _ in splits], [b for _, b in splits], _values(c, sums).tolist())


def _dealt(blocks: DataFrame, width: int, codes, n: np.ndarray, parts: int):
    """Rows as (cells, first row of each, keys) per task: sorted by cell and cut evenly, wherever a
    cell's rows end."""
    spark, total = blocks.sparkSession, int(n.sum())
    before = spark.sparkContext.broadcast((codes, n.cumsum() - n, n))

    def deal(row):
        table, first, size = before.value
        cell = np.searchsorted(table, _cell_codes(*_arrays(row, width)))
        key = np.frombuffer(row["key"], np.int64)
        at = first[cell] + (key.view(np.uint64) % size[cell].astype(np.uint64)).astype(np.int64)
        part = at * parts // total
        order = part.argsort(kind="stable")
        cuts = np.searchsorted(part[order], np.arange(parts + 1))
        for p in range(parts):
            rows = order[cuts[p]:cuts[p + 1]]
            if len(rows):
                yield p, (cell[rows].astype(np.int32), key[rows])

    def gather(pairs):
        held = [v for _, v in pairs]
        if held:
            cell, key = np.concatenate([c for c, _ in held]), np.concatenate([k for _, k in held])
            order = np.lexsort((key, cell))  # the sums do not depend on the order of arrival
            cells, first = np.unique(cell[order], return_index=True)
            yield cells, first, key[order]
    return blocks.rdd.flatMap(deal).partitionBy(parts, lambda p: p).mapPartitions(gather)


def _boost_cells(blocks: DataFrame, codes: np.ndarray, n: np.ndarray, jobs: Sequence[Job], models: list[Booster], staged: list[list],
                 starts: np.ndarray, ends: np.ndarray, rounds: int, loss: str, seed: int, survivors, stops: frozenset[int]) -> None:
    """Grow ``models`` and fill ``staged``: one job per chunk of rounds, whatever the rows."""
    sc = blocks.sparkSession.sparkContext
    cores, total = sc.defaultParallelism, int(n.sum())
    width, start = len(starts), models[0].start
    parts = max(1, min(cores, total // BLOCK_ROWS), -(-total // KEY_ROWS))
    keys = _dealt(blocks, width, codes, n, parts).persist(StorageLevel.MEMORY_AND_DISK)
    table = sc.broadcast((codes, n))

    # groups of one temperature; deep and shallow models alternate over them
    by_temperature: dict[float, list[int]] = {}
    for i in sorted(range(len(jobs)), key=lambda i: -jobs[i].candidate.depth):
        by_temperature.setdefault(jobs[i].candidate.bagging_temperature, []).append(i)
    share = -(-len(jobs) // min(len(jobs), 2 * cores))
    members: list[list[int]] = []
    for alike in by_temperature.values():
        count = -(-len(alike) // share)
        members += [alike[g::count] for g in range(count)]
    temperature = [jobs[m[0]].candidate.bagging_temperature for m in members]

    going = set(range(len(jobs)))
    state = sc.parallelize([(g, (m, None)) for g, m in enumerate(members)], len(members))
    done, old, step = 0, None, max(1, min(CHECKPOINT_ROUNDS, WEIGHT_BYTES // (8 * len(codes))))
    while done < rounds and going:
        upto = min([done + step, rounds, *[s for s in stops if s > done]])
        running = frozenset(going)
        wanted: dict[float, list[int]] = {}
        for g, m in enumerate(members):
            if temperature[g] and running & set(m):
                wanted.setdefault(temperature[g], []).append(g)

        def weigh(part, wanted=wanted, done=done, upto=upto):
            cells, first, key = part
            sums = {t: np.empty((upto - done, len(cells))) for t in wanted}
            for r in range(done, upto):
                draws = _exponentials(key, r, seed)
                for t in wanted:
                    sums[t][r - done] = np.add.reduceat(draws ** t if t != 1.0 else draws, first)
            for t, groups in wanted.items():
                for g in groups:
                    yield g, (cells, sums[t])

        def grow(item, running=running, done=done, upto=upto):
            g, values = item
            codes, n = table.value
            cells = _Cells(codes, n, starts)
            weights, held = np.zeros((upto - done, len(codes))), None
            # in the cells' order, so that a cell cut in two sums up alike every time
            for first, second in sorted(values, key=lambda v: (1, int(v[0][0])) if isinstance(v[0], np.ndarray) else (0, 0)):
                if isinstance(first, np.ndarray):
                    weights[:, first] += second
                else:
                    mine, held = first, second
            if not temperature[g]:
                weights[:] = n
            if held is None:
                held = {i: np.full(len(codes), start, np.float32) for i in mine}
            found, margins = {}, {}
            for i in mine:
                if i not in running:
                    continue
                margin, trees, sums, job = held[i].copy(), [], [], jobs[i]
                out = cells.fold == job.held_out if job.held_out is not None else None
                for r in range(upto - done):
                    t = cells.tree(job, margin, weights[r], ends, loss)
                    margin += np.array(t.values, np.float32)[_leaves(cells.bins, list(zip(t.features, t.bins)))]
                    trees.append(t)
                    if out is not None:
                        sums.append(tuple(_held_out_sums(margin[out], cells.y[out], cells.n[out], loss)))
                found[i], margins[i] = (trees, sums), margin
            return g, (mine, margins), found
        weights = keys.flatMap(weigh)
        state_of = state.union(weights).groupByKey(len(members), lambda g: g)
        grown = state_of.map(grow).persist(StorageLevel.MEMORY_AND_DISK)
        grown.checkpoint()
        for found in grown.map(lambda x: x[2]).collect():
            for i, (trees, sums) in found.items():
                models[i].trees += trees
                staged[i] += sums
        if old is not None:
            old.unpersist()
        old, state, done = grown, grown.map(lambda x: x[:2]), upto
        if survivors is not None and done in stops and done < rounds:
            going &= set(survivors(done, [s[-1] if len(s) == done else None for s in staged]))
    if old is not None:
        old.unpersist()
    keys.unpersist()


def boost(df: DataFrame, features: str, label: str, jobs: Sequence[Job], key: str, fold: str | None = None, rounds: int = 100,
          loss: str = "logistic", max_bins: int = 32, seed: int = 0,
          survivors: Callable[[int, list[tuple[float, float, float] | None]], set[int]] | None = None,
          stops: Sequence[int] | None = None) -> Boosted:
    """Train every job's model for ``rounds`` rounds in one loop.

    ``features`` is an array column (all of one length; NULL and NaN are missing, below every
    border), ``label`` 0/1 for ``loss="logistic"`` or a number for ``"squared"``; rows without
    label are left out.  ``fold`` numbers the folds that jobs hold out.  ``survivors(round,
    staged)`` may end models early: it gets the held-out sums after each round of ``stops`` (None:
    of all) and returns the numbers of the jobs that go on."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    df = cut_lineage(df.select(features, F.col(label).cast("double").alias(label), key, *([fold] if fold else [])))
    borders = borders_of(df, features, max_bins)
    stats = df.where(F.col(label).isNotNull()).agg(F.avg(label).alias("m"), F.count("*").alias("n")).first()
    mean = stats["m"] or 0.0
    start = mean if loss == "squared" else math.log((mean + 1e-9) / (1.0 - mean + 1e-9))
    models = [Booster(job, loss, start, borders) for job in jobs]
    staged: list[list] = [[] for _ in jobs]
    if not stats["n"] or not borders or not jobs:
        return Boosted(models, staged)

    jobs, width = list(jobs), len(borders)
    sizes = np.array([len(b) + 1 for b in borders])
    ends = sizes.cumsum()
    starts = ends - sizes
    asked = frozenset(range(1, rounds) if stops is None else stops) if survivors else frozenset()
    # full blocks: each one sends histograms of its own
    full = -(-stats["n"] // BLOCK_ROWS)
    blocks = cut_lineage(_blocks(df.coalesce(full) if full < df.rdd.getNumPartitions() else df, features, label, fold, key, borders))
    cells = _find_cells(blocks, width)
    if cells is not None:
        if len(cells[0]):
            _boost_cells(blocks, *cells, jobs, models, staged, starts, ends, rounds, loss, seed, survivors, asked)
        return Boosted(models, staged)
    n_blocks, cores = blocks.count(), spark.sparkContext.defaultParallelism
    groups = min(len(jobs), max(-(-len(jobs) // GROUP_MODELS), -(-cores // n_blocks)))
    # deep and shallow models alternate over the groups
    order = sorted(range(len(jobs)), key=lambda i: -jobs[i].candidate.depth)
    members = [order[g::groups] for g in range(groups)]

    def unit(row) -> dict:
        bins, y, fold = _arrays(row, width)
        return {"models": members[row["group"]], "bins": bins, "y": y, "fold": fold, "key": np.frombuffer(row["key"], np.int64),
                "margins": np.full((len(members[row["group"]]), len(y)), start, np.float32)}
    table = blocks.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    state = table.repartition(min(n_blocks * groups, max(4 * cores, n_blocks))).rdd.map(unit).persist(StorageLevel.MEMORY_AND_DISK)
    reducers = min(len(jobs), 4 * cores)
    going = set(range(len(jobs)))
    old = None
    for round_ in range(rounds + 1):
        splits: dict[int, list[tuple[int, int]]] = {i: [] for i in going} if round_ < rounds else {}
        sums: dict[int, np.ndarray] = {}
        for level in range(max((jobs[i].candidate.depth for i in splits), default=1)):
            live = {i: splits[i] for i in splits if len(splits[i]) == level < jobs[i].candidate.depth}
            if level and not live:
                break

            def partial(u, live=live, running=frozenset(going), level=level, round_=round_):
                if level == 0:
                    yield from _held_out(u, jobs, running, loss)
                yield from _Trainer(u, jobs, starts, ends, round_, loss, seed).partial(live)

            def choose(item):
                (i, kind), x = item
                return i, kind, x.tolist() if kind else _best_split(x, starts, ends, jobs[i].candidate.l2)
            for i, kind, found in state.flatMap(partial).reduceByKey(lambda a, b: a + b, reducers).map(choose).collect():
                if kind:
                    if round_:
                        staged[i].append(tuple(found))
                    continue
                gain, cell, children = found
                if level == 0:
                    sums[i] = children.sum(axis=2)
                if gain > jobs[i].candidate.min_gain:
                    f = int(np.searchsorted(ends, cell, side="right"))
                    splits[i].append((f, cell - int(starts[f])))
                    sums[i] = children.reshape(2, -1)
        if old is not None:
            old.unpersist()
            old = None
        if round_ == rounds:
            break
        if round_ in asked:
            going &= set(survivors(round_, [s[-1] if len(s) == round_ else None for s in staged]))
            if not going:
                break
        trees = {}
        for i in going:
            trees[i] = Tree([f for f, _ in splits[i]], [b for _, b in splits[i]], _values(jobs[i].candidate, sums[i]).tolist())
            models[i].trees.append(trees[i])
        old, state = state, state.map(lambda u, trees=trees: _advance(u, trees)).persist(StorageLevel.MEMORY_AND_DISK)
        if (round_ + 1) % CHECKPOINT_ROUNDS == 0:
            state.checkpoint()
    state.unpersist()
    return Boosted(models, staged)


@dataclass
class SearchResult:
    trials: list[dict]  # depth, learning_rate, l2, bagging_temperature, rounds, accuracy, loss, best (0/1)
    best: Candidate
    model: Booster  # the best candidate, fitted on all rows


def _folds_of(df: DataFrame, fold: str) -> list[int]:
    return sorted(r[0] for r in df.where(F.col(fold).isNotNull()).select(fold).distinct().limit(1000).collect())


def _trial(candidate: Candidate, results: Boosted, at: Sequence[int], rounds: int) -> dict:
    """Fold means of a candidate whose models are ``at``."""
    return {"depth": candidate.depth, "learning_rate": candidate.learning_rate, "l2": candidate.l2,
            "bagging_temperature": candidate.bagging_temperature, "rounds": rounds,
            "accuracy": float(np.mean([results.accuracy(i, rounds) for i in at])),
            "loss": float(np.mean([results.mean_loss(i, rounds) for i in at])), "best": 0}


def cross_validate(df: DataFrame, features: str, label: str, key: str, fold: str, candidates: Sequence[Candidate],
                   rounds: int = 100, loss: str = "logistic", seed: int = 0, halving: Sequence[int] = (),
                   keep: float = 0.5) -> list[dict]:
    """Fold means of every candidate, all trained in one loop (V3).

    ``halving`` are rounds after which only the best ``keep`` share of the candidates that are
    still running goes on (by held-out loss); the others report the rounds they got."""
    folds = _folds_of(df, fold)
    jobs = [Job(c, f) for c in candidates for f in folds]
    n = len(folds)

    def survivors(round_, staged):
        running = [c for c in range(len(candidates)) if staged[c * n] is not None]
        if round_ in halving:
            mean = {c: np.mean([s[2] / max(s[0], 1) for s in staged[c * n:c * n + n]]) for c in running}
            running = sorted(running, key=lambda c: (mean[c], c))[:max(1, math.ceil(len(running) * keep))]
        return {c * n + k for c in running for k in range(n)}
    results = boost(df, features, label, jobs, key, fold, rounds, loss, seed=seed,
                    survivors=survivors if halving else None, stops=halving)
    return [_trial(candidate, results, range(c * n, c * n + n), len(results.staged[c * n]))
            for c, candidate in enumerate(candidates) if n and results.staged[c * n]]


def grid_search(df: DataFrame, features: str, label: str, key: str, fold: str, grid: Sequence[Candidate], rounds: int = 100,
                loss: str = "logistic", seed: int = 0) -> SearchResult:
    """Every candidate on every fold for all rounds (V8); the best by accuracy (``squared``: by
    loss; ties: the first) is fitted again on all rows."""
    trials = cross_validate(df, features, label, key, fold, grid, rounds, loss, seed)
    quality = (lambda t: t["accuracy"]) if loss == "logistic" else (lambda t: -t["loss"])
    best = max(range(len(trials)), key=lambda i: (quality(trials[i]), -i))
    trials[best]["best"] = 1
    model = boost(df, features, label, [Job(grid[best])], key, fold, rounds, loss, seed=seed).models[0]
    return SearchResult(trials, grid[best], model)


def random_search(df: DataFrame, features: str, label: str, key: str, fold: str, bounds: dict[str, tuple[float, float]],
                  trials: int = 5, refine: int = 15, rounds: int = 100, loss: str = "logistic", seed: int = 0,
                  halving: Sequence[int] = (10, 25, 50)) -> SearchResult:
    """Search in continuous bounds (V9): ``trials`` random candidates, then ``refine`` guided ones
    in the half of the bounds around the best so far.  Both waves are successive halvings: bad
    trials end after few rounds.  The best is the least held-out loss of all trials that got
    every round, fitted again on all rows."""
    import random
    draw = random.Random(seed)

    def candidates(space, count):
        out = []
        for _ in range(count):
            values = {name: draw.uniform(lo, hi) for name, (lo, hi) in space.items()}
            out.append(Candidate(**{k: int(round(v)) if k == "depth" else v for k, v in values.items()}))
        return out
    first = candidates(bounds, trials)
    table = cross_validate(df, features, label, key, fold, first, rounds, loss, seed, halving)
    leader = min(range(len(table)), key=lambda i: (-table[i]["rounds"], table[i]["loss"]))
    near = {}
    for name, (lo, hi) in bounds.items():
        at, half = getattr(first[leader], name), (hi - lo) / 4
        near[name] = (max(lo, at - half), min(hi, at + half))
    second = candidates(near, refine)
    table += cross_validate(df, features, label, key, fold, second, rounds, loss, seed, halving)
    best = min(range(len(table)), key=lambda i: (-table[i]["rounds"], table[i]["loss"], i))
    table[best]["best"] = 1
    chosen = (first + second)[best]
    return SearchResult(table, chosen, boost(df, features, label, [Job(chosen)], key, fold, rounds, loss, seed=seed).models[0])


def staged_scores(model: Booster, features) -> Column:
    """Array of the scores after 1, 2, ... rounds, in one pass over the trees."""
    whole = model.trees
    steps = [Booster(model.job, model.loss, 0.0, model.borders, [t]).margin(features) for t in whole]
    start = F.struct(F.lit(float(model.start)).alias("m"), F.array().cast("array<double>").alias("s"))

    def step(state: Column, x: Column) -> Column:
        m = state["m"] + x
        value = F.lit(1.0) / (F.lit(1.0) + F.exp(-m)) if model.loss == "logistic" else m
        return F.struct(m.alias("m"), F.concat(state["s"], F.array(value)).alias("s"))
    return F.aggregate(F.array(*steps), start, step, lambda s: s["s"]) if steps else F.array().cast("array<double>")


def staged_thresholds(df: DataFrame, model: Booster, features: str, label: str, thresholds: Sequence[float]) -> DataFrame:
    """(round, threshold, tp, fp, fn, f1, logloss, best) of every boosting prefix and threshold on
    ``df`` (M2, M11): one pass scores all prefixes and counts classes per (round, bucket between
    thresholds); the running sums see rounds x thresholds rows only.  ``best`` marks the largest
    F1 (ties: fewer rounds, then the smaller threshold)."""
    from pyspark.sql import Window

    from ..sources.io import spread
    from .ranges import bucket_of
    grid = sorted({float(t) for t in thresholds})
    # a hold-out may come in few tasks (the lowest ranks of a sort), and scoring is dear
    rows = spread(df.where(F.col(label).isNotNull()).select(label, features), df.sparkSession.sparkContext.defaultParallelism)
    long = rows.select(F.col(label).cast("double").alias("y"), F.posexplode(staged_scores(model, features)).alias("r", "v"))
    sure = F.greatest(F.least(F.col("v"), F.lit(1 - 1e-15)), F.lit(1e-15))
    per = (long.select((F.col("r") + 1).alias("round"), bucket_of(F.col("v"), grid, "double").alias("at"), "y",
                       (-F.log(F.when(F.col("y") == 1, sure).otherwise(F.lit(1.0) - sure))).alias("l"))
           .groupBy("round", "at").agg(F.sum((F.col("y") == 1).cast("long")).alias("pos"), F.sum((F.col("y") != 1).cast("long")).alias("neg"),
                                       F.sum("l").alias("l")))
    spark = df.sparkSession
    cells = spark.range(1, len(model.trees) + 1).select(F.col("id").cast("int").alias("round")).crossJoin(
        spark.createDataFrame(list(enumerate([None, *grid])), "i int, threshold double"))
    per = cells.join(per.withColumnRenamed("round", "r2"), (F.col("round") == F.col("r2")) & (F.col("i") == F.col("at")), "left")
    whole = Window.partitionBy("round")  # one row per threshold
    above = whole.orderBy(F.desc("i")).rowsBetween(Window.unboundedPreceding, 0)
    zero = F.lit(0)
    tp, fp = F.coalesce(F.sum("pos").over(above), zero), F.coalesce(F.sum("neg").over(above), zero)
    n = F.sum(F.coalesce("pos", zero) + F.coalesce("neg", zero)).over(whole)
    out = per.select("round", "threshold", tp.alias("tp"), fp.alias("fp"), (F.coalesce(F.sum("pos").over(whole), zero) - tp).alias("fn"),
                     F.try_divide(F.sum("l").over(whole), n).alias("logloss")).where("threshold is not null")
    f1 = F.coalesce(F.try_divide(2.0 * F.col("tp"), 2.0 * F.col("tp") + F.col("fp") + F.col("fn")), F.lit(0.0))
    first = F.row_number().over(Window.partitionBy().orderBy(F.desc("f1"), "round", "threshold"))  # rounds x thresholds rows
    return out.withColumn("f1", f1).withColumn("best", (first == 1).cast("int"))


# executors need no copy of this package on their import path
cloudpickle.register_pickle_by_value(sys.modules[__name__])
