"""Boosted regression trees that grow leaf by leaf over binned features.

Every feature is cut into at most 255 bins, and rows are stored once as bytes. A tree grows
best-first: of all leaves the one whose best split gains most is split next. The sums of all
open leaves by feature and bin come from one Spark job, in which each task adds up its rows
and each (leaf, feature) picks its best split where its sums meet; only these picks reach the
driver. As the split of a leaf doesn't depend on the other leaves, a job looks ahead: it asks
for the children of all leaves that may still be split, so that a tree takes about as many
jobs as it is deep. Children of too few rows to be split are not asked for.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropweave.session import materialize

# Tasks use this module's functions: they travel with the job, wherever it is installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINS = 255
MISSING = 255  # the byte of a value that isn't there
#: Rounds after which the residuals are stored anew, so that a pass applies few trees.
STORED_EVERY = 10


@dataclass
class Split:
    """The best split of a leaf; rows up to ``bin`` go left, missing ones as stated."""

    gain: float
    feature: int
    bin: int
    missing_left: bool
    left_rows: int
    left_sum: float
    right_rows: int
    right_sum: float


@dataclass
class Tree:
    """Nodes in arrays; a leaf has feature -1, and its value is what it adds."""

    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    missing_left: list[bool] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)

    def add(self, value: float) -> int:
        """A new leaf."""
        for column, first in (
            (self.feature, -1), (self.bin, 0), (self.threshold, 0.0), (self.missing_left, False),
            (self.left, 0), (self.right, 0), (self.value, value), (self.gain, 0.0),
        ):
            column.append(first)
        return len(self.feature) - 1

    def split(self, node: int, by: Split, threshold: float, rate: float) -> tuple[int, int]:
        self.feature[node], self.bin[node], self.threshold[node] = by.feature, by.bin, threshold
        self.missing_left[node], self.gain[node] = by.missing_left, by.gain
        self.left[node] = self.add(rate * by.left_sum / by.left_rows)
        self.right[node] = self.add(rate * by.right_sum / by.right_rows)
        return self.left[node], self.right[node]

    def leaves(self, values: np.ndarray, binned: bool) -> np.ndarray:
        """The leaf of every row of a matrix of bins, or of plain values with NaN where missing."""
        feature, left, right = (np.array(x) for x in (self.feature, self.left, self.right))
        cut, missing_left = np.array(self.bin if binned else self.threshold), np.array(self.missing_left)
        node, rows = np.zeros(len(values), np.int64), np.arange(len(values))
        while len(rows):
            rows = rows[feature[node[rows]] >= 0]
            at = node[rows]
            own = values[rows, feature[at]]
            missing = own == MISSING if binned else np.isnan(own)
            goes_left = np.where(missing, missing_left[at], own <= cut[at])
            node[rows] = np.where(goes_left, left[at], right[at])
        return node

    def values(self, values: np.ndarray, binned: bool) -> np.ndarray:
        return np.array(self.value)[self.leaves(values, binned)]


def best_split(sums: np.ndarray, counts: np.ndarray, feature: int, least_rows: int) -> Split | None:
    """The split of largest gain, the lowest bin of equal ones; missing values go to either side.

    The last of the ``BINS`` + 1 places holds the missing rows.
    """
    total, rows = sums.sum(), counts.sum()
    found = None
    for missing_left in (False, True) if counts[MISSING] else (False,):
        left_sum = np.cumsum(sums[:BINS]) + (sums[MISSING] if missing_left else 0.0)
        left_rows = np.cumsum(counts[:BINS]) + (counts[MISSING] if missing_left else 0)
        right_sum, right_rows = total - left_sum, rows - left_rows
        valid = (left_rows >= least_rows) & (right_rows >= least_rows)
        # A cut behind an empty bin is the cut before it.
        valid &= counts[:BINS] > 0
        if not valid.any():
            continue
        with np.errstate(divide="ignore", invalid="ignore"):
            gains = left_sum**2 / left_rows + right_sum**2 / right_rows - total**2 / rows
        gains = np.where(valid, gains, -np.inf)
        at = int(np.argmax(gains))
        if found is None or gains[at] > found.gain:
            found = Split(float(gains[at]), feature, at, missing_left, int(left_rows[at]), float(left_sum[at]), int(right_rows[at]), float(right_sum[at]))
    return found


def bin_edges(rows: DataFrame, features: Column, width: int) -> list[np.ndarray]:
    """Upper edges of the bins of every feature: midway between neighbouring quantiles.

    A feature of at most ``BINS`` values has a bin for each. The quantiles are sketches that
    merge; the edges are one row.
    """
    points = [k / BINS for k in range(1, BINS + 1)]
    one = rows.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.get(features, i).alias("x")) for i in range(width)])).alias("c")).select("c.*")
    values = one.where(~F.isnan("x")).groupBy("i").agg(F.percentile_approx("x", points, 100 * BINS).alias("at"))
    edges = [np.zeros(0) for _ in range(width)]
    for row in values.collect():
        at = np.unique(row["at"])
        edges[row["i"]] = (at[:-1] + at[1:]) / 2
    return edges


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), width)


def _doubles(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _binned(rows: DataFrame, edges: Sequence[np.ndarray], base: float) -> DataFrame:
    """``bins`` and ``residual`` of every row."""
    width = len(edges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _doubles(batch.column("x"), width)
            bins = np.zeros((len(values), width), np.uint8)
            for i, own in enumerate(edges):
                bins[:, i] = np.where(np.isnan(values[:, i]), MISSING, np.searchsorted(own, values[:, i], side="left"))
            residual = batch.column("y").to_numpy(zero_copy_only=False) - base
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in bins], pa.binary()), pa.array(residual)], names=["bins", "residual"])

    return rows.mapInArrow(run, "bins binary, residual double")


def _with_residuals(rows: DataFrame, trees: Sequence[Tree], width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = _matrix(batch.column("bins"), width)
            left = batch.column("residual").to_numpy(zero_copy_only=False) - sum(t.values(bins, True) for t in trees)
            yield pa.RecordBatch.from_arrays([batch.column("bins"), pa.array(left)], names=["bins", "residual"])

    return rows.mapInArrow(run, "bins binary, residual double")


_SPLIT = "leaf int, feature int, gain double, bin int, missing_left boolean, left_rows long, left_sum double, right_rows long, right_sum double"


def _splits(
    rows: DataFrame, pending: Sequence[Tree], tree: Tree, wanted: Sequence[int], features: Sequence[int], width: int, least_rows: int, one_task: bool
) -> dict[int, Split]:
    """The best split of every wanted leaf of a growing tree, if it has one."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(len(tree.feature), -1)
        place[list(wanted)] = np.arange(len(wanted))
        shape = (len(wanted), len(features), BINS + 1)
        totals, counts = np.zeros(shape), np.zeros(shape, np.int64)
        for batch in batches:
            bins = _matrix(batch.column("bins"), width)
            residual = batch.column("residual").to_numpy(zero_copy_only=False) - sum(t.values(bins, True) for t in pending)
            at = place[tree.leaves(bins, True)]
            bins, residual, at = bins[at >= 0], residual[at >= 0], at[at >= 0]
            for k, i in enumerate(features):
                cell = at * (BINS + 1) + bins[:, i]
                size = len(wanted) * (BINS + 1)
                totals[:, k] += np.bincount(cell, residual, size).reshape(-1, BINS + 1)
                counts[:, k] += np.bincount(cell, minlength=size).reshape(-1, BINS + 1)
        leaf, k = np.nonzero(counts.any(axis=2))
        if len(leaf):
            columns = [np.array(wanted)[leaf], np.array(features)[k], totals[leaf, k], counts[leaf, k]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), *(pa.array([x.tobytes() for x in c], pa.binary()) for c in columns[2:])],
                names=["leaf", "feature", "totals", "counts"],
            )

    def picked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # At most a row of sums for each wanted leaf and feature is held.
        held: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for leaf, feature, *own in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                new = np.frombuffer(own[0]), np.frombuffer(own[1], np.int64)
                before = held.get((leaf, feature))
                held[leaf, feature] = (before[0] + new[0], before[1] + new[1]) if before else new
        best: dict[int, Split] = {}
        for leaf, feature in sorted(held):
            own = best_split(*held[leaf, feature], feature, least_rows)
            if own and (leaf not in best or own.gain > best[leaf].gain):
                best[leaf] = own
        names = [x.split(" ")[0] for x in _SPLIT.split(", ")]
        found = [{"leaf": leaf, **vars(own)} for leaf, own in best.items()]
        kinds = [pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.bool_(), pa.int64(), pa.float64(), pa.int64(), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array([x[n] for x in found], kind) for n, kind in zip(names, kinds, strict=True)], names=names)

    parts = rows.mapInArrow(sums, "leaf int, feature int, totals binary, counts binary")
    # The sums of one task are whole as they are; those of several meet by leaf and feature.
    parts = parts if one_task else parts.repartition("leaf", "feature")
    best: dict[int, Split] = {}
    # At most a row per wanted leaf and feature.
    for row in parts.mapInArrow(picked, _SPLIT).collect():
        own = Split(row.gain, row.feature, *row[3:])
        if row.leaf not in best or (-own.gain, own.feature) < (-best[row.leaf].gain, best[row.leaf].feature):
            best[row.leaf] = own
    return best


def grown(
    rows: DataFrame,
    pending: Sequence[Tree],
    edges: Sequence[np.ndarray],
    features: Sequence[int],
    leaves: int,
    rate: float,
    least_rows: int,
    one_task: bool = False,
) -> Tree | None:
    """One best-first tree over the residuals, or None if nothing can be split.

    ``one_task`` states that ``rows`` are a single partition, whose sums need no shuffle.
    """
    ahead = Tree()  # every split asked for so far, whether it is taken or not
    ahead.add(0.0)
    known: dict[int, Split | None] = {}
    open_leaves = [0]
    while True:
        if open_leaves:
            found = _splits(rows, pending, ahead, open_leaves, features, len(edges), least_rows, one_task)
            known |= {x: found.get(x) for x in open_leaves}
        taken, waiting = _taken(ahead, known, leaves)
        if not waiting:
            break
        # Those whose split is known and may be taken are split ahead; their children are asked for.
        open_leaves = []
        for node in waiting:
            split = known[node]
            edge = edges[split.feature]
            cut = edge[split.bin] if split.bin < len(edge) else np.inf
            for child, n in zip(ahead.split(node, split, float(cut), rate), (split.left_rows, split.right_rows), strict=True):
                # Too few rows for two leaves: no job is needed to know that there is no split.
                if n < 2 * least_rows:
                    known[child] = None
                else:
                    open_leaves.append(child)
    if not taken:
        return None
    tree = Tree()
    tree.add(0.0)
    at = {0: 0}
    for node in taken:
        split = known[node]
        edge = edges[split.feature]
        cut = edge[split.bin] if split.bin < len(edge) else np.inf
        own = tree.split(at[node], split, float(cut), rate)
        if ahead.feature[node] >= 0:
            at |= dict(zip((ahead.left[node], ahead.right[node]), own, strict=True))
    return tree


def _taken(ahead: Tree, known: dict[int, Split | None], leaves: int) -> tuple[list[int], list[int]]:
    """Nodes that best-first growth splits, in order, and those to look behind before it is sure.

    A leaf that was not split ahead hides children that might come before others in the order.
    All splittable leaves that may be among the remaining ones are looked behind at once.
    """
    frontier, taken = [0], []
    while len(taken) < leaves - 1:
        able = [x for x in frontier if known.get(x) is not None and known[x].gain > 1e-12]
        if not able:
            return taken, []
        node = min(able, key=lambda x: (-known[x].gain, x))
        taken.append(node)
        frontier.remove(node)
        if ahead.feature[node] < 0:
            if len(taken) == leaves - 1:
                return taken, []
            rest = sorted(able, key=lambda x: (-known[x].gain, x))[: leaves - len(taken)]
            return taken, [x for x in rest if ahead.feature[x] < 0]
        frontier += [ahead.left[node], ahead.right[node]]
    return taken, []


class LeafwiseBoosting(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol):
    """Squared-error boosting: ``rounds`` trees of at most ``leaves`` leaves, each times ``rate``.

    A tree sees a share of the features, drawn by ``seed`` and round, and all rows; a leaf has
    at least ``least_rows`` of them. Missing features need not be filled: at every split they
    go to the side that gains more. Rounds end early when no leaf can be split.
    """

    accepts_missing = True

    def __init__(
        self,
        rounds: int = 100,
        rate: float = 0.1,
        leaves: int = 51,
        feature_share: float = 0.8,
        least_rows: int = 20,
        seed: int = 42,
    ) -> None:
        super().__init__()
        self.rounds, self.rate, self.leaves = rounds, rate, leaves
        self.feature_share, self.least_rows, self.seed = feature_share, least_rows, seed

    def _fit(self, dataset: DataFrame) -> BoostedTrees:
        vector, label = F.col(self.getFeaturesCol()), F.col(self.getLabelCol())
        rows = dataset.select(vector_to_array(vector).alias("x"), label.cast("double").alias("y"))
        first = rows.agg(F.avg("y").alias("base"), F.max(F.size("x")).alias("width")).first()
        if first["base"] is None:
            raise ValueError("no training rows")
        base, width = first["base"], first["width"]
        edges = bin_edges(rows, F.col("x"), width)
        # Every round reads the stored rows several times: files of the size Spark aims at.
        even = rows.hint("rebalance")
        state, trees, pending = materialize(_binned(even, edges, base), "binned"), [], []
        one_task = state.rdd.getNumPartitions() == 1
        draw = np.random.default_rng(self.seed)
        n_features = max(1, round(self.feature_share * width))
        for _ in range(self.rounds):
            seen = sorted(draw.choice(width, n_features, replace=False).tolist())
            tree = grown(state, pending, edges, seen, self.leaves, self.rate, self.least_rows, one_task)
            if tree is None:
                break
            trees.append(tree)
            pending.append(tree)
            if len(pending) == STORED_EVERY:
                state, pending = materialize(_with_residuals(state, pending, width), "residuals"), []
                one_task = state.rdd.getNumPartitions() == 1
        return self._copyValues(BoostedTrees(base, width, trees))


class BoostedTrees(Model, HasFeaturesCol, HasPredictionCol):
    """Trees whose values add up to the prediction."""

    def __init__(self, base: float, width: int, trees: Sequence[Tree]) -> None:
        super().__init__()
        self.base, self.width, self.trees = base, width, list(trees)

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802
        """Share of all gains by feature."""
        gains = np.zeros(self.width)
        for tree in self.trees:
            for feature, gain in zip(tree.feature, tree.gain, strict=True):
                if feature >= 0:
                    gains[feature] += gain
        return Vectors.dense(gains / gains.sum() if gains.any() else gains)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        base, trees = self.base, self.trees

        @F.pandas_udf("double")
        def predicted(x):  # noqa: ANN001, ANN202
            import pandas as pd

            values = np.stack(x.to_numpy()) if len(x) else np.zeros((0, 1))
            return pd.Series(base + sum((t.values(values, False) for t in trees), np.zeros(len(x))))

        vector = vector_to_array(F.col(self.getFeaturesCol()))
        return dataset.withColumn(self.getPredictionCol(), predicted(vector))
