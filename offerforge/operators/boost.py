"""Boosted trees from aggregates: one softmax over all classes, second-order gains, every tree shrunk by the step.

Features are binned once. Rows alike in bins and label have the same margins throughout, so they are one row with their number,
unless a round takes a sample of them. A level of a round's trees, of all classes together, is one pass: tasks add up gradient and
hessian by (class, node, feature, bin), Spark adds the tasks' sums, forms running sums over the bins and keeps the best
split of each node. The driver sees one row per node. Sums are kept in whole units of 2^-24, so they do not depend on
the order of the rows: the same table gives the same model whatever its partitioning.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerforge.session import written

UNITS = 1 << 24
"""Units of a gradient or hessian in the sums."""
BINS = 64
"""Bins of a feature, the one of missing values included; 256 at most."""
SMOOTHING = 1.0
"""Added to the hessian of a leaf."""
LEAST_GAIN = 1e-6
ROWS_PER_TASK = 20_000

_ROWS = "bins binary, label int, id long, margins binary, n long"
_SUMS = "class int, node int, feature int, bin int, g long, h long"


@dataclass(frozen=True)
class Tree:
    """Nodes in heap order: feature (-1 for a leaf), last bin that goes left, side of missing values, value, gain."""

    feature: np.ndarray
    cut: np.ndarray
    missing_left: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    @staticmethod
    def empty(depth: int) -> Tree:
        n = (2 << depth) - 1
        return Tree(np.full(n, -1), np.zeros(n, np.int64), np.zeros(n, bool), np.zeros(n), np.zeros(n))

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """Node that each row of ``bins`` ends in."""
        node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        while True:
            feature = self.feature[node]
            inner = feature >= 0
            if not inner.any():
                return node
            bin_ = bins[rows, np.maximum(feature, 0)]
            left = np.where(bin_ == 0, self.missing_left[node], bin_ <= self.cut[node])
            node = np.where(inner, 2 * node + 2 - left, node)


@dataclass(frozen=True)
class BoostedModel:
    """Trees by round and class with the features' bin limits; two labels share one tree, that of the second label."""

    features: tuple[str, ...]
    labels: tuple[str, ...]
    cuts: tuple[tuple[float, ...], ...]
    rounds: tuple[tuple[Tree, ...], ...] = ()

    @property
    def outputs(self) -> int:
        return 1 if len(self.labels) == 2 else len(self.labels)

    def binned(self, columns: Sequence) -> np.ndarray:
        """Bin numbers by row and feature: 0 where missing, else one more than the number of limits below the value."""
        out = np.zeros((len(columns[0]), len(columns)), np.uint8)
        for i, (column, cuts) in enumerate(zip(columns, self.cuts)):
            values = np.asarray(column, np.float64)
            out[:, i] = np.where(np.isnan(values), 0, np.searchsorted(np.asarray(cuts), values, side="left") + 1)
        return out

    def margins(self, bins: np.ndarray, rounds: Sequence[tuple[Tree, ...]] | None = None) -> np.ndarray:
        """Margins by row and output of some rounds, all by default."""
        out = np.zeros((len(bins), self.outputs))
        for trees in self.rounds if rounds is None else rounds:
            for c, tree in enumerate(trees):
                out[:, c] += tree.value[tree.nodes(bins)]
        return out

    def score(self, df: DataFrame, name: str = "probability") -> DataFrame:
        """Adds the array of class probabilities, in label order."""
        model = self
        if len(self.labels) < 2:
            return df.withColumn(name, F.array(*[F.lit(1.0) for _ in self.labels]).cast("array<double>"))

        @F.pandas_udf("array<double>")
        def scored(values: pd.DataFrame) -> pd.Series:
            bins = model.binned([values.iloc[:, i] for i in range(values.shape[1])])
            return pd.Series(list(_probabilities(model.margins(bins))))

        known = [F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(self.features)]
        return df.withColumn(name, scored(F.struct(*known)))

    def importance(self, n: int = 9) -> DataFrame:
        """(feature, importance) of the n most important features: mean gain of a feature's splits, as a share."""
        gain, splits = np.zeros(len(self.features)), np.zeros(len(self.features))
        for tree in (t for trees in self.rounds for t in trees):
            inner = tree.feature >= 0
            np.add.at(gain, tree.feature[inner], tree.gain[inner])
            np.add.at(splits, tree.feature[inner], 1)
        mean = gain / np.maximum(splits, 1)
        share = mean / (mean.sum() or 1.0)
        rows = sorted(zip(self.features, map(float, share)), key=lambda item: (-item[1], item[0]))[:n]
        return SparkSession.active().createDataFrame(rows, "feature string, importance double")


def _probabilities(margins: np.ndarray) -> np.ndarray:
    if margins.shape[1] == 1:
        yes = 1.0 / (1.0 + np.exp(-margins[:, 0]))
        return np.stack([1.0 - yes, yes], axis=1)
    raised = np.exp(margins - margins.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def _gradients(margins: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of the log loss by row and output, in units; the softmax's second one is doubled, as a
    step changes all margins of a row at once."""
    chances = _probabilities(margins)
    if margins.shape[1] == 1:
        chances, hit, factor = chances[:, 1:], (labels == 1)[:, None], 1.0
    else:
        hit, factor = labels[:, None] == np.arange(margins.shape[1]), 2.0
    return np.rint((chances - hit) * UNITS), np.rint(factor * chances * (1.0 - chances) * UNITS)


def fit_bins(df: DataFrame, features: Sequence[str], bins: int = BINS) -> tuple[tuple[tuple[float, ...], ...], int]:
    """Limits of each feature's bins (distinct quantiles, fewer than ``bins``, from one sketch per feature) and the number
    of rows."""
    marks = [i / (bins - 2) for i in range(1, bins - 1)]
    known = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in features]
    found = df.agg(*[F.percentile_approx(c, marks, 10_000).alias(f"_q{i}") for i, c in enumerate(known)], F.count("*")).first()
    return tuple(tuple(sorted(set(found[i] or ()))) for i in range(len(features))), found[-1]


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    """Rows of equally long binary values as a matrix."""
    _, ends, data = column.buffers()
    size = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    ends = np.frombuffer(ends, size)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].view(kind).reshape(len(column), -1)


def _binary(rows: np.ndarray) -> pa.Array:
    """Each row of a matrix as a binary value."""
    wide = rows.shape[1] * rows.itemsize
    ends = np.arange(0, (len(rows) + 1) * wide, wide, dtype=np.int32) if wide else np.zeros(len(rows) + 1, np.int32)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(rows))])


def binned_values(column: pa.Array) -> np.ndarray:
    return _matrix(column, np.uint8)


def binned_rows(df: DataFrame, model: BoostedModel, label: Column, key: Column, n: int, alike: bool = True) -> DataFrame:
    """Bins, label, id, empty margins and number ``n`` of the rows with a label, dealt out evenly to as many tasks as they are
    worth and there are cores for, and written once. Rows ``alike`` in bins and label are one row, without an id; else every
    row stands for itself."""
    rows = df.select(*[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(model.features)],
                     label.cast("int").alias("label"), F.xxhash64(key).alias("id")).where("label IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = model.binned([c.to_numpy(zero_copy_only=False) for c in batch.columns[:-2]])
            yield pa.RecordBatch.from_arrays([_binary(bins), *batch.columns[-2:]], names=["bins", "label", "id"])

    made = rows.mapInArrow(run, "bins binary, label int, id long")
    if alike:
        made = written(made.groupBy("bins", "label").agg(F.lit(0).cast("bigint").alias("id"), F.count("*").alias("n")))
        n = made.count()
    else:
        made = made.withColumn("n", F.lit(1).cast("bigint"))
    nothing = F.lit(bytes(8 * model.outputs)).alias("margins")
    spark = df.sparkSession
    most = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    parts = min(most, n // ROWS_PER_TASK + 1)
    return written(made.select("bins", "label", "id", nothing, "n").repartition(parts))


def advanced(rows: DataFrame, model: BoostedModel) -> DataFrame:
    """``rows`` with the last round added to their margins, so that no pass walks more than one round of trees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                margins = _matrix(batch.column(3), np.float64) + model.margins(binned_values(batch.column(0)), model.rounds[-1:])
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:3], _binary(margins), batch.column(4)], names=batch.schema.names)

    return written(rows.mapInArrow(run, _ROWS))


def _in_sample(ids: np.ndarray, round_: int, share: float) -> np.ndarray:
    """Rows of a round's sample, by a hash of id and round."""
    mixed = (ids.view(np.uint64) ^ np.uint64(round_ * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    return (mixed * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(11)).astype(np.float64) < share * float(1 << 53)


def gradient_sums(
    rows: DataFrame, model: BoostedModel, trees: Sequence[Tree], level: int, bins: int = BINS, share: float = 1.0
) -> DataFrame:
    """``class``, ``node``, ``feature``, ``bin``, ``g``, ``h``: sums of a level of the trees being grown, in units.

    Each task adds its rows up first and gives at most one row per cell. Rows that have ended in a leaf take no part.
    """
    first, wide, features = (1 << level) - 1, 1 << level, len(model.features)
    round_ = len(model.rounds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, model.outputs, features, wide * bins))
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, times = batch.column(2).to_numpy(), batch.column(4).to_numpy()
            kept = _in_sample(ids, round_, share) if share < 1.0 else np.ones(len(ids), bool)
            cells = binned_values(batch.column(0))[kept]
            both = _gradients(_matrix(batch.column(3), np.float64)[kept], batch.column(1).to_numpy()[kept])
            both = [values * times[kept][:, None] for values in both]
            for c, tree in enumerate(trees):
                node = tree.nodes(cells) - first
                here = node >= 0
                place = node[here] * bins
                for f in range(features):
                    at = place + cells[here, f]
                    for part, values in enumerate(both):
                        sums[part, c, f] += np.bincount(at, values[here, c], wide * bins)
        c, f, at = np.nonzero(sums[1])
        if len(c):
            g, h = (s[c, f, at].astype(np.int64) for s in sums)
            columns = [c, first + at // bins, f, at % bins]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(x.astype(np.int32)) for x in columns], pa.array(g), pa.array(h)],
                names=["class", "node", "feature", "bin", "g", "h"])

    cell = ["class", "node", "feature"]
    return rows.mapInArrow(run, _SUMS).repartition(*cell).groupBy(*cell, "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))


def best_splits(sums: DataFrame, child_weight: float) -> DataFrame:
    """``class``, ``node``, ``best``: per node the split of largest gain, the first feature and bin on a tie.

    ``best`` has gain, feature, cut and side of missing values, gradient and hessian of the left side and of the node. A
    node without a split whose sides both reach ``child_weight`` has a gain of -1.
    """
    whole = "PARTITION BY class, node, feature"
    upto = f"{whole} ORDER BY bin ROWS UNBOUNDED PRECEDING"
    known = sums.selectExpr(
        "class", "node", "feature", "bin", f"sum(g) OVER ({whole}) AS gs", f"sum(h) OVER ({whole}) AS hs",
        f"sum(if(bin = 0, g, 0)) OVER ({whole}) AS gm", f"sum(if(bin = 0, h, 0)) OVER ({whole}) AS hm",
        f"sum(if(bin > 0, g, 0)) OVER ({upto}) AS gu", f"sum(if(bin > 0, h, 0)) OVER ({upto}) AS hu")
    sides = known.selectExpr("*", "explode(array(0L, 1L)) AS side").selectExpr(
        "*", "gu + side * gm AS gl", "hu + side * hm AS hl", "gs - gu - side * gm AS gr", "hs - hu - side * hm AS hr")

    def gain(side: str) -> str:
        return f"pow(g{side} / {UNITS}D, 2) / (h{side} / {UNITS}D + {SMOOTHING!r}D)"

    fits = f"least(hl, hr) > 0 AND least(hl, hr) >= {child_weight * UNITS!r}D"
    value = f"if({fits}, {gain('l')} + {gain('r')} - {gain('s')}, -1D)"
    return sides.groupBy("class", "node").agg(F.expr(
        f"max(struct({value} AS gain, -feature AS minus_feature, -bin AS minus_cut, side = 1 AS missing_left, gl, hl, gs, hs))"
    ).alias("best"))


def grow(
    rows: DataFrame, model: BoostedModel, depth: int, step: float, child_weight: float, bins: int = BINS, share: float = 1.0
) -> tuple[Tree, ...]:
    """The trees of one more round, one per output, level by level."""
    trees = tuple(Tree.empty(depth) for _ in range(model.outputs))
    for level in range(depth):
        splits = best_splits(gradient_sums(rows, model, trees, level, bins, share), child_weight).collect()
        open_ = False
        for c, node, best in splits:  # at most one row per node of the level
            tree = trees[c]

            def leaf(at: int, g: int, h: int, tree: Tree = tree) -> None:
                tree.value[at] = -step * (g / UNITS) / (h / UNITS + SMOOTHING)

            leaf(node, best.gs, best.hs)
            if best.gain > LEAST_GAIN:
                tree.feature[node], tree.cut[node] = -best.minus_feature, -best.minus_cut
                tree.missing_left[node], tree.gain[node] = best.missing_left, best.gain
                leaf(2 * node + 1, best.gl, best.hl)
                leaf(2 * node + 2, best.gs - best.gl, best.hs - best.hl)
                open_ = True
        if not open_:
            break
    return trees


def fit_boosted(
    df: DataFrame,
    features: Sequence[str],
    labels: Sequence[str],
    code: Column,
    key: Column,
    depth: int,
    rounds: int,
    step: float,
    child_weight: float = 1.0,
    subsample: float = 1.0,
    bins: int = BINS,
) -> BoostedModel:
    """Fits ``rounds`` trees per output. ``code`` is the place of a row's label, null for rows to leave out; ``key``
    decides on the sample of a round, so reruns agree."""
    cuts, n = fit_bins(df, features, bins)
    model = BoostedModel(tuple(features), tuple(labels), cuts)
    if len(labels) < 2:
        return model
    rows = binned_rows(df, model, code, key, n, alike=subsample >= 1.0)
    for number in range(rounds):
        model = replace(model, rounds=(*model.rounds, grow(rows, model, depth, step, child_weight, bins, subsample)))
        if number + 1 < rounds:
            rows = advanced(rows, model)
    return model
