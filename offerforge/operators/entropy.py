"""Entropy trees from count tables, for the importance of numeric features to a label.

All trees grow together. A level is one pass: tasks count rows by (tree, node, feature, bin, label), Spark adds the
counts up, and each (tree, node, feature) of at most bins x labels counts gives its best cut. Of a node's features that
are not constant there the first few of a seeded order take part, so trees differ and reruns agree.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerforge.operators.boost import BINS, BoostedModel, Tree, binned_rows, binned_values, fit_bins

TREES = 5
TRIED = 2
"""Features tried at a node."""
DEPTH = 6

_COUNTS = "tree int, node int, feature int, bin int, label int, n long"
_CUTS = "tree int, node int, feature int, cut int, gain double, rows long"


def label_counts(rows: DataFrame, trees: Sequence[Tree], features: int, labels: int, level: int, bins: int = BINS) -> DataFrame:
    """``tree``, ``node``, ``feature``, ``bin``, ``label``, ``n`` of a level; tasks count first, at most one row per cell."""
    first, wide = (1 << level) - 1, 1 << level

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(trees), features, wide * bins * labels), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            cells, label, times = binned_values(batch.column(0)), batch.column(1).to_numpy(), batch.column(4).to_numpy()
            for t, tree in enumerate(trees):
                node = tree.nodes(cells) - first
                here = node >= 0
                for f in range(features):
                    at = (node[here] * bins + cells[here, f]) * labels + label[here]
                    counts[t, f] += np.bincount(at, times[here], wide * bins * labels).astype(np.int64)
        t, f, at = np.nonzero(counts)
        if len(t):
            columns = [t, first + at // (bins * labels), f, at // labels % bins, at % labels]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(x.astype(np.int32)) for x in columns], pa.array(counts[t, f, at])],
                names=["tree", "node", "feature", "bin", "label", "n"])

    cell = ["tree", "node", "feature"]
    return rows.mapInArrow(run, _COUNTS).repartition(*cell).groupBy(*cell, "bin", "label").agg(F.sum("n").alias("n"))


def _entropy(counts: np.ndarray) -> np.ndarray:
    """Entropy in bits along the last axis."""
    share = counts / np.maximum(counts.sum(axis=-1, keepdims=True), 1)
    return -(share * np.log2(np.where(share > 0, share, 1))).sum(axis=-1)


def _best_cut(cells: pa.Table) -> pa.Table:
    """Best cut of one feature at one node: rows up to its bin go left. No row where the feature is constant."""
    bins, place = np.unique(cells.column("bin").to_numpy(), return_inverse=True)
    label = cells.column("label").to_numpy()
    counts = np.zeros((len(bins), label.max() + 1))
    np.add.at(counts, (place, label), cells.column("n").to_numpy())
    left, whole = counts.cumsum(axis=0)[:-1], counts.sum(axis=0)
    n, part = whole.sum(), left.sum(axis=1)
    gains = _entropy(whole) - part / n * _entropy(left) - (n - part) / n * _entropy(whole - left)
    # equal but for rounding counts as equal, and then the first cut is taken
    best = int(np.argmax(gains >= gains.max() - 1e-12)) if len(gains) else 0
    row = {k: cells.column(k)[0].as_py() for k in ("tree", "node", "feature")} | {"rows": int(n)}
    row |= {"cut": int(bins[best]), "gain": float(gains[best])} if len(gains) else {"cut": 0, "gain": -1.0}
    row["gain"] = row["gain"] if _entropy(whole) > 0 else -1.0
    kinds = pa.schema([(k, pa.int32()) for k in ("tree", "node", "feature", "cut")] + [("gain", pa.float64()), ("rows", pa.int64())])
    return pa.Table.from_pylist([row], schema=kinds)


def best_cuts(counts: DataFrame, features: Sequence[str], seed: int, tried: int) -> DataFrame:
    """``tree``, ``node``, ``feature``, ``cut``, ``gain``, ``rows``: the split of each node that has one."""
    cuts = counts.groupBy("tree", "node", "feature").applyInArrow(_best_cut, _CUTS).filter("gain >= 0")
    name = F.get(F.array(*[F.lit(f) for f in features]), F.col("feature"))
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), "tree", "node", name).cast("binary"))
    drawn = cuts.withColumn("_r", F.row_number().over(Window.partitionBy("tree", "node").orderBy(draw, "feature")))
    order = Window.partitionBy("tree", "node").orderBy(F.round("gain", 12).desc(), "feature")
    return drawn.filter(F.col("_r") <= tried).withColumn("_r", F.row_number().over(order)).filter("_r = 1").drop("_r")


def tree_importances(
    df: DataFrame, code: Column, labels: int, features: Sequence[str], trees: int = TREES, tried: int = TRIED,
    depth: int = DEPTH, seed: int = 123, bins: int = BINS,
) -> np.ndarray:
    """Importance of each feature in each tree: its share of the entropy that the tree's splits take away.

    ``code`` is the place of a row's label, null for rows to leave out. A tree without a split has importances of 0.
    """
    cuts, n = fit_bins(df, features, bins)
    rows = binned_rows(df, BoostedModel(tuple(features), ("one", "other"), cuts), code, code, n)
    grown, taken = [Tree.empty(depth) for _ in range(trees)], np.zeros((trees, len(features)))
    for level in range(depth):
        splits = best_cuts(label_counts(rows, grown, len(features), labels, level, bins), features, seed, tried).collect()
        for s in splits:  # at most one row per tree and node
            tree = grown[s.tree]
            tree.feature[s.node], tree.cut[s.node], tree.missing_left[s.node] = s.feature, s.cut, True
            taken[s.tree, s.feature] += s.rows * s.gain
        if not splits:
            break
    whole = taken.sum(axis=1, keepdims=True)
    return taken / np.where(whole > 0, whole, 1)
