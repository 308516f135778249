"""Propensity models: split, train, score, importance, accuracy. Forests are MLlib's, boosted trees those of ``boost``."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerforge.functions.names import numeric_columns
from offerforge.operators.boost import BoostedModel, fit_boosted
from offerforge.operators.encode import fit_labels, yes_no
from offerforge.operators.numeric import fit_stats
from offerforge.session import shared_folder

# Share of test rows and seed of the split, tree depth, boosting rounds, and the settings of the two
# kinds of boosted trees.
TEST_PERCENT = 20
SEED = 123
DEPTH = 6
ROUNDS = 10
MULTICLASS_STEP = 0.3
BINARY_STEP = 0.01
BINARY_SUBSAMPLE = 0.5
BINARY_CHILD_WEIGHT = 0.5
TOP_FEATURES = 9


def split_bucket(key: str) -> Column:
    """Number from 0 to 99 that depends on the key only."""
    return F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("bigint") % 100


def key_split(df: DataFrame, key: str = "customer_id", test_percent: int = TEST_PERCENT) -> tuple[DataFrame, DataFrame]:
    """(train, test) by a hash of the key: the same whatever the partitioning, and no customer is in both."""
    in_test = split_bucket(key) < test_percent
    return df.filter(~in_test), df.filter(in_test)


def random_split(df: DataFrame, test_percent: int = TEST_PERCENT, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    train, test = df.randomSplit([100.0 - test_percent, float(test_percent)], seed)
    return train, test


@dataclass(frozen=True)
class TrainedModel:
    """A fitted forest with its feature names, the stand-in for a missing value of each, and the labels."""

    model: Model | None
    features: tuple[str, ...]
    missing: tuple[float, ...]
    labels: tuple[str, ...]

    def assembled(self, df: DataFrame) -> DataFrame:
        known = df.select(
            "*",
            *[F.coalesce(F.col(c).cast("double"), F.lit(m)).alias(f"_x_{c}") for c, m in zip(self.features, self.missing)],
        )
        columns = [f"_x_{c}" for c in self.features]
        return VectorAssembler(inputCols=columns, outputCol="_features").transform(known).drop(*columns)

    def score(self, df: DataFrame, name: str = "probability") -> DataFrame:
        """Adds the array of class probabilities, in label order."""
        named = self.model.copy().setPredictionCol("_y").setRawPredictionCol("_r").setProbabilityCol("_p")
        return named.transform(self.assembled(df)).select(*df.columns, vector_to_array("_p").alias(name))

    def importance(self, n: int = TOP_FEATURES) -> DataFrame:
        """(feature, importance) of the n most important features."""
        weights = self.model.featureImportances.toArray()
        rows = sorted(zip(self.features, map(float, weights)), key=lambda item: (-item[1], item[0]))[:n]
        return SparkSession.active().createDataFrame(rows, "feature string, importance double")


def _stand_ins(df: DataFrame, features: Sequence[str]) -> tuple[float, ...]:
    """One below the minimum of each feature, so that a tree can part the missing values from the others."""
    stats = fit_stats(df, features)
    return tuple((stats[c].low or 0.0) - 1.0 for c in features)


def _fit(estimator: Estimator, shell: TrainedModel, df: DataFrame, label: Column) -> TrainedModel:
    """Fits the estimator on the assembled and cached table."""
    shared_folder(df.sparkSession)
    known = shell.assembled(df).select("_features", label.cast("double").alias("_label"))
    data = known.filter("_label is not null").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return replace(shell, model=estimator.fit(data))
    finally:
        data.unpersist()


def train_multiclass(
    df: DataFrame,
    target: str,
    key: str = "customer_id",
    features: Sequence[str] | None = None,
    backend: str = "boosted",
    depth: int = DEPTH,
    trees: int = 20,
    rounds: int = ROUNDS,
    step: float = MULTICLASS_STEP,
    seed: int = SEED,
    subset: str = "auto",
) -> TrainedModel | BoostedModel:
    """Class probabilities from trees over the numeric columns.

    ``boosted`` grows ``rounds`` trees per class that share one softmax (two classes share one tree). ``forest`` fits one
    random forest of ``trees`` trees, each split over a ``subset`` of the features (``all``, ``sqrt``, a share; MLlib's
    names).
    """
    features = tuple(features or [c for c in numeric_columns(df) if c not in (key, target)])
    labels = tuple(fit_labels(df, target))
    names = F.array(*[F.lit(v) for v in labels])
    place = F.array_position(names, F.col(target).cast("string"))
    code = F.when(place > 0, place - 1)
    if backend == "boosted":
        return fit_boosted(df, features, labels, code, F.col(key), depth, rounds, step)
    if backend == "forest":
        shell = TrainedModel(None, features, _stand_ins(df, features), labels)
        forest = RandomForestClassifier(
            labelCol="_label", featuresCol="_features", numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy=subset
        )
        return _fit(forest, shell, df, code)
    raise ValueError(f"unknown backend {backend}")


def train_binary(
    df: DataFrame,
    target: str,
    key: str = "customer_id",
    features: Sequence[str] | None = None,
    depth: int = DEPTH,
    rounds: int = ROUNDS,
    step: float = BINARY_STEP,
    subsample: float = BINARY_SUBSAMPLE,
    child_weight: float = BINARY_CHILD_WEIGHT,
) -> BoostedModel:
    """Boosted trees for a yes/no target; the second probability is that of ``yes``.

    ``child_weight`` is the least hessian of a leaf. Every tree, the first too, is shrunk by ``step``, so few rounds of a
    small step leave all scores near one half. A round's rows are a ``subsample`` by a hash of the key.
    """
    features = tuple(features or [c for c in numeric_columns(df) if c not in (key, target)])
    known = yes_no(df, target) if dict(df.dtypes)[target] == "string" else df
    return fit_boosted(
        known, features, ("no", "yes"), F.col(target), F.col(key), depth, rounds, step, child_weight, subsample)


def accuracy(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """(accuracy): percent of rows whose prediction is right, from a share rounded to four places."""
    hit = (F.col(actual) == F.col(predicted)).cast("int")
    return df.agg((F.round(F.avg(hit), 4) * 100).alias("accuracy"))
