"""Numeric features: quantiles and tiers, scaling, outliers, histograms, correlations."""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUARTILES = (0.0, 0.25, 0.5, 0.75, 1.0)
COLUMN_BLOCK = 256
"""Columns whose cross products a task holds at once."""


def exact_quantiles(
    df: DataFrame, column: str, probabilities: Sequence[float] = QUARTILES, rows_per_range: int = 500_000
) -> dict[float, float]:
    """Exact quantiles with linear interpolation, without bringing the column to one task.

    Rows are first reduced to value counts. The values are cut into ranges of about ``rows_per_range`` by
    approximate quantiles, which decide about balance only. The range totals, a few numbers, tell which ranges hold
    the wanted ranks; only these are ordered.
    """
    counts = (
        df.select(F.col(column).cast("double").alias("v")).filter("v is not null and not isnan(v)")
        .groupBy("v").agg(F.count(F.lit(1)).alias("n")).persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        distinct, total = counts.agg(F.count("v"), F.sum("n")).first()
        if distinct == 0:
            return {p: None for p in probabilities}
        ranges = math.ceil(distinct / rows_per_range)
        cuts = []
        if ranges > 1:
            marks = [i / ranges for i in range(1, ranges)]
            cuts = sorted(set(counts.agg(F.percentile_approx("v", marks, 10_000).alias("c")).first().c))
        bucketed = with_range_number(counts, "v", "b", cuts)
        totals = {0: total}
        if cuts:
            totals = {r.b: r.n for r in bucketed.groupBy("b").agg(F.sum("n").alias("n")).collect()}
        buckets = sorted(totals)
        ends = list(accumulate(totals[b] for b in buckets))
        wanted = {p: (ends[-1] - 1) * p for p in probabilities}
        ranks = sorted({r for w in wanted.values() for r in (math.floor(w), math.ceil(w))})
        before = dict(zip(buckets, [0, *ends]))
        picks = {r: buckets[bisect_right(ends, r)] for r in ranks}
        ordered = Window.partitionBy("b").orderBy("v")
        start = F.create_map(*[F.lit(x) for b in set(picks.values()) for x in (b, before[b])])[F.col("b")]
        running = bucketed.filter(F.col("b").isin(list(set(picks.values())))).withColumn(
            "to", F.sum("n").over(ordered) + start
        )
        hits = F.array(*[F.lit(r) for r in ranks])
        inside = F.filter(hits, lambda r: (r >= F.col("to") - F.col("n")) & (r < F.col("to")))
        found = {
            r.rank: r.v
            for r in running.filter(F.size(inside) > 0).select("v", F.explode(inside).alias("rank")).collect()
        }
    finally:
        counts.unpersist()
    out = {}
    for p, w in wanted.items():
        low, high = found[math.floor(w)], found[math.ceil(w)]
        out[p] = low + (high - low) * (w - math.floor(w))
    return out


def with_range_number(df: DataFrame, column: str, name: str, cuts: Sequence[float]) -> DataFrame:
    """Adds the number of cuts at or below the value; the value must not be missing."""
    if not cuts:
        return df.withColumn(name, F.lit(0))
    splits = [-math.inf, *cuts, math.inf]
    return Bucketizer(splits=splits, inputCol=column, outputCol=name).transform(df).withColumn(
        name, F.col(name).cast("int")
    )


def quantiles_approx(df: DataFrame, column: str, probabilities: Sequence[float] = QUARTILES,
                     accuracy: int = 10_000) -> dict[float, float]:
    """Mergeable approximate quantiles, one pass."""
    values = df.agg(F.percentile_approx(column, list(probabilities), accuracy).alias("q")).first().q
    return dict(zip(probabilities, values or [None] * len(probabilities)))


def tier_edges(quantiles: Mapping[float, float]) -> list[float]:
    """Ascending distinct edges."""
    return sorted({v for v in quantiles.values() if v is not None})


def tier_labels(edges: Sequence[float]) -> list[str]:
    """t0, t1, ... one fewer than the edges."""
    return [f"t{i}" for i in range(len(edges) - 1)]


def tier(value: Column, edges: Sequence[float]) -> Column:
    """Tier of a value: left-open right-closed ranges between the edges, ``unknown`` outside and on the lowest edge."""
    out = F.lit("unknown")
    for label, low, high in list(zip(tier_labels(edges), edges, edges[1:]))[::-1]:
        out = F.when((value > low) & (value <= high), label).otherwise(out)
    return out


def with_city_tier(df: DataFrame, population: str, edges: Sequence[float], name: str = "city_grp") -> DataFrame:
    """Tier column in place of the population column."""
    return df.withColumn(name, tier(F.col(population), edges)).drop(population)


@dataclass(frozen=True)
class ColumnStats:
    """Non-null count, mean, population standard deviation, minimum and maximum of a column."""

    count: int
    mean: float | None
    sd: float | None
    low: float | None
    high: float | None


def fit_stats(df: DataFrame, columns: Sequence[str]) -> dict[str, ColumnStats]:
    """Statistics of several columns from one aggregate, which partial sums make independent of any grouping."""
    makers = (F.count, F.avg, F.stddev_pop, F.min, F.max)
    row = df.agg(*[m(F.col(c).cast("double")).alias(f"{c}|{i}") for c in columns for i, m in enumerate(makers)]).first()
    return {c: ColumnStats(*[row[f"{c}|{i}"] for i in range(len(makers))]) for c in columns}


def stats_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same statistics as a long table (column, n, mean, sd, low, high)."""
    makers = {"n": F.count, "mean": F.avg, "sd": F.stddev_pop, "low": F.min, "high": F.max}
    one = df.agg(*[m(F.col(c).cast("double")).alias(f"{c}|{k}") for c in columns for k, m in makers.items()])
    entries = [F.struct(F.lit(c).alias("column"), *[F.col(f"`{c}|{k}`").alias(k) for k in makers]) for c in columns]
    return one.select(F.explode(F.array(*entries)).alias("_e")).select("_e.*")


def _lit(value) -> Column:
    return F.lit(None).cast("double") if value is None else F.lit(float(value))


def mask_outliers(df: DataFrame, stats: Mapping[str, ColumnStats], limit: float = 2.0) -> DataFrame:
    """NULL in place of values more than ``limit`` standard deviations away from the mean."""
    def masked(name: str, s: ColumnStats) -> Column:
        value = F.col(name).cast("double")
        score = F.abs(F.try_divide(value - _lit(s.mean), _lit(s.sd)))
        return F.when(~F.coalesce(score > limit, F.lit(False)), value)

    return df.withColumns({c: masked(c, s) for c, s in stats.items()})


def outlier_report(df: DataFrame, columns: Sequence[str], limit: float = 2.0) -> DataFrame:
    """(column, outlier): values masked as outliers plus values missing anyway."""
    from offerforge.operators.profile import null_counts

    return null_counts(mask_outliers(df.select(*columns), fit_stats(df, columns), limit))


def log_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Base-10 logarithm; NULL for zero and negative values."""
    return df.withColumns({c: F.log10(F.when(F.col(c) > 0, F.col(c))) for c in columns})


def standard_scale(df: DataFrame, stats: Mapping[str, ColumnStats]) -> DataFrame:
    """Distance from the mean in population standard deviations; NULL for a constant column."""
    return df.withColumns({c: F.try_divide(F.col(c) - _lit(s.mean), _lit(s.sd)) for c, s in stats.items()})


def minmax_scale(df: DataFrame, stats: Mapping[str, ColumnStats]) -> DataFrame:
    """Position between minimum and maximum; NULL for a constant column."""
    return df.withColumns(
        {c: F.try_divide(F.col(c) - _lit(s.low), _lit(s.high) - _lit(s.low)) for c, s in stats.items()}
    )


def custom_scale(
    df: DataFrame, stats: Mapping[str, ColumnStats], lower: float, upper: float, shift: bool = False
) -> DataFrame:
    """Position between the whole parts of minimum and maximum, times the width of [lower, upper].

    The result starts at 0; ``shift`` makes it start at ``lower``.
    """
    def scaled(name: str, s: ColumnStats) -> Column:
        low, high = (None if v is None else float(int(v)) for v in (s.low, s.high))
        share = F.try_divide(F.col(name) - _lit(low), _lit(high) - _lit(low))
        return share * float(upper - lower) + (float(lower) if shift else 0.0)

    return df.withColumns({c: scaled(c, s) for c, s in stats.items()})


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """(bin, low, high, n) of equally wide bins over the value range, the last bin closed, empty bins with n = 0."""
    s = fit_stats(df, [column])[column]
    if s.count == 0:
        return df.sparkSession.createDataFrame([], "bin bigint, low double, high double, n bigint")
    low, high = (s.low, s.high) if s.high > s.low else (s.low - 0.5, s.high + 0.5)
    width = (high - low) / bins
    number = F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1)).cast("bigint")
    counts = df.filter(F.col(column).isNotNull()).groupBy(number.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    edges = df.sparkSession.range(bins).select(
        F.col("id").alias("bin"), (low + F.col("id") * width).alias("low"), (low + (F.col("id") + 1) * width).alias("high")
    )
    return edges.join(counts, "bin", "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("bigint")).orderBy("bin")


def _cross_sums(df: DataFrame, left: Sequence[str], right: Sequence[str], centre: Mapping[str, float]) -> DataFrame:
    """Sums over the rows with both values, for every pair of a left and a later right column.

    A task holds six matrices of the two blocks' sizes and hands on one row per pair.
    """
    columns = list(dict.fromkeys([*left, *right]))
    place = {c: i for i, c in enumerate(columns)}
    same = list(left) == list(right)
    pairs = np.triu_indices(len(left), 1) if same else tuple(x.ravel() for x in np.indices((len(left), len(right))))
    first, second = np.array(left)[pairs[0]], np.array(right)[pairs[1]]
    at, to = [place[c] for c in left], [place[c] for c in right]
    middle = np.array([centre[c] for c in columns])

    def partial_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = None
        for batch in batches:
            values = batch.to_numpy(dtype=float) - middle
            known = (~np.isnan(values)).astype(float)
            values = np.nan_to_num(values)
            squares = values * values
            part = [known[:, at].T @ known[:, to], values[:, at].T @ known[:, to], known[:, at].T @ values[:, to],
                    squares[:, at].T @ known[:, to], known[:, at].T @ squares[:, to], values[:, at].T @ values[:, to]]
            sums = part if sums is None else [s + p for s, p in zip(sums, part)]
        if sums is not None:
            out = {"first": first, "second": second}
            out |= {k: s[pairs] for k, s in zip(("n", "sx", "sy", "sxx", "syy", "sxy"), sums)}
            yield pd.DataFrame(out)

    schema = "first string, second string, n double, sx double, sy double, sxx double, syy double, sxy double"
    return df.select(*[F.col(c).cast("double") for c in columns]).mapInPandas(partial_sums, schema)


def correlations(df: DataFrame, columns: Sequence[str], block: int = COLUMN_BLOCK) -> DataFrame:
    """(first, second, corr): Pearson correlation for every pair of columns, over the rows having both values.

    The first column stands before the second in ``columns``; the correlation is NULL when one of them is constant in
    those rows. Columns are taken in blocks, and every pair of blocks is a scan of its own that reads only their columns:
    each task adds up the cross products of its Arrow batches as matrices of at most ``block`` by ``block``, whatever the
    number of columns, and these sums are combined by pair. The number of aggregates does not grow the generated code, as
    it would with one covariance expression per pair, which is many times slower beyond a few columns.
    """
    columns = list(columns)
    centre = {c: s.mean or 0.0 for c, s in fit_stats(df, columns).items()}
    blocks = [columns[i : i + block] for i in range(0, len(columns), block)]
    parts = reduce(DataFrame.unionByName, [
        _cross_sums(df, left, right, centre) for i, left in enumerate(blocks) for right in blocks[i:]
        if left is not right or len(left) > 1 or len(blocks) == 1
    ])
    totals = parts.groupBy("first", "second").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    spread = [F.col(f"s{v}{v}") - F.try_divide(F.pow(f"s{v}", F.lit(2)), F.col("n")) for v in "xy"]
    # what is left of a constant column after cancellation is rounding noise, not spread
    spread = [F.when(s > 1e-12 * F.col(f"s{v}{v}"), s) for s, v in zip(spread, "xy")]
    shared = F.col("sxy") - F.try_divide(F.col("sx") * F.col("sy"), F.col("n"))
    return totals.select("first", "second", F.try_divide(shared, F.sqrt(spread[0] * spread[1])).alias("corr"))


def top_correlations(df: DataFrame, columns: Sequence[str], n: int = 5, absolute: bool = False) -> DataFrame:
    """The ``n`` pairs with the highest correlation, by sign or by absolute value; unknown ones last."""
    measure = F.abs("corr") if absolute else F.col("corr")
    return correlations(df, columns).orderBy(measure.desc_nulls_last(), "first", "second").limit(n)


def highly_correlated(df: DataFrame, columns: Sequence[str], threshold: float) -> DataFrame:
    """(column): those whose absolute correlation with a column before them is above the threshold."""
    strongest = correlations(df, columns).groupBy("second").agg(F.max(F.abs("corr")).alias("strongest"))
    return strongest.filter(F.col("strongest") > threshold).select(F.col("second").alias("column"))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Square correlation table: ``column`` and one column per name."""
    half = correlations(df, columns)
    spread = fit_stats(df, columns)
    own = df.sparkSession.createDataFrame(
        [(c, c, 1.0 if spread[c].sd else None) for c in columns], "first string, second string, corr double"
    )
    both = half.unionByName(half.select(F.col("second").alias("first"), F.col("first").alias("second"), "corr"))
    return (
        both.unionByName(own).groupBy(F.col("first").alias("column")).pivot("second", list(columns)).agg(F.first("corr"))
    )
