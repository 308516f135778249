"""Statistics and choices within one row, as plain column arithmetic so that they stay in generated code."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INCOME_OF_GRADUATES = 400000


def row_statistics(df: DataFrame, columns: Sequence[str], prefix: str, median: str = "positional") -> DataFrame:
    """Adds ``<prefix>_mean, _variance, _sd, _median, _skew, _peak, _below`` over a group of columns.

    Variance is the population variance. The ``positional`` median takes the middle column(s) in the given
    order, ``sorted`` the middle value(s). Skew is Pearson's second coefficient, NULL when all values are alike.
    ``_below`` counts the values under the mean and the peak is never under 0.
    """
    n = len(columns)
    values = [F.col(c).cast("double") for c in columns]
    mean = f"{prefix}_mean"
    if median == "positional":
        middle = values[n // 2] if n % 2 else (values[n // 2 - 1] + values[n // 2]) / 2
    elif median == "sorted":
        ordered = F.array_sort(F.array(*values))
        at = [F.get(ordered, F.lit(i)) for i in ((n - 1) // 2, n // 2)]
        middle = (at[0] + at[1]) / 2
    else:
        raise ValueError(f"unknown median {median}")
    df = df.withColumn(mean, reduce(add, values) / n)
    df = df.withColumns(
        {
            f"{prefix}_variance": reduce(add, [F.pow(v - F.col(mean), 2) for v in values]) / n,
            f"{prefix}_median": middle,
            f"{prefix}_peak": F.greatest(F.lit(0.0), *values),
            f"{prefix}_below": reduce(add, [F.when(F.col(mean) > v, 1).otherwise(0) for v in values]),
        }
    )
    df = df.withColumn(f"{prefix}_sd", F.sqrt(f"{prefix}_variance"))
    return df.withColumn(
        f"{prefix}_skew", F.try_divide(3 * (F.col(mean) - F.col(f"{prefix}_median")), F.col(f"{prefix}_sd"))
    )


def with_churn_score(
    df: DataFrame, amounts: Sequence[str], counts: Sequence[str], median: str = "positional",
    name: str = "transactions_churn_analysis",
) -> DataFrame:
    """Churn score .8, .5 or .3 from how two groups of monthly columns fall below their mean with positive skew."""
    keep = df.columns
    df = row_statistics(row_statistics(df, amounts, "_g1", median), counts, "_g2", median)
    below1, below2, skew1, skew2 = (F.col(c) for c in ("_g1_below", "_g2_below", "_g1_skew", "_g2_skew"))
    both = (below1 >= 4) & (below2 >= 4) & (skew1 > 0) & (skew2 > 0)
    either = ((below1 > 4) & (skew1 > 0)) | ((below2 > 4) & (skew2 > 0))
    return df.withColumn(name, F.when(both, 0.8).when(either, 0.5).otherwise(0.3)).select(*keep, name)


def argmax_category(columns: Sequence[str]) -> Column:
    """Name, up to its first underscore, of the first column holding the largest value.

    The largest value is taken as at least 0, so a row with negative values only has no category.
    """
    peak = F.greatest(F.lit(0.0), *[F.col(c).cast("double") for c in columns])
    return F.coalesce(*[F.when(F.col(c).cast("double") == peak, c.split("_")[0]) for c in columns])


def education_label(income: Column) -> Column:
    return F.when(income < INCOME_OF_GRADUATES, "Not Graduate").otherwise("Graduate")


def keyed_choice(key: Column, values: Sequence[str], salt: str = "") -> Column:
    """One of ``values`` picked by a hash of the key: evenly spread, and the same on every run."""
    number = F.conv(F.substring(F.md5(F.concat(F.lit(salt), key.cast("string"))), 1, 8), 16, 10).cast("bigint")
    return F.get(F.array(*[F.lit(v) for v in values]), (number % len(values)).cast("int"))
