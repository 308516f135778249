"""Table profiles in long form: one row per column, from one aggregate over the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerforge.functions.names import string_columns


def _long(one_row: DataFrame, names: Sequence[str], label: str, fields: dict[str, Sequence[str]]) -> DataFrame:
    """One row per name from a single-row aggregate; ``fields`` maps a result column to its source columns."""
    entries = [
        F.struct(F.lit(name).alias(label), *[F.col(f"`{columns[i]}`").alias(out) for out, columns in fields.items()])
        for i, name in enumerate(names)
    ]
    return one_row.select(F.explode(F.array(*entries)).alias("_e")).select("_e.*")


def _aggregated(df: DataFrame, label: str, **measures) -> DataFrame:
    """Long form of one or more aggregates applied to every column of ``df``."""
    aggregates, fields = [], {}
    for out, make in measures.items():
        fields[out] = [f"{out}_{i}" for i in range(len(df.columns))]
        aggregates += [make(F.col(f"`{c}`"), c).alias(a) for c, a in zip(df.columns, fields[out])]
    return _long(df.agg(*aggregates), df.columns, label, fields)


def schema_profile(df: DataFrame, order_by: str) -> DataFrame:
    """(column, dtype, sample): the sample is the value in the first row under ``order_by``."""
    types = dict(df.dtypes)
    return _aggregated(
        df, "column",
        dtype=lambda value, name: F.first(F.lit(types[name])),
        sample=lambda value, name: F.min_by(value.cast("string"), F.col(order_by)),
    )


def value_text(df: DataFrame, name: str) -> Column:
    """Text that is equal for equal values; 0.0 and -0.0 count as one value."""
    value = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        value = value + F.lit(0.0)
    return value.cast("string")


def column_values(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct (column, value) pairs with their row count ``n``.

    The pairs are combined before the shuffle and spread by column and value, so no column, however frequent one
    of its values is, ends up in one task.
    """
    columns = df.columns if columns is None else columns
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), value_text(df, c).alias("value")) for c in columns])
    return df.select(F.explode(pairs).alias("_p")).groupBy("_p.column", "_p.value").agg(F.count(F.lit(1)).alias("n"))


def unique_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, num_unique_values), ascending; a missing value counts as one value."""
    return (
        column_values(df, columns)
        .groupBy("column")
        .agg(F.count(F.lit(1)).alias("num_unique_values"))
        .orderBy("num_unique_values", "column")
    )


def columns_by_cardinality(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(num_unique_values, columns): the string columns sharing a number of values, joined by commas."""
    counts = unique_counts(df, string_columns(df) if columns is None else columns)
    names = F.array_join(F.array_sort(F.collect_list("column")), ",")
    return counts.groupBy("num_unique_values").agg(names.alias("columns")).orderBy("num_unique_values")


def constant_or_key_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns with one value only or with as many values as rows, with the number of values."""
    counts = column_values(df, columns).groupBy("column").agg(
        F.count(F.lit(1)).alias("num_unique_values"), F.sum("n").alias("_rows")
    )
    return counts.filter(F.col("num_unique_values").isin(1) | (F.col("num_unique_values") == F.col("_rows"))).select(
        "column", "num_unique_values"
    ).orderBy("num_unique_values", "column")


def missing_percent(df: DataFrame) -> DataFrame:
    """(column_name, percent_missing), ascending."""
    return _aggregated(
        df, "column_name",
        percent_missing=lambda value, name: F.try_divide(F.count_if(value.isNull()) * 100.0, F.count(F.lit(1))),
    ).orderBy("percent_missing", "column_name")


def columns_with_missing(df: DataFrame) -> DataFrame:
    return missing_percent(df).filter(F.col("percent_missing") > 0)


def null_counts(df: DataFrame, label: str = "outlier") -> DataFrame:
    """(column, outlier): nulls per column, which after outlier masking is the number of outliers."""
    return _aggregated(df, "column", **{label: lambda value, name: F.count_if(value.isNull())})


def value_frequency(df: DataFrame, column: str) -> DataFrame:
    """(value, n, percent): count and share of each value among the rows that have one, most frequent first."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(
        F.count(F.lit(1)).alias("n")
    )
    total = counts.agg(F.sum("n").alias("total")).scalar()
    return counts.withColumn("percent", F.col("n") * 100.0 / total).orderBy(F.desc("n"), "value")
