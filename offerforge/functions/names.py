"""Column names and column lists by type."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def normalized_name(name: str) -> str:
    """Lower case, trimmed, every run of characters other than letters and digits as one underscore."""
    return re.sub(r"[\W_]+", "_", name.strip().lower())


def normalize_names(df: DataFrame) -> DataFrame:
    """All columns renamed by ``normalized_name``; two columns that end up alike are an error."""
    names = [normalized_name(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"column names collide after normalisation: {', '.join(clashes)}")
    return df.toDF(*names)


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def non_string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if not isinstance(f.dataType, T.StringType)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def drop_columns(df: DataFrame, columns: list[str] | str) -> DataFrame:
    """Without the named columns; a name that is not there is an error, as a typo would otherwise go unseen."""
    columns = [columns] if isinstance(columns, str) else list(columns)
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"no such column: {', '.join(missing)}")
    return df.drop(*columns)


def lowercase_values(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Lower-cased values of the given columns, by default of all string columns."""
    columns = string_columns(df) if columns is None else columns
    return df.withColumns({c: F.lower(F.col(c)) for c in columns})


def feature_slice(df: DataFrame) -> DataFrame:
    """All columns but the first, which holds the key."""
    return df.select(*df.columns[1:])


def split_target(df: DataFrame, key: str, target: str) -> tuple[DataFrame, DataFrame]:
    """(features, key with target): the target stays out of feature work and comes back by key."""
    return df.drop(target), df.select(key, target)


def attach_target(features: DataFrame, targets: DataFrame, key: str) -> DataFrame:
    """Target column put back last, matched on the key."""
    return features.join(targets, key, "left")
