"""Category handling: rare values, integer codes, one-hot columns, encoder choice, targets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerforge.functions.names import string_columns
from offerforge.operators.profile import column_values
from offerforge.operators.tables import lookup_join
from offerforge.session import BROADCAST_ROWS, written

MAX_CATEGORIES = 1000
RARE_PERCENT = 0.1
MAX_LABELS = 1000


def fit_categories(
    df: DataFrame, columns: Sequence[str], max_categories: int = MAX_CATEGORIES
) -> dict[str, list[str | None]]:
    """Sorted values per column, None last where a value is missing; an error beyond ``max_categories`` values.

    These lists become columns or literals of a plan, so they have to be short.
    """
    return _listed(column_values(df, columns), columns, max_categories) if columns else {}


def _listed(pairs: DataFrame, columns: Sequence[str], max_categories: int) -> dict[str, list[str | None]]:
    """Value lists from (column, value) pairs; no more rows than the lists may hold are fetched."""
    room = max_categories * len(columns)
    rows = pairs.select("column", "value").limit(room + 1).collect()
    out = {c: sorted((r.value for r in rows if r.column == c), key=lambda v: (v is None, v)) for c in columns}
    if len(rows) > room or any(len(values) > max_categories for values in out.values()):
        raise ValueError(f"more than {max_categories} categories in one of {', '.join(columns)}")
    return out


def fit_frequent_values(df: DataFrame, columns: Sequence[str], percent: float = RARE_PERCENT) -> dict[str, list[str]]:
    """Values with a share above ``percent``, per column: by definition fewer than 100 / percent of them."""
    counts = column_values(df, columns).filter("value is not null").persist()
    totals = counts.groupBy("column").agg(F.sum("n").alias("total"))
    kept = counts.join(F.broadcast(totals), "column").filter(F.col("n") * 100.0 / F.col("total") > percent).collect()
    counts.unpersist()
    return {c: sorted(r.value for r in kept if r.column == c) for c in columns}


def group_rare(df: DataFrame, frequent: Mapping[str, Sequence[str]], other: str = "others") -> DataFrame:
    """``others`` in place of the values that are not frequent; missing stays missing."""
    def grouped(name: str, values: Sequence[str]) -> Column:
        return F.when(F.col(name).isNull() | F.col(name).isin(list(values)), F.col(name)).otherwise(other)

    return df.withColumns({c: grouped(c, v) for c, v in frequent.items()})


def code_categories(df: DataFrame, categories: Mapping[str, Sequence[str | None]]) -> DataFrame:
    """Integer code of each value by its position in the fitted list; a value not seen at fit time is NULL."""
    def code(name: str, values: Sequence[str | None]) -> Column:
        known = [v for v in values if v is not None]
        place = F.array_position(F.array(*[F.lit(v) for v in known]).cast("array<string>"), F.col(name).cast("string"))
        out = F.when(place > 0, place - 1)
        if None in values:
            out = F.when(F.col(name).isNull(), len(known)).otherwise(out)
        return out.cast("bigint")

    return df.withColumns({c: code(c, v) for c, v in categories.items()})


def code_table(df: DataFrame, column: str, order_by: str | None = None, ranges: int | None = None) -> DataFrame:
    """(value, code) for a column of any cardinality, codes from 0 by value or by first appearance under ``order_by``.

    A missing value has a code too, the last one by value. Spark deals the values out by ranges of their order, from a
    sample of its own, and sorts each range; a value's place in its range and the sizes of the ranges before it make the
    code. Nothing is fetched, and the plan has the same size whatever the number of values; ``ranges`` forces a number.
    """
    order = F.min(order_by) if order_by else F.min(F.col(column))
    values = df.groupBy(F.col(column).alias("value")).agg(order.alias("_at"))
    by = [F.col("_at").asc_nulls_last(), F.col("value").asc_nulls_last()]
    dealt = values.repartitionByRange(ranges, *by) if ranges else values.repartitionByRange(*by)
    # the high bits of a row's number are its partition's, the low ones its place in the partition
    number = F.monotonically_increasing_id()
    place = number.bitwiseAND(F.lit((1 << 33) - 1))
    ranged = written(dealt.sortWithinPartitions(*by).select("value", F.shiftright(number, 33).alias("_r"), place.alias("_place")))
    sizes = ranged.groupBy("_r").agg(F.count(F.lit(1)).alias("_n"))  # one row per range
    before = sizes.select("_r", (F.sum("_n").over(Window.orderBy("_r")) - F.col("_n")).alias("_before"))
    return ranged.join(F.broadcast(before), "_r").select("value", (F.col("_before") + F.col("_place")).alias("code"))


def code_by_table(df: DataFrame, column: str, codes: DataFrame, max_broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Column replaced by its code from a ``code_table``, for columns with too many values for literals."""
    tagged = df.withColumns({"_null": F.col(column).isNull(), "_v": F.coalesce(F.col(column).cast("string"), F.lit(""))})
    lookup = written(codes).select(
        F.col("value").isNull().alias("_null"), F.coalesce(F.col("value").cast("string"), F.lit("")).alias("_v"), "code"
    )
    out = lookup_join(tagged, lookup, ["_null", "_v"], max_broadcast_rows)
    return out.select(*[F.col("code").alias(c) if c == column else F.col(c) for c in df.columns])


def one_hot(df: DataFrame, categories: Mapping[str, Sequence[str | None]]) -> DataFrame:
    """Columns ``<column>_<value>`` of 0 and 1 behind the other columns; a missing value is 0 in all of them."""
    rest = [F.col(f"`{c}`") for c in df.columns if c not in categories]
    flags = [
        F.coalesce(F.col(c).cast("string") == v, F.lit(False)).cast("int").alias(f"{c}_{v}")
        for c, values in categories.items()
        for v in values
        if v is not None
    ]
    return df.select(*rest, *flags)


@dataclass(frozen=True)
class EncoderPlan:
    """Fitted category lists: columns to be coded and columns to be spread."""

    coded: dict[str, list[str | None]] = field(default_factory=dict)
    spread: dict[str, list[str | None]] = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        return one_hot(code_categories(df, self.coded), self.spread)


def fit_encoders(
    df: DataFrame, code_at: Sequence[int] = (2,), spread_at: Sequence[int] = (5,), columns: Sequence[str] | None = None
) -> EncoderPlan:
    """Encoder per string column by its number of values; columns with another number stay as they are.

    A sketch rules out columns whose number of values is far from the wanted ones, so the values of keys and free text are
    not shuffled; the others are counted exactly. Only the lists of the chosen columns are fetched.
    """
    columns = string_columns(df) if columns is None else list(columns)
    if not columns:
        return EncoderPlan()
    guessed = df.agg(*[F.approx_count_distinct(F.col(f"`{c}`")).alias(c) for c in columns]).first().asDict()
    far = 2 * max([*code_at, *spread_at]) + 100  # many times the sketch's error
    columns = [c for c in columns if guessed[c] <= far]
    if not columns:
        return EncoderPlan()
    pairs = column_values(df, columns).persist()
    try:
        counted = pairs.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()
        counts = {r.column: r.n for r in counted}
        chosen = [c for c in columns if counts.get(c) in {*code_at, *spread_at}]
        values = _listed(pairs.filter(F.col("column").isin(chosen)), chosen, MAX_CATEGORIES) if chosen else {}
    finally:
        pairs.unpersist()
    return EncoderPlan(
        coded={c: values[c] for c in chosen if counts[c] in code_at},
        spread={c: values[c] for c in chosen if counts[c] in spread_at and counts[c] not in code_at},
    )


def yes_no(df: DataFrame, column: str) -> DataFrame:
    """1 for ``yes``, 0 for anything else, also for a missing value."""
    return df.withColumn(column, F.coalesce(F.col(column) == "yes", F.lit(False)).cast("int"))


def fit_labels(df: DataFrame, column: str, max_labels: int = MAX_LABELS) -> list[str]:
    """Sorted labels of a target column, for a model that has an output for each; an error beyond ``max_labels``."""
    found = column_values(df, [column]).filter("value is not null").select("value").limit(max_labels + 1).collect()
    if len(found) > max_labels:
        raise ValueError(f"more than {max_labels} labels in {column}")
    return sorted(r.value for r in found)


def encode_labels(df: DataFrame, column: str, max_broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Labels replaced by their place in the order of all labels, however many; a missing label stays missing."""
    codes = code_table(df.filter(F.col(column).isNotNull()), column)
    return code_by_table(df, column, codes, max_broadcast_rows)


def label_dictionary(df: DataFrame, column: str) -> DataFrame:
    """(code, label) of a target column."""
    codes = code_table(df.filter(F.col(column).isNotNull()), column)
    return codes.select("code", F.col("value").alias("label"))
