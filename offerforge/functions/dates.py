"""Date features. Every function takes the reference day ``as_of``; none reads the clock."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OLD_CUSTOMER_MONTHS = 24


def date_pattern(separator: str, day: int, month: int, year: int) -> str:
    """Date pattern from a separator and the positions of its three parts."""
    parts = {day: "d", month: "M", year: "yyyy"}
    if sorted(parts) != [0, 1, 2]:
        raise ValueError("positions must be 0, 1 and 2")
    return f"'{separator}'".join(parts[i] for i in range(3))


def parse_date(text: Column, pattern: str = "M/d/yyyy", strict: bool = False) -> Column:
    """Date from delimited text; bad text is NULL, or an error when ``strict``."""
    return F.to_date(text, pattern) if strict else F.try_to_date(text, pattern)


def full_years(day: Column, as_of: date) -> Column:
    """Completed years from ``day`` to ``as_of``."""
    not_reached = F.month(day) * 100 + F.dayofmonth(day) > as_of.month * 100 + as_of.day
    return (F.lit(as_of.year) - F.year(day) - F.when(not_reached, 1).otherwise(0)).cast("bigint")


def tenure_months(day: Column, as_of: date, method: str = "years_and_month") -> Column:
    """Months from ``day`` to ``as_of``.

    ``years_and_month`` is twelve per completed year plus the plain difference of the two month numbers; before
    the anniversary it is about a year short and may be negative. ``calendar`` counts completed months.
    """
    if method == "years_and_month":
        return full_years(day, as_of) * 12 + (F.lit(as_of.month) - F.month(day))
    if method == "calendar":
        apart = (F.lit(as_of.year) - F.year(day)) * 12 + F.lit(as_of.month) - F.month(day)
        return (apart - F.when(F.dayofmonth(day) > as_of.day, 1).otherwise(0)).cast("bigint")
    raise ValueError(f"unknown method {method}")


def days_elapsed(day: Column, as_of: date) -> Column:
    return F.datediff(F.lit(as_of), day).cast("bigint")


def years_since(year: Column, as_of: date) -> Column:
    """Calendar years from a year number to the year of ``as_of``."""
    return (F.lit(as_of.year) - year.cast("bigint")).cast("bigint")


def tenure_segment(months: Column) -> Column:
    """``old_customer`` beyond 24 months, else ``new_customer``, also when the tenure is unknown."""
    return F.when(months > OLD_CUSTOMER_MONTHS, "old_customer").otherwise("new_customer")


def _from_day(df: DataFrame, column: str, pattern: str, strict: bool, name: str, feature) -> DataFrame:
    """A feature of the day in place of its text column; the text is parsed once per row."""
    parsed = df.withColumn("_day", parse_date(F.col(column), pattern, strict))
    return parsed.withColumn(name, feature(F.col("_day"))).drop("_day", column)


def with_age(df: DataFrame, column: str, as_of: date, pattern: str = "M/d/yyyy", strict: bool = False) -> DataFrame:
    """``age`` in place of a date-of-birth text column."""
    return _from_day(df, column, pattern, strict, "age", lambda day: full_years(day, as_of))


def with_customer_since(
    df: DataFrame, column: str, as_of: date, pattern: str = "M/d/yyyy", method: str = "years_and_month",
    strict: bool = False,
) -> DataFrame:
    """``customer_since_months`` in place of a joining-date text column."""
    return _from_day(
        df, column, pattern, strict, "customer_since_months", lambda day: tenure_months(day, as_of, method)
    )


def with_months_ago(
    df: DataFrame, column: str, as_of: date, pattern: str = "yyyy-M-d", method: str = "years_and_month",
    strict: bool = False,
) -> DataFrame:
    """``months_ago_<column>`` in place of a date text column."""
    return _from_day(
        df, column, pattern, strict, f"months_ago_{column}", lambda day: tenure_months(day, as_of, method)
    )


def with_days_elapsed(
    df: DataFrame, column: str, as_of: date, pattern: str = "M/d/yyyy", strict: bool = False
) -> DataFrame:
    """``<column>_in_days`` in place of a date text column."""
    return _from_day(df, column, pattern, strict, f"{column}_in_days", lambda day: days_elapsed(day, as_of))


def with_years_old(df: DataFrame, column: str, as_of: date) -> DataFrame:
    """``years_auto_old`` in place of a year column."""
    return df.withColumn("years_auto_old", years_since(F.col(column), as_of)).drop(column)


def with_vehicle_age(df: DataFrame, column: str, as_of: date) -> DataFrame:
    """``vehicle_age_yrs`` in place of a year column that may be text."""
    return df.withColumn("vehicle_age_yrs", years_since(F.col(column).try_cast("int"), as_of)).drop(column)


def with_bought_month(df: DataFrame, column: str, pattern: str = "M/d/yyyy", strict: bool = False) -> DataFrame:
    """``product_bought_in_month``, the month number as text, in place of a date text column."""
    return _from_day(
        df, column, pattern, strict, "product_bought_in_month", lambda day: F.month(day).cast("string")
    )


def with_tenure_segment(df: DataFrame, months: str = "customer_since_months",
                        name: str = "customer_rel_dur_segment") -> DataFrame:
    return df.withColumn(name, tenure_segment(F.col(months)))
