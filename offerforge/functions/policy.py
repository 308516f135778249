"""Derivations on policy tables: limits, amounts, ordinals and buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Claim severities with their weight, the weight of any other text, and the premium vehicle makes
# with the yearly value factors.
SEVERITY_WEIGHTS = {"Total Loss": 0.8, "Major Damage": 0.6, "Minor Damage": 0.4}
OTHER_SEVERITY = 0.2
PREMIUM_MAKES = ("Mercedes", "BMW", "Audi")
PREMIUM_FACTOR = 10000
STANDARD_FACTOR = 4000


def with_split_limits(df: DataFrame, column: str, separator: str = "/") -> DataFrame:
    """``bodily_injury_single_limit`` and ``bodily_injury_total_limit`` in place of an ``a/b`` text column."""
    return df.withColumns(
        {
            f"bodily_injury_{name}_limit": F.split_part(F.col(column), F.lit(separator), F.lit(i)).try_cast("bigint")
            for i, name in ((1, "single"), (2, "total"))
        }
    ).drop(column)


def with_net_amount(df: DataFrame, first: str, second: str) -> DataFrame:
    """``net_captial``, the sum of two amounts, in place of them (the name is the established column name)."""
    return df.withColumn("net_captial", F.col(first) + F.col(second)).drop(first, second)


def severity_weight(text: Column, case_sensitive: bool = False) -> Column:
    """Ordinal weight of a claim severity; unknown and missing texts get the lowest weight."""
    shown = text if case_sensitive else F.lower(text)
    out = F.lit(OTHER_SEVERITY)
    for name, weight in SEVERITY_WEIGHTS.items():
        out = F.when(shown == (name if case_sensitive else name.lower()), weight).otherwise(out)
    return out


def day_part(hour: Column) -> Column:
    """morning from 4, evening from 12, night from 19 on and before 4, also when the hour is unknown."""
    return F.when(hour.between(4, 11), "morning").when(hour.between(12, 18), "evening").otherwise("night")


def capped_count(count: Column, cap: int = 2) -> Column:
    """Counts from ``cap`` on as ``cap``; unknown stays unknown."""
    return F.when(count >= cap, cap).otherwise(count)


def make_value(make: Column, years: Column, case_sensitive: bool = False) -> Column:
    """Years of age times the factor of the vehicle make."""
    shown = make if case_sensitive else F.lower(make)
    premium = [m if case_sensitive else m.lower() for m in PREMIUM_MAKES]
    return F.when(shown.isin(premium), PREMIUM_FACTOR).otherwise(STANDARD_FACTOR) * years
