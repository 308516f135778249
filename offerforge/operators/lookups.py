"""City and address lookups on dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerforge.functions.geo import BRANCH, NEAR_KM, great_circle_km, near_flag
from offerforge.operators.tables import lookup_join
from offerforge.session import BROADCAST_ROWS


def _place(column):
    return F.lower(F.trim(column))


def with_population(
    df: DataFrame, city: str, cities: DataFrame, max_broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """``population`` in place of a city column, 0 for a city not in ``cities(city, population)``."""
    known = cities.select(_place(F.col("city")).alias("_city"), F.col("population").alias("_population"))
    joined = lookup_join(df.withColumn("_city", _place(F.col(city))), known, ["_city"], max_broadcast_rows)
    return joined.withColumn("population", F.coalesce("_population", F.lit(0)).cast("bigint")).drop(
        "_city", "_population", city
    )


def city_population(cities: DataFrame, city: str) -> DataFrame:
    """Population of one city."""
    return cities.filter(_place(F.col("city")) == city.strip().lower()).select("city", "population")


def with_branch_distance(
    df: DataFrame,
    address: str,
    gazetteer: DataFrame,
    point: tuple[float, float] = BRANCH,
    missing_distance: float = 0.0,
    max_broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Adds ``distance_km`` and ``is_matched`` for a ``place,city`` address column.

    ``gazetteer(place, city, latitude, longitude)`` holds each place once. An address that is not found gets
    ``missing_distance``.
    """
    known = gazetteer.select(
        _place(F.col("place")).alias("_place"),
        _place(F.col("city")).alias("_city"),
        great_circle_km(F.col("latitude"), F.col("longitude"), point).alias("_km"),
    )
    parts = df.withColumns(
        {
            "_place": _place(F.split_part(F.col(address), F.lit(","), F.lit(1))),
            "_city": _place(F.split_part(F.col(address), F.lit(","), F.lit(2))),
        }
    )
    joined = lookup_join(parts, known, ["_place", "_city"], max_broadcast_rows)
    return joined.withColumns(
        {
            "distance_km": F.coalesce("_km", F.lit(float(missing_distance))),
            "is_matched": F.col("_km").isNotNull().cast("int"),
        }
    ).drop("_place", "_city", "_km")


def with_near_branch(df: DataFrame, address: str, limit: int = NEAR_KM) -> DataFrame:
    """``address_near_by_bank`` in place of the address and of the distance columns made for it."""
    return df.withColumn("address_near_by_bank", near_flag(F.col("distance_km"), limit)).drop(
        address, "distance_km", "is_matched"
    )
