"""Small helpers of the operators: arrow maps over texts and written steps."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_AT_ONCE = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(df: DataFrame, key: str, text: str, key_name: str, text_name: str = "text") -> DataFrame:
    """Key and text under fixed names, null texts as empty ones; other columns, of whatever name, are left behind."""
    return df.select(F.col(key).alias(key_name), F.coalesce(F.col(text), F.lit("")).alias(text_name))


def map_rows(df: DataFrame, make: Callable[[pa.RecordBatch], list[dict]], schema: str,
             done: Callable[[], None] | None = None) -> DataFrame:
    """Arrow map: ``make`` gives the rows for a slice of at most ``ROWS_AT_ONCE`` rows, so few long texts are unpacked
    at a time. ``done`` is called at the end of each task."""
    kinds = arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                    rows = make(batch.slice(at, ROWS_AT_ONCE))
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=kinds)
        finally:
            if done:
                done()

    return df.mapInArrow(run, schema)


def arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def set_aside(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` under column names that nothing else has, and the new name of each column."""
    names = {c: f"_own_{k}" for k, c in enumerate(df.columns)}
    return df.withColumnsRenamed(names), names


def put_back(names: dict[str, str], *new: str) -> list[Column]:
    """The columns of ``set_aside`` under their names, but for those that the ``new`` columns replace."""
    return [F.col(n).alias(c) for c, n in names.items() if c.lower() not in new]
