"""Relational building blocks: keyed joins, lookups, de-duplication, consolidation of transactions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerforge.session import BROADCAST_ROWS, is_small, scratch_path, written

HOT_SHARE = 0.001
"""A key with more than this share of the rows is joined apart; there can be at most 1 / HOT_SHARE such keys."""


BUCKETS = 256
"""Buckets of a table that is joined on its key again and again."""
SALTS = 64
"""Parts that the rows of a hot or missing key are dealt to."""


def lookup_join(facts: DataFrame, lookup: DataFrame, on: Sequence[str], max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Left join to a lookup table holding each key once.

    A lookup found to be small is broadcast. A larger one is joined by one shuffle in which hot keys are salted: there
    are fewer than 1 / HOT_SHARE of them by definition, so marking them is a bounded broadcast, and only their lookup
    rows are repeated for every salt. Rows with a missing key match nothing and are dealt out the same way. The facts are
    read twice, once for the counts.
    """
    on = list(on)
    if is_small(lookup, max_rows):
        return facts.join(F.broadcast(lookup), on, "left")
    missing = reduce(or_, [F.col(c).isNull() for c in on])
    counts = facts.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    counts = written(counts.filter(~missing).filter(F.col("_n") > 1))
    total = facts.count()
    hot = F.broadcast(counts.filter(F.col("_n") > total * HOT_SHARE).select(*on, F.lit(True).alias("_hot")))
    deal = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
    salted = facts.join(hot, on, "left").withColumn("_salt", F.when(F.col("_hot") | missing, deal).otherwise(0)).drop("_hot")
    salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    parts = lookup.join(hot, on, "left").withColumn("_salt", F.explode(salts)).drop("_hot")
    return salted.join(parts, [*on, "_salt"], "left").drop("_salt")


def keep_last(df: DataFrame, key: str | Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Per key the row that is last under ``order_by``, which must leave no ties.

    Ranking before the shuffle leaves one row per key and task, so a key with very many rows does not gather.
    """
    keys = [key] if isinstance(key, str) else list(key)
    window = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order_by])
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def bucketed(df: DataFrame, name: str, key: str = "customer_id", buckets: int = BUCKETS) -> DataFrame:
    """``df`` written to the shared folder in buckets of the key, one sorted file each, and read as a table.

    Joins and aggregates on the key of such tables need no shuffle, however often they are run; choose ``buckets`` so that
    one fits in a task's memory, and the same number for tables that meet.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table_name = path.rsplit("/", 1)[1].replace("-", "_")
    writer = df.repartition(buckets, key).write.option("path", path).bucketBy(buckets, key).sortBy(key)
    writer.saveAsTable(table_name)
    return spark.table(table_name)


def outer_master(tables: Mapping[str, DataFrame], key: str = "customer_id", buckets: int | None = None) -> DataFrame:
    """Full outer join of many tables on one key. With ``buckets``, the tables are ``bucketed`` in that number: then only
    the keys are shuffled, to the buckets' partitioning.

    The keys of all tables, once each, are the spine; the tables are joined to it one after the other on its partitioning,
    so each table is shuffled once. Rows without a key match nothing and follow behind. A column name found in several
    tables is prefixed by the table name.
    """
    names = [c for t in tables.values() for c in t.columns if c != key]
    clashing = {c for c in names if names.count(c) > 1}
    renamed = [
        t.select(key, *[F.col(c).alias(f"{name}_{c}" if c in clashing else c) for c in t.columns if c != key])
        for name, t in tables.items()
    ]
    spine = union_keys(renamed, key).filter(F.col(key).isNotNull())
    spine = spine.repartition(buckets, key) if buckets else spine
    whole = reduce(lambda left, right: left.join(right.filter(F.col(key).isNotNull()), key, "left"), renamed, spine)
    lost = [t.filter(F.col(key).isNull()) for t in renamed]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), lost, whole)


def inner_fanout(base: DataFrame, tables: Mapping[str, DataFrame], key: str = "customer_id") -> dict[str, DataFrame]:
    """The base table joined to each of several tables."""
    return {name: base.join(t, key, "inner") for name, t in tables.items()}


def keep_known(df: DataFrame, others: DataFrame, key: str = "customer_id") -> DataFrame:
    """Rows whose key occurs in the other table."""
    return df.join(others.select(key), key, "left_semi")


def attach(df: DataFrame, results: DataFrame, key: str = "customer_id", how: str = "inner") -> DataFrame:
    """Result columns put onto the rows with the same key, never by position."""
    return df.join(results, key, how)


def union_keys(tables: Sequence[DataFrame], key: str = "customer_id") -> DataFrame:
    """Every key found in at least one of the tables, once."""
    return reduce(DataFrame.unionByName, [t.select(key) for t in tables]).distinct()


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def top_rows(df: DataFrame, order_by: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows under an order without ties (head, tail with the order reversed, top-n)."""
    return df.orderBy(*order_by).limit(n)


def consolidate_transactions(
    transactions: DataFrame,
    key: str,
    attributes: Sequence[str],
    category: str,
    amount: str,
    groups: Mapping[str, Sequence[str]],
) -> DataFrame:
    """One row per customer: modes of the attributes, then sum and count of the amount per category group and in all.

    A mode is the most frequent value, the smallest on ties, missing values not counted. ``groups`` maps a result
    prefix to the categories it adds up.

    The transactions are read once and go through three aggregates, each combined before its shuffle: to one row per
    customer, attribute values and category; to one row per customer, column and value; to one row per customer. No
    aggregate holds more than a number per row, so a customer with very many transactions or values is no burden.
    """
    reduced = transactions.groupBy(key, *attributes, category).agg(
        F.count(F.lit(1)).alias("_rows"), F.count(amount).alias("_trans"), F.sum(amount).alias("_amt")
    )
    types = {f.name: f.dataType for f in transactions.schema}
    columns = [*attributes, category]
    names = [f"_v{i}" for i in range(len(columns))]
    entries = []
    for i, c in enumerate(columns):  # every column keeps a field of its own type, so no value is rounded
        last = c == category
        entries.append(
            F.struct(
                F.lit(i).alias("at"),
                *[(F.col(c) if n == i else F.lit(None)).cast(types[other]).alias(names[n]) for n, other in enumerate(columns)],
                (F.col("_trans") if last else F.lit(None)).cast("bigint").alias("trans"),
                (F.col("_amt") if last else F.lit(None)).cast("double").alias("amt"),
            )
        )
    at = F.col("at")
    values = (
        reduced.select(key, "_rows", F.explode(F.array(*entries)).alias("_e")).select(key, "_rows", "_e.*")
        .groupBy(key, "at", *names)
        .agg(F.sum("_rows").alias("n"), F.sum("trans").alias("trans"), F.sum("amt").alias("amt"))
    )
    picks = [
        F.min(F.when((at == i) & F.col(names[i]).isNotNull(), F.struct((-F.col("n")).alias("n"), F.col(names[i]).alias("v")))).alias(f"_m{i}")
        for i in range(len(attributes))
    ]
    measures = []
    for prefix, categories in groups.items():
        inside = (at == len(attributes)) & F.col(names[-1]).cast("string").isin(list(categories))
        measures += [
            F.coalesce(F.sum(F.when(inside, F.col("amt"))), F.lit(0.0)).alias(f"{prefix}_amt"),
            F.coalesce(F.sum(F.when(inside, F.col("trans"))), F.lit(0)).alias(f"{prefix}_trans"),
        ]
    measures += [
        F.coalesce(F.sum("amt"), F.lit(0.0)).alias("total_amt"),
        F.coalesce(F.sum("trans"), F.lit(0)).alias("total_trans"),
    ]
    modes = [F.col(f"_m{i}.v").alias(c) for i, c in enumerate(attributes)]
    return values.groupBy(key).agg(*picks, *measures).select(
        key, *modes, *[f"{p}_{m}" for p in [*groups, "total"] for m in ("amt", "trans")]
    )
