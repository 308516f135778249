"""Registered queries: scaling, outliers, histograms, correlations."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from offerforge.operators import numeric
from offerforge.plans.registry import query, table

LINE = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")


def line_numbers(spark, sf_dir):
    """Lines with a derived total, a constant and some missing discounts."""
    return table(spark, sf_dir, "lineitem").select(
        "l_quantity", "l_extendedprice", F.when(F.col("l_returnflag") != "R", F.col("l_discount")).alias("l_discount"),
        "l_tax", F.col("l_linenumber").cast("double").alias("l_linenumber"),
        (F.col("l_extendedprice") * (1 + F.col("l_tax"))).alias("gross"), F.lit(1.0).alias("fixed"),
    )


_LINES = (
    "lines AS (SELECT l_quantity, l_extendedprice, CASE WHEN l_returnflag <> 'R' THEN l_discount END AS l_discount, l_tax, "
    "CAST(l_linenumber AS DOUBLE) AS l_linenumber, l_extendedprice * (1 + l_tax) AS gross, CAST(1 AS DOUBLE) AS fixed FROM lineitem)"
)
_COLUMNS = (*LINE, "gross", "fixed")


def _pair_sql(a: str, b: str) -> str:
    x, y = f"CASE WHEN {b} IS NOT NULL THEN {a} END", f"CASE WHEN {a} IS NOT NULL THEN {b} END"
    return (
        f"SELECT '{a}' AS first, '{b}' AS second, round(covar_pop({x}, {y}) / nullif(stddev_pop({x}) * stddev_pop({y}), 0), 6) "
        "AS corr FROM lines"
    )


_PAIRS = " UNION ALL ".join(_pair_sql(a, b) for a, b in combinations(_COLUMNS, 2))


@query("corr_pairs", f"WITH {_LINES} {_PAIRS}")
def corr_pairs(spark, sf_dir):
    return numeric.correlations(line_numbers(spark, sf_dir), _COLUMNS).withColumn("corr", F.round("corr", 6))


@query("corr_pairs_wide", f"WITH {_LINES} {_PAIRS}")
def corr_pairs_wide(spark, sf_dir):
    """The same pairs with the rows spread over many small tasks: the partial sums must add up to the same."""
    spread = line_numbers(spark, sf_dir).repartition(29)
    return numeric.correlations(spread, _COLUMNS).withColumn("corr", F.round("corr", 6))


@query("corr_pairs_blocked", f"WITH {_LINES} {_PAIRS}")
def corr_pairs_blocked(spark, sf_dir):
    """The same pairs with the columns taken two at a time, as thousands of columns would be in larger blocks."""
    return numeric.correlations(line_numbers(spark, sf_dir), _COLUMNS, block=2).withColumn("corr", F.round("corr", 6))


@query(
    "top_corr",
    f"WITH {_LINES} SELECT first, second, corr FROM ({_PAIRS}) ORDER BY corr DESC NULLS LAST, first, second LIMIT 2",
)
def top_corr(spark, sf_dir):
    return numeric.top_correlations(line_numbers(spark, sf_dir), _COLUMNS, 2).withColumn("corr", F.round("corr", 6))


@query("corr_drop_list", f"WITH {_LINES} SELECT DISTINCT second AS \"column\" FROM ({_PAIRS}) WHERE abs(corr) > 0.75")
def corr_drop_list(spark, sf_dir):
    return numeric.highly_correlated(line_numbers(spark, sf_dir), _COLUMNS, 0.75)


def _matrix_sql() -> str:
    def cell(row: str, col: str) -> str:
        if row == col:
            return "CAST(1 AS DOUBLE)" if row != "fixed" else "CAST(NULL AS DOUBLE)"
        a, b = sorted((row, col), key=_COLUMNS.index)
        return f"(SELECT corr FROM p WHERE first = '{a}' AND second = '{b}')"

    rows = " UNION ALL ".join(
        f"SELECT '{r}' AS \"column\", " + ", ".join(f"{cell(r, c)} AS {c}" for c in _COLUMNS) for r in _COLUMNS
    )
    return f"WITH {_LINES}, p AS ({_PAIRS}) {rows}"


@query("corr_matrix", _matrix_sql())
def corr_matrix(spark, sf_dir):
    matrix = numeric.correlation_matrix(line_numbers(spark, sf_dir), _COLUMNS)
    return matrix.select("column", *[F.round(c, 6).alias(c) for c in _COLUMNS])


@query(
    "histogram",
    "WITH s AS (SELECT min(c_acctbal) AS lo, (max(c_acctbal) - min(c_acctbal)) / 12 AS w FROM customer), "
    "c AS (SELECT CAST(least(floor((c_acctbal - lo) / w), 11) AS BIGINT) AS bin, count(*) AS n FROM customer, s GROUP BY 1) "
    "SELECT r AS bin, round(lo + r * w, 4) AS low, round(lo + (r + 1) * w, 4) AS high, coalesce(n, 0) AS n "
    "FROM range(12) t(r) CROSS JOIN s LEFT JOIN c ON c.bin = r",
)
def histogram(spark, sf_dir):
    bins = numeric.histogram(table(spark, sf_dir, "customer"), "c_acctbal", 12)
    return bins.withColumns({"low": F.round("low", 4), "high": F.round("high", 4)})


@query(
    "column_stats",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS sd, "
        f"CAST(min({c}) AS DOUBLE) AS low, CAST(max({c}) AS DOUBLE) AS high FROM lineitem"
        for c in LINE
    ),
)
def column_stats(spark, sf_dir):
    stats = numeric.stats_table(table(spark, sf_dir, "lineitem"), LINE)
    return stats.withColumns({"mean": F.round("mean", 6), "sd": F.round("sd", 6)})


_Z = "CASE WHEN abs(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()) > 2 THEN NULL ELSE {c} END AS {c}"


@query("outlier_mask", "SELECT p_partkey, " + _Z.format(c="p_retailprice") + ", " + _Z.format(c="q") +
       " FROM (SELECT p_partkey, p_retailprice, CAST(p_size * p_size AS DOUBLE) AS q FROM part)")
def outlier_mask(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        "p_partkey", "p_retailprice", (F.col("p_size") * F.col("p_size")).cast("double").alias("q")
    )
    return numeric.mask_outliers(part, numeric.fit_stats(part, ["p_retailprice", "q"]))


@query(
    "outlier_report",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS outlier FROM (SELECT {_Z.format(c=c)} FROM lineitem)"
        for c in ("l_quantity", "l_extendedprice", "l_tax")
    ),
)
def outlier_report(spark, sf_dir):
    return numeric.outlier_report(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_tax"])


@query(
    "log_scale",
    "SELECT c_custkey, round(log10(CASE WHEN c_acctbal > 0 THEN c_acctbal END), 6) AS c_acctbal FROM customer",
)
def log_scale(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return numeric.log_scale(customer, ["c_acctbal"]).withColumn("c_acctbal", F.round("c_acctbal", 6))


def _scaled(spark, sf_dir, scale):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", F.lit(3.0).alias("fixed"))
    scaled = scale(customer, numeric.fit_stats(customer, ["c_acctbal", "fixed"]))
    return scaled.withColumns({c: F.round(c, 6) for c in ("c_acctbal", "fixed")})


@query(
    "standard_scale",
    "SELECT c_custkey, round((c_acctbal - avg(c_acctbal) OVER ()) / stddev_pop(c_acctbal) OVER (), 6) AS c_acctbal, "
    "CAST(NULL AS DOUBLE) AS fixed FROM customer",
)
def standard_scale(spark, sf_dir):
    return _scaled(spark, sf_dir, numeric.standard_scale)


@query(
    "minmax_scale",
    "SELECT c_custkey, round((c_acctbal - min(c_acctbal) OVER ()) / (max(c_acctbal) OVER () - min(c_acctbal) OVER ()), 6) "
    "AS c_acctbal, CAST(NULL AS DOUBLE) AS fixed FROM customer",
)
def minmax_scale(spark, sf_dir):
    return _scaled(spark, sf_dir, numeric.minmax_scale)


_CUSTOM = (
    "round((c_acctbal - trunc(min(c_acctbal) OVER ())) / (trunc(max(c_acctbal) OVER ()) - trunc(min(c_acctbal) OVER ())) * 8"
)


@query("custom_scale", f"SELECT c_custkey, {_CUSTOM}, 6) AS c_acctbal, CAST(NULL AS DOUBLE) AS fixed FROM customer")
def custom_scale(spark, sf_dir):
    return _scaled(spark, sf_dir, lambda df, stats: numeric.custom_scale(df, stats, 2, 10))


@query("custom_scale_shifted", f"SELECT c_custkey, {_CUSTOM} + 2, 6) AS c_acctbal, CAST(NULL AS DOUBLE) AS fixed FROM customer")
def custom_scale_shifted(spark, sf_dir):
    return _scaled(spark, sf_dir, lambda df, stats: numeric.custom_scale(df, stats, 2, 10, shift=True))
