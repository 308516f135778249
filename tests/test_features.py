"""Edge rows of sources, dates, policy, lookup and row functions."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from offerforge.functions import dates, geo, names, policy, rows
from offerforge.operators import lookups, profile
from offerforge.operators.tables import attach, bucketed, consolidate_transactions, keep_last, lookup_join, outer_master
from offerforge.sources import tables as src

AS_OF = date(2002, 1, 15)


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_names_are_normalised_and_clashes_reported(spark):
    assert names.normalized_name("  First -- Name_(x)") == "first_name_x_"
    clash = spark.createDataFrame([(1, 2)], ["A b", "a_B"])
    with pytest.raises(ValueError, match="a_b"):
        names.normalize_names(clash)


def test_drop_columns_reports_unknown_names(spark):
    with pytest.raises(ValueError, match="nope"):
        names.drop_columns(spark.range(1), "nope")


@pytest.mark.parametrize(
    "text,years,months",
    [
        ("1/15/1980", 22, 264), ("1/16/1980", 21, 252), ("1/14/1980", 22, 264), ("2/29/1976", 25, 299),
        ("12/1/2001", 0, -11), ("2/29/1975", None, None), ("?", None, None), (None, None, None),
    ],
)
def test_age_and_tenure(spark, text, years, months):
    df = spark.createDataFrame([(text, text)], "dob string, since string")
    out = dates.with_customer_since(dates.with_age(df, "dob", AS_OF), "since", AS_OF)
    assert out.columns == ["age", "customer_since_months"]
    assert values(out, "age", "customer_since_months") == [(years, months)]


def test_calendar_tenure_and_strict_dates(spark):
    df = spark.createDataFrame([("12/1/2001",)], "d string")
    day = dates.parse_date(F.col("d"))
    assert values(df, dates.tenure_months(day, AS_OF, "calendar")) == [(1,)]
    bad = spark.createDataFrame([("13/45/2001",)], "d string")
    with pytest.raises(Exception):
        dates.with_age(bad, "d", AS_OF, strict=True).collect()


def test_date_pattern_follows_positions(spark):
    df = spark.createDataFrame([("2001-12-31",)], "d string")
    out = dates.with_days_elapsed(df, "d", AS_OF, dates.date_pattern("-", 2, 1, 0))
    assert values(out, "d_in_days") == [(15,)]


def test_tenure_segment_bounds(spark):
    df = spark.createDataFrame([(24,), (25,), (None,)], "m int")
    assert [r[0] for r in values(df, dates.tenure_segment(F.col("m")))] == ["new_customer", "old_customer", "new_customer"]


def test_policy_functions(spark):
    df = spark.createDataFrame(
        [("Total Loss", 4, 0, "BMW"), ("total loss", 12, 2, "audi"), (None, None, None, None), ("x", 19, 9, "Saab")],
        "s string, h int, w int, m string",
    )
    out = values(
        df, policy.severity_weight(F.col("s")), policy.severity_weight(F.col("s"), case_sensitive=True),
        policy.day_part(F.col("h")), policy.capped_count(F.col("w")), policy.make_value(F.col("m"), F.lit(2)),
    )
    assert out == [
        (0.8, 0.8, "morning", 0, 20000), (0.8, 0.2, "evening", 2, 20000), (0.2, 0.2, "night", None, 8000),
        (0.2, 0.2, "night", 2, 8000),
    ]
    limits = policy.with_split_limits(spark.createDataFrame([("100/300",), ("x",)], "c string"), "c")
    assert values(limits, "*") == [(100, 300), (None, None)]


def test_distance_and_near_flag(spark):
    places = spark.createDataFrame([("Here", "Town", 12.9698, 77.75), ("Far", "Town", 13.9698, 77.75)],
                                   "place string, city string, latitude double, longitude double")
    df = spark.createDataFrame([("here, town",), ("FAR,Town",), ("gone,Town",), (None,)], "address string")
    located = lookups.with_branch_distance(df, "address", places)
    got = {r[0]: r[1:] for r in values(located, "address", "distance_km", "is_matched")}
    assert got == {"here, town": (0.0, 1), "FAR,Town": (111.19, 1), "gone,Town": (0.0, 0), None: (0.0, 0)}
    assert sorted(r[0] for r in values(lookups.with_near_branch(located, "address"), "*")) == [0, 1, 1, 1]
    assert values(spark.range(1), geo.near_flag(F.lit(14.99)), geo.near_flag(F.lit(15.0))) == [(1, 0)]


def test_population_unknown_city_is_zero_with_and_without_broadcast(spark):
    cities = spark.createDataFrame([("Paris", 5)], "city string, population long")
    df = spark.createDataFrame([(i, " PARIS" if i % 3 else "Rome") for i in range(30)], "id int, city string")
    for bound in (0, 100):
        got = dict(values(lookups.with_population(df, "city", cities, bound), "id", "population"))
        assert got == {i: 5 if i % 3 else 0 for i in range(30)}


def test_lookup_join_spreads_missing_keys(spark):
    facts = spark.range(20_000).select(F.when(F.col("id") % 10 == 0, F.col("id")).alias("k"), "id").repartition(4)
    lookup = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup_join(facts, lookup, ["k"], max_rows=10)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert max(sizes) <= 2 * 20_000 / 4 and sum(sizes) == 20_000
        assert joined.filter("v <> 2 * k OR (v IS NULL) <> (k IS NULL)").count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)


def test_bucketed_tables_are_not_shuffled_again(spark):
    def made(n, name):
        df = spark.range(n).select(F.when(F.col("id") > 2, F.col("id")).alias("customer_id"), F.md5(F.col("id").cast("string")).alias(name))
        return bucketed(df, name, buckets=8)

    tables = {n: made(k, n) for n, k in (("one", 500), ("two", 700))}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        master, attached = outer_master(tables, buckets=8), attach(tables["one"], tables["two"])
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in (master, attached)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    dealt = [line for line in plans[0].splitlines() if "Exchange" in line]
    assert plans[0].count("SortMergeJoin") == 2 and len(dealt) <= 2 and not any("one" in x or "two" in x for x in dealt)
    assert "SortMergeJoin" in plans[1] and "Exchange" not in plans[1]
    assert master.count() == 697 + 6 and attached.count() == 497


def test_outer_master_shuffles_each_table_once(spark):
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables = {f"t{k}": spark.range(k, 50 + k).select(
            F.when(F.col("id") > k, F.col("id")).alias("customer_id"), F.col("id").alias("v")) for k in range(5)}
        master = outer_master(tables)
        plan = master._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 6
        want = tables["t0"].withColumnRenamed("v", "t0_v")
        for name in list(tables)[1:]:
            want = want.join(tables[name].withColumnRenamed("v", f"{name}_v"), "customer_id", "full_outer")
        assert sorted(map(str, master.collect())) == sorted(map(str, want.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)


def test_lookup_join_with_hot_and_rare_keys(spark):
    facts = spark.range(6000).select(F.when(F.col("id") < 2000, 0).otherwise(F.col("id")).alias("k"), "id")
    lookup = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    got = {r.id: r.v for r in lookup_join(facts, lookup, ["k"], max_rows=10).collect()}
    assert got == {i: 0 if i < 2000 else i * 2 if i < 5000 else None for i in range(6000)}


def test_row_statistics_constant_rows_and_options(spark):
    df = spark.createDataFrame([(1.0, 1.0, 1.0), (9.0, 1.0, 2.0), (-1.0, -2.0, -3.0)], "a double, b double, c double")
    out = rows.row_statistics(df, ["a", "b", "c"], "g")
    assert values(out, "g_median", "g_skew", "g_peak", "g_below")[0] == (1.0, None, 1.0, 0)
    assert [r[0] for r in values(out, "g_median")] == [1.0, 1.0, -2.0]
    assert [r[0] for r in values(out, "g_peak")] == [1.0, 9.0, 0.0]
    assert [r[0] for r in values(rows.row_statistics(df, ["a", "b", "c"], "g", "sorted"), "g_median")] == [1.0, 2.0, -2.0]


@pytest.mark.parametrize(
    "first,second,score",
    [
        ([0, 0, 0, 0, 10, 10], [0, 0, 0, 0, 10, 10], 0.8),
        ([0, 0, 0, 0, 0, 10], [1, 1, 1, 1, 1, 1], 0.5),
        ([1, 1, 1, 1, 1, 1], [1, 1, 1, 1, 1, 1], 0.3),
        ([0, 0, 0, 0, 10, 10], [1, 1, 1, 1, 1, 1], 0.3),
        ([None, 0, 0, 0, 0, 10], [1, 1, 1, 1, 1, 1], 0.3),
    ],
)
def test_churn_score(spark, first, second, score):
    columns = [f"a{i}" for i in range(6)], [f"b{i}" for i in range(6)]
    df = spark.createDataFrame([(*first, *second)], ", ".join(f"{c} int" for g in columns for c in g))
    assert values(rows.with_churn_score(df, *columns), "transactions_churn_analysis") == [(score,)]


def test_argmax_ties_and_negatives(spark):
    df = spark.createDataFrame([(2.0, 2.0), (-1.0, -2.0), (-1.0, 0.0), (None, 3.0), (None, None)], "x_amt double, y_amt double")
    assert [r[0] for r in values(df, rows.argmax_category(["x_amt", "y_amt"]))] == ["x", None, "y", "y", None]


def test_profiles_count_missing_as_a_value(spark):
    df = spark.createDataFrame([(1, "a", 0.0), (2, None, -0.0), (3, "a", None)], "k int, t string, z double")
    assert dict(values(profile.unique_counts(df), "column", "num_unique_values")) == {"k": 3, "t": 2, "z": 2}
    assert values(profile.constant_or_key_columns(df), "column") == [("k",)]
    assert dict(values(profile.null_counts(df), "column", "outlier")) == {"k": 0, "t": 1, "z": 1}
    assert values(profile.columns_by_cardinality(df, ["t", "z"]), "columns") == [("t,z",)]
    empty = df.limit(0)
    assert {r[0] for r in values(profile.missing_percent(empty), "percent_missing")} == {None}


def test_csv_types_tokens_and_nested_columns(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, "x,y", 1.5, ["a"], {"p": 0.5}), (2, None, float("nan"), None, None), (3, "NA", None, [], {})],
        "id int, t string, d double, l array<string>, m map<string,double>",
    )
    path = str(tmp_path / "t")
    src.write_csv_table(df, path)
    inferred = src.read_csv_table(spark, path)
    assert dict(inferred.dtypes) == {"id": "bigint", "t": "string", "d": "double", "l": "string", "m": "string"}
    got = sorted(values(inferred, "id", "t", "d"))
    assert got == [(1, "x,y", 1.5), (2, None, None), (3, None, None)]
    back = src.parse_score_map(F.col("m"))
    assert dict(values(inferred.filter("id = 1"), "id", back)) == {1: {"p": 0.5}}


def test_ingest_removes_nan_and_keyless_rows(spark):
    df = spark.createDataFrame([("a", float("nan")), (None, 1.0), ("b", 2.0)], "customer_id string, v double")
    assert sorted(values(src.ingest(df), "*")) == [("a", None), ("b", 2.0)]


def test_score_text_keeps_order_and_quotes(spark):
    df = spark.createDataFrame([("{'b': 0.2, 'a': 0.9}",), ("{}",), (None,)], "t string")
    assert [r[0] for r in values(df, src.candidate_names(F.col("t")))] == [["b", "a"], [], None]


def test_consolidation_modes_ties_and_grocery(spark):
    df = spark.createDataFrame(
        [
            ("c1", "gold", 5.0, "food", 1.0), ("c1", "silver", 5.0, "grocery", 2.0), ("c1", None, 7.0, "fuel", None),
            ("c2", None, None, None, 4.0),
        ],
        "id string, card string, income double, kind string, amount double",
    )
    for parts in (1, 7):
        out = consolidate_transactions(
            df.repartition(parts), "id", ["card", "income"], "kind", "amount", {"food": ["food", "grocery"], "fuel": ["fuel"]}
        )
        assert sorted(values(out, "*")) == [
            ("c1", "gold", 5.0, 3.0, 2, 0.0, 0, 3.0, 2), ("c2", None, None, 0.0, 0, 0.0, 0, 4.0, 1),
        ]


def test_keep_last_and_outer_master(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "customer_id string, o int, v string")
    last = keep_last(df, "customer_id", ["o"])
    assert sorted(values(last, "customer_id", "v")) == [("a", "y"), ("b", "z")]
    other = spark.createDataFrame([("b", "q"), ("c", "r")], "customer_id string, v string")
    master = outer_master({"left": last.drop("o"), "right": other})
    assert sorted(values(master, "customer_id", "left_v", "right_v"), key=str) == [
        ("a", "y", None), ("b", "z", "q"), ("c", None, "r"),
    ]
