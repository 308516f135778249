"""Quantiles, tiers, scaling, correlation, encoding and imputation against brute force."""

from __future__ import annotations

import numpy as np
import pandas as pd
import random

import pytest
from pyspark.sql import functions as F

from offerforge.operators import encode, impute, numeric


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


@pytest.mark.parametrize("per_range", [1_000_000, 40])
def test_exact_quantiles(spark, per_range):
    rng = np.random.default_rng(5)
    data = np.concatenate([rng.normal(size=900), np.full(450, 0.25), rng.integers(0, 9, 200)])
    df = spark.createDataFrame([(float(v),) for v in data] + [(None,), (float("nan"),)], "v double").repartition(5)
    got = numeric.exact_quantiles(df, "v", [0, 0.1, 0.25, 0.5, 0.75, 1], per_range)
    for p, v in got.items():
        assert v == pytest.approx(np.quantile(data, p), abs=1e-12)


def test_quantiles_of_nothing(spark):
    assert set(numeric.exact_quantiles(spark.createDataFrame([], "v double"), "v").values()) == {None}


def test_tiers_at_edges(spark):
    df = spark.createDataFrame([(v,) for v in (0, 1, 2, 3, 4, 5, None)], "p int")
    edges = numeric.tier_edges({0: 0.0, 0.25: 2.0, 0.5: 2.0, 1: 4.0})
    got = [r[0] for r in values(numeric.with_city_tier(df, "p", edges), "city_grp")]
    assert got == ["unknown", "t0", "t0", "t1", "t1", "unknown", "unknown"]
    assert {r[0] for r in values(numeric.with_city_tier(df, "p", [3.0]), "city_grp")} == {"unknown"}


def test_correlations_like_pandas(spark):
    rng = np.random.default_rng(1)
    frame = pd.DataFrame(rng.normal(size=(500, 5)), columns=list("abcde"))
    frame["b"] = frame["a"] * 3 + frame["b"] * 0.1 + 1e6
    frame["e"] = 7.0
    frame.loc[::4, "c"] = np.nan
    expected = frame.corr()
    df = spark.createDataFrame(frame.replace({np.nan: None}).astype(object).values.tolist(), "a double, b double, c double, d double, e double")
    for parts in (1, 6):
        got = {(r["first"], r["second"]): r["corr"] for r in numeric.correlations(df.repartition(parts), list("abcde")).collect()}
        assert len(got) == 10
        for (x, y), r in got.items():
            assert r is None if "e" in (x, y) else r == pytest.approx(expected.loc[x, y], abs=1e-9)
    assert values(numeric.highly_correlated(df, list("abcde"), 0.75), "column") == [("b",)]
    assert values(numeric.top_correlations(df, list("abcde"), 1), "first", "second") == [("a", "b")]


def test_scalers_and_outliers(spark):
    df = spark.createDataFrame([(float(v), 1.0) for v in [0] * 9 + [100]] + [(None, 1.0)], "v double, c double")
    stats = numeric.fit_stats(df, ["v", "c"])
    assert sorted(values(numeric.mask_outliers(df, stats), "v"), key=str)[-2:] == [(None,), (None,)]
    assert {r[0] for r in values(numeric.minmax_scale(df, stats), "c")} == {None}
    assert max(r[0] for r in values(numeric.custom_scale(df.na.drop(), stats, 2, 4), "v")) == 2.0
    assert max(r[0] for r in values(numeric.custom_scale(df.na.drop(), stats, 2, 4, shift=True), "v")) == 4.0
    logs = spark.createDataFrame([(100.0,), (0.0,), (-1.0,), (None,)], "v double")
    assert [r[0] for r in values(numeric.log_scale(logs, ["v"]), "v")] == [2.0, None, None, None]


def test_histogram_last_bin_closed_and_constant(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)], "v double")
    assert [r[0] for r in values(numeric.histogram(df, "v", 5), "n")] == [2, 2, 2, 2, 3]
    assert sum(r[0] for r in values(numeric.histogram(df.select(F.lit(2.0).alias("v")), "v", 3), "n")) == 11


def test_rare_values_at_the_threshold(spark):
    df = spark.createDataFrame([("a",)] * 997 + [("b",), ("c",), ("c",), (None,)], "t string")
    grouped = encode.group_rare(df, encode.fit_frequent_values(df, ["t"]))
    counts = {r.t: r["count"] for r in grouped.groupBy("t").count().collect()}
    assert counts == {"a": 997, "others": 1, "c": 2, None: 1}


def test_one_hot_rows_sum_to_one(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "t string")
    out = encode.one_hot(df, encode.fit_categories(df, ["t"]))
    assert values(out, "*") == [(1, 0), (0, 1), (0, 0)]


def test_codes_with_missing_and_first_appearance(spark):
    df = spark.createDataFrame([(1, "z"), (2, None), (3, "a"), (4, "z")], "o int, t string")
    coded = encode.code_categories(df, encode.fit_categories(df, ["t"]))
    assert [r[0] for r in values(coded.orderBy("o"), "t")] == [1, 2, 0, 1]
    for ranges in (1, 3):
        first = {r.value: r.code for r in encode.code_table(df, "t", "o", ranges).collect()}
        assert first == {"z": 0, None: 1, "a": 2}
    by_table = encode.code_by_table(df, "t", encode.code_table(df, "t", "o"), max_broadcast_rows=0)
    assert [r[0] for r in values(by_table.orderBy("o"), "t")] == [0, 1, 2, 0]


def test_code_table_in_ranges_is_a_ranking(spark):
    df = spark.range(5000).select(F.md5(F.col("id").cast("string")).alias("t"))
    got = {r.value: r.code for r in encode.code_table(df, "t", ranges=7).collect()}
    assert [got[v] for v in sorted(got)] == list(range(5000))


def test_code_table_in_fifty_ranges_keeps_a_short_plan(spark):
    df = spark.range(4000).select(F.when(F.col("id") % 9 > 0, F.md5(F.col("id").cast("string"))).alias("t"), "id")
    codes = encode.code_table(df, "t", ranges=50)
    got = {r.value: r.code for r in codes.collect()}
    known = sorted(v for v in got if v is not None)
    assert [got[v] for v in known] == list(range(len(known))) and got[None] == len(known)
    assert len(codes._jdf.queryExecution().optimizedPlan().toString()) < 5000
    first = {r.value: r.code for r in encode.code_table(df, "t", "id", 50).collect()}
    assert first[None] == 0 and sorted(first.values()) == list(range(len(first)))


def test_correlations_in_blocks_equal_those_at_once(spark):
    df = spark.range(300).select(*[(F.when(F.col("id") % (i + 5) > 0, F.sin(F.col("id") * (i + 1)) + F.col("id") * i)).alias(f"c{i}") for i in range(7)])
    whole, parts = (
        {(r.first, r.second): r["corr"] for r in numeric.correlations(df, df.columns, block).collect()} for block in (256, 3))
    assert parts == pytest.approx(whole) and len(parts) == 21


def test_too_many_categories_is_an_error(spark):
    with pytest.raises(ValueError, match="categories"):
        encode.fit_categories(spark.range(50).select(F.col("id").cast("string").alias("t")), ["t"], 10)


def test_encoder_choice_without_columns_of_a_cardinality(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "x")], "two string, one string")
    plan = encode.fit_encoders(df, (2,), (5,))
    assert list(plan.coded) == ["two"] and not plan.spread


def _brute_neighbours(frame, target, features, k, coordinates):
    donors = frame[frame[target].notna()]
    out = {}
    for row in frame[frame[target].isna()].itertuples():
        ranked = []
        for d in donors.itertuples():
            pairs = [(getattr(row, f), getattr(d, f)) for f in features]
            pairs = [(a, b) for a, b in pairs if not (np.isnan(a) or np.isnan(b))]
            if pairs:
                ranked.append((sum((a - b) ** 2 for a, b in pairs) * coordinates / len(pairs), d.id, getattr(d, target)))
        out[row.id] = [v for *_, v in sorted(ranked)[:k]]
    return out


@pytest.mark.parametrize("per_cell,start,quantile_bits", [(2000, 256, 10), (5, 256, 10), (1, 4, 2)])
def test_numeric_imputation_is_exact(spark, monkeypatch, per_cell, start, quantile_bits):
    monkeypatch.setattr(impute, "START_CELLS", start)
    monkeypatch.setattr(impute, "MAX_BITS", quantile_bits)
    rng = np.random.default_rng(3)
    n = 400
    frame = pd.DataFrame({"id": range(n), "x": rng.normal(size=n).round(2), "y": rng.exponential(size=n), "v": rng.normal(size=n)})
    frame.loc[:130, ["x", "y"]] = [0.5, 0.5]  # a third of the rows at one point
    frame.loc[5::9, "y"] = np.nan
    frame.loc[3::11, "x"] = np.nan
    frame.loc[::5, "v"] = np.nan
    frame.loc[50, ["x", "y", "v"]] = np.nan
    df = spark.createDataFrame(frame.astype(object).where(frame.notna(), None).values.tolist(), "id int, x double, y double, v double")
    filled = {r.id: r.v for r in impute.impute_numeric(df, "v", ["x", "y"], "id", donors_per_cell=per_cell).collect()}
    expected = _brute_neighbours(frame, "v", ["x", "y"], 2, 3)
    assert len(filled) == n
    for i, near in expected.items():
        assert filled[i] == pytest.approx(np.mean(near) if near else frame.v.mean())
    for row in frame[frame.v.notna()].itertuples():
        assert filled[row.id] == row.v


def test_category_imputation_by_vote(spark):
    rng = np.random.default_rng(4)
    n = 300
    frame = pd.DataFrame({"id": range(n), "x": rng.normal(size=n), "y": rng.normal(size=n), "z": rng.normal(size=n)})
    kind = np.where(frame.x + frame.y > 0, "up", "down").astype(object)
    kind[::6] = None
    frame["t"] = kind
    df = spark.createDataFrame(frame.values.tolist(), "id int, x double, y double, z double, t string")
    filled = {r.id: r.t for r in impute.impute_category(df, "t", ["x", "y", "z"], "id", donors_per_cell=4).collect()}
    for i, near in _brute_neighbours(frame, "t", ["x", "y", "z"], 7, 3).items():
        assert filled[i] == max(sorted(set(near)), key=near.count)


def test_impute_missing_leaves_nothing_open(spark):
    df = spark.range(200).select(
        F.col("id").alias("customer_id"), F.when(F.col("id") % 9 != 0, F.col("id") * 2.0).alias("a"), (F.col("id") * 1.0).alias("b"),
        F.when(F.col("id") % 7 != 0, F.when(F.col("id") < 100, "low").otherwise("high")).alias("t"),
    )
    out = impute.impute_missing(df)
    assert out.columns == df.columns and out.count() == 200
    assert out.filter("a is null or t is null").count() == 0
    assert {r.t for r in out.filter("customer_id < 90").collect()} == {"low"}


def test_impute_missing_without_comparable_columns(spark):
    df = spark.createDataFrame([(1, 2.0, None), (2, 4.0, None), (3, None, "x")], "customer_id int, a double, t string")
    assert [r[0] for r in values(impute.impute_missing(df, columns=["a"]).orderBy("customer_id"), "a")] == [2.0, 4.0, 3.0]
    whole = impute.impute_missing(df).orderBy("customer_id")  # the numbers filled first decide about the text
    assert [r[0] for r in values(whole, "a")] == [2.0, 4.0, 3.0] and {r[0] for r in values(whole, "t")} == {"x"}
    empty = df.withColumn("a", F.lit(None).cast("double"))
    with pytest.raises(ValueError, match="fill t"):
        impute.impute_missing(empty)


def test_nearest_donors_of_ten_coordinates(spark):
    rng = random.Random(4)
    d, k = 10, 2
    donors = [(i, float(i), *[rng.random() for _ in range(d)]) for i in range(400)]
    queries = [(i, *[rng.random() for _ in range(d)]) for i in range(15)]
    points = ", ".join(f"_f{i} double" for i in range(d))
    near = impute.nearest_donors(
        spark.createDataFrame(queries, f"_q int, {points}"), spark.createDataFrame(donors, f"_key int, _value double, {points}"),
        d, k, donors_per_cell=1,
    )
    want = {
        (q[0], x[0]) for q in queries
        for x in sorted(donors, key=lambda x: (sum((a - b) ** 2 for a, b in zip(q[1:], x[2:])), x[0]))[:k]
    }
    assert {(r._q, r._key) for r in near.collect()} == want


def test_nearest_donors_of_a_wide_and_two_narrow_coordinates(spark):
    """A coordinate far wider than the others is cut more often than they are, so queries meet few donors."""
    points = [(i, i * 7919 % 3000 / 1.0, float(i * 31 % 50), float(i % 8)) for i in range(3000)]
    donors = spark.createDataFrame([(k, str(k), *p) for k, *p in points], "_key long, _value string, _f0 double, _f1 double, _f2 double")
    asked = [(q, q * 37.5, float(q % 47), float(q % 7)) for q in range(60)]
    queries = spark.createDataFrame(asked, "_q long, _f0 double, _f1 double, _f2 double")
    found = impute.nearest_donors(queries, donors, 3, 7, donors_per_cell=8).collect()
    for q, *at in asked:
        want = sorted((sum((a - b) ** 2 for a, b in zip(at, p)), k) for k, *p in points)[:7]
        assert sorted((r["_d"], r["_key"]) for r in found if r["_q"] == q) == want
    marks = [[i * s for i in range(1, 1024)] for s in (2.0, 0.05)] + [[float(i // 200) for i in range(1023)], [3.0] * 1023]
    lags, most = impute._cut_at(marks)
    assert lags == [0, 5, 9, impute.MAX_LAG] and most == [impute.MAX_CUT, impute.MAX_CUT, 3, 1]
