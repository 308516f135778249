"""Decoding, ladder, eligibility rules against a plain walk, models on a planted signal."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from offerforge.operators import eligibility, model, recommend
from offerforge.sources.rules import (
    CATALOGUES, catalogue_rules, read_rule_block, read_rule_file, read_rules, rule_lines, rule_rows,
)


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_decoding_ties_take_the_first(spark):
    df = spark.createDataFrame([([0.2, 0.4, 0.4, 0.0],)], "p array<double>")
    top = recommend.top_offers(F.col("p"), list("abcd"), 3)
    assert values(df, recommend.top_index(F.col("p")))[0][0] == 1
    assert [(o.label, o.score) for o in values(df, top)[0][0]] == [("b", 0.4), ("c", 0.4), ("a", 0.2)]
    assert values(df, recommend.offers_map(top)) == [({"b": 0.4, "c": 0.4, "a": 0.2},)]


def test_threshold_is_strict(spark):
    df = spark.createDataFrame([(0.4,), (0.41,), (None,)], "s double")
    assert [r[0] for r in values(df, recommend.threshold_offer(F.col("s"), "t", 0.4))] == [{}, {"t": 0.41}, {}]


@pytest.mark.parametrize(
    "card,spent,trans,expected",
    [
        ("silver", "fuel", "fuel", [("gold fuel", 0.75), ("platinum fuel", 0.25)]),
        ("silver", "fuel", "food", [("gold fuel", 0.75), ("gold food", 0.25)]),
        ("gold", "fuel", "fuel", [("platinum fuel", 0.75), ("signature fuel", 0.25)]),
        ("gold", "fuel", "food", [("platinum fuel", 0.75), ("platinum food", 0.25)]),
        ("platinum", "fuel", "fuel", [("platinum fuel", 0.75), ("signature fuel", 0.25)]),
        ("platinum", "fuel", "food", [("signature fuel", 0.75), ("signature food", 0.25)]),
        ("signature", "fuel", "fuel", [("signature fuel", 0.75)]),
        ("signature", "fuel", "food", [("signature fuel", 0.75), ("signature food", 0.25)]),
        ("bronze", "fuel", "food", []),
        ("gold", None, "food", [("platinum food", 0.25)]),
        ("gold", None, None, []),
    ],
)
def test_card_ladder(spark, card, spent, trans, expected):
    df = spark.createDataFrame([(card, spent, trans)], "c string, s string, t string")
    got = values(df, recommend.ladder_offers(F.col("c"), F.col("s"), F.col("t")))[0][0]
    assert [(o.label, o.score) for o in got] == expected


def test_churn_addons_per_row(spark):
    df = spark.createDataFrame([(1, 1, 0.8), (0, 1, 0.5), (1, 1, 0.3)], "a_b_c_gold int, a_b_c_fuel int, s double")
    got = [r[0] for r in values(df, recommend.churn_addon_offers(["a_b_c_gold", "a_b_c_fuel"], F.col("s"), 0.4))]
    assert got == [["gold:0.8", "fuel:0.8"], ["fuel:0.5"], []]


def _walk(row, candidates, rules):
    """First candidate all of whose rules hold."""
    for name in candidates or []:
        fine = True
        for product, _, attribute, kind, low, high, members in rules:
            if product != name:
                continue
            value = row[attribute]
            if kind in ("int", "non-list"):
                if low is not None and not (value is not None and value > low):
                    fine = False
                if high is not None and not (value is not None and value < high):
                    fine = False
            elif kind == "list":
                fine = fine and value is not None and value.lower() in [m.lower() for m in members]
            else:
                fine = False
        if fine:
            return name
    return "no recommendation"


RULES = [
    ("a", 0, "income", "int", 0.0, None, None), ("a", 1, "town", "list", None, None, ["X", "y"]),
    ("b", 0, "income", "non-list", 10.0, 20.0, None), ("c", 0, "income", "odd", None, None, None),
    ("d", 0, "income", "int", None, None, None),
]


@pytest.mark.parametrize("compiled", [500, 0])
def test_final_offer_like_a_walk(spark, compiled):
    rng = random.Random(2)
    rows = []
    for i in range(300):
        names = rng.choice([None, [], *[rng.sample(["a", "b", "c", "d", "free"], rng.randint(1, 3)) for _ in range(8)]])
        rows.append((i, rng.choice([None, -1.0, 0.0, 0.5, 10.0, 15.0, 20.0]), rng.choice([None, "x", "Y", "z"]), names))
    df = spark.createDataFrame(rows, "customer_id int, income double, town string, names array<string>").repartition(3)
    out = eligibility.with_final_offer(df, "names", rule_rows(spark, RULES), "final", max_compiled_rules=compiled)
    got = dict(values(out, "customer_id", "final"))
    assert got == {i: _walk({"income": v, "town": t}, names, RULES) for i, v, t, names in rows}


def test_rules_on_absent_columns_are_reported(spark):
    df = spark.createDataFrame([(1, ["a"])], "customer_id int, names array<string>")
    with pytest.raises(ValueError, match="income"):
        eligibility.with_final_offer(df, "names", rule_rows(spark, RULES[:1]), "final")


def test_rule_file_and_shipped_catalogue_agree(spark, tmp_path):
    pytest.importorskip("yaml")
    lines = ["medical_insurance:"]
    for product, rules in CATALOGUES["medical_insurance"].items():
        lines.append(f"  {product}:")
        for attribute, low, high in rules:
            lines += [f"    - attribute : {attribute}", "      type: int", "      required_values:",
                      f"        min: {low if low is not None else False}", f"        max: {high if high is not None else False}"]
    path = tmp_path / "rules.yml"
    path.write_text("\n".join(lines))
    got = sorted(map(str, read_rules(spark, str(path), "medical_insurance").collect()))
    assert got == sorted(map(str, catalogue_rules(spark, "medical_insurance").collect()))


def test_rule_block_is_read_whole_or_refused(spark, tmp_path):
    rules = catalogue_rules(spark, "motor_insurance").unionByName(catalogue_rules(spark, "occupation"))
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    rule_lines(rules, "all").write.text(good)
    assert sorted(map(str, read_rule_block(spark, good, "all").collect())) == sorted(map(str, rules.collect()))
    assert read_rule_block(spark, good, "none").count() == 0
    lines = ['{"block": "b", "product": "p", "rule_no": 0, "attribute": "a", "type": "int", "required_values": {"min": false, "max": 0}}',
             '{"block": "b", "product": "p", "rule_no": 1, "attribute": "a", "type": "list", "values": [null]}', "nothing"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(bad)
    found = sorted(map(str, values(read_rule_file(spark, bad), "min", "max", "refused")))
    assert found == sorted(map(str, [(None, 0.0, None), (None, None, "list without values"), (None, None, "not a rule")]))
    with pytest.raises(ValueError, match="list without values"):
        read_rule_block(spark, bad, "b")


def test_split_is_stable_disjoint_and_whole(spark):
    df = spark.range(2000).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("customer_id"))
    parts = [model.key_split(df.repartition(n)) for n in (1, 7)]
    tests = [{r[0] for r in values(test, "*")} for _, test in parts]
    assert tests[0] == tests[1] and 300 < len(tests[0]) < 500
    assert {r[0] for r in values(parts[0][0], "*")}.isdisjoint(tests[0])
    assert parts[0][0].count() + len(tests[0]) == 2000


def planted(spark):
    return spark.range(1500).select(
        F.col("id").alias("customer_id"), (F.col("id") % 3).cast("double").alias("signal"), F.rand(1).alias("noise"),
        F.when(F.col("id") % 50 == 0, None).otherwise(F.rand(2)).alias("holes"),
        F.concat(F.lit("k"), (F.col("id") % 3).cast("string")).alias("target"),
    )


@pytest.mark.parametrize("backend", ["forest", "boosted"])
def test_multiclass_finds_the_signal(spark, backend):
    df = planted(spark)
    train, test = model.key_split(df)
    trained = model.train_multiclass(train, "target", backend=backend, trees=5, rounds=2, depth=3)
    scored = trained.score(test)
    sums = [r[0] for r in values(scored, F.aggregate("probability", F.lit(0.0), lambda a, v: a + v))]
    assert sums == pytest.approx([1.0] * len(sums))
    best = scored.select("target", F.get(F.array(*[F.lit(v) for v in trained.labels]), recommend.top_index(F.col("probability")).cast("int")).alias("best"))
    assert values(model.accuracy(best, "target", "best"), "accuracy") == [(100.0,)]
    assert trained.importance(2).first().feature == "signal"


def test_binary_scores_part_the_classes(spark):
    df = planted(spark).withColumn("target", F.when(F.col("signal") > 0, "yes").otherwise("no"))
    trained = model.train_binary(df, "target", rounds=3)
    means = dict(values(trained.score(df).groupBy("target").agg(F.avg(F.get("probability", F.lit(1))).alias("m")), "target", "m"))
    assert means["yes"] > means["no"]


def test_small_steps_stay_near_one_half(spark):
    df = planted(spark).withColumn("target", F.when(F.col("signal") > 0, "yes").otherwise("no"))
    trained = model.train_binary(df, "target", rounds=10)
    low, high = trained.score(df).agg(F.min(F.get("probability", F.lit(1))), F.max(F.get("probability", F.lit(1)))).first()
    assert 0.45 < low < 0.5 < high < 0.56


def test_boosting_does_not_depend_on_the_partitioning(spark):
    def fitted(parts):
        df = planted(spark).select("customer_id", "signal", F.xxhash64("customer_id").alias("noise"), "target")
        return model.train_multiclass(df.repartition(parts), "target", rounds=2, depth=2)

    one, many = fitted(1), fitted(7)
    assert one.cuts == many.cuts
    for a, b in zip([t for r in one.rounds for t in r], [t for r in many.rounds for t in r]):
        assert [x.tolist() for x in (a.feature, a.cut, a.value)] == [x.tolist() for x in (b.feature, b.cut, b.value)]


def test_boosting_with_missing_values_and_one_class(spark):
    df = spark.createDataFrame([(i, None if i % 3 == 0 else float(i % 3), "a" if i % 3 == 0 else "b") for i in range(60)],
                               "customer_id long, x double, target string")
    trained = model.train_multiclass(df, "target", rounds=3, depth=2)
    best = trained.score(df).select("target", F.when(F.get("probability", F.lit(1)) > 0.5, "b").otherwise("a").alias("best"))
    assert values(model.accuracy(best, "target", "best"), "accuracy") == [(100.0,)]
    single = model.train_multiclass(df.filter("target = 'a'"), "target", rounds=3)
    assert values(single.score(df).limit(2), "probability") == [([1.0],), ([1.0],)]


def test_rows_alike_are_one_row_of_boosted_trees(spark):
    """The passes read as many rows as there are kinds of rows, and their sums are those of all rows."""
    from offerforge.operators import boost

    df = spark.range(2400).selectExpr("id", "id % 12 AS month", "int(id % 3) AS y")
    cuts, n = boost.fit_bins(df, ["month"])
    model = boost.BoostedModel(("month",), ("a", "b", "c"), cuts)
    roots = tuple(boost.Tree.empty(1) for _ in range(3))
    one, each = (boost.binned_rows(df, model, F.col("y"), F.col("id"), n, alike=a) for a in (True, False))
    assert one.count() == 12 and one.agg(F.sum("n")).first()[0] == 2400 and each.count() == 2400
    sums = [sorted(map(tuple, boost.gradient_sums(x, model, roots, 0).collect())) for x in (one, each)]
    assert sums[0] == sums[1] and sums[0]


def test_rows_alike_count_in_entropy_trees(spark):
    from offerforge.operators import boost, entropy

    df = spark.range(700).selectExpr("id", "id % 7 AS f", "int(id % 7 > 3) AS y")
    cuts, n = boost.fit_bins(df, ["f"])
    rows = boost.binned_rows(df, boost.BoostedModel(("f",), ("a", "b"), cuts), F.col("y"), F.col("y"), n)
    counts = entropy.label_counts(rows, [boost.Tree.empty(1)], 1, 2, 0).collect()
    assert rows.count() == 7 and [r["n"] for r in counts] == [100] * 7
