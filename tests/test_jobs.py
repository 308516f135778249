"""Whole jobs on the small tables: reports, targets, test customers, independence of the partitioning."""

from __future__ import annotations

import pytest

from offerforge.operators.model import split_bucket
from offerforge.plans import fixtures as fx
from offerforge.plans import jobs, queries_jobs
from offerforge.plans.fixtures import AS_OF

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def funds(spark):
    return queries_jobs.preprocessed_account(spark, SF_DIR, "funds")


def test_reports_are_tables(funds):
    got = {name: report().count() for name, report in funds.reports.items()}
    assert got["schema"] > 5 and got["unique_values"] == got["schema"] and got["outliers"] >= 3
    assert got["top_correlations"] == jobs.TOP_PAIRS


def test_target_is_carried_with_its_customer(spark, funds):
    raw = queries_jobs.account_customers(spark, SF_DIR, "funds")
    expected = {r.customer_id.lower(): r.fund_type.lower() for r in raw.collect()}
    assert {r.customer_id: r.fund_type for r in funds.features.collect()} == expected
    assert funds.features.columns[-1] == "fund_type"


def test_features_do_not_depend_on_partitions(spark, funds):
    raw = queries_jobs.account_customers(spark, SF_DIR, "funds").repartition(7)
    again = jobs.preprocess(raw, jobs.PREPROCESS["funds"], AS_OF, fx.cities(spark, SF_DIR)).features
    assert again.columns == funds.features.columns
    assert sorted(map(str, again.collect())) == sorted(map(str, funds.features.collect()))


def test_offers_are_for_test_customers_in_rank_order(funds):
    done = jobs.recommend_multiclass(funds.features, funds.snapshot, "fund_type", "fund_top3_reco", rounds=2)
    rows = done.offers.withColumn("_b", split_bucket("customer_id")).collect()
    assert rows and all(r._b < 20 for r in rows)
    assert len(rows) == funds.features.filter(split_bucket("customer_id") < 20).count()
    for r in rows:
        scores = [o.score for o in r.fund_top3_reco]
        assert scores == sorted(scores, reverse=True) and sum(scores) == pytest.approx(1.0)
        assert {o.label for o in r.fund_top3_reco} == {"debt", "equity", "hybrid"}
    assert 0 <= done.accuracy.first().accuracy <= 100


def test_binary_offer_is_empty_or_above_the_threshold(spark):
    done = queries_jobs.preprocessed_account(spark, SF_DIR, "current_account")
    result = jobs.recommend_binary(done.features, done.snapshot, "current_acc_avl", "current_account", "reco")
    for r in result.offers.collect():
        assert r.reco == {} or r.reco["current_account"] > jobs.OFFER_THRESHOLD


def test_insurance_offers_for_customers_of_any_line(spark):
    tables = queries_jobs.insurance_tables(spark, SF_DIR, "travel", "medical")
    combined, hits = jobs.recommend_insurance(tables, rounds=2)
    rows = combined.collect()
    assert set(hits) == {"travel", "medical"}
    assert rows and all(r.travel_top3_reco or r.medical_top3_reco for r in rows)
    assert len({r.customer_id for r in rows}) == len(rows)


def test_plans_have_no_cross_joins_or_row_functions(spark):
    from offerforge.plans.all_queries import QUERIES

    names = ("card_upsell_offers", "address_distance", "outer_master", "dedup_keep_last", "corr_pairs", "rule_three_products",
             "histogram", "value_frequency", "topk_decode", "occupation_rules", "hot_key_lookup")
    for name in names:
        df = QUERIES[name](spark, SF_DIR)
        plan = df._jdf.queryExecution().executedPlan().toString()
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
            assert bad not in plan, f"{bad} in {name}"


def test_consolidation_reads_the_transactions_once(spark):
    df = jobs.consolidate_card(fx.card_transactions(spark, SF_DIR))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_loan_enrichment_rules(spark):
    for r in queries_jobs.enriched_loans(spark, SF_DIR).collect():
        if r.loan_availed == "Business Growth Loan":
            assert (r.occupation, r.self_employed) == ("Business", "Yes")
        elif r.education == "Graduate":
            assert r.occupation in ("Engineer", "Doctor", "Lawyer")
            assert r.occupation != "Engineer" or r.self_employed == "No"
        else:
            assert r.occupation in ("Plumber", "Welder", "BrickLayer") and r.self_employed == "Yes"


def test_insurance_lines_are_trained_at_the_same_time(spark, monkeypatch):
    """Each of two lines waits for the other; one after the other they would not end."""
    import threading

    gate, frame = threading.Barrier(2), spark.createDataFrame([("a", 1)], "customer_id string, x int")

    def waits(features, snapshot, target, name, **options):
        gate.wait(30)
        return jobs.Recommended(frame.withColumnRenamed("x", name), None, None)

    monkeypatch.setattr(jobs, "recommend_multiclass", waits)
    tables = jobs.InsuranceTables({"one": frame, "two": frame}, jobs.Preprocessed(frame, frame, None), frame)
    combined, hits = jobs.recommend_insurance(tables)
    assert list(hits) == ["one", "two"] and combined.count() == 1


def test_offers_of_a_wide_step_and_of_a_forest(spark):
    """Only those who say yes get the offer of the wide step, and the forest is sure of what one feature tells."""
    df = spark.range(600).selectExpr("concat('c', id) AS customer_id", "id % 3 AS f", "CASE WHEN id % 3 = 1 THEN 'yes' ELSE 'no' END AS y")
    done = jobs.recommend_binary(df, df, "y", "card", "slow", wide="quick").offers.collect()
    assert done and all(len(r["slow"]) == 1 and len(r["quick"]) == (r["f"] == 1) for r in done)
    ranked = jobs.recommend_multiclass(df, df, "y", "boosted", forest="forest").offers.collect()
    assert ranked and all(r["forest"][0]["score"] == 1 and r["forest"][0]["label"] == ("yes" if r["f"] == 1 else "no") for r in ranked)


def test_offers_of_the_forest_are_checked_as_a_whole(spark):
    """All offers of the forest count, not its best one alone: how many, their order, their sum."""
    offer = "array<struct<label:string,score:double>>"
    rows = [("a", 1, [("x", 0.9), ("y", 0.1)], [("x", 1.0), ("y", 0.0), ("z", 0.0)]),
            ("b", 2, [("x", 0.9), ("y", 0.1)], [("x", 0.2), ("y", 0.7)])]
    done = jobs.Recommended(spark.createDataFrame(rows, f"customer_id string, age int, top {offer}, _forest {offer}"), None, None)
    found = queries_jobs._answers(done, "top", "_forest", forest_held=True).orderBy("customer_id")
    held = found.select("forest_n_offers", "forest_descending", "forest_whole").collect()
    assert [tuple(r) for r in held] == [(3, True, True), (2, False, False)]
