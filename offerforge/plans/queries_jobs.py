"""Registered queries: models and whole product-line jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerforge.operators import model, recommend
from offerforge.operators.eligibility import with_final_offers
from offerforge.operators.profile import value_frequency
from offerforge.plans import fixtures as fx
from offerforge.plans import jobs
from offerforge.plans.fixtures import AS_OF, CTES, age_sql, tenure_sql, with_sql
from offerforge.plans.queries_features import (
    ADDRESSES, EDGES_ROW_SQL, KM_SQL, LOCATED, TIER_SQL, choice_sql,
)
from offerforge.plans.queries_offers import CARD_OFFERS, LINES, _final_sql, _line_steps, insurance_candidates
from offerforge.plans.queries_relational import consolidation_steps, rounded_amounts
from offerforge.plans.registry import query, table
from offerforge.session import scratch_path, written
from offerforge.sources.rules import catalogue_rules
from offerforge.sources.tables import candidate_names, read_csv_table, write_csv_table

FUNDS = ("Equity", "Debt", "Hybrid")
TIERS = ("Basic", "Silver", "Gold", "Platinum")
INSURANCES = ("Travel", "Motor", "Medical", "Home")
LOANS = ("Business Growth Loan", "Home Loan", "Car Loan", "Personal Loan")

# --- models -------------------------------------------------------------------------------------------------------


def score_features(spark, sf_dir) -> DataFrame:
    """One column per coordinate of the vectors, with the label as class name."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.concat(F.lit("class_"), F.col("label").cast("string")).alias("label"),
        *[F.get("embedding", F.lit(i)).cast("double").alias(f"f{i}") for i in range(64)],
    )


@query("train_multiclass")
def train_multiclass(spark, sf_dir):
    """Test rows with their three best classes from a forest."""
    train, test = model.key_split(score_features(spark, sf_dir), "vec_id")
    trained = model.train_multiclass(train, "label", "vec_id", backend="forest")
    offers = trained.score(test).select(
        "vec_id", recommend.top_offers(F.col("probability"), trained.labels, 3).alias("offers")
    )
    return recommend.explode_offers(offers, "offers", "vec_id")


@query("train_multiclass_boosted")
def train_multiclass_boosted(spark, sf_dir):
    """Order status from boosted trees with the library's depth and rounds."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", F.month("o_orderdate").alias("month"), F.year("o_orderdate").alias("year")
    )
    train, test = model.key_split(orders, "o_orderkey")
    trained = model.train_multiclass(train, "o_orderstatus", "o_orderkey")
    offers = trained.score(test).select(
        "o_orderkey", recommend.top_offers(F.col("probability"), trained.labels, 3).alias("offers")
    )
    return recommend.explode_offers(offers, "offers", "o_orderkey")


def document_answers(spark, sf_dir) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", "n_chars", F.size(F.split("text", r"\s+")).alias("words"), F.size(F.split("text", "\n")).alias("lines")
    )
    labels = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "yes").otherwise("no").alias("good"))
    return documents.join(labels, "doc_id", "left")


@query("train_binary")
def train_binary(spark, sf_dir):
    """Every document with the score of a good label, learnt from the labelled ones."""
    documents = document_answers(spark, sf_dir)
    train, _ = model.key_split(documents.filter(F.col("good").isNotNull()), "doc_id")
    trained = model.train_binary(train, "good", "doc_id")
    return trained.score(documents).select("doc_id", F.get("probability", F.lit(1)).alias("score"))


def quarter_orders(spark, sf_dir) -> DataFrame:
    """Orders by their month, which tells the quarter and the half of the year, with two columns that tell nothing."""
    month = F.month("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", month.alias("month"), F.lit(1.0).alias("one"), F.lit(7).alias("seven"),
        F.concat(F.lit("q"), F.quarter("o_orderdate").cast("string")).alias("quarter"),
        F.when(month <= 6, "yes").otherwise("no").alias("early"),
    )


_TEST_ORDERS = "FROM orders WHERE CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 20"
_QUARTER = "'q' || CAST(quarter(o_orderdate) AS VARCHAR)"


def _quarter_answers(spark, sf_dir, **options) -> DataFrame:
    train, test = model.key_split(quarter_orders(spark, sf_dir), "o_orderkey")
    trained = model.train_multiclass(train, "quarter", "o_orderkey", **options)
    p = F.col("probability")
    top = recommend.top_offers(p, trained.labels, 3)
    scores = F.transform(top, lambda o: o["score"])
    return trained.score(test).select(
        "o_orderkey", top[0]["label"].alias("best"), F.size(top).cast("bigint").alias("n_offers"), F.round(top[0]["score"], 9).alias("score"),
        (F.sort_array(scores, asc=False) == scores).alias("descending"),
        (F.abs(F.aggregate(p, F.lit(0.0), lambda a, x: a + x) - 1) < 1e-9).alias("whole"),
    )


@query(
    "known_multiclass_forest",
    f"SELECT o_orderkey, {_QUARTER} AS best, CAST(3 AS BIGINT) AS n_offers, CAST(1 AS DOUBLE) AS score, true AS descending, "
    f"true AS whole {_TEST_ORDERS}",
)
def known_multiclass_forest(spark, sf_dir):
    """A forest learns exactly what one feature tells."""
    return _quarter_answers(spark, sf_dir, backend="forest", subset="all")


@query(
    "known_multiclass_boosted",
    f"SELECT o_orderkey, {_QUARTER} AS best, CAST(3 AS BIGINT) AS n_offers, true AS descending, true AS whole {_TEST_ORDERS}",
)
def known_multiclass_boosted(spark, sf_dir):
    """Boosted trees with one softmax pick the class that one feature tells."""
    return _quarter_answers(spark, sf_dir).drop("score")


@query(
    "known_binary",
    f"SELECT o_orderkey, CASE WHEN month(o_orderdate) <= 6 THEN 'early bird' END AS offer {_TEST_ORDERS}",
)
def known_binary(spark, sf_dir):
    """The offer goes to exactly the rows whose answer is yes."""
    train, test = model.key_split(quarter_orders(spark, sf_dir).drop("quarter"), "o_orderkey")
    trained = model.train_binary(train, "early", "o_orderkey", step=model.MULTICLASS_STEP)
    offers = recommend.threshold_offer(F.get("probability", F.lit(1)), "early bird", 0.4)
    return trained.score(test).select("o_orderkey", F.explode_outer(offers).alias("offer", "score")).drop("score")


@query(
    "known_importance",
    "SELECT * FROM (VALUES ('month', CAST(1 AS DOUBLE)), ('one', CAST(0 AS DOUBLE)), ('seven', CAST(0 AS DOUBLE))) t(feature, importance)",
)
def known_importance(spark, sf_dir):
    """All importance is with the one feature that tells something."""
    orders = quarter_orders(spark, sf_dir).drop("early")
    return model.train_multiclass(orders, "quarter", "o_orderkey").importance()


@query("feature_importance")
def feature_importance(spark, sf_dir):
    return model.train_multiclass(score_features(spark, sf_dir), "label", "vec_id", backend="forest").importance()


# --- preprocessing jobs -------------------------------------------------------------------------------------------


def card_customers(spark, sf_dir) -> DataFrame:
    """Customers with a row per order; the last order decides."""
    orders = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("customer_id"), F.col("o_orderkey").alias("row_no"),
        F.col("o_orderpriority").alias("card_type"), F.col("o_totalprice").alias("income"),
    )
    customers = fx.customers(spark, sf_dir).select("customer_id", "gender", "occupation", "marital_status", "dob", "city")
    return customers.join(orders, "customer_id")


def _account_target(job: str):
    """Target column of a job, from the occupation or marital status, which become features: a model can learn it exactly."""
    length, initial = F.length("occupation"), F.ascii(F.lower("marital_status"))
    return {
        "current_account": lambda: F.when(length == 9, "Yes").otherwise("No").alias("current_acc_avl"),
        "term_deposit": lambda: F.when(F.col("marital_status") == "Married", "Yes").otherwise("No").alias("term_dep_avl"),
        "funds": lambda: fx.pick(length, FUNDS).alias("fund_type"),
        "savings_account": lambda: fx.pick(length, TIERS).alias("savings_account_avl"),
        "insurance_cross_sell": lambda: fx.pick(initial, INSURANCES).alias("insurance"),
    }[job]()


_PLAIN = ("customer_id", "gender", "occupation", "marital_status", "dob", "customer_to_bank", "city", "income")


def account_customers(spark, sf_dir, job: str) -> DataFrame:
    more = {"insurance_cross_sell": ("branch_group",), "current_account": ("property_area",)}.get(job, ())
    return fx.customers(spark, sf_dir).select(*_PLAIN, *more, _account_target(job))


def loan_customers(spark, sf_dir, target: str) -> DataFrame:
    loan = fx.pick(F.ascii(F.lower("property_area")), LOANS).alias(target)
    return fx.customers(spark, sf_dir).select(
        "customer_id", "gender", "marital_status", "property_area", "dob", "customer_to_bank", "address",
        (F.col("income") * 100).alias("applicant_income"),
        fx.pick(F.col("number"), ("0", "1", "2")).cast("double").alias("coapplicant_income"),
        F.col("top_price").alias("loan_amt"), loan,
    )


_SPREADS = {
    "occupation": ("automobile", "building", "furniture", "household", "machinery"),
    "city_grp": ("t0", "t1", "t2", "t3", "unknown"),
    "branch_group": tuple(f"g{i}" for i in range(14)),
    "property_area": ("urban", "rural", "semiurban", "metro"),
    "product_name": tuple(f"p{i}" for i in range(16)),
    "collision_type": ("front", "rear", "side"),
    "incident_hour_of_the_day": ("morning", "evening", "night"),
    "alarm": ("y", "n"), "roof": ("f", "o", "p"), "walls": ("brick", "wood", "stone", "mixed"),
    "risk_class": ("a", "b", "c", "d", "e", "f"),
}
_CODES = {
    "marital_status": ("married", "single"), "customer_rel_dur_segment": ("new_customer", "old_customer"),
    "channel": ("offline", "online"), "smoker": ("no", "yes"), "tenure_kind": ("let", "owned"), "listing": ("f", "o", "p"),
    "kind": ("farm", "flat", "house", "villa"),
}


def _hot_sql(*columns: str, **lists: tuple[str, ...]) -> str:
    lists = {c: _SPREADS[c] for c in columns} | lists
    return ", ".join(f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS \"{c}_{v}\"" for c, values in lists.items() for v in values)


def _code_sql(*columns: str) -> str:
    return ", ".join(
        f"CAST(CASE {c} " + " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(_CODES[c])) + f" END AS BIGINT) AS {c}"
        for c in columns
    )


def _log_sql(*columns: str) -> str:
    return ", ".join(f"round(log10(CASE WHEN {c} > 0 THEN {c} END), 6) AS {c}" for c in columns)


_POPULATED = (
    "SELECT c.*, coalesce(population, 0) AS population FROM derived c LEFT JOIN cities t ON lower(trim(c.city)) = lower(trim(t.city))"
)
_TIERED = {
    "populated": _POPULATED, "edges": EDGES_ROW_SQL,
    "enriched": f"SELECT p.*, {TIER_SQL} AS city_grp FROM populated p, edges e",
}
_SEGMENT = f"CASE WHEN {tenure_sql('customer_to_bank')} > 24 THEN 'old_customer' ELSE 'new_customer' END AS customer_rel_dur_segment"
_DERIVED = (
    f"SELECT lower(customer_id) AS customer_id, lower(occupation) AS occupation, lower(marital_status) AS marital_status, "
    f"{age_sql('dob')} AS age, {tenure_sql('customer_to_bank')} AS customer_since_months, {_SEGMENT}, city, income, "
    "lower(branch_group) AS branch_group, lower(property_area) AS property_area, n_orders, top_price FROM customers"
)


def _account_sql(target: str, spread: tuple[str, ...], kept: tuple[str, ...] = ()) -> str:
    columns = ", ".join(
        x for x in (
            "customer_id, age, customer_since_months", _log_sql("income"),
            _code_sql("marital_status", "customer_rel_dur_segment"), _hot_sql(*spread), *kept, target,
        ) if x
    )
    return with_sql("customers cities", f"SELECT {columns} FROM enriched", derived=_DERIVED, **_TIERED)


def _pick(number: str, values) -> str:
    return fx._pick_sql(number, tuple(v.lower() for v in values))


_TARGET_SQL = {
    "current_account": "CASE WHEN length(occupation) = 9 THEN 'yes' ELSE 'no' END",
    "term_deposit": "CASE WHEN marital_status = 'married' THEN 'yes' ELSE 'no' END",
    "funds": _pick("length(occupation)", FUNDS),
    "savings_account": _pick("length(occupation)", TIERS),
    "insurance_cross_sell": _pick("ascii(marital_status)", INSURANCES),
    "loan_cross_sell": _pick("ascii(property_area)", LOANS),
    "loan_up_sell": _pick("ascii(property_area)", LOANS),
}
_ACCOUNT_SQL = {
    "current_account": _account_sql(
        f"{_TARGET_SQL['current_account']} AS current_acc_avl", ("occupation", "city_grp", "property_area")),
    "term_deposit": _account_sql(f"{_TARGET_SQL['term_deposit']} AS term_dep_avl", ("occupation", "city_grp")),
    "funds": _account_sql(f"{_TARGET_SQL['funds']} AS fund_type", ("occupation", "city_grp")),
    "savings_account": _account_sql(f"{_TARGET_SQL['savings_account']} AS savings_account_avl", ("occupation", "city_grp")),
    "insurance_cross_sell": _account_sql(
        f"{_TARGET_SQL['insurance_cross_sell']} AS insurance", ("branch_group",), ("occupation", "city_grp")),
}


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def preprocessed_account(spark, sf_dir, job: str) -> jobs.Preprocessed:
    return jobs.preprocess(account_customers(spark, sf_dir, job), jobs.PREPROCESS[job], AS_OF, fx.cities(spark, sf_dir))


def _register_account(job: str) -> None:
    @query(f"job_{job}_features", _ACCOUNT_SQL[job])
    def features(spark, sf_dir):
        return _rounded(preprocessed_account(spark, sf_dir, job).features, "income")


for _job in _ACCOUNT_SQL:
    _register_account(_job)


_CARD_DERIVED = (
    "SELECT lower(customer_id) AS customer_id, lower(occupation) AS occupation, lower(marital_status) AS marital_status, "
    f"{age_sql('dob')} AS age, city, last_price AS income, lower(last_priority) AS card_type FROM customers JOIN "
    "(SELECT o_custkey AS k, arg_max(o_totalprice, o_orderkey) AS last_price, arg_max(o_orderpriority, o_orderkey) AS last_priority "
    "FROM orders GROUP BY o_custkey) ON number = k"
)


def preprocessed_card_cross_sell(spark, sf_dir, **replaced) -> jobs.Preprocessed:
    return jobs.preprocess(
        card_customers(spark, sf_dir).withColumns(replaced), jobs.PREPROCESS["card_cross_sell"], AS_OF, fx.cities(spark, sf_dir), order_by="row_no"
    )


@query(
    "job_card_cross_sell_features",
    with_sql(
        "customers cities",
        f"SELECT customer_id, age, {_log_sql('income')}, {_code_sql('marital_status')}, {_hot_sql('occupation', 'city_grp')}, "
        "card_type FROM enriched",
        derived=_CARD_DERIVED, **_TIERED,
    ),
)
def job_card_cross_sell_features(spark, sf_dir):
    return _rounded(preprocessed_card_cross_sell(spark, sf_dir).features, "income")


@query(
    "job_card_cross_sell_snapshot",
    with_sql(
        "customers cities",
        "SELECT customer_id, occupation, marital_status, age, income, card_type, city_grp FROM enriched",
        derived=_CARD_DERIVED, **_TIERED,
    ),
)
def job_card_cross_sell_snapshot(spark, sf_dir):
    """The enriched table written as CSV and read back."""
    snapshot = preprocessed_card_cross_sell(spark, sf_dir).snapshot
    path = scratch_path(spark, "consolidated_for_comparison")
    write_csv_table(snapshot, path)
    return read_csv_table(spark, path, snapshot.schema)


_Z = "CASE WHEN abs(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()) > 2 THEN NULL ELSE {c} END AS {c}"


@query(
    "job_card_cross_sell_outliers",
    with_sql(
        "customers cities",
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS outlier FROM (SELECT {_Z.format(c=c)} FROM enriched)"
            for c in ("age", "income")
        ),
        derived=_CARD_DERIVED, **_TIERED,
    ),
)
def job_card_cross_sell_outliers(spark, sf_dir):
    return preprocessed_card_cross_sell(spark, sf_dir).reports["outliers"]()


_LABELS = ("occupation", "marital_status", "city_grp", "customer_rel_dur_segment")


@query(
    "job_funds_cardinality",
    with_sql(
        "customers cities",
        "SELECT n AS num_unique_values, string_agg(\"column\", ',' ORDER BY \"column\") AS columns FROM ("
        + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n FROM enriched" for c in ("customer_id", *_LABELS))
        + ") GROUP BY n",
        derived=_DERIVED, **_TIERED,
    ),
)
def job_funds_cardinality(spark, sf_dir):
    return preprocessed_account(spark, sf_dir, "funds").reports["cardinality"]()


_UP_TOTALS = ", ".join(f"{p}_amt, {p}_trans" for p in (*jobs.CARD_GROUPS, "total"))
_UP_STEPS = {
    **consolidation_steps(),
    "derived": f"SELECT customer_id, card_type, occupation, marital_status, income, {age_sql('dob')} AS age, "
    f"{tenure_sql('customer_to_bank')} AS customer_since_months, city, {_UP_TOTALS} FROM consolidated",
    **_TIERED,
}


@query(
    "job_card_up_sell_features",
    with_sql(
        "card_transactions cities",
        f"SELECT customer_id, card_type, {_log_sql('income')}, age, customer_since_months, {_UP_TOTALS}, "
        f"{_code_sql('marital_status')}, {_hot_sql('city_grp', occupation=('business', 'farmer', 'retired', 'salaried', 'student'))} "
        "FROM enriched",
        **_UP_STEPS,
    ),
)
def job_card_up_sell_features(spark, sf_dir):
    done = jobs.preprocess_card_up_sell(fx.card_transactions(spark, sf_dir), AS_OF, fx.cities(spark, sf_dir))
    return rounded_amounts(_rounded(done.features, "income"))


def _loan_sql(target: str) -> str:
    derived = (
        f"SELECT lower(customer_id) AS customer_id, lower(marital_status) AS marital_status, {age_sql('dob')} AS age, "
        f"{tenure_sql('customer_to_bank')} AS customer_since_months, {_SEGMENT}, lower(property_area) AS property_area, "
        f"income * 100 AS applicant_income, number % 3 AS coapplicant_income, top_price AS loan_amt, {_TARGET_SQL['loan_up_sell']} AS {target}, "
        "customer_id AS raw_id FROM customers"
    )
    return with_sql(
        "customers gazetteer",
        f"SELECT d.customer_id, age, customer_since_months, {_log_sql('applicant_income', 'coapplicant_income', 'loan_amt')}, "
        f"{_code_sql('marital_status', 'customer_rel_dur_segment')}, {_hot_sql('property_area')}, "
        f"CASE WHEN trunc(distance_km) < 15 THEN 1 ELSE 0 END AS address_near_by_bank, {target} "
        "FROM derived d JOIN located l ON l.customer_id = d.raw_id",
        derived=derived, located=LOCATED,
    )


def _register_loan(job: str, target: str) -> None:
    @query(f"job_{job}_features", _loan_sql(target))
    def features(spark, sf_dir):
        done = preprocessed_loan(spark, sf_dir, job)
        return _rounded(done.features, *jobs.LOAN_LOGS)


def preprocessed_loan(spark, sf_dir, job: str) -> jobs.Preprocessed:
    spec = jobs.PREPROCESS[job]
    loans = loan_customers(spark, sf_dir, spec.target)
    return jobs.preprocess(loans, spec, AS_OF, gazetteer=fx.gazetteer(spark, sf_dir))


_register_loan("loan_cross_sell", "loan_availed")
_register_loan("loan_up_sell", "loan_availed2")

_INSURED = {
    "derived": _DERIVED, **_TIERED,
    "base": "SELECT customer_id, age, customer_since_months, income, "
    f"{_code_sql('marital_status', 'customer_rel_dur_segment')}, {_hot_sql('branch_group')}, occupation, city_grp FROM enriched",
}
_LINE_SQL = {
    "travel": (
        f"SELECT lower(customer_id) AS customer_id, lower(agency) AS agency, net_sales, duration, "
        f"{_hot_sql('product_name')}, {_code_sql('channel')}, lower(travel_addon) AS travel_addon FROM "
        "(SELECT * REPLACE (lower(product_name) AS product_name, lower(channel) AS channel) FROM travel_policy)"
    ),
    "motor": (
        f"SELECT lower(customer_id) AS customer_id, {tenure_sql('incident_date', '%Y-%m-%d')} AS months_ago_incident_date, "
        "2002 - auto_year AS years_auto_old, 2002 - auto_year AS vehicle_age_yrs, "
        "CAST(split_part(policy_csl, '/', 1) AS BIGINT) AS bodily_injury_single_limit, "
        "CAST(split_part(policy_csl, '/', 2) AS BIGINT) AS bodily_injury_total_limit, "
        "round(capital_gains + capital_loss, 2) AS net_captial, CAST(CASE lower(incident_severity) WHEN 'total loss' THEN 0.8 "
        "WHEN 'major damage' THEN 0.6 WHEN 'minor damage' THEN 0.4 ELSE 0.2 END AS DOUBLE) AS incident_severity, "
        "CASE WHEN witnesses >= 2 THEN 2 ELSE witnesses END AS witnesses, CASE WHEN lower(auto_make) IN ('mercedes', 'bmw', 'audi') "
        "THEN 10000 ELSE 4000 END * (2002 - auto_year) AS auto_make, policy_annual_premium, "
        f"{_hot_sql('collision_type', 'incident_hour_of_the_day')}, lower(motor_addon) AS motor_addon FROM "
        "(SELECT * REPLACE (lower(collision_type) AS collision_type, CASE WHEN incident_hour_of_the_day >= 4 AND "
        "incident_hour_of_the_day < 12 THEN 'morning' WHEN incident_hour_of_the_day >= 12 AND incident_hour_of_the_day < 19 "
        "THEN 'evening' ELSE 'night' END AS incident_hour_of_the_day) FROM motor_policy)"
    ),
    "medical": (
        f"SELECT lower(customer_id) AS customer_id, bmi, charges, {_code_sql('smoker')}, lower(medical_addon) AS medical_addon FROM "
        "(SELECT * REPLACE (lower(smoker) AS smoker) FROM medical_policy)"
    ),
    "home": (
        f"SELECT lower(customer_id) AS customer_id, sum_insured, {_hot_sql('alarm', 'roof', 'walls', 'risk_class')}, "
        "lower(addon) AS home_addon FROM (SELECT * REPLACE (lower(alarm) AS alarm, lower(roof) AS roof, lower(walls) AS walls, "
        "lower(risk_class) AS risk_class) FROM home_policy)"
    ),
    "property": (
        f"SELECT lower(customer_id) AS customer_id, rebuild_cost, {_code_sql('tenure_kind', 'listing', 'kind')}, "
        "lower(addon) AS property_addon FROM (SELECT * REPLACE (lower(tenure_kind) AS tenure_kind, lower(listing) AS listing, "
        "lower(kind) AS kind) FROM property_policy)"
    ),
}


def insurance_tables(spark, sf_dir, *lines: str) -> jobs.InsuranceTables:
    """The job over the given lines, by default over all five."""
    customer = fx.customers(spark, sf_dir).select(
        "customer_id", "occupation", "marital_status", "dob", "customer_to_bank", "city", "income", "branch_group"
    )
    policies = {n: getattr(fx, f"{n}_policy")(spark, sf_dir) for n in lines or _LINE_SQL}
    return jobs.preprocess_insurance(customer, policies, AS_OF, fx.cities(spark, sf_dir))


def _register_line(line: str) -> None:
    sql = with_sql(
        f"customers cities {line}_policy", "SELECT * FROM base JOIN line USING (customer_id)", **_INSURED, line=_LINE_SQL[line]
    )

    @query(f"job_insurance_up_sell_{line}", sql)
    def features(spark, sf_dir):
        done = insurance_tables(spark, sf_dir, line).lines[line]
        return done.withColumn("net_captial", F.round("net_captial", 2)) if line == "motor" else done


for _line in _LINE_SQL:
    _register_line(_line)


@query("job_insurance_up_sell_customer", with_sql("customers cities", "SELECT * FROM base", **_INSURED))
def job_insurance_up_sell_customer(spark, sf_dir):
    return insurance_tables(spark, sf_dir, "medical").customer.features


@query(
    "job_insurance_up_sell_master",
    with_sql(
        "customers cities travel_policy motor_policy medical_policy home_policy property_policy",
        "SELECT customer_id, age, city_grp, c.occupation, lower(t.agency) AS agency, m.policy_annual_premium, d.bmi, "
        "lower(h.walls) AS walls, p.rebuild_cost FROM (SELECT customer_id, age, city_grp, occupation FROM enriched) c "
        + " ".join(
            f"FULL JOIN (SELECT * REPLACE (lower(customer_id) AS customer_id) FROM {n}_policy) {a} USING (customer_id)"
            for n, a in (("travel", "t"), ("motor", "m"), ("medical", "d"), ("home", "h"), ("property", "p"))
        ),
        derived=_DERIVED, **_TIERED,
    ),
)
def job_insurance_up_sell_master(spark, sf_dir):
    return insurance_tables(spark, sf_dir).master.select(
        "customer_id", "age", "city_grp", "occupation", "agency", "policy_annual_premium", "bmi", "walls", "rebuild_cost"
    )


# --- loan enrichment ----------------------------------------------------------------------------------------------

PLACES = tuple(a.split(",")[0] for a in ADDRESSES)


def town_gazetteer(spark, sf_dir) -> DataFrame:
    """Positions for the places, from the first nation row of each; the last place stays unknown."""
    place = fx.pick(F.col("n_nationkey"), (*PLACES[:-1], "Elsewhere"))
    first = table(spark, sf_dir, "nation").groupBy(place.alias("place")).agg(F.min("n_nationkey").alias("k"))
    return first.select(
        "place", F.lit("Bengaluru").alias("city"), (12.9698 + F.col("k") * 0.05).alias("latitude"),
        F.lit(77.75).alias("longitude"),
    )


_SKILLED, _MANUAL = ("Engineer", "Doctor", "Lawyer"), ("Plumber", "Welder", "BrickLayer")
_TOWNS = (
    "SELECT place, CAST(12.9698 AS DOUBLE) + min(n_nationkey) * CAST(0.05 AS DOUBLE) AS latitude, CAST(77.75 AS DOUBLE) AS longitude "
    f"FROM (SELECT n_nationkey, {fx._pick_sql('n_nationkey', (*PLACES[:-1], 'Elsewhere'))} AS place FROM nation) GROUP BY place"
)
_ENRICHED_LOANS = (
    f"SELECT customer_id, loan_availed, applicant_income, education, occupation, CASE WHEN loan_availed = 'Business Growth Loan' "
    f"OR education <> 'Graduate' THEN 'Yes' WHEN occupation = 'Engineer' THEN 'No' ELSE "
    f"{choice_sql('customer_id', ('Yes', 'No'), 'self_employed')} END AS self_employed, "
    f"CASE WHEN trunc(coalesce(km, 0)) < 15 THEN 1 ELSE 0 END AS address_near_by_bank FROM (SELECT *, CASE WHEN loan_availed = "
    f"'Business Growth Loan' THEN 'Business' WHEN education = 'Graduate' THEN {choice_sql('customer_id', _SKILLED, 'occupation')} "
    f"ELSE {choice_sql('customer_id', _MANUAL, 'occupation')} END AS occupation FROM (SELECT customer_id, "
    f"{fx._pick_sql('n_orders', LOANS)} AS loan_availed, income * 100 AS applicant_income, "
    f"CASE WHEN income * 100 < 400000 THEN 'Not Graduate' ELSE 'Graduate' END AS education, "
    f"split_part({choice_sql('customer_id', ADDRESSES, 'address')}, ',', 1) AS place FROM customers)) a "
    f"LEFT JOIN (SELECT place, {KM_SQL} AS km FROM towns) t ON lower(a.place) = lower(t.place)"
)


def enriched_loans(spark, sf_dir) -> DataFrame:
    loans = fx.customers(spark, sf_dir).select(
        "customer_id", fx.pick(F.col("n_orders"), LOANS).alias("loan_availed"), (F.col("income") * 100).alias("applicant_income")
    )
    return jobs.enrich_loans(loans, ADDRESSES, town_gazetteer(spark, sf_dir))


@query("occupation_enrich", with_sql("customers", "SELECT * FROM loans", towns=_TOWNS, loans=_ENRICHED_LOANS))
def occupation_enrich(spark, sf_dir):
    return enriched_loans(spark, sf_dir)


@query(
    "job_loan_enrichment_counts",
    with_sql(
        "customers", "SELECT address_near_by_bank AS value, count(*) AS n, round(count(*) * CAST(100 AS DOUBLE) / "
        "sum(count(*)) OVER (), 6) AS percent FROM loans GROUP BY 1", towns=_TOWNS, loans=_ENRICHED_LOANS,
    ),
)
def job_loan_enrichment_counts(spark, sf_dir):
    return value_frequency(enriched_loans(spark, sf_dir), "address_near_by_bank").withColumn("percent", F.round("percent", 6))


# --- recommendation jobs ------------------------------------------------------------------------------------------


def _ranked(done: jobs.Recommended, name: str) -> DataFrame:
    return recommend.explode_offers(done.offers, name, "customer_id", "age")


@query(
    "job_card_up_sell_offers",
    with_sql(
        "card_transactions cities",
        "SELECT d.customer_id, age, city_grp, rank, label, score FROM enriched d JOIN offers o ON o.customer_id = d.customer_id "
        "WHERE label IS NOT NULL",
        **{**CARD_OFFERS, **_UP_STEPS},
    ),
)
def job_card_up_sell_offers(spark, sf_dir):
    consolidated = written(jobs.consolidate_card(fx.card_transactions(spark, sf_dir)))
    offers = jobs.recommend_card_up_sell(jobs.enrich_card_up_sell(consolidated, AS_OF, fx.cities(spark, sf_dir)))
    return recommend.explode_offers(offers, "top_reco", "customer_id", "age", "city_grp")


_IN_TEST = "CAST('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 20"


def _held(name: str, prefix: str = "") -> list[Column]:
    """What must hold of all offers under ``name``: how many, their order, their sum."""
    offers = F.col(name)
    scores = F.transform(offers, lambda o: o["score"])
    return [
        F.size(offers).cast("bigint").alias(f"{prefix}n_offers"), (F.sort_array(scores, asc=False) == scores).alias(f"{prefix}descending"),
        (F.abs(F.aggregate(scores, F.lit(0.0), lambda a, x: a + x) - 1) < 1e-9).alias(f"{prefix}whole"),
    ]


def _answers(done: jobs.Recommended, name: str, forest: str | None = None, forest_held: bool = False) -> DataFrame:
    """The best offer of each test customer and what must hold of all of them; of offers of a forest the best with its score
    as well, with ``forest_held`` also what must hold of all of these."""
    offers = F.col(name)
    return done.offers.select(
        "customer_id", "age", offers[0]["label"].alias("best"), (offers[0]["score"] > 0.5).alias("sure"), *_held(name),
        *([F.get(forest, F.lit(0))["label"].alias("forest_best"), F.round(F.get(forest, F.lit(0))["score"], 9).alias("best_score")] if forest else []),
        *(_held(forest, "forest_") if forest and forest_held else []),
    )


CARDS = ("Silver", "Gold", "Platinum")


@query(
    "job_card_cross_sell_offers",
    with_sql(
        "customers", f"SELECT customer_id, age, {_pick('length(occupation)', CARDS)} AS best, true AS sure, CAST(3 AS BIGINT) AS n_offers, "
        f"true AS descending, true AS whole FROM derived WHERE {_IN_TEST.format(key='customer_id')}", derived=_CARD_DERIVED),
)
def job_card_cross_sell_offers(spark, sf_dir):
    """Cards of the test customers, learnt where the occupation tells the card."""
    done = preprocessed_card_cross_sell(spark, sf_dir, card_type=fx.pick(F.length("occupation"), CARDS))
    name = "credit_cross_sell_top3_reco"
    return _answers(jobs.recommend_multiclass(done.features, done.snapshot, "card_type", name), name)


def _register_multiclass(job: str, target: str, name: str, load, labels: int, forest: str | None = "_forest",
                         forest_held: bool = False) -> None:
    more = f", {_TARGET_SQL[job]} AS forest_best, CAST(1 AS DOUBLE) AS best_score" if forest else ""
    if forest and forest_held:
        more += f", CAST({labels} AS BIGINT) AS forest_n_offers, true AS forest_descending, true AS forest_whole"
    sql = with_sql(
        "customers", f"SELECT customer_id, age, {_TARGET_SQL[job]} AS best, true AS sure, "
        f"CAST({labels} AS BIGINT) AS n_offers, true AS descending, true AS whole{more} FROM derived "
        f"WHERE {_IN_TEST.format(key='customer_id')}", derived=_DERIVED)

    @query(f"job_{job}_offers", sql)
    def offers(spark, sf_dir):
        """The best offers of the boosted trees, and the best one of a forest, which scores what one feature tells with 1."""
        done = load(spark, sf_dir, job)
        return _answers(jobs.recommend_multiclass(done.features, done.snapshot, target, name, forest=forest), name, forest, forest_held)


_register_multiclass("funds", "fund_type", "fund_top3_reco", preprocessed_account, 3)
_register_multiclass("savings_account", "savings_account_avl", "savings_top3_reco", preprocessed_account, 3, forest_held=True)
_register_multiclass("insurance_cross_sell", "insurance", "insurance_cross_sell_top3_reco", preprocessed_account, 2, None)
_register_multiclass("loan_cross_sell", "loan_availed", "loan_cross_sell_top3_reco", preprocessed_loan, 3, forest_held=True)
_register_multiclass("loan_up_sell", "loan_availed2", "loan_upsell_top3_reco", preprocessed_loan, 3)


def _register_binary(job: str, target: str, product: str, name: str) -> None:
    sql = with_sql(
        "customers", f"SELECT customer_id, age, CASE WHEN {_TARGET_SQL[job]} = 'yes' THEN '{product}' END AS offer, "
        f"CASE WHEN {_TARGET_SQL[job]} = 'yes' THEN true END AS sure, '{product}' AS slow_offer, {_TARGET_SQL[job]} = 'yes' AS slow_sure "
        f"FROM derived WHERE {_IN_TEST.format(key='customer_id')}",
        derived=_DERIVED)

    @query(f"job_{job}_offers", sql)
    def offers(spark, sf_dir):
        """The offer goes to those who say yes. Ten rounds of step 0.01 (``slow``) leave all scores above the cut of 0.40, and
        above one half for those who say yes."""
        done = preprocessed_account(spark, sf_dir, job)
        result = jobs.recommend_binary(done.features, done.snapshot, target, product, name, wide="_wide")
        found = result.offers.select("customer_id", "age", F.explode_outer(name).alias("slow_offer", "_slow"), "_wide")
        found = found.select("customer_id", "age", "slow_offer", "_slow", F.explode_outer("_wide").alias("offer", "_score"))
        return found.select("customer_id", "age", "offer", (F.col("_score") > 0.5).alias("sure"), "slow_offer", (F.col("_slow") > 0.5).alias("slow_sure"))


_register_binary("current_account", "current_acc_avl", "current_account", "currentaccount_reco")
_register_binary("term_deposit", "term_dep_avl", "term_deposit", "termdep_reco")


@query("job_funds_accuracy", "SELECT CAST(100 AS DOUBLE) AS accuracy")
def job_funds_accuracy(spark, sf_dir):
    done = preprocessed_account(spark, sf_dir, "funds")
    return jobs.recommend_multiclass(done.features, done.snapshot, "fund_type", "fund_top3_reco").accuracy


# What tells the add-on of each line: the policy's column, the value, the add-on for it and that for all others.
ADDONS = {
    "travel": ("travel_addon", "channel", "Online", "Ticket Protector", "Cancellation Plan"),
    "motor": ("motor_addon", "collision_type", "Rear", "Parked Car", "Multi-Vehicle Collision"),
    "medical": ("medical_addon", "smoker", "Yes", "Cardiovascular", "Dental"),
    "home": ("addon", "alarm", "Y", "Lock", "Garden"),
    "property": ("addon", "tenure_kind", "Let", "Fire", "Flood"),
}


def told_tables(spark, sf_dir, *lines: str) -> jobs.InsuranceTables:
    """The job's tables with add-ons that a feature tells, and incomes in the range of the rules."""
    customer = fx.customers(spark, sf_dir).select(
        "customer_id", "occupation", "marital_status", "dob", "customer_to_bank", "city", (F.col("income") * 20).alias("income"), "branch_group"
    )
    policies = {}
    for line in lines:
        target, column, value, addon, other = ADDONS[line]
        told = F.when(F.col(column) == value, addon).otherwise(other)
        policies[line] = getattr(fx, f"{line}_policy")(spark, sf_dir).withColumn(target, told)
    return jobs.preprocess_insurance(customer, policies, AS_OF, fx.cities(spark, sf_dir))


def _told_sql(line: str) -> str:
    """Test customers of a line with their two add-ons in order."""
    _, column, value, addon, other = ADDONS[line]
    first, second = (f"CASE WHEN {column} = '{value}' THEN '{a.lower()}' ELSE '{b.lower()}' END" for a, b in ((addon, other), (other, addon)))
    return (
        f"SELECT lower(customer_id) AS customer_id, {first} AS first, {second} AS second FROM {line}_policy JOIN customers USING (customer_id) "
        f"WHERE {_IN_TEST.format(key='lower(customer_id)')}"
    )


@query(
    "job_insurance_up_sell_offers",
    with_sql(
        "customers " + " ".join(f"{line}_policy" for line in ADDONS),
        " UNION ALL ".join(
            f"SELECT customer_id, '{line}' AS line, {rank} AS rank, {which} AS label FROM told_{line}"
            for line in ADDONS for rank, which in ((1, "first"), (2, "second"))),
        **{f"told_{line}": _told_sql(line) for line in ADDONS}),
)
def job_insurance_up_sell_offers(spark, sf_dir):
    """The best add-ons of all five lines, side by side by customer, unfolded to rows."""
    combined, _ = jobs.recommend_insurance(told_tables(spark, sf_dir, *ADDONS))
    listed = F.map_from_arrays(F.array(*[F.lit(x) for x in ADDONS]), F.array(*[F.col(f"{x}_top3_reco") for x in ADDONS]))
    by_line = written(combined.select("customer_id", listed.alias("_offers"))).select("customer_id", F.explode("_offers").alias("line", "_o"))
    return recommend.explode_offers(by_line, "_o", "customer_id", "line").drop("score")


def _chain_sql() -> str:
    steps = {k: v for k, v in _line_steps().items() if not k.endswith("_candidates")}
    told = {f"told_{x}": _told_sql(x) for x in LINES}
    candidates = {
        f"{x}_candidates": f"SELECT a.customer_id, unnest([first, second]) AS product, unnest([1, 2]) AS r FROM attributes a "
        f"JOIN told_{x} t ON lower(a.customer_id) = t.customer_id" for x in LINES
    }
    columns = ", ".join(f"coalesce({x}_final.product, 'no recommendation') AS {x}_final_reco" for x in LINES)
    joins = " ".join(f"LEFT JOIN {x}_final USING (customer_id)" for x in LINES)
    scored = " UNION ".join(f"SELECT customer_id FROM told_{x}" for x in LINES)
    return with_sql(
        "customers motor_policy travel_policy medical_policy",
        f"SELECT lower(customer_id) AS customer_id, {columns} FROM attributes {joins} WHERE lower(customer_id) IN ({scored})",
        **told, **{k: steps[k] for k in ("attributes", "facts")}, **candidates,
        **{k: v for k, v in steps.items() if k not in ("attributes", "facts")})


@query("job_insurance_chain", _chain_sql())
def job_insurance_chain(spark, sf_dir):
    """Add-ons recommended by three models, combined, written as score text, read back and cut by the rule catalogues."""
    tables = told_tables(spark, sf_dir, *LINES)
    combined, _ = jobs.recommend_insurance(tables)
    names = [f"{x}_top3_reco" for x in LINES]
    facts = tables.master.select("customer_id", "age", "income", "agency", "policy_annual_premium", "vehicle_age_yrs", "bmi")
    offered = combined.select("customer_id", *[recommend.offers_map(F.col(n)).alias(n) for n in names]).join(facts, "customer_id")
    path = scratch_path(spark, "combined_recommendations")
    write_csv_table(offered, path)
    read = read_csv_table(spark, path, offered.withColumns({n: F.lit("") for n in names}).schema)
    read = read.withColumns({f"{x}_top3": candidate_names(F.col(f"{x}_top3_reco")) for x in LINES})
    catalogues = {f"{x}_final_reco": (f"{x}_top3", catalogue_rules(spark, f"{x}_insurance")) for x in LINES}
    return with_final_offers(read, catalogues).select("customer_id", *catalogues)


@query("job_insurance_rule_validation", _final_sql(LINES))
def job_insurance_rule_validation(spark, sf_dir):
    """Candidates written as score text in CSV, read back, validated against the three catalogues."""
    customers = insurance_candidates(spark, sf_dir)
    names = {f"{x}_top3": f"{x}_top3_reco" for x in LINES}
    as_map = {
        reco: F.map_from_entries(F.transform(c, lambda v, i: F.struct(v.alias("k"), (1.0 / (i + 1)).alias("v"))))
        for c, reco in names.items()
    }
    path = scratch_path(spark, "combined_recommendations")
    written = customers.withColumns(as_map).drop(*names)
    write_csv_table(written, path)
    flat = written.withColumns({r: F.lit("") for r in names.values()}).schema
    read = read_csv_table(spark, path, flat)
    read = read.withColumns({c: candidate_names(F.col(r)) for c, r in names.items()})
    catalogues = {f"{x}_final_reco": (f"{x}_top3", catalogue_rules(spark, f"{x}_insurance")) for x in LINES}
    return with_final_offers(read, catalogues).select("customer_id", *catalogues)
