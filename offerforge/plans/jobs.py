"""Product-line jobs: preprocessing and recommendation, as settings over the operators."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerforge.functions.dates import (
    with_age, with_customer_since, with_months_ago, with_tenure_segment, with_years_old,
)
from offerforge.functions.names import lowercase_values, normalize_names, numeric_columns, string_columns
from offerforge.functions.policy import (
    capped_count, day_part, make_value, severity_weight, with_net_amount, with_split_limits,
)
from offerforge.functions.rows import education_label, keyed_choice
from offerforge.operators import profile
from offerforge.operators.encode import EncoderPlan, fit_encoders
from offerforge.operators.boost import BoostedModel
from offerforge.operators.lookups import with_branch_distance, with_near_branch, with_population
from offerforge.operators.model import (
    BINARY_STEP, MULTICLASS_STEP, ROUNDS, TrainedModel, accuracy, key_split, train_binary, train_multiclass,
)
from offerforge.operators.numeric import (
    exact_quantiles, highly_correlated, log_scale, outlier_report, tier_edges, top_correlations, with_city_tier,
)
from offerforge.operators.recommend import (
    attach_offers, combine_offers, ladder_offers, threshold_offer, top_index, top_offers, with_top_categories,
)
from offerforge.operators.tables import consolidate_transactions, inner_fanout, keep_last, outer_master
from offerforge.session import shared_folder, written
from offerforge.sources.tables import ingest, replace_null_tokens

KEY = "customer_id"
CORR_THRESHOLD = 0.75
TOP_PAIRS = 10
OFFER_THRESHOLD = 0.40

# Attributes of a card customer and the expense categories behind each pair of totals.
CARD_ATTRIBUTES = ("card_type", "occupation", "dob", "income", "customer_to_bank", "city", "marital_status")
CARD_GROUPS = {
    "travel": ("travel",), "fuel": ("fuel",), "entertainment": ("entertainment",), "food": ("food", "grocery"),
    "bill": ("bills",),
}


@dataclass(frozen=True)
class PreprocessSpec:
    """What sets one preprocessing job apart from the others."""

    target: str | None
    dropped: tuple[str, ...] = ("gender",)
    since: bool = True
    place: str = "city"
    code_at: tuple[int, ...] = (2,)
    spread_at: tuple[int, ...] = (5,)
    logs: tuple[str, ...] = ("income",)
    dropped_last: tuple[str, ...] = ()


# Targets, numbers of categories that are coded and spread, log-scaled columns.
LOAN_LOGS = ("applicant_income", "coapplicant_income", "loan_amt")
PREPROCESS = {
    "card_cross_sell": PreprocessSpec("card_type", since=False),
    "card_up_sell": PreprocessSpec("card_type", dropped=(), dropped_last=("customer_rel_dur_segment",)),
    "current_account": PreprocessSpec("current_acc_avl", spread_at=(4, 5)),
    "funds": PreprocessSpec("fund_type"),
    "insurance_cross_sell": PreprocessSpec("insurance", spread_at=(14,)),
    "loan_cross_sell": PreprocessSpec("loan_availed", place="address", spread_at=(4,), logs=LOAN_LOGS),
    "loan_up_sell": PreprocessSpec("loan_availed2", place="address", spread_at=(4, 6), logs=LOAN_LOGS),
    "savings_account": PreprocessSpec("savings_account_avl"),
    "term_deposit": PreprocessSpec("term_dep_avl"),
    "insurance_customer": PreprocessSpec(None, dropped=(), spread_at=(14,), logs=()),
    "travel": PreprocessSpec("travel_addon", dropped=("destination",), spread_at=(16,), logs=()),
    "motor": PreprocessSpec(
        "motor_addon",
        dropped=("incident_city", "incident_location", "policy_bind_date", "incident_state", "policy_state", "auto_model"),
        code_at=(), spread_at=(3, 4, 5), logs=(),
    ),
    "medical": PreprocessSpec("medical_addon", dropped=(), spread_at=(), logs=()),
    "home": PreprocessSpec(
        "addon", dropped=("quote_date", "cover_start", "mta_date", "police"), code_at=(), spread_at=(2, 3, 4, 6), logs=(),
    ),
    "property": PreprocessSpec(
        "addon", dropped=("quote_date", "cover_start", "mta_date", "police"), code_at=(2, 3, 4), spread_at=(), logs=(),
    ),
}


@dataclass(frozen=True)
class Preprocessed:
    """Numeric features with the target, the enriched table before encoding, and reports on demand."""

    features: DataFrame
    snapshot: DataFrame
    encoders: EncoderPlan
    reports: Mapping[str, Callable[[], DataFrame]] = field(default_factory=dict)


def clean(df: DataFrame, dropped: tuple[str, ...] = ()) -> DataFrame:
    """Names normalised, unwanted columns gone, text in lower case, NaN as NULL, no row without a key."""
    df = normalize_names(df)
    return ingest(lowercase_values(df.drop(*dropped)), KEY)


def enrich_customer(
    df: DataFrame, spec: PreprocessSpec, as_of: date, cities: DataFrame | None, gazetteer: DataFrame | None
) -> DataFrame:
    """Age, tenure with its segment, and city tier or nearness of the branch."""
    df = with_age(df, "dob", as_of)
    if spec.since:
        df = with_tenure_segment(with_customer_since(df, "customer_to_bank", as_of))
    if spec.place == "city":
        df = with_population(df, "city", cities)
        return with_city_tier(df, "population", tier_edges(exact_quantiles(df, "population")))
    return with_near_branch(with_branch_distance(df, "address", gazetteer), "address")


def enrich_motor(df: DataFrame, as_of: date) -> DataFrame:
    """Policy derivations; the vehicle age is kept under both of its names."""
    df = with_months_ago(df, "incident_date", as_of)
    df = replace_null_tokens(df, ["?"])
    df = with_years_old(df, "auto_year", as_of)
    df = with_split_limits(df, "policy_csl")
    df = with_net_amount(df, "capital_gains", "capital_loss")
    return df.withColumns(
        {
            "vehicle_age_yrs": F.col("years_auto_old"),
            "incident_severity": severity_weight(F.col("incident_severity")),
            "incident_hour_of_the_day": day_part(F.col("incident_hour_of_the_day")),
            "witnesses": capped_count(F.col("witnesses")),
            "auto_make": make_value(F.col("auto_make"), F.col("years_auto_old")),
        }
    )


def encode(enriched: DataFrame, spec: PreprocessSpec, raw: DataFrame | None = None) -> Preprocessed:
    """Encoders by number of categories, log scaling and reports for an enriched table.

    The target takes no part: it is carried along with its row. The enriched table is written once, as it is a result
    of its own, and each fit reads only the columns it needs from there.
    """
    enriched = written(enriched)
    features = enriched.drop(spec.target) if spec.target else enriched
    encoders = fit_encoders(
        features, spec.code_at, spec.spread_at, [c for c in string_columns(features) if c != KEY]
    )
    encoded = log_scale(encoders.transform(enriched), spec.logs).drop(*spec.dropped_last)
    if spec.target:
        encoded = encoded.select(*[c for c in encoded.columns if c != spec.target], spec.target)
    numbers = [c for c in numeric_columns(encoded) if c not in (KEY, spec.target)]
    before = [c for c in numeric_columns(features) if c != KEY]
    profiled = enriched if raw is None else raw
    reports = {
        "schema": lambda: profile.schema_profile(profiled, KEY),
        "unique_values": lambda: profile.unique_counts(profiled),
        "constant_or_key": lambda: profile.constant_or_key_columns(profiled),
        "missing": lambda: profile.columns_with_missing(features),
        "cardinality": lambda: profile.columns_by_cardinality(features),
        "outliers": lambda: outlier_report(features, before),
        "top_correlations": lambda: top_correlations(encoded, numbers, TOP_PAIRS),
        "highly_correlated": lambda: highly_correlated(encoded, numbers, CORR_THRESHOLD),
    }
    return Preprocessed(encoded, enriched, encoders, reports)


def preprocess(
    df: DataFrame, spec: PreprocessSpec, as_of: date, cities: DataFrame | None = None,
    gazetteer: DataFrame | None = None, order_by: str | None = None,
) -> Preprocessed:
    """One customer table to features. With ``order_by`` only the last row per customer counts."""
    df = clean(df, spec.dropped)
    if order_by:
        df = written(keep_last(df, KEY, [order_by]).drop(order_by))
    return encode(enrich_customer(df, spec, as_of, cities, gazetteer), spec, raw=df)


def consolidate_card(transactions: DataFrame) -> DataFrame:
    """Card transactions to one row per customer."""
    return consolidate_transactions(
        clean(transactions, ("gender", "city_transaction_made", "date_transaction_made")),
        KEY, CARD_ATTRIBUTES, "exp_type", "amount", CARD_GROUPS,
    )


def enrich_card_up_sell(consolidated: DataFrame, as_of: date, cities: DataFrame) -> DataFrame:
    """Consolidated card customers with age, tenure and city tier."""
    return enrich_customer(consolidated, PREPROCESS["card_up_sell"], as_of, cities, None)


def preprocess_card_up_sell(transactions: DataFrame, as_of: date, cities: DataFrame) -> Preprocessed:
    """Consolidation, then the customer preprocessing on its result."""
    consolidated = written(consolidate_card(transactions))
    return encode(enrich_card_up_sell(consolidated, as_of, cities), PREPROCESS["card_up_sell"], raw=consolidated)


@dataclass(frozen=True)
class InsuranceTables:
    """Result of the insurance up-sell preprocessing: a feature table per line and one table of everything."""

    lines: Mapping[str, DataFrame]
    customer: Preprocessed
    master: DataFrame


def preprocess_insurance(
    customer: DataFrame, policies: Mapping[str, DataFrame], as_of: date, cities: DataFrame
) -> InsuranceTables:
    """Six tables: customer and one per line of ``travel motor medical home property``.

    Each line is encoded on its own and joined to the customer features. The master table is the outer join of all
    lines and the customers after derivation, before encoding.
    """
    base = preprocess(customer, PREPROCESS["insurance_customer"], as_of, cities)
    enriched, encoded = {}, {}
    for name, policy in policies.items():
        spec = PREPROCESS[name]
        line = clean(policy, spec.dropped)
        line = enrich_motor(line, as_of) if name == "motor" else line
        enriched[name] = line.drop(spec.target)
        named = f"{name}_addon"
        encoded[name] = encode(line, spec).features.withColumnRenamed(spec.target, named)
    lines = inner_fanout(base.features, encoded, KEY)
    return InsuranceTables(lines, base, outer_master({**enriched, "customer": base.snapshot}, KEY))


def enrich_loans(loans: DataFrame, addresses: tuple[str, ...], gazetteer: DataFrame) -> DataFrame:
    """Loan table with address, education, occupation and self-employment filled in, and nearness of the branch.

    Choices follow a hash of the customer, so a rerun gives the same table.
    """
    key = F.col(KEY)
    graduate = F.col("education") == "Graduate"
    business = F.col("loan_availed") == "Business Growth Loan"
    # Occupations open to graduates and to others.
    skilled, manual = ("Engineer", "Doctor", "Lawyer"), ("Plumber", "Welder", "BrickLayer")
    df = loans.withColumns(
        {"address": keyed_choice(key, addresses, "address"), "education": education_label(F.col("applicant_income"))}
    )
    df = df.withColumn(
        "occupation",
        F.when(business, "Business").when(graduate, keyed_choice(key, skilled, "occupation"))
        .otherwise(keyed_choice(key, manual, "occupation")),
    )
    df = df.withColumn(
        "self_employed",
        F.when(business | ~F.coalesce(graduate, F.lit(False)), "Yes").when(F.col("occupation") == "Engineer", "No")
        .otherwise(keyed_choice(key, ("Yes", "No"), "self_employed")),
    )
    return with_near_branch(with_branch_distance(df, "address", gazetteer), "address")


@dataclass(frozen=True)
class Recommended:
    """Offers on the snapshot of the test customers, the model, and its accuracy on them."""

    offers: DataFrame
    model: TrainedModel | BoostedModel
    accuracy: DataFrame | None


def recommend_multiclass(
    features: DataFrame, snapshot: DataFrame, target: str, name: str, k: int = 3, backend: str = "boosted",
    rounds: int = ROUNDS, forest: str | None = None,
) -> Recommended:
    """Trains on four fifths of the customers and gives the others their k best classes as ``name``; with ``forest`` also
    those of a forest that tries all features at every split, under that name."""
    train, test = key_split(features, KEY)
    model = train_multiclass(train, target, KEY, backend=backend, rounds=rounds)
    scored, more = model.score(test), []
    if forest:
        second = train_multiclass(train, target, KEY, backend="forest", subset="all")
        scored = second.score(scored, "_chances")
        more = [top_offers(F.col("_chances"), second.labels, k).alias(forest)]
    scored = scored.select(
        KEY, F.col(target).alias("_actual"), F.get(F.array(*[F.lit(v) for v in model.labels]),
                                                  top_index(F.col("probability")).cast("int")).alias("_predicted"),
        top_offers(F.col("probability"), model.labels, k).alias(name), *more,
    )
    offers = attach_offers(snapshot.drop(target), scored.drop("_actual", "_predicted"), KEY)
    return Recommended(offers, model, accuracy(scored, "_actual", "_predicted"))


def recommend_binary(
    features: DataFrame, snapshot: DataFrame, target: str, product: str, name: str, threshold: float = OFFER_THRESHOLD,
    rounds: int = ROUNDS, step: float = BINARY_STEP, wide: str | None = None,
) -> Recommended:
    """Gives each test customer the product when the score is above the threshold; with ``wide`` also by a model of the step
    of several classes, under that name, whose scores reach both sides of the threshold in a few rounds."""
    train, test = key_split(features, KEY)
    model = train_binary(train, target, KEY, rounds=rounds, step=step)
    scored, names = model.score(test), {name: "probability"}
    if wide:
        scored = train_binary(train, target, KEY, rounds=rounds, step=MULTICLASS_STEP).score(scored, "_chances")
        names[wide] = "_chances"
    offers = scored.select(KEY, *[threshold_offer(F.get(p, F.lit(1)), product, threshold).alias(n) for n, p in names.items()])
    return Recommended(attach_offers(snapshot.drop(target), offers, KEY), model, None)


def recommend_card_up_sell(customers: DataFrame) -> DataFrame:
    """Adds ``top_reco`` to consolidated card customers, enriched or not, from their two top categories; no model needed."""
    df = with_top_categories(customers)
    offers = ladder_offers(F.col("card_type"), F.col("max_spent_category"), F.col("max_trans_category"))
    return df.withColumn("top_reco", offers)


def recommend_insurance(tables: InsuranceTables, backend: str = "boosted", rounds: int = ROUNDS) -> tuple[DataFrame, dict]:
    """Five models, their offers side by side, and the accuracy of each. The lines are trained at the same time: a model is many
    short jobs, which leave most cores free."""

    def trained(line: tuple[str, DataFrame]) -> Recommended:
        name, features = line
        return recommend_multiclass(
            features, features.select(KEY), f"{name}_addon", f"{name}_top3_reco", backend=backend, rounds=rounds
        )

    shared_folder(tables.customer.features.sparkSession)
    with ThreadPoolExecutor(max(len(tables.lines), 1)) as pool:
        done = dict(zip(tables.lines, pool.map(inheritable_thread_target(tables.customer.features.sparkSession)(trained), tables.lines.items())))
    results = {name: d.offers for name, d in done.items()}
    return combine_offers(results, tables.customer.features, KEY), {name: d.accuracy for name, d in done.items()}
