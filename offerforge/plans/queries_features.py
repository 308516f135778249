"""Registered queries: sources, columns, profiles, dates, policy and lookup derivations."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerforge.functions import dates, geo, names, policy, rows
from offerforge.operators import lookups, numeric, profile
from offerforge.plans import fixtures as fx
from offerforge.plans.fixtures import AS_OF, age_sql, tenure_sql, with_sql
from offerforge.plans.registry import query, table
from offerforge.session import scratch_path
from offerforge.sources import tables as src

# --- sources and columns -------------------------------------------------------------------------------------------


@query(
    "csv_round_trip",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def csv_round_trip(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "csv_round_trip")
    src.write_csv_table(customer, path)
    return src.read_csv_table(spark, path, customer.schema)


@query(
    "csv_text_round_trip",
    "SELECT * FROM documents UNION ALL SELECT doc_id, '  \"' || replace(text, ' ', chr(13) || chr(10) || chr(92) || 'n, ') || '\"\" ' "
    "|| chr(92), CASE WHEN doc_id % 2 = 0 THEN '' END, source, n_chars FROM documents",
)
def csv_text_round_trip(spark, sf_dir):
    """Texts as they are and with line breaks, quotes, backslashes, commas and outer blanks; empty and missing ones."""
    docs = table(spark, sf_dir, "documents")
    hard = F.concat(F.lit('  "'), F.replace("text", F.lit(" "), F.lit("\r\n\\n, ")), F.lit('"" \\'))
    both = docs.unionByName(docs.withColumns({"text": hard, "lang": F.when(F.col("doc_id") % 2 == 0, F.lit(""))}))
    path = scratch_path(spark, "csv_text_round_trip")
    src.write_csv_table(both, path)
    return src.read_written_csv(spark, path, both.schema)


@query(
    "csv_inferred_types",
    "SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part",
)
def csv_inferred_types(spark, sf_dir):
    path = scratch_path(spark, "csv_inferred_types")
    src.write_csv_table(table(spark, sf_dir, "part"), path)
    return src.read_csv_table(spark, path)


@query(
    "null_tokens",
    with_sql(
        "motor_policy",
        "SELECT customer_id, CASE WHEN collision_type <> '?' THEN collision_type END AS collision_type, "
        "TRY_CAST(CASE WHEN size_text <> '?' THEN size_text END AS BIGINT) AS size_text "
        "FROM (SELECT customer_id, collision_type, CASE WHEN witnesses = 0 THEN '?' ELSE CAST(witnesses AS VARCHAR) END "
        "AS size_text FROM motor_policy)",
    ),
)
def null_tokens(spark, sf_dir):
    motor = fx.motor_policy(spark, sf_dir).select(
        "customer_id", "collision_type",
        F.when(F.col("witnesses") == 0, "?").otherwise(F.col("witnesses").cast("string")).alias("size_text"),
    )
    return src.replace_null_tokens(motor, ["?"], {"size_text": "bigint"})


@query(
    "score_text_candidates",
    "SELECT vec_id, CAST(p AS INTEGER) AS pos, CASE p WHEN 0 THEN 'b ' || label ELSE 'a ' || label END AS candidate "
    "FROM embeddings, (VALUES (0), (1)) t(p)",
)
def score_text_candidates(spark, sf_dir):
    text = F.format_string("{'b %d': 0.7, 'a %d': 0.2}", "label", "label")
    named = table(spark, sf_dir, "embeddings").select("vec_id", src.candidate_names(text).alias("names"))
    return named.select("vec_id", F.posexplode("names").alias("pos", "candidate"))


@query(
    "normalize_names",
    'SELECT c_custkey AS customer_key, c_name AS name_of_customer, c_acctbal AS balance_usd FROM customer',
)
def normalize_names(spark, sf_dir):
    return names.normalize_names(
        table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias(" Customer  Key"), F.col("c_name").alias("Name-of__Customer"),
            F.col("c_acctbal").alias("BALANCE (USD"),
        )
    )


@query("drop_columns", "SELECT p_partkey, p_name, p_brand, p_size FROM part")
def drop_columns(spark, sf_dir):
    return names.drop_columns(table(spark, sf_dir, "part"), ["p_type", "p_retailprice"])


@query("lowercase_values", "SELECT p_partkey, lower(p_name) AS p_name, lower(p_brand) AS p_brand, lower(p_type) AS p_type FROM part")
def lowercase_values(spark, sf_dir):
    return names.lowercase_values(table(spark, sf_dir, "part").drop("p_size", "p_retailprice"))


@query("feature_slice", "SELECT s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey, s_acctbal FROM supplier")
def feature_slice(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier").withColumn("s_nationkey", F.col("s_nationkey").cast("bigint"))
    return names.feature_slice(supplier)


@query(
    "target_round_trip",
    "SELECT o_orderkey, o_totalprice / 1000 AS price, o_orderstatus FROM orders",
)
def target_round_trip(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    features, target = names.split_target(orders, "o_orderkey", "o_orderstatus")
    features = features.select("o_orderkey", (F.col("o_totalprice") / 1000).alias("price"))
    return names.attach_target(features, target, "o_orderkey")


@query(
    "ingest_missing",
    "SELECT o_custkey, CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS price FROM orders WHERE o_orderstatus <> 'P'",
)
def ingest_missing(spark, sf_dir):
    raw = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("o_custkey"),
        F.when(F.col("o_orderstatus") == "F", F.lit(float("nan"))).otherwise(F.col("o_totalprice")).alias("price"),
    )
    return src.ingest(raw, "o_custkey")


# --- profiles -----------------------------------------------------------------------------------------------------


@query(
    "schema_profile",
    "SELECT 'c_custkey' AS \"column\", 'bigint' AS dtype, CAST(arg_min(c_custkey, c_custkey) AS VARCHAR) AS sample FROM customer "
    "UNION ALL SELECT 'c_name', 'string', arg_min(c_name, c_custkey) FROM customer "
    "UNION ALL SELECT 'c_nationkey', 'int', CAST(arg_min(c_nationkey, c_custkey) AS VARCHAR) FROM customer "
    "UNION ALL SELECT 'c_acctbal', 'double', CAST(arg_min(c_acctbal, c_custkey) AS VARCHAR) FROM customer "
    "UNION ALL SELECT 'c_mktsegment', 'string', arg_min(c_mktsegment, c_custkey) FROM customer",
)
def schema_profile(spark, sf_dir):
    return profile.schema_profile(table(spark, sf_dir, "customer"), "c_custkey")


_COLUMN_KIND = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{k}' AS kind, count({c}) AS n FROM orders"
    for c, k in (
        ("o_orderkey", "other"), ("o_custkey", "other"), ("o_orderstatus", "string"), ("o_totalprice", "other"),
        ("o_orderdate", "other"), ("o_orderpriority", "string"),
    )
)


@query("column_kinds", _COLUMN_KIND)
def column_kinds(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    kinds = {c: "string" for c in names.string_columns(orders)} | {c: "other" for c in names.non_string_columns(orders)}
    return profile._aggregated(
        orders, "column", kind=lambda value, name: F.first(F.lit(kinds[name])), n=lambda value, name: F.count(value)
    )


_PART_COLUMNS = ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
_LABELLED = (
    "SELECT d.doc_id, CASE WHEN lang <> 'de' THEN lang END AS lang, source, quality, toxic "
    "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"
)


def labelled_documents(spark, sf_dir):
    """Documents with their labels, where they have some, and the German language tag missing."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return documents.join(table(spark, sf_dir, "labels"), "doc_id", "left").withColumn(
        "lang", F.when(F.col("lang") != "de", F.col("lang"))
    )


def _distinct_sql(source: str, columns, name: str = "column") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"{name}\", count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) "
        f"AS num_unique_values, count(*) AS n_rows FROM {source}"
        for c in columns
    )


@query("unique_counts", f"SELECT \"column\", num_unique_values FROM ({_distinct_sql('part', _PART_COLUMNS)})")
def unique_counts(spark, sf_dir):
    return profile.unique_counts(table(spark, sf_dir, "part"))


@query(
    "unique_counts_with_missing",
    f"WITH d AS ({_LABELLED}) SELECT \"column\", num_unique_values FROM "
    f"({_distinct_sql('d', ('doc_id', 'lang', 'source', 'quality', 'toxic'))})",
)
def unique_counts_with_missing(spark, sf_dir):
    return profile.unique_counts(labelled_documents(spark, sf_dir))


@query(
    "columns_by_cardinality",
    f"SELECT num_unique_values, string_agg(\"column\", ',' ORDER BY \"column\") AS columns FROM "
    f"({_distinct_sql('customers', ('occupation', 'marital_status', 'city', 'gender', 'branch_group', 'property_area'))}) "
    "GROUP BY num_unique_values".join([with_sql("customers", ""), ""]),
)
def columns_by_cardinality(spark, sf_dir):
    customers = fx.customers(spark, sf_dir).select(
        "occupation", "marital_status", "city", "gender", "branch_group", "property_area", "number"
    )
    return profile.columns_by_cardinality(customers)


@query(
    "constant_or_key_columns",
    f"WITH p AS (SELECT *, 'x' AS fixed FROM part) SELECT \"column\", num_unique_values FROM "
    f"({_distinct_sql('p', (*_PART_COLUMNS, 'fixed'))}) WHERE num_unique_values = 1 OR num_unique_values = n_rows",
)
def constant_or_key_columns(spark, sf_dir):
    return profile.constant_or_key_columns(table(spark, sf_dir, "part").withColumn("fixed", F.lit("x")))


def _missing_sql(expr: str, label: str) -> str:
    return f"WITH d AS ({_LABELLED}) " + " UNION ALL ".join(
        f"SELECT '{c}' AS {label}, {expr.format(c=c)} FROM d" for c in ("doc_id", "lang", "source", "quality", "toxic")
    )


_PERCENT = "round((count(*) - count({c})) * CAST(100 AS DOUBLE) / count(*), 6) AS percent_missing"


@query("missing_percent", _missing_sql(_PERCENT, "column_name"))
def missing_percent(spark, sf_dir):
    return profile.missing_percent(labelled_documents(spark, sf_dir)).withColumn(
        "percent_missing", F.round("percent_missing", 6)
    )


@query("columns_with_missing", f"SELECT * FROM ({_missing_sql(_PERCENT, 'column_name')}) WHERE percent_missing > 0")
def columns_with_missing(spark, sf_dir):
    return profile.columns_with_missing(labelled_documents(spark, sf_dir)).withColumn(
        "percent_missing", F.round("percent_missing", 6)
    )


@query("null_counts", _missing_sql("count(*) - count({c}) AS outlier", '"column"'))
def null_counts(spark, sf_dir):
    return profile.null_counts(labelled_documents(spark, sf_dir))


@query(
    "value_frequency",
    f"WITH d AS ({_LABELLED}) SELECT lang AS value, count(*) AS n, "
    "round(count(*) * CAST(100 AS DOUBLE) / sum(count(*)) OVER (), 6) AS percent FROM d WHERE lang IS NOT NULL GROUP BY lang",
)
def value_frequency(spark, sf_dir):
    return profile.value_frequency(labelled_documents(spark, sf_dir), "lang").withColumn("percent", F.round("percent", 6))


# --- dates --------------------------------------------------------------------------------------------------------

_BIRTHS = with_sql("customers", "SELECT customer_id, {value} FROM customers")


@query("age", _BIRTHS.format(value=age_sql("dob") + " AS age"))
def age(spark, sf_dir):
    return dates.with_age(fx.customers(spark, sf_dir).select("customer_id", "dob"), "dob", AS_OF)


@query("tenure_months", _BIRTHS.format(value=tenure_sql("customer_to_bank") + " AS customer_since_months"))
def tenure_months(spark, sf_dir):
    customers = fx.customers(spark, sf_dir).select("customer_id", "customer_to_bank")
    return dates.with_customer_since(customers, "customer_to_bank", AS_OF)


@query(
    "tenure_months_calendar",
    "SELECT o_orderkey, CAST(datesub('month', CAST(o_orderdate AS DATE), DATE '2002-01-15') AS BIGINT) AS months FROM orders",
)
def tenure_months_calendar(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", dates.tenure_months(F.to_date("o_orderdate"), AS_OF, "calendar").alias("months"))


_MOTOR_DAYS = with_sql("motor_policy", "SELECT customer_id, {value} FROM motor_policy")


@query(
    "months_ago",
    _MOTOR_DAYS.format(value=tenure_sql("incident_date", "%Y-%m-%d") + " AS months_ago_incident_date"),
)
def months_ago(spark, sf_dir):
    motor = fx.motor_policy(spark, sf_dir).select("customer_id", "incident_date")
    return dates.with_months_ago(motor, "incident_date", AS_OF, dates.date_pattern("-", 2, 1, 0))


@query(
    "days_elapsed",
    with_sql(
        "customers",
        "SELECT customer_id, datediff('day', CAST(try_strptime(customer_to_bank, '%m/%d/%Y') AS DATE), "
        "DATE '2002-01-15') AS customer_to_bank_in_days FROM customers",
    ),
)
def days_elapsed(spark, sf_dir):
    customers = fx.customers(spark, sf_dir).select("customer_id", "customer_to_bank")
    return dates.with_days_elapsed(customers, "customer_to_bank", AS_OF, dates.date_pattern("/", 1, 0, 2))


@query("years_old", _MOTOR_DAYS.format(value="2002 - auto_year AS years_auto_old"))
def years_old(spark, sf_dir):
    return dates.with_years_old(fx.motor_policy(spark, sf_dir).select("customer_id", "auto_year"), "auto_year", AS_OF)


@query("vehicle_age", _MOTOR_DAYS.format(value="2002 - auto_year AS vehicle_age_yrs"))
def vehicle_age(spark, sf_dir):
    motor = fx.motor_policy(spark, sf_dir).select("customer_id", F.col("auto_year").cast("string").alias("auto_year"))
    return dates.with_vehicle_age(motor, "auto_year", AS_OF)


@query(
    "bought_month",
    with_sql(
        "customers",
        "SELECT customer_id, CAST(month(try_strptime(customer_to_bank, '%m/%d/%Y')) AS VARCHAR) "
        "AS product_bought_in_month FROM customers",
    ),
)
def bought_month(spark, sf_dir):
    customers = fx.customers(spark, sf_dir).select("customer_id", "customer_to_bank")
    return dates.with_bought_month(customers, "customer_to_bank")


@query(
    "tenure_segment",
    with_sql(
        "customers",
        f"SELECT customer_id, {tenure_sql('customer_to_bank')} AS customer_since_months, CASE WHEN "
        f"{tenure_sql('customer_to_bank')} > 24 THEN 'old_customer' ELSE 'new_customer' END AS customer_rel_dur_segment "
        "FROM customers",
    ),
)
def tenure_segment(spark, sf_dir):
    customers = fx.customers(spark, sf_dir).select("customer_id", "customer_to_bank")
    return dates.with_tenure_segment(dates.with_customer_since(customers, "customer_to_bank", AS_OF))


# --- policies -----------------------------------------------------------------------------------------------------


@query(
    "split_limits",
    _MOTOR_DAYS.format(
        value="CAST(split_part(policy_csl, '/', 1) AS BIGINT) AS bodily_injury_single_limit, "
        "CAST(split_part(policy_csl, '/', 2) AS BIGINT) AS bodily_injury_total_limit"
    ),
)
def split_limits(spark, sf_dir):
    return policy.with_split_limits(fx.motor_policy(spark, sf_dir).select("customer_id", "policy_csl"), "policy_csl")


@query("net_amount", _MOTOR_DAYS.format(value="round(capital_gains + capital_loss, 2) AS net_captial"))
def net_amount(spark, sf_dir):
    motor = fx.motor_policy(spark, sf_dir).select("customer_id", "capital_gains", "capital_loss")
    return policy.with_net_amount(motor, "capital_gains", "capital_loss").withColumn(
        "net_captial", F.round("net_captial", 2)
    )


@query(
    "severity",
    _MOTOR_DAYS.format(
        value="CAST(CASE lower(incident_severity) WHEN 'total loss' THEN 0.8 WHEN 'major damage' THEN 0.6 "
        "WHEN 'minor damage' THEN 0.4 ELSE 0.2 END AS DOUBLE) AS weight, CAST(0.2 AS DOUBLE) AS literal_weight"
    ),
)
def severity(spark, sf_dir):
    text = F.lower("incident_severity")
    return fx.motor_policy(spark, sf_dir).select(
        "customer_id", policy.severity_weight(text).alias("weight"),
        policy.severity_weight(text, case_sensitive=True).alias("literal_weight"),
    )


@query(
    "day_part",
    "SELECT event_id, CASE WHEN hour(ts) >= 4 AND hour(ts) < 12 THEN 'morning' WHEN hour(ts) >= 12 AND hour(ts) < 19 "
    "THEN 'evening' ELSE 'night' END AS part FROM events",
)
def day_part(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", policy.day_part(F.hour("ts")).alias("part"))


@query(
    "cap_count",
    "SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber >= 2 THEN 2 ELSE l_linenumber END AS witnesses FROM lineitem",
)
def cap_count(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", policy.capped_count(F.col("l_linenumber")).alias("witnesses")
    )


@query(
    "make_value",
    _MOTOR_DAYS.format(
        value="CASE WHEN lower(auto_make) IN ('mercedes', 'bmw', 'audi') THEN 10000 ELSE 4000 END * (2002 - auto_year) "
        "AS auto_make"
    ),
)
def make_value(spark, sf_dir):
    years = dates.years_since(F.col("auto_year"), AS_OF)
    return fx.motor_policy(spark, sf_dir).select(
        "customer_id", policy.make_value(F.lower("auto_make"), years).alias("auto_make")
    )


# --- lookups ------------------------------------------------------------------------------------------------------


@query(
    "city_population",
    with_sql(
        "customers cities",
        "SELECT customer_id, coalesce(population, 0) AS population FROM customers c LEFT JOIN cities t "
        "ON lower(trim(c.city)) = lower(trim(t.city))",
    ),
)
def city_population(spark, sf_dir):
    customers = fx.customers(spark, sf_dir).select("customer_id", "city")
    return lookups.with_population(customers, "city", fx.cities(spark, sf_dir))


@query("one_city_population", with_sql("cities", "SELECT city, population FROM cities WHERE lower(city) = 'nation_7'"))
def one_city_population(spark, sf_dir):
    return lookups.city_population(fx.cities(spark, sf_dir), "Nation_7")


_POPULATED = (
    "SELECT customer_id, coalesce(population, 0) AS population FROM customers c LEFT JOIN cities t "
    "ON lower(trim(c.city)) = lower(trim(t.city))"
)
_EDGES = "SELECT quantile_cont(CAST(population AS DOUBLE), {q}) AS edge FROM populated"
_EDGE_ROWS = " UNION ALL ".join(
    f"SELECT CAST({q} AS DOUBLE) AS probability, edge FROM ({_EDGES.format(q=q)})" for q in (0, 0.25, 0.5, 0.75, 1)
)


@query("quartile_edges", with_sql("customers cities", _EDGE_ROWS, populated=_POPULATED))
def quartile_edges(spark, sf_dir):
    customers = fx.customers(spark, sf_dir).select("customer_id", "city")
    populated = lookups.with_population(customers, "city", fx.cities(spark, sf_dir))
    edges = numeric.exact_quantiles(populated, "population")
    return spark.createDataFrame(list(edges.items()), "probability double, edge double")


@query(
    "price_quartiles",
    " UNION ALL ".join(
        f"SELECT CAST({q} AS DOUBLE) AS probability, round(quantile_cont(l_extendedprice, {q}), 6) AS edge FROM lineitem"
        for q in (0, 0.25, 0.5, 0.75, 1)
    ),
)
def price_quartiles(spark, sf_dir):
    """Many distinct values: the column is cut into ranges of values."""
    edges = numeric.exact_quantiles(table(spark, sf_dir, "lineitem"), "l_extendedprice", rows_per_range=5000)
    rows_ = [(p, round(v, 6)) for p, v in edges.items()]
    return spark.createDataFrame(rows_, "probability double, edge double")


# Edges may coincide: a tier is numbered by the distinct edges below the value.
_BELOW = " + ".join(
    f"CASE WHEN e.e{i} < population" + (f" AND e.e{i} <> e.e{i - 1}" if i else "") + " THEN 1 ELSE 0 END" for i in range(5)
)
TIER_SQL = f"CASE WHEN population > e.e0 AND population <= e.e4 THEN 't' || (({_BELOW}) - 1) ELSE 'unknown' END"
EDGES_ROW_SQL = "SELECT " + ", ".join(
    f"quantile_cont(CAST(population AS DOUBLE), {q}) AS e{i}" for i, q in enumerate((0, 0.25, 0.5, 0.75, 1))
) + " FROM populated"


@query(
    "city_tier",
    with_sql(
        "customers cities", f"SELECT customer_id, {TIER_SQL} AS city_grp FROM populated, edges e",
        populated=_POPULATED, edges=EDGES_ROW_SQL,
    ),
)
def city_tier(spark, sf_dir):
    customers = fx.customers(spark, sf_dir).select("customer_id", "city")
    populated = lookups.with_population(customers, "city", fx.cities(spark, sf_dir))
    edges = numeric.tier_edges(numeric.exact_quantiles(populated, "population"))
    return numeric.with_city_tier(populated, "population", edges)


KM_SQL = (
    "round(2 * 6371.0 * asin(sqrt(pow(sin((radians(latitude) - radians(CAST(12.9698 AS DOUBLE))) / 2), 2) + "
    "cos(radians(latitude)) * cos(radians(CAST(12.9698 AS DOUBLE))) * "
    "pow(sin((radians(longitude) - radians(CAST(77.75 AS DOUBLE))) / 2), 2))), 2)"
)
LOCATED = (
    f"SELECT customer_id, coalesce(km, 0) AS distance_km, CASE WHEN km IS NULL THEN 0 ELSE 1 END AS is_matched "
    f"FROM customers c LEFT JOIN (SELECT place, city, {KM_SQL} AS km FROM gazetteer) g "
    "ON lower(trim(split_part(c.address, ',', 1))) = lower(g.place) AND lower(trim(split_part(c.address, ',', 2))) = lower(g.city)"
)


@query("address_distance", with_sql("customers gazetteer", LOCATED))
def address_distance(spark, sf_dir):
    customers = fx.customers(spark, sf_dir).select("customer_id", "address")
    return lookups.with_branch_distance(customers, "address", fx.gazetteer(spark, sf_dir)).drop("address")


@query(
    "near_flag",
    with_sql(
        "customers gazetteer",
        "SELECT customer_id, CASE WHEN trunc(distance_km) < 15 THEN 1 ELSE 0 END AS address_near_by_bank FROM located",
        located=LOCATED,
    ),
)
def near_flag(spark, sf_dir):
    customers = fx.customers(spark, sf_dir).select("customer_id", "address")
    located = lookups.with_branch_distance(customers, "address", fx.gazetteer(spark, sf_dir))
    return lookups.with_near_branch(located, "address")


@query(
    "great_circle",
    "SELECT s_suppkey, round(2 * 6371.0 * asin(sqrt(pow(sin((radians(lat) - radians(CAST(12.9698 AS DOUBLE))) / 2), 2) + "
    "cos(radians(lat)) * cos(radians(CAST(12.9698 AS DOUBLE))) * pow(sin((radians(lon) - radians(CAST(77.75 AS DOUBLE))) "
    "/ 2), 2))), 2) AS km FROM (SELECT s_suppkey, CAST(s_suppkey % 180 - 90 AS DOUBLE) AS lat, s_acctbal / 60 AS lon FROM supplier)",
)
def great_circle(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier")
    return supplier.select(
        "s_suppkey", geo.great_circle_km((F.col("s_suppkey") % 180 - 90).cast("double"), F.col("s_acctbal") / 60).alias("km")
    )


# --- within a row -------------------------------------------------------------------------------------------------

MONTHS = 12


def monthly_orders(spark, sf_dir):
    """Order totals and counts of twelve months per customer, as two groups of twelve columns each."""
    month = F.month("o_orderdate")
    measures = []
    for m in range(1, MONTHS + 1):
        measures.append(F.coalesce(F.round(F.sum(F.when(month == m, F.col("o_totalprice"))), 2), F.lit(0.0)).alias(f"amt_{m}"))
        measures.append(F.count(F.when(month == m, 1)).cast("double").alias(f"cnt_{m}"))
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(*measures)


def _group_sql(prefix: str) -> str:
    c = [f"{prefix}_{m}" for m in range(1, MONTHS + 1)]
    mean = f"(({' + '.join(c)}) / {MONTHS})"
    var = "((" + " + ".join(f"pow({x} - {mean}, 2)" for x in c) + f") / {MONTHS})"
    below = " + ".join(f"CASE WHEN {mean} > {x} THEN 1 ELSE 0 END" for x in c)
    skew = f"CASE WHEN {var} > 0 THEN 3 * ({mean} - ({c[MONTHS // 2 - 1]} + {c[MONTHS // 2]}) / 2) / sqrt({var}) END"
    return (
        f"{mean} AS {prefix}_mean, {var} AS {prefix}_variance, ({c[MONTHS // 2 - 1]} + {c[MONTHS // 2]}) / 2 AS {prefix}_median, "
        f"{below} AS {prefix}_below, {skew} AS {prefix}_skew, greatest(0.0, {', '.join(c)}) AS {prefix}_peak"
    )


_MONTHLY_SQL = "SELECT o_custkey, " + ", ".join(
    f"coalesce(round(sum(CASE WHEN month(o_orderdate) = {m} THEN o_totalprice END), 2), 0) AS amt_{m}, "
    f"CAST(count(CASE WHEN month(o_orderdate) = {m} THEN 1 END) AS DOUBLE) AS cnt_{m}"
    for m in range(1, MONTHS + 1)
) + " FROM orders GROUP BY o_custkey"
_ROW_STATS = f"WITH m AS ({_MONTHLY_SQL}), s AS (SELECT o_custkey, {_group_sql('amt')}, {_group_sql('cnt')} FROM m) "


@query(
    "row_statistics",
    _ROW_STATS + "SELECT o_custkey, round(amt_mean, 4) AS g_mean, round(amt_variance, 1) AS g_variance, round(amt_median, 4) "
    "AS g_median, CAST(amt_below AS INTEGER) AS g_below, round(amt_skew, 6) AS g_skew, round(amt_peak, 2) AS g_peak FROM s",
)
def row_statistics(spark, sf_dir):
    stats = rows.row_statistics(monthly_orders(spark, sf_dir), [f"amt_{m}" for m in range(1, MONTHS + 1)], "g")
    return stats.select(
        "o_custkey", F.round("g_mean", 4).alias("g_mean"), F.round("g_variance", 1).alias("g_variance"),
        F.round("g_median", 4).alias("g_median"), "g_below", F.round("g_skew", 6).alias("g_skew"),
        F.round("g_peak", 2).alias("g_peak"),
    )


@query(
    "churn_row_stats",
    _ROW_STATS + "SELECT o_custkey, CAST(CASE WHEN amt_below >= 4 AND cnt_below >= 4 AND amt_skew > 0 AND cnt_skew > 0 THEN 0.8 "
    "WHEN (amt_below > 4 AND amt_skew > 0) OR (cnt_below > 4 AND cnt_skew > 0) THEN 0.5 ELSE 0.3 END AS DOUBLE) "
    "AS transactions_churn_analysis FROM s",
)
def churn_row_stats(spark, sf_dir):
    groups = [[f"{p}_{m}" for m in range(1, MONTHS + 1)] for p in ("amt", "cnt")]
    return rows.with_churn_score(monthly_orders(spark, sf_dir), *groups).select("o_custkey", "transactions_churn_analysis")


@query(
    "education_label",
    "SELECT c_custkey, CASE WHEN c_acctbal * 100 < 400000 THEN 'Not Graduate' ELSE 'Graduate' END AS education FROM customer",
)
def education_label(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey", rows.education_label(F.col("c_acctbal") * 100).alias("education")
    )


def choice_sql(key: str, values, salt: str) -> str:
    number = f"CAST('0x' || substr(md5('{salt}' || CAST({key} AS VARCHAR)), 1, 8) AS BIGINT) % {len(values)}"
    return f"CASE {number} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


# The addresses handed out to customers without one.
ADDRESSES = (
    "Fraser Town,Bengaluru", "J.C.Nagar,Bengaluru", "Air Force Hospital,Bengaluru", "Agram,Bengaluru",
    "Madhavan Park,Bengaluru", "Vimanapura,Bengaluru", "Yeswanthpura,Bengaluru", "Hulsur Bazaar,Bengaluru",
)


@query("address_enrich", f"SELECT c_custkey, {choice_sql('c_custkey', ADDRESSES, 'address')} AS address FROM customer")
def address_enrich(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey", rows.keyed_choice(F.col("c_custkey"), ADDRESSES, "address").alias("address")
    )
