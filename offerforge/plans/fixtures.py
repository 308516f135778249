"""Bank tables derived from the given tables, in Spark and as SQL.

Every fixture covers all rows of its source. The SQL texts are the same definitions for the checking engine.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerforge.plans.registry import table

AS_OF = date(2002, 1, 15)

CARDS = ("Silver", "Gold", "Platinum", "Signature")
EXPENSES = {"view": "travel", "click": "fuel", "signup": "entertainment", "purchase": "food", "error": "bills"}
MAKES = ("Saab", "Mercedes", "Dodge", "Audi", "Nissan", "BMW", "Ford")
SEVERITIES = ("Total Loss", "Major Damage", "Minor Damage", "Trivial Damage")
UNLISTED = ("NATION_0", "NATION_1", "NATION_2")
UNMAPPED = ("NATION_23", "NATION_24")
AGENCIES = ("CWT", "EPX", "JZI", "C2B")


def pick(number: Column, values: tuple[str, ...]) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), (number % len(values)).cast("int"))


def slash_date(day: Column, years_back: Column | int = 0) -> Column:
    """``M/d/yyyy`` text; going back from 29 February gives a day that does not exist."""
    return F.concat_ws(
        "/", F.month(day).cast("string"), F.dayofmonth(day).cast("string"),
        (F.year(day) - years_back).cast("string"),
    )


def card_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.col("user_id")
    expense = F.create_map(*[F.lit(x) for item in EXPENSES.items() for x in item])
    noted = F.regexp_extract("props", "[0-9]+", 0).cast("bigint") % 25
    return table(spark, sf_dir, "events").select(
        user.alias("customer_id"),
        pick(user, ("F", "M")).alias("gender"),
        pick(user, CARDS).alias("card_type"),
        pick(F.col("event_id"), ("Salaried", "Business", "Student", "Retired", "Farmer")).alias("occupation"),
        F.concat_ws("/", 1 + user % 12, 1 + user % 28, 1950 + user % 50).alias("dob"),
        (20000 + user % 50 * 1000 + F.col("event_id") % 3 * 500).cast("double").alias("income"),
        F.concat_ws("/", 1 + user % 12, 1 + F.col("event_id") % 3, 1995 + user % 7).alias("customer_to_bank"),
        F.concat(F.lit("NATION_"), F.when(F.col("event_id") % 3 == 0, noted).otherwise(user % 25).cast("string")).alias("city"),
        pick(F.col("event_id"), ("Single", "Married")).alias("marital_status"),
        expense[F.col("event_type")].alias("exp_type"),
        F.col("value").alias("amount"),
        F.col("event_type").alias("city_transaction_made"),
        F.col("ts").cast("date").cast("string").alias("date_transaction_made"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer, with the day of the customer's first order by number as joining day."""
    orders = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k")).agg(
        F.min_by(F.to_date("o_orderdate"), "o_orderkey").alias("since"),
        F.count(F.lit(1)).alias("n_orders"),
        F.max("o_totalprice").alias("top_price"),
    )
    key = F.col("c_custkey")
    return (
        table(spark, sf_dir, "customer")
        .join(orders, F.col("c_custkey") == F.col("k"), "left")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            F.concat(F.lit("C"), key.cast("string")).alias("customer_id"),
            pick(key, ("F", "M")).alias("gender"),
            F.col("c_mktsegment").alias("occupation"),
            pick(key, ("Single", "Married", "Single")).alias("marital_status"),
            slash_date(F.col("since"), 20 + key % 40).alias("dob"),
            slash_date(F.col("since")).alias("customer_to_bank"),
            F.col("n_name").alias("city"),
            F.col("c_acctbal").alias("income"),
            F.concat(F.col("n_name"), F.lit(","), F.col("r_name")).alias("address"),
            F.concat(F.lit("G"), (key % 14).cast("string")).alias("branch_group"),
            pick(key, ("Urban", "Rural", "Semiurban", "Metro")).alias("property_area"),
            F.col("n_orders"),
            F.col("top_price"),
            key.alias("number"),
        )
    )


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Population by city; three nations are not on the list."""
    return table(spark, sf_dir, "nation").filter(~F.col("n_name").isin(*UNLISTED)).select(
        F.col("n_name").alias("city"), (F.col("n_nationkey").cast("bigint") * 37 % 11 * 100000).alias("population")
    )


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places around the branch; two nations are not on the list."""
    key = F.col("n_nationkey")
    return (
        table(spark, sf_dir, "nation").filter(~F.col("n_name").isin(*UNMAPPED))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("n_name").alias("place"), F.col("r_name").alias("city"),
            (12.9698 + (key - 12) * 0.05).alias("latitude"), (77.75 + (key * 7 % 25 - 12) * 0.05).alias("longitude"),
        )
    )


def policy_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last order of each customer, by order number."""
    last = F.max_by(F.struct("o_orderstatus", "o_orderpriority", "o_orderdate", "o_totalprice"), "o_orderkey")
    return (
        table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k"))
        .agg(F.max("o_orderkey").alias("ok"), last.alias("last"), F.count(F.lit(1)).alias("n"))
        .select("k", "ok", "n", "last.*")
    )


def motor_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.min("l_partkey").alias("pk"), F.max("l_linenumber").cast("bigint").alias("lines"),
        F.max("l_extendedprice").alias("gain"), (-F.min("l_extendedprice")).alias("loss"),
    )
    size = F.col("p_size").cast("bigint")
    part = F.col("p_partkey")
    return (
        policy_base(spark, sf_dir).join(lines, F.col("ok") == F.col("l_orderkey"))
        .join(table(spark, sf_dir, "part"), F.col("pk") == F.col("p_partkey"))
        .select(
            F.concat(F.lit("C"), F.col("k").cast("string")).alias("customer_id"),
            F.col("p_type").alias("motor_addon"),
            F.col("p_brand").alias("incident_city"), F.col("p_name").alias("incident_location"),
            F.col("p_brand").alias("incident_state"), F.col("p_brand").alias("policy_state"),
            F.col("p_name").alias("policy_bind_date"), F.col("p_name").alias("auto_model"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("incident_date"),
            (1960 + size % 40).alias("auto_year"),
            F.concat_ws("/", size, size * 2).alias("policy_csl"),
            F.col("gain").alias("capital_gains"), F.col("loss").alias("capital_loss"),
            pick(part, SEVERITIES).alias("incident_severity"),
            (F.col("ok") % 24).alias("incident_hour_of_the_day"),
            (F.col("lines") - 1).alias("witnesses"),
            pick(part, MAKES).alias("auto_make"),
            pick(F.col("ok"), ("Front", "Rear", "Side", "?")).alias("collision_type"),
            F.col("p_retailprice").alias("policy_annual_premium"),
        )
    )


def _policy_holder(stranger: str) -> Column:
    """Customer of a policy; where ``stranger`` holds, a number that no customer has."""
    return F.expr(f"concat('C', CASE WHEN {stranger} THEN k + 1000000000 ELSE k END)").alias("customer_id")


def travel_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return policy_base(spark, sf_dir).select(
        _policy_holder("o_orderstatus = 'F'"),
        F.col("o_orderpriority").alias("travel_addon"),
        F.col("o_orderstatus").alias("destination"),
        pick(F.col("k"), AGENCIES).alias("agency"),
        F.concat(F.lit("P"), (F.col("ok") % 16).cast("string")).alias("product_name"),
        pick(F.col("ok"), ("Online", "Offline")).alias("channel"),
        F.col("o_totalprice").alias("net_sales"), F.col("n").alias("duration"),
    )


def medical_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return policy_base(spark, sf_dir).select(
        _policy_holder("o_orderpriority = '5-LOW'"),
        pick(F.col("ok"), ("Cardiovascular", "Illness", "Mental Health", "Dental")).alias("medical_addon"),
        (18 + F.col("k") % 25).alias("bmi"),
        pick(F.col("n"), ("Yes", "No")).alias("smoker"),
        F.col("o_totalprice").alias("charges"),
    )


def home_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return policy_base(spark, sf_dir).select(
        _policy_holder("o_orderpriority = '2-HIGH'"),
        pick(F.col("ok"), ("Lock", "Garden", "Key")).alias("addon"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("quote_date"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("cover_start"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("mta_date"),
        pick(F.col("ok"), ("Y", "N")).alias("police"),
        pick(F.col("n"), ("Y", "N")).alias("alarm"),
        F.col("o_orderstatus").alias("roof"),
        pick(F.col("k") + F.col("ok"), ("Brick", "Wood", "Stone", "Mixed")).alias("walls"),
        pick(F.col("ok"), ("A", "B", "C", "D", "E", "F")).alias("risk_class"),
        F.col("o_totalprice").alias("sum_insured"),
    )


def property_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return policy_base(spark, sf_dir).select(
        _policy_holder("o_orderpriority = '1-URGENT'"),
        pick(F.col("ok"), ("Fire", "Flood", "Quake")).alias("addon"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("quote_date"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("cover_start"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("mta_date"),
        pick(F.col("ok"), ("Y", "N")).alias("police"),
        pick(F.col("n"), ("Let", "Owned")).alias("tenure_kind"),
        F.col("o_orderstatus").alias("listing"),
        pick(F.col("k") + F.col("ok"), ("Flat", "House", "Villa", "Farm")).alias("kind"),
        F.col("o_totalprice").alias("rebuild_cost"),
    )


def _pick_sql(number: str, values: tuple[str, ...]) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE ({number}) % {len(values)} {whens} END"


_EXPENSE_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in EXPENSES.items()) + " END"
_SLASH = "month({d}) || '/' || day({d}) || '/' || (year({d}) - {back})"
_DAY = "strftime(o_orderdate, '%Y-%m-%d')"

CTES = {
    "card_transactions": f"""
        SELECT user_id AS customer_id, {_pick_sql('user_id', ('F', 'M'))} AS gender,
          {_pick_sql('user_id', CARDS)} AS card_type,
          {_pick_sql('event_id', ('Salaried', 'Business', 'Student', 'Retired', 'Farmer'))} AS occupation,
          (1 + user_id % 12) || '/' || (1 + user_id % 28) || '/' || (1950 + user_id % 50) AS dob,
          CAST(20000 + user_id % 50 * 1000 + event_id % 3 * 500 AS DOUBLE) AS income,
          (1 + user_id % 12) || '/' || (1 + event_id % 3) || '/' || (1995 + user_id % 7) AS customer_to_bank,
          'NATION_' || CASE WHEN event_id % 3 = 0 THEN CAST(regexp_extract(props, '[0-9]+') AS BIGINT) % 25
            ELSE user_id % 25 END AS city,
          {_pick_sql('event_id', ('Single', 'Married'))} AS marital_status,
          {_EXPENSE_SQL} AS exp_type, "value" AS amount
        FROM events""",
    "first_orders": """
        SELECT o_custkey AS k, CAST(arg_min(o_orderdate, o_orderkey) AS DATE) AS since, count(*) AS n_orders,
          max(o_totalprice) AS top_price
        FROM orders GROUP BY o_custkey""",
    "customers": f"""
        SELECT 'C' || c_custkey AS customer_id, {_pick_sql('c_custkey', ('F', 'M'))} AS gender,
          c_mktsegment AS occupation, {_pick_sql('c_custkey', ('Single', 'Married', 'Single'))} AS marital_status,
          {_SLASH.format(d='since', back='(20 + c_custkey % 40)')} AS dob,
          {_SLASH.format(d='since', back='0')} AS customer_to_bank,
          n_name AS city, c_acctbal AS income, n_name || ',' || r_name AS address,
          'G' || (c_custkey % 14) AS branch_group,
          {_pick_sql('c_custkey', ('Urban', 'Rural', 'Semiurban', 'Metro'))} AS property_area,
          n_orders, top_price, c_custkey AS number
        FROM customer LEFT JOIN first_orders ON c_custkey = k
          LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    "cities": f"""
        SELECT n_name AS city, CAST(n_nationkey AS BIGINT) * 37 % 11 * 100000 AS population
        FROM nation WHERE n_name NOT IN {UNLISTED}""",
    "gazetteer": f"""
        SELECT n_name AS place, r_name AS city,
          CAST(12.9698 AS DOUBLE) + (n_nationkey - 12) * CAST(0.05 AS DOUBLE) AS latitude,
          CAST(77.75 AS DOUBLE) + (n_nationkey * 7 % 25 - 12) * CAST(0.05 AS DOUBLE) AS longitude
        FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_name NOT IN {UNMAPPED}""",
    "policy_base": """
        SELECT o_custkey AS k, max(o_orderkey) AS ok, count(*) AS n, arg_max(o_orderstatus, o_orderkey) AS o_orderstatus,
          arg_max(o_orderpriority, o_orderkey) AS o_orderpriority, arg_max(o_orderdate, o_orderkey) AS o_orderdate,
          arg_max(o_totalprice, o_orderkey) AS o_totalprice
        FROM orders GROUP BY o_custkey""",
    "motor_policy": f"""
        SELECT 'C' || k AS customer_id, p_type AS motor_addon, {_DAY} AS incident_date,
          CAST(1960 + p_size % 40 AS BIGINT) AS auto_year, p_size || '/' || (p_size * 2) AS policy_csl,
          gain AS capital_gains, loss AS capital_loss, {_pick_sql('p_partkey', SEVERITIES)} AS incident_severity,
          ok % 24 AS incident_hour_of_the_day, lines - 1 AS witnesses, {_pick_sql('p_partkey', MAKES)} AS auto_make,
          {_pick_sql('ok', ('Front', 'Rear', 'Side', '?'))} AS collision_type,
          p_retailprice AS policy_annual_premium
        FROM policy_base JOIN (
          SELECT l_orderkey, min(l_partkey) AS pk, CAST(max(l_linenumber) AS BIGINT) AS lines,
            max(l_extendedprice) AS gain, -min(l_extendedprice) AS loss
          FROM lineitem GROUP BY l_orderkey) ON ok = l_orderkey
          JOIN part ON pk = p_partkey""",
    "travel_policy": f"""
        SELECT 'C' || CASE WHEN o_orderstatus = 'F' THEN k + 1000000000 ELSE k END AS customer_id, o_orderpriority AS travel_addon, o_orderstatus AS destination,
          {_pick_sql('k', AGENCIES)} AS agency, 'P' || (ok % 16) AS product_name,
          {_pick_sql('ok', ('Online', 'Offline'))} AS channel, o_totalprice AS net_sales, n AS duration
        FROM policy_base""",
    "medical_policy": f"""
        SELECT 'C' || CASE WHEN o_orderpriority = '5-LOW' THEN k + 1000000000 ELSE k END AS customer_id,
          {_pick_sql('ok', ('Cardiovascular', 'Illness', 'Mental Health', 'Dental'))} AS medical_addon,
          18 + k % 25 AS bmi, {_pick_sql('n', ('Yes', 'No'))} AS smoker, o_totalprice AS charges
        FROM policy_base""",
    "home_policy": f"""
        SELECT 'C' || CASE WHEN o_orderpriority = '2-HIGH' THEN k + 1000000000 ELSE k END AS customer_id, {_pick_sql('ok', ('Lock', 'Garden', 'Key'))} AS addon,
          {_pick_sql('n', ('Y', 'N'))} AS alarm, o_orderstatus AS roof,
          {_pick_sql('k + ok', ('Brick', 'Wood', 'Stone', 'Mixed'))} AS walls,
          {_pick_sql('ok', ('A', 'B', 'C', 'D', 'E', 'F'))} AS risk_class, o_totalprice AS sum_insured
        FROM policy_base""",
    "property_policy": f"""
        SELECT 'C' || CASE WHEN o_orderpriority = '1-URGENT' THEN k + 1000000000 ELSE k END AS customer_id, {_pick_sql('ok', ('Fire', 'Flood', 'Quake'))} AS addon,
          {_pick_sql('n', ('Let', 'Owned'))} AS tenure_kind, o_orderstatus AS listing,
          {_pick_sql('k + ok', ('Flat', 'House', 'Villa', 'Farm'))} AS kind, o_totalprice AS rebuild_cost
        FROM policy_base""",
}

_NEEDS = {
    "customers": ("first_orders",),
    **{f"{p}_policy": ("policy_base",) for p in ("motor", "travel", "medical", "home", "property")},
}


def with_sql(names: str, body: str, **more: str) -> str:
    """``WITH`` clause of the named fixtures, what they build on and further named steps, before the query body."""
    order: list[str] = []
    for name in names.split():
        for n in (*_NEEDS.get(name, ()), name):
            if n not in order:
                order.append(n)
    parts = [f"{n} AS ({CTES[n]})" for n in order] + [f"{n} AS ({s})" for n, s in more.items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body


# Age and tenure in SQL, from M/d/yyyy text, as of AS_OF.
def age_sql(text: str, fmt: str = "%m/%d/%Y") -> str:
    d = f"CAST(try_strptime({text}, '{fmt}') AS DATE)"
    return (
        f"CAST({AS_OF.year} - year({d}) - CASE WHEN month({d}) * 100 + day({d}) > {AS_OF.month * 100 + AS_OF.day} "
        f"THEN 1 ELSE 0 END AS BIGINT)"
    )


def tenure_sql(text: str, fmt: str = "%m/%d/%Y") -> str:
    d = f"CAST(try_strptime({text}, '{fmt}') AS DATE)"
    return f"CAST({age_sql(text, fmt)} * 12 + {AS_OF.month} - month({d}) AS BIGINT)"
