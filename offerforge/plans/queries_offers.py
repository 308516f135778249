"""Registered queries: offers from scores, the card ladder, eligibility rules, combination."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from offerforge.functions.dates import with_age, years_since
from offerforge.functions.rows import with_churn_score
from offerforge.operators import eligibility, encode, model, recommend
from offerforge.operators.tables import attach
from offerforge.plans import fixtures as fx
from offerforge.plans.fixtures import AS_OF, age_sql, with_sql
from offerforge.plans.jobs import consolidate_card, recommend_card_up_sell
from offerforge.plans.queries_features import MONTHS, _ROW_STATS, monthly_orders
from offerforge.plans.queries_relational import consolidation_steps
from offerforge.plans.registry import query, table
from offerforge.session import scratch_path, written
from offerforge.sources.rules import CATALOGUES, catalogue_rules, read_rule_file, rule_lines, rule_rows

# --- card ladder --------------------------------------------------------------------------------------------------

SPENT = ("travel", "fuel", "entertainment", "food", "bill")


def _argmax_sql(suffix: str) -> str:
    peak = f"greatest(0, {', '.join(f'{c}_{suffix}' for c in SPENT)})"
    return "CASE " + " ".join(f"WHEN {c}_{suffix} = {peak} THEN '{c}'" for c in SPENT) + " END"


CATEGORY_STEP = (
    f"SELECT customer_id, card_type, {_argmax_sql('amt')} AS max_spent_category, {_argmax_sql('trans')} AS max_trans_category "
    "FROM consolidated"
)
LADDER_STEP = """
    SELECT customer_id, 1 AS rank, CASE card_type WHEN 'silver' THEN 'gold ' WHEN 'gold' THEN 'platinum '
        WHEN 'platinum' THEN CASE WHEN max_spent_category = max_trans_category THEN 'platinum ' ELSE 'signature ' END
        WHEN 'signature' THEN 'signature ' END || max_spent_category AS label, CAST(0.75 AS DOUBLE) AS score
    FROM categories
    UNION ALL
    SELECT customer_id, 2, CASE WHEN max_spent_category = max_trans_category
        THEN CASE card_type WHEN 'silver' THEN 'platinum ' WHEN 'gold' THEN 'signature ' WHEN 'platinum' THEN 'signature ' END
            || max_spent_category
        ELSE CASE card_type WHEN 'silver' THEN 'gold ' WHEN 'gold' THEN 'platinum ' ELSE 'signature ' END
            || max_trans_category END, CAST(0.25 AS DOUBLE)
    FROM categories"""
CARD_OFFERS = {**consolidation_steps(), "categories": CATEGORY_STEP, "offers": LADDER_STEP}


@query(
    "card_upsell_offers",
    with_sql("card_transactions", "SELECT * FROM offers WHERE label IS NOT NULL", **CARD_OFFERS),
)
def card_upsell_offers(spark, sf_dir):
    offers = recommend_card_up_sell(consolidate_card(fx.card_transactions(spark, sf_dir)))
    return recommend.explode_offers(offers, "top_reco", "customer_id")


@query(
    "argmax_category",
    with_sql(
        "card_transactions", "SELECT customer_id, max_spent_category, max_trans_category FROM categories",
        **consolidation_steps(), categories=CATEGORY_STEP,
    ),
)
def argmax_category(spark, sf_dir):
    consolidated = consolidate_card(fx.card_transactions(spark, sf_dir))
    return recommend.with_top_categories(consolidated).select("customer_id", "max_spent_category", "max_trans_category")


# --- decoding -----------------------------------------------------------------------------------------------------

LABELS = [f"class_{i}" for i in range(64)]
_SCORES = "SELECT vec_id, label, i - 1 AS i, CAST(embedding[i] AS DOUBLE) AS s FROM embeddings, range(1, 65) t(i)"
_RANKED = f"SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, i) AS r FROM ({_SCORES})"


def scores(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("p"))


@query("top1_decode", f"SELECT vec_id, i AS best FROM ({_RANKED}) WHERE r = 1")
def top1_decode(spark, sf_dir):
    return scores(spark, sf_dir).select("vec_id", recommend.top_index(F.col("p")).alias("best"))


@query(
    "topk_decode",
    f"SELECT vec_id, CAST(r AS INTEGER) AS rank, 'class_' || i AS label, s AS score FROM ({_RANKED}) WHERE r <= 3",
)
def topk_decode(spark, sf_dir):
    decoded = scores(spark, sf_dir).select("vec_id", recommend.top_offers(F.col("p"), LABELS, 3).alias("offers"))
    return recommend.explode_offers(decoded, "offers", "vec_id")


@query(
    "threshold_offer",
    "SELECT vec_id, 'term_deposit' AS offer, CAST(embedding[1] AS DOUBLE) AS score FROM embeddings "
    "WHERE CAST(embedding[1] AS DOUBLE) > 0.1 UNION ALL SELECT vec_id, NULL, NULL FROM embeddings "
    "WHERE NOT CAST(embedding[1] AS DOUBLE) > 0.1",
)
def threshold_offer(spark, sf_dir):
    offers = recommend.threshold_offer(F.get("p", F.lit(0)), "term_deposit", 0.1)
    return scores(spark, sf_dir).select("vec_id", F.explode_outer(offers).alias("offer", "score"))


_CHURN = (
    "CAST(CASE WHEN amt_below >= 4 AND cnt_below >= 4 AND amt_skew > 0 AND cnt_skew > 0 THEN 0.8 "
    "WHEN (amt_below > 4 AND amt_skew > 0) OR (cnt_below > 4 AND cnt_skew > 0) THEN 0.5 ELSE 0.3 END AS DOUBLE)"
)


@query(
    "churn_addon_offer",
    _ROW_STATS + f", c AS (SELECT o_custkey, {_CHURN} AS churn FROM s) "
    "SELECT c_custkey, c_mktsegment || ':' || CAST(churn AS VARCHAR) AS offer FROM customer JOIN c ON c_custkey = o_custkey "
    "WHERE churn > 0.4",
)
def churn_addon_offer(spark, sf_dir):
    groups = [[f"{p}_{m}" for m in range(1, MONTHS + 1)] for p in ("amt", "cnt")]
    churn = with_churn_score(monthly_orders(spark, sf_dir), *groups).select(
        F.col("o_custkey").alias("c_custkey"), F.col("transactions_churn_analysis").alias("churn")
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("held_add_on"))
    flags = encode.one_hot(customer, encode.fit_categories(customer, ["held_add_on"]))
    names = [c for c in flags.columns if c.startswith("held_add_on_")]
    offers = recommend.churn_addon_offers(names, F.col("churn"), 0.4)
    return attach(flags, churn, "c_custkey").select("c_custkey", F.explode(offers).alias("offer"))


# --- eligibility --------------------------------------------------------------------------------------------------

# Scored products per line: those of the rule catalogue and one without rules.
LINES = {
    "travel": [*CATALOGUES["travel_insurance"], "luggage cover"],
    "motor": [*CATALOGUES["motor_insurance"], "breakdown help"],
    "medical": [*CATALOGUES["medical_insurance"], "vision"],
}


def insurance_candidates(spark, sf_dir):
    """Customers with rule attributes and the three best products of each line, by score."""
    at, candidates = 1, {}
    scored = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("number"), F.col("embedding").cast("array<double>").alias("p")
    )
    for line, products in LINES.items():
        best = recommend.top_offers(F.slice("p", at, len(products)), products, 3)
        candidates[f"{line}_top3"] = F.transform(best, lambda o: o["label"])
        at += len(products)
    scored = scored.select("number", *[c.alias(n) for n, c in candidates.items()])
    customers = with_age(fx.customers(spark, sf_dir), "dob", AS_OF).select(
        "customer_id", "number", "age", (F.col("income") * 20).alias("income")
    )
    motor = fx.motor_policy(spark, sf_dir).select(
        "customer_id", "policy_annual_premium", years_since(F.col("auto_year"), AS_OF).alias("vehicle_age_yrs")
    )
    travel = fx.travel_policy(spark, sf_dir).select("customer_id", F.lower("agency").alias("agency"))
    medical = fx.medical_policy(spark, sf_dir).select("customer_id", "bmi")
    out = customers.join(scored, "number", "left")
    for policies in (motor, travel, medical):
        out = out.join(policies, "customer_id", "left")
    return out


def _values_sql(catalogue: str) -> str:
    rows = []
    for product, rules in CATALOGUES[catalogue].items():
        for n, (attribute, *bounds) in enumerate(rules):
            if isinstance(bounds[0], list):
                listed = ", ".join(f"'{v}'" for v in bounds[0])
                rows.append(f"('{product}', {n}, '{attribute}', NULL, NULL, [{listed}])")
            else:
                low, high = ("NULL" if b is None else str(b) for b in bounds)
                rows.append(f"('{product}', {n}, '{attribute}', {low}, {high}, NULL)")
    return (
        "SELECT product, rule_no, attribute, CAST(lo AS DOUBLE) AS lo, CAST(hi AS DOUBLE) AS hi, members "
        f"FROM (VALUES {', '.join(rows)}) t(product, rule_no, attribute, lo, hi, members)"
    )


def _line_steps() -> dict[str, str]:
    steps = {
        "attributes": (
            f"SELECT customer_id, number, {age_sql('dob')} AS age, income * 20 AS income, policy_annual_premium, "
            "2002 - auto_year AS vehicle_age_yrs, lower(agency) AS agency, bmi FROM customers "
            "LEFT JOIN motor_policy USING (customer_id) LEFT JOIN travel_policy USING (customer_id) "
            "LEFT JOIN medical_policy USING (customer_id)"
        ),
        "facts": " UNION ALL ".join(
            f"SELECT customer_id, '{a}' AS attribute, {num} AS num, {txt} AS txt FROM attributes"
            for a, num, txt in [
                *[(a, f"CAST({a} AS DOUBLE)", "CAST(NULL AS VARCHAR)")
                  for a in ("age", "income", "policy_annual_premium", "vehicle_age_yrs", "bmi")],
                ("agency", "CAST(NULL AS DOUBLE)", "agency"),
            ]
        ),
    }
    at = 1
    for line, products in LINES.items():
        listed = ", ".join(f"({i}, '{p}')" for i, p in enumerate(products))
        steps[f"{line}_candidates"] = (
            f"SELECT customer_id, product, r FROM (SELECT customer_id, product, row_number() OVER (PARTITION BY customer_id "
            f"ORDER BY CAST(embedding[{at} + i] AS DOUBLE) DESC, i) AS r FROM attributes JOIN embeddings ON number = vec_id, "
            f"(VALUES {listed}) t(i, product)) WHERE r <= 3"
        )
        at += len(products)
        steps[f"{line}_rules"] = _values_sql(f"{line}_insurance")
        steps[f"{line}_passed"] = (
            f"SELECT c.customer_id, c.product, c.r FROM {line}_candidates c LEFT JOIN {line}_rules u ON c.product = u.product "
            "LEFT JOIN facts f ON f.customer_id = c.customer_id AND f.attribute = u.attribute "
            "GROUP BY c.customer_id, c.product, c.r HAVING bool_and(u.product IS NULL OR CASE WHEN u.members IS NOT NULL "
            "THEN coalesce(list_contains(u.members, f.txt), false) ELSE (u.lo IS NULL OR coalesce(f.num > u.lo, false)) "
            "AND (u.hi IS NULL OR coalesce(f.num < u.hi, false)) END)"
        )
        steps[f"{line}_final"] = f"SELECT customer_id, arg_min(product, r) AS product FROM {line}_passed GROUP BY customer_id"
    return steps


_FIXTURES = "customers motor_policy travel_policy medical_policy"


def _final_sql(lines) -> str:
    columns = ", ".join(f"coalesce({x}_final.product, 'no recommendation') AS {x}_final_reco" for x in lines)
    joins = " ".join(f"LEFT JOIN {x}_final ON {x}_final.customer_id = a.customer_id" for x in lines)
    return with_sql(_FIXTURES, f"SELECT a.customer_id, {columns} FROM attributes a {joins}", **_line_steps())


@query("rule_final_offer", _final_sql(["motor"]))
def rule_final_offer(spark, sf_dir):
    customers = insurance_candidates(spark, sf_dir)
    rules = catalogue_rules(spark, "motor_insurance")
    return eligibility.with_final_offer(customers, "motor_top3", rules, "motor_final_reco").select(
        "customer_id", "motor_final_reco"
    )


@query("rule_final_offer_joined", _final_sql(["travel"]))
def rule_final_offer_joined(spark, sf_dir):
    """The same operator with the rules as a joined table, the way taken for a very large catalogue."""
    customers = insurance_candidates(spark, sf_dir)
    return eligibility.with_final_offer(
        customers, "travel_top3", catalogue_rules(spark, "travel_insurance"), "travel_final_reco", max_compiled_rules=0
    ).select("customer_id", "travel_final_reco")


@query("rule_three_products", _final_sql(LINES))
def rule_three_products(spark, sf_dir):
    catalogues = {f"{x}_final_reco": (f"{x}_top3", catalogue_rules(spark, f"{x}_insurance")) for x in LINES}
    return eligibility.with_final_offers(insurance_candidates(spark, sf_dir), catalogues).select("customer_id", *catalogues)


@query(
    "rule_range",
    "SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS above, CASE WHEN c_acctbal < 5000 THEN 1 ELSE 0 END AS below, "
    "CASE WHEN c_acctbal > 0 AND c_acctbal < 5000 THEN 1 ELSE 0 END AS inside, 1 AS open FROM customer",
)
def rule_range(spark, sf_dir):
    balance = F.col("c_acctbal")
    bounds = {"above": (0.0, None), "below": (None, 5000.0), "inside": (0.0, 5000.0), "open": (None, None)}
    return table(spark, sf_dir, "customer").select(
        "c_custkey", *[eligibility.in_range(balance, *b).cast("int").alias(n) for n, b in bounds.items()]
    )


@query(
    "rule_member",
    "SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 1 ELSE 0 END AS member, 0 AS exact_case "
    "FROM customer",
)
def rule_member(spark, sf_dir):
    values = ["Building", "machinery"]
    segment = F.col("c_mktsegment")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", eligibility.is_member(segment, values).cast("int").alias("member"),
        eligibility.is_member(segment, values, case_sensitive=True).cast("int").alias("exact_case"),
    )


@query(
    "rule_unknown_kind",
    "SELECT c_custkey, 'plain' AS final FROM customer",
)
def rule_unknown_kind(spark, sf_dir):
    """A product with a rule of unknown kind is refused, the next one without rules wins."""
    rules = rule_rows(spark, [("odd", 0, "c_acctbal", "regex", None, None, None)])
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_acctbal", F.array(F.lit("odd"), F.lit("plain")).alias("names")
    )
    return eligibility.with_final_offer(customers, "names", rules, "final").select("c_custkey", "final")


_BRANDS = (
    "SELECT p_brand || ' ' || p_type AS product, avg(p_retailprice) AS price, count(*) AS parts, min(p_size) AS size "
    "FROM part GROUP BY p_brand, p_type"
)
_BRAND_RULES_HELD = (
    "o_totalprice > price * 90 AND (parts % 3 <> 0 OR o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW')) "
    "AND (parts % 2 <> 0 OR o_totalprice > 150000) AND (size > 3 OR year(o_orderdate) % 2 = 0)"
)


@query(
    "rule_paths_agree",
    f"WITH b AS ({_BRANDS}), l AS (SELECT *, row_number() OVER (ORDER BY product) - 1 AS r, count(*) OVER () AS n FROM b), "
    "c AS (SELECT o.*, i, product, price, parts, size FROM orders o, range(0, 3) t(i), l WHERE r = (o_orderkey + i * 7) % n), "
    f"f AS (SELECT o_orderkey, first(product ORDER BY i) AS product FROM c WHERE {_BRAND_RULES_HELD} GROUP BY o_orderkey) "
    "SELECT o.o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey END AS customer_id, "
    "coalesce(f.product, 'no recommendation') AS compiled, coalesce(f.product, 'no recommendation') AS joined "
    "FROM orders o LEFT JOIN f USING (o_orderkey)",
)
def rule_paths_agree(spark, sf_dir):
    """Both ways to apply one catalogue, over repeated and missing keys and number, text, boolean and date attributes. It has
    up to six rules for every brand and type, an open range of a date among them, which always holds."""
    brands = table(spark, sf_dir, "part").groupBy(F.concat_ws(" ", "p_brand", "p_type").alias("product")).agg(
        F.avg("p_retailprice").alias("price"), F.count("*").alias("parts"), F.min("p_size").alias("size")
    )
    open_, none = F.lit(None).cast("double"), F.lit(None).cast("array<string>")

    def texts(*values):
        return F.array(*[F.lit(v) for v in values])

    def rule(number, attribute, kind, low=open_, values=none, where=True):
        parts = {"rule_no": F.lit(number), "attribute": F.lit(attribute), "kind": F.lit(kind), "min": low, "max": open_, "values": values}
        return F.when(F.lit(where) if where is True else where, F.struct(*[v.alias(n) for n, v in parts.items()]))

    listed = F.array_compact(F.array(
        rule(0, "o_totalprice", "int", F.col("price") * 90),
        rule(1, "o_orderpriority", "list", values=texts("1-URGENT", "2-high", "5-Low"), where=F.col("parts") % 3 == 0),
        rule(2, "is_large", "list", values=texts("true"), where=F.col("parts") % 2 == 0),
        rule(3, "year_begin", "list", values=texts(*[f"{y}-01-01" for y in range(1990, 2030, 2)]), where=F.col("size") <= 3),
        rule(4, "year_begin", "non-list"),
        rule(5, "o_totalprice", "non-list", F.lit(0.0)),
    ))
    rules = written(brands.select("product", F.explode(listed).alias("r")).select("product", "r.*"))
    numbered = brands.select("product", (F.row_number().over(Window.orderBy("product")) - 1).alias("r"))
    count = numbered.count()
    orders = table(spark, sf_dir, "orders")
    places = F.array(*[((F.col("o_orderkey") + 7 * i) % count).cast("int") for i in range(3)])
    names = orders.select("o_orderkey", F.posexplode(places).alias("i", "r")).join(numbered, "r").groupBy("o_orderkey").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("i", "product"))), lambda x: x["product"]).alias("names"))
    customers = orders.select(
        "o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey")).alias("customer_id"), "o_totalprice",
        "o_orderpriority", (F.col("o_totalprice") > 150000).alias("is_large"),
        F.trunc("o_orderdate", "year").alias("year_begin"),
    ).join(names, "o_orderkey")
    compiled = eligibility.with_final_offer(customers, "names", rules, "compiled", max_compiled_rules=10_000)
    both = eligibility.with_final_offer(compiled, "names", rules, "joined", max_compiled_rules=0)
    return both.select("o_orderkey", "customer_id", "compiled", "joined")


@query(
    "rule_file",
    """
SELECT 'brands' AS block, p_brand AS product, 0 AS rule_no, 'income' AS attribute, 'int' AS kind, min(p_size)::DOUBLE - 1 AS "min",
  NULL::DOUBLE AS "max", NULL AS members, NULL AS refused FROM part GROUP BY p_brand
UNION ALL SELECT 'brands', p_brand, 1, 'town', 'list', NULL, NULL, string_agg(DISTINCT p_type, '|' ORDER BY p_type), NULL
FROM part GROUP BY p_brand
UNION ALL SELECT 'nations', n_name, n_regionkey::INTEGER, 'balance', CASE WHEN n_nationkey % 5 = 4 THEN 'regex' ELSE 'non-list' END, 0,
  CASE WHEN n_nationkey % 5 <> 3 THEN n_nationkey END, NULL,
  CASE n_nationkey % 5 WHEN 4 THEN 'unknown kind' WHEN 3 THEN 'bound is no number' END FROM nation
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'not a rule' FROM region""",
)
def rule_file(spark, sf_dir):
    """Two blocks of rules and broken lines written to rule files and read back, each line a rule or the reason why not."""
    none = F.lit(None)
    brands = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("product"))
    sized = brands.agg((F.min("p_size").cast("double") - 1).alias("min")).select(
        "product", F.lit(0).alias("rule_no"), F.lit("income").alias("attribute"), F.lit("int").alias("kind"), "min",
        none.cast("double").alias("max"), none.cast("array<string>").alias("values"))
    packed = brands.agg(F.array_sort(F.collect_set("p_type")).alias("values")).select(
        "product", F.lit(1).alias("rule_no"), F.lit("town").alias("attribute"), F.lit("list").alias("kind"),
        none.cast("double").alias("min"), none.cast("double").alias("max"), "values")
    lines = rule_lines(sized.unionByName(packed), "brands")
    # as people write them: open bounds as false, numbers bare
    case = F.col("n_nationkey") % 5
    nations = table(spark, sf_dir, "nation").select(F.format_string(
        '{"block": "nations", "product": "%s", "rule_no": %d, "attribute": "balance", "type": "%s", "required_values": {"min": 0, "max": %s}}',
        "n_name", "n_regionkey", F.when(case == 4, "regex").otherwise("non-list"),
        F.when(case == 3, '"many"').otherwise(F.col("n_nationkey").cast("string"))).alias("value"))
    broken = table(spark, sf_dir, "region").select(F.concat(F.lit('{"block": "brands", "product": '), "r_regionkey").alias("value"))
    path = scratch_path(spark, "rules")
    lines.unionByName(nations).unionByName(broken).write.text(path)
    return read_rule_file(spark, path).withColumn("members", F.array_join("values", "|")).drop("values")


_JOBS = ("Lawyer", "Doctor", "Business", "Engineer")


def professionals(spark, sf_dir):
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", fx.pick(key, _JOBS).alias("occupation"), (F.col("c_acctbal") * 60).alias("income"),
        fx.pick(key, ("yes", "Yes", "no")).alias("self_employed"), (key % 12).alias("years_of_experience"),
        (key % 9).alias("number_of_private_firms"), (key % 6).alias("number_of_private_clinics"),
        (F.col("c_nationkey") / 25.0).alias("score"),
    )


@query(
    "occupation_rules",
    "SELECT c_custkey, occupation, CASE occupation "
    "WHEN 'Lawyer' THEN CASE WHEN income < 500000 AND own AND years > 5 AND firms > 6 AND score > 0.6 AND score < 0.8 THEN 1 ELSE 0 END "
    "WHEN 'Doctor' THEN CASE WHEN income < 700000 AND own AND years > 5 AND clinics > 3 AND score > 0.5 AND score < 0.7 THEN 1 ELSE 0 END "
    "WHEN 'Business' THEN CASE WHEN income < 500000 AND own AND years > 5 AND score > 0.7 AND score < 0.9 THEN 1 ELSE 0 END "
    "ELSE CASE WHEN income < 300000 AND years > 5 AND score > 0.3 AND score < 0.5 THEN 1 ELSE 0 END END AS eligible FROM "
    "(SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'Lawyer' WHEN 1 THEN 'Doctor' WHEN 2 THEN 'Business' ELSE 'Engineer' END AS occupation, "
    "c_acctbal * 60 AS income, c_custkey % 3 < 2 AS own, c_custkey % 12 AS years, c_custkey % 9 AS firms, c_custkey % 6 AS clinics, "
    "c_nationkey / CAST(25 AS DOUBLE) AS score FROM customer)",
)
def occupation_rules(spark, sf_dir):
    rules = catalogue_rules(spark, "occupation")
    return eligibility.occupation_eligible(professionals(spark, sf_dir), "occupation", rules).select(
        "c_custkey", "occupation", "eligible"
    )


# --- combination --------------------------------------------------------------------------------------------------


@query(
    "combine_recommendations",
    with_sql(
        _FIXTURES,
        "SELECT s.customer_id, t.product AS travel_best, m.product AS motor_best, CASE WHEN c.customer_id IS NOT NULL THEN a.agency END AS agency, c.occupation "
        "FROM (SELECT customer_id FROM travel_policy UNION SELECT customer_id FROM motor_policy) s "
        "LEFT JOIN (SELECT customer_id, agency AS product FROM travel_policy) t ON t.customer_id = s.customer_id "
        "LEFT JOIN (SELECT customer_id, auto_make AS product FROM motor_policy) m ON m.customer_id = s.customer_id "
        "LEFT JOIN travel_policy a ON a.customer_id = s.customer_id LEFT JOIN customers c ON c.customer_id = s.customer_id",
    ),
)
def combine_recommendations(spark, sf_dir):
    travel = fx.travel_policy(spark, sf_dir).select("customer_id", F.col("agency").alias("travel_best"))
    motor = fx.motor_policy(spark, sf_dir).select("customer_id", F.col("auto_make").alias("motor_best"))
    snapshot = fx.customers(spark, sf_dir).select("customer_id", "occupation").join(
        fx.travel_policy(spark, sf_dir).select("customer_id", "agency"), "customer_id", "left"
    )
    return recommend.combine_offers({"travel": travel, "motor": motor}, snapshot)


@query(
    "attach_to_snapshot",
    f"SELECT c_custkey, c_mktsegment, CAST(r AS INTEGER) AS rank, 'class_' || i AS label, s AS score FROM ({_RANKED}) "
    "JOIN customer ON c_custkey = vec_id WHERE r <= 3",
)
def attach_to_snapshot(spark, sf_dir):
    scored = scores(spark, sf_dir).select(
        F.col("vec_id").alias("c_custkey"), recommend.top_offers(F.col("p"), LABELS, 3).alias("top3")
    )
    snapshot = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    attached = recommend.attach_offers(snapshot, scored, "c_custkey")
    return recommend.explode_offers(attached, "top3", "c_custkey", "c_mktsegment")


@query(
    "accuracy",
    f"SELECT round(avg(CASE WHEN i % 10 = label THEN 1 ELSE 0 END), 4) * 100 AS accuracy FROM ({_RANKED}) WHERE r = 1",
)
def accuracy(spark, sf_dir):
    predicted = scores(spark, sf_dir).select("label", (recommend.top_index(F.col("p")) % 10).alias("predicted"))
    return model.accuracy(predicted, "label", "predicted")
