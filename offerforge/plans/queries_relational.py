"""Registered queries: consolidation, joins, de-duplication, encodings, imputation, split."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerforge.functions.names import string_columns
from offerforge.operators import encode, impute, model, tables as ops
from offerforge.plans import fixtures as fx
from offerforge.plans.fixtures import with_sql
from offerforge.plans.jobs import CARD_ATTRIBUTES, consolidate_card
from offerforge.plans.registry import query, table

# --- consolidation and joins --------------------------------------------------------------------------------------


def consolidation_steps() -> dict[str, str]:
    """SQL steps from ``card_transactions`` to ``consolidated``."""
    steps = {
        "tx": "SELECT customer_id, lower(card_type) AS card_type, lower(occupation) AS occupation, lower(dob) AS dob, income, "
        "lower(customer_to_bank) AS customer_to_bank, lower(city) AS city, lower(marital_status) AS marital_status, exp_type, "
        "amount FROM card_transactions"
    }
    modes = []
    for a in CARD_ATTRIBUTES:
        steps[f"m_{a}"] = (
            f"SELECT customer_id AS id_{a}, {a} FROM (SELECT customer_id, {a}, row_number() OVER (PARTITION BY customer_id "
            f"ORDER BY count(*) DESC, {a}) AS r FROM tx WHERE {a} IS NOT NULL GROUP BY customer_id, {a}) WHERE r = 1"
        )
        modes.append(f"LEFT JOIN m_{a} ON customer_id = id_{a}")
    groups = {"travel": "'travel'", "fuel": "'fuel'", "entertainment": "'entertainment'", "food": "'food', 'grocery'", "bill": "'bills'"}
    sums = ", ".join(
        f"coalesce(sum(amount) FILTER (exp_type IN ({c})), 0) AS {p}_amt, count(amount) FILTER (exp_type IN ({c})) AS {p}_trans"
        for p, c in groups.items()
    )
    steps["totals"] = (
        f"SELECT customer_id, {sums}, coalesce(sum(amount), 0) AS total_amt, count(amount) AS total_trans FROM tx GROUP BY customer_id"
    )
    steps["consolidated"] = (
        f"SELECT customer_id, {', '.join(CARD_ATTRIBUTES)}, "
        + ", ".join(f"round({p}_amt, 2) AS {p}_amt, {p}_trans" for p in [*groups, "total"])
        + " FROM totals " + " ".join(modes)
    )
    return steps


def rounded_amounts(df):
    return df.withColumns({c: F.round(c, 2) for c in df.columns if c.endswith("_amt")})


@query(
    "consolidate_customer",
    with_sql("card_transactions", "SELECT * FROM consolidated", **consolidation_steps()),
)
def consolidate_customer(spark, sf_dir):
    return rounded_amounts(consolidate_card(fx.card_transactions(spark, sf_dir)))


@query(
    "consolidate_wide_numbers",
    "WITH t AS (SELECT o_custkey AS customer_id, 9007199254740993 + o_orderkey % 3 AS account, "
    "CAST(o_orderkey % 4 AS DECIMAL(30, 12)) + CAST(1000000000000000.000000000001 AS DECIMAL(30, 12)) AS share FROM orders), "
    "a AS (SELECT customer_id, account, row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, account) AS r FROM t GROUP BY customer_id, account), "
    "s AS (SELECT customer_id, share, row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, share) AS r FROM t GROUP BY customer_id, share) "
    "SELECT a.customer_id, account, CAST(share AS VARCHAR) AS share, n AS total_trans FROM a JOIN s ON a.customer_id = s.customer_id "
    "JOIN (SELECT customer_id, count(*) AS n FROM t GROUP BY customer_id) c ON a.customer_id = c.customer_id WHERE a.r = 1 AND s.r = 1",
)
def consolidate_wide_numbers(spark, sf_dir):
    """Modes of whole numbers and decimals with more digits than a double holds."""
    key = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_id"), (F.lit(9007199254740993) + key % 3).alias("account"),
        ((key % 4).cast("decimal(30,12)") + F.lit("1000000000000000.000000000001").cast("decimal(30,12)")).cast("decimal(30,12)").alias("share"),
        "o_orderstatus", "o_totalprice",
    )
    found = ops.consolidate_transactions(orders, "customer_id", ["account", "share"], "o_orderstatus", "o_totalprice", {})
    return found.select("customer_id", "account", F.col("share").cast("string").alias("share"), "total_trans")


_AGGREGATES = {
    "order_sums": "SELECT o_custkey + 40 AS customer_id, count(*) AS n_rows, round(sum(o_totalprice), 2) AS amount FROM orders "
    "GROUP BY o_custkey",
    "event_sums": "SELECT user_id AS customer_id, count(*) AS n_rows, round(sum(\"value\"), 2) AS event_value FROM events GROUP BY user_id",
    "profiles": "SELECT c_custkey * 2 AS customer_id, c_mktsegment, c_acctbal FROM customer",
}


def _aggregates(spark, sf_dir):
    """Order and event sums and profiles of all customers, their keys shifted so that each table lacks some."""
    orders = table(spark, sf_dir, "orders").groupBy((F.col("o_custkey") + 40).alias("customer_id")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("o_totalprice"), 2).alias("amount")
    )
    events = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("customer_id")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("value"), 2).alias("event_value")
    )
    profiles = table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") * 2).alias("customer_id"), "c_mktsegment", "c_acctbal"
    )
    return {"orders": orders, "events": events, "profiles": profiles}


@query(
    "outer_master",
    with_sql(
        "",
        "SELECT customer_id, o.n_rows AS orders_n_rows, amount, e.n_rows AS events_n_rows, event_value, c_mktsegment, c_acctbal "
        "FROM order_sums o FULL JOIN event_sums e USING (customer_id) FULL JOIN profiles p USING (customer_id)",
        **_AGGREGATES,
    ),
)
def outer_master(spark, sf_dir):
    return ops.outer_master(_aggregates(spark, sf_dir))


@query(
    "bucketed_master",
    with_sql(
        "",
        "SELECT customer_id, o.n_rows AS orders_n_rows, amount, e.n_rows AS events_n_rows, event_value, c_mktsegment, c_acctbal "
        "FROM order_sums o FULL JOIN event_sums e USING (customer_id) FULL JOIN profiles p USING (customer_id)",
        **_AGGREGATES,
    ),
)
def bucketed_master(spark, sf_dir):
    """The same from tables written in buckets of the key, none of which is shuffled again."""
    tables = {n: ops.bucketed(df, n, "customer_id", 16) for n, df in _aggregates(spark, sf_dir).items()}
    return ops.outer_master(tables, buckets=16)


@query(
    "bucketed_attach",
    with_sql("", "SELECT customer_id, c_mktsegment, c_acctbal, n_rows, amount FROM profiles JOIN order_sums USING (customer_id)", **_AGGREGATES),
)
def bucketed_attach(spark, sf_dir):
    """Results attached to a snapshot, both in buckets of the key."""
    parts = _aggregates(spark, sf_dir)
    return ops.attach(*(ops.bucketed(parts[n], n, "customer_id", 16) for n in ("profiles", "orders")))


@query(
    "inner_fanout",
    with_sql(
        "",
        "SELECT 'orders' AS source, customer_id, c_acctbal, n_rows FROM profiles JOIN order_sums USING (customer_id) "
        "UNION ALL SELECT 'events', customer_id, c_acctbal, n_rows FROM profiles JOIN event_sums USING (customer_id)",
        **_AGGREGATES,
    ),
)
def inner_fanout(spark, sf_dir):
    parts = _aggregates(spark, sf_dir)
    joined = ops.inner_fanout(parts["profiles"], {"orders": parts["orders"], "events": parts["events"]})
    out = [df.select(F.lit(n).alias("source"), "customer_id", "c_acctbal", "n_rows") for n, df in joined.items()]
    return out[0].unionByName(out[1])


@query(
    "semi_filter",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT user_id FROM events WHERE event_type = 'purchase')",
)
def semi_filter(spark, sf_dir):
    buyers = table(spark, sf_dir, "events").filter("event_type = 'purchase'").select(F.col("user_id").alias("c_custkey"))
    return ops.keep_known(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), buyers, "c_custkey")


@query(
    "equality_filter",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'",
)
def equality_filter(spark, sf_dir):
    return table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").select("o_orderkey", "o_custkey")


@query(
    "union_test_keys",
    with_sql(
        "",
        "SELECT customer_id FROM order_sums UNION SELECT customer_id FROM event_sums UNION SELECT customer_id FROM profiles",
        **_AGGREGATES,
    ),
)
def union_test_keys(spark, sf_dir):
    return ops.union_keys(list(_aggregates(spark, sf_dir).values()))


@query(
    "keyed_attach",
    with_sql("", "SELECT customer_id, c_mktsegment, event_value FROM profiles JOIN event_sums USING (customer_id)", **_AGGREGATES),
)
def keyed_attach(spark, sf_dir):
    parts = _aggregates(spark, sf_dir)
    return ops.attach(parts["profiles"].select("customer_id", "c_mktsegment"), parts["events"].drop("n_rows"))


@query("distinct_values", "SELECT DISTINCT p_brand FROM part")
def distinct_values(spark, sf_dir):
    return ops.distinct_values(table(spark, sf_dir, "part"), "p_brand")


@query(
    "hot_key_lookup",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, n AS flag_rows FROM lineitem JOIN "
    "(SELECT l_returnflag AS f, count(*) AS n FROM lineitem GROUP BY l_returnflag) ON l_returnflag = f",
)
def hot_key_lookup(spark, sf_dir):
    """A lookup over the broadcast bound on a key with three values, each of a third of the rows."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    flags = lines.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("flag_rows"))
    return ops.lookup_join(lines, flags, ["l_returnflag"], max_rows=0)


@query(
    "missing_key_lookup",
    "WITH k AS (SELECT l_orderkey, l_linenumber, CASE WHEN (l_orderkey + l_linenumber) % 10 = 0 THEN l_suppkey END AS l_suppkey "
    "FROM lineitem) SELECT l_orderkey, l_linenumber, k.l_suppkey, s_name, s_acctbal FROM k LEFT JOIN supplier ON k.l_suppkey = s_suppkey",
)
def missing_key_lookup(spark, sf_dir):
    """A lookup over the broadcast bound where nine tenths of the rows have no key."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when((F.col("l_orderkey") + F.col("l_linenumber")) % 10 == 0, F.col("l_suppkey")).alias("l_suppkey")
    )
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name", "s_acctbal")
    return ops.lookup_join(lines, suppliers, ["l_suppkey"], max_rows=0)


@query(
    "dedup_keep_last",
    "SELECT o_custkey, o_orderkey, o_orderpriority, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey "
    "ORDER BY o_orderkey DESC) AS r FROM orders) WHERE r = 1",
)
def dedup_keep_last(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority", "o_totalprice")
    return ops.keep_last(orders, "o_custkey", ["o_orderkey"])


@query("top_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def top_n(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return ops.top_rows(orders, [F.desc("o_totalprice"), F.asc("o_orderkey")], 25)


@query("ordered_sample", "SELECT p_partkey, p_name FROM part ORDER BY p_partkey DESC LIMIT 5")
def ordered_sample(spark, sf_dir):
    return ops.top_rows(table(spark, sf_dir, "part").select("p_partkey", "p_name"), [F.desc("p_partkey")], 5)


# --- encodings ----------------------------------------------------------------------------------------------------


@query(
    "rare_to_others",
    "SELECT doc_id, CASE WHEN share > 0.1 THEN tag ELSE 'others' END AS tag FROM (SELECT doc_id, tag, "
    "count(*) OVER (PARTITION BY tag) * CAST(100 AS DOUBLE) / count(*) OVER () AS share FROM "
    "(SELECT doc_id, source || ' ' || lang || ' ' || CAST(n_chars // 500 AS VARCHAR) AS tag FROM documents))",
)
def rare_to_others(spark, sf_dir):
    tag = F.concat_ws(" ", "source", "lang", F.expr("n_chars div 500").cast("string")).alias("tag")
    tagged = table(spark, sf_dir, "documents").select("doc_id", tag)
    return encode.group_rare(tagged, encode.fit_frequent_values(tagged, ["tag"]))


_CODES = (
    "SELECT d.doc_id, n.code AS lang, quality FROM d LEFT JOIN (SELECT lang, row_number() OVER (ORDER BY lang NULLS LAST) - 1 AS code "
    "FROM (SELECT DISTINCT lang FROM d)) n ON d.lang IS NOT DISTINCT FROM n.lang"
)


@query(
    "binary_code",
    "WITH d AS (SELECT d.doc_id, CASE WHEN lang <> 'de' THEN lang END AS lang, quality FROM documents d "
    "LEFT JOIN labels l ON d.doc_id = l.doc_id) " + _CODES,
)
def binary_code(spark, sf_dir):
    from offerforge.plans.queries_features import labelled_documents

    documents = labelled_documents(spark, sf_dir).select("doc_id", "lang", "quality")
    return encode.code_categories(documents, encode.fit_categories(documents, ["lang"]))


@query(
    "code_by_first_appearance",
    "SELECT p_name AS value, row_number() OVER (ORDER BY first_seen, p_name) - 1 AS code FROM "
    "(SELECT p_name, min(p_partkey) AS first_seen FROM part GROUP BY p_name)",
)
def code_by_first_appearance(spark, sf_dir):
    return encode.code_table(table(spark, sf_dir, "part"), "p_name", order_by="p_partkey")


@query(
    "code_many_values",
    "SELECT c_custkey, dense_rank() OVER (ORDER BY c_name) - 1 AS c_name FROM customer",
)
def code_many_values(spark, sf_dir):
    """One code per customer name: numbered in ranges and joined, not kept as literals."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return encode.code_by_table(customer, "c_name", encode.code_table(customer, "c_name", ranges=16))


_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@query(
    "one_hot",
    "SELECT c_custkey, c_acctbal, "
    + ", ".join(f'CASE WHEN c_mktsegment = \'{v}\' THEN 1 ELSE 0 END AS "c_mktsegment_{v}"' for v in _SEGMENTS)
    + " FROM customer",
)
def one_hot(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    return encode.one_hot(customer, encode.fit_categories(customer, ["c_mktsegment"]))


@query(
    "encoder_choice",
    "SELECT o_orderkey, CAST(CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS BIGINT) AS o_orderstatus, big, "
    + ", ".join(
        f'CASE WHEN o_orderpriority = \'{v}\' THEN 1 ELSE 0 END AS "o_orderpriority_{v}"'
        for v in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
    )
    + " FROM (SELECT *, CAST(o_orderkey % 7 AS VARCHAR) AS big FROM orders)",
)
def encoder_choice(spark, sf_dir):
    """Three values are coded, five become columns, seven stay."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", (F.col("o_orderkey") % 7).cast("string").alias("big")
    )
    return encode.fit_encoders(orders, code_at=(3,), spread_at=(5,), columns=string_columns(orders)).transform(orders)


@query(
    "yes_no_target",
    "SELECT d.doc_id, CASE WHEN quality = 1 THEN 1 ELSE 0 END AS answer FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id",
)
def yes_no_target(spark, sf_dir):
    from offerforge.plans.queries_features import labelled_documents

    answer = F.when(F.col("quality") == 1, "yes").when(F.col("quality") == 0, "no")
    return encode.yes_no(labelled_documents(spark, sf_dir).select("doc_id", answer.alias("answer")), "answer")


@query(
    "label_encode",
    "SELECT o_orderkey, dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS o_orderpriority FROM orders",
)
def label_encode(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return encode.encode_labels(orders, "o_orderpriority")


@query(
    "label_dictionary",
    "SELECT row_number() OVER (ORDER BY label) - 1 AS code, label FROM (SELECT DISTINCT p_type AS label FROM part)",
)
def label_dictionary(spark, sf_dir):
    return encode.label_dictionary(table(spark, sf_dir, "part"), "p_type")


# --- imputation ---------------------------------------------------------------------------------------------------


def holed_parts(spark, sf_dir):
    """Parts with part of the sizes, prices and types missing."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(key % 10 != 3, F.col("p_size").cast("double")).alias("size"),
        F.when(key % 7 != 2, F.col("p_retailprice")).alias("price"),
        (F.length("p_name") + key % 13).cast("double").alias("name_length"),
        F.when(key % 9 != 4, F.col("p_type")).alias("type"),
    )


_HOLED = (
    "SELECT p_partkey, CASE WHEN p_partkey % 10 != 3 THEN CAST(p_size AS DOUBLE) END AS size, "
    "CASE WHEN p_partkey % 7 != 2 THEN p_retailprice END AS price, CAST(length(p_name) + p_partkey % 13 AS DOUBLE) AS name_length, "
    "CASE WHEN p_partkey % 9 != 4 THEN p_type END AS type FROM part"
)
_KNN_SQL = (
    "WITH parts AS ({holed}), pairs AS (SELECT q.p_partkey AS k, d.p_partkey AS donor, d.size AS v, "
    "(coalesce((q.price - d.price) * (q.price - d.price), 0) + (q.name_length - d.name_length) * (q.name_length - d.name_length)) "
    "* (3.0 / (CASE WHEN q.price IS NULL OR d.price IS NULL THEN 1 ELSE 2 END)) AS dist FROM parts q, parts d "
    "WHERE q.size IS NULL AND d.size IS NOT NULL), "
    "near AS (SELECT k, v FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY dist, donor) AS r FROM pairs) WHERE r <= 2) "
    "SELECT p_partkey, coalesce(size, m) AS size FROM parts LEFT JOIN (SELECT k, avg(v) AS m FROM near GROUP BY k) ON p_partkey = k"
)


@query("knn_impute_numeric", _KNN_SQL.format(holed=_HOLED))
def knn_impute_numeric(spark, sf_dir):
    """Sizes from the two nearest parts by price, where both have one, and length of name."""
    filled = impute.impute_numeric(
        holed_parts(spark, sf_dir), "size", ["price", "name_length"], "p_partkey", donors_per_cell=100
    )
    return filled.select("p_partkey", "size")


_VOTE_SQL = (
    "WITH parts AS ({holed}), pairs AS (SELECT q.p_partkey AS k, d.p_partkey AS donor, d.type AS v, "
    "(q.p - d.p) * (q.p - d.p) + (q.name_length - d.name_length) * (q.name_length - d.name_length) AS dist "
    "FROM (SELECT *, coalesce(price, 0) AS p FROM parts) q, (SELECT *, coalesce(price, 0) AS p FROM parts) d "
    "WHERE q.type IS NULL AND d.type IS NOT NULL), "
    "near AS (SELECT k, v FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY dist, donor) AS r FROM pairs) WHERE r <= 7), "
    "votes AS (SELECT k, v, row_number() OVER (PARTITION BY k ORDER BY count(*) DESC, v) AS r FROM near GROUP BY k, v) "
    "SELECT p_partkey, coalesce(type, v) AS type FROM parts LEFT JOIN votes ON p_partkey = k AND r = 1"
)


@query("knn_impute_category", _VOTE_SQL.format(holed=_HOLED))
def knn_impute_category(spark, sf_dir):
    """Types by majority of the seven nearest parts."""
    parts = holed_parts(spark, sf_dir).withColumn("price", F.coalesce("price", F.lit(0.0)))
    filled = impute.impute_category(parts, "type", ["price", "name_length"], "p_partkey", donors_per_cell=100)
    return filled.select("p_partkey", "type")


def _step_sql(column: str, table_name: str, features: tuple[str, ...], scale: str, k: int) -> str:
    """Key and ranked donors of the rows of a step's table that miss a column, over features some may lack."""
    square = " + ".join(f"coalesce((q.{f} - d.{f}) * (q.{f} - d.{f}), 0)" for f in features)
    return (
        f"SELECT k, v FROM (SELECT q.p_partkey AS k, d.{column} AS v, row_number() OVER (PARTITION BY q.p_partkey ORDER BY ({square}) "
        f"* {scale}, d.p_partkey) AS r FROM {table_name} q, {table_name} d WHERE q.{column} IS NULL AND d.{column} IS NOT NULL) WHERE r <= {k}"
    )


_ALL_SQL = (
    f"WITH parts AS ({_HOLED}), n1 AS ("
    + _step_sql("size", "parts", ("price", "name_length"), "(3.0 / (CASE WHEN q.price IS NULL OR d.price IS NULL THEN 1 ELSE 2 END))", 2)
    + "), t1 AS (SELECT p.* REPLACE (coalesce(size, m) AS size) FROM parts p LEFT JOIN (SELECT k, avg(v) AS m FROM n1 GROUP BY k) ON p_partkey = k), n2 AS ("
    + _step_sql("price", "t1", ("size", "name_length"), "1", 2)
    + "), t2 AS (SELECT p.* REPLACE (coalesce(price, m) AS price) FROM t1 p LEFT JOIN (SELECT k, avg(v) AS m FROM n2 GROUP BY k) ON p_partkey = k), n3 AS ("
    + _step_sql("type", "t2", ("size", "price", "name_length"), "1", 7)
    + "), votes AS (SELECT k, v, row_number() OVER (PARTITION BY k ORDER BY count(*) DESC, v) AS r FROM n3 GROUP BY k, v) "
    "SELECT p_partkey, round(size, 6) AS size, round(price, 6) AS price, name_length, coalesce(type, v) AS type FROM t2 "
    "LEFT JOIN votes ON p_partkey = k AND r = 1"
)


@query("impute_all_columns", _ALL_SQL)
def impute_all_columns(spark, sf_dir):
    """Numbers from correlated columns, then types from the features of varying importance."""
    filled = impute.impute_missing(holed_parts(spark, sf_dir), "p_partkey")
    return filled.withColumns({c: F.round(c, 6) for c in ("size", "price")})


# --- split --------------------------------------------------------------------------------------------------------


@query(
    "key_split",
    "SELECT c_custkey, CASE WHEN CAST('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 20 "
    "THEN 'test' ELSE 'train' END AS part FROM customer",
)
def key_split(spark, sf_dir):
    train, test = model.key_split(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
