"""Registered queries on the inside of the models: sums and splits of boosted trees, each proved by SQL."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from offerforge.operators import boost, impute
from offerforge.plans.registry import query, table

STATUSES = ("F", "O", "P")
STEP = 0.3

_STATUS_SQL = " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(STATUSES))
_UNITS = f"{boost.UNITS}::DOUBLE"


def status_orders(spark, sf_dir):
    """Orders by month and first digit of the priority, which every seventh order lacks, with the place of their status."""
    digit = F.substring("o_orderpriority", 1, 1).cast("int")
    place = F.array_position(F.array(*[F.lit(s) for s in STATUSES]), F.col("o_orderstatus"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.month("o_orderdate").alias("month"), F.when(F.col("o_orderkey") % 7 != 0, digit).alias("digit"),
        F.when(place > 0, place - 1).alias("place"))


def _round_sql(n: int) -> str:
    """Steps of one round of stumps on ``margin<n>``: probabilities, sums by class, feature and bin, best split, margins."""
    gain = "pow({0}g / {1}, 2) / ({0}h / {1} + {2})"
    left, right, whole = (gain.format(s, _UNITS, boost.SMOOTHING) for s in ("l", "r", "s"))
    return f"""
chance{n} AS (
  SELECT o_orderkey, y, class, exp(margin - top) / sum(exp(margin - top)) OVER (PARTITION BY o_orderkey) AS p
  FROM (SELECT *, max(margin) OVER (PARTITION BY o_orderkey) AS top FROM margin{n})),
slope{n} AS (
  SELECT o_orderkey, class, round_even((p - (y = class)::INT) * {_UNITS}, 0)::BIGINT AS g,
    round_even(2 * p * (1 - p) * {_UNITS}, 0)::BIGINT AS h FROM chance{n}),
sums{n} AS (
  SELECT class, feature, bin, sum(g)::BIGINT AS g, sum(h)::BIGINT AS h FROM slope{n} JOIN binned USING (o_orderkey) GROUP BY ALL),
sides{n} AS (
  SELECT *, side * gm + gu AS lg, side * hm + hu AS lh, sg - side * gm - gu AS rg, sh - side * hm - hu AS rh FROM (
    SELECT class, feature, bin, sum(g) OVER w AS sg, sum(h) OVER w AS sh,
      sum(if(bin = 0, g, 0)) OVER w AS gm, sum(if(bin = 0, h, 0)) OVER w AS hm,
      sum(if(bin > 0, g, 0)) OVER (w ORDER BY bin) AS gu, sum(if(bin > 0, h, 0)) OVER (w ORDER BY bin) AS hu
    FROM sums{n} WINDOW w AS (PARTITION BY class, feature)), (VALUES (0), (1)) t(side)),
split{n} AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY class ORDER BY {left} + {right} - {whole} DESC, feature, bin, side DESC) AS place
    FROM sides{n} WHERE least(lh, rh) > 0 AND least(lh, rh) >= {boost.UNITS}) WHERE place = 1),
margin{n + 1} AS (
  SELECT m.o_orderkey, y, m.class, margin - {STEP} * CASE WHEN if(b.bin = 0, side = 1, b.bin <= s.bin)
    THEN lg / {_UNITS} / (lh / {_UNITS} + {boost.SMOOTHING}) ELSE rg / {_UNITS} / (rh / {_UNITS} + {boost.SMOOTHING}) END AS margin
  FROM margin{n} m JOIN split{n} s ON m.class = s.class JOIN binned b ON b.o_orderkey = m.o_orderkey AND b.feature = s.feature)"""


@query(
    "boosted_sums",
    f"""
WITH known AS (
  SELECT o_orderkey, month(o_orderdate) AS month, CASE WHEN o_orderkey % 7 <> 0 THEN left(o_orderpriority, 1)::INT END AS digit,
    CASE o_orderstatus {_STATUS_SQL} END AS y FROM orders),
binned AS (
  SELECT o_orderkey, 0 AS feature, dense_rank() OVER (ORDER BY month) AS bin FROM known WHERE y IS NOT NULL
  UNION ALL SELECT o_orderkey, 1, CASE WHEN digit IS NULL THEN 0 ELSE dense_rank() OVER (ORDER BY digit NULLS LAST) END
  FROM known WHERE y IS NOT NULL),
margin1 AS (SELECT o_orderkey, y, class, 0::DOUBLE AS margin FROM known, (VALUES (0), (1), (2)) t(class) WHERE y IS NOT NULL),
{_round_sql(1)},
{_round_sql(2)},
{_round_sql(3)}
{" UNION ALL ".join(f"SELECT {n} AS round, class, feature, bin::INTEGER AS bin, g, h FROM sums{n}" for n in (1, 2, 3))}""",
)
def boosted_sums(spark, sf_dir):
    """Gradient and hessian sums that three rounds of one-split trees see: each round rests on all before it."""
    orders = status_orders(spark, sf_dir)
    features = ("month", "digit")
    cuts, n = boost.fit_bins(orders, features)
    model = boost.BoostedModel(features, STATUSES, cuts)
    rows, seen = boost.binned_rows(orders, model, F.col("place"), F.col("o_orderkey"), n), []
    roots = tuple(boost.Tree.empty(1) for _ in STATUSES)
    for number in (1, 2, 3):
        sums = boost.gradient_sums(rows, model, roots, 0)
        seen.append(sums.select(F.lit(number).alias("round"), "class", "feature", "bin", "g", "h"))
        model = replace(model, rounds=(*model.rounds, boost.grow(rows, model, 1, STEP, 1.0)))
        rows = boost.advanced(rows, model)
    return seen[0].unionByName(seen[1]).unionByName(seen[2])


_SPREAD_FEATURES = ("month", "digit", "same", "day")


def _level_sql(level: int) -> str:
    """Best cut of each node of a level on ``at<level>`` (a row's node per tree), and the nodes of the next level."""
    bits = "coalesce(sum(-n / t * log2(n / t)), 0)"
    return f"""
cells{level} AS (
  SELECT tree, node, feature, bin, y, count(*)::DOUBLE AS n FROM at{level} JOIN binned USING (o_orderkey) GROUP BY ALL),
cuts{level} AS (SELECT DISTINCT c.tree, c.node, c.feature, c.bin AS cut FROM cells{level} c),
parted{level} AS (
  SELECT u.tree, u.node, u.feature, cut, bin <= cut AS side, y, sum(n) AS n
  FROM cuts{level} u JOIN cells{level} c ON u.tree = c.tree AND u.node = c.node AND u.feature = c.feature GROUP BY ALL),
sided{level} AS (
  SELECT tree, node, feature, cut, side, any_value(t) AS t, {bits} AS e FROM (
    SELECT *, sum(n) OVER (PARTITION BY tree, node, feature, cut, side) AS t FROM parted{level}) GROUP BY tree, node, feature, cut, side),
noded{level} AS (
  SELECT tree, node, any_value(t) AS t, {bits} AS e FROM (
    SELECT tree, node, y, n, sum(n) OVER (PARTITION BY tree, node) AS t FROM (
      SELECT tree, node, y, sum(n) AS n FROM cells{level} WHERE feature = 0 GROUP BY ALL)) GROUP BY tree, node),
gains{level} AS (
  SELECT s.tree, s.node, feature, cut, round(any_value(w.e) - sum(s.t * s.e) / any_value(w.t), 12) AS gain, any_value(w.t) AS t
  FROM sided{level} s JOIN noded{level} w ON s.tree = w.tree AND s.node = w.node WHERE w.e > 0
  GROUP BY s.tree, s.node, feature, cut HAVING count(*) = 2),
best{level} AS (
  SELECT *, row_number() OVER (PARTITION BY tree, node ORDER BY md5(concat_ws(':', '123', tree, node, name)), feature) AS drawn
  FROM (SELECT *, row_number() OVER (PARTITION BY tree, node, feature ORDER BY gain DESC, cut) AS place FROM gains{level})
  JOIN names USING (feature) WHERE place = 1),
taken{level} AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tree, node ORDER BY gain DESC, feature) AS first FROM best{level} WHERE drawn <= 2)
  WHERE first = 1),
at{level + 1} AS (
  SELECT a.tree, o_orderkey, a.y, 2 * a.node + CASE WHEN bin <= cut THEN 1 ELSE 2 END AS node
  FROM at{level} a JOIN taken{level} s ON a.tree = s.tree AND a.node = s.node JOIN binned USING (o_orderkey, feature))"""


@query(
    "importance_spread",
    f"""
WITH known AS (
  SELECT o_orderkey, month(o_orderdate) AS f0, left(o_orderpriority, 1)::INT AS f1, 7 AS f2, day(o_orderdate) AS f3,
    o_orderstatus AS y FROM orders WHERE o_orderstatus IS NOT NULL),
names(feature, name) AS (VALUES {", ".join(f"({i}, '{n}')" for i, n in enumerate(_SPREAD_FEATURES))}),
binned AS (
  {" UNION ALL ".join(f"SELECT o_orderkey, {i} AS feature, f{i} AS bin FROM known" for i in range(len(_SPREAD_FEATURES)))}),
at0 AS (SELECT tree, o_orderkey, y, 0 AS node FROM known, range(0, 5) r(tree)),
{_level_sql(0)}, {_level_sql(1)}, {_level_sql(2)},
less AS (
  SELECT tree, feature, sum(t * gain) AS less FROM (
    SELECT * FROM taken0 UNION ALL SELECT * FROM taken1 UNION ALL SELECT * FROM taken2) GROUP BY tree, feature),
shares AS (
  SELECT tree, feature, name, coalesce(less / sum(less) OVER (PARTITION BY tree), 0) AS share
  FROM (SELECT tree, feature, name, less FROM (SELECT * FROM range(0, 5) r(tree), names) LEFT JOIN less USING (tree, feature)))
SELECT name AS feature, round(stddev_pop(share), 6) AS spread,
  row_number() OVER (ORDER BY round(stddev_pop(share), 6) DESC, feature)::INTEGER AS place
FROM shares GROUP BY feature, name""",
)
def importance_spread(spark, sf_dir):
    """Rank of four features, one constant, by the spread of their importance for the order status over five trees."""
    orders = table(spark, sf_dir, "orders").select(
        F.month("o_orderdate").alias("month"), F.substring("o_orderpriority", 1, 1).cast("int").alias("digit"),
        F.lit(7).alias("same"), F.dayofmonth("o_orderdate").alias("day"), "o_orderstatus")
    found = impute.importance_spread(orders, "o_orderstatus", _SPREAD_FEATURES, depth=3)
    ranked = [(name, round(spread, 6), place + 1) for place, (name, spread) in enumerate(found)]
    return spark.createDataFrame(ranked, "feature string, spread double, place int")
