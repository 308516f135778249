"""Eligibility: the first candidate offer whose rules the customer meets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from offerforge.operators.tables import lookup_join
from offerforge.session import written

NO_OFFER = "no recommendation"
RANGE_KINDS = ("int", "non-list")
MEMBER_KIND = "list"
MAX_COMPILED_RULES = 500
"""Rules compiled into the row's expression; a longer catalogue is joined, with the same result."""


def _number(value: Column) -> Column:
    """The value's text as a number; NaN and text that is no number, as of dates and booleans, are missing."""
    return F.nanvl(value.cast("string").try_cast("double"), F.lit(None).cast("double"))


def in_range(value: Column, low: float | None, high: float | None) -> Column:
    """Both bounds strict, None open; an unknown value passes only when both are open."""
    checks = []
    if low is not None:
        checks.append(_number(value) > low)
    if high is not None:
        checks.append(_number(value) < high)
    return F.coalesce(reduce(and_, checks), F.lit(False)) if checks else F.lit(True)


def is_member(value: Column, values: Sequence[str], case_sensitive: bool = False) -> Column:
    text = value.cast("string")
    if not case_sensitive:
        text, values = F.lower(text), [v.lower() for v in values if v is not None]
    return F.coalesce(text.isin(list(values)), F.lit(False))


def rule_met(rule: Row | Mapping, case_sensitive: bool = False) -> Column:
    """One rule on the attribute column of its name; a kind not known is never met."""
    value = F.col(rule["attribute"])
    if rule["kind"] in RANGE_KINDS:
        return in_range(value, rule["min"], rule["max"])
    if rule["kind"] == MEMBER_KIND:
        return is_member(value, rule["values"] or [], case_sensitive)
    return F.lit(False)


def rules_met(rules: Sequence[Row], case_sensitive: bool = False) -> Column:
    """All rules of one product."""
    return reduce(and_, [rule_met(r, case_sensitive) for r in rules], F.lit(True))


def with_final_offer(
    df: DataFrame,
    candidates: str,
    rules: DataFrame,
    name: str,
    case_sensitive: bool = False,
    max_compiled_rules: int = MAX_COMPILED_RULES,
) -> DataFrame:
    """Adds the first candidate that has no rules or meets all of them, else ``no recommendation``.

    ``candidates`` is an array of names in rank order, missing names skipped. A catalogue of usual size becomes one
    expression on the row, without join or shuffle. A larger one becomes an index that is joined. Both compare an attribute's text,
    or the number it spells, so they give the same offers.
    """
    listed = rules.limit(max_compiled_rules + 1).collect()
    if len(listed) > max_compiled_rules:
        return _indexed_final_offer(df, candidates, rules, name, case_sensitive)
    _check_attributes({r.attribute for r in listed}, df)
    products = {}
    for rule in listed:
        products.setdefault(rule["product"], []).append(rule)
    refused = F.array_compact(
        F.array(*[F.when(~rules_met(rs, case_sensitive), p) for p, rs in products.items()]).cast("array<string>")
    )
    first = F.get(F.array_except(F.array_compact(candidates), refused), F.lit(0))
    return df.withColumn(name, F.coalesce(first, F.lit(NO_OFFER)))


def _check_attributes(attributes: set[str], df: DataFrame) -> None:
    if missing := sorted(attributes - set(df.columns)):
        raise ValueError(f"rules need columns the table does not have: {', '.join(missing[:20])}")


def _indexed_final_offer(df: DataFrame, candidates: str, rules: DataFrame, name: str, case_sensitive: bool) -> DataFrame:
    """The same through an index of the rules that counts hits.

    Range rules of a product on one attribute are one interval, membership rules are filed by value. Each candidate of a
    row looks up its product's entries with the row's own values; a product is eligible when as many of its rules are hit
    as it has. No row carries a list of rules, and the work follows the candidates' attributes, not the catalogue. Rules
    with two open bounds always hold and are not counted, rules of an unknown kind never hold. Popular products are dealt
    out by ``lookup_join``. Rows are numbered and written first, so keys may be missing or repeated.
    """
    attributes = sorted(r.attribute for r in rules.select("attribute").distinct().limit(len(df.columns) + 21).collect())
    _check_attributes(set(attributes), df)
    numbered = written(df.withColumn("_row", F.monotonically_increasing_id()))
    is_range = F.col("kind").isin(*RANGE_KINDS)
    counted = rules.filter(~(is_range & F.col("min").isNull() & F.col("max").isNull()))
    needed = written(counted.groupBy("product").agg(F.count(F.lit(1)).alias("_needed")))
    ranges = counted.filter(is_range).groupBy("product", "attribute").agg(
        F.max("min").alias("_low"), F.min("max").alias("_high"), F.count(F.lit(1)).alias("_ranges"))
    shown = F.col("_value") if case_sensitive else F.lower("_value")
    members = counted.filter(F.col("kind") == MEMBER_KIND).select("product", "rule_no", "attribute", F.explode("values").alias("_value"))
    members = members.select("product", "rule_no", "attribute", shown.alias("_value")).filter("_value IS NOT NULL").distinct()
    members = members.groupBy("product", "attribute", "_value").agg(F.count(F.lit(1)).alias("_members"))

    values = F.array(*[F.struct(F.lit(a).alias("attribute"), F.col(a).cast("string").alias("_text")) for a in attributes])
    offered = numbered.select("_row", F.posexplode(F.array_compact(candidates)).alias("_pos", "product"), values.alias("_values"))
    free = lookup_join(offered.drop("_values"), needed, ["product"]).filter("_needed IS NULL").select("_row", "_pos", "product")
    asked = offered.select("_row", "_pos", "product", F.explode("_values").alias("_v")).select("_row", "_pos", "product", "_v.*")
    shown = F.col("_text") if case_sensitive else F.lower("_text")
    asked = asked.filter("_text IS NOT NULL").withColumn("_value", shown)
    found = lookup_join(lookup_join(asked, written(ranges), ["product", "attribute"]), written(members), ["product", "attribute", "_value"])
    number = _number(F.col("_text"))
    inside = F.coalesce((F.col("_low").isNull() | (number > F.col("_low"))) & (F.col("_high").isNull() | (number < F.col("_high"))), F.lit(False))
    hits = F.when(inside, F.coalesce("_ranges", F.lit(0))).otherwise(0) + F.coalesce("_members", F.lit(0))
    hit = found.select("_row", "_pos", "product", hits.alias("_hits")).filter("_hits > 0")
    hit = hit.groupBy("_row", "_pos", "product").agg(F.sum("_hits").alias("_hits"))
    met = lookup_join(hit, needed, ["product"]).filter("_hits = _needed").select("_row", "_pos", "product")
    first = met.unionByName(free).groupBy("_row").agg(F.min(F.struct("_pos", "product")).alias("_first"))
    whole = numbered.join(first, "_row", "left").withColumn(name, F.coalesce("_first.product", F.lit(NO_OFFER)))
    return whole.drop("_row", "_first")


def with_final_offers(
    df: DataFrame, catalogues: Mapping[str, tuple[str, DataFrame]], case_sensitive: bool = False
) -> DataFrame:
    """Several final offers at once: result column -> (candidate column, rule table)."""
    for name, (candidates, rules) in catalogues.items():
        df = with_final_offer(df, candidates, rules, name, case_sensitive)
    return df


def occupation_eligible(
    df: DataFrame, occupation: str, rules: DataFrame, name: str = "eligible"
) -> DataFrame:
    """1 when the customer meets all rules of the own occupation, those of ``others`` where it has none of its own."""
    listed = rules.select(F.lower("product").alias("_own")).distinct().withColumn("_listed", F.lit(True))
    known = lookup_join(df.withColumn("_own", F.lower(F.col(occupation))), listed, ["_own"])
    known = known.withColumn("_names", F.array(F.when(F.col("_listed"), F.col("_own")).otherwise("others")))
    final = with_final_offer(known, "_names", rules, "_final")
    return final.withColumn(name, (F.col("_final") != NO_OFFER).cast("int")).select(*df.columns, name)
