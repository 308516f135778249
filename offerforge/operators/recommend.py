"""Offers from scores: decoding, thresholds, the card ladder, churn add-ons, combination."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerforge.functions.rows import argmax_category
from offerforge.operators.tables import keep_known, outer_master, union_keys

# Offers by current card and by whether the two top categories agree, as (card of the offer, which
# top category it is for); then the score of the first and the second offer, and the two lists of category columns.
CARD_LADDER = {
    ("silver", True): [("gold", "spent"), ("platinum", "spent")],
    ("silver", False): [("gold", "spent"), ("gold", "trans")],
    ("gold", True): [("platinum", "spent"), ("signature", "spent")],
    ("gold", False): [("platinum", "spent"), ("platinum", "trans")],
    ("platinum", True): [("platinum", "spent"), ("signature", "spent")],
    ("platinum", False): [("signature", "spent"), ("signature", "trans")],
    ("signature", True): [("signature", "spent")],
    ("signature", False): [("signature", "spent"), ("signature", "trans")],
}
SLOT_SCORES = (0.75, 0.25)
SPENT_COLUMNS = ("travel_amt", "fuel_amt", "entertainment_amt", "food_amt", "bill_amt")
TRANS_COLUMNS = ("travel_trans", "fuel_trans", "entertainment_trans", "food_trans", "bill_trans")

OFFERS = "array<struct<label:string,score:double>>"


def top_index(scores: Column) -> Column:
    """Position, from 0, of the best score; the first one on a tie."""
    return F.array_position(scores, F.array_max(scores)) - 1


def top_offers(scores: Column, labels: Sequence[str], k: int = 3) -> Column:
    """The k best labels with their scores, best first, the lower position first on a tie."""
    ranked = F.array_sort(F.transform(scores, lambda s, i: F.struct((-s).alias("s"), i.alias("i"))))
    names = F.array(*[F.lit(v) for v in labels])
    return F.transform(
        F.slice(ranked, 1, k), lambda e: F.struct(F.get(names, e["i"]).alias("label"), (-e["s"]).alias("score"))
    )


def threshold_offer(score: Column, name: str, threshold: float) -> Column:
    """Map of one offer to its score when that is above the threshold, else an empty map."""
    nothing = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<double>"))
    return F.when(score > threshold, F.create_map(F.lit(name), score.cast("double"))).otherwise(nothing)


def offers_map(offers: Column) -> Column:
    """Label -> score map of an offer array."""
    return F.map_from_entries(offers)


def explode_offers(df: DataFrame, offers: str, *keep: str) -> DataFrame:
    """One row per offer: the kept columns, rank from 1, label, score.

    Rows without offers are left out after the explode: the filter a plain explode would bring along repeats the whole
    offer expression below it.
    """
    exploded = df.select(*keep, F.posexplode_outer(offers).alias("_i", "_o")).filter("_o is not null")
    return exploded.select(
        *keep, (F.col("_i") + 1).alias("rank"), F.col("_o.label").alias("label"), F.col("_o.score").alias("score")
    )


def with_top_categories(
    df: DataFrame, spent: Sequence[str] = SPENT_COLUMNS, trans: Sequence[str] = TRANS_COLUMNS
) -> DataFrame:
    """``max_spent_category`` and ``max_trans_category``."""
    return df.withColumns(
        {"max_spent_category": argmax_category(spent), "max_trans_category": argmax_category(trans)}
    )


def ladder_offers(
    card: Column, spent: Column, trans: Column,
    ladder: Mapping[tuple[str, bool], Sequence[tuple[str, str]]] = CARD_LADDER,
) -> Column:
    """Offer array of the card ladder; a card not on it gets no offer, nor does an unknown category."""
    category = {"spent": spent, "trans": trans}
    same = spent.eqNullSafe(trans)
    out = F.array().cast(OFFERS)
    for (current, agree), steps in ladder.items():
        offers = [
            F.when(
                category[source].isNotNull(),
                F.struct(F.concat(F.lit(f"{tier} "), category[source]).alias("label"), F.lit(s).alias("score")),
            )
            for (tier, source), s in zip(steps, SLOT_SCORES)
        ]
        out = F.when((card == current) & (same == agree), F.array_compact(F.array(*offers))).otherwise(out)
    return out


def churn_addon_offers(flags: Sequence[str], churn: Column, threshold: float, part: int = 3) -> Column:
    """``<name>:<churn score>`` for each flag set to 1 when the churn score is above the threshold.

    The offer name is the given underscore-separated part of the flag column's name.
    """
    offers = [
        F.when(F.col(c) == 1, F.concat(F.lit(c.split("_")[part] + ":"), churn.cast("string"))) for c in flags
    ]
    return F.when(churn > threshold, F.array_compact(F.array(*offers))).otherwise(F.array().cast("array<string>"))


def attach_offers(snapshot: DataFrame, scored: DataFrame, key: str = "customer_id") -> DataFrame:
    """Snapshot rows of the scored customers with the offer columns."""
    return snapshot.join(scored, key, "inner")


def combine_offers(results: Mapping[str, DataFrame], snapshot: DataFrame, key: str = "customer_id") -> DataFrame:
    """Results of several models side by side with the snapshot, for every customer scored by at least one of them."""
    scored = union_keys(list(results.values()), key)
    return keep_known(outer_master({**results, "snapshot": snapshot}, key), scored, key)
