"""Mixing sources to target weights, in DataFrame functions throughout.

The words of each source are added up, the budget is shared among the sources by weight, and a source's repetition rate
is its share over its size. Each document is taken ``floor(rate)`` times and once more with the rate's fraction as
probability. The draw depends on key, text and a seed alone, so reruns and other partitionings agree. Every source
uses, of ``SEEDS`` seeds, the one under which its taken words come nearest its target.

Null texts and texts without words have size 0; they are drawn like others but add nothing. A null source is one source,
the last in order. Rows with equal key and text draw alike, rows that differ in either draw apart. An empty table gives
an empty result, a table without words targets and rates of 0. Added columns replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerforge.llm.frames import put_back, set_aside
from offerforge.operators.encode import code_table
from offerforge.operators.tables import lookup_join
from offerforge.session import written

# Fixed values of the contract.
WORD = "[^\\x20\\x09-\\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_REPEATS = 2

SEEDS = 32


def _draw_base(key: Column, text: Column) -> Column:
    return F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def _draw(base: Column, seed: Column) -> Column:
    """A number from 0 to 1 that depends on the document and the seed."""
    digest = F.md5(F.concat(base, F.lit(":"), seed.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(1 << 32)


def _key_of(source: Column) -> list[Column]:
    """A source as two columns without nulls, to join on."""
    return [source.isNull().alias("_none"), F.coalesce(source, F.lit("")).alias("_source")]


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Key, source (as text), size and draw base of every document, without the texts."""
    return docs.select(
        F.col(key).alias("_key"), *_key_of(F.col(source).cast("string")),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("_size"),
        _draw_base(F.col(key), F.col(text)).alias("_base"))


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST_REPEATS) -> DataFrame:
    """``_none``, ``_source``, ``source_size``, ``target`` of every source.

    Weights repeat along the sources in code-point order. ``share`` of all sizes is divided by weight; a source stops at
    ``most`` times its size, and what it leaves is shared again among the others until none is above. Every round is one
    aggregate over the sources.
    """
    summed = written(sizes.groupBy("_none", "_source").agg(F.sum("_size").alias("source_size")))
    named = summed.withColumn("_name", F.when(~F.col("_none"), F.col("_source")))
    codes = code_table(named, "_name").select(*_key_of(F.col("value")), "code")
    weight = F.get(F.array(*[F.lit(w) for w in weights]), (F.col("code") % len(weights)).cast("int"))
    known = written(summed.join(codes, ["_none", "_source"]).select(
        "_none", "_source", "source_size", weight.cast("long").alias("_w"), (F.col("source_size") * most).alias("_cap")))
    total, all_weights = known.agg(F.sum("source_size"), F.sum("_w")).first()
    budget, level, capped = share * (total or 0), 0.0, -1
    if all_weights:
        level = budget / all_weights
    while True:
        over = F.col("_cap") < F.lit(level) * F.col("_w")
        n, taken, left = known.agg(
            F.count_if(over), F.sum(F.when(over, F.col("_cap"))), F.sum(F.when(~over, F.col("_w")))).first()
        if n == capped or not left:
            break
        capped, level = n, (budget - (taken or 0)) / left
    target = F.when(over, F.col("_cap").cast("double")).otherwise(F.lit(level) * F.col("_w"))
    return known.select("_none", "_source", "source_size", target.alias("target"))


def _parts(rate: Column) -> tuple[Column, Column]:
    whole = F.floor(rate)
    return whole.cast("long"), rate - whole


def rates(sizes: DataFrame, shares: DataFrame, seeds: int = SEEDS) -> DataFrame:
    """``shares`` with the columns ``_whole``, ``_fraction`` and ``_seed`` that decide on every document of a source.

    All seeds are tried on all documents in one aggregate, combined before its shuffle.
    """
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole, fraction = _parts(rate)
    shares = written(shares.withColumns({"_whole": whole, "_fraction": fraction}))
    drawn = lookup_join(sizes, shares, ["_none", "_source"]).withColumn("_seed", F.explode(F.sequence(F.lit(0), F.lit(seeds - 1))))
    extra = F.when(_draw(F.col("_base"), F.col("_seed")) < F.col("_fraction"), F.col("_size")).otherwise(F.lit(0))
    tried = drawn.groupBy("_none", "_source", "_seed").agg(F.sum(extra).alias("_extra"))
    tried = tried.join(shares.select("_none", "_source", "source_size", "target", "_whole"), ["_none", "_source"])
    off = F.abs(F.col("_whole") * F.col("source_size") + F.col("_extra") - F.col("target"))
    best = tried.groupBy("_none", "_source").agg(F.min(F.struct(off.alias("off"), "_seed")).alias("_best"))
    return written(shares.join(best, ["_none", "_source"]).withColumn("_seed", F.col("_best._seed")).drop("_best"))


def _copies() -> Column:
    extra = _draw(F.col("_base"), F.col("_seed")) < F.col("_fraction")
    return (F.col("_whole") + extra.cast("long")).alias("copies")


def plan(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST_REPEATS,
) -> DataFrame:
    """Key, ``size``, ``source_size``, ``target`` and ``copies`` of every document; texts are read once."""
    sizes = written(measured(docs, key, text, source))
    decided = lookup_join(sizes, rates(sizes, targets(sizes, weights, share, most)), ["_none", "_source"])
    return decided.select(F.col("_key").alias(key), F.col("_size").alias("size"), "source_size", "target", _copies())


def mixed(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST_REPEATS,
) -> DataFrame:
    """The documents as often as the mix takes them, with ``copy`` numbered from 0. The texts are not shuffled unless the
    sources are too many to be broadcast."""
    sizes = written(measured(docs, key, text, source))
    decided = rates(sizes, targets(sizes, weights, share, most)).select("_none", "_source", "_whole", "_fraction", "_seed")
    own, names = set_aside(docs)
    base = _draw_base(F.col(names[key]), F.col(names[text])).alias("_base")
    rows = lookup_join(own.select("*", *_key_of(F.col(names[source]).cast("string")), base), decided, ["_none", "_source"])
    rows = rows.withColumn("_n", _copies()).where("_n > 0")
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))).select(*put_back(names, "copy"), "copy")
