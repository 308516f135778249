"""Spelling variants: words one edit apart, found by asymmetric chunks, and the frequent form each variant stands for.

Of two words the shorter one (of equal lengths the smaller) gives two disjoint chunks, its head and its tail, each half
as long as the word; the other gives positional grams of that length. One inserted, deleted or replaced code point
leaves the head or the tail whole. The head then stands at the same place in both words, the tail at most one place
further, so grams meet chunks on text, side and length, and each candidate is verified by its edit distance. A chunk
that more than ``MOST_AT_ONCE`` words share would give candidates by the square: its words meet on the rest of the word
with one place blanked or left out instead, which is the same condition and gives no candidate that is not a pair.

Null texts have no words, empty words and empty tables give no rows, repeated rows count as often as they occur. A null
key is written as nothing in front of the colon. Other columns of the documents, of whatever name, take no part.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerforge.operators.tables import lookup_join
from offerforge.session import written

# Fixed values of the contract.
RUN = "[A-Za-z\\u00C0-\\u00FF]+"
TYPO_EVERY = 97
LEAST_LENGTH = 5
LEAST_COUNT = 3
FORM_FACTOR = 2

MOST_AT_ONCE = 256
"""Words of one chunk that are compared by pairs; those of a more common chunk meet on the rest of the word."""

HEAD, TAIL = 0, 1
_BLANK = "\x00"


def word_counts(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    typo_every: int = TYPO_EVERY,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
) -> DataFrame:
    """``word``, ``n``: lower-cased runs of letters with ``least_length`` code points that occur ``least_count`` times.

    One of ``typo_every`` runs, by the checksum of key and run, loses a code point first. Counts are combined before the
    shuffle, so a very common word is no burden.
    """
    lowered = F.translate(F.col(text), string.ascii_uppercase, string.ascii_lowercase)
    runs = docs.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_key"),
        F.explode(F.regexp_extract_all(lowered, F.lit(RUN), F.lit(0))).alias("_run"))
    runs = runs.where(F.length("_run") >= least_length).withColumn(
        "_h", F.crc32(F.concat("_key", F.lit(":"), "_run").cast("binary")))
    at = (F.col("_h") % F.length("_run")).cast("int")
    word = F.when(F.col("_h") % typo_every == 0, _without(F.col("_run"), at)).otherwise(F.col("_run"))
    counts = runs.select(word.alias("word")).where(F.length("word") >= least_length).groupBy("word")
    return counts.agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _without(word: Column, at: Column) -> Column:
    """``word`` without the code point at place ``at`` (from 0)."""
    return F.concat(F.substr(word, F.lit(1), at), F.substr(word, at + 2))


def _blanked(word: Column, at: Column) -> Column:
    return F.concat(F.substr(word, F.lit(1), at), F.lit(_BLANK), F.substr(word, at + 2))


def _part(word: str, side: int, n: Column) -> Column:
    """The first or last ``n`` code points."""
    whole = F.col(word)
    return F.substr(whole, F.lit(1), n) if side == HEAD else F.substr(whole, F.length(whole) - n + 1)


def _rest(word: str, n: Column) -> Column:
    """What head or tail of ``n`` code points leaves of the word."""
    whole = F.col(word)
    return F.when(F.col("side") == HEAD, F.substr(whole, n + 1)).otherwise(F.substr(whole, F.lit(1), F.length(whole) - n))


def _halves(words: DataFrame, word: str, shorter: int) -> DataFrame:
    """Head and tail of each word, as long as half a word of ``shorter`` code points less."""
    n = F.length(word) - shorter
    sides = [F.struct(F.lit(s).alias("side"), _part(word, s, F.floor(n / 2).cast("int")).alias("gram")) for s in (HEAD, TAIL)]
    return words.select(word, n.alias("length"), F.explode(F.array(*sides)).alias("_s")).select(word, "length", "_s.*")


def near_pairs(words: DataFrame, most_at_once: int = MOST_AT_ONCE) -> DataFrame:
    """``a``, ``b``: every pair of distinct words (column ``word``, each once) exactly one edit apart, once."""
    chunks = written(_halves(words.select(F.col("word").alias("a")), "a", 0))
    other = words.select(F.col("word").alias("b"))
    grams = written(_halves(other, "b", 0).unionByName(_halves(other, "b", 1)))
    on = ["length", "side", "gram"]
    common = written(chunks.groupBy(*on).agg(F.count("*").alias("_n")).where(F.col("_n") > most_at_once)
                     .select(*on, F.lit(True).alias("_common")))
    chunks = written(lookup_join(chunks, common, on))
    grams = written(lookup_join(grams, common, on))

    ordered = (F.length("b") > F.col("length")) | (F.col("a") < F.col("b"))
    near = F.levenshtein(F.col("a"), F.col("b"), 1) == 1
    rare = F.col("_common").isNull()
    met = chunks.where(rare).drop("_common").join(grams.where(rare).drop("_common"), on).where(ordered & near)

    # of a common chunk: the rest of both words with one place blanked, or the longer rest with one place left out
    half = F.floor(F.col("length") / 2).cast("int")
    left = chunks.where("_common").withColumn("_rest", _rest("a", half))
    left = left.select("a", *on, F.explode(F.array_append(_each_place(_blanked), F.col("_rest"))).alias("_rest"))
    right = grams.where("_common").withColumn("_rest", _rest("b", half))
    longer = F.length("b") > F.col("length")
    right = right.select("b", *on, F.explode(F.when(longer, F.array_distinct(_each_place(_without))).otherwise(_each_place(_blanked))).alias("_rest"))
    rested = left.join(right, [*on, "_rest"]).where(ordered & near)
    return met.select("a", "b").unionByName(rested.select("a", "b")).distinct()


def _each_place(change) -> Column:
    """``_rest`` changed at each of its places; there is always one, as the tail is at most half the word."""
    rest = F.col("_rest")
    return F.transform(F.sequence(F.lit(0), F.length(rest) - 1), lambda i: change(rest, i))


def forms(words: DataFrame, pairs: DataFrame, factor: int = FORM_FACTOR) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n``: the near word of largest count, the smallest on a tie, if it is
    at least ``factor`` times as frequent."""
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"))
    both = both.unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("near")))
    counted = both.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = counted.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("_best"))
    known = words.select("word", "n").join(best, "word", "left")
    largest = -F.col("_best.less")
    fits = largest >= factor * F.col("n")
    return known.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(fits, F.col("_best.near")).alias("form"), F.when(fits, largest).alias("form_n"))


def roots(formed: DataFrame) -> DataFrame:
    """``word``, ``root`` of the words that have a form: the last of the chain of forms.

    Counts at least double along a chain, so it ends; each round doubles the steps taken, and is written.
    """
    state = written(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        ahead = state.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        state = written(lookup_join(state, ahead, ["root"]).select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")))
        if state.where("_moved").isEmpty():
            return state.drop("_moved")
        state = state.drop("_moved")


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` for every word of the documents."""
    words = written(word_counts(docs, key, text))
    formed = written(forms(words, near_pairs(words)))
    return formed.join(roots(formed), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
