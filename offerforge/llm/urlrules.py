"""URL filters from association rules: frequent token combinations of labelled pages' urls that imply a bad label.

Spark's FP-growth mines the combinations with the label as one more item. Rules are pruned by support and confidence, and
where a shorter rule is at least as sure. They match through an inverted index: each rule is filed under its rarest token.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerforge.llm.frames import put_back, set_aside
from offerforge.session import is_small, written

#: Bad pages that a rule needs, a number and no share, so a bad host is found in a table of any size.
LEAST_PAGES = 20
LEAST_CONFIDENCE = 0.8
BAD = "label=block"
SMALL_RULES = 10_000


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or no ``://``."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_verdict(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest (verdict, host, path) that fits, else null.

    A rule fits its host and all its subdomains if the path starts with the rule's. The one with the longest host and path
    together wins.
    """
    out = None
    for verdict, site, start in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == site) | host.endswith("." + site)) & path.startswith(start)
        value = F.struct(F.lit(site + start).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out


def tokens(url: Column) -> Column:
    """Distinct tokens: host, its parent domains' labels, path segments that are not numbers, query keys."""
    site = host(url)
    labels = F.transform(F.split(site, r"\."), lambda x: F.concat(F.lit("label:"), x))
    segments = F.transform(F.filter(F.split(path(url), "/"), lambda x: (x != "") & ~x.rlike(r"^\d+(\.\w+)?$")),
                           lambda x: F.concat(F.lit("path:"), x))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\?([^#]*)", 1)
    keys = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""),
                       lambda x: F.concat(F.lit("key:"), F.split(x, "=")[0]))
    return F.array_distinct(F.filter(F.concat(F.array(F.concat(F.lit("host:"), site)), labels, segments, keys),
                                     lambda x: ~x.isin("host:", "label:")))


def mine(labelled: DataFrame, url: str = "url", bad: str = "bad", least_pages: int = LEAST_PAGES,
         least_confidence: float = LEAST_CONFIDENCE) -> DataFrame:
    """Rules (tokens, anchor, support long, confidence) from rows with a url and a boolean ``bad``.

    A rule's tokens, of any number, stand together with the label in at least ``least_pages`` rows, and at least
    ``least_confidence`` of the rows with them are bad. No rule holds another one that is at least as sure. Rows with a null label count as not labelled. Without labelled rows there are no rules.
    """
    spark = labelled.sparkSession
    rows = written(labelled.where(F.col(bad).isNotNull()).select(
        F.when(F.col(bad), F.array_append(tokens(F.col(url)), BAD)).otherwise(tokens(F.col(url))).alias("items"))
        .where(F.size("items") > 0))
    total = rows.count()
    kinds = "tokens array<string>, anchor string, support long, confidence double"
    if not total:
        return spark.createDataFrame([], kinds)
    least = (least_pages - 0.5) / total  # between two counts, so rounding is no matter
    if least > 1:
        return spark.createDataFrame([], kinds)
    sets = FPGrowth(itemsCol="items", minSupport=least, minConfidence=1.0).fit(rows).freqItemsets
    sets = written(sets.select(F.sort_array("items").alias("items"), "freq"))
    bad_sets = sets.where(F.array_contains("items", BAD)).select(F.array_remove("items", BAD).alias("items"), F.col("freq").alias("n"))
    rules = bad_sets.where(F.size("items") > 0).join(sets, "items").select(
        F.col("items").alias("tokens"), F.col("n").alias("support"), (F.col("n") / F.col("freq")).alias("confidence"))
    rules = written(rules.where(F.col("confidence") >= least_confidence))
    shorter = rules.select(F.col("tokens").alias("part"), F.col("confidence").alias("sure"), F.explode("tokens").alias("token"))
    longer = rules.select("tokens", "confidence", F.explode("tokens").alias("token"))
    needless = longer.join(shorter, "token").where(
        (F.size("part") < F.size("tokens")) & (F.size(F.array_except("part", "tokens")) == 0) & (F.col("sure") >= F.col("confidence")))
    rules = rules.join(needless.select("tokens").distinct(), "tokens", "left_anti")
    single = sets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    rarest = rules.select("tokens", F.explode("tokens").alias("token")).join(single, "token").groupBy("tokens").agg(
        F.min(F.struct("freq", "token"))["token"].alias("anchor"))
    return rules.join(rarest, "tokens").select("tokens", "anchor", "support", "confidence")


def judge(pages: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with ``mined`` (boolean): true where the url has all tokens of a rule.

    Rules are looked up by their anchor for each distinct token set, so pages of one host are judged together before
    anything is shuffled. The rules are broadcast if they are ``SMALL_RULES`` at most, else joined. Null urls have no token
    and match no rule. Repeated rows are judged alike. A column ``mined`` of ``pages`` is replaced.
    """
    rules = written(rules)
    index = F.broadcast(rules) if is_small(rules, SMALL_RULES) else rules
    rows, names = set_aside(pages)
    marked = rows.withColumn("_tokens", F.sort_array(tokens(F.col(names[url]))))
    sets = marked.select("_tokens").distinct()
    hits = sets.select("_tokens", F.explode("_tokens").alias("anchor")).join(index.select("anchor", "tokens"), "anchor")
    hits = hits.where(F.size(F.array_except("tokens", "_tokens")) == 0).select("_tokens").distinct()
    hits = written(hits.withColumn("_hit", F.lit(True)))
    hits = F.broadcast(hits) if is_small(hits, SMALL_RULES) else hits
    out = marked.join(hits, "_tokens", "left")
    return out.select(*put_back(names, "mined"), F.coalesce("_hit", F.lit(False)).alias("mined"))
