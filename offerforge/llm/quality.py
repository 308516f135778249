"""Quality rules with risk-controlled cutoffs, in DataFrame functions throughout.

Each rule rejects texts whose measure passes a cutoff. Cutoffs are chosen on labelled rows, for each stratum apart, from a
fixed ladder: from the loosest cutoff on, a step is taken if the exact binomial test rejects that the rule would wrongly
reject more than ``risk`` of the stratum's good texts. The ladder is walked in order and stops at the first step that
fails, so no correction for its length is needed; the error level is divided by the number of rules and strata.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerforge.llm.frames import put_back, set_aside
from offerforge.session import is_small, written

LEAST_WORDS = 50
MOST_REPEATED = 50
RISK = 0.02
ERROR = 0.05
SMALL_STRATA = 10_000
#: Bits of a packed number that hold a window's place.
PLACE_BITS = 24


@dataclass(frozen=True)
class Rule:
    """Rejects where ``measure`` (a SQL expression over the base columns) is at least a cutoff of ``ladder``."""

    name: str
    measure: str
    ladder: tuple[float, ...]


#: Loosest cutoff first.
RULES = (
    Rule("symbols", "n_symbols / n_words", (2.0, 1.0, 0.5, 0.3, 0.2, 0.1, 0.05, 0.02)),
    Rule("repeats", "n_repeat_words / n_words", (0.5, 0.4, 0.3, 0.2, 0.15, 0.1)),
    Rule("lines", "n_dup_lines / n_words", (0.5, 0.2, 0.1, 0.05, 0.02, 0.01)),
    Rule("long_words", "word_chars / n_words", (20.0, 15.0, 12.0, 10.0, 9.0, 8.0, 7.5)),
    Rule("short_words", "n_words / word_chars", (1.0, 0.5, 0.4, 0.35, 0.3, 0.28, 0.26)),
)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once for each row, although lambda bodies use it at every step."""
    return F.transform(F.array(value), body)[0]


def _repeated_words(words: Column) -> Column:
    """Words that stand in a window of three which occurs twice or more.

    Windows are hashed, the hash's high bits packed with the place into one number, and the numbers sorted: neighbours with
    equal high bits are candidates, few in most texts. Among them equality is decided by the words themselves. Texts whose
    places do not fit into ``PLACE_BITS`` have their hashes and places sorted side by side, which is slower.
    """
    mask = (1 << PLACE_BITS) - 1

    def hashes(w: Column, of) -> Column:
        return F.array_sort(F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: of(F.xxhash64(w[i], w[i + 1], w[i + 2]), i)))

    def packed(w: Column) -> Column:
        return _let(
            hashes(w, lambda h, i: h.bitwiseAND(F.lit(~mask)).bitwiseOR(i.cast("long"))),
            lambda s: F.transform(
                F.filter(s, lambda x, i: (F.shiftright(x, PLACE_BITS) == F.shiftright(F.get(s, i + 1), PLACE_BITS))
                         | (F.shiftright(x, PLACE_BITS) == F.shiftright(F.get(s, i - 1), PLACE_BITS))),
                lambda x: x.bitwiseAND(F.lit(mask)).cast("int")))

    def beside(w: Column) -> Column:
        return _let(
            hashes(w, lambda h, i: F.struct(h.alias("h"), i.cast("int").alias("i"))),
            lambda s: F.transform(
                F.filter(s, lambda x, i: (x["h"] == F.get(s, i + 1)["h"]) | (x["h"] == F.get(s, i - 1)["h"])), lambda x: x["i"]))

    def of(w: Column) -> Column:
        return _let(
            F.when(F.size(w) <= mask + 1, packed(w)).otherwise(beside(w)),
            lambda some: F.when(F.size(some) == 0, F.lit(0)).otherwise(_let(
                F.array_sort(F.transform(
                    some, lambda i: F.struct(w[i].alias("a"), w[i + 1].alias("b"), w[i + 2].alias("c"), i.alias("i")))),
                lambda found: _let(
                    F.array_sort(F.transform(F.filter(
                        found, lambda x, k: _same(x, F.get(found, k + 1)) | _same(x, F.get(found, k - 1))), lambda x: x["i"])),
                    lambda at: F.aggregate(
                        at, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
                        lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")),
                        lambda a: a["n"])))))

    return F.when(F.size(words) < 4, F.lit(0)).otherwise(_let(words, of))


def _same(x: Column, y: Column) -> Column:
    return F.coalesce((x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"]), F.lit(False))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long) and base_failed of the whole text.

    Words are runs outside ASCII white space; a null text has none. Base columns that ``docs`` has already, in whatever case
    of letters, are replaced.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    kept = [c for c in docs.columns if c.lower() not in
            ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "_base")]
    words = F.filter(F.split(body, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    base = _let(words, lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        (F.size(F.split(body, r"[#*$%&|<>]", -1)) - 1).cast("long").alias("n_symbols"),
        _let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
        _repeated_words(w).cast("long").alias("n_repeat_words")))
    out = docs.withColumn("_base", base).select(*kept, "_base.*")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def _measures(rules: tuple[Rule, ...]) -> Column:
    """Map of every rule's measure for a row with words."""
    return F.map_from_arrays(F.array(*(F.lit(r.name) for r in rules)),
                             F.array(*(F.expr(f"CAST({r.measure} AS DOUBLE)") for r in rules)))


def log_binomial(n: Column, k: Column, p: float) -> Column:
    """log P(X <= k) for X ~ Binomial(n, p): the terms from the first on, each from the one before, summed in logs."""
    odds = F.lit(p / (1 - p))
    start = F.struct((n * F.log(F.lit(1 - p))).alias("term"), (n * F.log(F.lit(1 - p))).alias("sum"))
    # the longest sequence is the risk times the good rows of a stratum: more false rejections never pass
    return F.aggregate(
        F.sequence(F.lit(0).cast("long"), k), start,
        lambda a, i: F.when(i == 0, a).otherwise(_let(
            a["term"] + F.log((n - i + 1) / i * odds),
            lambda t: F.struct(t.alias("term"), (F.greatest(a["sum"], t) + F.log1p(F.exp(-F.abs(a["sum"] - t)))).alias("sum")))),
        lambda a: a["sum"])


def fit_cutoffs(rows: DataFrame, stratum: str, good: str, rules: tuple[Rule, ...] = RULES, risk: float = RISK,
                error: float = ERROR) -> DataFrame:
    """Cutoffs (stratum, rule, cutoff) from labelled, measured rows: ``good`` is true for texts that should stay.

    For every stratum the chance that any chosen rule wrongly rejects more than ``risk / len(rules)`` of good texts is at
    most ``error`` over all strata and rules together, so all rules together reject at most ``risk``. Only texts that pass
    the base rules count. Strata without enough good texts get no cutoff; a null stratum is one of its own.
    """
    each = risk / len(rules)
    part = rows.where(f"{good} AND NOT base_failed").select(F.col(stratum).alias("stratum"), F.explode(_measures(rules)).alias("rule", "value"))
    ladder = F.create_map(*(x for r in rules for x in (F.lit(r.name), F.array(*map(F.lit, r.ladder)))))
    part = part.withColumn("steps", F.size(F.filter(ladder[F.col("rule")], lambda c: F.col("value") >= c)))
    # a row passes a suffix of the ladder: the loosest cutoffs are the largest
    counts = part.groupBy("stratum", "rule", "steps").agg(F.count("*").alias("n"))
    counts = written(counts)
    total = counts.groupBy("stratum", "rule").agg(F.sum("n").alias("n"))
    strata = max(1, counts.select("stratum").distinct().count())
    limit = F.log(F.lit(error / (len(rules) * strata)))
    steps = total.select("stratum", "rule", "n", F.posexplode(ladder[F.col("rule")]).alias("step", "cutoff"))
    wrong = steps.alias("s").join(counts.alias("c"), F.expr("s.stratum <=> c.stratum AND s.rule = c.rule"), "left").groupBy(
        "s.stratum", "s.rule", "s.n", "s.step", "s.cutoff").agg(
        F.sum(F.when(F.size(ladder[F.col("s.rule")]) - F.col("c.steps") <= F.col("s.step"), F.col("c.n")).otherwise(0)).alias("wrong"))
    tested = wrong.withColumn("passes", F.when(
        F.col("wrong") < F.col("n") * each, log_binomial(F.col("n"), F.col("wrong"), each) <= limit).otherwise(F.lit(False)))
    so_far = Window.partitionBy("stratum", "rule").orderBy("step")
    chosen = tested.withColumn("passes", F.min("passes").over(so_far)).where("passes")
    return chosen.groupBy("stratum", "rule").agg(F.min("cutoff").alias("cutoff"))


def judged(rows: DataFrame, cutoffs: DataFrame, stratum: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Measured ``rows`` with ``kept``: false if base_failed or a measure reaches its stratum's cutoff.

    There is one row of cutoffs for each stratum; up to ``SMALL_STRATA`` are broadcast, more are joined.
    """
    wide = written(cutoffs.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("_cutoffs")))
    wide = wide.withColumnRenamed("stratum", "_stratum")
    wide = F.broadcast(wide) if is_small(wide, SMALL_STRATA) else wide
    out = rows.join(wide, F.col(stratum).eqNullSafe(F.col("_stratum")), "left")
    hit = [F.coalesce(F.expr(f"CAST({r.measure} AS DOUBLE)") >= F.col("_cutoffs")[r.name], F.lit(False)) for r in rules]
    bad = hit[0]
    for h in hit[1:]:
        bad = bad | h
    return out.withColumn("kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(~bad)).drop("_stratum", "_cutoffs")


def quality(docs: DataFrame, labels: DataFrame, stratum: str = "lang", good: str = "quality = 1", rules: tuple[Rule, ...] = RULES,
            risk: float = RISK, error: float = ERROR, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: its key, stratum, base columns, base_failed and kept.

    ``labels`` has the key and the column of ``good``; labels that are null and those without a document are no evidence,
    a document labelled twice counts twice. The measures are computed once and written without the texts. Rows with a null
    key are judged but never labelled. No rows, or no labels, give base verdicts alone.
    """
    narrow = docs.select(F.col(key).alias("doc_id"), F.col(stratum).alias("_stratum_"), F.col(text).alias("_text_"))
    rows = written(measured(narrow, "_text_").drop("_text_"))
    marks = labels.select(F.col(key).alias("doc_id"), F.expr(good).alias("_good")).where("doc_id IS NOT NULL AND _good IS NOT NULL")
    cutoffs = fit_cutoffs(rows.join(marks, "doc_id"), "_stratum_", "_good", rules, risk, error)
    return judged(rows, cutoffs, "_stratum_", rules).withColumnRenamed("_stratum_", "stratum")


def filtered(docs: DataFrame, labels: DataFrame, stratum: str = "lang", good: str = "quality = 1", rules: tuple[Rule, ...] = RULES,
             risk: float = RISK, error: float = ERROR, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns. The cutoffs are fitted first, on measures written without the
    texts; the rows are then judged where they are read, so no text is shuffled. A null key is judged and never labelled,
    null and empty texts fail the base rules, repeated rows are judged alike, no rows give none."""
    narrow = docs.select(F.col(key).alias("doc_id"), F.col(stratum).alias("_stratum_"), F.col(text).alias("_text_"))
    marks = labels.select(F.col(key).alias("doc_id"), F.expr(good).alias("_good")).where("doc_id IS NOT NULL AND _good")
    keys = marks.select("doc_id").distinct()
    if is_small(keys):
        narrow = narrow.join(F.broadcast(keys), "doc_id", "left_semi")
    rows = written(measured(narrow, "_text_").drop("_text_"))
    cutoffs = written(fit_cutoffs(rows.join(marks, "doc_id"), "_stratum_", "_good", rules, risk, error))
    own, names = set_aside(docs)
    rows = judged(measured(own, names[text]), cutoffs, names[stratum], rules).where("kept")
    return rows.select(*put_back(names))
