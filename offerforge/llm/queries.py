"""The registered queries of this subpackage, each on whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerforge.llm import (
    chat, decontaminate, licenses, maintext, packing, quality, queries_words, reshard, simhash, tokenstore, urlrules,
)
from offerforge.llm.frames import table
from offerforge.session import scratch_path

# Fixed values of the queries' contracts.
EXTRA_CONVERSATION = -7
EXTRA_TEXT = "\\### Assistant: </turn> ok"
URL_RULES = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
]
OLD_SHARDS, NEW_SHARDS = 12, 16


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, read back from its windows: new turns in order, text under the loss mask."""
    extra = spark.range(2).select(
        F.lit(EXTRA_CONVERSATION).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(EXTRA_TEXT).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    windows = chat.format_windows(rows).select(
        "conv_id", "block", "window", F.length("text").cast("long").alias("chars"),
        chat.read_turns(F.col("text"), F.col("repeated")).alias("turns"),
        chat.loss_text(F.col("text"), F.col("loss_spans")).alias("loss"))
    parts = F.struct("block", "window", "turns", "loss", "chars")
    whole = windows.groupBy("conv_id").agg(F.sort_array(F.collect_list(parts)).alias("parts"))
    turns = F.flatten(F.col("parts.turns"))
    loss = F.array_join("parts.loss", "")
    said = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return whole.select(
        "conv_id", F.size(turns).cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.aggregate("parts.chars", F.lit(0).cast("long"), lambda a, n: a + n).alias("formatted_chars"),
        F.size("parts").cast("long").alias("n_windows"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base columns and verdict of every document."""
    found = quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark passage found in a document."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document."""
    found = simhash.group_near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return maintext.main_text(table(spark, sf_dir, "pages"))


def op6_packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), keep_ids=False)


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url: the list's rule, else mined rules. A page's labels are those under its number; bad is
    low quality or toxic."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    mined = urlrules.judge(pages, urlrules.mine(pages.join(labels, "page_id")))
    host, path = urlrules.host(F.col("url")), urlrules.path(F.col("url"))
    ruled = mined.select("page_id", host.alias("host"), path.alias("path"), "mined",
                         urlrules.rule_verdict(host, path, URL_RULES).alias("ruled"))
    return ruled.select("page_id", "host", "path", F.col("ruled.rule").alias("rule"), F.coalesce(
        F.col("ruled.verdict"), F.when(F.col("mined"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the ids of every document and reads the files back."""
    path = scratch_path(spark, "tokens")
    tokenstore.write_tokens(table(spark, sf_dir, "documents"), path, vocabulary("byte_bpe_50k.json"))
    return tokenstore.token_index(spark, path)


def op9_license_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every licence text in a document."""
    return licenses.license_spans(table(spark, sf_dir, "documents"))


def old_shard() -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(OLD_SHARDS))


def op10_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moves 12 shards by hash to 16 of even size, writes them and reads the rows' places from the files."""
    path = scratch_path(spark, "shards")
    docs = table(spark, sf_dir, "documents")
    reshard.rewrite(reshard.plan(docs, old_shard(), NEW_SHARDS), path)
    return reshard.read_back(spark, path).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_chat_windows, op2_quality_rules, op3_benchmark_leaks, op4_simhash_groups, op5_main_text, op6_packed_sequences,
        op7_url_filter, op8_token_files, op9_license_spans, op10_reshard, pipeline)
} | queries_words.QUERIES

_CHAT_SQL = rf"""
WITH RECURSIVE rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT {EXTRA_CONVERSATION}, 0, 'user', '{EXTRA_TEXT}'
  UNION ALL SELECT {EXTRA_CONVERSATION}, 1, 'assistant', '{EXTRA_TEXT}'),
formed AS (
  SELECT *, '<turn ' || replace(replace(replace(replace(role, '&', '&amp;'), '<turn', '&lt;turn'), '</turn', '&lt;/turn'), '>', '&gt;')
    || '>' || chr(10) || replace(replace(replace(text, '&', '&amp;'), '<turn', '&lt;turn'), '</turn', '&lt;/turn')
    || chr(10) || '</turn>' || chr(10) AS whole,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place FROM rows),
counted AS (
  SELECT *, len(regexp_extract_all(whole, '\p{{L}}{{1,4}}|\p{{N}}|[^\p{{L}}\p{{N}}\s]')) AS n, length(whole) AS chars FROM formed),
led AS (
  SELECT conv_id, n AS extra, chars AS extra_chars FROM counted WHERE place = 1 AND role = '{chat.SYSTEM_ROLE}'),
body AS (
  SELECT c.conv_id, row_number() OVER (PARTITION BY c.conv_id ORDER BY place) AS k, n, chars,
    coalesce(extra, 0) AS extra, coalesce(extra_chars, 0) AS extra_chars
  FROM counted c LEFT JOIN led l ON c.conv_id IS NOT DISTINCT FROM l.conv_id WHERE NOT (place = 1 AND l.extra IS NOT NULL)),
step AS (
  SELECT conv_id, k, n, chars, extra, extra_chars,
    coalesce(lag(n, 1) OVER w, 0) AS n1, coalesce(lag(n, 2) OVER w, 0) AS n2,
    coalesce(lag(chars, 1) OVER w, 0) AS c1, coalesce(lag(chars, 2) OVER w, 0) AS c2
  FROM body WINDOW w AS (PARTITION BY conv_id ORDER BY k)),
walk AS (
  SELECT conv_id, k, 1 AS windows, extra + n AS used, extra_chars + chars AS total FROM step WHERE k = 1
  UNION ALL
  SELECT s.conv_id, s.k,
    CASE WHEN w.used + s.n <= {chat.BUDGET} THEN w.windows ELSE w.windows + 1 END,
    CASE WHEN w.used + s.n <= {chat.BUDGET} THEN w.used + s.n
      WHEN s.k > 2 AND n1 + n2 <= {chat.HISTORY_TOKENS} AND n1 + n2 + s.n + s.extra <= {chat.BUDGET} THEN n1 + n2 + s.n + s.extra
      WHEN n1 <= {chat.HISTORY_TOKENS} AND n1 + s.n + s.extra <= {chat.BUDGET} THEN n1 + s.n + s.extra
      ELSE s.n + s.extra END,
    w.total + s.chars + CASE WHEN w.used + s.n <= {chat.BUDGET} THEN 0
      WHEN s.k > 2 AND n1 + n2 <= {chat.HISTORY_TOKENS} AND n1 + n2 + s.n + s.extra <= {chat.BUDGET} THEN c1 + c2 + s.extra_chars
      WHEN n1 <= {chat.HISTORY_TOKENS} AND n1 + s.n + s.extra <= {chat.BUDGET} THEN c1 + s.extra_chars
      ELSE s.extra_chars END
  FROM walk w JOIN step s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.k = w.k + 1),
ends AS (SELECT conv_id, max(windows) AS windows, max(total) AS total FROM walk GROUP BY conv_id)
SELECT c.conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = '{chat.TARGET_ROLE}'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = '{chat.TARGET_ROLE}'), '')) AS loss_sha256,
  CAST(coalesce(any_value(e.total), any_value(extra_chars)) AS BIGINT) AS formatted_chars,
  CAST(coalesce(any_value(e.windows), 1) AS BIGINT) AS n_windows
FROM counted c LEFT JOIN ends e ON c.conv_id IS NOT DISTINCT FROM e.conv_id
  LEFT JOIN led l ON c.conv_id IS NOT DISTINCT FROM l.conv_id GROUP BY c.conv_id"""

_RULES_SQL = ", ".join(
    f"('{r.name}', {k}, {c})" for r in quality.RULES for k, c in enumerate(r.ladder))
_QUALITY_SQL = rf"""
WITH split_words AS (
  SELECT doc_id, coalesce(text, '') AS text, lang, row_number() OVER () AS row,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
words AS (SELECT row, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM split_words),
windows AS (
  SELECT row, i, a, lead(a, 1) OVER o AS b, lead(a, 2) OVER o AS c FROM words WINDOW o AS (PARTITION BY row ORDER BY i)),
again AS (
  SELECT row, i FROM (SELECT *, count(*) OVER (PARTITION BY row, a, b, c) AS n FROM windows WHERE c IS NOT NULL) WHERE n > 1),
repeated AS (
  SELECT row, count(DISTINCT i + d) AS n FROM again, (VALUES (0), (1), (2)) AS t(d) GROUP BY row),
base AS (
  SELECT doc_id, lang, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM split_words s LEFT JOIN repeated r ON s.row = r.row),
failed AS (
  SELECT *, n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > {quality.MOST_REPEATED} * n_words AS base_failed FROM base),
ladder(rule, step, cutoff) AS (VALUES {_RULES_SQL}),
measures AS (
  {" UNION ALL ".join(f"SELECT doc_id, lang, base_failed, '{r.name}' AS rule, CASE WHEN n_words > 0 THEN CAST({r.measure.replace(' / ', ' / ')} AS DOUBLE) END AS value FROM failed" for r in quality.RULES)}),
good AS (SELECT m.* FROM measures m JOIN labels l ON m.doc_id = l.doc_id WHERE quality = 1 AND NOT base_failed),
tested AS (
  SELECT lang, l.rule, step, cutoff, count(*) AS n, count(*) FILTER (value >= cutoff) AS wrong
  FROM good g JOIN ladder l ON g.rule = l.rule GROUP BY ALL),
strata AS (SELECT count(DISTINCT coalesce(lang, chr(0))) AS n FROM good),
passing AS (
  SELECT lang, rule, step, cutoff, wrong < n * {quality.RISK / len(quality.RULES)!r} AND
    (SELECT sum(exp(lgamma(t.n + 1) - lgamma(k + 1) - lgamma(t.n - k + 1) + k * ln({quality.RISK / len(quality.RULES)!r})
      + (t.n - k) * ln(1 - {quality.RISK / len(quality.RULES)!r}))) FROM range(0, t.wrong + 1) AS r(k))
    <= {quality.ERROR} / ({len(quality.RULES)} * (SELECT n FROM strata)) AS ok FROM tested t),
chosen AS (
  SELECT lang, rule, min(cutoff) AS cutoff FROM (
    SELECT *, bool_and(ok) OVER (PARTITION BY lang, rule ORDER BY step) AS all_ok FROM passing) WHERE all_ok GROUP BY ALL),
hits AS (
  SELECT DISTINCT m.doc_id FROM measures m JOIN chosen c ON m.rule = c.rule AND m.lang IS NOT DISTINCT FROM c.lang AND value >= cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM hits) AS kept FROM failed"""

_LIST_SQL = " ".join(
    f"WHEN (host = '{site}' OR ends_with(host, '.{site}')) AND starts_with(path, '{start}') THEN ['{site + start}', '{verdict}']"
    for verdict, site, start in sorted(URL_RULES, key=lambda r: (-len(r[1] + r[2]), r)))
_URL_SQL = rf"""
WITH RECURSIVE cut AS (
  SELECT page_id, url, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path,
    regexp_extract(coalesce(url, ''), '\?([^#]*)', 1, 's') AS query, row_number() OVER () AS row FROM pages),
items AS (
  SELECT DISTINCT row, page_id, item FROM (
    SELECT row, page_id, 'host:' || host AS item FROM cut WHERE host != ''
    UNION ALL SELECT row, page_id, 'label:' || x FROM (SELECT row, page_id, unnest(string_split(host, '.')) AS x FROM cut) WHERE x != ''
    UNION ALL SELECT row, page_id, 'path:' || x FROM (SELECT row, page_id, unnest(string_split(path, '/')) AS x FROM cut)
      WHERE x != '' AND NOT regexp_matches(x, '^\d+(\.\w+)?$')
    UNION ALL SELECT row, page_id, 'key:' || split_part(x, '=', 1) FROM (SELECT row, page_id, unnest(string_split(query, '&')) AS x FROM cut)
      WHERE x != '')),
sets AS (
  SELECT row, page_id, [item] AS s FROM items
  UNION ALL SELECT a.row, a.page_id, list_append(a.s, b.item) FROM sets a JOIN items b ON a.row = b.row AND a.s[-1] < b.item),
marks AS (SELECT doc_id, quality = 0 OR toxic = 1 AS bad FROM labels WHERE quality = 0 OR toxic = 1 IS NOT NULL),
mined AS (
  SELECT s FROM sets JOIN marks ON page_id = doc_id GROUP BY s
  HAVING count(*) FILTER (bad) >= {urlrules.LEAST_PAGES}
    AND count(*) FILTER (bad) >= {urlrules.LEAST_CONFIDENCE} * count(*)),
hits AS (SELECT DISTINCT row FROM sets JOIN mined USING (s)),
ruled AS (SELECT *, CASE {_LIST_SQL} END AS found FROM cut)
SELECT page_id, host, path, found[1] AS rule,
  coalesce(found[2], CASE WHEN row IN (SELECT row FROM hits) THEN 'block' ELSE 'allow' END) AS verdict FROM ruled"""

ORACLES: dict[str, str] = {"op1_chat_windows": _CHAT_SQL, "op2_quality_rules": _QUALITY_SQL, "op7_url_filter": _URL_SQL} | queries_words.ORACLES
