"""Registered queries of the word operators: spelling variants, source mixing, ranked search, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerforge.llm import lexical, mixing, variants
from offerforge.llm.frames import table


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of all documents with its frequent form and root."""
    return variants.spelling_variants(table(spark, sf_dir, "documents"))


def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    planned = mixing.plan(table(spark, sf_dir, "documents"))
    return planned.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best documents for every benchmark item."""
    return lexical.ranked_search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op11_spelling_variants, op12_source_mix, op13_ranked_search)
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# the checksum's table follows from its polynomial; words are compared as strings of one byte per code point
_VARIANTS_SQL = rf"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS steps FROM range(0, 256) AS r(i)),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run
  FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL),
coded AS (SELECT *, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS h FROM counted),
summed AS (
  SELECT run, n, xor(list_reduce(
    list_transform(range(-1, len(h) // 2), lambda k: CASE WHEN k < 0 THEN 4294967295 ELSE ('0x' || h[2 * k + 1 : 2 * k + 2])::BIGINT END),
    lambda c, b: xor(c >> 8, steps[xor(c, b) % 256 + 1])), 4294967295) AS h FROM coded, crc),
cut AS (
  SELECT CASE WHEN h % 97 = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word, n
  FROM summed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM cut WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
less AS (
  SELECT DISTINCT word, n, translate(word, (SELECT string_agg(chr(i::INTEGER), '' ORDER BY i) FROM range(192, 256) AS r(i)),
      (SELECT string_agg(chr(i::INTEGER), '' ORDER BY i) FROM range(33, 97) AS r(i))) AS bytes,
    CASE WHEN k = 0 THEN word ELSE substring(word, 1, k - 1) || substring(word, k + 1) END AS rest
  FROM (SELECT word, n, unnest(range(0, length(word) + 1)) AS k FROM words)),
pairs AS (
  SELECT DISTINCT a.word, a.n, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.rest = b.rest AND a.word <> b.word
  WHERE levenshtein(a.bytes, b.bytes) = 1),
best AS (
  SELECT *, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS place FROM pairs),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN near_n >= 2 * w.n THEN near END AS form,
    CASE WHEN near_n >= 2 * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word AND place = 1),
walk AS (
  SELECT word, word AS at FROM formed
  UNION ALL SELECT w.word, f.form FROM walk w JOIN formed f ON w.at = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, w.at AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN walk w ON f.word = w.word JOIN formed e ON e.word = w.at AND e.form IS NULL"""

_MIX_SQL = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, '')) AS base FROM documents),
sources AS (
  SELECT source, size, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w, 2 * size AS cap
  FROM (SELECT source, sum(size)::BIGINT AS size FROM docs GROUP BY source)),
whole AS (SELECT 1.5::DOUBLE * sum(size)::DOUBLE AS budget, count(*) AS n FROM sources),
levels AS (
  SELECT 0::BIGINT AS i, budget / (SELECT sum(w) FROM sources) AS level FROM whole
  UNION ALL
  SELECT l.i + 1, any_value(budget - (SELECT coalesce(sum(cap), 0) FROM sources s WHERE s.cap < l.level * s.w))
    / nullif(sum(CASE WHEN cap < level * w THEN 0 ELSE w END), 0)
  FROM levels l, whole, sources WHERE l.i < whole.n GROUP BY l.i, l.level),
shares AS (
  SELECT source, size AS source_size, CASE WHEN cap < level * w THEN cap::DOUBLE ELSE level * w END AS target
  FROM sources, (SELECT arg_max(level, i) AS level FROM levels WHERE level IS NOT NULL)),
rated AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM shares),
parted AS (SELECT *, floor(rate)::BIGINT AS often, rate - floor(rate) AS fraction FROM rated),
drawn AS (
  SELECT d.doc_id, d.size, p.*, seed, ('0x' || left(md5(base || ':' || seed), 8))::BIGINT / 4294967296.0::DOUBLE < fraction AS extra
  FROM docs d JOIN parted p ON d.source IS NOT DISTINCT FROM p.source, range(0, {mixing.SEEDS}) AS r(seed)),
tried AS (
  SELECT source, seed, abs(any_value(often * source_size) + sum(CASE WHEN extra THEN size ELSE 0 END) - any_value(target)) AS off
  FROM drawn GROUP BY source, seed),
chosen AS (SELECT source, arg_min(seed, (off, seed)) AS seed FROM tried GROUP BY source)
SELECT doc_id, size, source_size, target, (size * (often + extra::BIGINT))::BIGINT AS taken
FROM drawn d JOIN chosen c ON d.source IS NOT DISTINCT FROM c.source AND d.seed = c.seed"""

_SEARCH_SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
lengths AS (SELECT row, doc_id, len(t) AS n FROM docs WHERE len(t) > 0),
whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM lengths),
asked AS (
  SELECT item_id, row_number() OVER () AS item,
    regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)),
wanted AS (SELECT item, item_id, term, count(*) AS q FROM (SELECT item, item_id, unnest(t) AS term FROM asked) GROUP BY ALL),
held AS (
  SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(t) AS term FROM docs)
  WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM held GROUP BY term), whole),
normed AS (SELECT row, doc_id, 25 + (75 * n * docs) // terms AS m FROM lengths, whole),
scored AS (
  SELECT item, any_value(item_id) AS item_id, row, any_value(doc_id) AS doc_id,
    sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM wanted JOIN weights USING (term) JOIN held USING (term) JOIN normed USING (row) GROUP BY item, row)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank FROM scored WHERE score > 0)
WHERE rank <= 10"""

ORACLES: dict[str, str] = {
    "op11_spelling_variants": _VARIANTS_SQL, "op12_source_mix": _MIX_SQL, "op13_ranked_search": _SEARCH_SQL,
}
