"""Corpus pipeline: quality rules, near duplicates, benchmark passages, packing. Each stage reads what the one before wrote."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from offerforge.llm import decontaminate, packing, quality, simhash
from offerforge.llm.frames import table
from offerforge.llm.queries import vocabulary
from offerforge.session import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. Null, empty and very short texts fail them; a document without a number is
    judged and never labelled, repeated rows are judged alike, without labels the base rules decide."""
    return quality.filtered(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, Jaccard 0.8), that with the smallest number. Fingerprints at 3
    bits or less, found through vantage-point trees, are tested first, an exact search finds what is left. Of rows with that number one stays; null texts count as empty, rows without a number all stay. No rows give none."""
    return simhash.keep_one(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark, up to the error budget. Null texts stay, documents and items without a
    number take part, repeated rows are judged alike, an empty benchmark removes nothing."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in the training sequences. A null or empty text is its end mark alone, repeated
    rows and rows without a number are packed each, no rows give none."""
    return packing.pack_documents(docs, vocabulary("word_bpe_49k.json"), keep_ids=False)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_passages),
    ("best_fit_packing", best_fit_packing),
]

#: SQL has no XXH64 and no tokenizer, so the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages from ``documents`` on; all but the last are written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
