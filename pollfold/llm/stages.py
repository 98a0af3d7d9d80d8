"""The stages of the corpus pipeline: (spark, docs, sf_dir) to the documents that go on.

All stages take texts whole, at any length, and any table with the columns of documents; other columns go along, whatever their
names. An empty table stays empty. Rows with a null id are documents like others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pollfold.llm import decontamination, line_dedup, mixing, near_dedup, quality
from pollfold.llm.common import columns_of, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule, or that the classifier rejects, go.

    Null and empty texts have no words and so go. Repeated rows are judged alike, each on its own. Without labels of both
    kinds only the rules decide."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    rows, found = quality.judge(docs, model)
    return rows.where(found["kept"]).select(columns_of(docs))


def line_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that are similar to an earlier line go; documents without any line left go.

    Null, empty and blank texts have no line and stay. Of equal lines the one with the smallest doc_id (null last) and
    number stays; repeated rows keep the same lines."""
    return line_dedup.without_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest doc_id (null last).

    Texts without words are in no group and stay. Of repeated rows with that id, the least by all columns stays."""
    return near_dedup.without_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    Null and empty texts hold none and stay; items count by their text, with or without id; repeated rows go or stay alike."""
    rows, items = decontamination.matched(docs, table(spark, sf_dir, "benchmark"))
    return rows.where(F.size(items) == 0).select(columns_of(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words to take of every document: (doc_id, size, source_size, target, taken, shard, shard_quota).

    Null and empty texts have size 0 and nothing taken. A null source is a source. Repeated rows are documents of their
    own; equal ids are laid out by size."""
    return mixing.mix(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_duplicates),
    ("near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mixing_sources", mix_sources),
]
