"""From raw documents to a training mix: quality rules, line and near duplicates, benchmark passages, source weights."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pollfold.llm.common import saved, table
from pollfold.llm.stages import STAGES as _STAGES

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = _STAGES

# the classifier of the first stage is trained, which SQL cannot express; test_pipeline_stages compares every stage with brute
# force, the trained classifier with texts that are good or bad by construction
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
