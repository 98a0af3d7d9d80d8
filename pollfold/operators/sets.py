"""Set operations on tables and id sets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; columns that a part lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_ids(*ids: DataFrame) -> DataFrame:
    """Ids that are in any of the sets."""
    return reduce(lambda a, b: a.union(b), ids).distinct()


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of left that are not in right."""
    return left.subtract(right)


def split_cohorts(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """(rows that satisfy the condition, all others): disjoint and complete, also for null conditions."""
    flag = F.coalesce(condition, F.lit(False))
    return df.filter(flag), df.filter(~flag)
