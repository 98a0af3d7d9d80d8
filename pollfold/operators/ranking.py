"""Sorts and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pollfold.functions.columns import c


def by_count(df: DataFrame, key: str, count: str = "n") -> DataFrame:
    """Descending counts, ties by key."""
    return df.orderBy(c(count).desc(), c(key))


def most_active(counts: DataFrame, key: str, k: int = 40, count: str = "n") -> DataFrame:
    """The k keys with the highest counts; every task keeps k rows, no full sort."""
    return by_count(counts, key, count).limit(k)


def by_time(df: DataFrame, time_col: str = "created_at", *ties: str) -> DataFrame:
    return df.orderBy(c(time_col), *[c(t) for t in ties])


def by_fraction(df: DataFrame, fraction: str, total: str, more_than: float = 4, ties: Sequence[str] = ()) -> DataFrame:
    """Subjects with enough votes, highest fraction first."""
    return df.filter(c(total) > more_than).orderBy(c(fraction).desc(), *[c(t) for t in ties])


def row_of_maximum(df: DataFrame, column: str, ties: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(c(column).desc(), *[c(t) for t in ties]).limit(1)


def first_and_last(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The first and the last row by ``order``, marked in ``end``: one aggregate, no sort."""
    row, key = F.struct(*[c(n) for n in df.columns]), F.struct(*[c(n) for n in order])
    ends = df.agg(F.min_by(row, key).alias("first"), F.max_by(row, key).alias("last"))
    pair = F.array(
        F.struct(F.lit("first").alias("end"), F.col("first").alias("row")),
        F.struct(F.lit("last").alias("end"), F.col("last").alias("row")),
    )
    return ends.select(F.inline(pair)).select("end", "row.*")


def capped(df: DataFrame, n: int) -> DataFrame:
    """At most n rows, for trial runs."""
    return df.limit(n)
