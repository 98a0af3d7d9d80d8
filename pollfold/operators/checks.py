"""Uniqueness and vocabulary checks. They run one job each, so batch only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pollfold.functions.columns import c


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*[c(k) for k in keys]).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same DataFrame, after making sure that no key repeats."""
    found = repeated_keys(df, keys).limit(5).collect()
    if found:
        raise ValueError(f"keys {list(keys)} repeat, for example {[tuple(row) for row in found]}")
    return df


def enforce_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows, but a key that repeats raises while the result is computed.

    No extra job: rows are grouped by key, which a join on the key needs anyway, and copies collapse before the shuffle.
    """
    rest = [name for name in df.columns if name not in set(keys)]
    grouped = df.groupBy(*[c(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("__rows"), F.any_value(F.struct(*[c(n) for n in rest])).alias("__row")
    )
    shown = F.to_json(F.struct(*[c(k) for k in keys]))
    failed = F.raise_error(F.concat(F.lit("key repeats: "), shown)).cast(df.select(*[c(n) for n in rest]).schema)
    checked = grouped.withColumn("__row", F.when(F.col("__rows") == 1, F.col("__row")).otherwise(failed))
    return checked.select(*[c(k) for k in keys], "__row.*").select(*[c(n) for n in df.columns])


def duplicate_group_ids(df: DataFrame, name: str = "iauname", subject: str = "subject_id") -> DataFrame:
    """Ids of all subjects whose external name is shared with another subject."""
    shared = repeated_keys(df.filter(c(name).isNotNull()), [name]).select(c(name))
    return df.join(shared, name, "left_semi").select(c(subject).cast("string").alias(subject))


def vocabulary_gap(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Answers that occur in only one of two exports: ``column, value, only_in``.

    Each side is reduced to its distinct answers (a few per question) before the comparison.
    """
    gap = None
    for a, b, side in ((left, right, "left"), (right, left, "right")):
        one_way = _vocabulary(a, columns).subtract(_vocabulary(b, columns)).withColumn("only_in", F.lit(side))
        gap = one_way if gap is None else gap.unionByName(one_way)
    return gap


def assert_same_vocabulary(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> None:
    found = vocabulary_gap(left, right, columns).limit(5).collect()
    if found:
        raise ValueError(f"answers in one export only, for example {[tuple(row) for row in found]}")


def _vocabulary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(name).alias("column"), c(name).cast("string").alias("value")) for name in columns])
    return df.select(F.inline(pairs)).filter("value is not null").distinct()
