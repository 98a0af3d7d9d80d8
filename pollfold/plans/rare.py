"""Rare features: multiple-choice answers as counts and fractions next to the reduced table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pollfold.functions.columns import c
from pollfold.functions.jsons import STRICT
from pollfold.functions.text import sanitise, underscored
from pollfold.functions.votes import fraction
from pollfold.operators.aggregates import distinct_values, named_values
from pollfold.sources.storage import cut_lineage


def chosen_features(rows: DataFrame, key: str, value: str = "value", is_json: bool = True) -> DataFrame:
    """One row per chosen feature, as a column-safe label; an empty list gives one null row."""
    answers = F.from_json(c(value), "array<string>", STRICT) if is_json else c(value)
    exploded = rows.select(c(key), F.explode_outer(answers).alias("feature"))
    return exploded.select(c(key), underscored(sanitise(F.col("feature"))).alias("feature"))


def feature_table(chosen: DataFrame, key: str) -> DataFrame:
    """Long form (key, feature, n), for any number of features.

    Counting per (subject, feature) needs neither a list of features nor all rows of a subject in one place."""
    present = chosen.filter(c(key).isNotNull() & F.col("feature").isNotNull())
    return present.groupBy(c(key), "feature").agg(F.count(F.lit(1)).alias("n"))


def feature_maps(table: DataFrame, key: str) -> DataFrame:
    """Sparse form (key, features): a map from the features that a subject has to their counts."""
    entries = F.sort_array(F.collect_list(F.struct("feature", "n")))
    return table.groupBy(c(key)).agg(F.map_from_entries(entries).alias("features"))


def feature_shares(reduced: DataFrame, table: DataFrame, key: str, total: str = "smooth-or-featured_total-votes") -> DataFrame:
    """Long form with the fraction of the first question's total: (key, feature, n, fraction), null without votes."""
    totals = reduced.select(c(key), c(total).alias("__total"))
    joined = table.join(totals, key, "inner")
    return joined.select(c(key), "feature", "n", fraction(F.col("n"), F.col("__total"), null_when_empty=True).alias("fraction"))


def feature_counts(chosen: DataFrame, key: str, features: Sequence[str] | None = None) -> DataFrame:
    """Wide form: one row per subject with a count column per feature, 0 when absent.

    Counting per (subject, feature) comes before the rows go by subject, so neither a hot subject nor a hot feature lands
    in one task. Without a list, the features that occur become columns if they are no more than MAX_COLUMNS, else this
    raises: an open vocabulary belongs in :func:`feature_table` or :func:`feature_maps`. The counts are checkpointed for
    the lookup, so that the answers are parsed only once.
    """
    counted = feature_table(chosen, key)
    if features is None:
        counted = cut_lineage(counted)
        features = named_values(distinct_values(counted, "feature"), "feature")
    columns = [F.coalesce(F.sum(F.when(F.col("feature") == f, F.col("n"))), F.lit(0).cast("bigint")).alias(f) for f in features]
    return counted.repartition(c(key)).groupBy(c(key)).agg(*columns)


def with_feature_fractions(
    reduced: DataFrame, counts: DataFrame, key: str, total: str = "smooth-or-featured_total-votes"
) -> DataFrame:
    """Reduced table joined with feature counts, plus each count over the first question's total.

    Both sides have one row per subject by construction; :func:`pollfold.operators.joins.one_to_one` checks foreign tables.
    """
    joined = reduced.join(counts, key, "inner")
    fractions = {
        f"{name}_fraction": fraction(c(name), c(total), null_when_empty=True)
        for name in counts.columns
        if name != key
    }
    return joined.withColumns(fractions)
