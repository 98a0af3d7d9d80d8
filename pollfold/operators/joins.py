"""Joins.

None of them forces a broadcast of data that grows: Catalyst and AQE broadcast a side whose measured size is
below the session threshold, and split the left side of skewed keys otherwise. Only :func:`lookup_join`
hints, and only after measuring; the question dictionary is a list in the code.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from pollfold.dictionary import QuestionSet
from pollfold.functions.columns import c
from pollfold.functions.text import is_blank
from pollfold.operators.checks import enforce_unique

NULL_KEY_PARTS = 1024
UNKNOWN_MODES = ("error", "drop", "keep")


def fits_broadcast(df: DataFrame, max_rows: int = 20_000, max_bytes: int = 32 << 20) -> bool:
    """Whether a dimension is small, measured by one aggregate over it."""
    size = df.agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.length(F.to_json(F.struct("*")))), F.lit(0)).alias("bytes")
    ).first()
    return size["rows"] <= max_rows and size["bytes"] <= max_bytes


def lookup_join(
    df: DataFrame, dimension: DataFrame, keys: Sequence[str], how: str, spread_by: str, spread: int = 16, **limits: int
) -> DataFrame:
    """Join with a dimension: broadcast when it measures small.

    A large one joins by shuffle, with every key split into ``spread`` parts by a hash of ``spread_by``, because one
    entry of a dimension (the version in force, say) may concern a large part of all rows.
    """
    if fits_broadcast(dimension, **limits):
        return df.join(F.broadcast(dimension), list(keys), how)
    salted = df.withColumn("__part", F.pmod(F.xxhash64(c(spread_by)), F.lit(spread)))
    copies = dimension.select("*", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("__part"))
    copies = copies.withColumn("__part", F.col("__part").cast("bigint"))
    return salted.join(copies, [*keys, "__part"], how).drop("__part")


def _joined_on_keys(df: DataFrame, other: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Left or left anti join. Rows without a key match nothing and may be many, so they are spread by their other columns."""
    other = other.withColumn("__part", F.lit(0).cast("bigint"))
    others = [c(f.name) for f in df.schema if isinstance(f.dataType, AtomicType)]
    missing = reduce(or_, [c(k).isNull() for k in keys])
    part = F.when(missing, 1 + F.pmod(F.xxhash64(*others), F.lit(NULL_KEY_PARTS))).otherwise(F.lit(0)).cast("bigint")
    return df.withColumn("__part", part).join(other, [*keys, "__part"], how).drop("__part")


def attach(df: DataFrame, other: DataFrame, on: str | Sequence[str], required: bool = True) -> DataFrame:
    """Add the columns of another table by key: inner when ``required``, else left."""
    keys = [on] if isinstance(on, str) else list(on)
    return df.join(other, keys, "inner") if required else _joined_on_keys(df, other, keys, "left")


def natural_join(df: DataFrame, other: DataFrame, how: str = "inner") -> DataFrame:
    """Join on all columns the two tables share."""
    shared = [name for name in df.columns if name in set(other.columns)]
    return df.join(other, shared, how)


def one_to_one(df: DataFrame, other: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Inner join in which a key that repeats on either side is an error, raised while the join is computed."""
    keys = [on] if isinstance(on, str) else list(on)
    return enforce_unique(df, keys).join(enforce_unique(other, keys), keys, "inner")


def fold_outer(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer join of several tables on the same keys; missing numbers become 0."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.join(frame, list(keys), "full")
    return out.na.fill(0, subset=[name for name in out.columns if name not in set(keys)])


def keep_ids(df: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    """Rows whose key is among the ids."""
    return df.join(ids.select(on), on, "left_semi")


def remove_ids(df: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    """Rows whose key is not among the ids; rows without a key stay."""
    return _joined_on_keys(df, ids.select(on), [on], "left_anti").select(*[c(name) for name in df.columns])


def remove_people(df: DataFrame, people: Sequence[str] | DataFrame, column: str = "person_id") -> DataFrame:
    """Drop the rows of some volunteers, given as a short list or as a table of ids."""
    if isinstance(people, DataFrame):
        return remove_ids(df, people, column)
    return df.filter(~F.coalesce(c(column).isin(list(people)), F.lit(False))) if people else df


def with_version(df: DataFrame, versions: DataFrame, on_missing: str = "error") -> DataFrame:
    """Attach the label map of the workflow version each classification was made under.

    ``versions`` has one row per (workflow, major, minor). A classification without version raises when it is
    computed, is dropped, or is kept with a null map.
    """
    if on_missing not in UNKNOWN_MODES:
        raise ValueError(f"on_missing must be one of {UNKNOWN_MODES}")
    keys = ["workflow_id", "workflow_major_version", "workflow_minor_version"]
    unique = enforce_unique(versions.select(*keys, "strings"), keys)
    how = "inner" if on_missing == "drop" else "left"
    joined = lookup_join(df, unique, keys, how, spread_by="classification_id")
    if on_missing == "error":
        what = F.concat_ws(".", *keys)
        failed = F.raise_error(F.concat(F.lit("no workflow version "), what)).cast("map<string,string>")
        joined = joined.withColumn("strings", F.coalesce("strings", failed))
    return joined


def with_names(
    df: DataFrame,
    dictionary: QuestionSet,
    raw_task: Column,
    raw_value: Column,
    on_unknown: str = "error",
    question: str = "question",
    response: str = "response",
) -> DataFrame:
    """Add published question and answer names by (raw question, raw answer).

    Raw answers repeat across questions, so the pair is the key. Rows with a null or blank answer are dropped. Any
    other unknown pair raises when it is computed, is dropped, or is kept with null names.

    Blank rows are told apart after the join, among the rows that found no name, so that the answer text is
    cleaned once per row.
    """
    if on_unknown not in UNKNOWN_MODES:
        raise ValueError(f"on_unknown must be one of {UNKNOWN_MODES}")
    names = dictionary.lookup(df.sparkSession).select(
        F.col("raw_task").alias("__raw_task"),
        F.col("raw_value").alias("__raw_value"),
        F.col("task").alias(question),
        F.col("value").alias(response),
    )
    keyed = df.withColumns({"__task": raw_task, "__value": raw_value})
    matches = (F.col("__task") == F.col("__raw_task")) & (F.col("__value") == F.col("__raw_value"))
    joined = keyed.join(F.broadcast(names), matches, "inner" if on_unknown == "drop" else "left")
    blank = F.coalesce(is_blank(F.col("__value")), F.lit(True))
    if on_unknown != "drop":
        joined = joined.filter(c(response).isNotNull() | ~blank)
    if on_unknown == "error":
        what = F.concat_ws(" / ", F.col("__task"), F.col("__value"))
        failed = F.raise_error(F.concat(F.lit("not in the dictionary: "), what)).cast("string")
        # only for rows that the filter keeps, in whatever order the optimiser evaluates the two
        joined = joined.withColumn(response, F.when(c(response).isNotNull(), c(response)).when(~blank, failed))
    return joined.drop("__task", "__value", "__raw_task", "__raw_value")
