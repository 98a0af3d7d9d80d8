"""Projections, renames and row filters."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pollfold.dictionary import QuestionSet
from pollfold.functions.columns import c
from pollfold.functions.text import is_blank
from pollfold.functions.times import to_utc
from pollfold.operators.aggregates import value_at_rank

# lots are whole numbers below this, exact as doubles
LOTS = 1 << 52


# --- projections ---


def lift_links(df: DataFrame) -> DataFrame:
    """API record with the nested link ids at top level and ``id`` as ``classification_id``."""
    links = F.col("links")
    lifted = df.withColumns(
        {
            "project_id": links["project"],
            "user_id": links["user"],
            "workflow_id": links["workflow"],
            "subject_id": links["subject"]["id"],
        }
    )
    return lifted.withColumnRenamed("id", "classification_id").drop("links")


def split_workflow_version(df: DataFrame, version: Column | None = None) -> DataFrame:
    """``major.minor`` text to two text columns."""
    parts = F.split(F.col("metadata.workflow_version") if version is None else version, r"\.")
    return df.withColumns({"workflow_major_version": F.get(parts, F.lit(0)), "workflow_minor_version": F.get(parts, F.lit(1))})


def as_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named columns as strings, the others unchanged."""
    return df.withColumns({name: c(name).cast("string") for name in columns})


def keep(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[c(name) for name in columns])


def without(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop columns; names that are absent are ignored."""
    return df.drop(*columns)


def rename_raw_counts(df: DataFrame, dictionary: QuestionSet) -> DataFrame:
    """``{raw question}_{raw answer}`` columns to ``{question}_{answer}``."""
    return df.withColumnsRenamed(dict(zip(dictionary.raw_count_columns, dictionary.count_columns)))


def survey_names(dictionary: QuestionSet, survey: str) -> dict[str, str]:
    """Plain result column -> survey-specific one, ``{question}-{survey}_...``."""
    names = {}
    for q in dictionary.questions:
        plain = [q.total_votes, *q.count_columns, *q.fraction_columns]
        names.update({p: f"{q.name}-{survey}{p[len(q.name):]}" for p in plain})
    return names


def with_survey_suffix(df: DataFrame, dictionary: QuestionSet, survey: str, required: Iterable[str] = ()) -> DataFrame:
    """Rename totals, counts and fractions to the survey's vocabulary; all ``required`` columns must then exist."""
    renamed = df.withColumnsRenamed(survey_names(dictionary, survey))
    missing = sorted(set(required) - set(renamed.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return renamed


def without_survey_suffix(df: DataFrame, survey: str) -> DataFrame:
    return df.withColumnsRenamed({name: name.replace(f"-{survey}", "") for name in df.columns})


def with_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({name: F.lit(v) for name, v in values.items()})


# --- filters ---


def allow(df: DataFrame, column: Column, values: Iterable) -> DataFrame:
    """Rows whose value is in a short list."""
    return df.filter(column.isin(list(values)))


def since(df: DataFrame, start: str, column: str = "created_at", inclusive: bool = False) -> DataFrame:
    """Rows after a time (from it on, with ``inclusive``)."""
    bound = F.lit(start).cast("timestamp")
    return df.filter(c(column) >= bound if inclusive else c(column) > bound)


def answered(df: DataFrame, task: str = "task", value: str = "value") -> DataFrame:
    """Rows with both a task and a value."""
    return df.dropna("any", subset=[task, value])


def single_choice(df: DataFrame, flag: str = "multiple_choice") -> DataFrame:
    """Drop multiple-choice rows, and rows that do not say which kind they are."""
    return df.filter(~c(flag))


def without_tasks(df: DataFrame, tasks: Iterable[str], task: str = "task") -> DataFrame:
    """Drop the listed tasks; rows without a task stay."""
    tasks = list(tasks)
    return df.filter(~F.coalesce(c(task).isin(tasks), F.lit(False))) if tasks else df


def only_task(df: DataFrame, name: str, task: str = "task") -> DataFrame:
    return df.filter(c(task) == name)


def not_blank(df: DataFrame, value: str = "value") -> DataFrame:
    return df.filter(~is_blank(c(value)))


def current_wording(
    df: DataFrame,
    since_version: Mapping[str, float],
    question: str = "question",
    version: str = "workflow_version",
    semantic: bool = False,
) -> DataFrame:
    """Drop answers to a question given under a workflow version before its present wording.

    Versions compare as decimal numbers, the way published tables were made (66.5 is after 66.425).
    ``semantic`` compares major and minor as whole numbers instead.
    """
    keep_row = F.lit(True)
    for name, least in since_version.items():
        if semantic:
            major, minor = str(least).split(".")
            parts = F.split(c(version).cast("string"), r"\.")
            at = F.struct(F.get(parts, F.lit(0)).try_cast("int"), F.coalesce(F.get(parts, F.lit(1)).try_cast("int"), F.lit(0)))
            current = at >= F.struct(F.lit(int(major)), F.lit(int(minor)))
        else:
            current = c(version).try_cast("double") >= F.lit(float(least))
        keep_row = keep_row & ((c(question) != name) | current)
    return df.filter(keep_row)


def above(df: DataFrame, column: str, least: float, strict: bool = False) -> DataFrame:
    """Rows whose total (or any number) reaches a threshold."""
    return df.filter(c(column) > least if strict else c(column) >= least)


def except_where(df: DataFrame, *conditions: Column) -> DataFrame:
    """Drop rows for which all conditions hold; a null condition does not hold."""
    both = F.lit(True)
    for condition in conditions:
        both = both & F.coalesce(condition, F.lit(False))
    return df.filter(~both)


def without_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns that are null in every row (one aggregate pass; not for streams)."""
    filled = df.agg(*[F.count(c(name)).alias(name) for name in df.columns]).first()
    return keep(df, [name for name in df.columns if filled[name]])


def lot(keys: Sequence[str], seed: int) -> Column:
    """A whole number below 2**52 drawn by the keys' text and the seed: the same on any cluster, in any order of rows."""
    parts = [F.coalesce(c(k).cast("string"), F.lit("null")) for k in keys]
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *parts)), 1, 13), 16, 10).cast("bigint")


def random_sample(
    df: DataFrame, fraction: float, replacement: bool = False, seed: int = 0, keys: Sequence[str] | None = None
) -> DataFrame:
    """About ``fraction`` of the rows; with ``replacement`` each row comes as often as a Poisson number of that mean says.

    What is drawn depends on the keys (all columns where none are given) and the seed alone, so a rerun, another
    partitioning or a lost executor gives the same rows. Rows with equal keys are drawn alike.
    """
    share = lot(keys or df.columns, seed) / F.lit(float(LOTS))
    if not replacement:
        return df.where(share < F.lit(float(fraction)))
    copies = reduce(add, [(share >= F.lit(x)).cast("int") for x in poisson_steps(fraction)], F.lit(0))
    return df.select("*", F.explode(F.array_repeat(F.lit(True), copies)).alias("__copy")).drop("__copy")


def poisson_steps(mean: float) -> list[float]:
    """Chances of at most 0, 1, 2, ... events, as far as they differ from 1."""
    steps, term, total = [], math.exp(-mean), 0.0
    while (total := total + term) < 1.0 and (len(steps) < mean or term > 1e-17):
        steps.append(total)
        term *= mean / len(steps)
    return steps


def sample_rows(df: DataFrame, n: int, seed: int = 0, keys: Sequence[str] | None = None) -> DataFrame:
    """``n`` rows without replacement, those of the lowest lots; rows whose keys equal the last one's come along.

    The lot at that rank is found first by histograms, so that no task holds or sorts the sample."""
    if n <= 0:
        return df.limit(0)
    drawn = df.select(lot(keys or df.columns, seed).alias("lot"))
    if drawn.count() <= n:
        return df
    return df.where(lot(keys or df.columns, seed) <= F.lit(value_at_rank(drawn, "lot", n - 1)))


def with_timestamp(df: DataFrame, column: str = "created_at") -> DataFrame:
    return df.withColumn(column, to_utc(c(column)))
