"""Classifications with annotation lists to one clean row per answer."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pollfold.dictionaries import DR5, PUBLIC_LAUNCH, QUESTION_SINCE_VERSION
from pollfold.dictionary import QuestionSet
from pollfold.functions.columns import c
from pollfold.functions.ids import response_id
from pollfold.functions.text import sanitise
from pollfold.operators.aggregates import keep_first
from pollfold.operators.joins import with_names
from pollfold.operators.shaping import answered, current_wording, since, single_choice, without_tasks

# Columns of the published response table besides question, response and id (fixed values).
PARENT_COLUMNS = (
    "created_at",
    "workflow_id",
    "workflow_version",
    "user_id",
    "person_id",
    "subject_id",
    "iauname",
    "classification_id",
)


def explode_annotations(
    df: DataFrame, keep: Sequence[str], exclude_tasks: Iterable[str] = (), annotations: str = "annotations"
) -> DataFrame:
    """One row per annotation with its members and the kept parent columns.

    An outer explode followed by a null filter: an inner one makes the optimiser add a filter on the size of the list,
    which computes the list twice when it comes from an expression.
    """
    exploded = df.select(F.explode_outer(c(annotations)).alias("annotation"), *[c(k) for k in keep])
    rows = exploded.filter(F.col("annotation").isNotNull())
    return without_tasks(rows.select("annotation.*", *[c(k) for k in keep]), exclude_tasks)


def clean_annotations(
    exploded: DataFrame,
    dictionary: QuestionSet,
    on_unknown: str = "error",
    task: str = "task",
    value: str = "value",
    question: str = "question",
    response: str = "response",
) -> DataFrame:
    """Drop rows without answer, then sanitise the answer text and rename by the dictionary."""
    return with_names(answered(exploded, task, value), dictionary, c(task), sanitise(c(value)), on_unknown, question, response)


def flatten(
    classifications: DataFrame,
    dictionary: QuestionSet = DR5,
    keep: Sequence[str] = PARENT_COLUMNS,
    start: str | None = PUBLIC_LAUNCH,
    start_inclusive: bool = False,
    exclude_tasks: Iterable[str] = (),
    since_version: Mapping[str, float] | None = QUESTION_SINCE_VERSION,
    on_unknown: str = "error",
    deduplicate: bool = False,
    id_kind: str | None = "xxhash64",
) -> DataFrame:
    """Response table: the kept columns, ``question``, ``response`` and ``response_id``.

    No shuffle: explode, filters and a join with the broadcast dictionary, so it is the same for batch and stream.
    The start filter comes before the explode. ``deduplicate`` drops repeats of (classification, question, response),
    which shuffles; reducing does not need it.
    """
    df = classifications.withColumn("created_at", F.to_timestamp("created_at"))
    if start is not None:
        df = since(df, start, inclusive=start_inclusive)
    df = df.withColumns({k: c(k).cast("string") for k in keep if k != "created_at"})
    rows = single_choice(answered(explode_annotations(df, keep, exclude_tasks), "task_id"))
    if since_version:
        rows = _currently_worded(rows, dictionary, since_version)
    named = clean_annotations(rows, dictionary, on_unknown, task="task_id")
    out = named.select(*[c(k) for k in keep], "question", "response")
    if deduplicate:
        out = unique_responses(out)
    if id_kind is not None:
        out = out.withColumn(
            "response_id", response_id(c("classification_id"), c("question"), c("response"), id_kind)
        )
    return out


def _currently_worded(rows: DataFrame, dictionary: QuestionSet, since_version: Mapping[str, float]) -> DataFrame:
    """The version gate, by raw question: old wordings must go before their answers are looked up."""
    raw = {dictionary.question(q).raw_name: v for q, v in since_version.items() if q in dictionary.question_names}
    return current_wording(rows, raw, question="task_id") if raw else rows


def unique_responses(
    responses: DataFrame, keys: Sequence[str] = ("classification_id", "question", "response")
) -> DataFrame:
    """One row per (classification, question, response).

    A classification belongs to one subject and one volunteer, so its repeats should be equal in the other columns too. If
    not, a batch keeps the smallest row (earliest, when the time comes first), a stream any.
    """
    rest = [name for name in responses.columns if name not in set(keys)]
    if responses.isStreaming or not rest:
        return responses.dropDuplicates(list(keys))
    return keep_first(responses, keys, rest)
