"""Classification exports (CSV with JSON cells) in the shape of derived API records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pollfold.dictionaries import DR5, MULTIPLE_CHOICE_LABEL, PUBLIC_LAUNCH
from pollfold.dictionary import QuestionSet
from pollfold.functions.ids import person_id
from pollfold.functions.jsons import browser_metadata, export_annotations, first_member, first_present
from pollfold.functions.times import api_time, whole_seconds
from pollfold.plans.derive import EXTERNAL_NAME_KEYS
from pollfold.plans.flatten import flatten

PROJECT_ID = "5733"  # the project all exports belong to; exports do not name it (fixed value)


def export_to_classifications(
    export: DataFrame,
    multiple_choice_labels: Sequence[str] = (MULTIPLE_CHOICE_LABEL,),
    name_keys: Sequence[str] = EXTERNAL_NAME_KEYS,
    project_id: str = PROJECT_ID,
) -> DataFrame:
    """JSON cells parsed, names and times harmonised with the API, volunteer identity added.

    Labels are matched by their start: the published wording of the rare-features question grew over time.
    """
    return _classifications(export, api_time(F.col("created_at")), multiple_choice_labels, name_keys, project_id)


def _classifications(
    export: DataFrame, created_at: Column, multiple_choice_labels: Sequence[str], name_keys: Sequence[str], project_id: str
) -> DataFrame:
    return export.select(
        "classification_id",
        created_at.alias("created_at"),
        F.lit(project_id).alias("project_id"),
        "workflow_id",
        F.col("workflow_version").cast("string").alias("workflow_version"),
        "user_id",
        person_id(F.col("user_id"), F.col("user_ip")).alias("person_id"),
        F.col("subject_ids").alias("subject_id"),
        first_present(first_member(F.col("subject_data")), name_keys).alias("iauname"),
        export_annotations(F.col("annotations"), multiple_choice_labels).alias("annotations"),
        browser_metadata(F.col("metadata")).alias("metadata"),
    )


def export_to_responses(
    export: DataFrame,
    dictionary: QuestionSet = DR5,
    multiple_choice_labels: Sequence[str] = (MULTIPLE_CHOICE_LABEL,),
    start: str | None = PUBLIC_LAUNCH,
    **options,
) -> DataFrame:
    """Export straight to the flat response table, with times that are not written and read again on the way."""
    times = whole_seconds(F.col("created_at"))
    classifications = _classifications(export, times, multiple_choice_labels, EXTERNAL_NAME_KEYS, PROJECT_ID)
    return flatten(classifications, dictionary, start=start, **options)
