"""Volunteer quality and test-subject rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pollfold.functions.columns import c
from pollfold.functions.votes import share
from pollfold.operators.aggregates import volunteer_profiles
from pollfold.operators.joins import remove_ids


@dataclass(frozen=True)
class QualityRule:
    """Who counts as unreliable on the key question. The defaults are the published thresholds."""

    question: str = "smooth-or-featured"
    unwanted: str = "problem"
    min_answers: int = 100
    max_unwanted_share: float = 0.25
    earliest_last_active: str | None = "2024-08-21"

    def left_early(self) -> Column:
        if self.earliest_last_active is None:
            return F.lit(False)
        return F.col("last_active") < F.lit(self.earliest_last_active).cast("timestamp")

    def answers_unwanted(self) -> Column:
        return (F.col("answers") > self.min_answers) & (F.col("unwanted_share") > self.max_unwanted_share)


def judged_volunteers(responses: DataFrame, rule: QualityRule, user: str = "user_id", **columns: str) -> DataFrame:
    """Profiles with ``left_early``, ``answers_unwanted`` and ``removed`` flags."""
    profiles = volunteer_profiles(responses, rule.question, {"unwanted_share": rule.unwanted}, user, **columns)
    return profiles.withColumns(
        {
            "left_early": rule.left_early(),
            "answers_unwanted": rule.answers_unwanted(),
            "removed": rule.left_early() | rule.answers_unwanted(),
        }
    )


def unreliable_volunteers(responses: DataFrame, rule: QualityRule, user: str = "user_id", **columns: str) -> DataFrame:
    """Ids of volunteers with at least one reason to be removed: one aggregation decides both reasons."""
    return judged_volunteers(responses, rule, user, **columns).filter("removed").select(c(user))


def without_unreliable(responses: DataFrame, rule: QualityRule, user: str = "user_id", **columns: str) -> DataFrame:
    """All responses of the remaining volunteers; responses without volunteer stay.

    The removed ids join by anti join: AQE broadcasts them when their measured size allows, and splits the responses
    of very active volunteers when not.
    """
    return remove_ids(responses, unreliable_volunteers(responses, rule, user, **columns), user)


def quality_report(responses: DataFrame, rule: QualityRule, user: str = "user_id", **columns: str) -> DataFrame:
    """One row: volunteers, removed ones by reason, and the share that answers the unwanted option too often."""
    judged = judged_volunteers(responses, rule, user, **columns)
    return judged.agg(
        F.count(F.lit(1)).alias("volunteers"),
        F.count_if(F.col("removed")).alias("removed"),
        F.count_if(F.col("left_early")).alias("left_early"),
        F.count_if(F.col("answers_unwanted")).alias("answers_unwanted"),
        share(F.col("answers_unwanted")).alias("unwanted_volunteer_share"),
    )


def intensive_subjects(
    responses: DataFrame,
    question: str,
    min_votes: int = 20,
    strict: bool = False,
    subject: str = "subject_id",
    task_col: str = "task",
) -> DataFrame:
    """Ids of subjects with at least (``strict``: more than) ``min_votes`` answers to the key question."""
    votes = responses.filter((c(task_col) == question) & c(subject).isNotNull()).groupBy(c(subject))
    counted = votes.agg(F.count(F.lit(1)).alias("votes"))
    enough = F.col("votes") > min_votes if strict else F.col("votes") >= min_votes
    return counted.filter(enough).select(c(subject))


def without_early_test_votes(
    responses: DataFrame,
    before: str,
    question: str,
    min_votes: int = 20,
    subject: str = "subject_id",
    task_col: str = "task",
    time_col: str = "created_at",
) -> DataFrame:
    """Drop votes that are both for a test subject and older than a date.

    One anti join by subject; a vote that is not early has no key in it, like one without subject, and stays.
    """
    ids = intensive_subjects(responses, question, min_votes, subject=subject, task_col=task_col)
    ids = ids.select(c(subject).alias("__test_subject"))
    early = c(time_col) < F.lit(before).cast("timestamp")
    keyed = responses.withColumn("__test_subject", F.when(early, c(subject)))
    return remove_ids(keyed, ids, "__test_subject").drop("__test_subject")


def volunteer_cohort(
    responses: DataFrame, left_before: str, user: str = "user_id", time_col: str = "created_at"
) -> DataFrame:
    """Per volunteer: ``left`` is true when the last activity is before a date (else the volunteer stayed)."""
    last = responses.filter(c(user).isNotNull()).groupBy(c(user)).agg(F.max(c(time_col)).alias("last_active"))
    return last.select(c(user), (F.col("last_active") < F.lit(left_before).cast("timestamp")).alias("left"))


def cohort_shares(
    responses: DataFrame,
    cohort: Column,
    answer: str,
    more_than: int = 10,
    subject: str = "subject_id",
    value_col: str = "value",
) -> DataFrame:
    """Share of one answer per cohort and subject, for subjects with more than ``more_than`` votes in that cohort."""
    grouped = responses.filter(cohort.isNotNull() & c(subject).isNotNull()).groupBy(cohort.alias("cohort"), c(subject))
    return grouped.agg(
        share(c(value_col) == answer).alias("answer_share"), F.count(F.lit(1)).alias("votes")
    ).filter(F.col("votes") > more_than)
