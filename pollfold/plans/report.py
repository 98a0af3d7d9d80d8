"""Volunteer activity reports."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame

from pollfold.functions.columns import c
from pollfold.functions.text import in_user_list
from pollfold.operators.aggregates import frequency, shares_per_week, time_buckets
from pollfold.operators.curves import concentration_curve
from pollfold.operators.ranking import most_active


def experts_only(df: DataFrame, users: Iterable[str], user: str = "user_name") -> DataFrame:
    return df.filter(in_user_list(c(user), users))


def activity_report(
    classifications: DataFrame,
    responses: DataFrame,
    answers: Mapping[str, str],
    experts: Iterable[str] = (),
    user: str = "user_id",
    workflow: str | None = None,
    value_col: str = "value",
    time_col: str = "created_at",
    top: int = 40,
) -> dict[str, DataFrame]:
    """The tables behind an activity report, by name; each is computed only when used."""
    per_user = frequency(classifications, user)
    expert_rows = experts_only(classifications, experts, user)
    return {
        "per_user": per_user,
        "most_active": most_active(per_user, user, top),
        "concentration": concentration_curve(classifications, user),
        "expert_concentration": concentration_curve(expert_rows, user),
        "per_expert": frequency(expert_rows, user),
        "two_hourly": time_buckets(classifications, 7200, workflow, time_col),
        "daily": time_buckets(classifications, 86400, workflow, time_col),
        "weekly_shares": shares_per_week(responses, answers, value_col, time_col),
    }
