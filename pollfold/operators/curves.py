"""Running totals over a whole table, without a single-task window over its rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pollfold.functions.columns import c

_CHUNK = 100_000  # ranks written per row before they are spread out


def concentration_steps(df: DataFrame, user: str = "user_id") -> DataFrame:
    """Concentration of votes over volunteers, one row per distinct number of votes, most active first.

    ``votes, volunteers, first_rank, last_rank, votes_before``: the volunteers with that many votes take the ranks
    from first to last, and ``votes_before`` votes belong to more active ones. The window runs over distinct
    vote numbers; d of them need at least d(d+1)/2 votes in the table, so it is tiny at any scale.
    """
    per_user = df.filter(c(user).isNotNull()).groupBy(c(user)).agg(F.count(F.lit(1)).alias("votes"))
    steps = per_user.groupBy("votes").agg(F.count(F.lit(1)).alias("volunteers"))
    before = Window.orderBy(F.desc("votes")).rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("volunteers").over(before), F.lit(0))
    return steps.select(
        "votes",
        "volunteers",
        (earlier + 1).alias("first_rank"),
        (earlier + F.col("volunteers")).alias("last_rank"),
        F.coalesce(F.sum(F.col("votes") * F.col("volunteers")).over(before), F.lit(0)).alias("votes_before"),
    )


def concentration_curve(df: DataFrame, user: str = "user_id") -> DataFrame:
    """Cumulative votes over volunteers in descending activity.

    ``rank, votes, cumulative, remaining, remaining_share``: remaining is the last cumulative value minus this one,
    and its share is relative to the first remaining value. Volunteers with equal votes are interchangeable, so the
    curve follows from :func:`concentration_steps`; long steps are cut into chunks and spread over the cluster.
    """
    steps = concentration_steps(df, user)
    chunk = F.explode(F.sequence("first_rank", "last_rank", F.lit(_CHUNK))).alias("from_rank")
    chunks = steps.select("votes", "first_rank", "last_rank", "votes_before", chunk).repartition("from_rank")
    last = F.least(F.col("from_rank") + (_CHUNK - 1), F.col("last_rank"))
    ranks = chunks.select("*", F.explode(F.sequence("from_rank", last)).alias("rank"))
    points = ranks.select(
        "rank",
        "votes",
        (F.col("votes_before") + F.col("votes") * (F.col("rank") - F.col("first_rank") + 1)).alias("cumulative"),
    )
    ends = steps.agg(
        F.max(F.col("votes_before") + F.col("votes") * F.col("volunteers")).alias("total"),
        F.max("votes").alias("most"),
    )
    total, most = ends.select("total").scalar(), ends.select("most").scalar()
    remaining = total - F.col("cumulative")
    return points.select(
        "rank",
        "votes",
        "cumulative",
        remaining.alias("remaining"),
        F.try_divide(remaining.cast("double"), (total - most).cast("double")).alias("remaining_share"),
    )


def running_count(df: DataFrame, flag: Column, time_col: str = "created_at") -> DataFrame:
    """Running number of rows, and of flagged rows, in time order: ``time, rows, flagged, rows_so_far, flagged_so_far``.

    One output row per distinct time; rows of the same time come together. Rows are first combined per time, then
    summed on a calendar: times within a second (at most a million), seconds within an hour (3600), and hours.
    Each window is bounded by its calendar unit, whatever the number of rows in it.
    """
    second, hour = F.date_trunc("second", "time"), F.date_trunc("hour", "second")
    times = (
        df.filter(c(time_col).isNotNull())
        .groupBy(c(time_col).alias("time"))
        .agg(F.count(F.lit(1)).alias("rows"), F.count_if(flag).alias("flagged"))
        .withColumn("second", second)
    )
    seconds = times.groupBy("second").agg(F.sum("rows").alias("rows"), F.sum("flagged").alias("flagged"))
    seconds = seconds.withColumn("hour", hour)
    hours = seconds.groupBy("hour").agg(F.sum("rows").alias("rows"), F.sum("flagged").alias("flagged"))
    per_hour = _offsets(hours, Window.orderBy("hour"), "hour")
    per_second = _offsets(seconds, Window.partitionBy("hour").orderBy("second"), "second", "hour")
    within = Window.partitionBy("second").orderBy("time").rowsBetween(Window.unboundedPreceding, 0)
    inner = times.select(
        "time",
        "rows",
        "flagged",
        "second",
        F.sum("rows").over(within).alias("rows_here"),
        F.sum("flagged").over(within).alias("flagged_here"),
    )
    # null-safe joins: plain ones would push different null filters into the three uses of the counted table, which
    # would then be read three times instead of once
    hourly = per_hour.withColumnRenamed("hour", "__hour")
    placed = per_second.join(hourly, F.col("hour").eqNullSafe(F.col("__hour"))).select(
        F.col("second").alias("__second"),
        (F.col("rows_before_second") + F.col("rows_before_hour")).alias("rows_before"),
        (F.col("flagged_before_second") + F.col("flagged_before_hour")).alias("flagged_before"),
    )
    return inner.join(placed, F.col("second").eqNullSafe(F.col("__second"))).select(
        "time",
        "rows",
        "flagged",
        (F.col("rows_before") + F.col("rows_here")).alias("rows_so_far"),
        (F.col("flagged_before") + F.col("flagged_here")).alias("flagged_so_far"),
    )


def _offsets(df: DataFrame, window, unit: str, *others: str) -> DataFrame:
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    return df.select(
        unit,
        *others,
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias(f"rows_before_{unit}"),
        F.coalesce(F.sum("flagged").over(before), F.lit(0)).alias(f"flagged_before_{unit}"),
    )
