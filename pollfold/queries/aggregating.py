"""Aggregations, windows and calendars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pollfold.operators import aggregates as agg
from pollfold.operators import checks, curves
from pollfold.plans.quality import cohort_shares, intensive_subjects, volunteer_cohort
from pollfold.queries.registry import query
from pollfold.queries.tables import (
    classification,
    CLASSIFICATION_SQL,
    EVENT_RESPONSES_SQL,
    event_responses,
    rounded,
    table,
    text_time,
)

DAY = 86400


@query("frequency_table", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def frequency_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.frequency(table(spark, sf_dir, "events"), "event_type")


@query(
    "frequency_table_with_nulls",
    "SELECT CASE WHEN value > 20 THEN event_type END AS kind, count(*) AS n FROM events GROUP BY 1",
)
def frequency_table_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("value") > 20, F.col("event_type")).alias("kind")
    return agg.frequency(table(spark, sf_dir, "events").select(kind), "kind", with_nulls=True)


@query(
    "count_of_counts",
    "SELECT n AS occurrences, count(*) AS keys FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey) GROUP BY n",
)
def count_of_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.count_of_counts(table(spark, sf_dir, "lineitem"), "l_orderkey")


@query(
    "distinct_counts",
    "SELECT l_returnflag, count(DISTINCT l_partkey) AS n_distinct FROM lineitem GROUP BY l_returnflag",
)
def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.distinct_count(table(spark, sf_dir, "lineitem"), "l_partkey", ["l_returnflag"])


@query("distinct_values", "SELECT DISTINCT p_type FROM part WHERE p_type IS NOT NULL")
def distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.distinct_values(table(spark, sf_dir, "part"), "p_type")


@query(
    "keep_first_row",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (SELECT *, row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey) AS r FROM lineitem) WHERE r = 1""",
)
def keep_first_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    first = agg.keep_first(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"])
    return first.drop("l_shipdate")


@query("drop_repeated_rows", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def drop_repeated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").dropDuplicates()


@query(
    "duplicate_groups",
    "SELECT CAST(p_partkey AS VARCHAR) AS subject_id FROM part WHERE p_name IN (SELECT p_name FROM part GROUP BY p_name HAVING count(*) > 1)",
)
def duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("subject_id"), F.col("p_name").alias("iauname"))
    return checks.duplicate_group_ids(parts)


@query("unique_keys_checked", "SELECT count(*) AS n FROM orders")
def unique_keys_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.assert_unique(table(spark, sf_dir, "orders"), ["o_orderkey"]).agg(F.count(F.lit(1)).alias("n"))


@query(
    "repeated_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.repeated_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "volunteer_profiles",
    f"""WITH {EVENT_RESPONSES_SQL} SELECT user_id, round(avg(CAST(response = 'viewed' AS INT)), 6) AS viewed,
    round(avg(CAST(response = 'failed' AS INT)), 6) AS failed, count(*) AS answers,
    strftime(min(created_at), '%Y-%m-%d %H:%M:%S') AS first_active,
    strftime(max(created_at), '%Y-%m-%d %H:%M:%S') AS last_active, count(subject_id) AS subjects
    FROM responses GROUP BY user_id""",
)
def volunteer_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiles = agg.volunteer_profiles(
        event_responses(spark, sf_dir),
        "action",
        {"viewed": "viewed", "failed": "failed"},
        task_col="question",
        value_col="response",
    )
    moments = {n: text_time(F.col(n)) for n in ("first_active", "last_active")}
    return rounded(profiles.withColumns(moments))


@query(
    "shares_per_week",
    """SELECT isoyear(l_shipdate) || '-' || weekofyear(l_shipdate) AS week_year,
    round(avg(CAST(l_returnflag = 'A' AS INT)), 6) AS accepted, round(avg(CAST(l_returnflag = 'R' AS INT)), 6) AS returned,
    count(*) AS answers FROM lineitem GROUP BY 1""",
)
def shares_per_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return rounded(agg.shares_per_week(lines, {"accepted": "A", "returned": "R"}, "l_returnflag", "l_shipdate"))


@query(
    "cohort_months",
    """WITH t AS (SELECT l_partkey, count(*) >= 32 AS in_test FROM lineitem GROUP BY l_partkey)
    SELECT l_partkey, strftime(l_shipdate, '%Y-%m') AS month, in_test, count(*) AS votes,
    round(avg(CAST(l_returnflag = 'A' AS INT)), 6) AS answer_share
    FROM lineitem JOIN t USING (l_partkey) GROUP BY 1, 2, 3""",
)
def cohort_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    months = agg.cohort_months(
        lines, "A", 32, subject="l_partkey", value_col="l_returnflag", time_col="l_shipdate"
    )
    return rounded(months)


@query(
    "cohort_shares_early_late",
    f"""WITH {EVENT_RESPONSES_SQL}, t AS (SELECT subject_id FROM responses GROUP BY subject_id HAVING count(*) > 95)
    SELECT CASE WHEN created_at < TIMESTAMP '2024-01-10 00:00:00' THEN 'early'
      WHEN created_at > TIMESTAMP '2024-01-20 00:00:00' THEN 'late' END AS cohort, subject_id,
    round(avg(CAST(response = 'viewed' AS INT)), 6) AS answer_share, count(*) AS votes
    FROM responses JOIN t USING (subject_id)
    WHERE created_at < TIMESTAMP '2024-01-10 00:00:00' OR created_at > TIMESTAMP '2024-01-20 00:00:00'
    GROUP BY 1, 2 HAVING count(*) > 10""",
)
def cohort_shares_early_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    responses = event_responses(spark, sf_dir)
    ids = intensive_subjects(responses, "action", 95, strict=True, task_col="question")
    early = F.col("created_at") < F.lit("2024-01-10").cast("timestamp")
    late = F.col("created_at") > F.lit("2024-01-20").cast("timestamp")
    cohort = F.when(early, F.lit("early")).when(late, F.lit("late"))
    test = responses.join(ids, "subject_id", "left_semi")
    return rounded(cohort_shares(test, cohort, "viewed", 10, value_col="response"))


@query(
    "cohort_shares_left_stayed",
    f"""WITH {EVENT_RESPONSES_SQL}, u AS (SELECT user_id, max(created_at) < TIMESTAMP '2024-01-30 00:00:00' AS "left"
      FROM responses GROUP BY user_id)
    SELECT "left" AS cohort, subject_id, round(avg(CAST(response = 'viewed' AS INT)), 6) AS answer_share, count(*) AS votes
    FROM responses JOIN u USING (user_id) GROUP BY 1, 2 HAVING count(*) > 5""",
)
def cohort_shares_left_stayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    responses = event_responses(spark, sf_dir)
    volunteers = volunteer_cohort(responses, "2024-01-30")
    flagged = responses.join(volunteers, "user_id")
    return rounded(cohort_shares(flagged, F.col("left"), "viewed", 5, value_col="response"))


def _buckets_sql(seconds: int) -> str:
    start = f"epoch_us(ts) // 1000000 // {seconds} * {seconds}"
    return f"""WITH b AS (SELECT {start} AS s, event_type, count(*) AS n FROM events GROUP BY 1, 2),
    grid AS (SELECT s, event_type FROM (SELECT unnest(range((SELECT min(s) FROM b), (SELECT max(s) FROM b) + 1, {seconds})) AS s),
      (SELECT DISTINCT event_type FROM events))
    SELECT strftime(make_timestamp(s * 1000000), '%Y-%m-%d %H:%M:%S') AS bucket, event_type, coalesce(n, 0) AS n
    FROM grid LEFT JOIN b USING (s, event_type)"""


@query("time_buckets_two_hours", _buckets_sql(7200))
def time_buckets_two_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    buckets = agg.time_buckets(table(spark, sf_dir, "events"), 7200, "event_type", "ts")
    return buckets.withColumn("bucket", text_time(F.col("bucket")))


@query("time_buckets_daily", _buckets_sql(DAY))
def time_buckets_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    buckets = agg.time_buckets(table(spark, sf_dir, "events"), DAY, "event_type", "ts")
    return buckets.withColumn("bucket", text_time(F.col("bucket")))


# the grid of fortnights goes through Sunday 1970-01-04
_FORTNIGHT, _SUNDAY = 14 * DAY, 3 * DAY


@query(
    "time_buckets_fortnights",
    f"""WITH b AS (SELECT ceil((epoch_us(l_shipdate) / 1e6 - {_SUNDAY}) / {_FORTNIGHT})::BIGINT * {_FORTNIGHT} + {_SUNDAY} AS s,
      count(*) AS n FROM lineitem GROUP BY 1),
    grid AS (SELECT unnest(range((SELECT min(s) FROM b), (SELECT max(s) FROM b) + 1, {_FORTNIGHT})) AS s)
    SELECT strftime(make_timestamp(s * 1000000), '%Y-%m-%d %H:%M:%S') AS bucket, coalesce(n, 0) AS n
    FROM grid LEFT JOIN b USING (s)""",
)
def time_buckets_fortnights(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    buckets = agg.time_buckets(lines, _FORTNIGHT, None, "l_shipdate", anchor=_SUNDAY, right=True)
    return buckets.withColumn("bucket", text_time(F.col("bucket")))


@query(
    "global_totals",
    """SELECT count(*) AS rows, round(sum(value), 3) AS total, round(avg(value), 6) AS mean,
    round(avg(CAST(value IS NULL AS INT)), 6) AS null_share, min(value) AS smallest, max(value) AS largest,
    round((max(epoch_us(ts)) - min(epoch_us(ts))) / 3600e6, 6) AS span_hours,
    round(count(*) / ((max(epoch_us(ts)) - min(epoch_us(ts))) / 3600e6), 6) AS per_hour FROM events""",
)
def global_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    figures = agg.totals(table(spark, sf_dir, "events"), "value", "ts")
    return rounded(figures.withColumn("total", F.round("total", 3)))


@query("exact_quantile", "SELECT round(quantile_cont(l_extendedprice, 0.7), 6) AS q70 FROM lineitem")
def exact_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    bound = agg.exact_quantile(lines, "l_extendedprice", 0.7)
    # the scalar next to the table it was found in, so that the result is a table again
    return lines.agg(F.round(F.max(F.lit(bound)), 6).alias("q70"))


@query(
    "histogram",
    """WITH r AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
    b AS (SELECT least(CAST(floor((value - lo) * 40 / (hi - lo)) AS BIGINT), 39) AS bin, count(*) AS n FROM events, r GROUP BY 1)
    SELECT g.bin, round(lo + g.bin * ((hi - lo) / 40), 6) AS bin_low, round(lo + (g.bin + 1) * ((hi - lo) / 40), 6) AS bin_high,
    coalesce(n, 0) AS n FROM (SELECT unnest(range(40)) AS bin) g LEFT JOIN b USING (bin), r""",
)
def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(agg.histogram(table(spark, sf_dir, "events"), "value", 40))


@query(
    "histogram_with_range",
    """WITH b AS (SELECT least(CAST(floor(l_discount * 10) AS BIGINT), 9) AS bin, count(*) AS n FROM lineitem
      WHERE l_discount BETWEEN 0 AND 1 GROUP BY 1)
    SELECT g.bin, round(g.bin * 0.1, 6) AS bin_low, round((g.bin + 1) * 0.1, 6) AS bin_high, coalesce(n, 0) AS n
    FROM (SELECT unnest(range(10)) AS bin) g LEFT JOIN b USING (bin)""",
)
def histogram_with_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(agg.histogram(table(spark, sf_dir, "lineitem"), "l_discount", 10, 0.0, 1.0))


@query("share_of_rows", "SELECT round(avg(CAST(toxic = 1 AND quality = 0 AS INT)), 6) AS share FROM labels")
def share_of_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = (F.col("toxic") == 1) & (F.col("quality") == 0)
    return rounded(agg.share_of(table(spark, sf_dir, "labels"), bad))


@query(
    "concentration_curve",
    """WITH u AS (SELECT user_id, count(*) AS votes FROM events GROUP BY user_id),
    c AS (SELECT row_number() OVER w AS rank, votes, sum(votes) OVER w AS cumulative FROM u
      WINDOW w AS (ORDER BY votes DESC, user_id ROWS UNBOUNDED PRECEDING))
    SELECT rank, votes, CAST(cumulative AS BIGINT) AS cumulative,
    CAST((SELECT max(cumulative) FROM c) - cumulative AS BIGINT) AS remaining,
    round(((SELECT max(cumulative) FROM c) - cumulative) / ((SELECT max(cumulative) FROM c) - (SELECT max(votes) FROM c)), 6)
      AS remaining_share FROM c""",
)
def concentration_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(curves.concentration_curve(table(spark, sf_dir, "events")))


@query(
    "concentration_steps",
    """WITH u AS (SELECT user_id, count(*) AS votes FROM events GROUP BY user_id),
    s AS (SELECT votes, count(*) AS volunteers FROM u GROUP BY votes)
    SELECT votes, volunteers, CAST(coalesce(sum(volunteers) OVER w, 0) + 1 AS BIGINT) AS first_rank,
    CAST(coalesce(sum(volunteers) OVER w, 0) + volunteers AS BIGINT) AS last_rank,
    CAST(coalesce(sum(votes * volunteers) OVER w, 0) AS BIGINT) AS votes_before FROM s
    WINDOW w AS (ORDER BY votes DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
)
def concentration_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curves.concentration_steps(table(spark, sf_dir, "events"))


@query(
    "running_flag_count",
    """SELECT epoch_us(ts) AS micros, count(*) AS rows, count(*) FILTER (event_type = 'purchase') AS flagged,
    CAST(sum(count(*)) OVER (ORDER BY ts) AS BIGINT) AS rows_so_far,
    CAST(sum(count(*) FILTER (event_type = 'purchase')) OVER (ORDER BY ts) AS BIGINT) AS flagged_so_far
    FROM events GROUP BY ts""",
)
def running_flag_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    running = curves.running_count(table(spark, sf_dir, "events"), F.col("event_type") == "purchase", "ts")
    return running.withColumn("micros", F.unix_micros("time")).drop("time")


@query(
    "classification_counts",
    f"SELECT {CLASSIFICATION_SQL} AS classification_id, count(*) AS n FROM lineitem GROUP BY 1",
)
def classification_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(classification().alias("classification_id"))
    return agg.frequency(rows, "classification_id")
