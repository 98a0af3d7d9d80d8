"""Counts, shares, buckets, histograms and exact quantiles."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from decimal import Decimal
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, IntegralType

from pollfold.functions.columns import c
from pollfold.functions.times import bucket_start, month_key, week_key
from pollfold.functions.votes import share
from pollfold.sources.storage import cut_lineage

HISTOGRAM_STEP = 1 << 14

# columns that a table may get from the values in its rows
MAX_COLUMNS = 2_000


def frequency(df: DataFrame, column: str, with_nulls: bool = False, count: str = "n") -> DataFrame:
    """Rows per value, nulls left out unless asked for."""
    rows = df if with_nulls else df.filter(c(column).isNotNull())
    return rows.groupBy(c(column)).agg(F.count(F.lit(1)).alias(count))


def count_of_counts(df: DataFrame, key: str) -> DataFrame:
    """How many keys occur n times: ``occurrences, keys``."""
    return frequency(df, key, count="occurrences").groupBy("occurrences").agg(F.count(F.lit(1)).alias("keys"))


def distinct_count(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Distinct non-null values per group (or overall). Rows shuffle on (group, value), so hot groups split."""
    return df.groupBy(*[c(b) for b in by]).agg(F.count_distinct(c(column)).alias("n_distinct"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(c(column)).dropna().distinct()


def named_values(values: DataFrame, column: str, most: int = MAX_COLUMNS) -> list[str]:
    """The values of a one-column table, sorted, to name columns by; more than ``most`` are an error, never cut."""
    found = [row[column] for row in values.limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"more than {most} values of {column} to make columns of; use a long or a map form, or give a list")
    return sorted(found)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first by ``order``.

    A ``min_by`` aggregate, not a window: copies of a hot key collapse before the shuffle. Make ``order`` unique
    within a key for a reproducible survivor.
    """
    rest = [name for name in df.columns if name not in set(keys)]
    first = F.min_by(F.struct(*[c(n) for n in rest]), F.struct(*[c(n) for n in order])).alias("first")
    picked = df.groupBy(*[c(k) for k in keys]).agg(first).select(*[c(k) for k in keys], "first.*")
    return picked.select(*[c(n) for n in df.columns])


def answer_shares(values: Column, answers: Mapping[str, str]) -> list[Column]:
    """Aggregates ``{column: answer}`` -> share of that answer."""
    return [share(values == answer).alias(name) for name, answer in answers.items()]


def volunteer_profiles(
    responses: DataFrame,
    question: str,
    answers: Mapping[str, str],
    user: str = "user_id",
    task_col: str = "task",
    value_col: str = "value",
    time_col: str = "created_at",
    subject: str = "subject_id",
) -> DataFrame:
    """Per volunteer, for one question: answer shares, answers given, first and last activity, subjects seen.

    All aggregates combine before the shuffle, so a volunteer with a large part of all votes is no hot spot.
    """
    return (
        responses.filter((c(task_col) == question) & c(user).isNotNull())
        .groupBy(c(user))
        .agg(
            *answer_shares(c(value_col), answers),
            F.count(c(value_col)).alias("answers"),
            F.min(c(time_col)).alias("first_active"),
            F.max(c(time_col)).alias("last_active"),
            F.count(c(subject)).alias("subjects"),
        )
    )


def shares_per_week(
    responses: DataFrame, answers: Mapping[str, str], value_col: str = "value", time_col: str = "created_at"
) -> DataFrame:
    """Answer shares and number of answers per ISO week."""
    weeks = responses.groupBy(week_key(c(time_col)).alias("week_year"))
    return weeks.agg(*answer_shares(c(value_col), answers), F.count(c(value_col)).alias("answers"))


def cohort_months(
    responses: DataFrame,
    answer: str,
    min_votes: int = 20,
    strict: bool = False,
    subject: str = "subject_id",
    value_col: str = "value",
    time_col: str = "created_at",
) -> DataFrame:
    """Share of one answer per month, cohort and subject.

    Subjects with at least ``min_votes`` votes (more than, with ``strict``) are the test cohort. The cohort is read
    off the monthly counts, so the votes are shuffled once, already combined; the window sees one row per month.
    """
    monthly = responses.groupBy(c(subject), month_key(c(time_col)).alias("month")).agg(
        F.count(F.lit(1)).alias("votes"),
        F.count_if(c(value_col) == answer).alias("chosen"),
    )
    everything = F.sum("votes").over(Window.partitionBy(c(subject)))
    in_test = everything > min_votes if strict else everything >= min_votes
    return monthly.select(
        c(subject),
        "month",
        in_test.alias("in_test"),
        "votes",
        (F.col("chosen") / F.col("votes")).alias("answer_share"),
    )


def totals(df: DataFrame, column: str, time_col: str | None = None) -> DataFrame:
    """One row of global figures of a column: rows, sum, mean, null share, min, max (and time span, rate per hour)."""
    figures = [
        F.count(F.lit(1)).alias("rows"),
        F.sum(c(column)).alias("total"),
        F.avg(c(column)).alias("mean"),
        share(c(column).isNull()).alias("null_share"),
        F.min(c(column)).alias("smallest"),
        F.max(c(column)).alias("largest"),
    ]
    if time_col is not None:
        span = F.unix_micros(F.max(c(time_col))) - F.unix_micros(F.min(c(time_col)))
        hours = span / F.lit(3600e6)
        figures += [hours.alias("span_hours"), F.try_divide(F.count(F.lit(1)).cast("double"), hours).alias("per_hour")]
    return df.agg(*figures)


def share_of(df: DataFrame, condition: Column, name: str = "share") -> DataFrame:
    return df.agg(share(condition).alias(name))


def time_buckets(
    df: DataFrame, seconds: int, by: str | None = None, time_col: str = "created_at", anchor: int = 0, right: bool = False
) -> DataFrame:
    """Rows per time bucket (and value of ``by``), with zero rows for empty buckets: ``bucket, [by,] n``.

    Buckets are left-closed and labelled by their start, on a grid through ``anchor`` (epoch seconds). ``right``
    makes them right-closed and labels them by their end, the convention of fortnight resampling; anchor it at
    a Sunday. The calendar has one entry per bucket between the first and the last, however many rows there are.
    """
    ts = c(time_col)
    if right:
        shifted = F.timestamp_micros(F.unix_micros(ts) - F.lit(1))
        bucket = bucket_start(shifted, seconds, anchor) + F.make_dt_interval(secs=F.lit(seconds))
    else:
        bucket = bucket_start(ts, seconds, anchor)
    keys = [bucket.alias("bucket")] + ([c(by)] if by else [])
    counted = df.filter(ts.isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    low, high = counted.select(F.min("bucket")).scalar(), counted.select(F.max("bucket")).scalar()
    slots = F.explode(F.sequence(low, high, F.make_dt_interval(secs=F.lit(seconds)))).alias("bucket")
    if by:
        calendar, on = counted.select(c(by)).distinct().select(slots, c(by)), ["bucket", by]
    else:
        calendar, on = counted.sparkSession.range(1).select(slots), ["bucket"]
    return calendar.join(counted, on, "left").na.fill(0, subset=["n"])


def histogram(df: DataFrame, column: str, bins: int, low: float | None = None, high: float | None = None) -> DataFrame:
    """Rows per equal-width bin: ``bin, bin_low, bin_high, n``, empty bins included.

    Without range the data's own is used (one more pass). The last bin includes its upper end; values outside the
    range and nulls are left out.
    """
    value = c(column).cast("double")
    if low is None or high is None:
        found = df.agg(F.min(value).alias("low"), F.max(value).alias("high")).first()
        low = found["low"] if low is None else low
        high = found["high"] if high is None else high
    if low is None:
        low, high = 0.0, 1.0
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    position = F.floor((value - F.lit(low)) * F.lit(bins) / F.lit(high - low))
    counted = (
        df.filter((value >= low) & (value <= high))
        .groupBy(F.least(position, F.lit(bins - 1)).cast("bigint").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    edges = df.sparkSession.range(bins).select(
        F.col("id").alias("bin"),
        (F.lit(float(low)) + F.col("id") * F.lit(width)).alias("bin_low"),
        (F.lit(float(low)) + (F.col("id") + 1) * F.lit(width)).alias("bin_high"),
    )
    return edges.join(counted, "bin", "left").na.fill(0, subset=["n"])


def exact_quantile(df: DataFrame, column: str, q: float) -> int | float | Decimal | None:
    """Exact quantile with linear interpolation, at any table size; null when there are no values.

    A value of the column keeps its type, so whole numbers stay exact; one between two values is a float.
    """
    rows = cut_lineage(_numbers(df, column))
    n = rows.count()
    if n == 0:
        return None
    place = q * (n - 1)
    rank = math.floor(place)
    lower = _at_rank(rows, rank)
    if place == rank:
        return lower
    # the next value in order is the same one again or the smallest larger one
    after = rows.agg(
        F.count_if(F.col("v") <= F.lit(lower)).alias("n"), F.min(F.when(F.col("v") > F.lit(lower), F.col("v"))).alias("next")
    ).first()
    upper = lower if after["n"] > rank + 1 else after["next"]
    if upper == lower:
        return lower
    if isinstance(lower, float):
        return lower + (upper - lower) * (place - rank)
    return float(Fraction(lower) + (Fraction(upper) - Fraction(lower)) * Fraction(place - rank))


def value_at_rank(df: DataFrame, column: str, rank: int) -> int | float | Decimal:
    """The value with ``rank`` values before it in ascending order; nulls and NaN don't count.

    No buffer ever holds the column. Each pass counts the values in :data:`HISTOGRAM_STEP` bins of the current range and
    goes on inside the bin that holds the wanted rank, until that bin has a single value. A pass returns at most
    one row per bin, and a value that fills much of the table is one bin entry like any other. Whole and decimal numbers
    are never made floats; infinite values are counted apart, for they have no bin.
    """
    return _at_rank(cut_lineage(_numbers(df, column)), rank)


def _at_rank(rows: DataFrame, rank: int) -> int | float | Decimal:
    v, exact = F.col("v"), rows.schema["v"].dataType != DoubleType()
    if not exact:
        least, most = F.lit(float("-inf")), F.lit(float("inf"))
        inside = (v > least) & (v < most)
        found = rows.agg(F.count_if(v == least).alias("below"), F.count_if(inside).alias("n")).first()
        if rank < found["below"]:
            return float("-inf")
        if rank >= found["below"] + found["n"]:
            return float("inf")
        rows, rank = rows.filter(inside), rank - found["below"]
    ends = rows.agg(F.min("v").alias("low"), F.max("v").alias("high")).first()
    low, high = ends["low"], ends["high"]
    while low < high:
        inside = rows.filter((v >= F.lit(low)) & (v <= F.lit(high)))
        bins = inside.groupBy(_bin(low, high, exact).alias("bin")).agg(
            F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")
        )
        before = low, high
        for entry in sorted(bins.collect(), key=lambda b: b["bin"]):
            if rank < entry["n"]:
                low, high = entry["low"], entry["high"]
                break
            rank -= entry["n"]
        if (low, high) == before:
            raise ArithmeticError(f"values from {low} to {high} cannot be told apart by bins")
    return low


def _bin(low: int | float | Decimal, high: int | float | Decimal, exact: bool) -> Column:
    """Number of the bin of ``v`` between the ends of the range."""
    if not exact:
        # the range times the number of bins has to be finite
        scale = 2.0**-20 if high / 2 - low / 2 > 1e300 else 1.0
        return F.width_bucket(F.col("v") * scale, F.lit(low * scale), F.lit(high * scale), F.lit(HISTOGRAM_STEP))
    if isinstance(low, Decimal):
        width = max((high - low) / HISTOGRAM_STEP, Decimal(1).scaleb(low.as_tuple().exponent))
        return F.floor((F.col("v") - F.lit(low)) / F.lit(width))
    # the range of whole numbers can be wider than a bigint
    width = -(-(high - low) // HISTOGRAM_STEP)
    return F.floor((F.col("v").cast("decimal(20,0)") - F.lit(Decimal(low))) / F.lit(Decimal(width)))


def _numbers(df: DataFrame, column: str) -> DataFrame:
    """The values as ``v``: bigint, decimal or double."""
    rows = df.select(c(column).alias("v"))
    kind = rows.schema["v"].dataType
    if isinstance(kind, IntegralType):
        return rows.select(F.col("v").cast("bigint").alias("v")).filter("v is not null")
    if isinstance(kind, DecimalType):
        return rows.filter("v is not null")
    return rows.select(F.col("v").cast("double").alias("v")).filter("v is not null and not isnan(v)")
