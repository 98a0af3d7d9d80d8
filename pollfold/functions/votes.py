"""Expressions on vote counts."""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(counts: Sequence[Column]) -> Column:
    """Sum of count columns."""
    out = counts[0]
    for count in counts[1:]:
        out = out + count
    return out


def fraction(count: Column, of: Column, null_when_empty: bool = False) -> Column:
    """count / total; 0 (or null) when there were no votes."""
    share = F.try_divide(count.cast("double"), of.cast("double"))
    return share if null_when_empty else F.coalesce(share, F.lit(0.0))


def largest(counts: Sequence[Column]) -> Column:
    present = [F.coalesce(n, F.lit(0)) for n in counts]
    return present[0] if len(present) == 1 else F.greatest(*present)


def arg_max(names: Sequence[str], counts: Sequence[Column], best: Column | None = None) -> Column:
    """Name of the largest count (``best``, if at hand); the first listed wins a tie; null counts as 0."""
    best = largest(counts) if best is None else best
    out = F.lit(names[-1])
    for name, n in list(zip(names, counts))[-2::-1]:
        out = F.when(F.coalesce(n, F.lit(0)) == best, F.lit(name)).otherwise(out)
    return out


def confidence(counts: Sequence[Column], best: Column | None = None) -> Column:
    """Largest count (``best``, if at hand) / total; 1 / number of answers when there were no votes."""
    best = largest(counts) if best is None else best
    present = [F.coalesce(n, F.lit(0)) for n in counts]
    share = F.try_divide(best.cast("double"), total(present).cast("double"))
    return F.coalesce(share, F.lit(1.0 / len(counts)))


def label_code(prediction: Column, names: Sequence[str]) -> Column:
    """Alphabetical rank of the answer within its question; an unknown answer raises, null stays null."""
    out = F.when(prediction.isNull(), F.lit(None).cast("int"))
    for code, name in enumerate(sorted(names)):
        out = out.when(prediction == name, F.lit(code))
    return out.otherwise(F.raise_error(F.concat(F.lit("unknown answer "), prediction)).cast("int"))


def wilson_interval(k: Column, n: Column, interval: float = 0.8) -> tuple[Column, Column]:
    """(low, high) of the Wilson score interval for k of n votes; null when n is 0."""
    z = NormalDist().inv_cdf(0.5 + interval / 2)
    n = n.cast("double")
    p = F.try_divide(k.cast("double"), n)
    shrink = F.lit(1.0) + F.try_divide(F.lit(z * z), n)
    centre = p + F.try_divide(F.lit(z * z / 2), n)
    inner = F.try_divide(p * (F.lit(1.0) - p), n) + F.try_divide(F.lit(z * z / 4), n * n)
    spread = F.lit(z) * F.sqrt(inner)
    return F.try_divide(centre - spread, shrink), F.try_divide(centre + spread, shrink)


def wilson_width(k: Column, n: Column, interval: float = 0.8) -> Column:
    low, high = wilson_interval(k, n, interval)
    return high - low


def bernoulli_mean(k: Column, n: Column) -> Column:
    return F.try_divide(k.cast("double"), n.cast("double"))


def bernoulli_variance(k: Column, n: Column) -> Column:
    """p (1 - p) / n."""
    p = bernoulli_mean(k, n)
    return F.try_divide(p * (F.lit(1.0) - p), n.cast("double"))


def vote_vector(k: Column, n: Column) -> Column:
    """The n votes on a question as 1 (this answer) and 0 (another), ones first."""
    return F.concat(F.array_repeat(F.lit(1), k.cast("int")), F.array_repeat(F.lit(0), (n - k).cast("int")))


def one_hot(answer: Column, value: str) -> Column:
    return answer.eqNullSafe(F.lit(value)).cast("int")


def share(condition: Column) -> Column:
    """Aggregate: share of rows that satisfy a condition; a null condition counts as not satisfied."""
    return F.avg(F.coalesce(condition, F.lit(False)).cast("double"))
