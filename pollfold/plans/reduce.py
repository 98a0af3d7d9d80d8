"""Responses or votes to one row per subject: counts, totals, fractions.

Shape of the plan. Every answer of the dictionary is one bit of a 64-bit vote mask, so the answers of a
classification are one ``bit_or``: a buffer of one long that combines in the scan task (annotations of a record
sit together) and makes repeated responses harmless. Masks are then counted per (subject, mask), which
splits a subject with a large part of all votes over the tasks that read it and leaves one row per distinct
path through the decision tree. Only these few rows go by subject, where the wide columns are first made.
No wide row is ever shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pollfold.dictionaries import DR5
from pollfold.dictionary import QuestionSet
from pollfold.functions.columns import c, quoted
from pollfold.operators.joins import remove_people


def classification_masks(
    responses: DataFrame,
    dictionary: QuestionSet,
    keys: Sequence[str],
    question: str = "question",
    response: str = "response",
) -> DataFrame:
    """One row per key with the vote mask words ``mask_0``, ...; answers outside the dictionary set no bit."""
    lookup = dictionary.lookup(responses.sparkSession).select(
        F.col("task").alias("__task"), F.col("value").alias("__value"), "word", "mask"
    )
    rows = responses.select(*[c(k) for k in keys], c(question).alias("__q"), c(response).alias("__r"))
    known = rows.join(
        F.broadcast(lookup), (F.col("__q") == F.col("__task")) & (F.col("__r") == F.col("__value")), "left"
    )
    words = [
        F.coalesce(F.bit_or(F.when(F.col("word") == w, F.col("mask"))), F.lit(0).cast("bigint")).alias(f"mask_{w}")
        for w in range(dictionary.mask_words)
    ]
    return known.groupBy(*[c(k) for k in keys]).agg(*words)


def reduce_responses(
    responses: DataFrame,
    dictionary: QuestionSet = DR5,
    key: str = "subject_id",
    drop_people: Sequence[str] | DataFrame = (),
    classification: str = "classification_id",
    question: str = "question",
    response: str = "response",
    person: str = "person_id",
    null_fraction: bool = False,
) -> DataFrame:
    """One row per subject: ``{question}_{answer}`` counts, ``{question}_total-votes``, ``{...}_fraction``.

    A classification counts once per answer. Answers nobody gave have 0; answers outside the dictionary are ignored;
    rows without subject are dropped. Fractions of a question without votes are 0 (null with ``null_fraction``).
    """
    rows = responses.filter(c(key).isNotNull())
    if isinstance(drop_people, DataFrame) or drop_people:
        rows = remove_people(rows, drop_people, person)
    masks = classification_masks(rows, dictionary, [key, classification], question, response)
    return reduce_paths(count_paths(masks, dictionary, key), dictionary, key, null_fraction)


def count_paths(masks: DataFrame, dictionary: QuestionSet, key: str = "subject_id") -> DataFrame:
    """(key, mask words, __n): how many classifications of a subject took each path through the decision tree.

    Such tables of disjoint sets of classifications add up, so they are the state that an incremental reduction keeps."""
    return masks.groupBy(c(key), *mask_columns(dictionary)).agg(F.count(F.lit(1)).alias("__n"))


def mask_columns(dictionary: QuestionSet) -> list[str]:
    return [f"mask_{w}" for w in range(dictionary.mask_words)]


def reduce_paths(paths: DataFrame, dictionary: QuestionSet, key: str = "subject_id", null_fraction: bool = False) -> DataFrame:
    """The wide table of path counts, which may come in several rows per path."""
    words = mask_columns(dictionary)
    by_subject = paths.repartition(c(key))
    counts = by_subject.groupBy(c(key)).agg(
        *[F.expr(f"sum(__n * {dictionary.bit_sql(name, words)}) AS {quoted(name)}") for name in dictionary.count_columns]
    )
    return with_totals(counts, dictionary, [key], null_fraction)


def reduce_votes(
    votes: DataFrame, dictionary: QuestionSet, key: str = "subject_id", null_fraction: bool = False
) -> DataFrame:
    """Sum a 0/1 vote table (one row per classification) by subject; null counts as 0.

    Equal vote rows are counted per subject first, so that the sums by subject see one row per distinct row.
    """
    names = dictionary.count_columns
    listed = ", ".join(f"CAST(coalesce({quoted(n)}, 0) AS BIGINT)" for n in names)
    packed = votes.filter(c(key).isNotNull()).select(c(key), F.expr(f"array({listed}) AS __votes"))
    rows = packed.groupBy(c(key), "__votes").agg(F.count(F.lit(1)).alias("__n")).repartition(c(key))
    counts = rows.groupBy(c(key)).agg(*[F.expr(f"sum(__n * __votes[{i}]) AS {quoted(n)}") for i, n in enumerate(names)])
    return with_totals(counts, dictionary, [key], null_fraction)


def with_totals(
    counts: DataFrame, dictionary: QuestionSet, keep: Sequence[str], null_fraction: bool = False
) -> DataFrame:
    """Add totals and fractions to a count table, columns in dictionary order.

    Two projections: totals become columns before fractions refer to them, which keeps the expressions linear in the
    number of answers. They are written as SQL text, one driver call per column instead of one per term.
    """
    totals = [f"{' + '.join(quoted(n) for n in q.count_columns)} AS {quoted(q.total_votes)}" for q in dictionary.questions]
    counted = counts.selectExpr(*[quoted(k) for k in keep], *[quoted(n) for n in dictionary.count_columns], *totals)
    empty = "NULL" if null_fraction else "0D"
    shares = [
        f"coalesce(try_divide(CAST({quoted(q.count_column(a))} AS DOUBLE), CAST({quoted(q.total_votes)} AS DOUBLE)), {empty})"
        f" AS {quoted(q.fraction_column(a))}"
        for q in dictionary.questions
        for a in q.answers
    ]
    return counted.selectExpr("*", *shares)
