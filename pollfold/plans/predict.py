"""Reduced counts to predicted answers, confidences, codes and intervals: projections only, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pollfold.dictionary import QuestionSet
from pollfold.functions.columns import c
from pollfold.functions.votes import arg_max, confidence, label_code, largest, total, wilson_interval
from pollfold.plans.reduce import reduce_votes


def predict(reduced: DataFrame, dictionary: QuestionSet, interval: float | None = None) -> DataFrame:
    """Add ``_prediction``, ``_prediction-conf`` and ``_prediction-encoded`` per question.

    The prediction is the most frequent answer, the first listed one on a tie. The code is its alphabetical rank.
    ``interval`` (0.8, say) adds ``_min`` and ``_max`` of the Wilson interval per answer.
    """
    questions = dictionary.questions
    # step by step, each referring to the columns of the one before, so that expressions stay short
    most = {f"__most_{i}": largest([c(n) for n in q.count_columns]) for i, q in enumerate(questions)}
    named = {
        q.prediction: arg_max(q.answer_names, [c(n) for n in q.count_columns], F.col(f"__most_{i}"))
        for i, q in enumerate(questions)
    }
    rest = {}
    for q in questions:
        counts = [c(n) for n in q.count_columns]
        rest[q.prediction_conf] = confidence(counts, F.col(f"__most_{questions.index(q)}"))
        rest[q.prediction_encoded] = label_code(c(q.prediction), q.answer_names)
        if interval is not None:
            for a in q.answers:
                low, high = wilson_interval(c(q.count_column(a)), total(counts), interval)
                rest[q.min_column(a)], rest[q.max_column(a)] = low, high
    return reduced.withColumns(most).withColumns(named).withColumns(rest).drop(*most)


def votes_to_predictions(
    votes: DataFrame, dictionary: QuestionSet, key: str = "subject_id", interval: float | None = None
) -> DataFrame:
    return predict(reduce_votes(votes, dictionary, key), dictionary, interval)
