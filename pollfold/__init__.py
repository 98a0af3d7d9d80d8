"""Crowd-sourced decision-tree answers to analysis-ready tables, as plain Spark DataFrame operators."""

from pollfold.dictionary import Answer, Question, QuestionSet
from pollfold.plans.derive import derive
from pollfold.plans.flatten import flatten
from pollfold.plans.predict import predict, votes_to_predictions
from pollfold.plans.reduce import reduce_responses, reduce_votes

__all__ = [
    "Answer",
    "Question",
    "QuestionSet",
    "derive",
    "flatten",
    "predict",
    "reduce_responses",
    "reduce_votes",
    "votes_to_predictions",
]
