"""Question dictionary: which questions exist, which answers they allow, and how result columns are named.

A dictionary is small and fixed by whoever designed the decision tree, so it lives in Python. It drives
column lists in one ``select`` each, and becomes a lookup DataFrame (:meth:`QuestionSet.lookup`) where
rows have to be joined with it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# answers per 64-bit vote mask; the sign bit stays free
MASK_BITS = 60


@dataclass(frozen=True)
class Answer:
    name: str
    raw_name: str


@dataclass(frozen=True)
class Question:
    name: str
    raw_name: str
    answers: tuple[Answer, ...]

    @property
    def total_votes(self) -> str:
        return f"{self.name}_total-votes"

    @property
    def prediction(self) -> str:
        return f"{self.name}_prediction"

    @property
    def prediction_conf(self) -> str:
        return f"{self.name}_prediction-conf"

    @property
    def prediction_encoded(self) -> str:
        return f"{self.name}_prediction-encoded"

    @property
    def answer_names(self) -> list[str]:
        return [a.name for a in self.answers]

    @property
    def raw_answer_names(self) -> list[str]:
        return [a.raw_name for a in self.answers]

    def count_column(self, answer: Answer) -> str:
        return f"{self.name}_{answer.name}"

    def raw_count_column(self, answer: Answer) -> str:
        return f"{self.raw_name}_{answer.raw_name}"

    def fraction_column(self, answer: Answer) -> str:
        return f"{self.count_column(answer)}_fraction"

    def min_column(self, answer: Answer) -> str:
        return f"{self.count_column(answer)}_min"

    def max_column(self, answer: Answer) -> str:
        return f"{self.count_column(answer)}_max"

    @property
    def count_columns(self) -> list[str]:
        return [self.count_column(a) for a in self.answers]

    @property
    def raw_count_columns(self) -> list[str]:
        return [self.raw_count_column(a) for a in self.answers]

    @property
    def fraction_columns(self) -> list[str]:
        return [self.fraction_column(a) for a in self.answers]

    def answer(self, name: str) -> Answer:
        return next(a for a in self.answers if a.name == name)

    def answer_from_raw(self, raw_name: str) -> Answer:
        return next(a for a in self.answers if a.raw_name == raw_name)

    def answer_from_count_column(self, column: str) -> Answer:
        return next(a for a in self.answers if self.count_column(a) == column)


@dataclass(frozen=True)
class QuestionSet:
    questions: tuple[Question, ...]

    def __post_init__(self):
        names = [q.name for q in self.questions]
        if len(set(names)) != len(names):
            raise ValueError(f"question names repeat: {names}")

    @classmethod
    def build(cls, *questions: tuple[str, str, dict[str, str]]) -> QuestionSet:
        """From ``(raw question, question, {raw answer: answer})`` entries, in output order."""
        return cls(
            tuple(
                Question(name, raw, tuple(Answer(a, raw_a) for raw_a, a in answers.items()))
                for raw, name, answers in questions
            )
        )

    @property
    def question_names(self) -> list[str]:
        return [q.name for q in self.questions]

    @property
    def raw_question_names(self) -> list[str]:
        return [q.raw_name for q in self.questions]

    def question(self, name: str) -> Question:
        return next(q for q in self.questions if q.name == name)

    def question_from_raw(self, raw_name: str) -> Question:
        return next(q for q in self.questions if q.raw_name == raw_name)

    @cached_property
    def count_columns(self) -> list[str]:
        return [c for q in self.questions for c in q.count_columns]

    @cached_property
    def raw_count_columns(self) -> list[str]:
        return [c for q in self.questions for c in q.raw_count_columns]

    @property
    def fraction_columns(self) -> list[str]:
        return [c for q in self.questions for c in q.fraction_columns]

    @property
    def total_columns(self) -> list[str]:
        return [q.total_votes for q in self.questions]

    @property
    def mask_words(self) -> int:
        """Number of 64-bit words that hold one bit per answer."""
        return -(-len(self.count_columns) // MASK_BITS)

    def mask_bit(self, column: str) -> tuple[int, int]:
        """(word, bit) of a count column inside the vote mask."""
        return divmod(self.count_columns.index(column), MASK_BITS)

    def lookup(self, spark: SparkSession) -> DataFrame:
        """One row per answer: ``q_ord, raw_task, task, a_ord, raw_value, value, word, mask``.

        A local relation with as many rows as the dictionary has answers (tens), so joining it with
        :func:`pyspark.sql.functions.broadcast` is bounded by construction.
        """
        rows = []
        for q_ord, q in enumerate(self.questions):
            for a_ord, a in enumerate(q.answers):
                word, bit = self.mask_bit(q.count_column(a))
                rows.append((q_ord, q.raw_name, q.name, a_ord, a.raw_name, a.name, word, 1 << bit))
        names = ("q_ord", "raw_task", "task", "a_ord", "raw_value", "value", "word", "mask")
        types = (pa.int32(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.int32(), pa.int64())
        arrays = [pa.array(col, t) for col, t in zip(zip(*rows), types)]
        return spark.createDataFrame(pa.table(arrays, names=list(names)))

    def bit_sql(self, column: str, words: list[str]) -> str:
        """SQL for the 0/1 value of a count column, read from the mask word columns."""
        word, bit = self.mask_bit(column)
        return f"(shiftrightunsigned({words[word]}, {bit}) & 1)"
