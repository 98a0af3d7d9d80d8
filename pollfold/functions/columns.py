"""Column-name helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """Name for use in SQL text; hyphens and dots in it are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def c(name: str) -> Column:
    """Column by exact name."""
    return F.col(quoted(name))


def question_answer(question: str = "question", response: str = "response") -> Column:
    """``{question}_{response}``, null when either side is null (``concat_ws`` would hide that)."""
    return F.concat(c(question), F.lit("_"), c(response))
