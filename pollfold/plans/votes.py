"""Vote tables: one row per classification, one 0/1 column per answer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pollfold.dictionaries import DR2, UKIDSS
from pollfold.dictionary import QuestionSet
from pollfold.functions.columns import c, quoted
from pollfold.functions.votes import one_hot
from pollfold.operators.checks import assert_same_vocabulary
from pollfold.operators.joins import remove_ids
from pollfold.operators.sets import stack
from pollfold.operators.shaping import rename_raw_counts
from pollfold.plans.reduce import classification_masks
from pollfold.sources.storage import cut_lineage

VOTE_KEYS = ("classification_id", "created_at", "user_id", "subject_id")
RARE_SHARE = 0.0001  # answers rarer than 1 in 10,000 are left over from trial workflows (fixed value)


def responses_to_votes(
    responses: DataFrame,
    dictionary: QuestionSet,
    question: str = "question",
    response: str = "response",
    keys: Sequence[str] = VOTE_KEYS,
) -> DataFrame:
    """One row per classification: the keys, then a 0/1 int column per answer.

    One shuffle on the full key with a one-long buffer; the columns are unpacked afterwards. Questions that nobody
    answered have zero columns. ``created_at`` is parsed when it is text.
    """
    df = responses
    if "created_at" in keys and dict(df.dtypes)["created_at"] == "string":
        df = df.withColumn("created_at", F.to_timestamp("created_at"))
    masks = classification_masks(df, dictionary, keys, question, response)
    words = [f"mask_{w}" for w in range(dictionary.mask_words)]
    bits = [f"CAST({dictionary.bit_sql(n, words)} AS INT) AS {quoted(n)}" for n in dictionary.count_columns]
    return masks.selectExpr(*[quoted(k) for k in keys], *bits)


def remove_rare_answers(
    coded: DataFrame, dictionary: QuestionSet, min_share: float = RARE_SHARE, all_rare: bool = False
) -> DataFrame:
    """Drop the rows with a rare answer, question after question; rows without an answer stay.

    For each question in turn, its rarest answer is removed if it makes up less than ``min_share`` of the rows still
    there, so at most one answer per question goes (of equally rare ones the alphabetically first). ``all_rare``
    removes every rare answer, measured against all rows.

    The table is read once for this: rows are counted per combination of answers, and the steps run on that
    small count table, which is checkpointed.
    """
    names = dictionary.raw_question_names
    combos = cut_lineage(coded.groupBy(*[c(n) for n in names]).agg(F.count(F.lit(1)).alias("__n")))
    answers_of = lambda left, name: left.filter(c(name).isNotNull()).groupBy(c(name).alias(name)).agg(F.sum("__n").alias("__sum"))
    if all_rare:
        # rare answers may be many, so they stay a table; all questions are judged by the full count
        whole = combos.agg(F.sum("__n")).first()[0] or 0
        kept = coded
        for name in names:
            kept = remove_ids(kept, answers_of(combos, name).filter(F.col("__sum") < whole * min_share), name)
        return kept
    removed: list[tuple[str, str]] = []
    for name in names:
        left = _without(combos, removed)
        rows = left.agg(F.sum("__n")).first()[0] or 0
        found = answers_of(left, name).orderBy("__sum", c(name)).limit(1).filter(F.col("__sum") < rows * min_share).collect()
        removed += [(name, row[name]) for row in found]
    return _without(coded, removed)


def _without(df: DataFrame, removed: Sequence[tuple[str, str]]) -> DataFrame:
    for name, answer in removed:
        df = df.filter(~c(name).eqNullSafe(F.lit(answer)))
    return df


def one_hot_votes(coded: DataFrame, dictionary: QuestionSet) -> DataFrame:
    """Wide coded export plus a 0/1 column per (raw question, raw answer)."""
    fresh = coded.drop(*dictionary.raw_count_columns)
    columns = [
        one_hot(c(q.raw_name), a.raw_name).alias(q.raw_count_column(a)) for q in dictionary.questions for a in q.answers
    ]
    return fresh.select("*", *columns)


def coded_export_to_votes(coded: DataFrame, dictionary: QuestionSet = UKIDSS, min_share: float = RARE_SHARE) -> DataFrame:
    """Coded export of one survey to a vote table with published column names."""
    kept = remove_rare_answers(coded, dictionary, min_share)
    return rename_raw_counts(one_hot_votes(kept, dictionary), dictionary)


def coded_releases_to_votes(
    first: DataFrame, second: DataFrame, dictionary: QuestionSet = DR2, min_share: float = RARE_SHARE
) -> DataFrame:
    """Two coded releases of one survey to one vote table; both must use the same answers."""
    parts = [remove_rare_answers(part, dictionary, min_share) for part in (first, second)]
    assert_same_vocabulary(parts[0], parts[1], dictionary.raw_question_names)
    return rename_raw_counts(one_hot_votes(stack(parts), dictionary), dictionary)
