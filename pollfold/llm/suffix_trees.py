"""Substring dedup: sorted suffixes of groups with a common part; runs that share enough are the deep nodes of their suffix tree."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pollfold.llm.common import GAP
from pollfold.llm.passages import Passages, without_repeats
from pollfold.llm.suffix_array import sorted_suffixes

WINDOW_WORDS = 50
CORE_WORDS = 8


def shared_prefixes(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Symbols that each suffix shares with the one before in ``order``, ``most`` at most; 0 is shared with nothing."""
    shared = np.zeros(len(order), np.int64)
    live = np.arange(1, len(order))
    for step in range(most):
        a, b = order[live] + step, order[live - 1] + step
        inside = (a < len(text)) & (b < len(text))
        live, a, b = live[inside], a[inside], b[inside]
        live = live[(text[a] == text[b]) & (text[a] > 0)]
        if not len(live):
            break
        shared[live] += 1
    return shared


def deep_nodes(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(suffix order, first leaf, last leaf) of the topmost internal nodes of the suffix tree that are ``depth`` or deeper.

    In the order of the leaves a node is a run of suffixes that share more than their neighbours do; the topmost deep
    nodes are the longest runs that share ``depth`` symbols.
    """
    order, _ = sorted_suffixes(text, depth)
    shared = shared_prefixes(text, order, depth) >= depth
    edge = np.diff(np.concatenate([[False], shared, [False]]).astype(np.int8))
    return order, np.flatnonzero(edge == 1) - 1, np.flatnonzero(edge == -1) - 1


def repeat_classes(text: np.ndarray, length: int) -> np.ndarray:
    """For every place the number of its deep node, -1 where there is none."""
    order, first, last = deep_nodes(text, length)
    out = np.full(len(text), -1, np.int64)
    size = last - first + 1
    rows = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size)
    out[order[rows]] = np.repeat(np.arange(len(first)), size)
    return out


WORDS = Passages(WINDOW_WORDS, CORE_WORDS, of_words=True, same_document=False, classes=repeat_classes)


def substring_dedup(docs: DataFrame, kind: Passages = WORDS) -> DataFrame:
    """(doc_id, n, n_removed, n_spans, kept_sha256) of every document, in words between the six ASCII spaces.

    Every word goes that a window of ``kind.length`` words covers which also starts in a document with a smaller id;
    windows are judged on the input. The digest is that of the kept words joined by one space.

    Null, empty and blank texts have no words. Rows without id come after all others and repeat none of each other; rows
    with the same id don't either. Texts of any length are read whole; an empty table gives none; other columns are
    ignored.
    """
    text = F.trim(F.regexp_replace("text", GAP, " "))
    return without_repeats(kind, docs.select("doc_id", text.alias("text")))
