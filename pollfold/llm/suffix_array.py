"""Suffix-array dedup: repeated strings of a least length from a Burrows-Wheeler transform, by interval expansion."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from pollfold.llm.passages import Passages, without_repeats

LEAST_BYTES = 100
CORE_BYTES = 20


def sorted_suffixes(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(places in the order of their next ``depth`` symbols at least, rank of every place: equal where these are), by doubling.

    The first step sorts as many symbols as fit in one number."""
    n = len(text)
    width = max(int(text.max(initial=0)).bit_length(), 1)
    known = max(1, min(62 // width, depth))
    padded = np.concatenate([text, np.zeros(known, np.int64)]).astype(np.int64)
    key = padded[:n].copy()
    for k in range(1, known):
        key = (key << width) | padded[k : n + k]
    while True:
        order = np.argsort(key)
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([np.zeros(min(n, 1), np.int64), np.cumsum(np.diff(ordered) != 0)])
        if known >= depth or not n or rank[order[-1]] == n - 1:
            return order, rank
        far = np.zeros(n, np.int64)
        far[: max(n - known, 0)] = rank[known:] + 1
        key = rank * (n + 2) + far
        known *= 2


def common_prefixes(text: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix order, ``known``): length of the common prefix with the suffix before where it is below ``least``, else -1.

    Starts with the interval of every symbol. A step prepends every symbol that the transform has in an interval, breadth
    first, so the strings of all intervals have the same length and common prefixes come out by increasing value: the
    right end of a new interval is where suffixes stop sharing its string. An interval whose right end is known already
    is not extended (Beller et al. 2013). Symbol 0 separates texts; nothing is prepended beyond it.

    A symbol's last row in an interval is one whose next row of that symbol lies beyond the interval; its first row is
    found among the symbol's rows. Both lead to the ends of the new interval, so rows of an interval are looked at
    but not sorted. Suffixes that agree beyond ``least`` symbols are one run, in any order inside.
    """
    text = np.append(text, 0)  # read in a circle, every suffix has a symbol before it
    order, rank = sorted_suffixes(text, least + 1)
    n = len(text)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    start = np.flatnonzero(np.concatenate([[True], np.diff(rank[order]) != 0]))
    before = text[order - 1]
    run_of = rank[order - 1]
    low_after, high_after = start[run_of], np.append(start[1:], n)[run_of]
    by_symbol = np.argsort(before, kind="stable")
    grouped = before[by_symbol]
    same = grouped[1:] == grouped[:-1]
    next_same = np.full(n, n, np.int64)
    next_same[by_symbol[:-1][same]] = by_symbol[1:][same]
    listed = grouped * (n + 1) + by_symbol
    known = np.full(n + 1, -1, np.int64)
    edge = np.flatnonzero(~same) + 1
    low, high = np.concatenate([[0], edge]), np.concatenate([edge, [n]])
    known[high] = 0
    for length in range(1, least):
        size = high - low
        many = size > 1
        begin, end, wide = low[many], high[many], size[many]
        rows = np.arange(wide.sum()) + np.repeat(begin - np.cumsum(wide) + wide, wide)
        last = next_same[rows] >= np.repeat(end, wide)
        rows, begin = rows[last], np.repeat(begin, wide)[last]
        first = by_symbol[np.searchsorted(listed, before[rows] * (n + 1) + begin)]
        rows, first = np.concatenate([rows, low[~many]]), np.concatenate([first, low[~many]])
        inner = before[rows] > 0
        rows, first = rows[inner], first[inner]
        if not len(rows):
            break
        stop = high_after[rows]
        fresh = known[stop] < 0
        low, high = low_after[first[fresh]], stop[fresh]
        known[high] = length
    return order, known[:n]


def repeat_classes(text: np.ndarray, length: int) -> np.ndarray:
    """For every place a number that is equal for equal strings of ``length`` symbols, -1 where the string occurs once."""
    order, known = common_prefixes(text, length)
    known[0] = 0
    run = np.cumsum(known >= 0)
    size = np.bincount(run)
    out = np.empty(len(order), np.int64)
    out[order] = np.where(size[run] > 1, run, -1)
    return out[: len(text)]


BYTES = Passages(LEAST_BYTES, CORE_BYTES, of_words=False, same_document=True, classes=repeat_classes)


def suffix_array_dedup(docs: DataFrame, kind: Passages = BYTES) -> DataFrame:
    """(doc_id, n, n_removed, n_spans, kept_sha256) of every document, in UTF-8 bytes.

    Every byte goes that a string of ``kind.length`` bytes covers which also starts earlier: in a document with a smaller
    id, or before in the same one. Strings don't cross documents and are judged on the input.

    Null and empty texts have no bytes. Rows without id come after all others, as one document. Rows with the same id are
    one document, with places side by side: repeated rows keep the same. Texts of any length are read whole; an empty
    table gives none; other columns are ignored.
    """
    return without_repeats(kind, docs.select("doc_id", "text"))
