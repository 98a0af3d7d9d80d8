"""Benchmark decontamination: exact hits of item pieces, verified with Myers' bit-parallel edit distance."""

from __future__ import annotations

from collections import defaultdict

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pollfold.llm.common import add_columns, columns_of, saved

# one edit allowed for so many characters of an item
CHARS_PER_ERROR = 20
# characters of items that one task holds at a time; more items are matched block after block
BLOCK_CHARS = 2_000_000
ITEM = "array<struct<item_id: bigint, distance: int, stop: int>>"


def normal(text: str) -> str:
    """Lower case, every run of white space one space."""
    return " ".join(text.lower().split())


def errors(item: str) -> int:
    return len(item) // CHARS_PER_ERROR


def pieces(item: str) -> list[tuple[int, str]]:
    """(offset, piece): one more piece than errors are allowed, so that one of them is intact in every match."""
    n = errors(item) + 1
    cuts = [len(item) * k // n for k in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def masks(item: str) -> dict[str, int]:
    out: dict[str, int] = defaultdict(int)
    for i, c in enumerate(item):
        out[c] |= 1 << i
    return dict(out)


def closest(item_masks: dict[str, int], length: int, text: str) -> tuple[int, int]:
    """(distance, end) of the substring of ``text`` that is closest to the item, the first of equals (Myers 1999).

    Bits of ``up`` and ``down`` say where the column of the distance table rises and falls; ``score`` is its last entry.
    """
    full, top = (1 << length) - 1, 1 << (length - 1)
    up, down, score = full, 0, length
    best, stop = length, 0
    for at, c in enumerate(text, 1):
        eq = item_masks.get(c, 0)
        x = eq | down
        d0 = ((((x & up) + up) ^ up) | x) & full
        rise, fall = down | (full & ~(d0 | up)), d0 & up
        if rise & top:
            score += 1
        elif fall & top:
            score -= 1
        shifted = (rise << 1) & full
        up, down = ((fall << 1) | (full & ~(d0 | shifted))) & full, d0 & shifted
        if score < best:
            best, stop = score, at
            if not best:
                break
    return best, stop


class Items:
    """The pieces of a block of items in one automaton."""

    def __init__(self, items: list[tuple[int | None, str]]):
        by_text: dict[str, list[int | None]] = defaultdict(list)
        for item_id, text in items:
            by_text[normal(text)].append(item_id)
        self.texts = sorted(t for t in by_text if t)
        self.ids = [by_text[t] for t in self.texts]
        self.masks: dict[int, dict[str, int]] = {}
        where: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for k, text in enumerate(self.texts):
            for offset, piece in pieces(text):
                where[piece].append((k, offset + len(piece)))
        self.automaton = ahocorasick.Automaton()
        for piece, places in where.items():
            self.automaton.add_word(piece, places)
        if self.texts:
            self.automaton.make_automaton()

    def matches(self, text: str | None) -> list[dict]:
        """Items within their error budget of a part of the text: the least distance and its first end."""
        if not text or not self.texts:
            return []
        text = normal(text)
        hits: dict[int, set[int]] = defaultdict(set)
        for last, places in self.automaton.iter(text):
            for k, offset in places:
                hits[k].add(last + 1 - offset)
        out = []
        for k, starts in hits.items():
            item, e = self.texts[k], errors(self.texts[k])
            if k not in self.masks:
                self.masks[k] = masks(item)
            best, stop = e + 1, 0
            for start, end in merged([(s - e, s + len(item) + e) for s in sorted(starts)]):
                distance, at = closest(self.masks[k], len(item), text[max(start, 0) : end])
                if distance < best:
                    best, stop = distance, max(start, 0) + at
                    if not best:
                        break
            if best <= e:
                out += [{"item_id": i, "distance": best, "stop": stop} for i in self.ids[k]]
        return sorted(out, key=lambda m: (m["item_id"] is None, m["item_id"] or 0, m["distance"], m["stop"]))


def merged(regions: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping regions as one, so that a text is read once per item at most."""
    out: list[tuple[int, int]] = []
    for start, end in regions:
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def matched(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> tuple[DataFrame, Column]:
    """All columns of ``docs`` and the column of the matched items."""
    items = benchmark.select("item_id", "text").where("length(trim(text)) > 0").distinct()
    # blocks by hash come out some larger, some smaller
    blocks = int((items.agg(F.sum(F.length("text"))).first()[0] or 0) // (block_chars // 2) + 1)
    items = saved(items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))), "benchmark-items")
    names, column = columns_of(docs), None
    name = "_found"
    while name in docs.columns:
        name = "_" + name
    for block in range(blocks):
        held = [(r["item_id"], r["text"]) for r in items.where(F.col("block") == block).collect()]
        shipped = docs.sparkSession.sparkContext.broadcast(held)
        built: list[Items] = []

        def rows_of(batch: pa.RecordBatch, shipped=shipped, built=built) -> list[pa.Array]:
            if not built:
                built.append(Items(shipped.value))
            kind = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("stop", pa.int32())]))
            return [pa.array([built[0].matches(t) for t in batch["text"].to_pylist()], kind)]

        docs, found = add_columns(docs, {"items": ITEM}, rows_of)
        every = found["items"] if column is None else F.concat(column, found["items"])
        docs, column = docs.select(*names, every.alias(name)), F.col(name)
        if blocks > 1:
            docs = saved(docs, "benchmark-block")
    return docs, column


def contaminated(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, contaminated, n_items, items) of every document.

    ``items`` lists the benchmark items (item_id, distance, stop) of which the text holds a copy with at most one edit
    (inserted, deleted or changed character) per CHARS_PER_ERROR characters, in lower case and with single spaces:
    ``distance`` is the least number of edits, ``stop`` the first end of such a copy in the normalised text.

    Null and empty texts match nothing, items without text match nothing; an item without id matches by its text like any
    other and is listed with a null id; items of equal text all match; texts of any length are read whole; null ids and repeated rows stay; empty tables are fine; other columns are ignored.
    """
    rows, items = matched(docs.select("doc_id", "text"), benchmark, block_chars)
    return rows.select("doc_id", (F.size(items) > 0).alias("contaminated"), F.size(items).alias("n_items"), F.array_sort(items).alias("items"))
