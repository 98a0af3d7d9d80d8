"""Repeated passages: which windows of fixed length also start earlier, found group by group.

A window's anchor is its run of ``core`` symbols with the least hash, so equal windows have equal anchors at the same
place. Consecutive windows with one anchor make a segment. Only segments whose anchor occurs elsewhere are looked at;
equal segments are one row from the start; what is left meets in groups by anchor. Groups that are too large for a task
are split by longer shared parts: of the places that the anchor can have in a window, a group takes half, then a quarter
and so on, and the part of the text that all its windows share grows, up to the whole window.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pollfold.llm.common import NO_ID, dropped, saved, slices, text_bytes
from pollfold.llm.numtext import BYTE_VALUE, grams, word_hashes, words

PLACE_BITS = 28
GROUP_SEGMENTS = 20_000
CHUNK_BYTES = 1 << 20
RANGES = "array<struct<a: int, b: int>>"


@dataclass(frozen=True)
class Passages:
    """What a passage is: ``length`` symbols (bytes or words), anchored by ``core`` of them.

    ``same_document`` says that a window can also repeat one of its own document. ``classes(symbols, length)`` gives a
    number to every place of a text, equal for equal windows, -1 for windows that occur once.
    """

    length: int
    core: int
    of_words: bool
    same_document: bool
    classes: Callable[[np.ndarray, int], np.ndarray]

    @property
    def places(self) -> int:
        return self.length - self.core + 1

    def symbols(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(value, start byte, end byte) of every symbol and the first symbol of each document."""
        if not self.of_words:
            at = np.arange(len(data))
            return BYTE_VALUE[data], at, at + 1, offsets
        start, end, first = words(data, offsets)
        return word_hashes(data, start, end), start, end, first

    def numbered(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(numbers from 1 on, equal for equal symbols, first symbol of each document)."""
        if self.of_words:
            values, _, _, first = self.symbols(data, offsets)
            return np.unique(values, return_inverse=True)[1] + 1, first
        return np.cumsum(np.bincount(data, minlength=256) > 0)[data], offsets

    def anchored(self, values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(document, first window, last window, place of the anchor, its hash) of every segment."""
        none = np.zeros(0, np.int64)
        if len(values) < self.length:
            return none, none, none, none, none.astype(np.uint64)
        if len(values) >= 1 << PLACE_BITS:
            raise ValueError(f"a text has more than {1 << PLACE_BITS} symbols")
        hashed = grams(values, self.core)
        low = np.uint64((1 << PLACE_BITS) - 1)
        key = (hashed & ~low) | np.arange(len(hashed), dtype=np.uint64)
        # least key of every run of ``places`` keys: runs of 1, 2, 4, ... and two that overlap
        width = 1
        while 2 * width <= self.places:
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        rest = self.places - width
        key = np.minimum(key[: len(key) - rest], key[rest:]) if rest else key
        n = np.maximum(np.diff(first) - self.length + 1, 0)
        doc = np.repeat(np.arange(len(n)), n)
        window = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[:-1][doc]
        place = (key[window] & low).astype(np.int64)
        if not len(window):
            return none, none, none, none, none.astype(np.uint64)
        new = np.flatnonzero(np.concatenate([[True], (np.diff(place) != 0) | (np.diff(doc) != 0)]))
        last = np.concatenate([new[1:], [len(window)]]) - 1
        return doc[new], window[new], window[last], place[new], hashed[place[new]]


def anchors(kind: Passages):
    """(hash, node) of every anchor; one that a text has twice also counts for a second node, if that matters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values, _, _, first = kind.symbols(*text_bytes(batch["text"]))
            doc, _, _, _, hashed = kind.anchored(values, first)
            node = np.asarray(batch["node"], np.int64)[doc]
            order = np.lexsort((hashed, doc))
            doc, hashed, node = doc[order], hashed[order], node[order]
            again = np.concatenate([[False], (doc[1:] == doc[:-1]) & (hashed[1:] == hashed[:-1])]) if len(doc) else np.zeros(0, bool)
            twice = np.flatnonzero(again) if kind.same_document else np.zeros(0, np.int64)
            hashed = np.concatenate([hashed[~again], hashed[twice]])
            node = np.concatenate([node[~again], node[twice] ^ 1])
            yield pa.RecordBatch.from_arrays([pa.array(hashed.view(np.int64)), pa.array(node)], ["hash", "node"])

    return run


def segments(kind: Passages):
    """(digest, id, key, place, seg, pos) of the segments whose anchor is in ``hashes``: ``place`` is the anchor's in the segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=1 << 19):
            data, offsets = text_bytes(batch["text"])
            values, start, end, first = kind.symbols(data, offsets)
            doc, a, b, place, hashed = kind.anchored(values, first)
            keys = hashed.view(np.int64)
            wanted = np.zeros(len(keys), bool)
            bounds = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            for d, listed in enumerate(batch["hashes"]):
                part = slice(bounds[d], bounds[d + 1])
                wanted[part] = np.isin(keys[part], np.asarray(listed.values, np.int64))
            doc, a, b, place, keys = doc[wanted], a[wanted], b[wanted], place[wanted], keys[wanted]
            raw = data.tobytes()
            seg = [raw[start[i] : end[j + kind.length - 1]] for i, j in zip(a.tolist(), b.tolist())]
            at = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["digest"].take(at),
                    batch["id"].take(at),
                    pa.array(keys),
                    pa.array((place - a).astype(np.int32)),
                    pa.array(seg, pa.binary()),
                    pa.array((a - first[:-1][doc]).astype(np.int32)),
                ],
                ["digest", "id", "key", "place", "seg", "pos"],
            )

    return run


def halved(kind: Passages, low: int, high: int):
    """The segments of a group cut in two by the anchor's place in the window, ``low`` to ``high``; key: what all windows share."""
    middle = (low + high) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "seg"):
            data, offsets = text_bytes(batch["seg"])
            values, start, end, first = kind.symbols(data, offsets)
            n = np.diff(first) - kind.length + 1
            place = np.asarray(batch["place"], np.int64)
            raw, out = data.tobytes(), []
            for row in range(batch.num_rows):
                for lo, hi in ((low, middle), (middle + 1, high)):
                    # the window that starts at i has its anchor at place - i
                    i, j = max(0, place[row] - hi), min(n[row] - 1, place[row] - lo)
                    if lo > hi or i > j:
                        continue
                    anchor = first[row] + place[row]
                    core = values[anchor - lo : anchor - hi + kind.length]
                    key = int(grams(core, len(core))[0] ^ np.uint64(lo)) if len(core) else lo
                    seg = raw[start[first[row] + i] : end[first[row] + j + kind.length - 1]]
                    out.append((row, key - (1 << 64) if key >= 1 << 63 else key, place[row] - i, seg, i, lo == low and hi == middle))
            at = pa.array([x[0] for x in out], pa.int64())
            pos = np.asarray(batch["pos"], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["seg_id"].take(at),
                    batch["id"].take(at),
                    pa.array([x[1] for x in out], pa.int64()),
                    pa.array([int(x[2]) for x in out], pa.int32()),
                    pa.array([x[3] for x in out], pa.binary()),
                    pa.array([int(pos[x[0]] + x[4]) for x in out], pa.int32()),
                    pa.array([int(x[4]) for x in out], pa.int32()),
                    pa.array([x[5] for x in out], pa.bool_()),
                ],
                ["parent", "id", "key", "place", "seg", "pos", "shift", "lower"],
            )

    return run


def repeated_windows(kind: Passages):
    """(seg_id, ranges) of segments with windows that start earlier than in the segment's first occurrence; rows sorted by key."""

    def judged(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        seg = rows["seg"].combine_chunks() if isinstance(rows["seg"], pa.ChunkedArray) else rows["seg"]
        number, first = kind.numbered(*text_bytes(seg))
        size = np.diff(first)
        # one separator after each segment
        text = np.zeros(len(number) + len(size), np.int64)
        own = np.repeat(np.arange(len(size)), size)
        text[np.arange(len(number)) + own] = number
        n = size - kind.length + 1
        row = np.repeat(np.arange(len(n)), n)
        shift = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        group = kind.classes(text, kind.length)[first[:-1][row] + row + shift]
        again = np.flatnonzero(group >= 0)
        again = again[np.argsort(group[again])]
        ids, pos = np.asarray(rows["id"], np.int64)[row[again]], np.asarray(rows["pos"], np.int64)[row[again]] + shift[again]
        head = np.flatnonzero(np.concatenate([[True], np.diff(group[again]) != 0])) if len(again) else np.zeros(0, np.int64)
        times = np.diff(np.append(head, len(again)))
        least_id = np.repeat(np.minimum.reduceat(ids, head), times) if len(head) else ids
        earlier = least_id < ids
        if kind.same_document:
            own_pos = np.where(ids == least_id, pos, np.iinfo(np.int64).max)
            least_pos = np.repeat(np.minimum.reduceat(own_pos, head), times) if len(head) else pos
            earlier |= least_pos < np.where(ids == least_id, pos, -1)
        hit = np.sort(again[earlier])
        cut = np.concatenate([[True], (np.diff(hit) != 1) | (np.diff(row[hit]) != 0)]) if len(hit) else np.zeros(0, bool)
        begin, stop = hit[cut], hit[np.concatenate([np.flatnonzero(cut)[1:] - 1, [len(hit) - 1]])] if len(hit) else hit
        found, count = np.unique(row[begin], return_counts=True)
        ends = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
        pairs = pa.StructArray.from_arrays([pa.array(shift[begin].astype(np.int32)), pa.array(shift[stop].astype(np.int32))], ["a", "b"])
        ranges = pa.ListArray.from_arrays(pa.array(ends), pairs)
        names = rows["seg_id"].combine_chunks() if isinstance(rows["seg_id"], pa.ChunkedArray) else rows["seg_id"]
        return pa.RecordBatch.from_arrays([names.take(pa.array(found)), ranges], ["seg_id", "ranges"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in slices(batches, "seg", CHUNK_BYTES // 2):
            keys = np.asarray(batch["key"], np.int64)
            if held and sum(b["seg"].nbytes for b in held) > CHUNK_BYTES // 2:
                # a chunk ends where a group ends
                new = np.flatnonzero(keys != held[-1]["key"][-1].as_py())
                if len(new):
                    yield judged(pa.Table.from_batches([*held, batch.slice(0, new[0])]))
                    held, batch = [], batch.slice(new[0])
            held.append(batch)
        if held:
            yield judged(pa.Table.from_batches(held))

    return run


def removed_windows(kind: Passages, found: DataFrame, owner: list[str], low: int, high: int) -> tuple[DataFrame, list[DataFrame]]:
    """(owner, pos, ranges), and the tables that these rows are read from: per row of ``found`` (owner, id, key, place, seg, pos)
    the windows that also start earlier."""
    seg_id = F.unhex(F.md5(F.concat(F.concat_ws(":", F.col("key"), F.col("place"), F.lit("")).cast("binary"), F.col("seg"))))
    # written once, as the segments are cut from the texts only here
    found = found.select(*owner, "id", "key", "place", "seg", "pos", seg_id.alias("seg_id"), windows_in(kind, F.col("seg")).alias("size"))
    found = saved(found, "segment-rows", compression="zstd")
    first = F.min(F.struct("id", "pos")).alias("first")
    unique = found.groupBy("seg_id", "key", "place", "seg").agg(first, F.count("*").alias("n"))
    unique = saved(unique.select("seg_id", "key", "place", "seg", F.col("first.id").alias("id"), F.col("first.pos").alias("pos"), "n"), "segments", compression="zstd")
    sizes = saved(unique.groupBy("key").agg(F.count("*").alias("in_group")).where("in_group > 1"), "segment-groups")
    rows = unique.join(sizes, "key")
    small = rows.where(F.col("in_group") <= GROUP_SEGMENTS).select("seg_id", "key", "seg", "id", "pos")
    small = small.repartition("key").sortWithinPartitions("key")
    ranged = saved(small.mapInArrow(repeated_windows(kind), f"seg_id binary, ranges {RANGES}"), "segment-ranges")
    large = rows.where(F.col("in_group") > GROUP_SEGMENTS)
    if low < high and not large.isEmpty():
        large = saved(large.drop("in_group", "n"), "large-groups")
        parts = large.mapInArrow(
            halved(kind, low, high), "parent binary, id long, key long, place int, seg binary, pos int, shift int, lower boolean"
        )
        middle = (low + high) // 2
        every, read = ranged, [large, ranged]
        for lower, lo, hi in ((True, low, middle), (False, middle + 1, high)):
            deeper, tables = removed_windows(kind, parts.where(F.col("lower") == lower), ["parent", "shift"], lo, hi)
            moved = F.transform("ranges", lambda r: F.struct((r["a"] + F.col("shift")).alias("a"), (r["b"] + F.col("shift")).alias("b")))
            every = every.unionByName(deeper.select(F.col("parent").alias("seg_id"), moved.alias("ranges")))
            read += tables
        ranged = saved(every.groupBy("seg_id").agg(F.flatten(F.collect_list("ranges")).alias("ranges")), "segment-ranges")
        dropped(*read)
    # segments that occur once and have no earlier window need no more care
    verdicts = unique.join(ranged, "seg_id", "left").where("n > 1 OR ranges IS NOT NULL")
    verdicts = saved(verdicts.select("seg_id", F.col("id").alias("id0"), F.col("pos").alias("pos0"), "ranges"), "segment-verdicts")
    dropped(unique, sizes, ranged)
    light = found.select(*owner, "id", "pos", "seg_id", "size")
    later = F.col("id") > F.col("id0")
    if kind.same_document:
        later = later | ((F.col("id") == F.col("id0")) & (F.col("pos") > F.col("pos0")))
    whole = F.array(F.struct(F.lit(0).alias("a"), (F.col("size") - 1).cast("int").alias("b")))
    gone = light.join(verdicts, "seg_id").select(*owner, "pos", F.when(later, whole).otherwise(F.col("ranges")).alias("ranges"))
    return gone.where("ranges IS NOT NULL"), [found, verdicts]


def windows_in(kind: Passages, seg: Column) -> Column:
    n = F.regexp_count(seg.cast("string"), F.lit(" ")) + 1 if kind.of_words else F.octet_length(seg)
    return n - (kind.length - 1)


def covered(kind: Passages):
    """(digest, n_removed, n_spans, kept_sha256) of texts whose windows in ``ranges`` go."""
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, offsets = text_bytes(batch["text"])
            _, start, end, first = kind.symbols(data, offsets)
            raw, out = data.tobytes(), []
            for d, ranges in enumerate(batch["ranges"].to_pylist()):
                n = int(first[d + 1] - first[d])
                edge = np.zeros(n + 1, np.int64)
                np.add.at(edge, [r["a"] for r in ranges], 1)
                np.add.at(edge, [r["b"] + kind.length for r in ranges], -1)
                gone = np.cumsum(edge[:-1]) > 0
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if n else 0
                if kind.of_words:
                    left = np.flatnonzero(~gone) + first[d]
                    kept = b" ".join([raw[i:j] for i, j in zip(start[left].tolist(), end[left].tolist())])
                else:
                    kept = data[first[d] : first[d + 1]][~gone].tobytes()
                out.append((int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
            removed, spans, sha = zip(*out)
            yield pa.RecordBatch.from_arrays([batch["digest"], pa.array(removed), pa.array(spans), pa.array(sha)], ["digest", "n_removed", "n_spans", "kept_sha256"])

    return run


def without_repeats(kind: Passages, docs: DataFrame) -> DataFrame:
    """(doc_id, n, n_removed, n_spans, kept_sha256) of rows (doc_id, text): symbols, those removed, their runs, and the rest's digest."""
    rows = docs.select("doc_id", F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.md5("text"))).withColumn("node", F.xxhash64("text"))
    n = F.when(F.col("text") == "", 0).otherwise(F.regexp_count("text", F.lit(" ")) + 1) if kind.of_words else F.octet_length("text")
    light = saved(rows.select("doc_id", "id", "digest", "node", n.cast("long").alias("n"), F.sha2("text", 256).alias("whole")), "passage-rows")
    firsts = saved(light.where(F.col("n") >= kind.length).groupBy("digest", "node").agg(F.min("id").alias("first")), "passage-firsts")
    found = rows.select("node", "text").mapInArrow(anchors(kind), "hash long, node long")
    often = found.groupBy("hash").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a != b").select("hash")
    often = saved(often, "passage-anchors")
    listed = found.join(often, "hash", "left_semi").groupBy("node").agg(F.collect_set("hash").alias("hashes"))
    listed = saved(listed.join(firsts, "node"), "passage-lists")
    texts = rows.join(listed, ["node", "digest"]).where(F.col("id") == F.col("first")).select("digest", "id", "text", "hashes")
    texts = saved(texts, "passage-texts")
    occurrences = texts.mapInArrow(segments(kind), "digest binary, id long, key long, place int, seg binary, pos int")
    dropped(often, listed)
    gone, read = removed_windows(kind, occurrences, ["digest"], 0, kind.places - 1)
    moved = F.transform("ranges", lambda r: F.struct((r["a"] + F.col("pos")).alias("a"), (r["b"] + F.col("pos")).alias("b")))
    gone = gone.select("digest", moved.alias("ranges")).groupBy("digest").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))
    cut = texts.select("digest", "text").join(gone, "digest").mapInArrow(
        covered(kind), "digest binary, n_removed long, n_spans long, kept_sha256 string"
    )
    cut = saved(cut.dropDuplicates(["digest"]), "passage-cuts")
    dropped(texts, *read)
    decided = saved(firsts.select("digest", "first").join(cut, "digest", "left"), "passage-decisions")
    dropped(firsts, cut)
    copy = F.col("id") > F.col("first")
    nothing = F.lit("e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855")  # sha256 of no bytes
    zero = F.lit(0).cast("long")
    return light.drop("node").join(decided, "digest", "left").select(
        "doc_id",
        "n",
        F.when(copy, F.col("n")).otherwise(F.coalesce("n_removed", zero)).alias("n_removed"),
        F.when(copy, 1).otherwise(F.coalesce("n_spans", zero)).alias("n_spans"),
        F.when(copy, nothing).otherwise(F.coalesce("kept_sha256", "whole")).alias("kept_sha256"),
    )
