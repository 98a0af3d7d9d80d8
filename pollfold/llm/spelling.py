"""Spelling variants: the vocabulary's minimal acceptor composed with a one-edit transducer and itself."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pollfold.llm.common import dropped, saved, slices

# runs of these, after A-Z have become a-z
RUN = re.compile("[a-zÀ-ÿ]+")
NO_RUN = re.compile("[^a-zÀ-ÿ]")
# 1 of so many (document, run) loses a letter
DAMAGED = 97
LEAST_LETTERS, LEAST_COUNT = 5, 3
# a form is this many times as frequent as its variant
TIMES = 2
# words whose acceptor one task builds at a time; a larger part is split by one more letter
PART_WORDS = 20_000
# text and different words that a counting task holds at a time
PIECE, HELD_WORDS = 1 << 20, 400_000
# heavy prefixes are sent to all tasks if their counted bytes are below this
BROADCAST_BYTES = 8 << 20


def pieces(text: str) -> Iterator[str]:
    """The text in pieces of about PIECE characters that cut no run."""
    start = 0
    while start < len(text):
        cut = NO_RUN.search(text, start + PIECE)
        end = cut.start() if cut else len(text)
        yield text[start:end]
        start = end


def count_runs(counts: Counter, doc_id: int | None, text: str) -> None:
    """Adds the runs of one document; those that the checksum of id and run picks lose the letter that it points at."""
    base = None if doc_id is None else crc32(f"{doc_id}:".encode())
    # bytes lower-case A-Z and nothing else
    for piece in pieces(text.encode().lower().decode()):
        found = Counter(RUN.findall(piece))
        if base is not None:
            for run in [r for r in found if crc32(r.encode(), base) % DAMAGED == 0]:
                at = crc32(run.encode(), base) % len(run)
                counts[run[:at] + run[at + 1 :]] += found.pop(run)
        counts.update(found)


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def given(counts: Counter) -> pa.RecordBatch:
        rows = [(w, n) for w, n in counts.items() if len(w) >= LEAST_LETTERS]
        return pa.RecordBatch.from_arrays([pa.array([w for w, _ in rows], pa.string()), pa.array([n for _, n in rows], pa.int64())], ["word", "n"])

    counts: Counter = Counter()
    for batch in slices(batches):
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
            count_runs(counts, doc_id, text or "")
            if len(counts) > HELD_WORDS:
                yield given(counts)
                counts = Counter()
    yield given(counts)


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    counted = docs.select("doc_id", "text").where("text IS NOT NULL").mapInArrow(count_words, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


class Acceptor:
    """The minimal acyclic automaton of sorted words: states by number, arcs to lower numbers only."""

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self._known: dict[tuple, int] = {}
        # nodes of the last word that may still get arcs
        open_: list[tuple[dict[str, int], bool]] = [({}, False)]
        last = ""
        for word in words:
            same = 0
            for x, y in zip(last, word):
                if x != y:
                    break
                same += 1
            self._close(open_, last, same)
            open_ += [({}, False) for _ in word[same:]]
            open_[-1] = (open_[-1][0], True)
            last = word
        self._close(open_, last, 0)
        self.start = self._state(*open_[0])

    def _state(self, arcs: dict[str, int], final: bool) -> int:
        key = (final, tuple(arcs.items()))
        state = self._known.setdefault(key, len(self.arcs))
        if state == len(self.arcs):
            self.arcs.append(arcs)
            self.final.append(final)
        return state

    def _close(self, open_: list[tuple[dict[str, int], bool]], last: str, down_to: int) -> None:
        while len(open_) > down_to + 1:
            state = self._state(*open_.pop())
            open_[-1][0][last[len(open_) - 1]] = state

    def both(self, one: int, other: int) -> Iterator[str]:
        """What both states accept; two paths that have met in one state go on as one."""
        arcs, final = self.arcs, self.final
        waiting = [(one, other, "")]
        while waiting:
            s, t, said = waiting.pop()
            if final[s] and final[t]:
                yield said
            if s == t:
                waiting += [(x, x, said + c) for c, x in arcs[s].items()]
            else:
                there = arcs[t]
                waiting += [(x, there[c], said + c) for c, x in arcs[s].items() if c in there]

    def edits(self, state: int) -> Iterator[tuple[str, str]]:
        """Pairs that the transducer accepts from (state, no edit yet, state) with its edit on the next letter: that letter
        replaced, or one more in the first word. A letter equal to the next one is not added, as the same pair leaves later."""
        arcs = list(self.arcs[state].items())
        for i, (x, to_x) in enumerate(arcs):
            for y, to_y in arcs[i + 1 :]:
                for rest in self.both(to_x, to_y):
                    yield x + rest, y + rest
            if self.final[to_x] and self.final[state]:
                yield x, ""
            beyond = self.arcs[to_x]
            for y, to_y in arcs:
                if y != x and y in beyond:
                    for rest in self.both(beyond[y], to_y):
                        yield x + y + rest, y + rest

    def near_pairs(self) -> Iterator[tuple[str, str]]:
        """All pairs of accepted words one edit apart, each once: the paths of the composition of acceptor, transducer, acceptor."""
        found = [list(self.edits(s)) for s in range(len(self.arcs))]
        # arcs lead to lower numbers, so states below are known first
        alive: list[bool] = []
        for s, arcs in enumerate(self.arcs):
            alive.append(bool(found[s]) or any(alive[t] for t in arcs.values()))
        waiting = [(self.start, "")]
        while waiting:
            s, said = waiting.pop()
            for one, other in found[s]:
                yield said + one, said + other
            waiting += [(t, said + c) for c, t in self.arcs[s].items() if alive[t]]


def part_pairs(group: pa.Table) -> pa.Table:
    """(word, n, other, other_n) of the near words of one part, each pair once."""
    count = dict(zip(group["word"].to_pylist(), group["n"].to_pylist()))
    skip = len(group["part"][0].as_py())
    shared = next(iter(count))[:skip]
    found = [(shared + u, shared + v) for u, v in Acceptor(sorted(w[skip:] for w in count)).near_pairs()]
    columns = [[u for u, _ in found], [count[u] for u, _ in found], [v for _, v in found], [count[v] for _, v in found]]
    return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64()) * 2)], ["word", "n", "other", "other_n"])


def without(column: str, at: int):
    """The text of a column without its code point ``at`` (from 0)."""
    return F.concat(F.substring(column, 1, at), F.substring(F.col(column), F.lit(at + 2), F.length(column)))


def near_pairs(words: DataFrame, part_words: int = PART_WORDS) -> DataFrame:
    """(word, n, other, other_n), written: every pair of near words of the written (word, n) once.

    Two near words part after a common start. The start state of the composition is split by its arcs: while more than
    ``part_words`` words share a prefix, its match arcs make one part per next letter, and its edit arcs, after which
    both words go on alike, are an equi-join on the word without that letter. Such a key has as many words as there are
    letters at most. A part below the limit goes to one task, which composes its acceptor.
    """
    open_, closed, edited, length = words, [], [], 0
    while True:
        prefix = F.substring("word", 1, length).alias("part")
        keyed = open_.select(prefix, "word", "n")
        heavy = saved(keyed.groupBy("part").agg(F.count("*").alias("words")).where(F.col("words") > part_words).select("part"), "spelling-heavy")
        size = heavy.agg(F.count("*").alias("n"), F.sum(F.octet_length("part") + 16).alias("bytes")).first()
        few = F.broadcast(heavy) if (size["bytes"] or 0) <= BROADCAST_BYTES else heavy
        closed.append(saved(keyed.join(few, "part", "left_anti"), "spelling-parts"))
        if not size["n"]:
            if length:
                dropped(open_)
            dropped(heavy)
            break
        still = saved(keyed.join(few, "part", "left_semi").select("word", "n"), "spelling-open")
        dropped(heavy, *([open_] if length else []))
        # the words without their next letter meet each other (replaced) and whole words (added)
        next_, after = F.substring("word", length + 1, 1), F.substring("word", length + 2, 1)
        less = still.where(F.length("word") > length).select(F.lit(length).alias("at"), without("word", length).alias("rest"), "word", "n", (next_ != after).alias("last"))
        whole = still.select(F.lit(length).alias("at"), F.col("word").alias("rest"), "word", "n", F.lit(None).cast("boolean").alias("last"))
        edited.append(saved(less.unionByName(whole), "spelling-edits"))
        open_, length = still, length + 1
    parts = closed[0]
    for more in closed[1:]:
        parts = parts.unionByName(more)
    pairs = parts.groupBy("part").applyInArrow(part_pairs, "word string, n long, other string, other_n long")
    if edited:
        rows = edited[0]
        for more in edited[1:]:
            rows = rows.unionByName(more)
        one = rows.where("last IS NOT NULL")
        other = rows.select("at", "rest", F.col("word").alias("other"), F.col("n").alias("other_n"), F.col("last").alias("other_last"))
        # a whole word meets a longer one where the letter left out differs from the next one, so that a pair comes once
        met = one.join(other, ["at", "rest"]).where("(other_last IS NOT NULL AND word < other) OR (other_last IS NULL AND last)")
        pairs = pairs.unionByName(met.select("word", "n", "other", "other_n"))
    out = saved(pairs, "spelling-pairs")
    dropped(*closed, *edited)
    return out


def roots(forms: DataFrame) -> DataFrame:
    """(word, root), written, of the written (word, form): forms followed to the last, twice as far each round.

    A form is at least TIMES as frequent as its word, so no way comes back."""
    found = saved(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = found.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        moved = saved(found.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root"), F.col("onward").isNotNull().alias("moved")), "spelling-roots")
        dropped(found)
        found = moved.select("word", "root")
        found.scratch_path = moved.scratch_path
        if moved.where("moved").isEmpty():
            return found


def spelling_variants(docs: DataFrame, part_words: int = PART_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of at least 5 code points and 3 occurrences.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF of whole texts, A-Z lower-cased. A run of a document loses one
    letter if 97 divides the crc32 of ``<doc_id>:<run>``. ``n_near`` counts the words one inserted, deleted or replaced
    code point away; ``form`` is the most frequent of them (of equal ones the first in code-point order) if it is at
    least twice as frequent as the word, else null, with its count ``form_n``; ``root`` follows the forms to the last and
    is the word itself without one.

    Null and empty texts have no words; rows without id count, and none of their runs loses a letter; repeated rows count
    again. Texts are read whole, in pieces that cut no run; a word of any length is one word. An empty table gives none;
    other columns are ignored.
    """
    words = saved(vocabulary(docs), "spelling-words")
    pairs = near_pairs(words, part_words)
    back = pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("word")))
    near = pairs.unionByName(back).groupBy("word", "n").agg(F.count("*").alias("n_near"), best.alias("best"))
    is_form = -F.col("best.less") >= TIMES * F.col("n")
    near = near.select("word", "n_near", F.when(is_form, F.col("best.word")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n"))
    near = saved(near, "spelling-near")
    dropped(pairs)
    last = roots(near.where("form IS NOT NULL"))
    found = words.join(near, "word", "left").join(last, "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")
