from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from pollfold.llm import passages, suffix_array, suffix_trees
from pollfold.llm.passages import Passages


def brute(rows, length, of_words, same_document):
    earliest, split = {}, []
    for doc_id, text in rows:
        text = text or ""
        parts = re.findall(r"[^\x20\x09-\x0D]+", text) if of_words else list(text.encode())
        order = (doc_id is None, doc_id or 0)
        split.append((doc_id, order, parts))
        for i in range(len(parts) - length + 1):
            at = (order, i if same_document else 0)
            w = tuple(parts[i : i + length])
            earliest[w] = min(earliest.get(w, at), at)
    out = []
    for doc_id, order, parts in split:
        gone = [False] * len(parts)
        for i in range(len(parts) - length + 1):
            if earliest[tuple(parts[i : i + length])] < (order, i if same_document else 0):
                gone[i : i + length] = [True] * length
        kept = [p for p, g in zip(parts, gone) if not g]
        data = " ".join(kept).encode() if of_words else bytes(kept)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(parts), sum(gone), spans, hashlib.sha256(data).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("classes", [suffix_array.repeat_classes, suffix_trees.repeat_classes])
def test_classes(classes):
    rng = np.random.default_rng(1)
    for _ in range(200):
        text = rng.integers(0, rng.integers(2, 5), rng.integers(1, 120))
        length = int(rng.integers(1, 9))
        got = classes(text, length)
        windows = {i: tuple(text[i : i + length]) for i in range(len(text) - length + 1) if 0 not in text[i : i + length]}
        n = Counter(windows.values())
        number = {}
        for i, w in windows.items():
            assert (got[i] >= 0) == (n[w] > 1), (text, length, i)
            if n[w] > 1:
                assert number.setdefault(w, got[i]) == got[i]
        assert len(set(number.values())) == len(number)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "bb", "ccc", "é", "dd"]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", "  ", "\n"]) for _ in range(n))
    shared = [text(rng.randint(5, 60)) for _ in range(6)]
    rows = []
    for i in range(90):
        parts = [rng.choice([text(rng.randint(0, 30)), rng.choice(shared), rng.choice(shared)[: rng.randint(0, 80)]]) for _ in range(rng.randint(0, 4))]
        rows.append((rng.choice([i, i, i, 7, None]), "".join(parts)))
    rows += [rng.choice(rows) for _ in range(20)] + [(500, None), (501, ""), (None, None), (502, shared[0] * 3), (503, text(3000))]
    return rows


@pytest.mark.parametrize("of_words", [False, True])
@pytest.mark.parametrize("group", [20_000, 2])
def test_repeats(spark, of_words, group, monkeypatch):
    monkeypatch.setattr(passages, "GROUP_SEGMENTS", group)
    rows = corpus(group + of_words)
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, digest string, n string").repartition(3)
    if of_words:
        kind, run = Passages(10, 4, True, False, suffix_trees.repeat_classes), suffix_trees.substring_dedup
    else:
        kind, run = Passages(24, 9, False, True, suffix_array.repeat_classes), suffix_array.suffix_array_dedup
    got = Counter(map(tuple, run(docs, kind).collect()))
    assert got == brute(rows, kind.length, of_words, kind.same_document)
    assert sum(r[2] for r in got) > 100


def test_odd(spark, odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert Counter(map(tuple, suffix_array.suffix_array_dedup(odd_docs).collect())) == brute(rows, 100, False, True)
    assert Counter(map(tuple, suffix_trees.substring_dedup(odd_docs).collect())) == brute(rows, 50, True, False)
    assert suffix_array.suffix_array_dedup(odd_docs.limit(0)).count() == 0
    assert suffix_trees.substring_dedup(odd_docs.limit(0)).count() == 0
