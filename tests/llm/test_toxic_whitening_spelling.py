from __future__ import annotations

import itertools
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from pollfold.llm import spelling, toxicity, whitening
from tests.llm.conftest import WORDS


def all_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- toxicity


@pytest.mark.parametrize("sizes", [[3, 0, 1, 5], [1], [0, 0], [7, 2, 0, 4, 0], [9]])
def test_marginals_are_those_of_all_paths(sizes):
    rng = np.random.default_rng(sum(sizes))
    first = np.concatenate([[0], np.cumsum(sizes)])
    emit, move = rng.normal(size=first[-1]) * 2, rng.normal(size=(2, 2))
    forward, backward, total = toxicity.forward_backward(emit, first, move)
    for k, m in enumerate(sizes):
        own, every, ones = emit[first[k] : first[k + 1]], 0.0, np.zeros(m)
        for path in itertools.product((0, 1), repeat=m):
            w = math.exp(sum(own[i] for i in range(m) if path[i]) + sum(move[path[i], path[i + 1]] for i in range(m - 1)))
            every, ones = every + w, ones + w * np.array(path)
        if m:
            at = slice(first[k], first[k + 1])
            assert math.log(every) == pytest.approx(total[k])
            assert np.exp(forward[at, 1] + backward[at, 1] - total[k]) == pytest.approx(ones / every)


INSULTS = ["grobian", "fool", "rotter"]


@pytest.fixture(scope="module")
def insulting(spark):
    rng = random.Random(11)
    rows, labels = [], []
    for k in range(900):
        words = [rng.choice(WORDS) + rng.choice(["", ",", "."]) for _ in range(rng.randint(5, 60))]
        toxic = k % 6 == 0
        for _ in range(3 if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(INSULTS).title())
        rows.append((k, " ".join(words)))
        if k % 3 != 1 or toxic:
            labels.append((k, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels += [(None, 1), (5, None), (0, 1), (10**9, 1)]
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int"), dict(rows)


def test_toxicity_learns_marked_tokens(insulting):
    docs, labels, texts = insulting
    learned = docs.where(~toxicity.held_out(F.col("doc_id")))
    found = toxicity.score_toxicity(docs, toxicity.fit_toxicity(learned, labels)).collect()
    assert len(found) == len(texts)
    for r in found:
        insulted = [m.span() for m in re.finditer("|".join(w.title() for w in INSULTS), texts[r["doc_id"]])]
        if crc32(str(r["doc_id"]).encode()) % 4 == 2:  # never learned
            assert r["predicted"] == int(r["doc_id"] % 6 == 0)
            assert [(s["start"], s["end"]) for s in r["spans"]] == insulted
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)


def test_toxicity_of_odd_rows(insulting, odd_docs, no_docs):
    docs, labels, _ = insulting
    field = toxicity.fit_toxicity(docs, labels)
    found = toxicity.score_toxicity(odd_docs, field).collect()
    assert len(found) == odd_docs.count()
    empty = [r for r in found if r["doc_id"] in (4, 5, 6)]
    assert len(empty) == 3 and len({r["score"] for r in empty}) == 1 and all(r["predicted"] == 0 and not r["spans"] for r in empty)
    assert toxicity.score_toxicity(no_docs, field).count() == 0
    assert toxicity.fit_toxicity(no_docs, labels) is None
    assert toxicity.fit_toxicity(docs, labels.where("toxic = 1")) is None
    assert {r["score"] for r in toxicity.score_toxicity(odd_docs, None).collect()} == {0.0}


# --- whitening


def spectra():
    rng = np.random.default_rng(4)
    left, right = np.linalg.qr(rng.normal(size=(200, 24)))[0], np.linalg.qr(rng.normal(size=(24, 24)))[0]
    yield rng.normal(size=(200, 24))
    yield rng.normal(size=(200, 24)) * np.logspace(0, -7, 24)
    yield np.vstack([np.eye(24)] * 3)
    yield np.repeat(rng.normal(size=(100, 6)), 4, axis=1)
    yield left * np.r_[1 + 1e-11 * np.arange(6), np.linspace(0.9, 0.1, 18)] @ right
    yield left * np.r_[np.ones(6), np.linspace(0.9, 0.1, 18)] @ right
    yield rng.normal(size=(9, 2))
    yield rng.normal(size=(9, 1))


@pytest.mark.parametrize("rows", list(spectra()))
def test_singular_values_and_directions(rows):
    r = np.linalg.qr(rows, mode="r")
    diagonal, above, right = whitening.bidiagonalised(r)
    squares = whitening.squared_singular_values(diagonal, above)
    expected = np.linalg.svd(rows, compute_uv=False) ** 2
    assert np.abs(squares - expected).max() <= 1e-13 * expected[0]
    values, vectors = whitening.leading_directions(r, 4)
    assert len(values) == min(4, int((expected > 1e-25 * expected[0]).sum()))
    assert np.abs(rows.T @ rows @ vectors.T - vectors.T * values).max() <= 1e-11 * expected[0]
    assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() <= 1e-9


def test_no_variance_has_no_direction():
    assert len(whitening.leading_directions(np.zeros((5, 5)), 4)[0]) == 0


def whitened_by_force(rows, count=4):
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    sizes = Counter(len(v) for _, v in kept)
    usual = max(sizes, key=lambda s: (sizes[s], s))
    kept = [(i, tuple(math.floor(256 * c) for c in v)) for i, v in kept if len(v) == usual]
    fit = np.array(sorted({x for _, x in kept}), dtype=object)
    n, total = len(fit), fit.sum(0)
    centred = (n * fit - total).astype(float) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:count], vectors[:, ::-1][:, :count]
    out = []
    for i, x in kept:
        apart = n * np.array(x, dtype=object) - total
        for k in range(len(values)):
            out.append((i, k + 1, n, int((apart**2).sum()), float(apart.astype(float) / n @ vectors[:, k] / math.sqrt(values[k])), values[k] / (centred**2).sum() * n))
    return out


def test_whitening_is_that_of_all_rows(spark, monkeypatch):
    rng = np.random.default_rng(12)
    data = [(k, [float(np.float32(x)) for x in rng.normal(size=6) * [3, 2, 1.5, 1, 0.3, 0.1]]) for k in range(400)]
    data += [(7, data[7][1])] * 60 + [(None, data[3][1]), (900, None), (901, []), (902, [1.0] * 5), (903, [1.0] * 5 + [None]), (904, [1.0] * 5 + [math.nan])]
    data += [(905, [math.inf] + [0.0] * 5), (906, [-0.0] * 6), (907, [1e6] + [0.0] * 5)]
    rows = spark.createDataFrame([(*r, "x", 1) for r in data], "vec_id long, embedding array<float>, x string, n int").repartition(7)
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 16)
    monkeypatch.setattr(whitening, "FACTOR_BYTES", 2 * 8 * 36)  # factors meet two by two
    found = whitening.whiten(rows).collect()
    expected = whitened_by_force(data)
    assert len(found) == len(expected)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[3])
    found, expected = sorted(map(tuple, found), key=key), sorted(expected, key=key)
    sign = {k: math.copysign(1, sum(f[4] * e[4] for f, e in zip(found, expected) if f[1] == k)) for k in range(1, 5)}
    for f, e in zip(found, expected):
        assert f[:3] == e[:3] and int(f[3]) == e[3]
        assert f[4] * sign[f[1]] == pytest.approx(e[4], abs=1e-9) and f[5] == pytest.approx(e[5]) and f[6] < 1e-9


def test_whitening_of_few_rows(spark):
    schema = "vec_id long, embedding array<double>"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, [math.nan])], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).count() == 0
    two = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [2.0, 2.0]), (2, [2.0, 2.0])], schema)).collect()
    assert sorted((r["id"], r["component"], r["n"], abs(round(r["whitened"], 9))) for r in two) == [(1, 1, 2, 1.0), (2, 1, 2, 1.0), (2, 1, 2, 1.0)]


def test_whole_numbers_beyond_64_bits(spark):
    big = [(k, [float(2**40 + k), float(-(2**41) * k)]) for k in range(50)]
    rows = spark.createDataFrame(big, "vec_id long, embedding array<double>")
    found = {r["id"]: int(r["deviation"]) for r in whitening.whiten(rows).where("component = 1").collect()}
    total = [sum(256 * int(v[j]) for _, v in big) for j in (0, 1)]
    assert found == {k: sum((50 * 256 * int(v[j]) - total[j]) ** 2 for j in (0, 1)) for k, v in big}


# --- spelling variants


def near(u: str, v: str) -> bool:
    if len(u) == len(v):
        return sum(x != y for x, y in zip(u, v)) == 1
    u, v = (u, v) if len(u) > len(v) else (v, u)
    return len(u) == len(v) + 1 and any(u[:i] + u[i + 1 :] == v for i in range(len(u)))


@pytest.mark.parametrize("letters, longest, count", [("ab", 6, 60), ("abc", 5, 150), ("abcdé", 4, 300), ("a", 9, 9)])
def test_acceptor_pairs_are_all_pairs(letters, longest, count):
    rng = random.Random(count)
    words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(1, longest))) for _ in range(count)})
    found = list(spelling.Acceptor(words).near_pairs())
    assert len(found) == len({frozenset(p) for p in found})
    assert {frozenset(p) for p in found} == {frozenset((u, v)) for i, u in enumerate(words) for v in words[:i] if near(u, v)}


def spelled_by_force(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: k for w, k in counts.items() if len(w) >= 5 and k >= 3}
    out, form = [], {}
    beside = {w: sorted((v for v in n if near(w, v)), key=lambda v: (-n[v], v)) for w in n}
    for w in n:
        form[w] = beside[w][0] if beside[w] and n[beside[w][0]] >= 2 * n[w] else None
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(beside[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("part_words", [20_000, 40, 3])
def test_spelling_is_that_of_all_pairs(spark, part_words):
    rng = random.Random(13)
    stems = ["".join(rng.choice("aabé") for _ in range(rng.randint(4, 7))) for _ in range(60)] + ["Anders", "andErs", "Études", "×ab÷cd", "aaaaaa", "aaaaaaa"]
    weight = [rng.choice([1, 1, 2, 5, 20]) for _ in stems]
    rows = [(k, " ".join(rng.choices(stems, weight, k=40)) + rng.choice(["", ",x1y", "\n", "Ābcdef"])) for k in range(60)]
    rows += [(None, rows[0][1]), (3, rows[1][1]), (3, rows[1][1]), (80, None), (81, ""), (82, " ".join(["y" * 3000] * 3 + ["y" * 2999] * 6 + ["zz"] * 9))]
    docs = spark.createDataFrame([(*r, "w", 1) for r in rows], "doc_id long, text string, word string, n int").repartition(3)
    assert all_rows(spelling.spelling_variants(docs, part_words)) == spelled_by_force(rows)


def test_spelling_of_odd_rows(spark, odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(spelling, "PIECE", 50)
    monkeypatch.setattr(spelling, "HELD_WORDS", 5)
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert all_rows(spelling.spelling_variants(odd_docs)) == spelled_by_force(rows)
    assert spelling.spelling_variants(no_docs).count() == 0
