from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pollfold.llm import decontamination, language, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_measures(text):
    text = text or ""
    found = WORD.findall(text)
    lines, dup = [], 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.append(line)
    windows = [tuple(found[i : i + 5]) for i in range(len(found) - 4)]
    n = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(5)}
    return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


@pytest.mark.parametrize("seed", range(3))
def test_measures(seed):
    rng = random.Random(seed)
    for _ in range(300):
        text = "".join(rng.choice(["a", "b", " ", " ", "\n", "\t", "é", "#", " ", "\x0b", "a b c d e "]) for _ in range(rng.randint(0, 60)))
        assert quality.measures(text) == brute_measures(text)
    assert quality.measures(" x\x85y z") == brute_measures(" x\x85y z")


def test_quality(spark, odd_docs):
    rng = random.Random(3)
    good = lambda: " ".join(rng.choice(["the", "house", "of", "many", "green", "trees", "stands", "by", "a", "lake"]) + rng.choice(["", "er", "ly"]) for _ in range(40))
    bad = lambda: " ".join(rng.choice(["BUY", "$$$", "NOW", "!!!", "CLICK"]) + rng.choice(["", "!!", "%%"]) for _ in range(40))
    rows = [(i, good() if i % 2 else bad(), "z") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)] + [(None, 1), (5, None)], "doc_id long, quality int")
    model = quality.fit(docs, labels, rows=200)
    found = {r.doc_id: r for r in quality.apply_rules(docs, model).collect()}
    for i, text, _ in rows:
        r = found[i]
        n, chars, symbols, dup, repeated = brute_measures(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, repeated)
        assert r.base_failed == (n < 10 or 100 * repeated > 20 * n)
        if i >= 300 and not r.base_failed:  # never seen in training
            assert r.kept == bool(i % 2)
    assert quality.fit(docs, labels.limit(0)) is None
    odd = quality.apply_rules(odd_docs, model).collect()
    assert len(odd) == odd_docs.count()
    assert all(r.base_failed and not r.kept and r.n_words == 0 for r in odd if r.doc_id in (4, 5, 6))
    assert quality.apply_rules(odd_docs.limit(0), None).count() == 0


def brute_kneser_ney(texts, order, discounts):
    """Probability of a class after its context, straight from the definition."""
    sequences = [language.letters([t])[0].tolist() for t in texts]
    counts = {n: Counter() for n in range(1, order + 1)}
    for s in sequences:
        counts[order].update(tuple(s[i : i + order]) for i in range(len(s) - order + 1))
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    uniform = 1 / len(counts[1])

    def chance(gram, n=order):
        lower = chance(gram[1:], n - 1) if n > 1 else uniform
        same = {g: c for g, c in counts[n].items() if g[:-1] == gram[:-1]}
        total = sum(same.values())
        if not total:
            return lower
        d = discounts[n]
        return max(counts[n][gram] - d, 0) / total + d * len(same) / total * lower

    return counts, chance


def test_kneser_ney(spark):
    texts = ["the cat sat on the mat, the rat sat", "that hat is at the cat"] * 2
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    model = language.train(docs)
    discounts = {}
    counts, _ = brute_kneser_ney(texts, language.ORDER, {})
    for n, c in counts.items():
        n1, n2 = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
        discounts[n] = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    _, chance = brute_kneser_ney(texts, language.ORDER, discounts)
    classes, _, _ = language.letters(["the hat sat, quiet"])
    grams = language.packed(classes, language.ORDER)
    got = model.chances(grams)[:, 0]
    expected = [chance(tuple(classes[i : i + language.ORDER].tolist())) for i in range(len(grams))]
    np.testing.assert_allclose(got, expected, rtol=1e-4)


def test_kneser_ney_of_many_grams(spark, odd_docs):
    rng = random.Random(8)
    texts = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=4000)) for _ in range(75)]
    rows = [(i, t, "en") for i, t in enumerate(texts)] + [(100 + i, " ".join(rng.choices(["der", "und", "mit"], k=40)), "de") for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(docs)
    assert isinstance(model, language.Model)
    counts, _ = brute_kneser_ney(texts, language.ORDER, {})
    assert len(counts[language.ORDER]) > 2**17
    # every gram and context is there, also those seen once
    for n, c in counts.items():
        own = language.packed(np.array(list(c)).ravel(), n)[::n]
        alpha = language.found_in(model.grams[n - 1], own, -1.0)
        gamma = language.found_in(model.contexts[n - 1], own >> language.BITS, -1.0)
        assert (alpha >= 0).all() and (gamma[:, model.langs.index("en")] < 1).all() and (gamma >= 0).all()
    discounts = {}
    for n, c in counts.items():
        n1, n2 = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
        discounts[n] = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    _, chance = brute_kneser_ney(texts, language.ORDER, discounts)
    grams = language.packed(language.letters([texts[0][:12] + " qzx"])[0], language.ORDER)
    classes = [[g >> (language.BITS * k) & 4095 for k in (3, 2, 1, 0)] for g in grams.tolist()]
    np.testing.assert_allclose(model.chances(grams)[:, model.langs.index("en")], [chance(tuple(x)) for x in classes], rtol=1e-4)

    # the same in tables
    written = language.train(docs, shipped_bytes=0)
    assert isinstance(written, language.WrittenModel) and written.langs == model.langs and written.uniform == model.uniform
    np.testing.assert_allclose(written.limits, model.limits)
    for some in (docs, odd_docs, odd_docs.limit(0)):
        key = lambda r: (r.doc_id is None, r.doc_id, r.bits is None, r.bits)
        one, two = (sorted(language.identify(some, m).collect(), key=key) for m in (model, written))
        assert len(one) == len(two) == some.count()
        for a, b in zip(one, two):
            assert (a.doc_id, a.lang_pred) == (b.doc_id, b.lang_pred)
            assert (a.score, a.bits) == (pytest.approx(b.score), pytest.approx(b.bits))


def test_limits_are_of_all_learned_texts(spark):
    rng = random.Random(9)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(5, 40))) for _ in range(3000)]
    docs = spark.createDataFrame([(i, t, "xx") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    model = language.train(docs)
    bits = np.sort(model.entropies(texts)[0][:, 0])
    exact = np.quantile(bits, language.REJECT_ABOVE)
    assert exact <= model.limits[0] + 1e-9 and model.limits[0] <= exact + 2 / language.STEPS


def test_language(spark, odd_docs):
    rng = random.Random(4)
    forms = {"en": ["the", "and", "with", "house", "thing"], "de": ["der", "und", "mit", "haus", "straße"], "ru": ["это", "и", "дом", "с", "вещь"]}
    rows = [(i, " ".join(rng.choice(forms[lang]) for _ in range(12)), lang, None) for i, lang in enumerate(["en", "de", "ru"] * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    learned = docs.where(~language.held_out(F.col("doc_id")))
    model = language.train(learned)
    found = {r.doc_id: r for r in language.identify(docs, model).collect()}
    assert sum(found[i].lang_pred == lang for i, _, lang, _ in rows) / len(rows) >= 0.99
    assert all(0 <= r.score <= 1 for r in found.values())
    odd = language.identify(odd_docs, model).collect()
    assert len(odd) == odd_docs.count()
    assert {(r.lang_pred, r.score, r.accepted) for r in odd if r.doc_id in (4, 5, 6)} == {("und", 0.0, False)}
    strange = spark.createDataFrame([(1, "zzz qqq xxx " * 20), (2, "123 !?"), (3, "ﬁ😀 數學")], "doc_id long, text string")
    got = {r.doc_id: r for r in language.identify(strange, model).collect()}
    assert not got[1].accepted and got[2].lang_pred == "und" and got[3].lang_pred in forms
    assert language.train(docs.limit(0)) is None
    assert language.identify(docs, None).select("lang_pred").distinct().collect()[0][0] == "und"
    assert language.identify(docs.limit(0), model).count() == 0


def edit_table(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        diagonal, row[0] = row[0], i
        for j, b in enumerate(text, 1):
            diagonal, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, diagonal + (a != b))
    return min(row), row.index(min(row))


def test_closest():
    rng = random.Random(5)
    for _ in range(400):
        item = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 90)))
        text = "".join(rng.choice("abc ") for _ in range(rng.randint(0, 120)))
        assert decontamination.closest(decontamination.masks(item), len(item), text) == edit_table(item, text)


def test_contaminated(spark, odd_docs):
    rng = random.Random(6)
    text = lambda n: "".join(rng.choice("abcdefgh   é\n") for _ in range(n))
    items = [(i, text(rng.choice([5, 19, 25, 60, 140]))) for i in range(25)] + [(25, None), (26, " "), (27, "Same Text Here"), (28, "same  text here"), (None, "abc"), (None, "same text HERE")]

    def edited(s, n):
        for _ in range(n):
            at = rng.randrange(max(len(s), 1))
            s = s[:at] + rng.choice(["", "x", "yy"]) + s[at + rng.choice([0, 1]) :]
        return s

    rows = [(i, text(150) + edited(rng.choice(items[:25])[1], rng.choice([0, 1, 2, 4, 8])).upper() + text(150)) for i in range(150)]
    rows += [(200, "x same TEXT\there y"), (201, None), (202, "")]
    docs = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, items string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    expected = {}
    for i, t in rows:
        whole = decontamination.normal(t or "")
        expected[i] = []
        for item_id, item in items:
            if item and item.strip():
                item = decontamination.normal(item)
                best, stop = edit_table(item, whole)
                if best <= len(item) // 20:
                    expected[i].append((item_id, best, stop))
    for block_chars in (10**6, 700):
        got = {r.doc_id: sorted(((m.item_id, m.distance, m.stop) for m in r["items"]), key=repr) for r in decontamination.contaminated(docs, benchmark, block_chars).collect()}
        assert got == {i: sorted(found, key=repr) for i, found in expected.items()}
    assert decontamination.contaminated(odd_docs, benchmark).count() == odd_docs.count()
    assert not decontamination.contaminated(odd_docs, benchmark.limit(0)).where("contaminated").count()
