from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pollfold.llm import line_dedup, near_dedup
from pollfold.llm.common import saved
from pollfold.llm.components import components
from pollfold.llm.decontamination import normal
from tests.llm.test_rules_language_benchmark import brute_measures, edit_table
from tests.llm.test_url_secrets_mixing import brute_seats, brute_targets

WORD = re.compile(r"[^\x20\x09-\x0D]+")
low = lambda s: re.sub("[A-Z]", lambda m: m[0].lower(), s or "")
order = lambda i: (i is None, i or 0)


def brute_lines(rows):
    lines = [(order(i), k, frozenset(WORD.findall(low(x))), r) for r, (i, t) in enumerate(rows) for k, x in enumerate((t or "").split("\n"))]
    lines = [x for x in lines if x[2]]
    out = [[i, 0, []] for i, _ in rows]
    for o, k, s, r in lines:
        out[r][1] += 1
        if any((p, q) < (o, k) and 100 * len(s & z) >= 80 * len(s | z) for p, q, z, _ in lines):
            out[r][2].append(k)
    return Counter((i, n, len(g), ",".join(map(str, g))) for i, n, g in out)


def brute_near(rows, percent):
    sets = []
    for _, t in rows:
        w = WORD.findall(low(t))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[top(a)] = top(b)
    least = {}
    for a, (i, _) in enumerate(rows):
        least[top(a)] = min(least.get(top(a), (True, 0)), order(i))
    ids = [None if least[top(a)][0] else least[top(a)][1] for a in range(len(rows))]
    return Counter((i, len(s), c, i == c) for (i, _), s, c in zip(rows, sets, ids))


def corpus(seed):
    rng = random.Random(seed)
    line = lambda n: " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") + rng.choice("XYz.é") for _ in range(n))
    pool = [line(rng.randint(1, 25)) for _ in range(40)]

    def edited(s):
        w = s.split(" ")
        for _ in range(rng.randint(0, 2)):
            w[rng.randrange(len(w))] = line(1)
        return rng.choice(["", " "]) + rng.choice([" ", "\t"]).join(w)

    rows = [(rng.choice([i, i, i, 5, None]), "\n".join(edited(rng.choice(pool)) for _ in range(rng.randint(0, 4)))) for i in range(110)]
    return rows + rows[:8] + [(900, None), (901, ""), (None, None), (902, " \n"), (903, " ".join(pool * 20))]


@pytest.mark.parametrize("seed", range(2))
def test_lines(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame([(*r, 1, "t") for r in rows], "doc_id long, text string, line int, tokens string")
    assert Counter(map(tuple, line_dedup.line_dedup(docs).collect())) == brute_lines(rows)
    kept = line_dedup.without_repeated_lines(docs)
    assert kept.columns == docs.columns and kept.count() < len(rows)
    assert line_dedup.line_dedup(docs.limit(0)).count() == 0


@pytest.mark.parametrize("kind", ["copies", "long"])
def test_line_pairs_grow_with_lines(spark, kind):
    """Copies that each have rare words of their own, and unlike lines so long that a sketch of 64 bits tells none apart."""
    rng = random.Random(7)
    if kind == "copies":
        base, odd = [f"w{i}" for i in range(60)], [f"odd{i}" for i in range(300)]
        texts = []
        for _ in range(300):
            words = list(base)
            for i in rng.sample(range(60), 3):
                words[i] = rng.choice(odd)
            texts.append(" ".join(words))
    else:
        texts = [" ".join(rng.sample([f"w{i}" for i in range(1500)], rng.randint(70, 260))) for _ in range(150)]
        texts += [" ".join(t.split(" ")[: rng.randint(60, 240)] + ["new"] * rng.randint(0, 1)) for t in texts[:60]]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lines = saved(line_dedup.lines_of(docs), "lines")
    sets = saved(line_dedup.distinct_sets(lines, saved(line_dedup.rarities(lines), "rarities"), 80), "sets")
    likely = line_dedup.likely_pairs(sets, 80)
    others = line_dedup.candidate_pairs(sets, line_dedup.verified(lines, likely, 80), 80)
    assert likely.count() + others.count() <= 3 * len(rows)
    assert Counter(map(tuple, line_dedup.line_dedup(docs).collect())) == brute_lines(rows)


@pytest.mark.parametrize("block", [400_000, 60])
def test_near(spark, block, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", block)
    monkeypatch.setattr(near_dedup, "STARS", 2 if block > 100 else 0)
    rng = random.Random(block)
    text = lambda n: [rng.choice("abcdefghij") + rng.choice("klmnop") for _ in range(n)]
    bases, rows = [text(rng.randint(3, 90)) for _ in range(7)], []
    for i in range(130):
        w = list(rng.choice(bases)) if rng.random() < 0.8 else text(rng.randint(0, 60))
        for _ in range(rng.randint(0, 2)):
            if w:
                w[rng.randrange(len(w))] = rng.choice("XYZ")
        rows.append((rng.choice([i, i, i, None]), rng.choice([" ", "\n "]).join(w)))
    rows += rows[:6] + [(900, None), (901, ""), (902, "a B c"), (903, "A b c")]
    docs = spark.createDataFrame([(*r, b"x") for r in rows], "doc_id long, text string, node binary").repartition(3)
    found = near_dedup.near_duplicates(docs, 85)
    assert Counter(tuple(r)[:4] for r in found.collect()) == brute_near(rows, 85)
    kept = near_dedup.without_near_duplicates(docs, 85)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect() if r.doc_id is not None and WORD.search(r.text or "")]
    assert set(ids) == {c[2] for c in brute_near(rows, 85) if c[1] and c[2] is not None}
    assert near_dedup.near_duplicates(docs.limit(0), 85).count() == 0


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + rng.randint(1, 40)) for _ in range(60)] + [(200, 200)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({got[i] for i in range(61)}) == 1
    assert len({v for k, v in got.items() if 100 <= k < 200}) == 1 and got[0] != got[100]


def test_pipeline(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "benchmark_decontamination", "mixing_sources"]
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 100 and {"doc_id", "size", "source_size", "target", "taken"} <= set(out.columns)


def wrapped(words, n):
    return "\n".join(" ".join(words[i : i + n]) for i in range(0, len(words), n))


def pipeline_rows(rng):
    """(rows, labels, items): good and bad texts, copies, near copies in other lines, repeated lines, benchmark passages."""
    syllables = ["ba", "do", "ke", "li", "mu", "na", "po", "ri", "su", "te"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(3))
    good = lambda n=40: [word() for _ in range(n)]
    bad = lambda: [rng.choice(["BUY", "$$$", "NOW", "!!!", "CLICK"]) + rng.choice(["", "!!", "%%"]) for _ in range(40)]
    texts = [wrapped(bad() if i % 2 == 0 else good(), 8) for i in range(300)]
    labels = [(i, i % 2, 0) for i in range(240)]
    bases = [good(44) for _ in range(8)]
    for base in bases:
        texts += [wrapped(base, 11), wrapped(base, 11)]  # exact copies lose all lines
        texts += [wrapped([*base[:20], word(), *base[20:]], 7)]  # near copies of which few lines are similar
    line = " ".join(good(9))
    texts += [f"{wrapped(good(), 10)}\n{line.upper() if i % 2 else line} \n" for i in range(5)]
    items = [(k, " ".join(good(12))) for k in range(3)] + [(9, None), (10, "  ")]
    for k in range(3):
        texts.append(wrapped(good(20), 10) + " " + items[k][1].title() + " " + wrapped(good(20), 10))
        texts.append(wrapped(good(20), 10) + " " + items[k][1].replace("a", "", 1) + " end")
        texts.append(wrapped(good(20), 10) + " " + items[k][1][: len(items[k][1]) // 2] + " end")
    texts += [None, "", " \n", "nine words are too few for a document", " ".join(good(3) * 20)]
    names = ["web", "web", "books", "code", None, "ü"]
    rows = [(i, rng.choice(names), t) for i, t in enumerate(texts)]
    rows += [rows[1]] + [(None, "web", wrapped(good(), 8)), (None, None, wrapped(good(), 8))]
    return [(i, t, "en", s, None if t is None else len(t)) for i, s, t in rows], labels, items


def brute_stages(rows, labels, items):
    """The documents (doc_id, text, lang, source, n_chars) after each of the first four stages."""
    stages = []
    looks_good = lambda t: "$$$" not in t and "CLICK" not in t
    measured = lambda t: (m := brute_measures(t))[0] >= 10 and 100 * m[4] <= 20 * m[0]
    rows = [r for r in rows if measured(r[1]) and looks_good(r[1])]
    stages.append(rows)

    lines = [(order(r[0]), k, frozenset(WORD.findall(low(x)))) for r in rows for k, x in enumerate(r[1].split("\n"))]
    lines = [x for x in lines if x[2]]
    cut = []
    for i, t, lang, source, _ in rows:
        kept, had, gone = [], 0, 0
        for k, x in enumerate(t.split("\n")):
            s = frozenset(WORD.findall(low(x)))
            again = bool(s) and any((o, p) < (order(i), k) and 100 * len(s & z) >= 80 * len(s | z) for o, p, z in lines)
            had, gone = had + bool(s), gone + again
            kept += [] if again else [x]
        if not gone or gone < had:
            cut.append((i, "\n".join(kept), lang, source, len("\n".join(kept))))
    rows = cut
    stages.append(rows)

    found = sets_of(rows)
    top = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if found[a] and 100 * len(found[a] & found[b]) >= near_dedup.PERCENT * len(found[a] | found[b]):
                top = [top[b] if x == top[a] else x for x in top]
    first = {}
    for a, r in enumerate(rows):
        if top[a] not in first or order(r[0]) < order(rows[first[top[a]]][0]):
            first[top[a]] = a
    rows = [r for a, r in enumerate(rows) if first[top[a]] == a]
    stages.append(rows)

    passages = [normal(x) for _, x in items if x and x.strip()]
    rows = [r for r in rows if not any(edit_table(x, normal(r[1]))[0] <= len(x) // 20 for x in passages)]
    stages.append(rows)
    return stages


def sets_of(rows):
    words = [WORD.findall(low(r[1])) for r in rows]
    return [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} for w in words]


def brute_mix(spark, rows):
    """(doc_id, size, source_size, target, taken) with 1 shard per source, blocks of 16 words."""
    ids = spark.createDataFrame([(r[0],) for r in rows], "i long").distinct()
    hashed = F.xxhash64(F.lit(20), F.coalesce(F.col("i").cast("string"), F.lit("null")))
    lot = {r.i: r.lot for r in ids.select("i", F.xxhash64(hashed).alias("lot")).collect()}
    sized = [(r[0], r[3], len(WORD.findall(r[1]))) for r in rows]
    sizes = Counter()
    for _, source, n in sized:
        sizes[source] += n
    aims = brute_targets(sizes)
    names = sorted(aims, key=lambda s: (s is not None, s or ""))
    quotas = dict(zip(names, brute_seats([aims[s] for s in names], int(sum(aims.values()) / 16 + 0.5))))
    out = []
    for s in names:
        own = sorted((x for x in sized if x[1] == s), key=lambda x: (lot[x[0]], order(x[0]), x[2]))
        read = min(quotas[s] * 16, 2 * sizes[s])
        stream = [k for k, x in enumerate(own) for _ in range(x[2])] * 2
        taken = Counter(stream[:read])
        out += [(x[0], x[2], sizes[s], round(aims[s], 6), taken[k]) for k, x in enumerate(own)]
    return Counter(out)


@pytest.mark.parametrize("seed", range(2))
def test_pipeline_stages(spark, tmp_path, seed):
    rows, labels, items = pipeline_rows(random.Random(seed))
    schemas = {"documents": "doc_id long, text string, lang string, source string, n_chars long", "labels": "doc_id long, quality int, toxic int", "benchmark": "item_id long, text string"}
    for (name, schema), table in zip(schemas.items(), (rows, labels, items)):
        spark.createDataFrame(table, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    expected = brute_stages(rows, labels, items)
    assert len({len(x) for x in [rows, *expected]}) == 5  # every stage has something to remove
    for (name, stage), after in zip(corpus_pipeline.STAGES, expected):
        docs = saved(stage(spark, docs, str(tmp_path)), "stage")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert Counter(map(tuple, docs.collect())) == Counter(after), name
    whole = corpus_pipeline.run(spark, str(tmp_path))
    got = Counter((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in whole.collect())
    assert got == brute_mix(spark, expected[-1])


def test_places_as_short_numbers_keep_their_order(spark):
    from pollfold.llm.common import NO_ID
    from pollfold.llm.line_dedup import LINES, corpus_place, place_in_corpus

    ids, lines = (-NO_ID - 1, -2, -1, 0, 1, NO_ID), (0, 5, LINES - 1)
    rows = [(i, n) for i in ids for n in lines]
    places = spark.createDataFrame(rows, "i long, n int").select("i", "n", place_in_corpus(F.col("i"), F.col("n")).alias("first"))
    found = [(r.id, r.line) for r in places.withColumns(corpus_place(F.col("first"))).orderBy("i", "n").collect()]
    assert found == sorted(set(found)) and found[-len(lines) :] == [(NO_ID, n) for n in lines]


def test_rarest_tokens_are_sorted_without_nulls(spark):
    from pollfold.llm.line_dedup import distinct_sets, lines_of, rarities

    lines = lines_of(spark.createDataFrame([(1, "a b b c\nd e")], "doc_id long, text string"))
    sets = distinct_sets(lines, rarities(lines), 80)
    # arrays that may hold nulls are sorted with boxes and an interpreted order
    assert not sets.schema["prefix"].dataType.containsNull
    assert sorted((r.size, len(r.prefix)) for r in sets.collect()) == [(2, 1), (3, 1)]
