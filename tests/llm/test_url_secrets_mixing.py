from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pollfold.llm.mixing import mix, sainte_lague
from pollfold.llm.queries import URL_RULES
from pollfold.llm.secrets import ALLOWED, CLASSES, find_secrets
from pollfold.llm.url_filter import filter_urls


def place(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def judged(url, rules):
    host, path = place(url)
    fits = [
        (-len(h + p), h + p, v != "block", v)
        for h, p, v in rules
        if host and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return (host, path, *((min(fits)[1], min(fits)[3]) if fits else (None, "allow")))


def test_urls(spark):
    rng = random.Random(1)
    pieces = [["http", "HTTPS"], ["com", "www.Example.com", "a.example.com", "example.com", "x.net", "net", "É.net", ""], ["", "/", "/en/", "/en", "/es/a/b", "/fr/?x", "/english/x#y", "?/en/"]]
    urls = ["://".join([rng.choice(pieces[0]), rng.choice(pieces[1])]) + rng.choice(pieces[2]) for _ in range(300)]
    urls += [None, "", "no scheme", "a://b://c/d", "http://" + "a." * 3000 + "net/" + "es/" * 3000, "http://x.net/es/", "http://x.net/es/"]
    rules = URL_RULES + [("x.net", "/en", "block"), ("a.example.com", "", "block"), ("net", "/es/", "allow"), (None, "/", "block"), ("net", None, None)]
    pages = spark.createDataFrame([(i % 200, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    found = filter_urls(pages, spark.createDataFrame(rules, "host string, path string, verdict string"))
    clean = [r for r in rules if r[0] and r[2]]
    assert Counter(map(tuple, found.collect())) == Counter((i % 200, *judged(u, clean)) for i, u in enumerate(urls))
    assert filter_urls(pages.limit(0), spark.createDataFrame(rules, "host string, path string, verdict string")).count() == 0


def brute_secrets(text):
    text = text or ""
    base = [("assign", *m.span(), 1) for m in re.finditer(r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text) if len(m[2]) >= 8]
    base += [("access", *m.span(), 2) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    base += [("hex", *m.span(), 3) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    added = []
    for m in re.finditer(r"[A-Za-z0-9+/=_-]{20,}", text):
        s = m[0]
        nth, (kind, _, _, least) = next((k, c) for k, c in enumerate(CLASSES, 4) if re.search(c[1], s))
        entropy = max(-sum(c / 20 * math.log2(c / 20) for c in Counter(s[i : i + 20]).values()) for i in range(len(s) - 19))
        good = re.search("[0-9]", s) and re.search("[A-Za-z]", s) and not re.search(ALLOWED, s) and entropy >= least - 1e-9
        if good and not any(b[1] < m.end() and m.start() < b[2] for b in base):
            added.append((kind, *m.span(), nth))
    order = lambda x: sorted(x, key=lambda s: (s[1], s[3]))
    return order(base), order(added)


def test_secrets(spark, odd_docs):
    rng = random.Random(2)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    pick = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    texts = [None, "", "secret: token: abcdefghij", "PassWord = 'abc' api-key=1 apikey:\"" + pick(letters, 30), "é😀 token=" + "a" * 8]
    texts += ["AKIAAKIA" + pick("ABC123", n) + " x" for n in (3, 7, 8, 9, 20)] + [pick("0123456789abcdef", n) for n in (31, 32, 33, 400)]
    for _ in range(200):
        chars = rng.choice([letters, "0123456789ABCDEF", "abc1", "0123456789abcdef", "abcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJ234567"])
        texts.append(" ".join(pick("etaoin é", rng.randint(0, 30)) + rng.choice(["", "passwd:", "x="]) + pick(chars, rng.randint(1, 60)) for _ in range(6)))
    docs = spark.createDataFrame([(i, t, "b") for i, t in enumerate(texts)], "doc_id long, text string, base string")
    got = {r.doc_id: r for r in find_secrets(docs).collect()}
    assert len(got) == len(texts)
    added = 0
    for i, t in enumerate(texts):
        base, more = brute_secrets(t)
        assert [(s.kind, s.start, s.stop, s.nth) for s in got[i].base] == base, t
        assert [(s.kind, s.start, s.stop, s.nth) for s in got[i].added] == more, t
        added += len(more)
    assert added > 20
    # many matches in one text, more than one block of running sums
    many = " ".join(pick("0123456789abcdef", rng.choice([20, 31, 32, 40])) + rng.choice(["", "g", "/Z"]) for _ in range(1500))
    row = find_secrets(spark.createDataFrame([(1, many)], "doc_id long, text string")).first()
    base, more = brute_secrets(many)
    assert [(s.kind, s.start, s.stop, s.nth) for s in row.base] == base
    assert [(s.kind, s.start, s.stop, s.nth) for s in row.added] == more
    assert find_secrets(odd_docs).count() == odd_docs.count()
    assert find_secrets(odd_docs.limit(0)).count() == 0


def brute_seats(claims, seats):
    quota = [0] * len(claims)
    for _ in range(seats):
        best = max(range(len(claims)), key=lambda i: (claims[i] / (2 * quota[i] + 1), -i))
        quota[best] += 1
    return quota


@pytest.mark.parametrize("seed", range(4))
def test_seats(spark, seed):
    rng = random.Random(seed)
    rows, expected = [], {}
    for g in range(5):
        claims = [float(rng.choice([0, 1, 3, 10, 1000, 10**5]) * rng.random()) for _ in range(rng.randint(1, 40))]
        seats = rng.choice([0, 1, 7, 100, 3000]) if any(claims) else 0
        rows += [(g, i, c, seats) for i, c in enumerate(claims)]
        expected |= {(g, i): q for i, q in enumerate(brute_seats(claims, seats))}
    got = sainte_lague(spark.createDataFrame(rows, "g int, tie int, claim double, seats long"), "g", "claim", "seats")
    assert {(r.g, r.tie): r.quota for r in got.collect()} == expected


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    full, total = set(), 1.5 * sum(sizes.values())
    while True:
        left = total - sum(2 * sizes[s] for s in full)
        free = [s for s in names if s not in full]
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        if not over:
            return {s: share.get(s, 2.0 * sizes[s]) for s in names}
        full |= over


def check_mix(docs, block, shard):
    got = mix(docs, block_words=block, shard_words=shard).collect()
    sizes, taken = defaultdict(int), defaultdict(int)
    counted = Counter((r.doc_id, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))) for r in docs.collect())
    assert counted == Counter((r.doc_id, r.size) for r in got)
    source_of = defaultdict(set)
    for r in docs.collect():
        source_of[(r.doc_id, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")))].add(r.source)
        sizes[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    aims = brute_targets(sizes)
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        options = [s for s in source_of[(r.doc_id, r.size)] if sizes[s] == r.source_size and abs(aims[s] - r.target) < 1e-6 * max(1, aims[s])]
        assert options
        taken[(r.source_size, round(r.target, 3))] += r.taken
    for s, aim in aims.items():
        same = sum(1 for o in aims if sizes[o] == sizes[s] and round(aims[o], 3) == round(aim, 3))
        shards = -(-sizes[s] // shard) or 1
        assert abs(taken.get((sizes[s], round(aim, 3)), 0) - same * aim) <= same * (block * (shards + 1))
    again = mix(docs, block_words=block, shard_words=shard)
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, got))


def test_mix(spark, odd_docs):
    check_mix(odd_docs, 4, 500)
    rng = random.Random(5)
    rows = [(i, "w " * rng.randint(0, 60), rng.choice(["s1", "s10", "s2", "hot", "hot", "hot", None, "ü", "Z"])) for i in range(600)]
    rows.append((600, "only", "tiny"))
    check_mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), 8, 700)
    assert mix(odd_docs.limit(0)).count() == 0
    assert mix(odd_docs.where(F.col("text").isNull())).agg(F.sum("taken")).first()[0] == 0
