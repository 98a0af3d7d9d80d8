"""Secret scan: three fixed patterns, and windows of high Shannon entropy in long strings of one character class."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# kind, pattern, group that must be long enough, its least length
BASE = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
)
# the same matches, without the many short ones: a run that is long enough is matched whole from its start
LONG_ONLY = {"access": r"AKIA[A-Z0-9]{12,}", "hex": r"[0-9a-f]{32,}"}
CANDIDATE = r"[A-Za-z0-9+/=_-]{20,}"
# class, pattern of the whole string, characters, least entropy in bits of one window: the value that 1 % of random windows of
# the class stay below (fixed values, simulated)
CLASSES = (
    ("entropy_hex", "^[0-9a-fA-F]+$", "0123456789abcdefABCDEF", 2.9),
    ("entropy_one_case", "^([0-9a-z]+|[0-9A-Z]+)$", "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", 3.38),
    ("entropy_base64", "", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-", 3.65),
)
# numbers that are summed up one after the other; longer lists are summed in blocks of so many
BLOCK = 256
WINDOW = 20
# a candidate with one of these is documentation, not a secret
ALLOWED = r"(?i)example|sample|placeholder|dummy|changeme|xxxxx|0123456789|abcdefghij"
SPAN = "array<struct<kind: string, start: bigint, stop: bigint, found: string, nth: int>>"


def once(value: Column, body) -> Column:
    """``body`` of a value that is computed once: an expression is computed again wherever it stands, a lambda variable is not."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(values: Column, start: Column, step) -> Column:
    """For every entry of ``values`` what ``step`` has made of ``start`` and all entries before it; ``step`` is associative, and
    ``start`` changes nothing.

    An array that grows by one entry is copied each time, so blocks of BLOCK entries are done on their own, each from what
    the blocks before it give: the copies grow with the entries, not with their square."""

    def scan(entries: Column, first: Column) -> Column:
        state = F.struct(first.alias("now"), F.array().cast("array<bigint>").alias("seen"))
        add = lambda acc, x: F.struct(step(acc["now"], x).alias("now"), F.concat(acc["seen"], F.array(acc["now"])).alias("seen"))
        return F.aggregate(entries, state, add)["seen"]

    def in_blocks(whole: Column) -> Column:
        last = F.greatest(F.ceil(F.size(whole) / BLOCK) - 1, F.lit(0)).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(whole, b * BLOCK + 1, BLOCK))

    def joined(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda block: F.aggregate(block, start, step))
        return F.flatten(F.zip_with(blocks, scan(totals, start), scan))

    return once(once(values, in_blocks), joined)


def spans_of(text: Column, pattern: str, kind: str, nth: int) -> Column:
    """All matches as (kind, start, stop, found, nth), positions in code points: gaps and matches take turns."""
    long = lambda array: F.transform(array, lambda x: F.length(x).cast("bigint"))
    span = lambda at, m: F.struct(
        F.lit(kind).alias("kind"), at.alias("start"), (at + F.length(m)).alias("stop"), m.alias("found"), F.lit(nth).alias("nth")
    )

    def placed(found: Column) -> Column:
        def with_gaps(gaps: Column) -> Column:
            ends = F.zip_with(gaps, long(found), lambda g, m: g + m)
            starts = F.zip_with(running(ends, F.lit(0).cast("bigint"), lambda at, n: at + n), gaps, lambda at, g: at + g)
            return F.zip_with(starts, found, span)

        return once(F.slice(long(F.split(text, pattern, -1)), F.lit(1), F.size(found)), with_gaps)

    spans = once(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)
    # most texts have no match: they pay for one search only
    return F.when(F.rlike(text, F.lit(pattern)), spans.cast(SPAN)).otherwise(F.array().cast(SPAN))


def by_start(spans: Column) -> Column:
    return F.array_sort(
        spans, lambda a, b: F.when(a["start"] != b["start"], F.signum(a["start"] - b["start"]).cast("int")).otherwise(a["nth"] - b["nth"])
    )


def apart_from(spans: Column, base: Column) -> Column:
    """The ``spans`` that overlap none of ``base``, which have ``nth`` up to len(BASE): one pass over both in order of start for
    base spans that start before, one backwards for those that start after."""
    is_base = lambda s: s["nth"] <= len(BASE)
    zero, far = F.lit(0).cast("bigint"), F.lit(2**62).cast("bigint")

    def free(every: Column) -> Column:
        stops = F.transform(every, lambda s: F.when(is_base(s), s["stop"]).otherwise(zero))
        starts = F.transform(F.reverse(every), lambda s: F.when(is_base(s), s["start"]).otherwise(far))
        reached = running(stops, zero, lambda x, y: F.greatest(x, y))
        coming = F.reverse(running(starts, far, lambda x, y: F.least(x, y)))
        # a base span counts as reached by all, so that only the others are left
        past = F.zip_with(every, reached, lambda s, r: F.when(~is_base(s) & (r <= s["start"]), s))
        kept = F.zip_with(past, coming, lambda s, c: F.when(c >= s["stop"], s))
        return F.filter(kept, lambda s: s.isNotNull()).cast(SPAN)

    return F.when((F.size(spans) > 0) & (F.size(base) > 0), once(by_start(F.concat(base, spans)), free)).otherwise(spans)


def base_spans(text: Column, nth: int, kind: str, pattern: str, group: int, least: int) -> Column:
    """The matches of one fixed pattern that are long enough."""
    spans = spans_of(text, LONG_ONLY.get(kind, pattern), kind, nth)
    value = lambda s: F.regexp_extract(s["found"], pattern, group) if group else s["found"]
    return F.filter(spans, lambda s: F.length(value(s)) >= least)


def best_entropy(found: Column, alphabet: str, window: int = WINDOW) -> Column:
    """Highest Shannon entropy (bits per character) of any ``window`` characters in a row.

    The window slides by one: the count of the entering character goes up, that of the leaving one down, and the sum of
    c * log2(c) changes by these two terms only.
    """
    terms = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 2)])
    term = lambda c: F.element_at(terms, c + 1)
    code = lambda i: F.instr(F.lit(alphabet), F.substring(found, i, F.lit(1)))
    start = F.struct(
        F.array_repeat(F.lit(0), len(alphabet)).alias("counts"), F.lit(0.0).alias("total"), F.lit(float(window)).alias("least")
    )

    def changed(counts: Column, which: Column, by: int) -> Column:
        return F.transform(counts, lambda c, k: c + F.when(k + 1 == which, by).otherwise(0))

    def step(acc: Column, i: Column) -> Column:
        enters, leaves = code(i), code(i - window)
        c = F.element_at(acc["counts"], enters)
        total = acc["total"] + term(c + 1) - term(c)
        counts = changed(acc["counts"], enters, 1)
        d = F.element_at(counts, F.greatest(leaves, F.lit(1)))
        full = i > window
        total = total + F.when(full, term(F.greatest(d - 1, F.lit(0))) - term(d)).otherwise(0.0)
        counts = F.when(full, changed(counts, leaves, -1)).otherwise(counts)
        return F.struct(
            counts.alias("counts"),
            total.alias("total"),
            F.when(i >= window, F.least(acc["least"], F.round(total, 9) / window * 1.0)).otherwise(acc["least"]).alias("least"),
        )

    lowest = F.aggregate(F.sequence(F.lit(1), F.length(found)), start, step)["least"]
    return F.lit(math.log2(window)) - lowest


def candidates(text: Column) -> Column:
    """Strings that are long enough, mix letters and digits and are not allow-listed, with their class as kind."""
    kind = lambda s, values: F.coalesce(*[F.when(F.rlike(s["found"], F.lit(pattern)), v) for (_, pattern, _, _), v in zip(CLASSES, values)])
    mixed = F.filter(
        spans_of(text, CANDIDATE, "", len(BASE) + 1),
        lambda s: F.rlike(s["found"], F.lit("[0-9]")) & F.rlike(s["found"], F.lit("[A-Za-z]")) & ~F.rlike(s["found"], F.lit(ALLOWED)),
    )
    classed = F.transform(
        mixed,
        lambda s: F.struct(
            kind(s, [F.lit(c[0]) for c in CLASSES]).alias("kind"),
            s["start"].alias("start"),
            s["stop"].alias("stop"),
            s["found"].alias("found"),
            kind(s, [F.lit(len(BASE) + 1 + k) for k in range(len(CLASSES))]).alias("nth"),
        ),
    )
    return classed.cast(SPAN)


def of_high_entropy(spans: Column, window: int = WINDOW) -> Column:
    """Candidates with a window whose entropy reaches the limit of their class."""
    enough = lambda s: F.coalesce(*[F.when(s["kind"] == kind, best_entropy(s["found"], chars, window) >= least) for kind, _, chars, least in CLASSES])
    return F.filter(spans, enough)


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, base, added): arrays of spans (kind, start, stop, found, nth) per document.

    ``base`` has the matches of the three patterns that are long enough, ``added`` the strings of high entropy that
    overlap none of them. Starts and ends count code points, ends are exclusive.

    Null and empty texts have no spans; texts of any length are scanned whole; null ids and repeated rows stay; an empty
    table gives none; other columns are ignored.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    base = [base_spans(F.col("text"), nth, *of) for nth, of in enumerate(BASE, 1)]
    found = rows.select("doc_id", by_start(F.concat(*base)).alias("base"), candidates(F.col("text")).alias("strong"))
    found = found.select("doc_id", "base", apart_from(F.col("strong"), F.col("base")).alias("strong"))
    return found.select("doc_id", "base", of_high_entropy(F.col("strong")).alias("added"))


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
