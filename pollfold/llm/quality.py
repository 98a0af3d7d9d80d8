"""Quality rules: measures with fixed thresholds, and a calibrated logistic regression over hashed word and character n-grams."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pollfold.llm.common import add_columns, saved, text_bytes, within_bytes
from pollfold.llm.numtext import grams, mixed, sums, word_hashes, words

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
REPEAT_WINDOW = 5
# labelled rows (half of each label) and bytes of text that the classifier is fitted on at most; longer texts are not drawn
SAMPLE_ROWS, SAMPLE_BYTES, SAMPLE_TEXT_BYTES = 2_000, 16 << 20, 1 << 18
BITS = 17
WORD_GRAMS, CHARACTER_GRAMS = (1, 2), (3, 5)
# rejects only what is improbable to be good
KEEP_FROM = 0.1
FOUND = {
    **dict.fromkeys(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"), "long"),
    "base_failed": "boolean",
    "probability": "double",
    "kept": "boolean",
}


def measures(text: str) -> tuple[int, int, int, int, int]:
    """(words, code points in words, symbols, lines equal to an earlier one, words in repeated windows)."""
    found = text.encode().split()  # bytes split at exactly the six ASCII spaces
    chars = len(text) - sum(map(text.count, SPACES))
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    windows = list(zip(*(found[i:] for i in range(REPEAT_WINDOW))))
    repeated = 0
    if len(seen := set(windows)) < len(windows):
        often = {w for w, n in Counter(windows).items() if n > 1} if len(seen) > 1 else seen
        covered = 0
        for at, window in enumerate(windows):
            if window in often:
                repeated += at + REPEAT_WINDOW - max(at, covered)
                covered = at + REPEAT_WINDOW
    return len(found), chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated


def characters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code point of every character of UTF-8 ``data``, characters before each offset)."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    code = data[lead].astype(np.uint64)
    follow = lambda at, k: (data[np.minimum(lead[at] + k, len(data) - 1)] & 0x3F).astype(np.uint64)
    for extra, least, bits in ((1, 0xC0, 0x1F), (2, 0xE0, 0x0F), (3, 0xF0, 0x07)):
        at = np.flatnonzero((data[lead] >= least) & (data[lead] < (0xE0, 0xF0, 0x100)[extra - 1]))
        value = code[at] & np.uint64(bits)
        for k in range(1, extra + 1):
            value = (value << np.uint64(6)) | follow(at, k)
        code[at] = value
    return code, np.searchsorted(lead, offsets)


def features(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """(hashed feature of each gram, first gram of each document, grams at a document's end that reach beyond it) per kind."""
    start, end, first = words(data, offsets)
    hashed = word_hashes(data, start, end)
    shift = np.uint64(64 - BITS)
    kinds = [((grams(hashed + np.uint64(n), n) >> shift).astype(np.int64), first, n - 1) for n in WORD_GRAMS]
    code, before = characters(data, offsets)
    spread = mixed(code + np.uint64(1))
    return kinds + [((grams(spread, n) >> shift).astype(np.int64), before, n - 1) for n in CHARACTER_GRAMS]


@dataclass
class Model:
    """A document's logit is the mean weight of its grams, summed over the kinds, then scaled to a probability."""

    weights: np.ndarray  # kinds x features
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def logits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        total = np.full(len(offsets) - 1, self.bias)
        for kind, (index, first, short) in enumerate(features(data, offsets)):
            n = np.maximum(np.diff(first) - short, 0)
            total += sums(self.weights[kind][index], first, short) / np.maximum(n, 1)
        return total

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * logits + self.shift, -30, 30)))


def features_of(data: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Per text the features it holds and their share among its grams of a kind."""
    found = features(data, offsets)
    indices, values = [], []
    for d in range(len(offsets) - 1):
        parts = []
        for kind, (index, first, short) in enumerate(found):
            own = index[first[d] : max(first[d], min(first[d + 1] - short, len(index)))]
            unique, n = np.unique(own, return_counts=True)
            parts.append((unique + (kind << BITS), n / max(len(own), 1)))
        indices.append(np.concatenate([p[0] for p in parts]).astype(np.int32))
        values.append(np.concatenate([p[1] for p in parts]).astype(np.float32))
    return indices, values


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int, most_bytes: int) -> DataFrame:
    """(good, lot, text): at most ``rows`` labelled rows, half of each label at most, by the hash of their id, within ``most_bytes``."""
    known = (
        labels.select(F.col("doc_id").alias("label_id"), F.col("quality").cast("int").alias("good"))
        .where("label_id IS NOT NULL AND good IN (0, 1)")
        .groupBy("label_id")
        .agg(F.min("good").alias("good"))
        .withColumn("lot", F.xxhash64(F.lit(6), "label_id"))
    )
    parts = [known.where(F.col("good") == g).orderBy("lot", "label_id").limit(rows // 2) for g in (0, 1)]
    chosen = parts[0].unionByName(parts[1])
    texts = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull() & (F.octet_length("text") <= min(SAMPLE_TEXT_BYTES, most_bytes // 8)))
    found = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id")).select("good", "lot", "text")
    # an id may have several rows, equal ones count once
    return within_bytes(saved(found.dropDuplicates(["lot", "text"]), "quality-sample"), most_bytes)


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, turns: int = 80, most_bytes: int = SAMPLE_BYTES) -> Model | None:
    """Logistic regression on four fifths of the sample; the rest calibrates (Platt), and the labels' shares give the prior.

    One task fits the sample, which ``rows`` and ``most_bytes`` bound, and returns the weights."""
    shares = {r["good"]: r["n"] for r in labels.groupBy(F.col("quality").cast("int").alias("good")).agg(F.count("*").alias("n")).where("good IN (0, 1)").collect()}

    def train(sample: pa.Table) -> pa.Table:
        model = fitted(sample.sort_by([("lot", "ascending"), ("text", "ascending")]), shares, turns)
        kept = [] if model is None else [model]
        rest = pa.array([[m.bias, m.slope, m.shift] for m in kept], pa.list_(pa.float64()))
        return pa.table({"weights": pa.array([m.weights.tobytes() for m in kept], pa.binary()), "rest": rest})

    sample = labelled_sample(docs, labels, rows, most_bytes)
    got = sample.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(train, "weights binary, rest array<double>").collect()
    if not got:
        return None
    return Model(np.frombuffer(bytes(got[0]["weights"]), np.float32).reshape(-1, 1 << BITS), *got[0]["rest"])


def fitted(sample: pa.Table, shares: dict[int, int], turns: int) -> Model | None:
    good = np.asarray(sample["good"], dtype=float)
    lot = np.asarray(sample["lot"], dtype=np.int64)
    if min((good == g).sum() for g in (0, 1)) < 5:
        return None
    held = lot % 5 == 0
    if min((good[held] == g).sum() for g in (0, 1)) < 2:
        held = np.arange(len(good)) % 5 == 0
    index, value = features_of(*text_bytes(sample["text"].combine_chunks()))

    def gathered(which: np.ndarray):
        chosen = np.flatnonzero(which)
        at = np.repeat(np.arange(len(chosen)), [len(index[i]) for i in chosen])
        join = lambda x, t: np.concatenate([x[i] for i in chosen]) if len(chosen) else np.zeros(0, t)
        return at, join(index, np.int32), join(value, np.float32)

    size = (len(WORD_GRAMS) + len(CHARACTER_GRAMS)) << BITS
    weights, bias = np.zeros(size), 0.0
    mean, square, bias_mean, bias_square = np.zeros(size), np.zeros(size), 0.0, 0.0
    at, columns, amounts = gathered(~held)
    aim = good[~held]
    per_row = np.where(aim > 0, 0.5 / max(aim.sum(), 1), 0.5 / max((1 - aim).sum(), 1))
    for turn in range(1, turns + 1):  # Adam over the whole sample
        logit = np.bincount(at, amounts * weights[columns], len(aim)) + bias
        error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - aim) * per_row
        slope = np.bincount(columns, amounts * error[at], size)
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        bias_mean, bias_square = 0.9 * bias_mean + 0.1 * error.sum(), 0.99 * bias_square + 0.01 * error.sum() ** 2
        scale = lambda m, s: 0.2 * (m / (1 - 0.9**turn)) / (np.sqrt(s / (1 - 0.99**turn)) + 1e-7)
        weights -= scale(mean, square)
        bias -= scale(bias_mean, bias_square)
    model = Model(weights.astype(np.float32).reshape(-1, 1 << BITS), float(bias))
    at, columns, amounts = gathered(held)
    logit = np.bincount(at, amounts * weights[columns], int(held.sum())) + bias
    model.slope, model.shift = platt(logit, good[held])
    prior = np.log(max(shares.get(1, 0), 1) / max(shares.get(0, 0), 1)) - np.log((good == 1).sum() / (good == 0).sum())
    model.shift += float(prior)
    return model


def platt(logit: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the sigmoid that fits the held-out labels best (Newton's method, softened targets)."""
    n1, n0 = good.sum(), (1 - good).sum()
    aim = np.where(good > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    scale = max(float(np.abs(logit).mean()), 1e-9)
    x, a, b = logit / scale, 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g, w = p - aim, np.maximum(p * (1 - p), 1e-6)
        h = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(h, [(g * x).sum(), g.sum()])
        a, b = a - float(np.clip(step[0], -2, 2)), b - float(np.clip(step[1], -2, 2))
    return max(a, 0.05) / scale, b


def judge(docs: DataFrame, model: Model | None, keep_from: float = KEEP_FROM) -> tuple[DataFrame, dict[str, Column]]:
    """All columns of ``docs`` with the measures and the verdict (see ``apply_rules``)."""

    def rows_of(batch: pa.RecordBatch) -> list[pa.Array]:
        texts = batch["text"].to_pylist()
        n_words, chars, symbols, dup, repeated = map(np.array, zip(*(measures(t or "") for t in texts)))
        failed = (n_words < LEAST_WORDS) | (100 * repeated > MOST_REPEATED_PERCENT * n_words)
        chance = np.ones(len(texts)) if model is None else model.probabilities(model.logits(*text_bytes(batch["text"])))
        return [pa.array(x) for x in (n_words, chars, symbols, dup, repeated, failed, chance, ~failed & (chance >= keep_from))]

    return add_columns(docs, FOUND, rows_of)


def apply_rules(docs: DataFrame, model: Model | None, keep_from: float = KEEP_FROM) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, probability, kept) of every document.

    ``base_failed``: fewer than 10 words, or more than 20 % of the words in 5-word windows that occur twice or more.
    ``kept``: not failed, and a calibrated probability of good quality of ``keep_from`` or more; without a model the
    probability is 1.

    Null and empty texts have no words and so fail; texts of any length are read whole; null ids and repeated rows stay;
    an empty table gives none; other columns are ignored.
    """
    rows, found = judge(docs.select("doc_id", "text"), model, keep_from)
    return rows.select("doc_id", *[column.alias(name) for name, column in found.items()])
