"""Toxicity: a linear-chain conditional random field tags toxic tokens; its marginals give document scores and offsets."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pollfold.llm.common import add_columns, saved, text_bytes, within_bytes
from pollfold.llm.numtext import BYTE_VALUE, TO_LOWER, mixed, powers

# labelled rows and bytes of text that the field is fitted on at most; longer texts are not drawn
SAMPLE_ROWS, SAMPLE_BYTES, SAMPLE_TEXT_BYTES = 6_000, 8 << 20, 1 << 18
BITS = 18
KINDS = 5
TURNS = 60
STEP = 0.3
RIDGE = 1e-6
# a word marks toxic tokens if so many labelled texts hold it in so many contexts, and chance explains that badly
LEAST_TEXTS, LEAST_EVIDENCE, LEAST_RATIO = 3, 16.0, 8.0
PREDICT_FROM = 0.3
# marginal from which a token belongs to a reported span
SPAN_FROM = 0.5
FOUND = {"score": "double", "predicted": "int", "spans": "array<struct<start:int,end:int,chance:float>>"}


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first): bytes of every run of letters (any byte beyond ASCII is one), and the runs before each text."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    low = TO_LOWER[data]
    inside = ((low >= 97) & (low <= 122)) | (data >= 128)
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1] | cut[1:-1]
    ends[:-1] &= ~inside[1:] | cut[1:-1]
    start = np.flatnonzero(starts)
    return start, np.flatnonzero(ends) + 1, np.searchsorted(start, offsets)


def run_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the lower-cased bytes from start to end."""
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[TO_LOWER[data]] * up[: len(data)], out=total[1:])
    return mixed((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def features(data: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(KINDS x tokens): hashed word, first and last bytes, word before and word after within the text."""
    n = len(start)
    word = run_hashes(data, start, end)
    head = run_hashes(data, start, np.minimum(end, start + 4))
    tail = run_hashes(data, np.maximum(start, end - 4), end)
    before, after = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    before[1:], after[:-1] = word[:-1], word[1:]
    before[first[:-1][first[:-1] < n]] = 1
    after[first[1:][first[1:] > 0] - 1] = 1
    out = [mixed(h + np.uint64(0x9E3779B97F4A7C15) * np.uint64(k + 1)) >> np.uint64(64 - BITS) for k, h in enumerate((word, head, tail, before, after))]
    return np.stack(out).astype(np.int64)


def scan(emit: np.ndarray, first: np.ndarray, move: np.ndarray) -> np.ndarray:
    """(tokens x 2): log of the forward sums of a two-state chain, started anew at every text.

    ``emit`` is the score of state 1 over state 0, ``move`` (2 x 2) of going from state to state. The tokens lie in rows of
    about the root of their number; all rows step together, then their products are joined row after row.
    """
    n = len(emit)
    if not n:
        return np.zeros((0, 2))
    fresh = np.zeros(n, bool)
    fresh[first[:-1][first[:-1] < np.minimum(first[1:], n)]] = True
    length = max(1, int(np.sqrt(n)))
    rows = -(-n // length)
    pad = rows * length - n
    emit2 = np.concatenate([emit, np.zeros(pad)]).reshape(rows, length)
    fresh2 = np.concatenate([fresh, np.ones(pad, bool)]).reshape(rows, length)
    # sums[r, i, j]: from state i before the row to state j after the tokens so far
    sums = np.where(np.eye(2, dtype=bool), 0.0, -np.inf)[None].repeat(rows, 0)
    steps = np.empty((length, rows, 2, 2))
    for t in range(length):
        new = np.stack([np.logaddexp(sums[:, :, 0] + move[0, j], sums[:, :, 1] + move[1, j]) for j in (0, 1)], -1)
        new = np.where(fresh2[:, t, None, None], 0.0, new)
        new[:, :, 1] += emit2[:, t, None]
        steps[t] = sums = new
    enter = np.zeros((rows, 2))
    state, anew = np.zeros(2), fresh2.any(1)
    for r in range(rows):
        enter[r] = state
        state = sums[r, 0] if anew[r] else np.logaddexp(state[0] + sums[r, 0], state[1] + sums[r, 1])
    out = np.logaddexp(enter[None, :, 0, None] + steps[:, :, 0], enter[None, :, 1, None] + steps[:, :, 1])
    # a text that starts inside a row forgets what came before it: both ways in hold the same sums, so one is taken
    began = np.cumsum(fresh2, 1).T > 0
    out = np.where(began[:, :, None], steps[:, :, 0], out)
    return out.transpose(1, 0, 2).reshape(-1, 2)[:n]


def forward_backward(emit: np.ndarray, first: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(forward, backward, log of all paths per text) of a two-state chain over texts side by side."""
    n = len(emit)
    forward = scan(emit, first, move)
    # the same from the end; a backward sum does not count its own token
    turned = scan(emit[::-1], n - first[::-1], move.T)[::-1]
    backward = turned.copy()
    backward[:, 1] -= emit
    last = first[1:][first[1:] > first[:-1]] - 1
    total = np.zeros(len(first) - 1)
    total[first[1:] > first[:-1]] = np.logaddexp(forward[last, 0], forward[last, 1])
    return forward, backward, total


@dataclass
class Field:
    """Weights of the hashed features for state 1, scores of moves between states, and the calibration of texts."""

    weights: np.ndarray  # KINDS x 2**BITS
    bias: float
    move: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def emissions(self, index: np.ndarray) -> np.ndarray:
        return self.weights[np.arange(KINDS)[:, None], index].sum(0, dtype=np.float64) + self.bias

    def read(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(evidence per text, marginal per token, start, end, first). The evidence is the log of the odds that a text has
        a toxic token: all paths but the one without against that one."""
        start, end, first = tokens(data, offsets)
        emit = self.emissions(features(data, start, end, first))
        forward, backward, total = forward_backward(emit, first, self.move)
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        marginal = np.exp(np.minimum(forward[:, 1] + backward[:, 1] - total[row], 0.0))
        # the path without a toxic token scores its moves alone
        plain = np.maximum(np.diff(first) - 1, 0) * self.move[0, 0]
        some = total - plain
        evidence = np.where(some > 30, some, np.log(np.maximum(np.expm1(np.minimum(some, 30)), 1e-13)))
        return np.where(np.diff(first) > 0, evidence, -30.0), marginal, start, end, first

    def scores(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * np.clip(evidence, -30, 30) + self.shift, -30, 30)))


def marked_words(words: np.ndarray, contexts: np.ndarray, texts: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Hashes of the words that mark toxic tokens: texts labelled toxic hold them far more often than others do.

    A word counts once per text and once per context (the words around it), so copies of one text count once. ``toxic`` is
    the label of every text; the other arrays have an entry per token.
    """
    _, at = np.unique(np.stack([words, contexts]), axis=1, return_index=True)
    _, one = np.unique(np.stack([words[at], texts[at].astype(np.uint64)]), axis=1, return_index=True)
    words, label = words[at][one], toxic[texts[at][one]]
    found, place = np.unique(words, return_inverse=True)
    a = np.bincount(place, label, len(found))
    b = np.bincount(place, 1 - label, len(found))
    share = max(label.mean(), 1e-9)
    seen = a / (a + b)
    near = lambda x, p: np.where(x > 0, x * np.log(np.maximum(x, 1e-9) / ((a + b) * p)), 0.0)
    evidence = 2 * (near(a, share) + near(b, max(1 - share, 1e-9)))
    ratio = (a + 0.5) / (b + 0.5) * (1 - share) / share
    return found[(a >= LEAST_TEXTS) & (seen > share) & (evidence >= LEAST_EVIDENCE) & (ratio >= LEAST_RATIO)]


def fitted(batch: pa.Table, turns: int = TURNS) -> Field | None:
    """The field of a sample (toxic, lot, text); a fifth of its texts calibrates the scores only."""
    label = np.asarray(batch["toxic"], dtype=np.int64)
    if len(label) == 0 or label.min() == label.max():
        return None
    data, offsets = text_bytes(batch["text"].combine_chunks())
    start, end, first = tokens(data, offsets)
    held = np.asarray(batch["lot"], dtype=np.int64) % 5 == 0
    row = np.repeat(np.arange(len(label)), np.diff(first))
    word = run_hashes(data, start, end)
    around = np.concatenate([np.zeros(1, np.uint64), word, np.zeros(1, np.uint64)])
    context = mixed(around[:-2] + np.uint64(3) * around[2:])
    learn = ~held[row]
    marks = marked_words(word[learn], context[learn], row[learn], label)
    aim = np.isin(word, marks) & (label[row] == 1)
    index = features(data, start, end, first)
    field = Field(np.zeros((KINDS, 1 << BITS)), -4.0, np.zeros((2, 2)))
    flat = index + (np.arange(KINDS)[:, None] << BITS)
    used, place = np.unique(flat[:, learn], return_inverse=True)
    place = place.reshape(KINDS, -1)
    weight = np.zeros(len(used))
    mean, square = np.zeros(len(used) + 5), np.zeros(len(used) + 5)
    chosen = np.flatnonzero(~held)
    own_first = np.concatenate([[0], np.cumsum(np.diff(first)[chosen])])
    wanted = aim[learn].astype(float)
    begins = np.zeros(len(wanted), bool)
    begins[own_first[:-1][own_first[:-1] < own_first[1:]]] = True
    pair = np.flatnonzero(~begins)
    state = wanted.astype(np.int64)
    seen = np.bincount(state[pair - 1] * 2 + state[pair], minlength=4).reshape(2, 2).astype(float)
    n = max(len(wanted), 1)
    for turn in range(1, turns + 1):  # Adam over the whole sample
        emit = weight[place].sum(0) + field.bias
        forward, backward, total = forward_backward(emit, own_first, field.move)
        of = total[np.repeat(np.arange(len(chosen)), np.diff(own_first))]
        marginal = np.exp(np.minimum(forward[:, 1] + backward[:, 1] - of, 0.0))
        error = (marginal - wanted) / n
        moved = np.zeros((2, 2))
        for i in (0, 1):
            for j in (0, 1):
                both = forward[pair - 1, i] + field.move[i, j] + (emit[pair] if j else 0.0) + backward[pair, j] - of[pair]
                moved[i, j] = np.exp(np.minimum(both, 0.0)).sum()
        slope = np.concatenate([np.bincount(place.ravel(), np.tile(error, KINDS), len(used)) + RIDGE * weight, [error.sum()], ((moved - seen) / n).ravel()])
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        step = STEP * (mean / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.99**turn)) + 1e-9)
        weight -= step[: len(used)]
        field.bias -= float(step[len(used)])
        field.move = field.move - step[len(used) + 1 :].reshape(2, 2)
        field.move -= field.move[0, 0]  # only differences count
    weights = np.zeros(KINDS << BITS)
    weights[used] = weight
    field.weights = weights.reshape(KINDS, -1).astype(np.float32)
    evidence = np.clip(field.read(data, offsets)[0], -30, 30)
    rest = held if held.any() and label[held].min() < label[held].max() else np.ones(len(label), bool)
    field.slope, field.shift = calibrated(evidence[rest], label[rest])
    return field


def calibrated(evidence: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the sigmoid that fits the labels of texts left out best (Newton's method, softened targets)."""
    n1, n0 = label.sum(), (1 - label).sum()
    aim = np.where(label > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x, a, b = evidence / 10, 1.0, 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g, w = p - aim, np.maximum(p * (1 - p), 1e-6)
        h = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(h, [(g * x).sum(), g.sum()])
        a, b = a - float(np.clip(step[0], -1, 1)), b - float(np.clip(step[1], -1, 1))
    return max(a, 0.01) / 10, b


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int, most_bytes: int, text_limit: int) -> DataFrame:
    """(toxic, lot, text): labelled texts by the hash of their id, up to ``rows`` rows and ``most_bytes`` bytes."""
    known = (
        labels.select(F.col("doc_id").alias("label_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("label_id IS NOT NULL AND toxic IN (0, 1)")
        .groupBy("label_id")
        .agg(F.max("toxic").alias("toxic"))
        .withColumn("lot", F.xxhash64(F.lit(11), "label_id"))
    )
    chosen = known.orderBy("lot", "label_id").limit(rows)
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull() & (F.octet_length("text") <= min(text_limit, most_bytes // 8)))
    found = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id")).select("toxic", "lot", "text")
    return within_bytes(saved(found.dropDuplicates(["lot", "text"]), "toxic-sample"), most_bytes)


def fit_toxicity(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, most_bytes: int = SAMPLE_BYTES) -> Field | None:
    """The field learned from the labelled texts of ``docs`` in one task, which returns its weights (KINDS * 2**BITS floats).

    Labels are of texts. Tokens are labelled by the words that mark toxic texts (``marked_words``): such a word is toxic in
    a text labelled toxic, every other token is not. The field then learns words, their first and last bytes, neighbours
    and moves between states. None without labelled texts of both kinds. The sample is bounded by ``rows``, ``most_bytes``
    and, per text, SAMPLE_TEXT_BYTES.
    """
    sample = labelled_sample(docs, labels, rows, most_bytes, SAMPLE_TEXT_BYTES)

    def train(group: pa.Table) -> pa.Table:
        order = group.sort_by([("lot", "ascending"), ("text", "ascending")])
        field = fitted(order)
        if field is None:
            return pa.table({"weights": pa.array([], pa.binary()), "rest": pa.array([], pa.list_(pa.float64()))})
        rest = [field.bias, *field.move.ravel().tolist(), field.slope, field.shift]
        return pa.table({"weights": pa.array([field.weights.tobytes()], pa.binary()), "rest": pa.array([rest], pa.list_(pa.float64()))})

    got = sample.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(train, "weights binary, rest array<double>").collect()
    if not got:
        return None
    rest = got[0]["rest"]
    weights = np.frombuffer(bytes(got[0]["weights"]), np.float32).reshape(KINDS, -1)
    return Field(weights, rest[0], np.array(rest[1:5]).reshape(2, 2), rest[5], rest[6])


def judge(docs: DataFrame, field: Field | None) -> tuple[DataFrame, dict[str, Column]]:
    """All columns of ``docs`` with score, verdict and spans (see ``score_toxicity``)."""

    def rows_of(batch: pa.RecordBatch) -> list[pa.Array]:
        n = batch.num_rows
        span_type = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("chance", pa.float32())])
        if field is None:
            return [pa.array(np.zeros(n)), pa.array(np.zeros(n, np.int32)), pa.array([[]] * n, pa.list_(span_type))]
        data, offsets = text_bytes(batch["text"])
        evidence, marginal, start, end, first = field.read(data, offsets)
        score = field.scores(evidence)
        # code points before every byte, to tell offsets in the text
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        hit = np.flatnonzero(marginal >= SPAN_FROM)
        row = np.searchsorted(first, hit, side="right") - 1
        base = points[offsets[:-1]][row]
        spans = pa.StructArray.from_arrays(
            [pa.array((points[start[hit]] - base).astype(np.int32)), pa.array((points[end[hit]] - base).astype(np.int32)), pa.array(marginal[hit].astype(np.float32))],
            ["start", "end", "chance"],
        )
        ends = np.searchsorted(hit, first)
        return [pa.array(score), pa.array((score >= PREDICT_FROM).astype(np.int32)), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), spans)]

    return add_columns(docs, FOUND, rows_of)


def score_toxicity(docs: DataFrame, field: Field | None) -> DataFrame:
    """(doc_id, score, predicted, spans) of every document.

    ``score`` is the calibrated probability that a label marks the text as toxic, from the odds that the field gives to at
    least one toxic token; ``predicted`` is 1 from PREDICT_FROM; ``spans`` lists the tokens whose marginal is SPAN_FROM or
    more, in code points (end exclusive).

    Null and empty texts have no token and get the score of a text without evidence; without a field all scores are 0.
    Texts of any length are read whole; null ids and repeated rows stay, and equal texts get equal scores; an empty table
    gives none; other columns are ignored.
    """
    rows, found = judge(docs.select("doc_id", "text"), field)
    return rows.select("doc_id", *[column.alias(name) for name, column in found.items()])


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4, is 2; false for null."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
