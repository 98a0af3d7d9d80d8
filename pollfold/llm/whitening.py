"""Embedding whitening: blockwise QR of centred rows, bidiagonalisation of R, dqds singular values, twisted factorisations."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pollfold.llm.common import dropped, saved

SCALE = 256
COMPONENTS = 4
# rows that one QR step takes in, and bytes of triangular factors that meet in one task
BLOCK_ROWS = 4096
FACTOR_BYTES = 64 << 20
EPS = float(np.finfo(float).eps)
# eigenvalues nearer than this share of the largest get vectors from different twists, made orthogonal
CLOSE = 1e-8
# whole numbers up to here add and multiply in 64 bits
SAFE = 1 << 62


def bidiagonalised(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, right) with r = left @ bidiagonal @ right.T, by Householder reflections from both sides."""
    a = np.array(r, float)
    d = a.shape[1]
    right = np.eye(d)

    def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
        """(v, scale): I - scale * v v' maps x onto its first axis."""
        norm = np.linalg.norm(x)
        if norm == 0 or not np.any(x[1:]):
            return x, 0.0
        v = x.copy()
        v[0] += np.copysign(norm, x[0])
        return v, 2.0 / float(v @ v)

    for k in range(d):
        v, scale = reflector(a[k:, k])
        if scale:
            a[k:, k:] -= scale * np.outer(v, v @ a[k:, k:])
        if k < d - 2:
            v, scale = reflector(a[k, k + 1 :])
            if scale:
                a[k:, k + 1 :] -= scale * np.outer(a[k:, k + 1 :] @ v, v)
                right[:, k + 1 :] -= scale * np.outer(right[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def dqds_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """The differential quotient-difference transform; None where the shift is above the least eigenvalue."""
    new_q, new_e, d = [], [], q[0] - shift
    for k in range(len(e)):
        if d < 0 or d + e[k] <= 0:
            return None
        new_q.append(d + e[k])
        t = q[k + 1] / new_q[-1]
        new_e.append(e[k] * t)
        d = d * t - shift
    if d < 0:
        return None
    return [*new_q, d], new_e


def squared_singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squares of the singular values of an upper bidiagonal matrix, falling, each with high relative accuracy."""
    found = []
    # (squares of the diagonal, squares above it, sum of the shifts so far)
    open_ = [([float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in above], 0.0)]
    while open_:
        q, e, moved = open_.pop()
        while q:
            cut = next((k for k in range(len(e) - 1, -1, -1) if e[k] <= (10 * EPS) ** 2 * (moved + min(q[k], q[k + 1])) or e[k] < 1e-300), None)
            if cut is not None:
                open_.append((q[: cut + 1], e[:cut], moved))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if len(q) == 1:
                found.append(moved + q[0])
                break
            if len(q) == 2:  # both roots of the last pair
                s = q[0] + q[1] + e[0]
                root = np.sqrt(max((q[0] - q[1] + e[0]) ** 2 + 4 * q[1] * e[0], 0.0))
                large = (s + root) / 2
                found += [moved + large, moved + q[0] * q[1] / large]
                break
            if q[0] < q[-1]:  # small values come to the end, where they are found
                q, e = q[::-1], e[::-1]
            # the lesser root of the last pair is near the least eigenvalue; a shift above it is refused
            s = q[-2] + q[-1] + e[-1]
            large = (s + np.sqrt(max((q[-2] - q[-1] + e[-1]) ** 2 + 4 * q[-1] * e[-1], 0.0))) / 2
            guess = float(q[-2] * q[-1] / large) if large > 0 else 0.0
            for shift in (guess * (1 - 1e-9), 0.75 * guess, 0.25 * guess, 0.0):
                if (step := dqds_step(q, e, shift)) is not None:
                    (q, e), moved = step, moved + shift
                    break
            else:  # a zero inside that the unshifted transform cannot pass: the pair around it has come apart
                e = [x if x > 0 else 0.0 for x in e]
                k = min(range(len(q)), key=q.__getitem__)
                e[min(k, len(e) - 1)] = 0.0
    return np.sort(np.maximum(found, 0.0))[::-1]


def twisted_vector(diagonal: np.ndarray, above: np.ndarray, value: float, nth: int = 0) -> np.ndarray:
    """Unit eigenvector of B'B (B upper bidiagonal) for an eigenvalue, from the factorisation twisted where its pivot is
    least (``nth`` least)."""
    q, e, n = diagonal**2, above**2, len(diagonal)
    tiny = np.finfo(float).tiny / EPS
    solid = lambda x: x if abs(x) > tiny else tiny
    down, up = np.empty(n), np.empty(n)
    low, high = np.empty(n - 1), np.empty(n - 1)
    down[0] = -value
    for i in range(n - 1):
        pivot = solid(down[i] + q[i])
        low[i] = diagonal[i] * above[i] / pivot
        down[i + 1] = e[i] * down[i] / pivot - value
    up[-1] = q[-1] - value
    for i in range(n - 2, -1, -1):
        pivot = solid(e[i] + up[i + 1])
        high[i] = diagonal[i] * above[i] / pivot
        up[i] = up[i + 1] * q[i] / pivot - value
    k = int(np.argsort(np.abs(down + up + value), kind="stable")[min(nth, n - 1)])
    z = np.zeros(n)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -low[i] * z[i + 1]
    for i in range(k, n - 1):
        z[i + 1] = -high[i] * z[i]
    return z / np.linalg.norm(z)


def leading_directions(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as rows) of r'r, the largest ``count`` of those above rounding."""
    diagonal, above, right = bidiagonalised(r)
    d = len(diagonal)
    size = np.abs(diagonal).max(initial=0.0) + np.abs(above).max(initial=0.0)
    cuts = [0, *(np.flatnonzero(np.abs(above) <= EPS * size) + 1).tolist(), d]
    # parts without a link have their own vectors, so equal values of different parts are no trouble
    values = [(v, lo, hi) for lo, hi in zip(cuts, cuts[1:]) for v in squared_singular_values(diagonal[lo:hi], above[lo : hi - 1])]
    values.sort(key=lambda x: (-x[0], x[1]))
    top = values[0][0] if values else 0.0
    chosen: list[tuple[float, int, np.ndarray]] = []
    for value, lo, hi in values[:count]:
        if value <= (d * EPS) ** 2 * top * 100 or value <= 0:
            break
        close = [z for v, at, z in chosen if at == lo and abs(v - value) <= CLOSE * top]
        z = twisted_vector(diagonal[lo:hi], above[lo : hi - 1], value, len(close))
        for _ in range(2 if close else 0):
            for other in close:
                z = z - (z @ other) * other
            z = z / np.linalg.norm(z)
        chosen.append((value, lo, z))
    vectors = np.zeros((len(chosen), d))
    for k, (_, lo, z) in enumerate(chosen):
        vectors[k, lo : lo + len(z)] = z
    return np.array([v for v, _, _ in chosen]), vectors @ right.T


def whole_numbers(embedding: Column) -> Column:
    """floor(SCALE * c) of every entry, as long."""
    return F.transform(embedding, lambda c: F.floor(c.cast("double") * F.lit(float(SCALE))).cast("long"))


def usable(rows: DataFrame, id_: str, vector: str) -> tuple[DataFrame, int]:
    """(id, x) of the rows whose vector is whole and of the usual length, and that length (0: no row)."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))
    good = rows.select(F.col(id_).alias("id"), F.col(vector).alias("vector")).where("vector IS NOT NULL").where(F.forall("vector", finite))
    usual = good.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n")).where("size > 0").agg(F.max(F.struct("n", "size")).alias("usual"))
    found = usual.first()["usual"]
    size = found["size"] if found else 0
    return good.where(F.size("vector") == size).select("id", whole_numbers(F.col("vector")).alias("x")), size


def matrix(batch: pa.RecordBatch, size: int) -> np.ndarray:
    return np.asarray(pa.compute.list_flatten(batch["x"]), np.int64).reshape(-1, size)


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_ROWS):
            yield batch.slice(start, BLOCK_ROWS)


def deviations(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """n * x - total, exact: 64-bit numbers where they fit, else Python's."""
    most = max(int(np.abs(x.astype(object)).max(initial=0)) if x.size and x.min() == np.iinfo(np.int64).min else int(np.abs(x).max(initial=0)), 1)
    if n * most + max(map(abs, total)) < SAFE:
        return n * x - np.array(total, np.int64)
    return n * x.astype(object) - np.array(total, object)


@dataclass
class Whitening:
    """What the fit list gives: rows and sums per dimension, eigenvalues with unit eigenvectors, and the trace."""

    n: int
    total: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """(rows x components): centred rows on the components, over the square root of the eigenvalue."""
        centred = deviations(x, self.n, self.total).astype(float) / self.n
        return centred @ self.vectors.T / np.sqrt(self.values)


def fit_whitening(fit: DataFrame, size: int, count: int = COMPONENTS) -> Whitening | None:
    """Components of the written table ``fit`` (x: distinct vectors of ``size`` entries); None if it is empty.

    Each task folds its rows, block by block, into one triangular factor; factors meet in groups of FACTOR_BYTES, round
    after round. The driver gets sums per dimension and the components, whatever the number of rows.
    """

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * size
        for batch in blocks(batches):
            x = matrix(batch, size)
            n += len(x)
            wide = len(x) * max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) >= SAFE
            total = [a + int(b) for a, b in zip(total, (x.astype(object) if wide else x).sum(0))]
        if n:
            values = pa.array(total, pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), values, pa.array([n] * size)], ["at", "total", "n"])

    sums = fit.mapInArrow(summed, "at int, total decimal(38,0), n long").groupBy("at").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    got = {r["at"]: (int(r["total"]), r["n"]) for r in sums.collect()}
    if not got:
        return None
    n, total = got[0][1], [got[k][0] for k in range(size)]

    def triangle(rows: np.ndarray) -> np.ndarray:
        r = np.linalg.qr(rows, mode="r")
        return np.vstack([r, np.zeros((size - len(r), size))])

    def factored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for batch in blocks(batches):
            centred = deviations(matrix(batch, size), n, total).astype(float) / n
            r = triangle(centred if r is None else np.vstack([r, centred]))
        if r is not None:
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()], pa.binary())], ["r"])

    def merged(group: pa.Table) -> pa.Table:
        r = None
        for blob in group["r"]:
            part = np.frombuffer(blob.as_py()).reshape(size, size)
            r = part if r is None else triangle(np.vstack([r, part]))
        return pa.table({"r": pa.array([r.tobytes()], pa.binary())})

    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch["r"]:
                r = np.frombuffer(blob.as_py()).reshape(size, size)
                values, vectors = leading_directions(r, count)
                trace = [float((r * r).sum())] * (len(values) + 1)
                # the last row carries the trace alone
                yield pa.RecordBatch.from_arrays(
                    [pa.array([*values.tolist(), None], pa.float64()), pa.array([*vectors.tolist(), None], pa.list_(pa.float64())), pa.array(trace)],
                    ["value", "vector", "trace"],
                )

    together = max(2, FACTOR_BYTES // (8 * size * size))
    factors = saved(fit.mapInArrow(factored, "r binary"), "whitening-factors")
    while (parts := factors.count()) > 1:
        groups = -(-parts // together)
        # evenly dealt: groups of about as many factors as may meet
        lot = F.pmod(F.xxhash64("r"), F.lit(groups)).alias("lot")
        fewer = saved(factors.select(lot, "r").groupBy("lot").applyInArrow(merged, "r binary"), "whitening-factors")
        dropped(factors)
        factors = fewer
    got = factors.mapInArrow(solved, "value double, vector array<double>, trace double").collect()
    dropped(factors)
    found = sorted((r for r in got if r["value"] is not None), key=lambda r: -r["value"])
    values = np.array([r["value"] for r in found]) / n
    vectors = np.array([r["vector"] for r in found]).reshape(len(found), size)
    model = Whitening(n, total, values, vectors, got[0]["trace"] / n)
    model.identity_error = identity_error(fit, model, size)
    return model


def identity_error(fit: DataFrame, model: Whitening, size: int) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    k = len(model.values)
    if not k:
        return 0.0

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in blocks(batches):
            w = model.whitened(matrix(batch, size))
            total += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(range(k * k), pa.int32()), pa.array(total.ravel())], ["at", "total"])

    got = fit.mapInArrow(products, "at int, total double").groupBy("at").agg(F.sum("total").alias("total")).collect()
    covariance = np.zeros(k * k)
    covariance[[r["at"] for r in got]] = [r["total"] for r in got]
    return float(np.abs(covariance.reshape(k, k) / model.n - np.eye(k)).max())


RESULT = "id {}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, id_: str = "vec_id", vector: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of every row with a whole vector, ``count`` rows each.

    Entries become whole numbers x = floor(SCALE * c). The fit list holds every distinct x once: ``n`` vectors with sums S.
    ``component`` numbers the eigenvectors of its covariance (divisor n) from 1 by falling eigenvalue; ``whitened`` is
    x - S/n on the eigenvector, over the root of the eigenvalue; ``deviation`` the exact sum of (n*x - S)^2 (null beyond 38
    digits); ``explained`` the eigenvalue's share of the trace; ``identity_error`` how far the covariance of the whitened
    fit list is from the identity.

    Rows whose vector is null, empty or holds null, NaN or infinite entries are left out, as are vectors of another length
    than the most frequent one (the longer, if two are as frequent). Components whose eigenvalue is zero up to rounding
    are left out, so a table of equal vectors gives no rows. Null ids and repeated rows stay; repeated vectors count once
    in the fit; an empty table gives none; other columns are ignored. Vectors of equal eigenvalues are some orthonormal
    choice. Vectors of any length are read whole; a task holds one block of rows and a square of the length.
    """
    good, size = usable(rows, id_, vector)
    schema = RESULT.format(good.schema["id"].dataType.simpleString())
    model = None
    if size:
        fit = saved(good.select("x").distinct(), "whitening-fit")
        model = fit_whitening(fit, size, count)
        dropped(fit)
    if model is None or not len(model.values):
        return rows.sparkSession.createDataFrame([], schema)
    k = len(model.values)
    explained = model.values / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            x = matrix(batch, size)
            apart = deviations(x, model.n, model.total)
            wide = apart.dtype == object or size * int(np.abs(apart).max(initial=0)) ** 2 >= SAFE
            apart = (apart.astype(object) ** 2).sum(1) if wide else (apart**2).sum(1)
            exact = [int(v) if v < 10**38 else None for v in apart.tolist()]
            each = np.repeat(np.arange(len(x)), k)
            count_ = len(each)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"].take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(count_, model.n, np.int64)),
                    pa.array(exact, pa.decimal128(38, 0)).take(pa.array(each)),
                    pa.array(model.whitened(x).ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(count_, model.identity_error)),
                ],
                ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return good.mapInArrow(run, schema)
