"""Language identification: interpolated Kneser-Ney character models per language in sorted hash arrays."""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pollfold.llm.common import SLICE_BYTES, saved, slices
from pollfold.llm.numtext import mixed, sums

ORDER = 4
BITS = 12
# a model is sent to the tasks as arrays up to this size; a larger one stays in tables that the texts' grams are joined with
SHIPPED_BYTES = 1 << 25
MAX_LANGUAGES = 500
# steps of cross-entropy to a bit, by which the texts of a language are counted for its limit
STEPS = 4096
REJECT_ABOVE = 0.995
UNKNOWN = "und"
# weight of a text's evidence in the score, in letters at most
EVIDENCE = 50


@cache
def letter_classes() -> np.ndarray:
    """Class of every code point: 0 for what is no letter, else 1 to 4095 by its lower-case form."""
    out = np.zeros(sys.maxunicode + 1, np.int64)
    for c in range(sys.maxunicode + 1):
        if (ch := chr(c)).isalpha():
            low = ord(ch.lower()[0])
            out[c] = low if low < 2048 else 2048 + low % 2047
    return out


def letters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(classes, offsets, letters per text): runs of other characters are one 0, and every text starts with ORDER - 1 zeros."""
    texts = [t or "" for t in texts]
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.array([len(t) for t in texts], np.int64)
    first = np.concatenate([[0], np.cumsum(size)])
    kinds = letter_classes()[codes]
    is_start = np.zeros(len(kinds) + 1, bool)
    is_start[first] = True
    keep = kinds > 0
    keep[1:] |= (kinds[:-1] > 0) & ~is_start[1:-1]
    before = np.concatenate([[0], np.cumsum(keep)])[first]
    n_letters = np.diff(np.concatenate([[0], np.cumsum(kinds > 0)])[first])
    pad = (ORDER - 1) * np.arange(len(first))
    offsets = before + pad
    out = np.zeros(int(offsets[-1]), np.int64)
    row = np.repeat(np.arange(len(texts)), np.diff(before))
    out[np.arange(before[-1]) + (ORDER - 1) * (row + 1)] = kinds[keep]
    return out, offsets, n_letters


def packed(classes: np.ndarray, n: int) -> np.ndarray:
    """Every n classes in a row as one number."""
    count = max(len(classes) - n + 1, 0)
    out = np.zeros(count, np.int64)
    for i in range(n):
        out = (out << BITS) | classes[i : i + count]
    return out


def ends_inside(offsets: np.ndarray, n_classes: int) -> np.ndarray:
    """Of every gram of ORDER classes, whether it ends inside the text it starts in."""
    inside = np.ones(n_classes, bool)
    for i in range(ORDER - 1):  # grams that start in a text's last places reach into the next one
        inside[np.maximum(offsets[1:] - 1 - i, 0)] = False
    return inside[: max(n_classes - ORDER + 1, 0)]


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of every slice: grams of ORDER classes that end inside a text."""
    for batch in slices(batches):
        classes, offsets, _ = letters(batch["text"].to_pylist())
        langs = batch["lang"].dictionary_encode()
        grams = packed(classes, ORDER)
        which = np.repeat(np.asarray(langs.indices, np.int64), np.diff(offsets))[: len(grams)]
        inside = ends_inside(offsets, len(classes))
        found, n = np.unique(grams[inside] | (which[inside] << (ORDER * BITS)), return_counts=True)
        names = langs.dictionary.take(pa.array(found >> (ORDER * BITS)))
        yield pa.RecordBatch.from_arrays([names.cast(pa.string()), pa.array(found & ((1 << (ORDER * BITS)) - 1)), pa.array(n)], ["lang", "gram", "n"])


@dataclass
class Model:
    """Per order, sorted hashes of grams with their discounted share and of contexts with the weight of the lower order,
    a column per language."""

    langs: list[str]
    grams: list[tuple[np.ndarray, np.ndarray]]
    contexts: list[tuple[np.ndarray, np.ndarray]]
    uniform: float
    limits: np.ndarray | None = None

    def chances(self, grams: np.ndarray) -> np.ndarray:
        """Probability of the last class of each ORDER-gram after the others: a row per gram, a column per language."""
        p = np.full((len(grams), len(self.langs)), self.uniform)
        for n in range(1, ORDER + 1):
            own = grams & ((1 << (n * BITS)) - 1)
            p = found_in(self.grams[n - 1], own, 0.0) + found_in(self.contexts[n - 1], own >> BITS, 1.0) * p
        return p

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(bits per character in every language, letters) of every text."""
        return entropies(texts, self.chances)


@dataclass
class WrittenModel:
    """The same as tables (gram, values) per order, with an array over the languages, for any number of grams."""

    langs: list[str]
    grams: list[DataFrame]
    contexts: list[DataFrame]
    uniform: float
    limits: np.ndarray | None = None

    def chances(self, grams: DataFrame) -> DataFrame:
        """(gram, p) of distinct ORDER-grams: the probability of the last class after the others in every language."""
        p = F.array_repeat(F.lit(self.uniform), len(self.langs))
        for n in range(1, ORDER + 1):
            own = F.col("gram").bitwiseAND((1 << (n * BITS)) - 1)
            grams = grams.select("*", own.alias("own"), F.shiftright(own, BITS).alias("context"))
            alpha = self.grams[n - 1].select(F.col("gram").alias("own"), F.col("values").alias("alpha"))
            gamma = self.contexts[n - 1].select(F.col("gram").alias("context"), F.col("values").alias("gamma"))
            grams = grams.join(alpha, "own", "left").join(gamma, "context", "left")
            lower = F.when(F.col("gamma").isNull(), p).otherwise(F.zip_with("gamma", p, lambda g, q: g * q))
            p = F.when(F.col("alpha").isNull(), lower).otherwise(F.zip_with("alpha", lower, lambda a, q: a + q))
            grams, p = grams.select("gram", p.alias("p")), F.col("p")
        return grams


def entropies(texts: list[str | None], chances: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(bits per character in every language, letters) of every text, by the chances of distinct grams."""
    classes, offsets, n_letters = letters(texts)
    grams = packed(classes, ORDER)
    unique, at = np.unique(grams, return_inverse=True)
    bits = -np.log2(np.maximum(chances(unique), 1e-12))
    n = np.maximum(np.diff(offsets) - (ORDER - 1), 1)
    return np.stack([sums(bits[at, k], offsets, ORDER - 1) / n for k in range(bits.shape[1])], 1), n_letters


RowsOf = Callable[[pa.RecordBatch, np.ndarray, np.ndarray], list]


def scored(rows: DataFrame, model: Model | WrittenModel, rows_of: RowsOf, schema: str) -> DataFrame:
    """``rows_of(batch, bits, letters)`` of all ``rows``, with the entropies of their ``text``."""
    names = T._parse_datatype_string(schema).names
    if isinstance(model, Model):

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                yield pa.RecordBatch.from_arrays(rows_of(batch, *model.entropies(batch["text"].to_pylist())), names)

        return rows.mapInArrow(run, schema)

    n_langs = len(model.langs)
    # a slice's distinct grams come with an array over the languages each
    limit = SLICE_BYTES * 8 // max(n_langs, 8)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for k, batch in enumerate(slices(batches, limit=limit)):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(batch.num_rows, first + k)), *batch.columns], ["slice", *batch.schema.names])

    def distinct_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = np.asarray(batch["slice"])
            for k in np.unique(number):
                classes, offsets, _ = letters(batch["text"].filter(pa.array(number == k)).to_pylist())
                grams = np.unique(packed(classes, ORDER)[ends_inside(offsets, len(classes))])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(grams), k)), pa.array(grams)], ["slice", "gram"])

    def together(texts: pa.Table, found: pa.Table) -> pa.Table:
        keys = np.asarray(found["gram"], np.int64)
        p = np.asarray(pa.compute.list_flatten(found["p"].combine_chunks()), np.float64).reshape(-1, n_langs)
        order = np.argsort(keys, kind="stable")
        keys, p = keys[order], p[order]

        def chances(grams: np.ndarray) -> np.ndarray:
            if not len(keys):
                return np.ones((len(grams), n_langs))
            at = np.minimum(np.searchsorted(keys, grams), len(keys) - 1)
            return np.where((keys[at] == grams)[:, None], p[at], 1.0)  # only grams across two texts are missing

        batch = pa.RecordBatch.from_arrays([c.combine_chunks() for c in texts.columns], texts.column_names)
        return pa.Table.from_arrays(rows_of(batch, *entropies(batch["text"].to_pylist(), chances)), names)

    rows = saved(rows.mapInArrow(numbered, T.StructType([T.StructField("slice", T.LongType()), *rows.schema.fields])), "lang-slices")
    grams = saved(rows.select("slice", "text").mapInArrow(distinct_grams, "slice long, gram long"), "lang-slice-grams")
    found = grams.join(model.chances(grams.select("gram").distinct()), "gram")
    return rows.groupBy("slice").cogroup(found.select("slice", "gram", "p").groupBy("slice")).applyInArrow(together, schema)


def hashed(keys: np.ndarray) -> np.ndarray:
    return mixed(keys.astype(np.uint64))


def found_in(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray, missing: float) -> np.ndarray:
    sorted_hashes, values = table
    if not len(sorted_hashes):
        return np.full((len(keys), values.shape[1]), missing)
    h = hashed(keys)
    at = np.minimum(np.searchsorted(sorted_hashes, h), len(sorted_hashes) - 1)
    return np.where((sorted_hashes[at] == h)[:, None], values[at], missing)


def _kneser_ney(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(grams with alpha, contexts with gamma) of counts (lang, gram, n) of one order."""
    by_lang = counts.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("n1"), F.count_if(F.col("n") == 2).alias("n2"))
    discount = F.when((F.col("n1") > 0) & (F.col("n2") > 0), F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(0.5)
    # one row per language, of which there are MAX_LANGUAGES at most
    by_lang = F.broadcast(by_lang.select("lang", discount.alias("discount")))
    context = F.shiftright("gram", BITS)
    contexts = counts.groupBy("lang", context.alias("context")).agg(F.sum("n").alias("total"), F.count("*").alias("types"))
    alpha = F.greatest(F.col("n") - F.col("discount"), F.lit(0.0)) / F.col("total")
    grams = counts.withColumn("context", context).join(contexts, ["lang", "context"]).join(by_lang, "lang")
    gamma = F.col("discount") * F.col("types") / F.col("total")
    return grams.select("lang", "gram", alpha.alias("value")), contexts.join(by_lang, "lang").select(
        "lang", F.col("context").alias("gram"), gamma.alias("value")
    )


def _array(rows: DataFrame, langs: list[str], missing: float) -> tuple[np.ndarray, np.ndarray]:
    got = rows.toArrow()
    keys, at = np.unique(hashed(np.asarray(got["gram"], np.int64)), return_inverse=True)
    values = np.full((len(keys), len(langs)), missing, np.float32)
    code = {name: i for i, name in enumerate(langs)}
    lang = got["lang"].combine_chunks().dictionary_encode()
    column = np.array([code[x] for x in lang.dictionary.to_pylist()], np.int64)[np.asarray(lang.indices)] if len(at) else np.zeros(0, np.int64)
    values[at, column] = np.asarray(got["value"], np.float32)
    return keys, values


def _table(rows: DataFrame, langs: list[str], missing: float) -> DataFrame:
    """(gram, values) with an array over the languages."""
    by_lang = rows.groupBy("gram").agg(F.map_from_entries(F.collect_list(F.struct("lang", F.col("value").cast("float")))).alias("m"))
    values = F.transform(F.array(*map(F.lit, langs)), lambda x: F.coalesce(F.try_element_at("m", x), F.lit(missing).cast("float")))
    return saved(by_lang.select("gram", values.alias("values")), "lang-model")


def train(docs: DataFrame, shipped_bytes: int = SHIPPED_BYTES) -> Model | WrittenModel | None:
    """Kneser-Ney models of all texts of ``docs`` (doc_id, text, lang); rows without text or language teach nothing.

    Grams of four are counted over all texts; the lower orders count in how many contexts a gram continues. Every gram and
    context is kept: as arrays up to ``shipped_bytes``, in tables above, with the same results.
    """
    known = docs.where("text IS NOT NULL AND lang IS NOT NULL")
    counts = known.select("lang", "text").mapInArrow(count_grams, "lang string, gram long, n long")
    counts = saved(counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "lang-grams")
    langs = [r["lang"] for r in counts.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect()]
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not langs:
        return None
    langs.sort()
    orders = [counts]
    for n in range(ORDER - 1, 0, -1):
        suffix = F.col("gram").bitwiseAND((1 << (n * BITS)) - 1)
        orders.insert(0, saved(orders[0].groupBy("lang", suffix.alias("gram")).agg(F.count("*").alias("n")), "lang-grams"))
    # no order has more contexts than grams
    size = 2 * sum(x.count() for x in orders) * (8 + 4 * len(langs))
    kind, kept = (Model, _array) if size <= shipped_bytes else (WrittenModel, _table)
    grams, contexts = [], []
    for x in orders:
        alpha, gamma = _kneser_ney(x)
        grams.append(kept(alpha, langs, 0.0))
        contexts.append(kept(gamma, langs, 1.0))
    n_first = len(grams[0][0]) if kind is Model else grams[0].count()
    model = kind(langs, grams, contexts, 1 / max(n_first, 1))
    model.limits = calibrated(model, known)
    return model


def calibrated(model: Model | WrittenModel, known: DataFrame) -> np.ndarray:
    """Per language the cross-entropy that few of its own texts exceed, over all learned texts.

    Texts are counted per step of cross-entropy, of which there are few, so that the limit is found without sorting them; it
    is the end of the step that holds the exact one.
    """
    langs = model.langs

    def own(batch: pa.RecordBatch, bits: np.ndarray, _: np.ndarray) -> list:
        steps = [math.ceil(bits[i, langs.index(x)] * STEPS) for i, x in enumerate(batch["lang"].to_pylist())]
        return [batch["lang"], pa.array(steps, pa.int64())]

    found = scored(known.select("lang", "text"), model, own, "lang string, step long")
    counts = found.groupBy("lang", "step").agg(F.count("*").alias("n"))
    got = counts.groupBy("lang").agg(F.ceil(F.percentile("step", REJECT_ABOVE, F.col("n"))).alias("limit")).collect()
    limit = {r["lang"]: r["limit"] / STEPS for r in got}
    return np.array([limit.get(x, np.inf) for x in model.langs])


def identify(docs: DataFrame, model: Model | WrittenModel | None) -> DataFrame:
    """(doc_id, lang_pred, score, bits, accepted) of every document.

    ``lang_pred`` has the lowest cross-entropy ``bits`` (per character), of equal ones the first by name; ``score`` is its
    share of the probability among the languages, with a text's evidence counted for EVIDENCE letters at most;
    ``accepted`` is false where ``bits`` is above the calibrated limit of the language.

    Texts that are null or have no letter are ``und`` with score 0, not accepted, as is everything without a model; texts
    of any length are scored whole; null ids and repeated rows stay; an empty table gives none; other columns are ignored.
    """

    rows = docs.select("doc_id", "text")
    schema = "doc_id long, lang_pred string, score double, bits double, accepted boolean"
    if model is None:
        return rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("bits"), F.lit(False).alias("accepted"))
    langs, limits = model.langs, model.limits

    def best(batch: pa.RecordBatch, bits: np.ndarray, n_letters: np.ndarray) -> list:
        first = bits.argmin(1)
        low = bits[np.arange(len(bits)), first]
        weight = np.log(2) * np.minimum(n_letters, EVIDENCE)[:, None]
        share = 1 / np.exp(np.maximum(-(bits - low[:, None]) * weight, -700)).sum(1)
        some = n_letters > 0
        lang = [langs[k] if s else UNKNOWN for k, s in zip(first, some)]
        accepted = some & (low <= limits[first])
        return [batch["doc_id"], pa.array(lang, pa.string()), pa.array(np.where(some, share, 0.0)), pa.array(np.where(some, low, np.nan), from_pandas=True), pa.array(accepted)]

    return scored(rows, model, best, schema)


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3, is 1; false for null."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))
