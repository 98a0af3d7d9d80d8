"""MinHash near-duplicates: banded candidates, sequential Bayesian pruning of signature batches, exact verification."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pollfold.llm.common import GAP, ascii_lower, columns_of, saved, slices, small_or_not, text_bytes
from pollfold.llm.components import components
from pollfold.llm.numtext import grams, mixed, word_hashes, words

WORDS = 5
PERCENT = 80
# a pair with 85 % in common shares none of the bands with probability 4e-7, one with 80 % 4e-5
BANDS, ROWS = 20, 4
HASHES = BANDS * ROWS
BATCH = 16
# pairs are given up when the similarity reaches the threshold with a posterior probability below this
MISS = 1e-6
STARS = 2
# shingles of one part of a bucket; larger buckets are compared part against part
BLOCK_SHINGLES = 400_000
_FACTORS = mixed(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)


def normal(text: Column) -> Column:
    """A-Z lower-cased words with single spaces; empty for null."""
    return F.coalesce(F.trim(F.regexp_replace(ascii_lower(text), GAP, " ")), F.lit(""))


def shingle_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of every run of WORDS words; of fewer words, the whole text is one."""
    start, end, first = words(data, offsets)
    hashed = word_hashes(data, start, end)
    n = np.diff(first)
    doc = np.repeat(np.arange(len(n)), np.maximum(n - WORDS + 1, 0))
    within = np.arange(len(doc)) - np.repeat(np.cumsum(np.maximum(n - WORDS + 1, 0)) - np.maximum(n - WORDS + 1, 0), np.maximum(n - WORDS + 1, 0))
    found = grams(hashed, WORDS)[first[:-1][doc] + within] if len(doc) else np.zeros(0, np.uint64)
    short = np.flatnonzero((n > 0) & (n < WORDS))
    whole = [grams(hashed[first[d] : first[d + 1]], int(n[d]))[0] for d in short]
    found, doc = np.concatenate([found, np.array(whole, np.uint64)]), np.concatenate([doc, short])
    order = np.argsort(doc, kind="stable")
    return found[order], doc[order]


def signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, node, n_shingles, signature): signature is HASHES unsigned 32-bit minima as bytes, null without words."""
    for batch in slices(batches):
        data, offsets = text_bytes(batch["text"])
        hashed, doc = shingle_hashes(data, offsets)
        _, at = np.unique(hashed ^ mixed(doc.astype(np.uint64) + np.uint64(1)), return_index=True)
        n = np.bincount(doc[at], minlength=batch.num_rows)
        some = np.flatnonzero(n)
        minima = np.zeros((len(some), HASHES), np.uint32)
        if len(some):
            first = np.searchsorted(doc, some)
            for k, factor in enumerate(_FACTORS):
                minima[:, k] = np.minimum.reduceat((hashed * factor) >> np.uint64(32), first)
        packed: list[bytes | None] = [None] * batch.num_rows
        for row, d in enumerate(some):
            packed[d] = minima[row].tobytes()
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["node"], pa.array(n.astype(np.int64)), pa.array(packed, pa.binary())], ["doc_id", "node", "n_shingles", "signature"]
        )


@lru_cache
def least_matches(percent: int, miss: float = MISS) -> list[int]:
    """For 0 to HASHES compared hashes, the fewest matches with which the pair stays.

    With a flat prior the similarity after m of n matches is Beta(m + 1, n - m + 1); its probability above the threshold t
    is that of at most m successes in n + 1 trials with chance t.
    """
    t, out = percent / 100, []
    for n in range(HASHES + 1):
        chance, total, m = (1 - t) ** (n + 1), 0.0, 0
        for m in range(n + 1):
            total += chance
            if total >= miss:
                break
            chance *= (n + 1 - m) / (m + 1) * t / (1 - t)
        out.append(m)
    return out


def stays(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Rows of two signature tables that no batch of hashes rules out."""
    least = least_matches(percent)
    alive, matches = np.arange(len(a)), np.zeros(len(a), np.int64)
    for n in range(BATCH, HASHES + 1, BATCH):
        matches[alive] += (a[alive, n - BATCH : n] == b[alive, n - BATCH : n]).sum(1)
        alive = alive[matches[alive] >= least[n]]
    return alive


def table_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, HASHES)


def pruned(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                alive = stays(table_of(batch["sa"]), table_of(batch["sb"]), percent)
                yield batch.select(["a", "b"]).take(pa.array(alive))

    return run


def block_links(percent: int):
    """Links between nodes with different labels in one pair of parts of a bucket, as many as are needed to connect them.

    A pair is looked at in the first band that it shares only; the signatures prune, then the sets are compared whole.
    """

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        column = lambda name: rows[name].combine_chunks() if isinstance(rows[name], pa.ChunkedArray) else rows[name]
        sig, band = table_of(column("signature")), int(column("band")[0].as_py())
        by_band = sig.reshape(-1, BANDS, ROWS)
        _, label = np.unique(np.array(column("label").to_pylist(), dtype=object), return_inverse=True)
        part, size = np.asarray(column("part")), np.asarray(column("n_shingles"))
        hashed, doc = shingle_hashes(*text_bytes(column("text")))
        names, word = np.unique(hashed, return_inverse=True)
        pairs = np.unique(doc.astype(np.int64) * max(len(names), 1) + word)
        doc, word = pairs // max(len(names), 1), pairs % max(len(names), 1)
        first = np.searchsorted(doc, np.arange(len(sig) + 1))
        left = np.flatnonzero(part == key[1].as_py())
        right = left if key[1] == key[2] else np.flatnonzero(part == key[2].as_py())
        a, b, mark = [], [], np.zeros(len(names), bool)
        for i in left:
            near = right[(label[right] != label[i]) & (100 * np.minimum(size[right], size[i]) >= percent * np.maximum(size[right], size[i]))]
            near = near[near > i] if right is left else near
            near = near[~(by_band[near, :band] == by_band[i, :band]).all(2).any(1)]
            if len(near):
                near = near[stays(np.broadcast_to(sig[i], (len(near), HASHES)), sig[near], percent)]
            if not len(near):
                continue
            mark[word[first[i] : first[i + 1]]] = True
            length = first[near + 1] - first[near]
            at = np.repeat(first[near] - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(length.sum())
            both = np.add.reduceat(mark[word[at]].astype(np.int64), np.concatenate([[0], np.cumsum(length)[:-1]]))
            mark[word[first[i] : first[i + 1]]] = False
            for j in near[100 * both >= percent * (size[i] + length - both)]:
                if label[i] != label[j]:
                    label[label == label[j]] = label[i]
                    a.append(i)
                    b.append(j)
        nodes = column("node")
        return pa.Table.from_arrays([nodes.take(pa.array(np.array(x, np.int64))) for x in (a, b)], ["a", "b"])

    return run


def shingle_set(text: str) -> set:
    found = text.split(" ")
    return set(zip(*(found[i:] for i in range(WORDS)))) if len(found) >= WORDS else {tuple(found)}


def confirmed(percent: int):
    """Pairs whose full shingle sets have ``percent`` of their union in common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[bytes | None, set] = (None, set())
        for batch in batches:
            good = []
            rows = zip(*(batch[c].to_pylist() for c in ("a", "ta", "tb")))
            for at, (a, ta, tb) in enumerate(rows):
                if a != last[0]:
                    last = (a, shingle_set(ta))
                one, other = last[1], shingle_set(tb)
                both = len(one & other)
                if 100 * both >= percent * (len(one) + len(other) - both):
                    good.append(at)
            if batch.num_rows:
                yield batch.select(["a", "b"]).take(pa.array(good, pa.int64()))

    return run


def classes(docs: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(rows, groups): doc_id, node and n_shingles of every row; node, component, component_id and n_links of every
    text that has copies or links.

    A node is the digest of a text's words: copies are one node from the start. Bands give buckets of nodes; inside a
    bucket no pairs are listed: all nodes are compared with one of them, then, where labels still differ, with another,
    and what is left part against part, with only the links that connect different labels written.
    """
    node = F.unhex(F.md5("text"))
    texts = docs.select("doc_id", normal(F.col("text")).alias("text")).withColumn("node", node)
    rows = saved(texts.mapInArrow(signatures, "doc_id long, node binary, n_shingles long, signature binary"), "signatures")
    found = rows.where("n_shingles > 0")
    unique = saved(
        found.groupBy("node").agg(
            F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), F.min("n_shingles").alias("n_shingles"), F.min("signature").alias("signature")
        ),
        "texts",
    )
    bands = F.array(*[F.xxhash64(F.lit(k), F.substring("signature", 4 * ROWS * k + 1, 4 * ROWS)) for k in range(BANDS)])
    listed = unique.select("node", "n_shingles", F.posexplode(bands).alias("band", "bucket"))
    shared = listed.groupBy("bucket").agg(F.count("*").alias("members"), F.sum("n_shingles").alias("weight")).where("members > 1")
    shared = saved(shared, "buckets")
    members = saved(listed.join(shared, "bucket").select("bucket", "band", "weight", "node"), "members")
    candidates = saved(members.select("node").distinct(), "candidates")
    light = saved(unique.join(candidates, "node", "left_semi").select("node", "first_id", "n_shingles", "signature"), "candidate-signatures")
    # a node and an id are 32 bytes; without a broadcast all texts would be shuffled for the few that are candidates
    whole = texts.join(small_or_not(light.select("node", "first_id"), 32), "node").where(F.col("doc_id").eqNullSafe(F.col("first_id")))
    whole = saved(whole.select("node", "text").dropDuplicates(["node"]), "candidate-texts")

    def linked(pairs: DataFrame) -> DataFrame:
        one = light.select(F.col("node").alias("a"), F.col("n_shingles").alias("na"), F.col("signature").alias("sa"))
        other = light.select(F.col("node").alias("b"), F.col("n_shingles").alias("nb"), F.col("signature").alias("sb"))
        sized = pairs.join(one, "a").join(other, "b").where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
        alive = saved(sized.select("a", "b", "sa", "sb").mapInArrow(pruned(percent), "a binary, b binary"), "survivors")
        ta, tb = whole.select(F.col("node").alias("a"), F.col("text").alias("ta")), whole.select(F.col("node").alias("b"), F.col("text").alias("tb"))
        full = alive.join(tb, "b").join(ta, "a")
        return saved(full.mapInArrow(confirmed(percent), "a binary, b binary"), "links")

    links, labels = None, candidates.withColumn("label", F.col("node"))
    ordered = lambda x, y: (F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    for turn in range(STARS + 1):
        held = members.join(labels, "node")
        spread = held.groupBy("bucket").agg(F.min(F.struct(F.xxhash64(F.lit(turn), "node"), "node", "label")).alias("c"), F.min("label").alias("l0"), F.max("label").alias("l1"))
        open_ = saved(spread.where("l0 != l1").select("bucket", F.col("c.node").alias("centre"), F.col("c.label").alias("centre_label")), "open-buckets")
        if open_.isEmpty():
            break
        if turn < STARS:
            pairs = held.join(open_, "bucket").where("label != centre_label").select(*ordered("node", "centre")).distinct()
        else:
            n = F.ceil(F.col("weight") / BLOCK_SHINGLES).cast("int")
            other = F.explode(F.sequence(F.lit(0), n - 1))
            blocks = held.join(open_.select("bucket"), "bucket").join(light, "node").join(whole, "node")
            blocks = blocks.withColumn("part", F.pmod(F.hash("node"), n)).withColumn("other", other).select(
                "bucket", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "band", "part", "node", "label",
                "n_shingles", "signature", "text",
            )
            crossed = blocks.groupBy("bucket", "i", "j").applyInArrow(block_links(percent), "a binary, b binary")
            pairs = crossed.select(*ordered("a", "b")).distinct()
        more = linked(saved(pairs, "pairs"))
        links = more if links is None else links.union(more)
        grouped = components(links)
        labels = saved(candidates.join(grouped, "node", "left").select("node", F.coalesce("label", "node").alias("label")), "node-labels")
    if links is None:
        links = members.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    degree = links.select(F.col("a").alias("node")).union(links.select("b")).groupBy("node").agg(F.count("*").alias("n_links"))
    joined = unique.select("node", "first_id", "copies").join(labels.join(degree, "node", "left"), "node", "left")
    joined = joined.withColumn("component", F.coalesce("label", "node"))
    least = joined.groupBy("component").agg(F.min("first_id").alias("component_id"), F.sum("copies").alias("rows")).where("rows > 1")
    least = saved(least.drop("rows"), "component-ids")
    groups = joined.join(least, "component").select("node", "component", "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return rows.select("doc_id", "node", "n_shingles"), saved(groups, "groups")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, n_links) of every document.

    Words are runs of anything but the six ASCII spaces, A-Z lower-cased; a document's set holds its distinct runs of five
    words, or all its words if they are fewer. Documents with 100 * intersection >= ``percent`` * union of their sets are
    linked; ``component_id`` is the smallest doc_id reachable, ``kept`` says that it is the document's own. ``n_links``
    counts the links confirmed between its text and other texts, of which enough are looked for to find all components.

    Null, empty and blank texts have no set and no link. Null ids come after all others: a component of rows without id
    has none. Repeated rows are copies with the same id, all kept. Texts of any length are compared whole; an empty table
    gives none; other columns are ignored.
    """
    rows, groups = classes(docs.select("doc_id", "text"), percent)
    found = rows.join(groups, "node", "left")
    component = F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def without_near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One document of each component, the one with the smallest id; documents without words stay. All columns of ``docs``.

    Of several rows with that id and a text of the component, the one with the least hash of all columns (but for maps) stays,
    so that reruns agree."""
    _, groups = classes(docs.select("doc_id", "text"), percent)
    node = "_node"
    while node in docs.columns:
        node = "_" + node
    digests = F.unhex(F.md5(normal(F.col("text"))))
    side = groups.select(F.col("node").alias(node), F.col("component").alias(node + "c"), F.col("component_id").alias(node + "i"))
    marked = docs.withColumn(node, digests).join(side, node, "left")
    single = marked.where(F.col(node + "c").isNull())
    first = marked.where(F.col(node + "c").isNotNull() & F.col("doc_id").eqNullSafe(F.col(node + "i")))
    digest = F.xxhash64(*[F.col(f"`{f.name}`") for f in docs.schema if f.dataType.typeName() != "map"])
    least = F.min_by(F.struct(*columns_of(docs)), digest).alias(node)
    first = first.groupBy(node + "c").agg(least).select(*[F.col(node)[c].alias(c) for c in docs.columns])
    return single.drop(node, node + "c", node + "i").unionByName(first)
