"""Mixing sources to target weights: Sainte-Laguë quotas of equal-token blocks, per source and per shard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pollfold.llm.common import n_words, saved

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
BLOCK_WORDS = 16
SHARD_WORDS = 1_000_000
BROADCAST_ROWS = 50_000
SEED = 20


def ranked(sources: DataFrame) -> DataFrame:
    """Sources with ``nth`` from 0 in code-point order, null last: sorted in ranges, so that no task sees them all."""
    order = [F.col("source").isNull(), F.col("source")]
    parts = sources.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = saved(parts.withColumn("at", F.monotonically_increasing_id()), "mix-sources").withColumn("part", F.shiftright("at", 33))
    counts = numbered.groupBy("part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offset = F.col("at") - F.shiftleft("part", 33)
    return numbered.join(counts.select("part", before.alias("before")), "part").withColumn("nth", F.col("before") + offset).drop("part", "before", "at")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target) of rows (source, source_size): ``share`` of all sizes dealt by weight; what exceeds
    ``most`` times a source's size is dealt again by weight among the others, until none is above."""
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    known = ranked(sizes).withColumn("weight", F.element_at(cycle, (F.col("nth") % len(weights) + 1).cast("int")))
    known = saved(known.withColumn("limit", F.col("source_size") * F.lit(float(most))), "mix-weights")
    level = 0.0
    while True:  # words per unit of weight; every turn fills at least one more source, so the level rises and then stays
        full = F.col("limit") <= F.col("weight") * level
        row = known.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(full, F.col("limit")).otherwise(0.0)).alias("spent"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        raised = max(0.0, share * (row["all"] or 0) - row["spent"]) / row["open"] if row["open"] else level
        if raised <= level * (1 + 1e-12):
            break
        level = raised
    return known.select("source", "source_size", F.least("limit", F.col("weight") * F.lit(level)).alias("target"))


def sainte_lague(claims: DataFrame, group: str, claim: str, seats: str) -> DataFrame:
    """``quota`` of every row: the ``seats`` of its group go to the highest quotients claim / (2k + 1).

    Rounding claim / (total / seats) is off by at most half the rows of the group, so that the last divisor lies close
    by: a row's quota is within its share of the rows, plus two, of that rounding. Only seats in this range are listed
    and ranked, some five a row; all below are given. ``tie`` settles equal quotients.
    """
    whole = Window.partitionBy(group)
    share = F.try_divide(F.col(claim), F.sum(claim).over(whole))
    near = F.floor(share * F.col(seats) + 0.5)
    reach = F.ceil(F.coalesce(share, F.lit(0.0)) * F.count("*").over(whole)) + 2
    ranged = claims.withColumn("_low", F.coalesce(F.greatest(near - reach, F.lit(0)), F.lit(0)).cast("long")).withColumn(
        "_high", F.coalesce(near + reach, F.lit(0)).cast("long")
    )
    ranged = ranged.withColumn("_left", F.col(seats) - F.sum("_low").over(whole))
    listed = ranged.withColumn("_seat", F.explode(F.sequence("_low", "_high")))
    quotient = F.col(claim) / (2 * F.col("_seat") + 1)
    place = F.row_number().over(whole.orderBy(quotient.desc(), "tie", "_seat"))
    won = ((place <= F.col("_left")) & (F.col(claim) > 0)).cast("long")
    return (
        listed.withColumn("_won", won)
        .groupBy(*claims.columns, "_low")
        .agg(F.sum("_won").alias("_sum"))
        .withColumn("quota", F.col("_low") + F.col("_sum"))
        .drop("_low", "_sum")
    )


def _with(rows: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    """The row of ``small`` with the same keys, null equal to null; broadcast only if it was counted to be small."""
    side = small.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in small.columns if c not in keys])
    if side.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        side = F.broadcast(side)
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return rows.join(side, same).drop(*[f"_{k}" for k in keys])


def mix(
    docs: DataFrame,
    weights=WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: int = SEED,
    key: str = "doc_id",
) -> DataFrame:
    """(doc_id, size, source_size, target, taken, shard, shard_quota) of every document.

    Sizes are words. Sources get ``weights`` in turn by code point, null last. Each source is cut into shards of about
    ``shard_words`` by a seeded hash of the id. Blocks of ``block_words`` go by highest quotients to sources (by
    target), then within a source to its shards (by size). A shard's documents are laid out in a seeded order and its
    quota of blocks is read from the start, again from the start when the shard ends; ``taken`` is how many words of a
    document were read. No document is taken more than ``most`` times.

    Null texts and texts without words have size 0 and nothing taken; null ids and repeated rows are documents of their
    own; equal ids are ordered by size; an empty table gives none; other columns are ignored.
    """
    sizes = docs.select(F.col(key).alias("doc_id"), F.col("source").alias("source"), n_words(F.col("text")).alias("size"))
    sizes = saved(sizes, "mix-sizes")
    aims = saved(targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most), "mix-targets")
    seats = F.floor(F.sum("target").over(Window.partitionBy("all")) / block_words + 0.5)
    claims = aims.withColumn("all", F.lit(0)).withColumn("tie", F.col("source")).withColumn("seats", seats.cast("long"))
    quotas = sainte_lague(claims, "all", "target", "seats").select("source", "source_size", "target", F.col("quota").alias("blocks"))
    quotas = quotas.withColumn("n_shards", F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1)).cast("long"))
    quotas = saved(quotas.withColumn("source_no", F.monotonically_increasing_id()), "mix-quotas")
    # the source of a row is now a number, so that null needs no care
    hashed = F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    placed = saved(
        _with(sizes, quotas, ["source"]).select(
            "doc_id", "size", "source_no", F.pmod(hashed, F.col("n_shards")).alias("shard"), F.xxhash64(hashed).alias("lot")
        ),
        "mix-placed",
    )
    shards = placed.groupBy("source_no", "shard").agg(F.sum("size").alias("shard_size"))
    shards = _with(shards, quotas.select("source_no", "blocks", "source_size", "target"), ["source_no"]).withColumn("tie", F.col("shard"))
    shards = saved(sainte_lague(shards, "source_no", "shard_size", "blocks"), "mix-shards")
    laid = Window.partitionBy("source_no", "shard").orderBy("lot", F.col("doc_id").asc_nulls_last(), "size")
    spread = placed.withColumn("end", F.sum("size").over(laid.rowsBetween(Window.unboundedPreceding, 0)))
    read = F.least(F.col("quota") * block_words, F.col("shard_size") * most)
    rounds = F.coalesce(F.floor(F.try_divide(read, F.col("shard_size"))), F.lit(0))
    rest = read - rounds * F.col("shard_size")
    part = F.greatest(F.lit(0), F.least(F.col("end"), rest) - (F.col("end") - F.col("size")))
    dealt = _with(spread, shards.drop("tie", "blocks"), ["source_no", "shard"])
    return dealt.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (rounds * F.col("size") + part).cast("long").alias("taken"),
        "shard",
        F.col("quota").alias("shard_quota"),
    )
