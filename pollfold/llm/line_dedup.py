"""Line dedup: exact set-similarity join of lines with prefix, length, positional and bitmap filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pollfold.llm.common import NO_ID, OTHER_CAPITALS, ascii_lower, columns_of, dropped, saved, small_or_not

PERCENT = 80
# tokens are counted in this many hashed bins, a table of fixed size that every task can hold
RARITY_BINS = 1 << 20
# levels of rarity to a doubling of the count; a level is below 128 for any count below 2**31
LEVELS = 4
# prefix tokens by which a set meets its likely partner: this many of the rarest and, as these may be the ones that only this
# copy has, the first of every step of rarity (half a doubling of the count) after them
HEADS = 2
STEP_BITS = 1
# sizes of one class differ by less than this share; a set also looks into the next class below
SIZE_CLASS = 1.12
# numbers of 64 bits that sum up a set before its tokens are read
WIDE = 4
# sets of this many tokens have sketches of 128 and 256 bits, as about all 64 bits of two of them may differ
LONG, LONGER = 80, 160
SKETCH = ("bits", "bits2", "bits3", "bits4")
# tokens meet in this many parts, one after the other, so that disk holds the shuffle of one
PARTS = 3
# lines of one document are below this number
LINES = 1 << 31
# a text has few different words, so their hashes are short numbers in a dictionary of this size
WORD_PAGES = {"parquet.dictionary.page.size": str(8 << 20), "compression": "zstd"}
OTHER_SPACES = "\t\x0b\x0c\r"


def plain(line: Column) -> Column:
    """A-Z lower-cased, for lines of texts that hold capitals beyond ASCII, which lower() would change too."""
    return F.when(line.rlike(OTHER_CAPITALS), ascii_lower(line)).otherwise(F.lower(line))


def tokens_of(line: Column) -> Column:
    """Hashes of the distinct words of a plain line."""
    hashes = F.array_distinct(F.transform(F.split(line, " "), lambda w: F.xxhash64(w)))
    return F.array_remove(hashes, F.xxhash64(F.lit("")))


def text_digest(text: Column) -> Column:
    """Tells texts of rows with equal ids apart."""
    return F.xxhash64(text, F.octet_length(text))


def lines_of(docs: DataFrame) -> DataFrame:
    """(id, digest, line, words, set_id, set_check) of every line with a word: its plain text and two hashes of that.

    Lines of equal plain text are one set from here on. Lines of equal words in another order are different sets that are
    found to be similar like others.
    """
    text = F.coalesce("text", F.lit(""))
    # whatever is made of whole texts comes before the lines: beside a generator it would be made again for every line
    rows = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), text.alias("text"), text_digest(text).alias("digest"))
    # most texts are lowered whole, as that is faster; every space that ends a word, but for line feeds, becomes a blank
    rows = rows.withColumn("odd", (F.octet_length("text") != F.length("text")) & F.col("text").rlike(OTHER_CAPITALS))
    lowered = F.when(F.col("odd"), F.col("text")).otherwise(F.lower("text"))
    spaced = F.when(F.col("text").rlike(f"[{OTHER_SPACES}]"), F.translate(lowered, OTHER_SPACES, " " * len(OTHER_SPACES))).otherwise(lowered)
    rows = rows.select("id", "digest", "odd", spaced.alias("text"))
    rows = rows.select("id", "digest", "odd", F.posexplode(F.split("text", "\n", -1)).alias("line", "raw"))
    words = F.when(F.col("odd"), plain(F.col("raw"))).otherwise(F.col("raw"))
    rows = rows.where(F.trim("raw") != "").select("id", "digest", "line", words.alias("words"))
    return rows.withColumns({"set_id": F.xxhash64("words"), "set_check": F.xxhash64(F.lit(1), "words")})


def rarity_bin(token: Column) -> Column:
    # tokens are hashes, so their low bits are spread evenly
    return token.bitwiseAND(RARITY_BINS - 1).cast("int")


def rarities(lines: DataFrame) -> DataFrame:
    """(levels): one row with the level of the token count of every bin, on a scale of logarithms, of the same size for any table."""
    words = lines.select(F.explode(F.split("words", " ")).alias("w")).where("w != ''")
    counted = words.select(F.xxhash64("w").alias("t")).groupBy(rarity_bin(F.col("t")).alias("bin")).agg(F.count("*").alias("n"))
    level = F.least(F.floor(F.log2(F.col("n")) * LEVELS) + 1, F.lit(127)).cast("tinyint")
    bins = lines.sparkSession.range(RARITY_BINS).select(F.col("id").cast("int").alias("bin"))
    every = bins.join(counted.select("bin", level.alias("level")), "bin", "left")
    levels = F.sort_array(F.collect_list(F.struct("bin", F.coalesce("level", F.lit(0).cast("tinyint")).alias("level"))))
    return every.agg(F.transform(levels, lambda x: x["level"]).alias("levels"))


def overlap_needed(a: Column, b: Column, percent: int) -> Column:
    """Tokens that sets of these sizes share at least: percent / (100 + percent) of both sizes."""
    return F.ceil(percent * (a + b) / F.lit(100 + percent))


def bit(token: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), token.bitwiseAND(63).cast("int"))


def sketch(tokens: Column) -> Column:
    """64 bits, each the parity of the tokens that fall on it. A token that only one of two sets has changes one bit, so the
    sketches differ in no more bits than the sets in tokens; unlike bits that are only set, they do not fill up."""
    return F.aggregate(tokens, F.lit(0).cast("long"), lambda acc, t: acc.bitwiseXOR(bit(t)))


def sketches(tokens: Column) -> list[Column]:
    """The columns of SKETCH: the sketch of a set, and for long sets those of its tokens with other next bits of the hash.

    The sketch of 256 bits has w0 to w3 by two more bits of the hash, that of 128 bits w0 ^ w2 and w1 ^ w3, that of 64 bits
    all four in one, so that sets of any two sizes can be compared. What a short set lacks is 0, which takes no room.
    """
    some = lambda bits, value: sketch(F.filter(tokens, lambda t: F.shiftright(t, 6).bitwiseAND(bits) == value))
    longer = lambda least, words: F.when(F.size(tokens) >= least, words).otherwise(F.lit(0).cast("long"))
    words = [sketch(tokens), longer(LONG, some(1, 1)), longer(LONGER, some(3, 2)), longer(LONGER, some(3, 3))]
    return [word.alias(name) for word, name in zip(words, SKETCH, strict=True)]


def bits_apart(a_size: Column, b_size: Column, a_words: list[Column], b_words: list[Column]) -> Column:
    """Bits that differ in the widest sketch both sets have: never more than the tokens that only one of them has."""
    w, x, y, z = (a.bitwiseXOR(b) for a, b in zip(a_words, b_words, strict=True))
    count = lambda *words: sum((F.bit_count(word) for word in words[1:]), F.bit_count(words[0]))
    least = F.least(a_size, b_size)
    wide = F.when(least >= LONGER, count(w.bitwiseXOR(x).bitwiseXOR(y), x.bitwiseXOR(z), y, z))
    return wide.when(least >= LONG, count(w.bitwiseXOR(x), x)).otherwise(count(w))


def place_in_corpus(id_: Column, line: Column) -> Column:
    """One number that orders lines by document and line; unlike a pair of columns its least value is a hash aggregate."""
    return (id_.cast("decimal(38,0)") * F.lit(LINES).cast("decimal(38,0)") + line.cast("decimal(38,0)")).cast("decimal(38,0)")


def corpus_place(place: Column) -> dict[str, Column]:
    """The document and line of a place, two short numbers that are compared faster than one of 38 digits.

    Of negative documents they are the quotient and rest towards zero, which are in the same order.
    """
    lines = F.lit(LINES).cast("decimal(38,0)")
    return {"id": F.call_function("div", place, lines), "line": (place % lines).cast("int")}


def distinct_sets(lines: DataFrame, levels: DataFrame, percent: int) -> DataFrame:
    """(set_id, set_check, size, sketch columns, prefix, first, n) of every set: its first line, its lines and its rarest tokens.

    A set of n tokens has at least ceil(percent * n / 100) in common with a similar one, so one of its first
    n - that + 1 in any common order.
    """
    # level and part of the token's hash in one number: sorts by rarity, equal for equal tokens
    # every bin has a level; said so, the numbers are known not to be null, and arrays of them are sorted without boxes
    level = lambda t: F.coalesce(F.get("levels", rarity_bin(t)), F.lit(0).cast("tinyint"))
    rank = lambda t: F.shiftleft(level(t).cast("long"), 32).bitwiseOR(t.bitwiseAND(0xFFFFFFFF))
    # as the one row of a generator the tokens are made once, not again in every expression that uses them
    place = place_in_corpus(F.col("id"), F.col("line")).alias("place")
    lines = lines.select("set_id", "set_check", place, F.explode(F.array(tokens_of(F.col("words")))).alias("tokens"))
    # a scalar subquery that the optimiser puts where it is used once: neither rows nor texts of plans carry the levels
    lines = lines.select("*", levels.scalar().alias("levels"))
    n = F.size("tokens")
    least = F.ceil(percent * n / F.lit(100)).cast("int")
    prefix = F.slice(F.sort_array(F.transform("tokens", rank)), F.lit(1), n - least + 1)
    chosen = lines.select("set_id", "set_check", n.alias("size"), *sketches(F.col("tokens")), prefix.alias("prefix"), "place")
    # repeated lines are one row from here on, put together before the shuffle and before their tokens are rows
    return chosen.groupBy("set_id", "set_check", "size", *SKETCH, "prefix").agg(F.min("place").alias("first"), F.count("*").alias("n"))


def listed(sets: DataFrame, prefix: Column, *columns: str) -> DataFrame:
    """``columns`` with the place and token of every prefix token; a token that is alone in its bin has nothing to meet."""
    return sets.select(*columns, F.posexplode(prefix).alias("place", "token")).where(F.shiftright("token", 32) > 1)


def parts_of(rows: DataFrame) -> list[DataFrame]:
    """The written rows in PARTS parts by their token, whose low bits are those of a hash."""
    return [rows.where(F.pmod("token", F.lit(PARTS)) == k) for k in range(PARTS)]


def close_enough(a: Column, b: Column, apart: Column, percent: int) -> Column:
    """Sizes are near enough, and no more bits differ than tokens may."""
    return (100 * F.least(a, b) >= percent * F.greatest(a, b)) & (apart <= a + b - 2 * overlap_needed(a, b, percent))


def heads_of(prefix: Column) -> Column:
    """The tokens of a prefix by which a set meets its likely partner."""
    step = lambda token: F.shiftright(token, 32 + STEP_BITS)
    return F.filter(prefix, lambda t, i: (i < HEADS) | (step(t) != step(F.element_at(prefix, F.greatest(i, F.lit(1))))))


def likely_pairs(sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): for every set at most one other set, an earlier one of its class of sizes (or the one below) that has a rare
    token in common with it.

    Of a token's sets of one class only the earliest is met, so a group of copies makes as many pairs as it has members.
    """
    placed = sets.withColumns(corpus_place(F.col("first")))
    heads = listed(placed, heads_of(F.col("prefix")), "set_id", "id", "line", "size", "bits").drop("place")
    heads = heads.withColumn("class", F.floor(F.log(F.col("size")) / F.log(F.lit(SIZE_CLASS))).cast("int"))
    heads = saved(heads, "line-heads", compression="zstd")
    parts = []
    for some in parts_of(heads):
        met = some.groupBy("token", "class").agg(F.min(F.struct("id", "line", "set_id", "size", "bits")).alias("met"))
        met = saved(met, "line-met", compression="zstd")
        # what is met goes to the class of those that ask, not they to two classes: it is fewer rows
        wanted = met.select("token", F.explode(F.array(F.col("class"), F.col("class") + 1)).alias("class"), "met")
        later = (F.col("id") > F.col("met.id")) | (F.col("id") == F.col("met.id")) & (F.col("line") > F.col("met.line"))
        found = some.join(wanted, ["token", "class"]).where(later)
        found = found.withColumn("apart", F.bit_count(F.col("bits").bitwiseXOR(F.col("met.bits"))))
        found = found.where(close_enough(F.col("size"), F.col("met.size"), F.col("apart"), percent))
        parts.append(saved(found.select("set_id", F.struct("apart", "met.id", "met.line", "met.set_id").alias("met")), "line-found"))
        dropped(met)
    nearest = reduce(DataFrame.union, parts).groupBy("set_id").agg(F.min("met").alias("met"))
    pairs = saved(nearest.select(F.col("met.set_id").alias("a"), F.col("set_id").alias("b")), "line-likely")
    dropped(heads, *parts)
    return pairs


def candidate_pairs(sets: DataFrame, sure: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the sets that pass all filters, a before b, but for pairs whose later set is in ``sure``.

    A pair decides only whether its later set goes, so a settled set asks for no partner; it stays a partner of later ones.
    """
    settled = small_or_not(sure.withColumn("sure", F.lit(True)), 17)
    marked = sets.join(settled, ["set_id", "set_check"], "left").withColumn("sure", F.coalesce("sure", F.lit(False)))
    # a table, since the two sides of a join don't share a shuffle of exploded rows
    marked = marked.withColumns(corpus_place(F.col("first")))
    rows = saved(listed(marked, F.col("prefix"), "set_id", "size", *SKETCH, "id", "line", "sure"), "line-prefixes", compression="zstd")
    parts = [saved(meeting(some, percent), "line-pairs") for some in parts_of(rows)]
    pairs = saved(reduce(DataFrame.union, parts).distinct(), "line-pairs")
    dropped(rows, *parts)
    return pairs


def meeting(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the sets in ``rows`` that have a token in common and pass all filters, a before b."""
    one, other = (rows.select("token", *[F.col(c).alias(x + c) for c in ("set_id", "size", "place", *SKETCH, "id", "line", "sure")]) for x in ("a_", "b_"))
    a_words, b_words = ([F.col(x + w) for w in SKETCH] for x in ("a_", "b_"))
    a, b = F.col("a_size"), F.col("b_size")
    rest = F.least(a - F.col("a_place"), b - F.col("b_place"))
    pairs = one.join(
        other,
        (one["token"] == other["token"])
        # both sides in each condition, so that none is pushed below the shuffle that the sides share
        & ((F.col("a_id") < F.col("b_id")) | (F.col("a_id") == F.col("b_id")) & (F.col("a_line") < F.col("b_line")))
        & (~F.col("b_sure") | F.col("a_sure").isNull())
        & close_enough(a, b, bits_apart(a, b, a_words, b_words), percent)
        & (rest >= overlap_needed(a, b, percent)),
    )
    return pairs.select(F.col("a_set_id").alias("a"), F.col("b_set_id").alias("b")).distinct()


def verified(lines: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """(set_id, set_check) of the later sets of the written ``pairs`` (a, b) that are similar, by their whole sets."""
    wanted = saved(pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct(), "line-candidates")
    sets = lines.join(small_or_not(wanted, 8), "set_id", "left_semi")
    place = place_in_corpus(F.col("id"), F.col("line"))
    sets = sets.groupBy("set_id", "set_check", "words").agg(F.min(place).alias("first"))
    sets = sets.select("set_id", "set_check", "first", F.explode(F.array(tokens_of(F.col("words")))).alias("tokens"))
    # as many bits as four numbers have: what these let through is nearly always similar
    part = lambda k: F.filter("tokens", lambda t: F.shiftright(t, 6).bitwiseAND(WIDE - 1) == k)
    wide = [sketch(part(k)).alias(f"w{k}") for k in range(WIDE)]
    sets = saved(sets.select("set_id", "set_check", "first", F.size("tokens").alias("size"), *wide, "tokens"), "line-sets", **WORD_PAGES)
    side = lambda x, *names: sets.select(F.col("set_id").alias(x), *[F.col(c).alias(f"{x}_{c}") for c in names])
    light = ("set_check", "first", "size", *[f"w{k}" for k in range(WIDE)])
    near = pairs.join(side("a", *light), "a").join(side("b", *light), "b")
    apart = sum(F.bit_count(F.col(f"a_w{k}").bitwiseXOR(F.col(f"b_w{k}"))) for k in range(WIDE))
    sizes = F.col("a_size") + F.col("b_size")
    near = near.where(apart <= sizes - 2 * overlap_needed(F.col("a_size"), F.col("b_size"), percent)).where("a_first != b_first")
    near = saved(near.select("a", "b", "a_set_check", "b_set_check", (F.col("a_first") > F.col("b_first")).alias("a_late")), "line-near")
    full = near.join(side("a", "set_check", "tokens"), ["a", "a_set_check"]).join(side("b", "set_check", "tokens"), ["b", "b_set_check"])
    both = F.size(F.array_intersect("a_tokens", "b_tokens"))
    alike = full.where(100 * both >= percent * (F.size("a_tokens") + F.size("b_tokens") - both))
    late = lambda x: F.struct(F.col(x).alias("set_id"), F.col(f"{x}_set_check").alias("set_check"))
    found = alike.select(F.when(F.col("a_late"), late("a")).otherwise(late("b")).alias("late")).select("late.*").distinct()
    found = saved(found, "line-similar")
    dropped(wanted, sets, near)
    return found


def similar_sets(lines: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(set_id, set_check) of the sets that an earlier first line of another set is similar to.

    One likely partner of every set is verified before all others: in a group of near copies this settles nearly all
    members, and a settled set asks for no other partner. So a group does not make all its pairs.
    """
    likely = likely_pairs(sets, percent)
    sure = verified(lines, likely, percent)
    others = candidate_pairs(sets, sure, percent)
    late = verified(lines, others, percent)
    found = saved(sure.union(late), "line-late")
    dropped(likely, sure, others, late)
    return found


def removed_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(id, digest, n_lines, removed), written, of every different document with words: ``removed`` numbers its lines from 0."""
    lines = saved(lines_of(docs.select("doc_id", "text")), "lines", compression="zstd")
    levels = saved(rarities(lines), "line-rarities")
    sets = saved(distinct_sets(lines, levels, percent), "line-distinct", **WORD_PAGES)
    found = similar_sets(lines, sets, percent)
    late = small_or_not(found.withColumn("late", F.lit(True)), 17)
    verdicts = sets.select("set_id", "set_check", "first", "n").join(late, ["set_id", "set_check"], "left").where("n > 1 OR late")
    verdicts = verdicts.select("set_id", "set_check", "first", F.coalesce("late", F.lit(False)).alias("late"))
    light = lines.select("id", "digest", "line", "set_id", "set_check")
    judged = light.join(verdicts, ["set_id", "set_check"], "left")
    place = place_in_corpus(F.col("id"), F.col("line"))
    gone = F.coalesce(F.col("late") | (place > F.col("first")), F.lit(False))
    # a repeated row has the same lines again
    numbers = F.array_sort(F.collect_set(F.when(gone, F.col("line"))))
    out = saved(judged.groupBy("id", "digest").agg(F.size(F.collect_set("line")).cast("long").alias("n_lines"), numbers.alias("removed")), "line-removals")
    dropped(lines, levels, sets, found)
    return out


def line_dedup(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_lines, n_removed, removed) of every document; ``removed`` joins the numbers of its removed lines, from 0.

    A line is removed if an earlier line (smaller doc_id, or same doc_id and smaller number) has a set of words, A-Z
    lower-cased, with 100 * intersection >= ``percent`` * union; lines are judged on the input. Lines without a word
    stay and are not counted.

    Null and empty texts have no line. Rows without id come after all others; rows with the same id are side by side, so
    repeated rows keep the same lines. Lines and texts of any length are read whole; an empty table gives none; other
    columns are ignored.
    """
    # null ids and the largest id share a number, so the two are told apart by nothing but the text: equal texts, equal lines
    found = removed_lines(docs, percent)
    rows = docs.select("doc_id", F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), text_digest(F.coalesce("text", F.lit(""))).alias("digest"))
    zero = F.lit(0).cast("long")
    return rows.join(found, ["id", "digest"], "left").select(
        "doc_id",
        F.coalesce("n_lines", zero).alias("n_lines"),
        F.coalesce(F.size("removed").cast("long"), zero).alias("n_removed"),
        F.coalesce(F.array_join(F.transform("removed", lambda i: i.cast("string")), ","), F.lit("")).alias("removed"),
    )


def without_repeated_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """All columns of ``docs`` with the removed lines cut from ``text`` (and ``n_chars``, if there, counted again); documents
    that lose all lines with a word go."""
    found = removed_lines(docs, percent).where(F.size("removed") > 0)
    name = "_line"
    while any(c.startswith(name) for c in docs.columns):
        name = "_" + name
    found = found.select(*[F.col(c).alias(name + c) for c in found.columns])
    same = (F.coalesce("doc_id", F.lit(NO_ID)) == F.col(name + "id")) & (text_digest(F.coalesce("text", F.lit(""))) == F.col(name + "digest"))
    kept = F.filter(F.split("text", "\n", -1), lambda line, i: ~F.array_contains(F.col(name + "removed"), i))
    text = F.when(F.col(name + "removed").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    rows = docs.join(found, same, "left").where(f"{name}removed IS NULL OR size({name}removed) < {name}n_lines").withColumn("text", text)
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(columns_of(docs))
