"""URL filter: host-suffix and path-prefix expressions, short hash prefixes, full digests, rule precedence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pollfold.llm.common import ascii_lower, saved

PREFIX_DIGITS = 8
BROADCAST_RULES = 100_000
MAX_SHAPES = 2_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or end, A-Z lower-cased; path: from there to ``?``, ``#`` or end."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return ascii_lower(host), F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest) + 1), r"^[^?#]*", 0)


def rule_keys(rules: DataFrame) -> DataFrame:
    """Rules (host, path, verdict) with their key: host plus path up to its last slash, in digests."""
    depth = F.length("path") - F.length(F.translate("path", "/", ""))
    folder = F.regexp_extract("path", "(?s)^.*/", 0)
    return (
        rules.select(ascii_lower(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
        .where(F.col("host").isNotNull() & (F.col("host") != "") & F.col("verdict").isNotNull())
        .select(
            F.concat("host", "path").alias("rule"),
            F.col("path").alias("rule_path"),
            F.col("verdict").alias("rule_verdict"),
            F.size(F.split("host", r"\.")).alias("labels"),
            depth.alias("depth"),
            F.sha2(F.concat("host", folder), 256).alias("rule_digest"),
        )
        .withColumn("prefix", F.substring("rule_digest", 1, PREFIX_DIGITS))
    )


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", key: str = "page_id", url: str = "url") -> DataFrame:
    """Host, path, rule and verdict of every row.

    ``rules`` has (host, path, verdict). A rule fits its host and all subdomains where the path starts with the rule's
    path; the longest rule wins, of equally long ones the first by text, of equal ones "block". Without a rule the
    verdict is ``default``. Each url is expanded to the shapes (number of labels, number of slashes) that rules have;
    the expressions meet the rules on a short digest prefix, then the whole digest and the rest of the path are compared.

    Null urls and urls without ``://`` have an empty host and path and no rule; repeated rows stay repeated; null keys
    stay; an empty table gives none; other columns of ``pages`` are ignored, whatever their names.
    """
    keyed = saved(rule_keys(rules), "url-rules")
    shapes = keyed.select("labels", "depth").distinct().limit(MAX_SHAPES + 1).collect()
    if len(shapes) > MAX_SHAPES:
        raise ValueError(f"the rules have more than {MAX_SHAPES} combinations of host depth and path depth")
    few = keyed.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url")).select("page_id", "url", host.alias("host"), path.alias("path"))
    places = rows.select("host", "path").where("host != ''").distinct()
    labels, slashes = F.split("host", r"\."), F.length("path") - F.length(F.translate("path", "/", ""))
    expressions = [
        F.when(
            (F.size(labels) >= s.labels) & (slashes >= s.depth),
            F.concat(
                F.substring_index("host", ".", -s.labels),
                F.concat(F.substring_index("path", "/", s.depth), F.lit("/")) if s.depth else F.lit(""),
            ),
        )
        for s in shapes
    ]
    if not expressions:
        return rows.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    expanded = (
        places.select("host", "path", F.explode(F.array_compact(F.array(*expressions))).alias("expression"))
        .select("host", "path", F.sha2("expression", 256).alias("digest"))
        .withColumn("prefix", F.substring("digest", 1, PREFIX_DIGITS))
    )
    found = (
        expanded.join(F.broadcast(keyed) if few else keyed, "prefix")
        .where((F.col("digest") == F.col("rule_digest")) & F.startswith("path", F.col("rule_path")))
        .groupBy("host", "path")
        .agg(
            F.min(
                F.struct((-F.length("rule")).alias("longest"), F.col("rule"), (F.col("rule_verdict") != "block").alias("open"), "rule_verdict")
            ).alias("best")
        )
    )
    found = saved(found.select("host", "path", "best.rule", "best.rule_verdict"), "url-matches")
    verdict = F.coalesce("rule_verdict", F.lit(default))
    with_host = rows.where("host != ''").join(found, ["host", "path"], "left")
    without = rows.where("host = ''").withColumns({"rule": F.lit(None).cast("string"), "rule_verdict": F.lit(None).cast("string")})
    columns = ["page_id", "host", "path", "rule", verdict.alias("verdict")]
    return with_host.select(columns).unionByName(without.select(columns))
