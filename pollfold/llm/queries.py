"""Registered queries of the operators, with their production parameters and the SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pollfold.llm import decontamination, language, line_dedup, mixing, near_dedup, quality, secrets, spelling, suffix_array, suffix_trees, toxicity, url_filter, whitening
from pollfold.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


# words in order of their number of lines; similar lines share one of the first
LINE_SQL = r"""
WITH l AS (
  SELECT doc_id, generate_subscripts(ls, 1) - 1 AS line, unnest(ls) AS words FROM (
    SELECT doc_id, string_split(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), chr(10)) AS ls
    FROM documents)),
t AS (SELECT doc_id, line, list_sort(list_distinct(regexp_extract_all(words, '[^\x20\x09-\x0D]+'))) AS ts FROM l),
o AS (SELECT * FROM t WHERE len(ts) > 0),
s AS (SELECT ts, row_number() OVER () AS k, min((doc_id, line)) AS first FROM o GROUP BY ts),
e AS (SELECT k, len(ts) AS n, unnest(ts) AS w FROM s),
f AS (SELECT w, count(*) AS df FROM e GROUP BY w),
r AS (SELECT k, n, w, row_number() OVER (PARTITION BY k ORDER BY df, w) AS place FROM e JOIN f USING (w)),
p AS (SELECT k, w FROM r WHERE place <= n - ceil(0.8 * n) + 1),
c AS (SELECT DISTINCT x.k AS a, y.k AS b FROM p x JOIN p y ON x.w = y.w AND x.k <> y.k),
late AS (
  SELECT DISTINCT b AS k FROM c JOIN s x ON x.k = a JOIN s y ON y.k = b WHERE x.first < y.first
    AND 100 * len(list_intersect(x.ts, y.ts)) >= 80 * (len(x.ts) + len(y.ts) - len(list_intersect(x.ts, y.ts)))),
judged AS (
  SELECT doc_id, line, (doc_id, line) > first OR s.k IN (SELECT k FROM late) AS gone FROM o JOIN s USING (ts)),
per AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed, string_agg(line::VARCHAR, ',' ORDER BY line) FILTER (gone) AS removed
  FROM judged GROUP BY doc_id)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(removed, '') AS removed
FROM documents LEFT JOIN per USING (doc_id)
"""


@query("op1_line_dedup", LINE_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents"))


# sets of five-word runs, links by shared runs, components by reachability
NEAR_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents),
sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS s FROM w),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM sets x JOIN sets y ON x.s = y.s AND x.doc_id <> y.doc_id
  JOIN sizes nx ON nx.doc_id = x.doc_id JOIN sizes ny ON ny.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, nx.n, ny.n HAVING 100 * count(*) >= 85 * (nx.n + ny.n - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""


@query("op2_near_dedup", NEAR_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("op3_suffix_array")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_array.suffix_array_dedup(table(spark, sf_dir, "documents")).withColumnRenamed("n", "n_bytes")


@query("op4_decontamination")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op5_language_id")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs.where(~language.held_out(F.col("doc_id"))))
    found = language.identify(docs, model)
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "bits", "accepted")


@query("op6_quality_rules")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.apply_rules(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


# fixed values: the rules of the URL query
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

URL_SQL = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
places AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM parts),
rules(rhost, rpath, rverdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fits AS (
  SELECT host, path, arg_max(struct_pack(rule := rhost || rpath, verdict := rverdict), length(rhost || rpath)) AS best
  FROM (SELECT DISTINCT host, path FROM places) p
  JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY ALL)
SELECT page_id, places.host, places.path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict
FROM places LEFT JOIN fits ON places.host = fits.host AND places.path = fits.path
"""


@query("op7_url_filter", URL_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), rules)


@query("op8_secret_scan")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    every = F.array_sort(
        F.concat("base", "added"),
        lambda a, b: F.when(a["start"] != b["start"], F.signum(a["start"] - b["start"]).cast("int")).otherwise(a["nth"] - b["nth"]),
    )
    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(secrets.span_text(F.col("base")), 256).alias("base_sha256"),
        secrets.span_text(every).alias("spans"),
    )


WINDOW_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(ws) - 48)) AS i, ws FROM w WHERE len(ws) >= 50),
h AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS d FROM win),
hit AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY d) AS m FROM h) WHERE m < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM hit),
per AS (SELECT doc_id, list(i) AS g FROM gone GROUP BY doc_id),
kept AS (
  SELECT doc_id, len(ws) AS n_words, coalesce(len(g), 0) AS n_removed,
    array_to_string(CASE WHEN g IS NULL THEN ws ELSE ws[:0] || list_transform(
      list_filter(range(1, len(ws) + 1), lambda i: NOT list_contains(g, i)), lambda i: ws[i]) END, ' ') AS rest
  FROM w LEFT JOIN per USING (doc_id))
SELECT doc_id, n_words, n_removed, sha256(coalesce(rest, '')) AS kept_sha256 FROM kept
"""


@query("op9_suffix_trees", WINDOW_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_trees.substring_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("n").alias("n_words"), "n_removed", "kept_sha256")


@query("op10_mixing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op11_toxicity")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learned = docs.where(~toxicity.held_out(F.col("doc_id")))
    field = toxicity.fit_toxicity(learned, table(spark, sf_dir, "labels"))
    found = toxicity.score_toxicity(docs, field)
    return found.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "spans")


@query("op12_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return found.withColumnRenamed("id", "vec_id").withColumn("deviation", F.col("deviation").try_cast("long"))


@query("op13_spelling_variants")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))
