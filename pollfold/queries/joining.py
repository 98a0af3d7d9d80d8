"""Joins and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pollfold.operators import checks, joins, sets
from pollfold.operators.skymatch import sky_match
from pollfold.plans.reduce import reduce_responses
from pollfold.queries.registry import query
from pollfold.queries.tables import (
    CLASSIFICATION_SQL,
    CODED_SQL,
    FLAGS,
    LINE_RESPONSES_SQL,
    annotated_lines,
    coded_lines,
    event_responses,
    line_responses,
    raw_lines,
    rounded,
    sky_positions,
    sky_sql,
    table,
    version_records,
)
from pollfold.operators.shaping import lift_links, split_workflow_version
from pollfold.functions.text import sanitise
from pollfold.sources.readers import workflow_versions

_VOTES_SQL = f"""WITH {LINE_RESPONSES_SQL}, reduced AS (
  SELECT subject_id, count(DISTINCT (classification_id, response)) AS votes FROM responses
  WHERE question = 'return-flag' GROUP BY subject_id)"""


def _votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    reduced = reduce_responses(line_responses(spark, sf_dir), FLAGS)
    return reduced.select("subject_id", F.col("`return-flag_total-votes`").alias("votes"))


@query(
    "join_reduced_with_subjects",
    f"{_VOTES_SQL} SELECT subject_id, votes, p_name FROM reduced JOIN part ON subject_id = p_partkey",
)
def join_reduced_with_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("subject_id"), "p_name")
    return joins.attach(_votes(spark, sf_dir), parts, "subject_id")


@query(
    "join_left_attach",
    "SELECT o_orderkey, c_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_custkey % 2 = 0",
)
def join_left_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = table(spark, sf_dir, "customer").filter(F.col("c_custkey") % 2 == 0)
    names = even.select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return joins.attach(table(spark, sf_dir, "orders"), names, "o_custkey", required=False).select("o_orderkey", "c_name")


@query(
    "join_full_outer_fold",
    """SELECT coalesce(a.k, b.k) AS k, coalesce(suppliers, 0) AS suppliers, coalesce(customers, 0) AS customers
    FROM (SELECT s_nationkey AS k, count(*) AS suppliers FROM supplier WHERE s_nationkey > 5 GROUP BY 1) a
    FULL JOIN (SELECT c_nationkey AS k, count(*) AS customers FROM customer WHERE c_nationkey < 15 GROUP BY 1) b
    ON a.k = b.k""",
)
def join_full_outer_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier").filter("s_nationkey > 5").groupBy(F.col("s_nationkey").alias("k"))
    customers = table(spark, sf_dir, "customer").filter("c_nationkey < 15").groupBy(F.col("c_nationkey").alias("k"))
    counts = [
        suppliers.agg(F.count(F.lit(1)).alias("suppliers")),
        customers.agg(F.count(F.lit(1)).alias("customers")),
    ]
    return joins.fold_outer(counts, ["k"])


@query(
    "join_one_to_one",
    f"{_VOTES_SQL} SELECT subject_id, votes, p_size FROM reduced JOIN part ON subject_id = p_partkey",
)
def join_one_to_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("subject_id"), "p_size")
    return joins.one_to_one(_votes(spark, sf_dir), sizes, "subject_id")


@query(
    "join_natural",
    """SELECT n_nationkey, n_regionkey, n_name, r_name FROM nation
    JOIN (SELECT r_regionkey AS n_regionkey, r_name FROM region) USING (n_regionkey)""",
)
def join_natural(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return joins.natural_join(table(spark, sf_dir, "nation"), regions)


_BIG_SQL = "SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING count(*) > 5"


def _big_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
    return counted.agg(F.count(F.lit(1)).alias("n")).filter("n > 5")


@query("join_keep_ids", f"SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN ({_BIG_SQL})")
def join_keep_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return joins.keep_ids(orders, _big_orders(spark, sf_dir), "o_orderkey")


@query(
    "join_remove_ids",
    f"""SELECT o_orderkey, o_custkey FROM (SELECT CASE WHEN o_orderkey % 10 <> 0 THEN o_orderkey END AS o_orderkey,
    o_custkey FROM orders) WHERE o_orderkey IS NULL OR o_orderkey NOT IN ({_BIG_SQL})""",
)
def join_remove_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderkey")).alias("o_orderkey")
    return joins.remove_ids(table(spark, sf_dir, "orders").select(key, "o_custkey"), _big_orders(spark, sf_dir), "o_orderkey")


@query(
    "join_remove_people",
    f"WITH {LINE_RESPONSES_SQL} SELECT classification_id, question FROM responses WHERE person_id NOT IN ('p3', 'p14')",
)
def join_remove_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = joins.remove_people(line_responses(spark, sf_dir), ["p3", "p14"])
    return kept.select("classification_id", "question")


@query(
    "join_workflow_version",
    f"""SELECT {CLASSIFICATION_SQL} AS classification_id, 'N in NATION_' || (l_suppkey % 25) AS label FROM lineitem""",
)
def join_workflow_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = lift_links(split_workflow_version(raw_lines(spark, sf_dir)))
    joined = joins.with_version(raw, workflow_versions(version_records(spark, sf_dir)))
    return joined.select("classification_id", F.try_element_at("strings", F.lit("T10.answers.1.label")).alias("label"))


@query(
    "join_dictionary",
    f"""SELECT {CLASSIFICATION_SQL} AS classification_id, 'return-flag' AS question,
    CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'N' THEN 'none' WHEN 'R' THEN 'returned' END AS response
    FROM lineitem WHERE l_linenumber <> 7""",
)
def join_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = annotated_lines(spark, sf_dir).select("classification_id", F.col("annotations")[0].alias("a"))
    value = sanitise(F.col("a.value"))
    named = joins.with_names(first, FLAGS, F.col("a.task"), value, on_unknown="drop")
    return named.select("classification_id", "question", "response")


@query(
    "join_subject_record",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS subject_id, p_name FROM events "
    "LEFT JOIN part ON p_partkey = CAST(json_extract_string(props, '$.k') AS BIGINT)",
)
def join_subject_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = event_responses(spark, sf_dir).select(F.col("classification_id").alias("event_id"), "subject_id")
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("subject_id"), "p_name")
    return joins.attach(events, parts, "subject_id", required=False)


_SEPARATION = """degrees(2 * asin(sqrt(least(1.0, pow(sin(radians(c.dec - g.dec) / 2), 2)
  + cos(radians(g.dec)) * cos(radians(c.dec)) * pow(sin(radians(c.ra - g.ra) / 2), 2)))))"""
_SKY_SQL = f"""WITH g AS ({sky_sql("customer", "c_custkey", 0.37)}), c AS ({sky_sql("supplier", "s_suppkey")}),
pairs AS (SELECT g.id, c.id AS id_catalog, {_SEPARATION} AS sep FROM g, c),
best AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY sep, id_catalog) AS rank FROM pairs WHERE sep <= 8)"""


@query(
    "sky_match_nearest",
    f"{_SKY_SQL} SELECT id, id_catalog, round(sep, 6) AS sky_separation FROM best WHERE rank = 1",
)
def sky_match_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    matched, _ = _sky(spark, sf_dir)
    return rounded(matched.select("id", "id_catalog", "sky_separation"))


@query("sky_match_unmatched", f"{_SKY_SQL} SELECT id FROM g WHERE id NOT IN (SELECT id FROM best)")
def sky_match_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sky(spark, sf_dir)[1].select("id")


def _sky(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    galaxies = sky_positions(spark, sf_dir, "customer", "c_custkey", 0.37)
    return sky_match(galaxies, sky_positions(spark, sf_dir, "supplier", "s_suppkey"), 8.0)


@query(
    "union_by_name",
    """SELECT s_name AS name, s_acctbal AS balance, NULL AS segment FROM supplier
    UNION ALL SELECT c_name, c_acctbal, c_mktsegment FROM customer""",
)
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_acctbal").alias("balance"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    return sets.stack([suppliers, customers])


@query(
    "set_difference",
    "SELECT c_nationkey AS k FROM customer WHERE c_nationkey < 20 EXCEPT SELECT s_nationkey FROM supplier WHERE s_nationkey > 3",
)
def set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = table(spark, sf_dir, "customer").filter("c_nationkey < 20").select(F.col("c_nationkey").alias("k"))
    right = table(spark, sf_dir, "supplier").filter("s_nationkey > 3").select(F.col("s_nationkey").alias("k"))
    return sets.difference(left, right)


@query(
    "union_id_sets",
    """SELECT user_id FROM (SELECT user_id FROM events GROUP BY user_id HAVING count(*) > 70
    UNION SELECT user_id FROM events WHERE event_type = 'error' GROUP BY user_id HAVING count(*) > 15)""",
)
def union_id_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    active = events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 70").select("user_id")
    failing = events.filter("event_type = 'error'").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return sets.union_ids(active, failing.filter("n > 15").select("user_id"))


@query(
    "split_cohorts",
    "SELECT event_id, CASE WHEN value > 20 THEN 'high' ELSE 'other' END AS cohort FROM events",
)
def split_cohorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "value")
    high, other = sets.split_cohorts(events, F.col("value") > 20)
    parts = [high.withColumn("cohort", F.lit("high")), other.withColumn("cohort", F.lit("other"))]
    return sets.stack(parts).select("event_id", "cohort")


@query(
    "vocabulary_gap",
    f"""WITH {CODED_SQL}, a AS (SELECT DISTINCT T0 AS value FROM coded WHERE T0 IS NOT NULL),
    b AS (SELECT DISTINCT T0 AS value FROM coded WHERE T0 IS NOT NULL AND T0 <> 'a-9')
    SELECT 'T0' AS "column", value, 'left' AS only_in FROM a WHERE value NOT IN (SELECT value FROM b)""",
)
def vocabulary_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = coded_lines(spark, sf_dir)
    clean = coded.filter(~F.col("T0").eqNullSafe(F.lit("a-9")))
    return checks.vocabulary_gap(coded, clean, ["T0", "T1"])
