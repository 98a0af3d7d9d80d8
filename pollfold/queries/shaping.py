"""Projections and filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pollfold.operators import shaping as ops
from pollfold.plans.reduce import reduce_responses
from pollfold.plans.subjects import subject_columns
from pollfold.plans.votes import one_hot_votes, remove_rare_answers
from pollfold.queries.registry import query
from pollfold.queries.tables import (
    ANNOTATED_SQL,
    classification,
    CLASSIFICATION_SQL,
    CODED,
    CODED_SQL,
    FLAGS,
    LINE_RESPONSES_SQL,
    annotated_lines,
    coded_lines,
    line_responses,
    raw_lines,
    rounded,
    table,
    text_time,
)


@query(
    "lift_links",
    f"""SELECT {CLASSIFICATION_SQL} AS classification_id, '5733' AS project_id, CAST(l_suppkey AS VARCHAR) AS user_id,
    CAST(l_suppkey % 25 % 5 AS VARCHAR) AS workflow_id, CAST(l_partkey AS VARCHAR) AS subject_id FROM lineitem""",
)
def lift_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.keep(
        ops.lift_links(raw_lines(spark, sf_dir)),
        ["classification_id", "project_id", "user_id", "workflow_id", "subject_id"],
    )


@query(
    "split_workflow_version",
    f"""SELECT {CLASSIFICATION_SQL} AS id, CAST(l_suppkey % 25 AS VARCHAR) AS workflow_major_version,
    '0' AS workflow_minor_version FROM lineitem""",
)
def split_workflow_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = ops.split_workflow_version(raw_lines(spark, sf_dir))
    return split.select("id", "workflow_major_version", "workflow_minor_version")


@query(
    "cast_to_text",
    "SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber FROM lineitem",
)
def cast_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber"]
    return ops.as_text(table(spark, sf_dir, "lineitem").select(*keys), keys)


@query(
    "project_subject_fields",
    """SELECT 'J' || l_partkey AS iauname, CAST(l_partkey AS VARCHAR) AS subject_id,
    'https://img.example/' || l_partkey || '.png' AS subject_url, 'team' AS uploader, '2018-01-01' AS upload_date,
    '40' AS retirement_limit FROM lineitem""",
)
def project_subject_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subject_columns(raw_lines(spark, sf_dir))


@query("drop_columns", "SELECT p_partkey, p_name, p_brand FROM part")
def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.without(table(spark, sf_dir, "part"), ["p_type", "p_size", "p_retailprice", "absent"])


@query(
    "rename_raw_counts",
    f"""WITH {CODED_SQL} SELECT classification_id,
    CAST(T0 IS NOT DISTINCT FROM 'a-0' AS INT) AS "return-flag_accepted",
    CAST(T0 IS NOT DISTINCT FROM 'a-1' AS INT) AS "return-flag_none",
    CAST(T0 IS NOT DISTINCT FROM 'a-2' AS INT) AS "return-flag_returned",
    CAST(T1 IS NOT DISTINCT FROM 'a-0' AS INT) AS "line-status_final",
    CAST(T1 IS NOT DISTINCT FROM 'a-1' AS INT) AS "line-status_open" FROM coded""",
)
def rename_raw_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    renamed = ops.rename_raw_counts(one_hot_votes(coded_lines(spark, sf_dir), CODED), CODED)
    return ops.keep(renamed, ["classification_id", *CODED.count_columns])


@query(
    "survey_suffix_names",
    f"""WITH {LINE_RESPONSES_SQL} SELECT subject_id, sum(CAST(question = 'return-flag' AS INT)) AS "return-flag-tpc_total-votes",
    sum(CAST(response = 'accepted' AS INT)) AS "return-flag-tpc_accepted",
    round(sum(CAST(response = 'accepted' AS INT)) / sum(CAST(question = 'return-flag' AS INT)), 6)
      AS "return-flag-tpc_accepted_fraction",
    sum(CAST(response = 'open' AS INT)) AS "line-status_open"
    FROM (SELECT DISTINCT subject_id, classification_id, question, response FROM responses) GROUP BY subject_id""",
)
def survey_suffix_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["return-flag-tpc_total-votes", "return-flag-tpc_accepted", "return-flag-tpc_accepted_fraction"]
    reduced = reduce_responses(line_responses(spark, sf_dir), FLAGS)
    renamed = ops.with_survey_suffix(reduced, FLAGS, "tpc", required=names)
    plain = ops.without_survey_suffix(ops.keep(renamed, ["subject_id", "line-status-tpc_open"]), "tpc")
    return rounded(ops.keep(renamed, ["subject_id", *names]).join(plain, "subject_id"))


@query("constant_columns", "SELECT c_custkey, '5733' AS project_id FROM customer")
def constant_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    return ops.with_constants(customers, {"project_id": "5733"})


@query("filter_allow_list", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def filter_allow_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return ops.allow(customers, F.col("c_mktsegment"), ["BUILDING", "MACHINERY"])


@query(
    "filter_since",
    "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'",
)
def filter_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = ops.since(table(spark, sf_dir, "events"), "2024-01-15", "ts")
    return late.select("event_id", text_time(F.col("ts")).alias("ts"))


@query(
    "filter_since_inclusive",
    "SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1998-10-03 00:00:00'",
)
def filter_since_inclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.since(table(spark, sf_dir, "orders"), "1998-10-03", "o_orderdate", inclusive=True).select("o_orderkey")


def _exploded(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = annotated_lines(spark, sf_dir).select("classification_id", F.explode("annotations").alias("a"))
    return rows.select("classification_id", "a.*")


@query(
    "filter_answered",
    f"""SELECT {CLASSIFICATION_SQL} AS classification_id, t.task FROM lineitem,
    (VALUES ('T0'), ('T1'), ('T10')) AS t(task) WHERE NOT (t.task = 'T1' AND l_linenumber = 6)""",
)
def filter_answered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.answered(_exploded(spark, sf_dir)).select("classification_id", "task")


@query(
    "filter_single_choice",
    f"SELECT {CLASSIFICATION_SQL} AS classification_id, t.task FROM lineitem, (VALUES ('T0'), ('T1')) AS t(task)",
)
def filter_single_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.single_choice(_exploded(spark, sf_dir)).select("classification_id", "task")


@query(
    "filter_tasks",
    f"SELECT {CLASSIFICATION_SQL} AS classification_id, t.task FROM lineitem, (VALUES ('T0'), ('T10')) AS t(task)",
)
def filter_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _exploded(spark, sf_dir)
    return ops.without_tasks(rows, ["T1", "T10"]).unionByName(ops.only_task(rows, "T10")).select("classification_id", "task")


@query(
    "filter_not_blank",
    f"""SELECT {CLASSIFICATION_SQL} AS classification_id, t.task FROM lineitem, (VALUES ('T0'), ('T1')) AS t(task)
    WHERE NOT (t.task = 'T0' AND l_linenumber = 7) AND NOT (t.task = 'T1' AND l_linenumber = 6)""",
)
def filter_not_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    single = ops.answered(ops.single_choice(_exploded(spark, sf_dir)))
    return ops.not_blank(single).select("classification_id", "task")


@query(
    "filter_current_wording",
    f"""WITH {ANNOTATED_SQL} SELECT classification_id, question, workflow_version FROM answers
    WHERE question <> 'line-status' OR CAST(workflow_version AS DOUBLE) >= 66.425""",
)
def filter_current_wording(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _wordings(spark, sf_dir)
    return ops.current_wording(rows, {"line-status": 66.425})


@query(
    "filter_current_wording_semantic",
    f"""WITH {ANNOTATED_SQL} SELECT classification_id, question, workflow_version FROM answers
    WHERE question <> 'line-status' OR l_linenumber * 100 >= 425""",
)
def filter_current_wording_semantic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.current_wording(_wordings(spark, sf_dir), {"line-status": 66.425}, semantic=True)


def _wordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pollfold.plans.flatten import flatten

    flat = flatten(
        annotated_lines(spark, sf_dir),
        FLAGS,
        keep=["classification_id", "workflow_version", "created_at"],
        start=None,
        since_version=None,
        id_kind=None,
    )
    return flat.select("classification_id", "question", "workflow_version")


_RARE_SQL = f"""WITH {CODED_SQL}, c0 AS (SELECT T0 AS a, count(*) AS n FROM coded WHERE T0 IS NOT NULL GROUP BY T0),
drop0 AS (SELECT a FROM c0 WHERE n < 0.05 * (SELECT count(*) FROM coded) ORDER BY n, a LIMIT 1),
left0 AS (SELECT * FROM coded WHERE T0 IS NULL OR T0 NOT IN (SELECT a FROM drop0)),
c1 AS (SELECT T1 AS a, count(*) AS n FROM left0 WHERE T1 IS NOT NULL GROUP BY T1),
drop1 AS (SELECT a FROM c1 WHERE n < 0.05 * (SELECT count(*) FROM left0) ORDER BY n, a LIMIT 1)
SELECT classification_id, T0, T1 FROM left0 WHERE T1 IS NULL OR T1 NOT IN (SELECT a FROM drop1)"""


@query("filter_rare_answers", _RARE_SQL)
def filter_rare_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_rare_answers(coded_lines(spark, sf_dir), CODED, min_share=0.05)
    return kept.select("classification_id", "T0", "T1")


@query(
    "filter_all_rare_answers",
    f"""WITH {CODED_SQL} SELECT classification_id, T0, T1 FROM coded
    WHERE (T0 IS NULL OR T0 NOT IN (SELECT T0 FROM coded WHERE T0 IS NOT NULL GROUP BY T0
      HAVING count(*) < 0.1 * (SELECT count(*) FROM coded)))
    AND (T1 IS NULL OR T1 NOT IN (SELECT T1 FROM coded WHERE T1 IS NOT NULL GROUP BY T1
      HAVING count(*) < 0.1 * (SELECT count(*) FROM coded)))""",
)
def filter_all_rare_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_rare_answers(coded_lines(spark, sf_dir), CODED, min_share=0.1, all_rare=True)
    return kept.select("classification_id", "T0", "T1")


@query(
    "filter_total_votes",
    f"""WITH {LINE_RESPONSES_SQL} SELECT subject_id, count(DISTINCT (classification_id, response)) AS votes FROM responses
    WHERE question = 'return-flag' GROUP BY subject_id HAVING count(DISTINCT (classification_id, response)) >= 25""",
)
def filter_total_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    reduced = reduce_responses(line_responses(spark, sf_dir), FLAGS)
    return ops.above(reduced, "return-flag_total-votes", 25).select(
        "subject_id", F.col("`return-flag_total-votes`").alias("votes")
    )


@query(
    "filter_negated_compound",
    f"""SELECT {CLASSIFICATION_SQL} AS classification_id FROM lineitem
    WHERE NOT (l_quantity > 25 AND l_shipdate < TIMESTAMP '1998-01-01 00:00:00')""",
)
def filter_negated_compound(spark: SparkSession, sf_dir: str) -> DataFrame:
    early = F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp")
    kept = ops.except_where(table(spark, sf_dir, "lineitem"), F.col("l_quantity") > 25, early)
    return kept.select(classification().alias("classification_id"))


@query("drop_empty_columns", "SELECT s_suppkey, s_name FROM supplier")
def drop_empty_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return ops.without_empty_columns(suppliers.withColumn("never", F.lit(None).cast("string")))


def _lot_sql(key: str, seed: int) -> str:
    return f"CAST('0x' || substr(md5('{seed}:' || {key}), 1, 13) AS BIGINT)"


@query(
    "random_sample",
    f"""WITH lots AS (SELECT event_id, {_lot_sql('event_id', 7)} / CAST({ops.LOTS} AS DOUBLE) AS lot FROM events)
    SELECT event_id FROM (SELECT event_id, unnest(generate_series(1,
      {' + '.join(f"CAST(lot >= CAST('{x!r}' AS DOUBLE) AS INT)" for x in ops.poisson_steps(0.75))})) FROM lots)""",
)
def random_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.random_sample(table(spark, sf_dir, "events"), 0.75, replacement=True, seed=7, keys=["event_id"]).select("event_id")


@query(
    "random_sample_once",
    f"SELECT event_id FROM events WHERE {_lot_sql('event_id', 3)} / CAST({ops.LOTS} AS DOUBLE) < CAST('0.2' AS DOUBLE)",
)
def random_sample_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.random_sample(table(spark, sf_dir, "events"), 0.2, seed=3, keys=["event_id"]).select("event_id")


@query(
    "random_sample_rows",
    f"SELECT event_id, event_type FROM events ORDER BY {_lot_sql('event_id', 5)} LIMIT 700",
)
def random_sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample size is the feature."""
    return ops.sample_rows(table(spark, sf_dir, "events"), 700, seed=5, keys=["event_id"]).select("event_id", "event_type")
