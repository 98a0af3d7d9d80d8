"""The jobs a user runs, end to end on the provided tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pollfold.dictionaries import EUCLID
from pollfold.functions.columns import c
from pollfold.operators.joins import attach, one_to_one, remove_people
from pollfold.operators.ranking import by_fraction
from pollfold.operators.sets import stack
from pollfold.plans.derive import derive
from pollfold.plans.export import export_to_responses
from pollfold.plans.flatten import explode_annotations, flatten
from pollfold.plans.predict import predict, votes_to_predictions
from pollfold.plans.publish import attach_catalog, compare_surveys, publish_catalog, with_sky_split
from pollfold.plans.quality import QualityRule, quality_report, unreliable_volunteers, without_early_test_votes, without_unreliable
from pollfold.plans.rare import chosen_features, feature_counts, feature_maps, feature_shares, feature_table, with_feature_fractions
from pollfold.plans.reduce import reduce_responses, reduce_votes
from pollfold.plans.report import activity_report
from pollfold.plans.subjects import current_subjects, subjects_from_export, subjects_from_raw
from pollfold.plans.votes import coded_export_to_votes, coded_releases_to_votes, responses_to_votes
from pollfold.queries.registry import query
from pollfold.queries.scans import written_export
from pollfold.queries.tables import (
    ACTIONS,
    ANNOTATED_SQL,
    CLASSIFICATION_SQL,
    CODED,
    CODED_SQL,
    EVENT_RESPONSES_SQL,
    FLAGS,
    LINE_RESPONSES_SQL,
    START,
    annotated_lines,
    classification,
    coded_lines,
    dealt,
    event_responses,
    line_responses,
    raw_lines,
    rounded,
    sky_positions,
    sky_sql,
    table,
    text_time,
    version_records,
)
from pollfold.sources.readers import workflow_versions

_FLAG_ANSWERS = {"return-flag": ["accepted", "none", "returned", "recalled"], "line-status": ["final", "open"]}


def _reduced_sql(key: str, answers: dict[str, list[str]], source: str = "responses", fractions: bool = True) -> str:
    """Counts, totals and fractions from distinct (classification, question, response) rows."""
    counts, out = [], [key]
    for question, names in answers.items():
        for name in names:
            counts.append(
                f"""count(*) FILTER (question = '{question}' AND response = '{name}') AS "{question}_{name}" """
            )
            out.append(f'"{question}_{name}"')
        total = " + ".join(f'"{question}_{name}"' for name in names)
        out.append(f'{total} AS "{question}_total-votes"')
        if fractions:
            for name in names:
                out.append(
                    f'round(coalesce("{question}_{name}" / nullif({total}, 0), 0), 6) AS "{question}_{name}_fraction"'
                )
    return (
        f"SELECT {', '.join(out)} FROM (SELECT {key}, {', '.join(counts)} FROM (SELECT DISTINCT {key}, "
        f"classification_id, question, response FROM {source}) GROUP BY {key})"
    )


@query("reduce_responses", f"WITH {LINE_RESPONSES_SQL} {_reduced_sql('subject_id', _FLAG_ANSWERS)}")
def reduce_responses_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reduce_responses(line_responses(spark, sf_dir), FLAGS))


@query(
    "reduce_responses_events",
    f"WITH {EVENT_RESPONSES_SQL} {_reduced_sql('subject_id', {'action': ['viewed', 'clicked', 'bought', 'joined', 'failed']})}",
)
def reduce_responses_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reduce_responses(event_responses(spark, sf_dir), ACTIONS))


@query(
    "reduce_responses_without_people",
    f"""WITH {LINE_RESPONSES_SQL}, kept AS (SELECT * FROM responses WHERE person_id NOT IN
      (SELECT 'p' || l_suppkey FROM lineitem GROUP BY l_suppkey HAVING avg(l_quantity) > 25.5))
    {_reduced_sql('subject_id', _FLAG_ANSWERS, 'kept', fractions=False)}""",
)
def reduce_responses_without_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.avg("l_quantity").alias("mean"))
    people = people.filter("mean > 25.5").select(F.concat(F.lit("p"), F.col("l_suppkey").cast("string")).alias("person_id"))
    reduced = reduce_responses(line_responses(spark, sf_dir), FLAGS, drop_people=people)
    return reduced.drop(*FLAGS.fraction_columns)


@query(
    "complete_answer_columns",
    f"""WITH {LINE_RESPONSES_SQL} SELECT subject_id, count(DISTINCT classification_id) FILTER (response = 'open')
    AS "line-status_open", 0 AS "return-flag_recalled" FROM responses GROUP BY subject_id""",
)
def complete_answer_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    # answers outside the dictionary are ignored, subjects that only have such answers stay
    odd = line_responses(spark, sf_dir).filter("response = 'final'").withColumn("response", F.lit("unlisted"))
    reduced = reduce_responses(stack([line_responses(spark, sf_dir), odd]), FLAGS)
    return reduced.select("subject_id", c("line-status_open"), c("return-flag_recalled"))


_FLAT_SQL = f"""WITH {ANNOTATED_SQL} SELECT classification_id, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at,
workflow_version, user_id, person_id, subject_id, iauname, question, response FROM answers
WHERE created_at > TIMESTAMP '{START} 00:00:00'
AND (question <> 'line-status' OR CAST(workflow_version AS DOUBLE) >= 66.425)"""


@query("flatten_classifications", _FLAT_SQL)
def flatten_classifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flatten(annotated_lines(spark, sf_dir), FLAGS, start=START, since_version={"line-status": 66.425})
    return flat.drop("workflow_id", "response_id").withColumn("created_at", text_time(F.col("created_at")))


@query(
    "flatten_response_ids",
    f"""WITH {ANNOTATED_SQL}, t AS (SELECT classification_id, question, response,
      list_transform(string_split(classification_id || question || response, ''), lambda x: ord(x)) AS b FROM answers)
    SELECT classification_id, question, response, CAST((len(b) + list_sum(list_transform(range(1, len(b) + 1),
      lambda i: (len(b) - i + 1) * b[i])))::BIGINT % 65521 * 65536 + (1 + list_sum(b))::BIGINT % 65521 AS VARCHAR) AS response_id
    FROM t""",
)
def flatten_response_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of published tables, as flatten makes them."""
    flat = flatten(annotated_lines(spark, sf_dir), FLAGS, start=None, since_version=None, id_kind="adler32")
    return flat.select("classification_id", "question", "response", "response_id")


@query(
    "flatten_unique_responses",
    f"""WITH {ANNOTATED_SQL} SELECT DISTINCT classification_id, subject_id, question, response FROM answers""",
)
def flatten_unique_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flatten(annotated_lines(spark, sf_dir), FLAGS, start=None, deduplicate=True, id_kind=None)
    return flat.select("classification_id", "subject_id", "question", "response")


@query(
    "flatten_and_reduce",
    f"""WITH {ANNOTATED_SQL} {_reduced_sql('iauname', _FLAG_ANSWERS, 'answers')}""",
)
def flatten_and_reduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flatten(annotated_lines(spark, sf_dir), FLAGS, start=None)
    return rounded(reduce_responses(flat, FLAGS, key="iauname"))


def _tie_sql(names: list[str], question: str) -> str:
    best = ", ".join(f'"{question}_{n}"' for n in names)
    whens = " ".join(f"""WHEN "{question}_{n}" = greatest({best}) THEN '{n}'""" for n in names)
    total = " + ".join(f'"{question}_{n}"' for n in names)
    codes = " ".join(f"WHEN '{n}' THEN {i}" for i, n in enumerate(sorted(names)))
    pick = f"CASE {whens} END"
    return f"""{pick} AS "{question}_prediction",
    round(coalesce(greatest({best}) / nullif({total}, 0), 1 / {len(names)}), 6) AS "{question}_prediction-conf",
    CASE {pick} {codes} END AS "{question}_prediction-encoded" """


@query(
    "predict_answers",
    f"""WITH {LINE_RESPONSES_SQL}, r AS ({_reduced_sql('subject_id', _FLAG_ANSWERS)})
    SELECT subject_id, {_tie_sql(_FLAG_ANSWERS['return-flag'], 'return-flag')},
    {_tie_sql(_FLAG_ANSWERS['line-status'], 'line-status')} FROM r""",
)
def predict_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    predicted = predict(reduce_responses(line_responses(spark, sf_dir), FLAGS), FLAGS)
    names = [n for q in FLAGS.questions for n in (q.prediction, q.prediction_conf, q.prediction_encoded)]
    return rounded(predicted.select("subject_id", *[c(n) for n in names]))


# every line answers one of the 47 options of the largest dictionary
_OPTIONS = [(q.name, a.name) for q in EUCLID.questions for a in q.answers]
_OPTION_ROWS = ", ".join(f"({i}, '{q}', '{a}')" for i, (q, a) in enumerate(_OPTIONS))
_WIDE_SQL = f"""WITH options(o, question, response) AS (VALUES {_OPTION_ROWS}), responses AS (
  SELECT {CLASSIFICATION_SQL} AS classification_id, l_partkey AS subject_id, question, response
  FROM lineitem JOIN options ON o = (l_orderkey + l_linenumber) % {len(_OPTIONS)})"""
_EUCLID_ANSWERS = {q.name: q.answer_names for q in EUCLID.questions}


def _wide_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = F.array(*[F.struct(F.lit(q).alias("question"), F.lit(a).alias("response")) for q, a in _OPTIONS])
    chosen = F.get(options, ((F.col("l_orderkey") + F.col("l_linenumber")) % len(_OPTIONS)).cast("int"))
    rows = dealt(table(spark, sf_dir, "lineitem")).select(
        classification().alias("classification_id"), F.col("l_partkey").alias("subject_id"), chosen.alias("answer")
    )
    return rows.select("classification_id", "subject_id", "answer.*")


@query("reduce_survey_dictionary", f"{_WIDE_SQL} {_reduced_sql('subject_id', _EUCLID_ANSWERS)}")
def reduce_survey_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reduce_responses(_wide_responses(spark, sf_dir), EUCLID))


@query(
    "predict_survey_dictionary",
    f"""{_WIDE_SQL}, r AS ({_reduced_sql('subject_id', _EUCLID_ANSWERS)})
    SELECT subject_id, {", ".join(_tie_sql(a, q) for q, a in _EUCLID_ANSWERS.items())} FROM r""",
)
def predict_survey_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    predicted = predict(reduce_responses(_wide_responses(spark, sf_dir), EUCLID), EUCLID, interval=0.8)
    names = [n for q in EUCLID.questions for n in (q.prediction, q.prediction_conf, q.prediction_encoded)]
    return rounded(predicted.select("subject_id", *[c(n) for n in names]))


def _wilson_sql(question: str, answer: str, answers: list[str]) -> str:
    n = "(" + " + ".join(f'"{question}_{a}"' for a in answers) + ")::DOUBLE"
    p, z = f'"{question}_{answer}" / nullif({n}, 0)', "1.2815515655446004e0"
    centre, spread = f"{p} + {z}*{z}/(2*{n})", f"{z}*sqrt({p}*(1 - {p})/{n} + {z}*{z}/(4*{n}*{n}))"
    return ", ".join(
        f'CASE WHEN {n} > 0 THEN round(({centre} {sign} {spread}) / (1 + {z}*{z}/{n}), 6) END AS "{question}_{answer}_{end}"'
        for sign, end in (("-", "min"), ("+", "max"))
    )


@query(
    "predict_survey_intervals",
    f"""{_WIDE_SQL}, r AS ({_reduced_sql('subject_id', _EUCLID_ANSWERS)})
    SELECT subject_id, {", ".join(_wilson_sql(q, a, names) for q, names in _EUCLID_ANSWERS.items() for a in names)} FROM r""",
)
def predict_survey_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The interval columns of every answer of the largest dictionary."""
    predicted = predict(reduce_responses(_wide_responses(spark, sf_dir), EUCLID), EUCLID, interval=0.8)
    names = [n for q in EUCLID.questions for a in q.answers for n in (q.min_column(a), q.max_column(a))]
    return rounded(predicted.select("subject_id", *[c(n) for n in names]))


@query(
    "predict_intervals",
    f"""WITH {LINE_RESPONSES_SQL}, r AS ({_reduced_sql('subject_id', {'line-status': ['final', 'open']})}),
    w AS (SELECT subject_id, "line-status_final" AS k, "line-status_total-votes" AS n, 1.2815515655446004e0 AS z FROM r)
    SELECT subject_id, round((k/n + z*z/(2*n) - z*sqrt(k/n*(1-k/n)/n + z*z/(4*n*n))) / (1 + z*z/n), 6) AS "line-status_final_min",
    round((k/n + z*z/(2*n) + z*sqrt(k/n*(1-k/n)/n + z*z/(4*n*n))) / (1 + z*z/n), 6) AS "line-status_final_max" FROM w""",
)
def predict_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    predicted = predict(reduce_responses(line_responses(spark, sf_dir), FLAGS), FLAGS, interval=0.8)
    return rounded(predicted.select("subject_id", c("line-status_final_min"), c("line-status_final_max")))


_VOTE_COLUMNS = [("return-flag", n) for n in _FLAG_ANSWERS["return-flag"]] + [("line-status", n) for n in _FLAG_ANSWERS["line-status"]]
_VOTES_SQL = f"""SELECT classification_id, strftime(created_at, '%Y-%m-%d') AS created_at, user_id, subject_id,
{", ".join(f'''CAST(bool_or(question = '{q}' AND response = '{a}') AS INT) AS "{q}_{a}"''' for q, a in _VOTE_COLUMNS)}
FROM responses GROUP BY ALL"""


@query("responses_to_votes", f"WITH {LINE_RESPONSES_SQL} {_VOTES_SQL}")
def responses_to_votes_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    votes = responses_to_votes(line_responses(spark, sf_dir), FLAGS)
    return votes.withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd"))


@query(
    "sum_reduce_votes",
    f"""WITH {CODED_SQL} SELECT subject_id, count(*) FILTER (T0 = 'a-0') AS "return-flag_accepted",
    count(*) FILTER (T0 = 'a-1') AS "return-flag_none", count(*) FILTER (T0 = 'a-2') AS "return-flag_returned",
    count(*) FILTER (T0 IN ('a-0', 'a-1', 'a-2')) AS "return-flag_total-votes",
    round(coalesce(count(*) FILTER (T1 = 'a-1') / nullif(count(T1), 0), 0), 6) AS "line-status_open_fraction"
    FROM coded WHERE coalesce(T0, '') <> 'a-9' GROUP BY subject_id""",
)
def sum_reduce_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    reduced = reduce_votes(coded_export_to_votes(coded_lines(spark, sf_dir), CODED, min_share=0.05), CODED)
    names = [*CODED.question("return-flag").count_columns, "return-flag_total-votes", "line-status_open_fraction"]
    return rounded(reduced.select("subject_id", *[c(n) for n in names]))


@query(
    "votes_to_predictions",
    f"""WITH {CODED_SQL}, r AS (SELECT subject_id, count(*) FILTER (T0 = 'a-0') AS "return-flag_accepted",
    count(*) FILTER (T0 = 'a-1') AS "return-flag_none", count(*) FILTER (T0 = 'a-2') AS "return-flag_returned"
    FROM coded WHERE coalesce(T0, '') <> 'a-9' GROUP BY subject_id)
    SELECT subject_id, {_tie_sql(['accepted', 'none', 'returned'], 'return-flag')} FROM r""",
)
def votes_to_predictions_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    votes = coded_export_to_votes(coded_lines(spark, sf_dir), CODED, min_share=0.05)
    q = CODED.question("return-flag")
    predicted = votes_to_predictions(votes, CODED)
    return rounded(predicted.select("subject_id", c(q.prediction), c(q.prediction_conf), c(q.prediction_encoded)))


@query(
    "coded_releases_to_votes",
    f"""WITH {CODED_SQL} SELECT classification_id, CAST(T0 IS NOT DISTINCT FROM 'a-0' AS INT) AS "return-flag_accepted",
    CAST(T1 IS NOT DISTINCT FROM 'a-1' AS INT) AS "line-status_open" FROM coded WHERE coalesce(T0, '') <> 'a-9'""",
)
def coded_releases_to_votes_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = coded_lines(spark, sf_dir)
    first = F.col("subject_id") % 2 == 0
    votes = coded_releases_to_votes(coded.filter(first), coded.filter(~first), CODED, min_share=0.05)
    return votes.select("classification_id", c("return-flag_accepted"), c("line-status_open"))


_RULE = QualityRule("action", "failed", min_answers=60, max_unwanted_share=0.22, earliest_last_active="2024-01-30T12:00:00")
_RULE_COLUMNS = {"task_col": "question", "value_col": "response"}
_JUDGED_SQL = f"""WITH {EVENT_RESPONSES_SQL}, judged AS (
  SELECT user_id, max(created_at) < TIMESTAMP '2024-01-30 12:00:00' AS left_early,
  count(*) > 60 AND avg(CAST(response = 'failed' AS INT)) > 0.22 AS answers_unwanted FROM responses GROUP BY user_id)"""


@query(
    "volunteer_quality_report",
    f"""{_JUDGED_SQL} SELECT count(*) AS volunteers, count(*) FILTER (left_early OR answers_unwanted) AS removed,
    count(*) FILTER (left_early) AS left_early, count(*) FILTER (answers_unwanted) AS answers_unwanted,
    round(avg(CAST(answers_unwanted AS INT)), 6) AS unwanted_volunteer_share FROM judged""",
)
def volunteer_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(quality_report(event_responses(spark, sf_dir), _RULE, **_RULE_COLUMNS))


@query(
    "volunteer_quality_filter",
    f"""{_JUDGED_SQL} SELECT classification_id, user_id, response FROM responses
    WHERE user_id NOT IN (SELECT user_id FROM judged WHERE left_early OR answers_unwanted)""",
)
def volunteer_quality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = without_unreliable(event_responses(spark, sf_dir), _RULE, **_RULE_COLUMNS)
    return kept.select("classification_id", "user_id", "response")


@query(
    "drop_early_test_votes",
    f"""WITH {EVENT_RESPONSES_SQL} SELECT classification_id, subject_id, response FROM responses WHERE NOT (
    subject_id IN (SELECT subject_id FROM responses GROUP BY subject_id HAVING count(*) >= 100)
    AND created_at < TIMESTAMP '2024-01-15 00:00:00')""",
)
def drop_early_test_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = without_early_test_votes(event_responses(spark, sf_dir), "2024-01-15", "action", 100, task_col="question")
    return kept.select("classification_id", "subject_id", "response")


@query(
    "filter_then_reduce",
    f"""{_JUDGED_SQL}, kept AS (SELECT * FROM responses WHERE NOT (
      subject_id IN (SELECT subject_id FROM responses GROUP BY subject_id HAVING count(*) >= 100)
      AND created_at < TIMESTAMP '2024-01-15 00:00:00')
      AND (user_id IS NULL OR user_id NOT IN (SELECT user_id FROM judged WHERE left_early OR answers_unwanted)))
    {_reduced_sql('subject_id', {'action': ['viewed', 'clicked', 'bought', 'joined', 'failed']}, 'kept')}""",
)
def filter_then_reduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    responses = event_responses(spark, sf_dir)
    late = without_early_test_votes(responses, "2024-01-15", "action", 100, task_col="question")
    bad = unreliable_volunteers(responses, _RULE, **_RULE_COLUMNS)
    return rounded(reduce_responses(remove_people(late, bad, "user_id"), ACTIONS))


@query(
    "rare_feature_table",
    f"""WITH {LINE_RESPONSES_SQL}, reduced AS ({_reduced_sql('subject_id', {'return-flag': _FLAG_ANSWERS['return-flag']})}),
    rare AS (SELECT l_partkey AS subject_id, count(*) AS ring, count(*) FILTER (l_linestatus = 'F') AS lens_or_arc
      FROM lineitem GROUP BY l_partkey)
    SELECT subject_id, "return-flag_total-votes" AS votes, ring, lens_or_arc,
    round(ring / "return-flag_total-votes", 6) AS ring_fraction,
    round(lens_or_arc / "return-flag_total-votes", 6) AS lens_or_arc_fraction
    FROM reduced JOIN rare USING (subject_id) WHERE "return-flag_total-votes" > 4""",
)
def rare_feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = F.when(F.col("l_linestatus") == "F", F.lit('["Ring","![x](y) Lens or Arc"]')).otherwise(F.lit('["Ring"]'))
    rows = dealt(table(spark, sf_dir, "lineitem")).select(F.col("l_partkey").alias("subject_id"), listed.alias("value"))
    counts = feature_counts(chosen_features(rows, "subject_id"), "subject_id", ["ring", "lens_or_arc"])
    reduced = reduce_responses(line_responses(spark, sf_dir), FLAGS)
    merged = with_feature_fractions(reduced, counts, "subject_id", "return-flag_total-votes")
    ranked = by_fraction(merged, "lens_or_arc_fraction", "return-flag_total-votes", 4, ["subject_id"])
    names = ["ring", "lens_or_arc", "ring_fraction", "lens_or_arc_fraction"]
    return rounded(ranked.select("subject_id", c("return-flag_total-votes").alias("votes"), *names))


# as many features as there are suppliers, one of them on every line
_OPEN_SQL = """open AS (
  SELECT l_partkey AS subject_id, 'odd_' || l_suppkey AS feature, count(*) AS n FROM lineitem GROUP BY ALL
  UNION ALL SELECT l_partkey, 'ring', count(*) FROM lineitem GROUP BY ALL)"""


def _open_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = F.concat(F.lit('["Ring","Odd '), F.col("l_suppkey").cast("string"), F.lit('"]'))
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("subject_id"), listed.alias("value"))
    return feature_table(chosen_features(rows, "subject_id"), "subject_id")


@query(
    "rare_feature_maps",
    f"""WITH {_OPEN_SQL} SELECT subject_id, count(*) AS features,
    string_agg(feature || ':' || n, ',' ORDER BY feature) AS listed FROM open GROUP BY subject_id""",
)
def rare_feature_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An open vocabulary, sparse: no column is named by a value."""
    maps = feature_maps(_open_features(spark, sf_dir), "subject_id")
    entries = F.transform(F.sort_array(F.map_entries("features")), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string")))
    return maps.select("subject_id", F.size("features").cast("bigint").alias("features"), F.array_join(entries, ",").alias("listed"))


@query(
    "rare_feature_shares",
    f"""WITH {LINE_RESPONSES_SQL}, reduced AS ({_reduced_sql('subject_id', {'return-flag': _FLAG_ANSWERS['return-flag']})}), {_OPEN_SQL}
    SELECT subject_id, feature, n, round(n / "return-flag_total-votes", 6) AS fraction FROM open JOIN reduced USING (subject_id)""",
)
def rare_feature_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    reduced = reduce_responses(line_responses(spark, sf_dir), FLAGS)
    return rounded(feature_shares(reduced, _open_features(spark, sf_dir), "subject_id", "return-flag_total-votes"))


@query(
    "derive_labels",
    f"""SELECT {CLASSIFICATION_SQL} AS classification_id, CAST(l_suppkey % 25 % 5 AS VARCHAR) AS workflow_id,
    (l_suppkey % 25) || '.0' AS workflow_version, CAST(l_suppkey AS VARCHAR) AS user_id,
    'J' || l_partkey AS iauname, CASE WHEN l_linenumber = 7 THEN 2 ELSE 3 END AS annotations
    FROM lineitem WHERE l_suppkey % 25 % 5 IN (1, 2)""",
)
def derive_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    derived = derive(raw_lines(spark, sf_dir), workflow_versions(version_records(spark, sf_dir)), ["1", "2"])
    return derived.select(
        "classification_id",
        "workflow_id",
        "workflow_version",
        "user_id",
        "iauname",
        F.size("annotations").alias("annotations"),
    )


@query(
    "derive_annotations",
    f"""WITH lines AS (SELECT *, {CLASSIFICATION_SQL} AS classification_id, strpos('ANR', l_returnflag) - 1 AS flag FROM lineitem
      JOIN nation ON n_nationkey = l_suppkey % 25 WHERE n_regionkey IN (1, 2))
    SELECT classification_id, 'T0' AS task, '![flag.png](https://img.example/flag.png =60x) ' || l_returnflag || ' ' AS value,
      'Which flag?' AS task_label, CAST(flag AS VARCHAR) AS value_index, false AS multiple_choice FROM lines WHERE l_linenumber <> 7
    UNION ALL SELECT classification_id, 'T1', l_linestatus, 'Which status?', CAST(strpos('FO', l_linestatus) - 1 AS VARCHAR), false FROM lines
    UNION ALL SELECT classification_id, 'T10', '["' || l_returnflag || ' in ' || n_name || '","Lens or Arc"]',
      'Do you see any of these rare features?', '[' || flag || ',3]', true FROM lines""",
)
def derive_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The members of the derived annotation lists, label by label."""
    derived = derive(raw_lines(spark, sf_dir), workflow_versions(version_records(spark, sf_dir)), ["1", "2"])
    rows = derived.select("classification_id", F.inline("annotations"))
    return rows.select("classification_id", "task", "value", "task_label", "value_index", "multiple_choice")


@query(
    "raw_to_reduced",
    f"""WITH responses AS (SELECT {CLASSIFICATION_SQL} AS classification_id, l_partkey AS subject_id, 'return-flag' AS question,
      CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'N' THEN 'none' WHEN 'R' THEN 'returned' END AS response
      FROM lineitem WHERE l_linenumber <> 7
      UNION ALL SELECT {CLASSIFICATION_SQL}, l_partkey, 'line-status',
      CASE l_linestatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'open' END FROM lineitem)
    SELECT CAST(subject_id AS VARCHAR) AS subject_id, * EXCLUDE (subject_id) FROM ({_reduced_sql('subject_id', _FLAG_ANSWERS)})""",
)
def raw_to_reduced(spark: SparkSession, sf_dir: str) -> DataFrame:
    derived = derive(raw_lines(spark, sf_dir), workflow_versions(version_records(spark, sf_dir)))
    return rounded(reduce_responses(flatten(derived, FLAGS, start=None, id_kind=None), FLAGS))


@query(
    "export_to_responses",
    f"""WITH {ANNOTATED_SQL} SELECT classification_id, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at,
    subject_id, iauname, question, response FROM answers WHERE created_at > TIMESTAMP '{START} 00:00:00'""",
)
def export_to_responses_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = export_to_responses(written_export(spark, sf_dir), FLAGS, ["question of T10"], start=START, since_version=None)
    flat = flat.withColumn("created_at", text_time(F.col("created_at")))
    return flat.select("classification_id", "created_at", "subject_id", "iauname", "question", "response")


@query(
    "subjects_from_raw",
    """SELECT DISTINCT 'J' || l_partkey AS iauname, CAST(l_partkey AS VARCHAR) AS subject_id,
    'https://img.example/' || l_partkey || '.png' AS subject_url, 'team' AS uploader, '2018-01-01' AS upload_date,
    '40' AS retirement_limit FROM lineitem WHERE l_suppkey % 25 % 5 IN (0, 3)""",
)
def subjects_from_raw_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subjects_from_raw(raw_lines(spark, sf_dir), ["0", "3"])


def _subject_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as subject export: one workflow per size, hidden and plain metadata keys."""
    name, key = F.col("p_name"), F.col("p_partkey").cast("string")
    metadata = F.to_json(
        F.struct(name.alias("!iauname"), F.lit("team").alias("#uploader"), F.col("p_brand").alias("brand"), F.lit(None).cast("string").alias("none"))
    )
    url = F.concat(F.lit("https://img.example/"), key, F.lit(".png"))
    return table(spark, sf_dir, "part").select(
        key.alias("subject_id"),
        F.col("p_size").cast("string").alias("workflow_id"),
        F.lit("9").alias("subject_set_id"),
        metadata.alias("metadata"),
        F.to_json(F.create_map(F.lit("0"), url)).alias("locations"),
        F.lit(None).cast("string").alias("retired_at"),
    )


@query(
    "subjects_from_export",
    """SELECT CAST(p_partkey AS VARCHAR) AS subject_id, 'https://img.example/' || p_partkey || '.png' AS subject_url,
    p_name AS iauname, 'team' AS uploader FROM part""",
)
def subjects_from_export_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    export = _subject_export(spark, sf_dir)
    # exact repeats are harmless
    return subjects_from_export(stack([export, export])).select("subject_id", "subject_url", "iauname", "uploader")


@query(
    "current_subjects",
    """SELECT CAST(p_partkey AS VARCHAR) AS subject_id, CAST(p_size AS VARCHAR) AS workflow_id, p_name AS iauname,
    p_brand AS brand, 'https://img.example/' || p_partkey || '.png' AS locations FROM part WHERE p_size = 11""",
)
def current_subjects_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    subjects = current_subjects(_subject_export(spark, sf_dir), workflow="11")
    assert "retired_at" not in subjects.columns
    return subjects.select("subject_id", "workflow_id", "iauname", "brand", "locations")


@query(
    "publish_survey_catalog",
    f"""WITH {LINE_RESPONSES_SQL}, reduced AS (SELECT subject_id AS id_str, count(DISTINCT (classification_id, response)) AS votes
      FROM responses WHERE question = 'return-flag' GROUP BY subject_id), coords AS ({sky_sql("part", "p_partkey")})
    SELECT id_str, votes, 'data/images/' || id_str || '.png' AS file_loc,
    ra >= (SELECT quantile_cont(ra, 0.7) FROM coords) AS in_test, round(ra, 6) AS ra, round(dec, 6) AS dec
    FROM reduced JOIN coords ON id_str = id""",
)
def publish_survey_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    reduced = reduce_responses(line_responses(spark, sf_dir), FLAGS)
    reduced = reduced.select(F.col("subject_id").alias("id_str"), c("return-flag_total-votes").alias("votes"))
    url = F.concat(F.lit("https://img.example/a/"), F.col("p_partkey").cast("string"), F.lit(".png"))
    locations = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id_str"), url.alias("locations"))
    coords = sky_positions(spark, sf_dir, "part", "p_partkey").withColumnRenamed("id", "id_str")
    return rounded(publish_catalog(reduced, locations, coords, "data/images"))


@query(
    "sky_split",
    f"""WITH coords AS ({sky_sql("customer", "c_custkey")}) SELECT id,
    ra >= (SELECT quantile_cont(ra, 0.7) FROM coords) AS in_test FROM coords""",
)
def sky_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_sky_split(sky_positions(spark, sf_dir, "customer", "c_custkey")).select("id", "in_test")


_SEPARATION = """degrees(2 * asin(sqrt(least(1.0, pow(sin(radians(c.dec - g.dec) / 2), 2)
  + cos(radians(g.dec)) * cos(radians(c.dec)) * pow(sin(radians(c.ra - g.ra) / 2), 2)))))"""
_PREDICTED_SQL = f"""WITH {LINE_RESPONSES_SQL}, r AS ({_reduced_sql('subject_id', _FLAG_ANSWERS)}),
predicted AS (SELECT subject_id, "return-flag_total-votes" AS votes, {_tie_sql(_FLAG_ANSWERS['return-flag'], 'return-flag')} FROM r)"""


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict(reduce_responses(line_responses(spark, sf_dir), FLAGS), FLAGS)


@query(
    "attach_sky_catalog",
    f"""{_PREDICTED_SQL}, g AS (SELECT p.subject_id, p.votes, s.ra, s.dec FROM predicted p
      JOIN ({sky_sql("part", "p_partkey", 0.21)}) s ON s.id = p.subject_id
      WHERE votes > 10 AND "return-flag_prediction" <> 'returned'),
    c AS ({sky_sql("supplier", "s_suppkey")}),
    best AS (SELECT subject_id, votes, id, {_SEPARATION} AS sep FROM g, c),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY subject_id ORDER BY sep, id) AS rank FROM best WHERE sep <= 5)
    SELECT subject_id, votes, id, round(sep, 6) AS sky_separation FROM ranked WHERE rank = 1""",
)
def attach_sky_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    subjects = sky_positions(spark, sf_dir, "part", "p_partkey", 0.21).withColumnRenamed("id", "subject_id")
    catalog = sky_positions(spark, sf_dir, "supplier", "s_suppkey")
    matched = attach_catalog(_predictions(spark, sf_dir), subjects, catalog, 5.0, "return-flag", "returned", 10)
    votes = c("return-flag_total-votes").alias("votes")
    return rounded(matched.select("subject_id", votes, "id", "sky_separation"))


@query(
    "compare_two_surveys",
    f"""{_PREDICTED_SQL}, g AS ({sky_sql("part", "p_partkey", 0.21)}), c AS ({sky_sql("supplier", "s_suppkey")}),
    pairs AS (SELECT g.id AS subject_id, c.id AS expert, {_SEPARATION} AS sep FROM g, c),
    best AS (SELECT *, row_number() OVER (PARTITION BY subject_id ORDER BY sep, expert) AS rank FROM pairs WHERE sep <= 5)
    SELECT p.subject_id, p."return-flag_prediction" AS here, p."return-flag_prediction" AS there, expert
    FROM predicted p JOIN best USING (subject_id) WHERE rank = 1""",
)
def compare_two_surveys(spark: SparkSession, sf_dir: str) -> DataFrame:
    subjects = sky_positions(spark, sf_dir, "part", "p_partkey", 0.21).withColumnRenamed("id", "subject_id")
    others = subjects.withColumn("subject_id", -F.col("subject_id") - 1)
    experts = sky_positions(spark, sf_dir, "supplier", "s_suppkey").withColumnRenamed("id", "expert")
    ours = _predictions(spark, sf_dir).select("subject_id", c("return-flag_prediction").alias("prediction"))
    theirs = ours.withColumn("subject_id", -F.col("subject_id") - 1)
    here, there = compare_surveys(subjects, others, experts, ours, theirs, 5.0)
    there = there.select("subject_id", F.col("prediction").alias("there"))
    here = here.select("subject_id", F.col("prediction").alias("here"), "expert")
    return one_to_one(here, there, "subject_id")


def _report_part(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = table(spark, sf_dir, "events").withColumn("user", F.concat(F.lit("User"), F.col("user_id").cast("string")))
        report = activity_report(
            events,
            events,
            {"viewed": "view", "failed": "error"},
            experts=["USER3", "user14", "User15"],
            user="user",
            value_col="event_type",
            time_col="ts",
        )
        part = report[name]
        times = [n for n, t in part.dtypes if t == "timestamp"]
        return rounded(part.withColumns({n: text_time(F.col(n)) for n in times}))

    return run


_USER_SQL = """users AS (SELECT 'User' || user_id AS "user", count(*) AS n FROM events GROUP BY 1)"""
query("report_per_user", f'WITH {_USER_SQL} SELECT "user", n FROM users')(_report_part("per_user"))
query("report_most_active", f'WITH {_USER_SQL} SELECT "user", n FROM users ORDER BY n DESC, "user" LIMIT 40')(
    _report_part("most_active")
)
query(
    "report_per_expert",
    f"""WITH {_USER_SQL} SELECT "user", n FROM users WHERE lower("user") IN ('user3', 'user14', 'user15')""",
)(_report_part("per_expert"))
query(
    "report_expert_concentration",
    f"""WITH {_USER_SQL}, c AS (SELECT row_number() OVER w AS rank, n AS votes, sum(n) OVER w AS cumulative FROM users
      WHERE lower("user") IN ('user3', 'user14', 'user15') WINDOW w AS (ORDER BY n DESC, "user" ROWS UNBOUNDED PRECEDING))
    SELECT rank, votes, CAST(cumulative AS BIGINT) AS cumulative,
    CAST((SELECT max(cumulative) FROM c) - cumulative AS BIGINT) AS remaining,
    round(((SELECT max(cumulative) FROM c) - cumulative) / ((SELECT max(cumulative) FROM c) - (SELECT max(votes) FROM c)), 6)
      AS remaining_share FROM c""",
)(_report_part("expert_concentration"))
_CURVE_SQL = """SELECT rank, votes, CAST(cumulative AS BIGINT) AS cumulative,
    CAST((SELECT max(cumulative) FROM c) - cumulative AS BIGINT) AS remaining,
    round(((SELECT max(cumulative) FROM c) - cumulative) / ((SELECT max(cumulative) FROM c) - (SELECT max(votes) FROM c)), 6)
      AS remaining_share FROM c"""
query(
    "report_concentration",
    f"""WITH {_USER_SQL}, c AS (SELECT row_number() OVER w AS rank, n AS votes, sum(n) OVER w AS cumulative FROM users
      WINDOW w AS (ORDER BY n DESC, "user" ROWS UNBOUNDED PRECEDING)) {_CURVE_SQL}""",
)(_report_part("concentration"))


def _calendar_sql(seconds: int) -> str:
    return f"""WITH b AS (SELECT epoch_us(ts) // 1000000 // {seconds} * {seconds} AS s, count(*) AS n FROM events GROUP BY 1),
    grid AS (SELECT unnest(range((SELECT min(s) FROM b), (SELECT max(s) FROM b) + 1, {seconds})) AS s)
    SELECT strftime(make_timestamp(s * 1000000), '%Y-%m-%d %H:%M:%S') AS bucket, coalesce(n, 0) AS n FROM grid LEFT JOIN b USING (s)"""


query("report_two_hourly", _calendar_sql(7200))(_report_part("two_hourly"))
query("report_daily", _calendar_sql(86400))(_report_part("daily"))
query(
    "report_weekly_shares",
    """SELECT isoyear(ts) || '-' || weekofyear(ts) AS week_year, round(avg(CAST(event_type = 'view' AS INT)), 6) AS viewed,
    round(avg(CAST(event_type = 'error' AS INT)), 6) AS failed, count(*) AS answers FROM events GROUP BY 1""",
)(_report_part("weekly_shares"))


@query(
    "subjects_with_votes",
    f"""WITH {LINE_RESPONSES_SQL}, reduced AS ({_reduced_sql('subject_id', _FLAG_ANSWERS, fractions=False)})
    SELECT reduced.*, p_brand FROM reduced JOIN part ON subject_id = p_partkey""",
)
def subjects_with_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("subject_id"), "p_brand")
    reduced = reduce_responses(line_responses(spark, sf_dir), FLAGS).drop(*FLAGS.fraction_columns)
    return attach(reduced, parts, "subject_id")


@query(
    "multiple_choice_kept_apart",
    f"SELECT {CLASSIFICATION_SQL} AS classification_id, '[\"ring\",\"lens or arc\"]' AS value FROM lineitem",
)
def multiple_choice_kept_apart(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = explode_annotations(annotated_lines(spark, sf_dir), ["classification_id"])
    return rows.filter("multiple_choice").select("classification_id", "value")
