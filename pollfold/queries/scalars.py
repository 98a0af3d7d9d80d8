"""Scalar functions on text, times, JSON, ids and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pollfold.functions import ids, jsons, text, times, votes
from pollfold.functions.columns import question_answer
from pollfold.plans.flatten import explode_annotations
from pollfold.plans.rare import chosen_features
from pollfold.plans.subjects import expand_metadata, metadata_key_rows, unhidden_members
from pollfold.queries.registry import query
from pollfold.queries.scans import written_export
from pollfold.queries.tables import (
    ACTIONS,
    classification,
    CLASSIFICATION_SQL,
    LINE_RESPONSES_SQL,
    annotated_lines,
    line_responses,
    raw_lines,
    rounded,
    table,
    tagged,
    text_time,
    version_records,
)
from pollfold.sources.readers import workflow_versions

_TRIM_SQL = "lower(trim(trim(text, ''''), ' '))"


@query(
    "sanitise_text",
    f"""WITH t AS (SELECT doc_id, {_TRIM_SQL} AS s FROM documents)
    SELECT doc_id, md5(CASE WHEN NOT contains(s, '[') THEN s
      WHEN regexp_matches(s, '^\\s*[^\\s\\[]*\\[') THEN regexp_extract(s, '^[^)]*\\)\\s*((?s:.*))$', 1) END) AS cleaned
    FROM t""",
)
def sanitise_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", F.md5(text.sanitise(F.col("text"))).alias("cleaned"))


@query(
    "strip_image_markdown",
    """SELECT p_partkey, p_name AS tagged, CASE WHEN p_size % 2 = 0 THEN p_name END AS mid, p_name AS plain FROM part""",
)
def strip_image_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("p_name")
    # a bracket after the first word is malformed and gives null
    mid = F.when(F.col("p_size") % 2 == 0, name).otherwise(F.concat(name, F.lit(" [x](y)")))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        text.strip_image_markdown(tagged(name).substr(F.lit(1), F.length(tagged(name)) - 1)).alias("tagged"),
        text.strip_image_markdown(mid).alias("mid"),
        text.strip_image_markdown(name).alias("plain"),
    )


@query(
    "sanitise_answers",
    f"""SELECT {CLASSIFICATION_SQL} AS classification_id,
    CASE WHEN l_linenumber <> 7 THEN lower(l_returnflag) ELSE '' END AS flag,
    CASE WHEN l_linenumber <> 6 THEN lower(l_linestatus) END AS status FROM lineitem""",
)
def sanitise_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("annotations")
    return annotated_lines(spark, sf_dir).select(
        "classification_id",
        text.sanitise(value[0]["value"]).alias("flag"),
        text.sanitise(value[1]["value"]).alias("status"),
    )


@query(
    "export_time_to_api_time",
    "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS created_at FROM events",
)
def export_time_to_api_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = F.concat(text_time(F.col("ts")), F.lit(" UTC"))
    return table(spark, sf_dir, "events").select("event_id", times.api_time(written).alias("created_at"))


@query("parse_times", "SELECT event_id, epoch_us(ts) // 1000 AS millis FROM events")
def parse_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return table(spark, sf_dir, "events").select("event_id", F.unix_millis(times.to_utc(written)).alias("millis"))


@query(
    "iso_week_keys",
    """SELECT o_orderkey, isoyear(o_orderdate) || '-' || weekofyear(o_orderdate) AS week_year,
    strftime(o_orderdate, '%Y-%m') AS month FROM orders""",
)
def iso_week_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", times.week_key(day).alias("week_year"), times.month_key(day).alias("month")
    )


@query(
    "elapsed_days",
    """SELECT event_id, round((epoch_us(ts) - (SELECT min(epoch_us(ts)) FROM events)) / 86400e6, 1) AS days_since_start,
    epoch_us(ts) - (SELECT min(epoch_us(ts)) FROM events) AS micros_since_start FROM events""",
)
def elapsed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    start = events.select(F.min("ts")).scalar()
    since = times.elapsed(F.col("ts"), start)
    micros = F.expr("0").cast("bigint") + (F.unix_micros(F.timestamp_micros(F.lit(0)) + since))
    return events.select(
        "event_id", times.elapsed_days(F.col("ts"), start).alias("days_since_start"), micros.alias("micros_since_start")
    )


@query(
    "question_answer_names",
    f"""WITH {LINE_RESPONSES_SQL} SELECT classification_id, question || '_' || response AS question_response
    FROM responses""",
)
def question_answer_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    responses = line_responses(spark, sf_dir)
    return responses.select("classification_id", question_answer().alias("question_response"))


@query("underscored_labels", "SELECT p_partkey, replace(p_name, ' ', '_') AS label FROM part")
def underscored_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", text.underscored(F.col("p_name")).alias("label"))


@query(
    "expert_flag",
    "SELECT c_custkey, lower(c_name) IN ('customer#000000001', 'customer#000000007') AS expert FROM customer",
)
def expert_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    experts = ["CUSTOMER#000000001", "customer#000000007"]
    return table(spark, sf_dir, "customer").select("c_custkey", text.in_user_list(F.col("c_name"), experts).alias("expert"))


@query(
    "prefix_and_extension",
    """SELECT p_partkey, starts_with(p_name, 'red') AS is_red, 'h2o_' || p_name AS prefixed,
    p_name AS stem FROM part""",
)
def prefix_and_extension(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("p_name")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        text.has_prefix(name, "red").alias("is_red"),
        text.prefixed(name, "h2o_").alias("prefixed"),
        text.without_extension(F.concat(name, F.lit(".jpg"))).alias("stem"),
    )


@query(
    "url_file_names",
    """WITH p AS (SELECT page_id, regexp_replace(regexp_replace(url, '^[a-z]+://[^/?#]*', ''), '[?#].*$', '') AS path FROM pages)
    SELECT page_id, regexp_extract(path, '[^/]*$') AS file_name,
    'data/images/' || regexp_extract(path, '[^/]*$') AS file_loc FROM p""",
)
def url_file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id", text.url_file_name(url).alias("file_name"), text.rerooted(url, "data/images").alias("file_loc")
    )


@query(
    "unhidden_metadata_keys",
    "SELECT s_suppkey, s_name AS iauname, CAST(s_nationkey AS VARCHAR) AS uploader FROM supplier",
)
def unhidden_metadata_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier")
    members = F.create_map(F.lit("!iauname"), F.col("s_name"), F.lit("!uploader!"), F.col("s_nationkey").cast("string"))
    shown = suppliers.select("s_suppkey", unhidden_members(members).alias("m"))
    return shown.select("s_suppkey", F.col("m")["iauname"].alias("iauname"), F.col("m")["uploader"].alias("uploader"))


_COUNTS_SQL = """WITH counts AS (
  SELECT user_id, count(*) AS n, count(*) FILTER (event_type = 'view') AS viewed,
    count(*) FILTER (event_type = 'click') AS clicked, count(*) FILTER (event_type = 'purchase') AS bought
  FROM events GROUP BY user_id)"""


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(kind == "view").alias("viewed"),
        F.count_if(kind == "click").alias("clicked"),
        F.count_if(kind == "purchase").alias("bought"),
    )


@query(
    "prediction_and_confidence",
    f"""{_COUNTS_SQL} SELECT user_id, CASE greatest(viewed, clicked, bought) WHEN viewed THEN 'viewed'
    WHEN clicked THEN 'clicked' ELSE 'bought' END AS prediction,
    round(coalesce(greatest(viewed, clicked, bought) / nullif(viewed + clicked + bought, 0), 1 / 3), 6) AS confidence,
    CASE greatest(viewed, clicked, bought) WHEN viewed THEN 2 WHEN clicked THEN 1 ELSE 0 END AS code FROM counts""",
)
def prediction_and_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["viewed", "clicked", "bought"]
    counts = [F.col(n) for n in names]
    best = votes.arg_max(names, counts)
    return rounded(
        _counts(spark, sf_dir).select(
            "user_id",
            best.alias("prediction"),
            votes.confidence(counts).alias("confidence"),
            votes.label_code(best, names).alias("code"),
        )
    )


@query(
    "wilson_intervals",
    f"""{_COUNTS_SQL}, w AS (SELECT user_id, viewed / n AS p, n, 1.2815515655446004e0 AS z FROM counts)
    SELECT user_id, round((p + z*z/(2*n) - z*sqrt(p*(1-p)/n + z*z/(4*n*n))) / (1 + z*z/n), 6) AS low,
    round((p + z*z/(2*n) + z*sqrt(p*(1-p)/n + z*z/(4*n*n))) / (1 + z*z/n), 6) AS high,
    round(2*z*sqrt(p*(1-p)/n + z*z/(4*n*n)) / (1 + z*z/n), 6) AS width FROM w""",
)
def wilson_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    low, high = votes.wilson_interval(F.col("viewed"), F.col("n"), 0.8)
    width = votes.wilson_width(F.col("viewed"), F.col("n"), 0.8)
    return rounded(
        _counts(spark, sf_dir).select("user_id", low.alias("low"), high.alias("high"), width.alias("width"))
    )


@query(
    "label_wilson_intervals",
    """WITH c AS (SELECT lang, sum(quality) AS k, count(*) AS n, 1.959963984540054e0 AS z
      FROM labels JOIN documents USING (doc_id) GROUP BY lang)
    SELECT lang, k, n, round((k/n + z*z/(2*n) - z*sqrt(k/n*(1-k/n)/n + z*z/(4*n*n))) / (1 + z*z/n), 6) AS low,
    round((k/n + z*z/(2*n) + z*sqrt(k/n*(1-k/n)/n + z*z/(4*n*n))) / (1 + z*z/n), 6) AS high FROM c""",
)
def label_wilson_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang")
    counted = table(spark, sf_dir, "labels").join(documents, "doc_id").groupBy("lang")
    counts = counted.agg(F.sum("quality").alias("k"), F.count(F.lit(1)).alias("n"))
    low, high = votes.wilson_interval(F.col("k"), F.col("n"), 0.95)
    return rounded(counts.select("lang", "k", "n", low.alias("low"), high.alias("high")))


@query(
    "bernoulli_estimates",
    f"{_COUNTS_SQL} SELECT user_id, round(viewed/n, 6) AS mean, round(viewed/n*(1-viewed/n)/n, 9) AS variance FROM counts",
)
def bernoulli_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("viewed"), F.col("n")
    variance = F.round(votes.bernoulli_variance(k, n), 9)
    return _counts(spark, sf_dir).select(
        "user_id", F.round(votes.bernoulli_mean(k, n), 6).alias("mean"), variance.alias("variance")
    )


@query(
    "vote_vectors",
    f"""{_COUNTS_SQL} SELECT user_id, repeat('1', viewed) || repeat('0', n - viewed) AS votes FROM counts""",
)
def vote_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vector = votes.vote_vector(F.col("viewed"), F.col("n")).cast("array<string>")
    return _counts(spark, sf_dir).select("user_id", F.array_join(vector, "").alias("votes"))


@query(
    "one_hot_answers",
    """SELECT event_id, CAST(event_type = 'view' AS INT) AS viewed, CAST(event_type = 'click' AS INT) AS clicked
    FROM events""",
)
def one_hot_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        "event_id", votes.one_hot(kind, "view").alias("viewed"), votes.one_hot(kind, "click").alias("clicked")
    )


@query(
    "label_encoding",
    """SELECT event_id, CASE event_type WHEN 'purchase' THEN 0 WHEN 'click' THEN 1 WHEN 'error' THEN 2
    WHEN 'signup' THEN 3 WHEN 'view' THEN 4 END AS code FROM events""",
)
def label_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    question = ACTIONS.questions[0]
    published = F.create_map(*[F.lit(x) for a in question.answers for x in (a.raw_name, a.name)])
    name = F.try_element_at(published, F.col("event_type"))
    return table(spark, sf_dir, "events").select(
        "event_id", votes.label_code(name, question.answer_names).alias("code")
    )


@query(
    "explode_annotation_lists",
    f"""SELECT {CLASSIFICATION_SQL} AS classification_id, t.task FROM lineitem,
    (VALUES ('T0'), ('T1')) AS t(task)""",
)
def explode_annotation_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    exploded = explode_annotations(annotated_lines(spark, sf_dir), ["classification_id"], exclude_tasks=["T10"])
    return exploded.select("classification_id", "task")


@query(
    "explode_multiple_answers",
    f"""SELECT {CLASSIFICATION_SQL} AS classification_id, t.feature FROM lineitem,
    (VALUES ('ring'), ('lens_or_arc')) AS t(feature)""",
)
def explode_multiple_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = explode_annotations(annotated_lines(spark, sf_dir), ["classification_id"], exclude_tasks=["T0", "T1"])
    return chosen_features(rows, "classification_id")


@query(
    "parse_json_cells",
    """SELECT event_id, json_extract_string(props, '$.k') AS k FROM events""",
)
def parse_json_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = jsons.string_map(F.col("props"))
    return table(spark, sf_dir, "events").select("event_id", members["k"].alias("k"))


@query(
    "serialise_json",
    """SELECT p_partkey, '{"name":"' || p_name || '"}' AS dropped, '{"name":"' || p_name || '","gone":null}' AS kept
    FROM part""",
)
def serialise_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = F.struct(F.col("p_name").alias("name"), F.lit(None).cast("string").alias("gone"))
    kept = F.to_json(record, {"ignoreNullFields": "false"})
    return table(spark, sf_dir, "part").select("p_partkey", F.to_json(record).alias("dropped"), kept.alias("kept"))


_LABELLED_SQL = f"""SELECT {CLASSIFICATION_SQL} AS classification_id, 'T0' AS task, 'Which flag?' AS task_label,
'![flag.png](https://img.example/flag.png =60x) ' || l_returnflag || ' ' AS value,
CAST(strpos('ANR', l_returnflag) - 1 AS VARCHAR) AS value_index, false AS multiple_choice
FROM lineitem WHERE l_linenumber <> 7
UNION ALL SELECT {CLASSIFICATION_SQL}, 'T1', 'Which status?', l_linestatus,
CAST(strpos('FO', l_linestatus) - 1 AS VARCHAR), false FROM lineitem {{where}}
UNION ALL SELECT {CLASSIFICATION_SQL}, 'T10', 'Do you see any of these rare features?',
'["' || l_returnflag || ' in NATION_' || (l_suppkey % 25) || '","Lens or Arc"]',
'[' || (strpos('ANR', l_returnflag) - 1) || ',3]', true FROM lineitem {{where}}"""


def _labelled(spark: SparkSession, sf_dir: str, strict: bool) -> DataFrame:
    from pollfold.plans.derive import derive

    versions = workflow_versions(version_records(spark, sf_dir))
    derived = derive(raw_lines(spark, sf_dir), versions, strict=strict)
    rows = derived.select("classification_id", F.inline("annotations"))
    return rows.select("classification_id", "task", "task_label", "value", "value_index", "multiple_choice")


@query("insert_workflow_contents", _LABELLED_SQL.format(where=""))
def insert_workflow_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(spark, sf_dir, strict=False)


@query("insert_workflow_contents_strict", _LABELLED_SQL.format(where="WHERE l_linenumber <> 7"))
def insert_workflow_contents_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(spark, sf_dir, strict=True)


@query(
    "first_json_member",
    f"""SELECT {CLASSIFICATION_SQL} AS classification_id, 'J' || l_partkey AS iauname FROM lineitem""",
)
def first_json_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    member = jsons.first_member(F.col("subject_data"))
    name = jsons.first_present(member, ["iauname", "!iauname", "IAUNAME", "!IAUNAME"])
    return written_export(spark, sf_dir).select("classification_id", name.alias("iauname"))


@query(
    "first_present_key",
    """SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN s_name WHEN s_suppkey % 3 = 1 THEN 'old ' || s_name END AS id,
    s_name AS nested FROM supplier""",
)
def first_present_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, third = F.col("s_name"), F.col("s_suppkey") % 3
    members = F.when(third == 0, F.create_map(F.lit("id"), name, F.lit("!id"), F.lit("never")))
    members = members.when(third == 1, F.create_map(F.lit("!id"), F.concat(F.lit("old "), name)))
    members = members.otherwise(F.create_map(F.lit("else"), name))
    inner = F.to_json(F.create_map(F.lit("!id"), name))
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        jsons.first_present(members, ["id", "!id"]).alias("id"),
        jsons.first_present_nested(F.create_map(F.lit("retired"), inner), "retired", ["id", "!id"]).alias("nested"),
    )


@query(
    "select_metadata_keys",
    """SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN '#' || s_name ELSE '!' || s_name END AS iauname FROM supplier""",
)
def select_metadata_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("#"), F.col("s_name")))
    record = F.struct(shown.alias("#iauname"), F.concat(F.lit("!"), F.col("s_name")).alias("!iauname"))
    members = jsons.string_map(F.to_json(record))
    later_wins = jsons.first_present(members, ["#iauname", "!iauname"])
    return table(spark, sf_dir, "supplier").select("s_suppkey", later_wins.alias("iauname"))


@query("expand_json_columns", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def expand_json_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expand_metadata(table(spark, sf_dir, "events").select("event_id", "props"), "props").drop("props")


@query("json_keys", "SELECT DISTINCT unnest(json_keys(props)) AS key FROM events")
def json_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata_key_rows(table(spark, sf_dir, "events"), "props")


@query("frame_urls", "SELECT page_id, url AS first, url || '/1' AS second FROM pages")
def frame_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    second = F.concat(F.col("url"), F.lit("/1"))
    frames = F.to_json(F.create_map(F.lit("0"), F.col("url"), F.lit("1"), second))
    pages = table(spark, sf_dir, "pages").select("page_id", frames.alias("locations"))
    return pages.select(
        "page_id", jsons.frame_url(F.col("locations")).alias("first"), jsons.frame_url(F.col("locations"), 1).alias("second")
    )


@query(
    "parse_browser_metadata",
    f"""SELECT {CLASSIFICATION_SQL} AS classification_id, 'api' AS source, '800' AS width,
    strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS started_at, true AS live_project FROM lineitem""",
)
def parse_browser_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = written_export(spark, sf_dir).select("classification_id", jsons.browser_metadata(F.col("metadata")).alias("m"))
    return parsed.select(
        "classification_id",
        F.col("m.source").alias("source"),
        F.col("m.viewport.width").alias("width"),
        text_time(F.col("m.started_at")).alias("started_at"),
        F.col("m.live_project").alias("live_project"),
    )


@query(
    "response_ids",
    f"""WITH {LINE_RESPONSES_SQL}, t AS (SELECT classification_id, question, response,
      list_transform(string_split(classification_id || question || response, ''), lambda x: ord(x)) AS b FROM responses)
    SELECT classification_id, question, CAST((len(b) + list_sum(list_transform(range(1, len(b) + 1),
      lambda i: (len(b) - i + 1) * b[i])))::BIGINT % 65521 * 65536 + (1 + list_sum(b))::BIGINT % 65521 AS VARCHAR) AS response_id
    FROM t""",
)
def response_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = ids.response_id(F.col("classification_id"), F.col("question"), F.col("response"), kind="adler32")
    return line_responses(spark, sf_dir).select("classification_id", "question", key.alias("response_id"))


@query(
    "person_ids",
    f"""SELECT {CLASSIFICATION_SQL} AS classification_id,
    CASE WHEN l_suppkey % 2 = 0 THEN CAST(l_suppkey AS VARCHAR) WHEN l_suppkey % 3 <> 0 THEN 'ip_10.0.0.' || l_suppkey END
      AS person_id,
    CASE WHEN l_suppkey % 2 = 0 AND l_suppkey <> 0 THEN CAST(l_suppkey AS VARCHAR)
      WHEN l_suppkey % 3 <> 0 THEN '10.0.0.' || l_suppkey END AS user_id FROM lineitem""",
)
def person_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    user, address = F.col("user_id"), F.col("user_ip")
    return written_export(spark, sf_dir).select(
        "classification_id",
        ids.person_id(user, address).alias("person_id"),
        ids.account_or_address(user, address).alias("user_id"),
    )


@query(
    "multiple_choice_flag",
    f"""SELECT {CLASSIFICATION_SQL} AS classification_id, t.task, t.task = 'T10' AS multiple_choice FROM lineitem,
    (VALUES ('T0'), ('T1'), ('T10')) AS t(task)""",
)
def multiple_choice_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = jsons.export_annotations(F.col("annotations"), ["question of T10"])
    rows = written_export(spark, sf_dir).select("classification_id", F.inline(parsed))
    return rows.select("classification_id", "task", "multiple_choice")
