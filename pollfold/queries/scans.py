"""Sources and sinks: tables are written in the platform's file formats to the shared folder and read back."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pollfold.queries.registry import query
from pollfold.queries.tables import (
    classification,
    CLASSIFICATION_SQL,
    annotated_lines,
    line_responses,
    raw_lines,
    table,
    text_time,
    version_records,
)
from pollfold.functions.jsons import ANNOTATION_TEXT
from pollfold.sources import chunks, readers, rejects, writers
from pollfold.sources.storage import scratch_path

_EVENT_SQL = """SELECT CAST(event_id AS VARCHAR) AS id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS created_at,
event_type AS kind, props FROM events"""


def _event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("id"),
        text_time(F.col("ts")).alias("created_at"),
        F.col("event_type").alias("kind"),
        "props",
    )


_EVENT_SCHEMA = "id string, created_at string, kind string, props string"


@query("scan_json_lines", _EVENT_SQL)
def scan_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "json")
    writers.write_json(_event_records(spark, sf_dir), path)
    return readers.read_json(spark, path, _EVENT_SCHEMA)


@query("scan_json_schema_from_example", _EVENT_SQL)
def scan_json_schema_from_example(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "json")
    writers.write_json(_event_records(spark, sf_dir), path)
    schema = readers.infer_schema_from_example(spark, path)
    return readers.read_json(spark, path, schema).select("id", "created_at", "kind", "props")


@query("scan_json_many_paths", _EVENT_SQL)
def scan_json_many_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _event_records(spark, sf_dir)
    views = F.col("kind").isin("view", "click")
    paths = [scratch_path(spark, "json"), scratch_path(spark, "json")]
    writers.write_json(records.filter(views), paths[0])
    writers.write_json(records.filter(~views), paths[1])
    return readers.read_json(spark, paths, _EVENT_SCHEMA)


def _export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines as a classification export, JSON cells and all."""
    lines = annotated_lines(spark, sf_dir)
    short = F.transform("annotations", lambda a: F.struct(a["task"], a["task_label"], a["value"]))
    subject = F.create_map(F.col("subject_id"), F.create_map(F.lit("!iauname"), F.col("iauname")))
    number = F.col("user_id").cast("int")
    return lines.select(
        "classification_id",
        F.concat(F.lit("user"), "user_id").alias("user_name"),
        F.when(number % 2 == 0, F.concat(F.col("user_id"), F.lit(".0"))).alias("user_id"),
        F.when(number % 3 != 0, F.concat(F.lit("10.0.0."), "user_id")).alias("user_ip"),
        "workflow_id",
        F.lit("tree").alias("workflow_name"),
        F.col("workflow_version").cast("float").alias("workflow_version"),
        F.concat(F.translate(F.substring("created_at", 1, 19), "T", " "), F.lit(" UTC")).alias("created_at"),
        F.lit("").alias("gold_standard"),
        F.lit("").alias("expert"),
        F.to_json(
            F.struct(
                F.lit("api").alias("source"),
                F.struct(F.lit("800").alias("width"), F.lit("600").alias("height")).alias("viewport"),
                F.col("created_at").alias("started_at"),
                F.col("created_at").alias("finished_at"),
                F.lit(True).alias("live_project"),
                F.lit("en, gb").alias("user_language"),
            )
        ).alias("metadata"),
        F.to_json(short, {"ignoreNullFields": "false"}).alias("annotations"),
        F.to_json(subject).alias("subject_data"),
        F.col("subject_id").alias("subject_ids"),
    )


def written_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The export, written as compressed CSV with doubled quotes and scanned strictly."""
    path = scratch_path(spark, "export")
    writers.write_csv(_export(spark, sf_dir), path, compression="snappy")
    return readers.read_classification_export(spark, path)


@query(
    "scan_classification_export",
    f"""SELECT {CLASSIFICATION_SQL} AS classification_id, 'user' || l_suppkey AS user_name,
    CASE WHEN l_suppkey % 2 = 0 THEN l_suppkey || '.0' END AS user_id,
    strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') || ' UTC' AS created_at, CAST(l_partkey AS VARCHAR) AS subject_ids,
    '{{"' || l_partkey || '":{{"!iauname":"J' || l_partkey || '"}}}}' AS subject_data FROM lineitem""",
)
def scan_classification_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written_export(spark, sf_dir).select(
        "classification_id", "user_name", "user_id", "created_at", "subject_ids", "subject_data"
    )


@query(
    "scan_classification_cells",
    f"""SELECT {CLASSIFICATION_SQL} AS classification_id, CASE WHEN l_suppkey % 3 <> 0 THEN '10.0.0.' || l_suppkey END AS user_ip,
    '1' AS workflow_id, 'tree' AS workflow_name, CAST('66.' || (l_linenumber * 100) AS FLOAT) AS workflow_version,
    CAST(NULL AS VARCHAR) AS gold_standard, CAST(NULL AS VARCHAR) AS expert,
    '{{"source":"api","viewport":{{"width":"800","height":"600"}},"started_at":"' || strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ')
      || '","finished_at":"' || strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') || '","live_project":true,"user_language":"en, gb"}}' AS metadata,
    '[{{"task":"T0","task_label":"question of T0","value":' || CASE WHEN l_linenumber = 7 THEN '"  "' ELSE
      '"![flag.png](https://img.example/flag.png =60x) ' || l_returnflag || ' "' END
      || '}},{{"task":"T1","task_label":"question of T1","value":' || CASE WHEN l_linenumber = 6 THEN 'null' ELSE '"' || chr(39) || l_linestatus || chr(39) || '"' END
      || '}},{{"task":"T10","task_label":"question of T10","value":"[\\"ring\\",\\"lens or arc\\"]"}}]' AS annotations FROM lineitem""",
)
def scan_classification_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other columns of the export: JSON cells with commas, quotes and nested objects come back as written."""
    return written_export(spark, sf_dir).select(
        "classification_id",
        "user_ip",
        "workflow_id",
        "workflow_name",
        "workflow_version",
        "gold_standard",
        "expert",
        "metadata",
        "annotations",
    )


@query("scan_csv_text_ids", "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand FROM part")
def scan_csv_text_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    writers.write_csv(table(spark, sf_dir, "part"), path)
    return readers.read_csv(spark, path, columns=["p_partkey", "p_name", "p_brand"])


@query("scan_csv_typed", "SELECT p_partkey, p_name, p_size FROM part")
def scan_csv_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    writers.write_csv(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size"), path)
    return readers.read_csv(spark, path, schema="p_partkey bigint, p_name string, p_size int")


@query("scan_csv_first_rows", "SELECT least(count(*), 1000) AS n FROM part")
def scan_csv_first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    writers.write_csv(table(spark, sf_dir, "part"), path)
    return readers.read_first_rows(spark, path, 1000).agg(F.count(F.lit(1)).alias("n"))


@query("scan_parquet", "SELECT l_partkey, l_returnflag FROM lineitem WHERE l_quantity > 25")
def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = readers.read_parquet(spark, f"{sf_dir}/lineitem.parquet")
    return lines.filter(F.col("l_quantity") > 25).select("l_partkey", "l_returnflag")


@query("scan_shards_without_header", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def scan_shards_without_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "shards")
    writers.write_lines(table(spark, sf_dir, "customer"), path, ["c_custkey", "c_name", "c_mktsegment"])
    return readers.read_shards(spark, path, "c_custkey bigint, c_name string, c_mktsegment string")


@query(
    "chunk_first_and_last_ids",
    "SELECT event_type AS kind, min(event_id) AS first_id, max(event_id) AS last_id FROM events GROUP BY event_type",
)
def chunk_first_and_last_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "chunks")
    _event_records(spark, sf_dir).write.partitionBy("kind").option("maxRecordsPerFile", 500).json(folder)
    records = spark.read.schema(_EVENT_SCHEMA).json(folder)
    named = records.select("*", F.col("_metadata.file_path").alias("file_name"))
    kinds = named.select("file_name", "kind").distinct()
    chunks = readers.chunk_ids(named).join(kinds, "file_name")
    return chunks.groupBy("kind").agg(F.min("first_id").alias("first_id"), F.max("last_id").alias("last_id"))


_CHUNK = 500


def _chunk_files(spark: SparkSession, sf_dir: str) -> str:
    """Events as one file per run of ids."""
    folder = scratch_path(spark, "chunks")
    records = _event_records(spark, sf_dir).withColumn("run", F.floor(F.col("id").cast("bigint") / _CHUNK))
    records.repartition("run").write.partitionBy("run").json(folder)
    return folder


@query(
    "chunk_catalogue",
    f"""SELECT min(event_id) AS first_id, max(event_id) AS last_id, count(*) AS records
    FROM events GROUP BY event_id // {_CHUNK}""",
)
def chunk_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per chunk file, from the stored index."""
    folder, index = _chunk_files(spark, sf_dir), scratch_path(spark, "index")
    chunks.update_index(spark, folder, index, "part", schema=_EVENT_SCHEMA)
    chunks.update_index(spark, folder, index, "part", schema=_EVENT_SCHEMA)  # nothing new, nothing twice
    return chunks.read_index(spark, index).select("first_id", "last_id", "records")


@query("chunk_records", f"SELECT CAST(event_id AS VARCHAR) AS id, event_id // {_CHUNK} AS run FROM events")
def chunk_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of raw chunk files by name pattern; derived ones are another set, here empty."""
    folder = _chunk_files(spark, sf_dir)
    read = lambda derived: readers.read_chunks(spark, folder, "part", derived, f"{_EVENT_SCHEMA}, run bigint")
    return read(False).unionByName(read(True)).select("id", "run")


@query(
    "chunk_pull",
    "SELECT CAST(event_id AS VARCHAR) AS id, event_type AS kind FROM events WHERE event_id > (SELECT max(event_id) // 2 FROM events)",
)
def chunk_pull(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pull from the middle: files that end below the cursor stay closed."""
    folder, index = _chunk_files(spark, sf_dir), scratch_path(spark, "index")
    chunks.update_index(spark, folder, index, "part", schema=_EVENT_SCHEMA)
    middle = chunks.index_cursor(spark, index) // 2
    return chunks.pull(spark, index, middle, schema=_EVENT_SCHEMA).select("id", "kind")


@query("resume_cursor", "SELECT coalesce(max(event_id), 159526481) AS last_id FROM events")
def resume_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.last_id(_event_records(spark, sf_dir))


@query(
    "next_records_above_cursor",
    "SELECT event_id, event_type FROM events WHERE event_id > 100 ORDER BY event_id LIMIT 500",
)
def next_records_above_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return readers.next_records(events, 100, 500, "event_id").select("event_id", "event_type")


@query(
    "next_records_repeated_ids",
    """SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey > 100 AND l_orderkey <= (
      SELECT max(l_orderkey) FROM (SELECT l_orderkey FROM lineitem WHERE l_orderkey > 100 ORDER BY l_orderkey LIMIT 501))""",
)
def next_records_repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several lines share an order: those of the last order all come along."""
    return readers.next_records(table(spark, sf_dir, "lineitem"), 100, 501, "l_orderkey").select("l_orderkey", "l_linenumber")


@query(
    "workflow_version_dimension",
    """SELECT CAST(n_regionkey AS VARCHAR) AS workflow_id, CAST(n_nationkey AS VARCHAR) AS workflow_major_version,
    '0' AS workflow_minor_version, 'N in ' || n_name AS label FROM nation""",
)
def workflow_version_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "versions")
    records = version_records(spark, sf_dir)
    writers.write_json(records, path)
    versions = readers.read_workflow_versions(spark, path, expected=records.count())
    label = F.try_element_at("strings", F.lit("T10.answers.1.label")).alias("label")
    return versions.select("workflow_id", "workflow_major_version", "workflow_minor_version", label)


@query(
    "scan_api_records",
    f"""SELECT {CLASSIFICATION_SQL} AS id, CAST(l_partkey AS VARCHAR) AS subject_id, 3 AS annotations,
    CASE WHEN l_linenumber <> 7 THEN CAST(strpos('ANR', l_returnflag) - 1 AS VARCHAR) END AS first_value
    FROM lineitem""",
)
def scan_api_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "raw")
    writers.write_json(raw_lines(spark, sf_dir), path, compression="snappy")
    return readers.read_json(spark, path).select(
        "id",
        F.col("links.subject.id").alias("subject_id"),
        F.size("annotations").alias("annotations"),
        F.col("annotations")[0]["value"].alias("first_value"),
    )


@query("sink_parquet", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def sink_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "parquet")
    writers.write_parquet(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), path)
    return readers.read_parquet(spark, path)


@query("sink_csv_optional", "SELECT s_suppkey, s_name FROM supplier")
def sink_csv_optional(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    writers.write_csv(suppliers, None)
    path = scratch_path(spark, "csv")
    writers.write_csv(suppliers, path)
    return readers.read_csv(spark, path, schema="s_suppkey bigint, s_name string")


_LINES_SQL = f"""SELECT {CLASSIFICATION_SQL} AS classification_id,
strftime(l_shipdate, '%Y-%m-%d') AS created_at, CAST(l_suppkey AS VARCHAR) AS user_id,
CAST(l_partkey AS VARCHAR) AS subject_id, 'T0' AS task, l_returnflag AS value FROM lineitem"""


@query("sink_text_lines", _LINES_SQL)
def sink_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("value"),
        F.lit("T0").alias("task"),
        F.col("l_partkey").alias("subject_id"),
        F.col("l_suppkey").alias("user_id"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("created_at"),
        classification().alias("classification_id"),
    )
    path = scratch_path(spark, "lines")
    writers.write_lines(rows, path)
    return readers.read_shards(spark, path, ", ".join(f"{n} string" for n in writers.RESPONSE_LINE))


@query("sink_bounded_files", "SELECT count(*) AS n, true AS bounded FROM orders")
def sink_bounded_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "bounded")
    writers.write_bounded_json(table(spark, sf_dir, "orders"), path)
    files = spark.read.text(path).groupBy(F.col("_metadata.file_path")).agg(F.count(F.lit(1)).alias("rows"))
    return files.agg(F.sum("rows").alias("n"), (F.max("rows") <= 2500).alias("bounded"))


@query("sink_single_file", "SELECT count(*) AS n, 1 AS files FROM nation")
def sink_single_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "single")
    writers.write_single_file(table(spark, sf_dir, "nation"), path)
    rows = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file"))
    return rows.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("file").alias("files"))


@query(
    "freshness_gate",
    "SELECT l_partkey AS subject_id, count(*) AS responses FROM lineitem GROUP BY l_partkey",
)
def freshness_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "gate")

    def compute() -> DataFrame:
        flags = line_responses(spark, sf_dir).filter("question = 'return-flag'")
        return flags.groupBy("subject_id").agg(F.count(F.lit(1)).alias("responses"))

    def never() -> DataFrame:
        raise AssertionError("a fresh result must not be computed again")

    writers.fresh_or_recomputed(spark, folder, compute, timedelta(hours=1))
    return writers.fresh_or_recomputed(spark, folder, never, timedelta(hours=1))


# line 5 is cut off in the middle, line 6 has text in place of a number (fixed by the queries below and their SQL)
@query(
    "rejected_json_records",
    f"""SELECT {CLASSIFICATION_SQL} AS id, l_linenumber NOT IN (5, 6) AS kept, CASE l_linenumber
      WHEN 5 THEN '{{"id":"' || {CLASSIFICATION_SQL} || '","line"'
      WHEN 6 THEN '{{"id":"' || {CLASSIFICATION_SQL} || '","line":"six"}}' END AS record FROM lineitem""",
)
def rejected_json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted and rejected lines of one scan together are the input."""
    path = scratch_path(spark, "damaged")
    line, id_ = F.col("l_linenumber"), classification()
    start = F.concat(F.lit('{"id":"'), id_, F.lit('","line"'))
    rest = F.when(line == 5, F.lit("")).when(line == 6, F.lit(':"six"}')).otherwise(F.concat(F.lit(":"), line.cast("string"), F.lit("}")))
    table(spark, sf_dir, "lineitem").select(F.concat(start, rest).alias("value")).write.text(path)
    records = readers.json_records(rejects.read_lines(spark, path), "id string, line int")
    found = rejects.routed(records, scratch_path(spark, "routed"), "lines")
    kept = found.accepted.select("id", F.lit(True).alias("kept"), F.lit(None).cast("string").alias("record"))
    name = F.regexp_extract("record", '"id":"([^"]*)"', 1)
    return kept.unionByName(found.rejected.select(name.alias("id"), F.lit(False).alias("kept"), "record"))


@query(
    "rejected_csv_rows",
    """SELECT CAST(p_partkey AS VARCHAR) AS part, p_size % 7 > 1 AS kept,
    CASE p_size % 7 WHEN 0 THEN p_partkey || ',' || p_size || 'x' WHEN 1 THEN CAST(p_partkey AS VARCHAR) END AS record FROM part""",
)
def rejected_csv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a cell that is no number, or with too few cells, are set aside whole."""
    path = scratch_path(spark, "damaged")
    part, size = F.col("p_partkey").cast("string"), F.col("p_size").cast("string")
    rest = F.when(F.col("p_size") % 7 == 0, F.concat(F.lit(","), size, F.lit("x"))).when(F.col("p_size") % 7 == 1, F.lit(""))
    row = F.concat(part, F.coalesce(rest, F.concat(F.lit(","), size)))
    table(spark, sf_dir, "part").select(row.alias("value")).write.text(path)
    found = rejects.routed(readers.csv_records(spark, path, "part string, size int", header=False), scratch_path(spark, "routed"), "parts")
    kept = found.accepted.select("part", F.lit(True).alias("kept"), F.lit(None).cast("string").alias("record"))
    return kept.unionByName(found.rejected.select(F.split("record", ",")[0].alias("part"), F.lit(False).alias("kept"), "record"))


@query(
    "rejected_annotations",
    f"""SELECT {CLASSIFICATION_SQL} AS classification_id, CASE WHEN l_linenumber = 5 THEN 'annotations'
      WHEN l_linenumber = 6 THEN 'annotations, metadata' END AS reason,
      CASE WHEN l_linenumber NOT IN (5, 6) THEN 3 END AS annotations FROM lineitem""",
)
def rejected_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export rows with damaged JSON cells leave the main path with the names of their damaged columns."""
    line = F.split("classification_id", "-")[1]
    damaged = _export(spark, sf_dir).withColumns(
        {
            "annotations": F.when(line.isin("5", "6"), F.substring("annotations", 1, 30)).otherwise(F.col("annotations")),
            "metadata": F.when(line == "6", F.lit("{no json")).otherwise(F.col("metadata")),
        }
    )
    path = scratch_path(spark, "export")
    writers.write_csv(damaged, path, compression="snappy")
    records = readers.csv_records(spark, path, readers.CLASSIFICATION_EXPORT)
    checked = rejects.checked_cells(records, {"annotations": ANNOTATION_TEXT, "metadata": "map<string,string>"})
    found = rejects.routed(checked, scratch_path(spark, "routed"), "export")
    parsed = F.from_json("annotations", ANNOTATION_TEXT, {"mode": "FAILFAST"})
    kept = found.accepted.select("classification_id", F.lit(None).cast("string").alias("reason"), F.size(parsed).alias("annotations"))
    name = F.get_json_object("record", "$.classification_id")
    return kept.unionByName(found.rejected.select(name.alias("classification_id"), "reason", F.lit(None).cast("int").alias("annotations")))
