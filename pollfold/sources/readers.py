"""Scans: classification exports, API records, subject exports, vote tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pollfold.functions.columns import c
from pollfold.functions.jsons import STRICT
from pollfold.operators.aggregates import value_at_rank
from pollfold.sources.rejects import csv_records as csv_records  # the tolerant counterparts of the strict readers below
from pollfold.sources.rejects import json_records as json_records

# Column names and types of the platform's files (fixed values).
CLASSIFICATION_EXPORT = (
    "classification_id string, user_name string, user_id string, user_ip string, workflow_id string, "
    "workflow_name string, workflow_version float, created_at string, gold_standard string, expert string, "
    "metadata string, annotations string, subject_data string, subject_ids string"
)
SUBJECT_EXPORT = (
    "subject_id string, project_id string, workflow_id string, subject_set_id string, metadata string, "
    "locations string, classifications_count int, retired_at string, retirement_reason string"
)
API_RECORD = (
    "id string, created_at string, annotations array<struct<task:string,value:string>>, "
    "metadata struct<workflow_version:string>, "
    "links struct<project:string,user:string,workflow:string,"
    "subject:struct<id:string,locations:array<map<string,string>>,metadata:map<string,string>>>"
)
WORKFLOW_VERSION = "major_number string, minor_number string, links struct<workflow:string>, strings map<string,string>"
DERIVED_MARK = "derived"
# a row with too few cells, or a cell that does not fit its type, fails the scan, whichever columns are asked for
STRICT_CSV = {"quote": '"', "escape": '"', "mode": "FAILFAST", "columnPruning": "false"}
FIRST_ID = 159526481  # where an incremental pull starts when nothing was pulled before


def infer_schema_from_example(spark: SparkSession, example: str) -> StructType:
    """Schema of one small JSON-lines file, for streams that have to know it up front."""
    return spark.read.options(**STRICT).json(example).schema


def read_json(spark: SparkSession, paths: str | Sequence[str], schema: StructType | str | None = API_RECORD) -> DataFrame:
    """JSON-lines files or folders; with ``schema=None`` the schema is inferred (an extra pass). A damaged line fails the scan."""
    reader = spark.read.options(**STRICT) if schema is None else spark.read.options(**STRICT).schema(schema)
    return reader.json(paths if isinstance(paths, str) else list(paths))


def stream_json(spark: SparkSession, folder: str, schema: StructType | str = API_RECORD, max_files: int | None = None) -> DataFrame:
    """New JSON-lines files of a folder as a stream; a damaged line stops it."""
    reader = spark.readStream.options(**STRICT).schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(folder)


def stream_parquet(spark: SparkSession, folder: str, schema: StructType | str, max_bytes: int | None = None) -> DataFrame:
    """New Parquet files of a folder as a stream, about ``max_bytes`` of them in a batch, one file at least."""
    reader = spark.readStream.schema(schema)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(folder)


def read_classification_export(spark: SparkSession, path: str) -> DataFrame:
    """Classification export: quotes inside JSON cells are doubled; a malformed row fails the scan."""
    return spark.read.options(**STRICT_CSV).csv(path, schema=CLASSIFICATION_EXPORT, header=True, enforceSchema=False)


def read_subject_export(spark: SparkSession, path: str) -> DataFrame:
    """Subject export; all ids stay text. A malformed row fails the scan."""
    return spark.read.options(**STRICT_CSV).csv(path, schema=SUBJECT_EXPORT, header=True)


def read_csv(spark: SparkSession, path: str, schema: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """CSV with header. Without ``schema`` every column is text: no inference pass, ids keep their zeros. A malformed row
    fails the scan; :func:`csv_records` sets it aside instead."""
    df = spark.read.options(**STRICT_CSV).csv(path, schema=schema, header=True)
    return df if columns is None else df.select(*[c(name) for name in columns])


def read_first_rows(spark: SparkSession, path: str, n: int, schema: str | None = None) -> DataFrame:
    """First n rows of a CSV, for dry runs."""
    return read_csv(spark, path, schema).limit(n)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_shards(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """CSV part files without header line; a malformed row fails the scan."""
    return spark.read.options(**STRICT_CSV).csv(folder, schema=schema, header=False)


def read_chunks(
    spark: SparkSession, folder: str, prefix: str, derived: bool = False, schema: str = API_RECORD
) -> DataFrame:
    """Records of the chunk files of a folder (raw or derived ones), with their ``file_name``.

    Chunk files share a name prefix; derived ones have ``derived`` in their name.
    """
    chunks = spark.read.options(**STRICT).schema(schema).option("pathGlobFilter", f"{prefix}*").json(folder)
    named = chunks.select("*", F.col("_metadata.file_name").alias("file_name"))
    is_derived = F.contains("file_name", F.lit(DERIVED_MARK))
    return named.filter(is_derived if derived else ~is_derived)


def chunk_ids(chunks: DataFrame) -> DataFrame:
    """First and last record id of every chunk file."""
    ids = F.col("id").cast("bigint")
    return chunks.groupBy("file_name").agg(F.min(ids).alias("first_id"), F.max(ids).alias("last_id"))


def last_id(records: DataFrame, id_col: str = "id", default: int = FIRST_ID) -> DataFrame:
    """One row with the highest id seen, or the default start."""
    return records.agg(F.coalesce(F.max(c(id_col).cast("bigint")), F.lit(default).cast("bigint")).alias("last_id"))


def next_records(records: DataFrame, after: int, max_records: int | None = None, id_col: str = "id") -> DataFrame:
    """Records above a cursor; with ``max_records``, those with the lowest ids.

    The id at that rank is found first, so that no task has to hold them all. Records that share it all come along,
    since the next call starts above it.
    """
    ids = c(id_col).cast("bigint")
    newer = records.filter(ids > F.lit(after))
    if max_records is None:
        return newer
    if max_records <= 0:
        return newer.limit(0)
    numbered = newer.select(ids.alias("id"))
    if numbered.count() <= max_records:
        return newer
    return newer.filter(ids <= F.lit(value_at_rank(numbered, "id", max_records - 1)))


def read_workflow_versions(spark: SparkSession, path: str, expected: int | None = None) -> DataFrame:
    """Label maps of all workflow versions: ``workflow_id, workflow_major_version, workflow_minor_version, strings``."""
    return workflow_versions(spark.read.options(**STRICT).schema(WORKFLOW_VERSION).json(path), expected)


def workflow_versions(raw: DataFrame, expected: int | None = None) -> DataFrame:
    """Version dimension from version records; ``expected`` is the count the platform announced."""
    versions = raw.select(
        F.col("links.workflow").alias("workflow_id"),
        F.col("major_number").cast("string").alias("workflow_major_version"),
        F.col("minor_number").cast("string").alias("workflow_minor_version"),
        "strings",
    )
    if expected is not None:
        found = versions.count()
        if found != expected:
            raise ValueError(f"{found} workflow versions, {expected} announced")
    return versions
