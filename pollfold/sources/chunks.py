"""Chunk index: the first and last id of every raw file, stored, so that a pull opens only files above its cursor."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pollfold.sources.readers import API_RECORD, DERIVED_MARK, FIRST_ID, next_records, read_json

INDEX = "path string, file_name string, first_id bigint, last_id bigint, records bigint"


def read_index(spark: SparkSession, index: str) -> DataFrame:
    """(path, file_name, first_id, last_id, records) of the files indexed so far."""
    try:
        return spark.read.schema(INDEX).parquet(index)
    except AnalysisException:  # nothing indexed yet
        return spark.createDataFrame([], INDEX)


def chunk_files(spark: SparkSession, folder: str, prefix: str, derived: bool = False) -> DataFrame:
    """(path, file_name) of the chunk files of a folder, listed without opening them."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"{prefix}*").option("recursiveFileLookup", True).load(folder)
    named = files.select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"))
    is_derived = F.contains("file_name", F.lit(DERIVED_MARK))
    return named.filter(is_derived if derived else ~is_derived)


def update_index(
    spark: SparkSession, folder: str, index: str, prefix: str, derived: bool = False, schema: str = API_RECORD
) -> int:
    """Indexes the chunk files that are not in the index yet and returns their number; only they are opened."""
    known = read_index(spark, index).select("path")
    fresh = [r["path"] for r in chunk_files(spark, folder, prefix, derived).join(known, "path", "left_anti").collect()]
    if not fresh:
        return 0
    ids = F.col("id").cast("bigint")
    records = read_json(spark, fresh, schema).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file_name"), ids.alias("id")
    )
    found = records.groupBy("path", "file_name").agg(
        F.min("id").alias("first_id"), F.max("id").alias("last_id"), F.count(F.lit(1)).alias("records")
    )
    found.write.mode("append").parquet(index)
    return len(fresh)


def index_cursor(spark: SparkSession, index: str, default: int = FIRST_ID) -> int:
    """The highest id of all indexed files, or the default start: where the next pull goes on."""
    return read_index(spark, index).agg(F.coalesce(F.max("last_id"), F.lit(default))).first()[0]


def pull(
    spark: SparkSession, index: str, after: int, max_records: int | None = None, schema: str = API_RECORD
) -> DataFrame:
    """Indexed records above a cursor, as :func:`next_records` gives them; files that end at or below it are not opened."""
    paths = [r["path"] for r in read_index(spark, index).filter(F.col("last_id") > after).select("path").collect()]
    if not paths:
        return spark.createDataFrame([], schema)
    return next_records(read_json(spark, paths, schema), after, max_records)
