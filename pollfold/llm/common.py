"""What the operators share: words, tables in the shared folder, slices of Arrow text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pollfold.sources.storage import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# characters beyond ASCII that a general lower() may change, those unknown to the pattern's Unicode version included
OTHER_CAPITALS = r"[\p{Lu}\p{Lt}\p{Nl}\p{So}\p{Cn}&&[^\x00-\x7F]]"
# tables are sent to all tasks up to this size
BROADCAST_BYTES = 8 << 20
# rows without id come after all others
NO_ID = 2**63 - 1
# text per step inside a task, so that memory does not depend on the batch
SLICE_BYTES = 1 << 20
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The rows written to the shared folder and read from there: lineage ends, lost executors cost nothing.

    Shuffle files of the step go as soon as its rows are written, so that disk holds those of one step at a time.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(FREE_SHUFFLES)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Removes tables that ``saved`` has written and nothing reads any more, through Spark's own file system."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.scratch_path)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def within_bytes(sample: DataFrame, most_bytes: int) -> DataFrame:
    """The rows (lot, text, ...) of a written sample of few rows whose texts, in the order of their lots, fit in ``most_bytes``."""
    sizes = sample.groupBy("lot").agg(F.sum(F.octet_length("text")).alias("size")).orderBy("lot").collect()
    total = 0
    for r in sizes:
        total += r["size"]
        if total > most_bytes:
            return sample.where(F.col("lot") < r["lot"])
    return sample


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def small_or_not(table: DataFrame, row_bytes: int, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The written table of rows of ``row_bytes``, broadcast if its counted rows fit in ``most_bytes``."""
    return F.broadcast(table) if table.count() * row_bytes <= most_bytes else table


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in runs of rows with about ``limit`` bytes of text, at least one row each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch[column]), 0), dtype=np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes of all rows, offsets); null counts as empty."""
    column = pa.compute.fill_null(column, "") if column.null_count else column
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def add_columns(docs: DataFrame, found: dict[str, str], rows_of) -> tuple[DataFrame, dict[str, Column]]:
    """All columns of ``docs`` and those of ``rows_of(batch)`` (a list of arrays), under names that no column has.

    ``found`` maps the names of the results to their types; returned with the frame are their columns by these names.
    """
    prefix = "_"
    while any(c.startswith(prefix) for c in docs.columns):
        prefix += "_"
    schema = T.StructType(docs.schema.fields + [T.StructField(prefix + n, T.DataType.fromDDL(t)) for n, t in found.items()])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([*batch.columns, *rows_of(batch)], names)

    return docs.mapInArrow(run, schema), {n: F.col(prefix + n) for n in found}


def columns_of(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]
