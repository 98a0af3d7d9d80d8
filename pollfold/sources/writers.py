"""Sinks."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pollfold.functions.columns import c
from pollfold.sources.storage import remove

# Column order of the plain text response lines (fixed value).
RESPONSE_LINE = ("classification_id", "created_at", "user_id", "subject_id", "task", "value")
RUN_LOG = "run_at timestamp, table_path string, seconds double"
# rows of a compressed text file: such a file is read by one task, so none may be large
PER_FILE = 250_000


def _text_options(compression: str | None) -> dict[str, str | int]:
    return {} if compression is None else {"compression": compression, "maxRecordsPerFile": PER_FILE}


def write_json(df: DataFrame, path: str, mode: str = "error", compression: str | None = None) -> None:
    """JSON lines, compressed (``snappy``, say: about as fast as plain text) on request; readers tell by the file names."""
    df.write.mode(mode).options(**_text_options(compression)).json(path)


def write_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", compression: str | None = None, per_file: int | None = None
) -> None:
    """Parquet, in the session's codec unless one is named (``zstd``, say: smaller at the same speed)."""
    options = {"compression": compression, "maxRecordsPerFile": per_file}
    df.write.mode(mode).options(**{k: v for k, v in options.items() if v is not None}).parquet(path)


def write_csv(df: DataFrame, path: str | None, mode: str = "overwrite", compression: str | None = None) -> None:
    """CSV with header, compressed on request; nothing is written when there is no path."""
    if path is not None:
        df.write.mode(mode).option("header", True).option("escape", '"').options(**_text_options(compression)).csv(path)


def write_lines(df: DataFrame, path: str, columns: Sequence[str] = RESPONSE_LINE, mode: str = "overwrite") -> None:
    """Comma-joined lines in a fixed column order, without header."""
    df.select(*[c(name) for name in columns]).write.mode(mode).option("escape", '"').csv(path)


def write_bounded_json(df: DataFrame, path: str, per_file: int = 2500, mode: str = "append") -> None:
    """JSON lines, at most ``per_file`` rows per file; files appear only when complete."""
    df.write.mode(mode).option("maxRecordsPerFile", per_file).json(path)


def write_single_file(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """One output file, for small published results: a single task writes it all."""
    df.repartition(1).write.mode(mode).format(fmt).option("header", True).save(path)


def fresh_or_recomputed(
    spark: SparkSession,
    folder: str,
    compute: Callable[[], DataFrame],
    max_age: timedelta | None = timedelta(hours=1),
    now: datetime | None = None,
    grace: timedelta | None = timedelta(days=1),
) -> DataFrame:
    """The stored result when it is younger than ``max_age``, else a new one, which is stored first.

    Every run writes its own table and one row to the run log, so readers never see half a result.
    ``max_age=None`` always recomputes. Tables that a newer one has replaced are removed once they are older than ``grace``,
    the time that their readers have; ``None`` keeps them.
    """
    now = now or datetime.now(timezone.utc)
    log = f"{folder}/runs"
    if max_age is not None:
        try:
            latest = spark.read.schema(RUN_LOG).json(log).orderBy(F.desc("run_at")).limit(1)
            young = latest.filter(F.col("run_at") > F.lit(now - max_age)).collect()
        except AnalysisException:  # nothing stored yet
            young = []
        if young:
            return spark.read.parquet(young[0]["table_path"])
    started = time.monotonic()
    table = f"{folder}/table-{now:%Y%m%dT%H%M%S%f}"
    compute().write.parquet(table)
    entry = [(now, table, time.monotonic() - started)]
    spark.createDataFrame(entry, RUN_LOG).coalesce(1).write.mode("append").json(log)
    if grace is not None:
        # the run before this one was the newest until now, so its readers have the grace from here on
        runs = spark.read.schema(RUN_LOG).json(log).filter(F.col("table_path") != table).orderBy(F.desc("run_at"))
        for old in runs.offset(1).filter(F.col("run_at") < F.lit(now - grace)).collect():
            remove(spark, old["table_path"])
    return spark.read.parquet(table)

