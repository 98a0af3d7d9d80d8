"""The provided tables in the roles that the operators expect, as DataFrames and as matching SQL.

``lineitem`` serves as a vote table with two questions: the part is the subject, the supplier the volunteer, the
ship date the time, and all four keys together the classification. ``events`` serves as a vote table with one
question: the ``k`` member of ``props`` is the subject.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pollfold.dictionary import QuestionSet

# two questions; "recalled" is an answer that nobody ever gives
FLAGS = QuestionSet.build(
    ("T0", "return-flag", {"a": "accepted", "n": "none", "r": "returned", "recalled": "recalled"}),
    ("T1", "line-status", {"f": "final", "o": "open"}),
)
# one question with the event types as answers
ACTIONS = QuestionSet.build(
    ("T0", "action", {"view": "viewed", "click": "clicked", "purchase": "bought", "signup": "joined", "error": "failed"})
)
START = "1996-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A provided table; times as UTC timestamps."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    times = [n for n, t in df.dtypes if t == "timestamp_ntz"]
    return df.withColumns({n: F.col(n).cast("timestamp") for n in times}) if times else df


def dealt(df: DataFrame) -> DataFrame:
    """Rows dealt out over all cores if the scan has fewer splits than there are cores.

    The provided tables are single files with one row group, which one task would parse alone. Tables of any size
    have more splits than cores and are left as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def text_time(ts: Column) -> Column:
    """Times leave queries as text, so that both engines print them alike."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison."""
    names = [n for n, t in df.dtypes if t == "double"]
    return df.withColumns({n: F.round(F.col(f"`{n}`"), digits) for n in names}) if names else df


def classification() -> Column:
    """Classification id of a line."""
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


CLASSIFICATION_SQL = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"


def answer_name(raw: Column, question) -> Column:
    """Published name of a raw answer letter, for building test tables."""
    pairs = [F.lit(x) for a in question.answers for x in (a.raw_name, a.name)]
    return F.try_element_at(F.create_map(*pairs), F.lower(raw))


def line_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat response table of both questions."""
    flag, status = FLAGS.questions
    answers = F.array(
        F.struct(F.lit(flag.name).alias("question"), answer_name(F.col("l_returnflag"), flag).alias("response")),
        F.struct(F.lit(status.name).alias("question"), answer_name(F.col("l_linestatus"), status).alias("response")),
    )
    return dealt(table(spark, sf_dir, "lineitem")).select(
        classification().alias("classification_id"),
        F.col("l_partkey").alias("subject_id"),
        F.col("l_suppkey").alias("user_id"),
        F.concat(F.lit("p"), F.col("l_suppkey").cast("string")).alias("person_id"),
        F.col("l_shipdate").alias("created_at"),
        F.inline(answers),
    )


LINE_RESPONSES_SQL = f"""
responses AS (
  SELECT {CLASSIFICATION_SQL} AS classification_id, l_partkey AS subject_id, l_suppkey AS user_id,
         'p' || l_suppkey AS person_id, l_shipdate AS created_at, 'return-flag' AS question,
         CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'N' THEN 'none' WHEN 'R' THEN 'returned' END AS response
  FROM lineitem
  UNION ALL
  SELECT {CLASSIFICATION_SQL}, l_partkey, l_suppkey, 'p' || l_suppkey, l_shipdate, 'line-status',
         CASE l_linestatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'open' END
  FROM lineitem
)"""


def event_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat response table of the one event question."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("classification_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("subject_id"),
        "user_id",
        F.col("ts").alias("created_at"),
        F.lit("action").alias("question"),
        answer_name(F.col("event_type"), ACTIONS.questions[0]).alias("response"),
    )


EVENT_RESPONSES_SQL = """
responses AS (
  SELECT event_id AS classification_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS subject_id, user_id,
         ts AS created_at, 'action' AS question,
         CASE event_type WHEN 'view' THEN 'viewed' WHEN 'click' THEN 'clicked' WHEN 'purchase' THEN 'bought'
              WHEN 'signup' THEN 'joined' WHEN 'error' THEN 'failed' END AS response
  FROM events
)"""


def tagged(letter: Column) -> Column:
    """Answer text the way volunteers' answers arrive: image tag, mixed case, stray spaces."""
    return F.concat(F.lit("![flag.png](https://img.example/flag.png =60x) "), letter, F.lit(" "))


def annotated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived classifications: annotation lists with tagged answers, a multiple-choice one, blanks and nulls.

    Line 7 leaves the first question blank, line 6 the second one null.
    """
    line = F.col("l_linenumber")
    none = F.lit(None).cast("string")

    def annotation(task: str, value: Column, many: bool) -> Column:
        return F.struct(
            F.lit(task).alias("task"),
            value.alias("value"),
            F.lit(f"question of {task}").alias("task_label"),
            F.lit(task).alias("task_id"),
            none.alias("value_index"),
            F.lit(many).alias("multiple_choice"),
        )

    annotations = F.array(
        annotation("T0", F.when(line == 7, F.lit("  ")).otherwise(tagged(F.col("l_returnflag"))), False),
        annotation("T1", F.when(line != 6, F.concat(F.lit("'"), F.col("l_linestatus"), F.lit("'"))), False),
        annotation("T10", F.lit('["ring","lens or arc"]'), True),
    )
    return dealt(table(spark, sf_dir, "lineitem")).select(
        classification().alias("classification_id"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
        F.lit("1").alias("workflow_id"),
        F.concat(F.lit("66."), (line * 100).cast("string")).alias("workflow_version"),
        F.col("l_suppkey").cast("string").alias("user_id"),
        F.concat(F.lit("p"), F.col("l_suppkey").cast("string")).alias("person_id"),
        F.col("l_partkey").cast("string").alias("subject_id"),
        F.concat(F.lit("J"), F.col("l_partkey").cast("string")).alias("iauname"),
        annotations.alias("annotations"),
    )


# answers of annotated_lines after cleaning, all versions, no start date
ANNOTATED_SQL = f"""
answers AS (
  SELECT {CLASSIFICATION_SQL} AS classification_id, l_shipdate AS created_at, CAST(l_suppkey AS VARCHAR) AS user_id,
         'p' || l_suppkey AS person_id, CAST(l_partkey AS VARCHAR) AS subject_id, 'J' || l_partkey AS iauname,
         '66.' || (l_linenumber * 100) AS workflow_version, l_linenumber, 'return-flag' AS question,
         CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'N' THEN 'none' WHEN 'R' THEN 'returned' END AS response
  FROM lineitem WHERE l_linenumber <> 7
  UNION ALL
  SELECT {CLASSIFICATION_SQL}, l_shipdate, CAST(l_suppkey AS VARCHAR), 'p' || l_suppkey, CAST(l_partkey AS VARCHAR),
         'J' || l_partkey, '66.' || (l_linenumber * 100), l_linenumber, 'line-status',
         CASE l_linestatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'open' END
  FROM lineitem WHERE l_linenumber <> 6
)"""


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw API records: answer indices, nested links, a workflow per region and a version per nation."""
    nation = table(spark, sf_dir, "nation")
    # letters to answer indices: A N R, F O
    flag = F.instr(F.lit("ANR"), F.col("l_returnflag")) - 1
    status = F.instr(F.lit("FO"), F.col("l_linestatus")) - 1

    def annotation(task: str, value: Column) -> Column:
        return F.struct(F.lit(task).alias("task"), value.alias("value"))

    several = F.concat(F.lit("["), flag.cast("string"), F.lit(",3]"))
    lines = dealt(table(spark, sf_dir, "lineitem")).withColumn("n_nationkey", F.pmod("l_suppkey", F.lit(25)).cast("int"))
    return lines.join(nation, "n_nationkey").select(
        classification().alias("id"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
        F.array(
            annotation("T0", F.when(F.col("l_linenumber") != 7, flag.cast("string"))),
            annotation("T1", status.cast("string")),
            annotation("T10", several),
        ).alias("annotations"),
        F.struct(F.concat(F.col("n_nationkey").cast("string"), F.lit(".0")).alias("workflow_version")).alias("metadata"),
        F.struct(
            F.lit("5733").alias("project"),
            F.col("l_suppkey").cast("string").alias("user"),
            F.col("n_regionkey").cast("string").alias("workflow"),
            F.struct(
                F.col("l_partkey").cast("string").alias("id"),
                F.array(
                    F.create_map(
                        F.lit("image/png"),
                        F.concat(F.lit("https://img.example/"), F.col("l_partkey").cast("string"), F.lit(".png")),
                    )
                ).alias("locations"),
                F.create_map(
                    F.lit("!iauname"),
                    F.concat(F.lit("J"), F.col("l_partkey").cast("string")),
                    F.lit("#uploader"),
                    F.lit("team"),
                    F.lit("#upload_date"),
                    F.lit("2018-01-01"),
                    F.lit("#retirement_limit"),
                    F.lit("40"),
                ).alias("metadata"),
            ).alias("subject"),
        ).alias("links"),
    )


def version_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version records of the raw lines, one per nation."""
    nation = table(spark, sf_dir, "nation")
    labels = {
        "T0.question": "Which flag?",
        "T1.question": "Which status?",
        "T10.question": "Do you see any of these rare features?",
        "T1.answers.0.label": "F",
        "T1.answers.1.label": "O",
        "T10.answers.3.label": "Lens or Arc",
    }
    pairs = [F.lit(x) for pair in labels.items() for x in pair]
    for index, letter in enumerate("ANR"):
        pairs += [F.lit(f"T0.answers.{index}.label"), tagged(F.lit(letter))]
        pairs += [F.lit(f"T10.answers.{index}.label"), F.concat(F.lit(f"{letter} in "), F.col("n_name"))]
    return nation.select(
        F.col("n_nationkey").cast("string").alias("major_number"),
        F.lit("0").alias("minor_number"),
        F.struct(F.col("n_regionkey").cast("string").alias("workflow")).alias("links"),
        F.create_map(*pairs).alias("strings"),
    )


def sky_positions(spark: SparkSession, sf_dir: str, name: str, key: str, offset: float = 0.0) -> DataFrame:
    """Table rows scattered over the sky by their key."""
    place = F.col(key)
    return table(spark, sf_dir, name).select(
        place.alias("id"),
        F.pmod(place * F.lit(137.508) + F.lit(offset), F.lit(360.0)).alias("ra"),
        (F.pmod(place * F.lit(61.803) + F.lit(offset), F.lit(120.0)) - F.lit(60.0)).alias("dec"),
    )


def sky_sql(name: str, key: str, offset: float = 0.0) -> str:
    ra, dec = f"fmod({key} * 137.508e0 + {offset}e0, 360e0)", f"fmod({key} * 61.803e0 + {offset}e0, 120e0) - 60e0"
    return f"SELECT {key} AS id, {ra} AS ra, {dec} AS dec FROM {name}"


def coded_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide coded export: one column per question, coded answer or null."""
    codes = {"T0": {"A": "a-0", "N": "a-1", "R": "a-2"}, "T1": {"F": "a-0", "O": "a-1"}}

    def coded(task: str, letter: str) -> Column:
        pairs = [F.lit(x) for pair in codes[task].items() for x in pair]
        return F.try_element_at(F.create_map(*pairs), F.col(letter))

    return table(spark, sf_dir, "lineitem").select(
        classification().alias("classification_id"),
        F.col("l_partkey").alias("subject_id"),
        # one line number stands for a trial workflow with an answer of its own
        F.when(F.col("l_quantity") == 1, F.lit("a-9")).otherwise(coded("T0", "l_returnflag")).alias("T0"),
        F.when(F.col("l_linenumber") % 3 != 0, coded("T1", "l_linestatus")).alias("T1"),
    )


CODED = QuestionSet.build(
    ("T0", "return-flag", {"a-0": "accepted", "a-1": "none", "a-2": "returned"}),
    ("T1", "line-status", {"a-0": "final", "a-1": "open"}),
)
CODED_SQL = f"""
coded AS (
  SELECT {CLASSIFICATION_SQL} AS classification_id, l_partkey AS subject_id,
         CASE WHEN l_quantity = 1 THEN 'a-9' WHEN l_returnflag = 'A' THEN 'a-0' WHEN l_returnflag = 'N' THEN 'a-1'
              WHEN l_returnflag = 'R' THEN 'a-2' END AS T0,
         CASE WHEN l_linenumber % 3 <> 0 THEN CASE l_linestatus WHEN 'F' THEN 'a-0' WHEN 'O' THEN 'a-1' END END AS T1
  FROM lineitem
)"""
