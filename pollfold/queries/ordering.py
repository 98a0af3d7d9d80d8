"""Sorts and top-k. Sorted results are compared as sets, so ranks are written out where the order matters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pollfold.operators import aggregates as agg
from pollfold.operators import ranking
from pollfold.queries.registry import query
from pollfold.queries.tables import table, text_time


@query("sort_by_count", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type ORDER BY n DESC, event_type")
def sort_by_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.by_count(agg.frequency(table(spark, sf_dir, "events"), "event_type"), "event_type")


@query(
    "most_active_volunteers",
    "SELECT user_id, count(*) AS n FROM events GROUP BY user_id ORDER BY n DESC, user_id LIMIT 40",
)
def most_active_volunteers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.most_active(agg.frequency(table(spark, sf_dir, "events"), "user_id"), "user_id", 40)


@query("sort_by_time", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events ORDER BY ts, event_id")
def sort_by_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = ranking.by_time(table(spark, sf_dir, "events"), "ts", "event_id")
    return ordered.select("event_id", text_time(F.col("ts")).alias("ts"))


@query(
    "rank_by_fraction",
    """SELECT l_partkey, count(*) AS votes, round(avg(CAST(l_returnflag = 'A' AS INT)), 6) AS fraction FROM lineitem
    GROUP BY l_partkey HAVING count(*) > 20 ORDER BY fraction DESC, l_partkey""",
)
def rank_by_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted = F.round(F.avg((F.col("l_returnflag") == "A").cast("double")), 6)
    parts = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("votes"), accepted.alias("fraction"))
    return ranking.by_fraction(parts, "fraction", "votes", 20, ["l_partkey"])


@query("row_of_maximum", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1")
def row_of_maximum(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return ranking.row_of_maximum(orders, "o_totalprice", ["o_orderkey"])


@query(
    "first_and_last_row",
    """(SELECT 'first' AS "end", event_id, event_type FROM events ORDER BY ts, event_id LIMIT 1)
    UNION ALL (SELECT 'last', event_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 1)""",
)
def first_and_last_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    return ranking.first_and_last(events, ["ts", "event_id"]).drop("ts")


@query("row_cap", "SELECT least(count(*), 100) AS n FROM orders")
def row_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.capped(table(spark, sf_dir, "orders"), 100).agg(F.count(F.lit(1)).alias("n"))
