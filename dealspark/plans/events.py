"""Queries on time: weekly windows, gaps, sessions, streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dealspark.catalogue import query
from dealspark.functions import dates
from dealspark.session import table
from dealspark.streaming import windows

START = "time_bucket(INTERVAL 7 DAYS, ts, TIMESTAMP '2023-12-29 05:00:00')"


@query("window_assign_weekly", f"SELECT {START} AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def window_assign_weekly(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy(dates.window_start(F.col("ts")).alias("start"), "event_type").agg(F.count("*").alias("n"))


@query("window_closed_filter", "SELECT o_orderkey, event_id FROM orders LEFT JOIN events ON o_orderkey = event_id WHERE ts IS NULL OR ts BETWEEN TIMESTAMP '2024-01-05 05:00:00' AND TIMESTAMP '2024-01-12 05:00:00'")
def window_closed_filter(spark: SparkSession, d: str) -> DataFrame:
    both = table(spark, d, "orders").join(table(spark, d, "events"), F.col("o_orderkey") == F.col("event_id"), "left")
    at = lambda x: F.lit(x).cast("timestamp_ntz")
    return both.where(dates.in_window(F.col("ts"), at("2024-01-05 05:00:00"), at("2024-01-12 05:00:00"))).select("o_orderkey", "event_id")


@query(
    "window_gap_recovery",
    f"SELECT CAST(g AS TIMESTAMP) + INTERVAL 5 HOURS AS start FROM generate_series(DATE '2023-12-22', DATE '2024-02-02', INTERVAL 7 DAYS) AS t(g) WHERE CAST(g AS TIMESTAMP) + INTERVAL 5 HOURS NOT IN (SELECT {START} FROM events GROUP BY 1 HAVING count(*) >= 2000)",
)
def window_gap_recovery(spark: SparkSession, d: str) -> DataFrame:
    complete = table(spark, d, "events").groupBy(dates.window_start(F.col("ts")).alias("start")).agg(F.count("*").alias("n")).where("n >= 2000")
    return dates.expected_windows(spark, "2023-12-22", "2024-02-09").join(complete, "start", "left_anti").select("start")


@query("latest_cutoff", "SELECT o_orderkey, time_bucket(INTERVAL 7 DAYS, o_orderdate, TIMESTAMP '2023-12-29 05:00:00') AS cutoff FROM orders")
def latest_cutoff(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", dates.window_start(F.col("o_orderdate")).alias("cutoff"))


@query("heading_groups", "SELECT user_id, CAST(grp AS BIGINT) AS grp, count(*) AS n, min(event_id) AS first_event FROM (SELECT *, sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS grp FROM events) GROUP BY 1, 2")
def heading_groups(spark: SparkSession, d: str) -> DataFrame:
    marks = F.sum((F.col("event_type") == "signup").cast("int")).over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return table(spark, d, "events").withColumn("grp", marks).groupBy("user_id", "grp").agg(F.count("*").alias("n"), F.min("event_id").alias("first_event"))


@query("json_extract", "SELECT event_type, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS total, count(*) AS n FROM events GROUP BY 1")
def json_extract(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("event_type").agg(F.sum(F.get_json_object("props", "$.k").cast("long")).alias("total"), F.count("*").alias("n"))


@query("stream_window_counts", f"SELECT {START} AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_window_counts(spark: SparkSession, d: str) -> DataFrame:
    return windows.counted_once(spark, f"{d}/events.parquet")


@query("stream_closed_windows", f"SELECT start, event_type, n FROM (SELECT {START} AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2) WHERE start + INTERVAL 7 DAYS <= (SELECT max(ts) FROM events) - INTERVAL 10 DAYS")
def stream_closed_windows(spark: SparkSession, d: str) -> DataFrame:
    """Weekly counts as an append-only stream gives them: each window once, when no more rows can come."""
    return windows.Weeks(spark, f"{d}/events.parquet").run().closed()
