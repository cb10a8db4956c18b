"""Queries on runs: resumed work, published windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealspark.catalogue import query
from dealspark.functions import dates
from dealspark.operators import ledger, publish
from dealspark.session import table

START = "time_bucket(INTERVAL 7 DAYS, ts, TIMESTAMP '2023-12-29 05:00:00')"
_LEDGER = "key long, status string, price double"


@query("resumed_orders", "SELECT o_orderkey AS key, o_totalprice AS price, CASE WHEN o_totalprice > 100000 THEN 1 ELSE 2 END AS run FROM orders")
def resumed_orders(spark: SparkSession, d: str) -> DataFrame:
    """Orders through a ledger: the first run accepts the large ones, the second one does only what is open."""
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("price"))
    book = ledger.Ledger(spark, ledger.scratch_path(spark, "ledgers"), _LEDGER)
    book.run(orders, lambda batch: batch.withColumn("status", F.when(F.col("price") > 100000, ledger.ACCEPTED).otherwise(ledger.FAILED)))
    return book.run(orders, lambda batch: batch.withColumn("status", F.lit(ledger.ACCEPTED))).select("key", "price", "run")


@query(
    "restored_orders",
    "SELECT o_orderkey AS key, 'reports/' || o_orderkey || '.docx' AS output FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 0",
)
def restored_orders(spark: SparkSession, d: str) -> DataFrame:
    """Finished orders as earlier outputs, taken back all or none."""
    done = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("key"), F.format_string("reports/%d.docx", "o_orderkey").alias("output"), "o_totalprice")
    gates = [("without a price", F.col("o_totalprice") > 0), ("not a report", F.endswith("output", F.lit(".docx")))]
    return ledger.restored(done, F.col("key"), F.col("output"), gates, requested=1 << 62, scope="reports").select("key", "output")


@query("published_weeks", f"SELECT CAST({START} AS VARCHAR) AS week, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def published_weeks(spark: SparkSession, d: str) -> DataFrame:
    """Weekly counts, published as a whole: the first try fails its condition and changes nothing."""
    counts = table(spark, d, "events").groupBy(dates.window_start(F.col("ts")).cast("string").alias("week"), "event_type").agg(F.count("*").alias("n"))
    weeks = publish.WindowTable(spark, ledger.scratch_path(spark, "published"), "week")
    metrics = {"events": F.sum("n"), "least": F.min("n")}
    weeks.publish("first", counts, metrics, {"no empty group": lambda m: m["least"] > 0}, unique=["event_type"])
    try:
        weeks.publish("doubled", counts.withColumn("n", F.col("n") * 2), metrics, {"as many events as before": lambda m: m["events"] == weeks_total(weeks)})
    except publish.PublishError:
        pass
    return weeks.read()


def weeks_total(weeks: publish.WindowTable) -> int:
    return weeks.read().agg(F.sum("n")).first()[0]
