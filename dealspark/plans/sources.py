"""Queries on sources: records of many shapes, fallback for each keyword."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealspark.catalogue import query
from dealspark.operators import fallback
from dealspark.operators.shapes import Field, Shapes, split_records
from dealspark.session import table

CASES = Shapes(
    [
        Field("name", aliases=("case_name", "案例名称"), required=True),
        Field("value", "double", ("deal_value", "交易金额")),
        Field("day", "date", ("published_at", "日期")),
        Field("active", "boolean", ("is_completed",), default=True),
    ]
)


def manifests(spark: SparkSession, d: str) -> DataFrame:
    """Three shapes of JSON out of the tables: arrays of an order's items, objects with a list of rows, single records."""
    day = F.to_date("l_shipdate").cast("string")
    item = F.create_map(F.lit("案例名称"), F.format_string("order %d", "l_orderkey"), F.lit("交易金额"), F.col("l_linenumber").cast("string"), F.lit("日期"), F.when(F.col("l_linenumber") % 2 == 0, F.translate(day, "-", "/")).otherwise(day))
    arrays = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.to_json(F.array_sort(F.collect_list(F.to_json(item)))).alias("quoted"))  # at most seven items an order
    arrays = arrays.select(F.format_string("orders/%d", "l_orderkey").alias("source"), F.concat(F.lit("["), F.array_join(F.from_json("quoted", "array<string>"), ","), F.lit("]")).alias("json"))
    row = F.to_json(F.create_map(F.lit(" Case_Name "), F.col("c_name"), F.lit("deal_value"), F.when(F.col("c_nationkey") == 3, F.lit("not told")).otherwise(F.col("c_custkey").cast("string")), F.lit("is_completed"), F.when(F.col("c_nationkey") < 5, "否").otherwise("")))
    lists = table(spark, d, "customer").select(F.format_string("customers/%d", "c_custkey").alias("source"), F.concat(F.lit('{"rows": ['), row, F.lit("]}")).alias("json"))
    single = F.to_json(F.create_map(F.lit("name"), F.when(F.col("s_suppkey") % 10 == 0, " ").otherwise(F.col("s_name")), F.lit("value"), F.format_string("%d,000", "s_suppkey"), F.lit("other"), F.lit("x")))
    records = table(spark, d, "supplier").select(F.format_string("suppliers/%d", "s_suppkey").alias("source"), F.when(F.col("s_suppkey") % 7 == 0, F.substring(single, 1, 9)).otherwise(single).alias("json"))
    return reduce(DataFrame.unionByName, (arrays, lists, records))


@query(
    "manifest_records",
    """SELECT 'orders/' || l_orderkey AS source, 'order ' || l_orderkey AS name, CAST(l_linenumber AS DOUBLE) AS value, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day, true AS active, '' AS reasons FROM lineitem
    UNION ALL SELECT 'customers/' || c_custkey, c_name, CASE WHEN c_nationkey <> 3 THEN CAST(c_custkey AS DOUBLE) END, NULL, c_nationkey >= 5, CASE WHEN c_nationkey = 3 THEN 'bad value' ELSE '' END FROM customer
    UNION ALL SELECT 'suppliers/' || s_suppkey, CASE WHEN s_suppkey % 7 <> 0 AND s_suppkey % 10 <> 0 THEN s_name END, CASE WHEN s_suppkey % 7 <> 0 THEN CAST(s_suppkey AS DOUBLE) * 1000 END, NULL, true, CASE WHEN s_suppkey % 7 = 0 THEN 'no object' WHEN s_suppkey % 10 = 0 THEN 'missing name' ELSE '' END FROM supplier""",
)
def manifest_records(spark: SparkSession, d: str) -> DataFrame:
    """Every record of three shapes in one schema, good or in quarantine."""
    found = CASES.typed(split_records(manifests(spark, d), "source", "json"))
    return found.select("source", "name", "value", F.col("day").cast("string").alias("day"), "active", F.array_join("reasons", ", ").alias("reasons"))


@query("manifest_columns", "SELECT 'customers/' || c_custkey AS source, 'day' AS field FROM customer UNION ALL SELECT 'suppliers/' || s_suppkey, unnest(CASE WHEN s_suppkey % 7 = 0 THEN ['name', 'value', 'day', 'active'] ELSE ['day', 'active'] END) FROM supplier UNION ALL SELECT DISTINCT 'orders/' || l_orderkey, 'active' FROM lineitem")
def manifest_columns(spark: SparkSession, d: str) -> DataFrame:
    """The columns that each source lacks."""
    return CASES.missing_columns(split_records(manifests(spark, d), "source", "json"))


_OFFERED = """WITH sources AS (SELECT DISTINCT o_orderpriority AS source, CAST(substr(o_orderpriority, 1, 1) AS INT) AS rank FROM orders),
live AS (SELECT * FROM sources WHERE rank NOT IN (2, 4)),
items AS (SELECT o_orderkey AS id, o_custkey AS key, source, rank, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS address FROM orders JOIN live ON source = o_orderpriority)"""


def _offered(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Orders as items of five sources, of which the second has failed; the fourth belongs to its family."""
    orders = table(spark, d, "orders")
    items = orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("key"), F.col("o_orderpriority").alias("source"), F.to_date("o_orderdate").cast("string").alias("address"))
    rank = F.substring("source", 1, 1).cast("int")
    sources = items.select("source").distinct().select("source", rank.alias("rank"), (rank % 2).alias("family"), (rank == 2).alias("failed"))
    return items, sources


@query("keyword_fallback", _OFFERED + " SELECT id, key, source FROM items JOIN (SELECT key, min(rank) AS rank FROM items GROUP BY key) USING (key, rank)")
def keyword_fallback(spark: SparkSession, d: str) -> DataFrame:
    """Each customer's orders from the first source that has any."""
    return fallback.first_source_by_key(*_offered(spark, d)).select("id", "key", "source")


@query("keyword_extend", _OFFERED + " SELECT id, key, source FROM (SELECT *, row_number() OVER (PARTITION BY key, address ORDER BY rank, id) AS k FROM items) WHERE k = 1")
def keyword_extend(spark: SparkSession, d: str) -> DataFrame:
    """Each customer's order days once, from the first source that has them."""
    return fallback.extended_by_key(*_offered(spark, d), F.col("id")).select("id", "key", "source")


@query("source_status", "SELECT o_orderpriority AS source, CASE substr(o_orderpriority, 1, 1) WHEN '2' THEN 'failed' WHEN '4' THEN 'skipped' ELSE 'live' END AS status FROM (SELECT DISTINCT o_orderpriority FROM orders)")
def source_status(spark: SparkSession, d: str) -> DataFrame:
    """Which sources failed, which were skipped for it."""
    return fallback.source_status(_offered(spark, d)[1]).select("source", "status")
