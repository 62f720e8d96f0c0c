"""The driver's tables seen as the library's inputs, in Spark and as SQL text for the check.

Transactions are order lines: customers' nations stand for countries, parts for streams.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HOME = "NATION_0"
LABELS = ("nation_23", "nation_24")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Lines that meet their orders in one task, on average: what a task holds does not grow with the tables.
LINES_PER_TASK = 1_000_000


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with order, customer and nation; the optimizer broadcasts what is small enough."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    buyers = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select("c_custkey", "n_name")
    placed = orders.join(buyers, orders.o_custkey == buyers.c_custkey)
    n_tasks = max(spark.sparkContext.defaultParallelism, lines.count() // LINES_PER_TASK + 1)
    return lines.repartition(n_tasks, "l_orderkey").join(placed.repartition(n_tasks, "o_orderkey"), lines.l_orderkey == placed.o_orderkey)


def _invoice():
    letter = F.when(F.col("o_orderkey") % 211 == 0, "A").when(F.col("o_orderkey") % 13 == 0, "C").otherwise("")
    return F.concat(letter, F.col("o_orderkey").cast("string"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean-shaped transactions, bad-debt invoices included."""
    key = F.col("o_orderkey")
    return _joined(spark, sf_dir).select(
        F.to_date("o_orderdate").alias("date"),
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), F.dayofmonth("o_orderdate").alias("day"),
        F.col("n_name").alias("country"),
        F.when(key % 5 != 0, F.col("o_custkey")).alias("customer_id"),
        _invoice().alias("invoice"),
        F.when(key % 211 == 0, "A").when(key % 13 == 0, "C").otherwise("").alias("invoice_prefix"),
        key.cast("string").alias("invoice_clean"),
        F.col("l_partkey").cast("string").alias("stream_id"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").cast("bigint").alias("times_viewed"),
        F.concat(F.lit("invoices-"), F.date_format("o_orderdate", "yyyy-MM"), F.lit(".json")).alias("source_file"),
    )


TXN_SQL = """
txn AS (
  SELECT CAST(o_orderdate AS DATE) AS date, n_name AS country,
         CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey END AS customer_id,
         (CASE WHEN o_orderkey % 211 = 0 THEN 'A' WHEN o_orderkey % 13 = 0 THEN 'C' ELSE '' END)
           || CAST(o_orderkey AS VARCHAR) AS invoice,
         CASE WHEN o_orderkey % 211 = 0 THEN 'A' WHEN o_orderkey % 13 = 0 THEN 'C' ELSE '' END AS invoice_prefix,
         CAST(o_orderkey AS VARCHAR) AS invoice_clean,
         CAST(l_partkey AS VARCHAR) AS stream_id,
         l_extendedprice AS price,
         CAST(l_quantity AS BIGINT) AS times_viewed,
         'invoices-' || strftime(o_orderdate, '%Y-%m') || '.json' AS source_file
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
)"""


def dirty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines as raw text with faults mixed in, one order in 50 twice."""
    return soiled(_joined(spark, sf_dir))


def dealt_dirty_lines(spark: SparkSession, sf_dir: str, file_no: Column) -> DataFrame:
    """``dirty_lines`` with their ``file_no``, those of a file in one task: lines move as days and numbers and become text there."""
    dealt = _joined(spark, sf_dir).select(
        file_no.alias("file_no"), "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("o_orderdate"), "n_name", "l_partkey",
        F.col("l_extendedprice").cast("decimal(18,2)").alias("l_extendedprice"), F.col("l_quantity").cast("bigint").alias("l_quantity"),
    )
    return soiled(dealt.repartition("file_no"), "file_no")


def soiled(joined: DataFrame, *kept: str) -> DataFrame:
    """Joined lines as raw text with faults; the columns ``kept`` stay as they are."""
    key = F.col("o_orderkey")
    part = F.col("l_partkey")
    month_file = F.concat(F.lit("invoices-"), F.date_format("o_orderdate", "yyyy-MM"), F.lit(".json"))
    return joined.select(
        *kept,
        F.when(key % 103 == 0, F.lit(" nan ")).when(key % 107 == 0, F.lit("  "))
        .otherwise(F.concat(F.lit("  "), F.col("n_name"), F.lit(" "))).alias("country"),
        F.when(key % 5 == 0, F.lit(None).cast("string")).when(key % 17 == 0, F.lit("12.5")).when(key % 19 == 0, F.lit("guest"))
        .otherwise(F.concat(F.col("o_custkey").cast("string"), F.lit(".0"))).alias("customer_id"),
        F.when(key % 109 != 0, F.concat(F.lit(" "), _invoice())).alias("invoice"),
        F.concat(part.cast("string"), F.lit(" ")).alias("stream_id"),
        F.when(key % 97 == 0, F.lit("N/A")).when(key % 113 == 0, F.lit("5d")).when(key % 127 == 0, F.lit("inf"))
        .otherwise(F.col("l_extendedprice").cast("decimal(18,2)").cast("string")).alias("price"),
        F.when(part % 31 == 0, F.lit("x")).when(part % 29 == 0, F.lit("2.9"))
        .otherwise(F.col("l_quantity").cast("bigint").cast("string")).alias("times_viewed"),
        F.year("o_orderdate").cast("string").alias("year"),
        F.when(key % 101 == 0, F.lit("13")).otherwise(F.date_format("o_orderdate", "MM")).alias("month"),
        F.date_format("o_orderdate", "dd").alias("day"),
        F.explode(F.when(key % 50 == 0, F.array(month_file, F.lit("invoices-again.json"))).otherwise(F.array(month_file))).alias("source_file"),
    )


DIRTY_SQL = """
dirty_once AS (
  SELECT o_orderkey AS order_no,
         CASE WHEN o_orderkey % 103 = 0 THEN ' nan ' WHEN o_orderkey % 107 = 0 THEN '  '
              ELSE '  ' || n_name || ' ' END AS country,
         CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 17 = 0 THEN '12.5'
              WHEN o_orderkey % 19 = 0 THEN 'guest' ELSE CAST(o_custkey AS VARCHAR) || '.0' END AS customer_id,
         CASE WHEN o_orderkey % 109 <> 0 THEN ' ' ||
              (CASE WHEN o_orderkey % 211 = 0 THEN 'A' WHEN o_orderkey % 13 = 0 THEN 'C' ELSE '' END)
              || CAST(o_orderkey AS VARCHAR) END AS invoice,
         CAST(l_partkey AS VARCHAR) || ' ' AS stream_id,
         CASE WHEN o_orderkey % 97 = 0 THEN 'N/A' WHEN o_orderkey % 113 = 0 THEN '5d'
              WHEN o_orderkey % 127 = 0 THEN 'inf'
              ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS price,
         CASE WHEN l_partkey % 31 = 0 THEN 'x' WHEN l_partkey % 29 = 0 THEN '2.9'
              ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS times_viewed,
         strftime(o_orderdate, '%Y') AS year,
         CASE WHEN o_orderkey % 101 = 0 THEN '13' ELSE strftime(o_orderdate, '%m') END AS month,
         strftime(o_orderdate, '%d') AS day,
         'invoices-' || strftime(o_orderdate, '%Y-%m') || '.json' AS source_file
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
),
dirty AS (
  SELECT * FROM dirty_once
  UNION ALL
  SELECT * REPLACE ('invoices-again.json' AS source_file) FROM dirty_once WHERE order_no % 50 = 0
)"""
