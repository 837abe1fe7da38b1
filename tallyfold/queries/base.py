"""Registry of queries with their DuckDB oracles, and the inputs that several of them share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ts(text: str):
    return F.lit(text).cast("timestamp_ntz")


def day(c: str):
    return F.date_format(c, "yyyy-MM-dd").alias(c)


def instant(c: str, name: str | None = None):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name or c)


def sql_instant(c: str, name: str | None = None) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f') AS {name or c}"


def source_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_orderdate").cast("timestamp_ntz").alias("changed"))


def target_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A perturbed copy of the orders: some missing, older, newer, and keys of its own."""
    o = source_orders(spark, sf_dir)
    one = F.expr("INTERVAL 1 DAY")
    moved = F.when(F.col("key") % 7 == 0, F.col("changed") - one).when(F.col("key") % 11 == 0, F.col("changed") + one).otherwise(F.col("changed"))
    own = o.where("key % 19 = 0").select((-F.col("key") - 1).alias("key"), "changed")
    return o.where("key % 13 <> 0").select("key", moved.alias("changed")).union(own)


SRC = "src AS (SELECT o_orderkey AS key, o_orderdate AS changed FROM orders)"
TGT = """tgt AS (SELECT o_orderkey AS key, CASE WHEN o_orderkey % 7 = 0 THEN o_orderdate - INTERVAL 1 DAY
  WHEN o_orderkey % 11 = 0 THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS changed FROM orders WHERE o_orderkey % 13 <> 0
  UNION ALL SELECT -o_orderkey - 1, o_orderdate FROM orders WHERE o_orderkey % 19 = 0)"""
ACTION = """CASE WHEN s.key IS NULL THEN 'remove' WHEN t.key IS NULL THEN 'insert' WHEN t.changed < s.changed THEN 'update'
  WHEN t.changed > s.changed THEN 'ahead' ELSE 'equal' END"""


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as versions of their customers: valid from an order to the customer's next one."""
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("version_id"), F.col("o_custkey").alias("entity_id"), F.col("o_orderdate").cast("timestamp_ntz").alias("valid_from"), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderdate").cast("timestamp_ntz") + F.expr("INTERVAL 400 DAY")).alias("valid_to"), F.when(F.col("o_orderkey") % 17 != 0, F.col("o_orderstatus")).alias("status"), F.col("o_totalprice").cast("decimal(20,2)").alias("amount"))


HIST = """hist AS (SELECT o_orderkey AS version_id, o_custkey AS entity_id, o_orderdate AS valid_from,
  CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate + INTERVAL 400 DAY END AS valid_to,
  CASE WHEN o_orderkey % 17 <> 0 THEN o_orderstatus END AS status, o_totalprice::DECIMAL(20,2) AS amount FROM orders)"""
