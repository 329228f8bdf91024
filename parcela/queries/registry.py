"""Where queries are entered, and the stand-in for the table of reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None) -> Callable:
    """Enters a function under its own name, with the SQL that checks it."""

    def enter(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return enter


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(spark: SparkSession, sf_dir: str, name: str, key: str, *columns: str) -> DataFrame:
    """A table dealt to all tasks by its key, for queries that make much of each row.

    A scan is cut by its bytes, so narrow rows are few tasks' or one's, whatever each of them costs. Later steps by the key find its rows together.
    """
    return table(spark, sf_dir, name).select(key, *columns).repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), key)


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of known customers as reports in their work queue."""
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    status = F.when(F.col("o_orderstatus") == "P", "pending").when(F.col("o_orderstatus") == "F", "failed").otherwise("extracted")
    synced = F.col("o_orderstatus") != "P"
    return orders.join(customers.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("eval_id"),
        F.col("c_nationkey").alias("comuna_id"),
        (F.col("o_orderkey") % 2 + 1).alias("tipo"),
        status.alias("pdf_status"),
        (F.col("o_orderkey") % 5).alias("retry_count"),
        F.when(synced, F.col("o_orderdate").cast("date")).alias("synced_at"),
        synced.alias("is_synced"),
        F.col("o_orderdate").cast("date").alias("last_seen_at"),
        F.date_add(F.col("o_orderdate").cast("date"), (F.col("o_orderkey") % 3 - 1).cast("int")).alias("processed_at"),
        F.when(status == "failed", F.concat(F.lit("error "), F.col("o_orderpriority"))).alias("last_error"),
        F.round("o_totalprice", 2).alias("price"),
    )


#: The same stand-in as a common table of the checking SQL.
EV = """ev as (select o_orderkey as eval_id, c_nationkey as comuna_id, o_orderkey % 2 + 1 as tipo,
  case o_orderstatus when 'P' then 'pending' when 'F' then 'failed' else 'extracted' end as pdf_status,
  o_orderkey % 5 as retry_count, case when o_orderstatus <> 'P' then o_orderdate::date end as synced_at,
  o_orderstatus <> 'P' as is_synced, o_orderdate::date as last_seen_at,
  o_orderdate::date + (o_orderkey % 3 - 1)::int as processed_at,
  case when o_orderstatus = 'F' then 'error ' || o_orderpriority end as last_error, round(o_totalprice, 2) as price
  from orders join customer on o_custkey = c_custkey)"""
