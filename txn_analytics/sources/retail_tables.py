"""The model's tables as views of the retail test tables (orders and their lines, events, customers).

Lookups are left joins on unique keys, so a lookup whose columns are not asked for can be left out
without changing a row. Spark knows the sizes of these scans and picks each join by them.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txn_analytics import model

ALL = tuple(model.TRANSACTIONS.fieldNames())
AS_OF = "2001-12-31"
EVENTS_AS_OF = "2024-01-31"


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def branches(spark: SparkSession, folder: str) -> DataFrame:
    regions = _read(spark, folder, "region").select(
        F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region"))
    return (
        _read(spark, folder, "nation").join(regions, "n_regionkey", "left")
        .select(F.col("n_name").alias("branch"), "region")
    )


def _with_holder(df: DataFrame, spark: SparkSession, folder: str, columns: Sequence[str]) -> DataFrame:
    """Adds segment and branch of the customer in ``holder``.

    Customers join first and the nations after them: Spark knows the size of a plain scan, and so
    broadcasts the customers while they are few and shuffles them when they are not.
    """
    wanted = [name for name in ("segment", "branch") if name in columns]
    if not wanted:
        return df
    holders = _read(spark, folder, "customer").select(
        F.col("c_custkey").alias("holder"), F.col("c_mktsegment").alias("segment"), "c_nationkey")
    return _with_branch(df.join(holders, "holder", "left"), spark, folder, wanted).select(*df.columns, *wanted)


def _with_branch(df: DataFrame, spark: SparkSession, folder: str, columns: Sequence[str]) -> DataFrame:
    if "branch" not in columns:
        return df
    nations = _read(spark, folder, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("branch"))
    return df.join(nations, "c_nationkey", "left")


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customer dimension. The source has no joining date, so one is derived from the key."""
    joined = F.date_add(F.lit("1994-01-01").cast("date"), (F.col("c_custkey") * 37 % 2000).cast("int"))
    return _with_branch(_read(spark, folder, "customer"), spark, folder, ("branch",)).select(
        F.col("c_custkey").cast("string").alias("customer_id"), F.col("c_mktsegment").alias("segment"), "branch",
        joined.alias("join_date"))


def _orders(spark: SparkSession, folder: str, columns: Sequence[str], include_failed: bool) -> DataFrame:
    orders = _read(spark, folder, "orders")
    if not include_failed:
        orders = orders.filter(F.col("o_orderstatus") != "F")
    status = (
        F.when(F.col("o_orderstatus") == "O", model.COMPLETED)
        .when(F.col("o_orderstatus") == "P", model.PENDING)
        .when(F.col("o_orderstatus") == "F", model.FAILED)
    )
    # Customers meet the orders before the lines do: there are fewer orders to shuffle.
    return _with_holder(
        orders.select(
            F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("holder"), status.alias("status")),
        spark, folder, columns)


def transactions(spark: SparkSession, folder: str, columns: Sequence[str] = ALL,
                 include_failed: bool = True) -> DataFrame:
    """Order lines as transactions, with the named columns.

    Leaving failed rows out here tests the stored status, which reaches the Parquet scan.
    """
    lines = _read(spark, folder, "lineitem")
    if not include_failed or {"customer_id", "status", "segment", "branch"} & set(columns):
        orders = _orders(spark, folder, columns, include_failed)
        lines = lines.join(orders, "l_orderkey", "left" if include_failed else "inner")
    if "product" in columns:
        parts = _read(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("product"))
        lines = lines.join(parts, "l_partkey", "left")
    values = {
        "transaction_id": F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
        "date": F.col("l_shipdate").cast("date"),
        "customer_id": F.col("holder").cast("string"),
        "transaction_type": F.col("l_returnflag"),
        "category": F.col("l_linestatus"),
        "amount": F.col("l_extendedprice").cast("decimal(15,2)"),
    }
    return lines.select(*[values.get(name, F.col(name)).alias(name) for name in columns])


def event_transactions(spark: SparkSession, folder: str, columns: Sequence[str] = ALL) -> DataFrame:
    """Events as transactions: a long-tailed amount, so this view has outliers. Errors failed, signups are pending."""
    status = (
        F.when(F.col("event_type") == "error", model.FAILED)
        .when(F.col("event_type") == "signup", model.PENDING)
        .otherwise(model.COMPLETED)
    )
    events = _with_holder(_read(spark, folder, "events").withColumn("holder", F.col("user_id")), spark, folder, columns)
    values = {
        "transaction_id": F.col("event_id").cast("string"),
        "date": F.col("ts").cast("date"),
        "customer_id": F.col("holder").cast("string"),
        "product": F.col("event_type"),
        "transaction_type": F.col("event_type"),
        "category": F.col("event_type"),
        "amount": F.col("value").cast("decimal(15,2)"),
        "status": status,
    }
    return events.select(*[values.get(name, F.col(name)).alias(name) for name in columns])
