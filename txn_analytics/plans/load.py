"""Loading: CSV files to checked tables, with keys reported or with keys that hold; months put in place of their own."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txn_analytics import model
from txn_analytics.operators import dimensions, keys, quality
from txn_analytics.sources.files import publish, read_csv, read_table, replace_months, staging_path, tidy_text, write_table

#: The folder of each verdict on a transaction.
TABLES = {keys.KEPT: "fact_transactions", keys.DUPLICATE: "duplicate_transactions", keys.ORPHAN: "orphan_transactions"}


def write_checked(rows: DataFrame, customers: DataFrame, folder: str) -> dict[str, DataFrame]:
    """Writes transactions to three tables: the fact, repeated keys and unknown customers. Returns them by verdict.

    Every row goes to one of them, in one write; then the three folders are put in place. The fact comes last, so that
    a failure before leaves the old one.
    """
    spark = rows.sparkSession
    judged = keys.with_verdicts(rows, "transaction_id", {"customer_id": customers.select("customer_id")})
    judged = judged.withColumn("load_month", F.year("date") * 100 + F.month("date"))
    staged = staging_path(f"{folder}/transactions")
    judged.hint("rebalance", keys.VERDICT, "load_month").write.partitionBy(keys.VERDICT, "load_month").parquet(staged)
    written = {row[0] for row in spark.read.schema(judged.schema).parquet(staged).select(keys.VERDICT).distinct().collect()}
    for verdict, name in reversed(TABLES.items()):
        part = f"{staged}/{keys.VERDICT}={verdict}"
        if verdict not in written:      # an empty table
            part = staging_path(f"{folder}/{name}")
            spark.createDataFrame([], judged.drop(keys.VERDICT).schema).write.parquet(part)
        publish(spark, part, f"{folder}/{name}")
    return {verdict: read_table(spark, f"{folder}/{name}") for verdict, name in TABLES.items()}


def load_months(rows: DataFrame, customers: DataFrame, folder: str) -> DataFrame:
    """Replaces in the fact the months that the rows have, and returns the rows that were not taken, with verdicts.

    Keys must hold in the whole fact: one that another month has is a duplicate. Loading the same rows again gives the
    same fact.
    """
    spark = rows.sparkSession
    path = f"{folder}/{TABLES[keys.KEPT]}"
    months = [row.m for row in rows.select((F.year("date") * 100 + F.month("date")).alias("m")).distinct().collect()]
    fact = read_table(spark, path)
    others = fact.filter(~F.coalesce(F.col("load_month").isin([m for m in months if m is not None]), F.lit(None in months)))
    judged = keys.with_verdicts(rows, "transaction_id", {"customer_id": customers.select("customer_id")}, others)
    staged = staging_path(f"{folder}/transactions")
    judged.write.partitionBy(keys.VERDICT).parquet(staged)
    judged = spark.read.schema(judged.schema).parquet(staged)
    replace_months(judged.filter(F.col(keys.VERDICT) == keys.KEPT).select(*[c for c in fact.columns if c != "load_month"]), path)
    return judged.filter(F.col(keys.VERDICT) != keys.KEPT)


def load(spark: SparkSession, transactions_csv: str, customers_csv: str, folder: str,
         load_date=None) -> dict[str, DataFrame]:
    """Replaces the fact and customer tables under ``folder`` with all rows and returns what is wrong with them.

    Lines that do not fit the declared types are saved apart. The checks come back as lazy results over
    the written tables: duplicate keys, transactions without a customer, NULLs per required column. ``load_keyed``
    keeps such rows out of the tables.
    """
    rows, bad_rows = read_csv(spark, transactions_csv, model.TRANSACTIONS)
    holders, bad_holders = read_csv(spark, customers_csv, model.CUSTOMERS)
    write_table(dimensions.apply_defaults(tidy_text(rows), load_date), f"{folder}/fact_transactions")
    write_table(tidy_text(holders), f"{folder}/dim_customers")
    write_table(bad_rows, f"{folder}/rejected_transactions", by_month=False)
    write_table(bad_holders, f"{folder}/rejected_customers", by_month=False)

    fact = read_table(spark, f"{folder}/fact_transactions")
    customers = read_table(spark, f"{folder}/dim_customers")
    return {
        "duplicate_transactions": quality.check_unique(fact, ["transaction_id"]),
        "duplicate_customers": quality.check_unique(customers, ["customer_id"]),
        "unknown_customers": quality.check_foreign_key(fact, customers, "customer_id"),
        "missing_transaction_values": quality.check_not_null(
            fact, [*model.TRANSACTIONS.fieldNames(), *model.LOAD_COLUMNS.fieldNames()]),
        "missing_customer_values": quality.check_not_null(customers, model.CUSTOMERS.fieldNames()),
    }


def load_keyed(spark: SparkSession, transactions_csv: str, customers_csv: str, folder: str,
               load_date=None) -> dict[str, DataFrame]:
    """``load`` with keys that hold: returns what was wrong with the files.

    Lines that do not fit the declared types, rows that repeat a key and transactions of unknown customers are saved
    apart, each kind in a table of its own. The checks come back as lazy results over the written tables: keys
    that were repeated, customers that are unknown with their rows, NULLs per required column.
    """
    rows, bad_rows = read_csv(spark, transactions_csv, model.TRANSACTIONS)
    holders, bad_holders = read_csv(spark, customers_csv, model.CUSTOMERS)
    holders = keys.with_verdicts(tidy_text(holders), "customer_id")
    for verdict, name in ((keys.KEPT, "dim_customers"), (keys.DUPLICATE, "duplicate_customers")):
        write_table(holders.filter(F.col(keys.VERDICT) == verdict).drop(keys.VERDICT), f"{folder}/{name}")
    customers = read_table(spark, f"{folder}/dim_customers")
    tables = write_checked(dimensions.apply_defaults(tidy_text(rows), load_date), customers, folder)
    write_table(bad_rows, f"{folder}/rejected_transactions", by_month=False)
    write_table(bad_holders, f"{folder}/rejected_customers", by_month=False)

    fact = tables[keys.KEPT]
    return {
        "duplicate_transactions": _repeated(tables[keys.DUPLICATE], "transaction_id"),
        "duplicate_customers": _repeated(read_table(spark, f"{folder}/duplicate_customers"), "customer_id"),
        "unknown_customers": tables[keys.ORPHAN].groupBy("customer_id").agg(F.count("*").alias("rows")),
        "missing_transaction_values": quality.check_not_null(
            fact, [*model.TRANSACTIONS.fieldNames(), *model.LOAD_COLUMNS.fieldNames()]),
        "missing_customer_values": quality.check_not_null(customers, model.CUSTOMERS.fieldNames()),
    }


def _repeated(duplicates: DataFrame, key: str) -> DataFrame:
    """Keys with the number of rows that had them, the kept one too; NULL keys have no kept one."""
    return duplicates.groupBy(key).agg((F.count("*") + F.col(key).isNotNull().cast("int")).alias("rows"))
