"""Customers, transactions and months sorted into named groups."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txn_analytics import model
from txn_analytics.cluster import join_lookup, materialise
from txn_analytics.functions.dates import as_date, day_gap, year_gap
from txn_analytics.functions.values import band_against, band_from, band_upto
from txn_analytics.operators.measures import measures, not_failed

CUSTOMER = ["customer_id", "segment", "branch"]


def benchmark(txn: DataFrame, bands=model.PEER_BANDS, rest: str = model.PEER_REST) -> DataFrame:
    """Each customer's volume against the mean customer of its segment.

    The mean comes from an aggregate joined back, so a segment with most of the customers is never
    gathered in one task.
    """
    customers = materialise(measures(txn, CUSTOMER))
    means = customers.groupBy("segment").agg(F.avg("total_volume").alias("segment_avg_volume"))
    return (
        join_lookup(customers, means, ["segment"])
        .withColumn("diff_from_segment_avg", F.col("total_volume") - F.col("segment_avg_volume"))
        .withColumn("performance_band", band_against("total_volume", "segment_avg_volume", bands, rest))
    )


def rfm(txn: DataFrame, value_bands=model.VALUE_BANDS, frequency_bands=model.FREQUENCY_BANDS,
        recency_bands=model.RECENCY_BANDS) -> DataFrame:
    """Recency, frequency and value bands per customer, and the group they put the customer in.

    Recency counts from the newest transaction in the data.
    """
    customers = materialise(
        not_failed(txn).groupBy(*CUSTOMER).agg(
            F.max("date").alias("last_date"), F.count("*").alias("frequency"), F.sum("amount").alias("monetary"))
    )
    newest = customers.agg(F.max("last_date")).scalar()
    active = F.col("recency_band") == "Active"
    valuable = F.col("value_band").isin("Platinum", "Gold")
    return (
        customers.withColumn("recency_days", day_gap(F.col("last_date"), newest))
        .withColumn("recency_band", band_upto("recency_days", recency_bands, model.RECENCY_REST))
        .withColumn("frequency_band", band_from("frequency", frequency_bands, model.FREQUENCY_REST))
        .withColumn("value_band", band_from("monetary", value_bands, model.VALUE_REST))
        .withColumn("customer_group",
                    F.when(active & valuable, model.CHAMPION)
                    .when(active & (F.col("frequency_band") == "High Frequency"), model.LOYAL)
                    .when((F.col("recency_band") == "Lapsing") & valuable, model.AT_RISK)
                    .when(F.col("recency_band") == model.RECENCY_REST, model.LOST)
                    .otherwise(model.REGULAR))
    )


def transaction_risk(txn: DataFrame, bands=model.RISK_BANDS, escalate_from=model.ESCALATE_FROM) -> DataFrame:
    """Risk category and advised action of every transaction, failed ones included. No shuffle."""
    flagged = F.col("is_anomaly")
    return txn.select(
        "transaction_id", "date", "customer_id", "segment", "branch", "transaction_type", "amount", "is_anomaly",
        F.when(flagged, model.RISK_OUTLIER).otherwise(band_from("amount", bands, model.RISK_REST))
        .alias("risk_category"),
        F.when(F.col("status") == model.FAILED, model.REVIEW_FAILED)
        .when(flagged & (F.col("amount") >= escalate_from), model.ESCALATE)
        .when(flagged, model.FLAG)
        .otherwise(model.NO_ACTION).alias("action"),
    )


def _customers_with_volume(customers: DataFrame, txn: DataFrame) -> DataFrame:
    """All customers, with the count, volume and mean of their non-failed rows (0 and NULLs if they have none).

    The fact is reduced to one row per customer first, so the join meets each key once.
    """
    return (
        customers.join(measures(txn, ["customer_id"]), "customer_id", "left")
        .withColumn("transactions", F.coalesce("transactions", F.lit(0)))
    )


def tenure_bands(customers: DataFrame, txn: DataFrame, as_of, bands=model.TENURE_BANDS,
                 rest: str = model.TENURE_REST) -> DataFrame:
    """Customers, inactive ones too, by calendar years since they joined."""
    return (
        _customers_with_volume(customers, txn)
        .withColumn("tenure_years", year_gap(F.col("join_date"), as_date(as_of)))
        .withColumn("tenure_band", band_from("tenure_years", bands, rest))
        .select(*CUSTOMER, "join_date", "tenure_years", "tenure_band", "transactions", "total_volume", "avg_amount")
    )


def tenure_summary(customers: DataFrame, txn: DataFrame, as_of, bands=model.TENURE_GROUPS,
                   rest: str = model.TENURE_GROUP_REST) -> DataFrame:
    """Segment by tenure: customers, transactions, volume, and mean volume of the active customers."""
    return (
        tenure_bands(customers, txn, as_of, bands, rest)
        .groupBy("segment", "tenure_band")
        .agg(
            F.count("customer_id").alias("customers"),
            F.sum("transactions").alias("transactions"),
            F.sum("total_volume").alias("total_volume"),
            F.avg("total_volume").alias("avg_volume_per_customer"),
        )
        .orderBy("segment", "tenure_band")
    )
