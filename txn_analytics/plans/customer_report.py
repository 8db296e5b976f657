"""The consolidated customer report: one row per active customer."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txn_analytics import model
from txn_analytics.cluster import join_lookup, materialise
from txn_analytics.functions.dates import as_date, month_gap
from txn_analytics.functions.values import at_least_one, band_against, band_from, band_upto, per_unit
from txn_analytics.operators.blocks import Rank, with_ranks
from txn_analytics.operators.measures import not_failed

KEY = ["customer_id", "segment", "branch"]


def _activity(txn: DataFrame) -> DataFrame:
    """Non-failed transactions per customer. Combined before each shuffle, so a hot customer stays small."""
    return not_failed(txn).groupBy(*KEY).agg(
        F.count("transaction_id").alias("transactions"), F.sum("amount").alias("total_volume"),
        F.min("amount").alias("min_amount"), F.max("amount").alias("max_amount"),
        F.countDistinct("product").alias("products_used"),
        F.countDistinct("transaction_type").alias("types_used"),
        F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        F.sum(F.col("is_anomaly").cast("long")).alias("anomalies"),
    )


def customer_report(txn: DataFrame, customers: DataFrame, as_of, tiers=model.TIERS,
                    blocks: int | None = None) -> DataFrame:
    """Tiers, activity, diversity, monthly spend, risk, benchmarks and ranks of every customer.

    ``txn`` carries ``is_anomaly``. Customers missing from ``customers`` are left out. The customer rows are
    computed once; means and both ranks are then read from them.
    """
    today = as_date(as_of)
    months_active = month_gap(F.col("first_date"), F.col("last_date"))
    kpis = materialise(
        _activity(txn).join(customers.select("customer_id", "join_date"), "customer_id")
        .withColumns({
            "tenure_months": month_gap(F.col("join_date"), today),
            "lifespan_months": months_active,
            "recency_months": month_gap(F.col("last_date"), today),
            "avg_transaction": per_unit("total_volume", "transactions"),
            "avg_monthly_spend": per_unit("total_volume", at_least_one(months_active)),
        })
    )

    bank = {name: kpis.agg(F.avg(value)).scalar() for name, value in (
        ("_bank_volume", "total_volume"), ("_bank_spend", "avg_monthly_spend"))}
    segments = kpis.groupBy("segment").agg(F.avg("total_volume").alias("_segment_volume"))
    ranks = [Rank("overall_rank"), Rank("segment_rank", within=("segment",))]
    ranked = with_ranks(kpis, "total_volume", KEY, ranks, blocks)
    return join_lookup(ranked, segments, ["segment"]).withColumns(bank).select(
        *KEY, "join_date",
        band_from("total_volume", tiers, model.TIER_REST).alias("customer_tier"),
        band_from("tenure_months", model.REPORT_TENURE, model.REPORT_TENURE_REST).alias("tenure_band"),
        F.when(F.col("recency_months") == 0, model.REPORT_THIS_MONTH)
        .otherwise(band_upto("recency_months", model.REPORT_ACTIVITY, model.REPORT_ACTIVITY_REST)).alias("activity_status"),
        "transactions", "products_used", "types_used", "first_date", "last_date",
        "total_volume", "min_amount", "max_amount",
        "tenure_months", "lifespan_months", "recency_months", "avg_transaction", "avg_monthly_spend",
        "anomalies",
        band_from("anomalies", model.CUSTOMER_RISK, model.RISK_CLEAN).alias("risk_flag"),
        F.round("_bank_volume", 2).alias("bank_avg_volume"),
        F.round("_bank_spend", 2).alias("bank_avg_monthly_spend"),
        F.round(F.col("total_volume") - F.col("_bank_volume"), 2).alias("diff_from_bank_avg"),
        F.round("_segment_volume", 2).alias("segment_avg_volume"),
        band_against("total_volume", "_segment_volume", model.SEGMENT_BANDS, model.SEGMENT_REST)
        .alias("segment_performance"),
        "overall_rank", "segment_rank",
    )
