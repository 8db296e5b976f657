"""The consolidated product report: one row per product, failed transactions included."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txn_analytics import model
from txn_analytics.functions.dates import as_date, month_gap
from txn_analytics.functions.values import at_least_one, band_against, band_from, per_unit, percent


def _activity(txn: DataFrame) -> DataFrame:
    """All transactions per product.

    Each distinct count is reduced to (product, value) pairs before the shuffle and spread by value, so a
    product with most of the rows is not gathered in one task.
    """
    def having(status):
        return F.count_if(F.col("status") == status).alias(status.lower())

    return txn.groupBy("product").agg(
        F.count("transaction_id").alias("transactions"),
        having(model.COMPLETED), having(model.PENDING), having(model.FAILED),
        F.countDistinct("customer_id").alias("customers"),
        F.countDistinct("branch").alias("branches"),
        F.countDistinct("segment").alias("segments"),
        F.countDistinct("transaction_type").alias("types_used"),
        F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        F.sum("amount").alias("total_revenue"),
        F.min("amount").alias("min_amount"), F.max("amount").alias("max_amount"),
        F.sum(F.col("is_anomaly").cast("long")).alias("anomalies"),
    )


def product_report(txn: DataFrame, as_of) -> DataFrame:
    """Tier, adoption, health, reach, revenue, risk, benchmarks and ranks of every product.

    ``txn`` carries ``is_anomaly``.
    """
    return report_of(_activity(txn), as_of)


def report_of(activity: DataFrame, as_of) -> DataFrame:
    """The report from one row of activity per product; windows see no others."""
    everything = Window.partitionBy()
    months_active = month_gap(F.col("first_date"), F.col("last_date"))
    recency, completion = F.col("recency_months"), F.col("completion_pct")
    health = (
        F.when((recency == 0) & (completion >= model.HEALTHY_FROM), model.HEALTHY)
        .when((recency <= 1) & (completion >= model.ACTIVE_FROM), model.ACTIVE)
        .when(completion < model.FAILING_BELOW, model.FAILING)
        .otherwise(model.MONITOR)
    )

    def falling_rank(name):
        return F.rank().over(Window.orderBy(F.col(name).desc()))

    kpis = (
        activity
        .withColumns({
            "lifespan_months": months_active,
            "recency_months": month_gap(F.col("last_date"), as_date(as_of)),
            "avg_order_revenue": per_unit("total_revenue", "transactions"),
            "avg_monthly_revenue": per_unit("total_revenue", at_least_one(months_active)),
            "revenue_per_customer": per_unit("total_revenue", "customers"),
            "completion_pct": percent("completed", "transactions"),
        })
        .withColumns({
            "bank_revenue": F.sum("total_revenue").over(everything),
            "bank_avg_revenue": F.round(F.avg("total_revenue").over(everything), 2),
            "bank_avg_monthly_revenue": F.round(F.avg("avg_monthly_revenue").over(everything), 2),
            "revenue_rank": falling_rank("total_revenue"),
            "adoption_rank": falling_rank("customers"),
            "order_revenue_rank": falling_rank("avg_order_revenue"),
        })
    )
    return kpis.orderBy(F.desc("total_revenue"), "product").select(
        "product",
        band_against("total_revenue", "bank_revenue", model.PRODUCT_TIERS, model.PRODUCT_TIER_REST, strict=False)
        .alias("performance_tier"),
        band_from("customers", model.ADOPTION, model.ADOPTION_REST).alias("adoption_band"),
        health.alias("health"),
        "transactions", "completed", "pending", "failed", "completion_pct",
        "customers", "branches", "segments",
        "first_date", "last_date", "lifespan_months", "recency_months",
        "total_revenue", "min_amount", "max_amount",
        "avg_order_revenue", "avg_monthly_revenue", "revenue_per_customer",
        "anomalies", band_from("anomalies", model.PRODUCT_RISK, model.RISK_CLEAN).alias("risk_flag"),
        "bank_revenue", percent("total_revenue", "bank_revenue").alias("revenue_share_pct"),
        "bank_avg_revenue", "bank_avg_monthly_revenue",
        "revenue_rank", "adoption_rank", "order_revenue_rank",
    )
