"""Grouped measures of transactions, and distinct values and date ranges of any table."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txn_analytics import model
from txn_analytics.functions.dates import as_date, day_gap, month_gap, year_gap
from txn_analytics.functions.values import band_below, band_upto, completed_or_pending, per_unit, percent

# What each measure is called, and how it is computed from the rows of a group.
MEASURES = {
    "transactions": lambda: F.count("*"),
    "total_volume": lambda: F.sum("amount"),
    # From the sum, so that each row is added up once.
    "avg_amount": lambda: per_unit(F.sum("amount"), F.count("amount"), 6),
    "min_amount": lambda: F.min("amount"),
    "max_amount": lambda: F.max("amount"),
    "customers": lambda: F.countDistinct("customer_id"),
    "branches": lambda: F.countDistinct("branch"),
}
BASIC = ("transactions", "total_volume", "avg_amount")


def not_failed(txn: DataFrame) -> DataFrame:
    return txn.filter(completed_or_pending())


def measures(txn: DataFrame, by: Sequence[str] = (), stats: Sequence[str] = BASIC,
             exclude_failed: bool = True) -> DataFrame:
    """The named measures per group, over non-failed rows unless told otherwise."""
    rows = not_failed(txn) if exclude_failed else txn
    return rows.groupBy(*by).agg(*[MEASURES[name]().alias(name) for name in stats])


def kpis(txn: DataFrame) -> DataFrame:
    return measures(txn, (), ("transactions", "customers", "branches",
                              "total_volume", "avg_amount", "min_amount", "max_amount"))


def per_customer(groups: DataFrame) -> DataFrame:
    """Adds the volume per distinct customer."""
    return groups.withColumn("volume_per_customer", per_unit("total_volume", "customers", 6))


def largest_first(groups: DataFrame, *then: str, value: str = "total_volume") -> DataFrame:
    return groups.orderBy(F.col(value).desc(), *then)


def magnitude(txn: DataFrame, by: str, stats: Sequence[str] = BASIC) -> DataFrame:
    """Measures per group with the group's unrounded share of all volume.

    The window runs over one row per group, after aggregation.
    """
    groups = measures(txn, [by], stats)
    everything = F.sum("total_volume").over(Window.partitionBy())
    return groups.withColumn("volume_share_pct", percent("total_volume", everything, None))


def amount_bands(txn: DataFrame, bands=model.AMOUNT_BANDS, rest: str = model.AMOUNT_BAND_REST) -> DataFrame:
    """Count, volume, mean and count share per band of transaction size."""
    rows = not_failed(txn).withColumn("amount_band", band_below("amount", bands, rest))
    groups = measures(rows, ["amount_band"], exclude_failed=False)
    everything = F.sum("transactions").over(Window.partitionBy())
    return groups.withColumn("count_share_pct", percent("transactions", everything, None)).orderBy("amount_band")


def activity_bands(txn: DataFrame, bands=model.ACTIVITY_BANDS, rest: str = model.ACTIVITY_BAND_REST) -> DataFrame:
    """Customers grouped by how many transactions they made, in the order of the bands."""
    limits = [(limit, str(at)) for at, (limit, _) in enumerate(bands)]
    customers = measures(txn, ["customer_id"], ("transactions", "total_volume"))
    return (
        customers
        .withColumn("activity_band", band_upto("transactions", bands, rest))
        .withColumn("band_order", band_upto("transactions", limits, str(len(bands))).cast("int"))
        .groupBy("band_order", "activity_band")
        .agg(
            F.count("*").alias("customers"),
            F.avg("transactions").alias("avg_transactions"),
            F.sum("total_volume").alias("group_volume"),
            F.avg("total_volume").alias("avg_volume_per_customer"),
        )
        .orderBy("band_order")
    )


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct().orderBy(*columns)


def date_range(df: DataFrame, day: str, by: Sequence[str] = ()) -> DataFrame:
    """First and last date with the days, month boundaries and year boundaries between them."""
    first, last = F.col("first_date"), F.col("last_date")
    return (
        df.groupBy(*by).agg(F.min(day).alias("first_date"), F.max(day).alias("last_date"))
        .withColumn("days", day_gap(first, last))
        .withColumn("months", month_gap(first, last))
        .withColumn("years", year_gap(first, last))
    )


def monthly_activity(txn: DataFrame) -> DataFrame:
    """Per calendar month of all rows: count, first and last date, days between them. Months without rows are absent."""
    return (
        txn.groupBy(F.trunc("date", "MM").alias("month_start"))
        .agg(F.count("*").alias("transactions"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))
        .orderBy("month_start")
        .select(
            F.year("month_start").alias("year"),
            F.month("month_start").alias("month_num"),
            F.date_format("month_start", "MMMM").alias("month_name"),
            "transactions", "first_date", "last_date",
            day_gap(F.col("first_date"), F.col("last_date")).alias("days_with_activity"),
        )
    )


def tenure(customers: DataFrame, as_of) -> DataFrame:
    """Years and months (boundaries crossed) from joining to ``as_of``, per customer."""
    today = as_date(as_of)
    return customers.select(
        "customer_id", "segment", "join_date",
        year_gap(F.col("join_date"), today).alias("tenure_years"),
        month_gap(F.col("join_date"), today).alias("tenure_months"),
    )
