"""Time columns and outlier flags of transactions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txn_analytics.cluster import join_lookup
from txn_analytics.functions.dates import month_label, quarter_code
from txn_analytics.functions.values import completed_or_pending
from txn_analytics.operators import states


def enrich_time(txn: DataFrame) -> DataFrame:
    """Month start and label, quarter code and ISO week of each row."""
    return (
        txn.withColumn("month_start", F.trunc("date", "MM"))
        .withColumn("month", month_label("date"))
        .withColumn("quarter", quarter_code("date"))
        .withColumn("week", F.weekofyear("date"))
    )


def flag_anomalies(txn: DataFrame, by: str = "segment", deviations: float = 3,
                   limits_from: DataFrame | None = None, moments: DataFrame | None = None) -> DataFrame:
    """Sets ``is_anomaly`` on rows above the mean of their group by so many sample deviations.

    Mean and deviation come from the rows that did not fail, and failed rows are never flagged. A group
    of one row has no deviation and no flag. ``limits_from`` may hold the same rows with only the group, the
    amount and the status, so that the limits need no other column of a view. With ``moments``, a state of
    ``states.moments``, limits come from it: exact sums, whatever the partitions are, and no second scan of the rows.
    """
    value = F.col("amount").cast("double")
    limits = states.limits(moments, by, deviations) if moments is not None else (
        (txn if limits_from is None else limits_from).filter(completed_or_pending()).groupBy(by)
        .agg((F.avg(value) + deviations * F.stddev_samp(value)).alias("_limit"))
    )
    flag = completed_or_pending() & (value > F.col("_limit"))
    return (
        join_lookup(txn, limits, [by])
        .withColumn("is_anomaly", F.coalesce(flag, F.lit(False)))
        .drop("_limit")
    )


def anomaly_rate(txn: DataFrame) -> DataFrame:
    """Flagged rows, all rows, and their ratio in percent, over rows that did not fail."""
    flagged = F.sum(F.col("is_anomaly").cast("long"))
    return txn.filter(completed_or_pending()).agg(
        flagged.alias("anomalies"), F.count("*").alias("transactions"),
        (F.avg(F.col("is_anomaly").cast("int")) * 100).alias("anomaly_rate_pct"),
    )
