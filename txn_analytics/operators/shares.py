"""Parts of a whole: what each group contributes to all volume or to the volume of a larger group."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txn_analytics import model
from txn_analytics.functions.values import percent
from txn_analytics.operators.measures import measures


def with_share(groups: DataFrame, value: str, out: str, within: Sequence[str] = (), digits: int | None = 2) -> DataFrame:
    """Adds 100 * value / sum(value) over all groups, or over those that share ``within``."""
    return groups.withColumn(out, percent(value, F.sum(value).over(Window.partitionBy(*within)), digits))


def volume_share(txn: DataFrame, by: str) -> DataFrame:
    """Volume and count share per group."""
    groups = measures(txn, [by], ("transactions", "total_volume"))
    groups = groups.withColumn("whole_volume", F.sum("total_volume").over(Window.partitionBy()))
    groups = with_share(groups, "total_volume", "volume_share_pct")
    return with_share(groups, "transactions", "transaction_share_pct").orderBy(F.desc("volume_share_pct"), by)


def segment_share(txn: DataFrame, by: str = "segment") -> DataFrame:
    """Volume share and share of customers; a customer seen in two groups counts in both and twice in the whole."""
    groups = measures(txn, [by], ("transactions", "customers", "total_volume"))
    groups = groups.withColumn("whole_volume", F.sum("total_volume").over(Window.partitionBy()))
    groups = with_share(groups, "total_volume", "volume_share_pct")
    return with_share(groups, "customers", "customer_share_pct").orderBy(F.desc("volume_share_pct"), by)


def _within(txn: DataFrame, within: str, part: str, stats: Sequence[str]) -> DataFrame:
    groups = measures(txn, [within, part], stats)
    groups = groups.withColumn(f"{within}_volume", F.sum("total_volume").over(Window.partitionBy(within)))
    return with_share(groups, "total_volume", "share_pct", [within])


def share_within(txn: DataFrame, within: str, part: str, stats: Sequence[str] = ("total_volume",)) -> DataFrame:
    """Share of each part in the volume of the group around it."""
    return _within(txn, within, part, stats).orderBy(within, F.desc("share_pct"), part)


def product_mix(txn: DataFrame) -> DataFrame:
    """Product share within each segment, with the plain mean of the segment's product means."""
    groups = _within(txn, "segment", "product", ("transactions", "total_volume", "avg_amount"))
    mean = F.avg("avg_amount").over(Window.partitionBy("segment"))
    return groups.withColumn("segment_avg_amount", F.round(mean, 6)).orderBy("segment", F.desc("share_pct"), "product")


def anomaly_share(txn: DataFrame) -> DataFrame:
    """Count and volume share of flagged and other rows."""
    groups = measures(txn, ["is_anomaly"], ("transactions", "total_volume"))
    groups = groups.withColumn("whole_volume", F.sum("total_volume").over(Window.partitionBy()))
    groups = with_share(with_share(groups, "transactions", "count_share_pct"), "total_volume", "volume_share_pct")
    return groups.orderBy("is_anomaly").select(
        F.when(F.col("is_anomaly"), model.ANOMALY).otherwise(model.NORMAL).alias("kind"),
        "transactions", "total_volume", "whole_volume", "count_share_pct", "volume_share_pct",
    )
