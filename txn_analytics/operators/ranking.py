"""Top-k and ranks of customers, branches, products and transaction types."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txn_analytics.operators.blocks import Rank, with_ranks
from txn_analytics.operators.measures import BASIC, measures


def top_k(txn: DataFrame, keys: Sequence[str], k: int = 10, stats: Sequence[str] = BASIC,
          smallest: bool = False) -> DataFrame:
    """The k groups with the largest (or smallest) volume; equal volumes in key order."""
    volume = F.col("total_volume")
    return measures(txn, keys, stats).orderBy(volume.asc() if smallest else volume.desc(), *keys).limit(k)


def _ranked_customers(txn: DataFrame, stats: Sequence[str], ranks: Sequence[Rank], blocks: int | None) -> DataFrame:
    key = ["customer_id", "segment"]
    return with_ranks(measures(txn, key, stats), "total_volume", key, ranks, blocks)


def global_rank(txn: DataFrame, blocks: int | None = None) -> DataFrame:
    """RANK, DENSE_RANK and ROW_NUMBER of every customer by volume."""
    ranks = [Rank("volume_rank"), Rank("volume_dense_rank", "dense"), Rank("volume_row_number", "number")]
    return _ranked_customers(txn, ("total_volume",), ranks, blocks)


def rank_within_segment(txn: DataFrame, blocks: int | None = None) -> DataFrame:
    """RANK of every customer by volume among the customers of its segment."""
    ranks = [Rank("rank_in_segment", within=("segment",))]
    return _ranked_customers(txn, ("total_volume", "transactions"), ranks, blocks)


def rank_groups(txn: DataFrame, by: str, dense: bool = False) -> DataFrame:
    """Groups of a dimension ranked by volume and by count; the windows see one row per group."""
    position = F.dense_rank if dense else F.rank
    return (
        measures(txn, [by])
        .withColumn("volume_rank", position().over(Window.orderBy(F.col("total_volume").desc())))
        .withColumn("count_rank", position().over(Window.orderBy(F.col("transactions").desc())))
        .orderBy("volume_rank", by)
    )


def top_k_within(txn: DataFrame, within: str, k: int = 5) -> DataFrame:
    """The k customers with the largest volume in each group. Each task keeps k per group before the shuffle."""
    order = Window.partitionBy(within).orderBy(F.col("total_volume").desc(), "customer_id", "segment")
    return (
        measures(txn, [within, "customer_id", "segment"], ("total_volume",))
        .withColumn("position", F.row_number().over(order))
        .filter(F.col("position") <= k)
        .orderBy(within, "position")
    )


def rank_types_within(txn: DataFrame, within: str = "branch", what: str = "transaction_type") -> DataFrame:
    """One dimension ranked by volume inside another."""
    order = Window.partitionBy(within).orderBy(F.col("total_volume").desc())
    return (
        measures(txn, [within, what], ("transactions", "total_volume"))
        .withColumn(f"rank_in_{within}", F.rank().over(order))
        .orderBy(within, f"rank_in_{within}", what)
    )
