"""The product report from a state by month: a new month adds rows to the state, and old months are not read again."""

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txn_analytics import model
from txn_analytics.operators.states import BITMAP_NUMBERS, bitmaps, distinct_counts, with_numbers
from txn_analytics.plans.product_report import report_of

#: Distinct counts of few values: name in the report, column of the fact.
FEW = {"branches": "branch", "segments": "segment", "types_used": "transaction_type"}

_MERGES = {name: F.sum for name in ("transactions", "completed", "pending", "failed", "total_revenue", "anomalies")} | {
    "first_date": F.min, "last_date": F.max, "min_amount": F.min, "max_amount": F.max}


def product_state(txn: DataFrame, customers: DataFrame, names: Mapping[str, DataFrame]) -> DataFrame:
    """One row per month, product and bucket of customers, from one pass over ``txn`` (with ``is_anomaly``).

    ``customers`` and ``names`` (by column of ``FEW``) are dimensions (number, name) as ``name_dimension`` gives them. Later
    states must use the same numbers, so they come from ``extend_name_dimension``.
    """
    for column, dimension in names.items():
        if dimension.filter(F.col(dimension.columns[0]) > BITMAP_NUMBERS).limit(1).count():
            raise ValueError(f"{column} has too many values for one bitmap")
        txn = with_numbers(txn, column, dimension, f"{column}_number")
    txn = with_numbers(txn, "customer_id", customers, "customers")

    def having(status):
        return F.count_if(F.col("status") == status)
    return bitmaps(
        txn.withColumn("month_start", F.trunc("date", "MM")), ["month_start", "product"], "customers",
        {name: f"{column}_number" for name, column in FEW.items()},
        {"transactions": F.count("transaction_id"), "completed": having(model.COMPLETED), "pending": having(model.PENDING),
         "failed": having(model.FAILED), "first_date": F.min("date"), "last_date": F.max("date"), "total_revenue": F.sum("amount"),
         "min_amount": F.min("amount"), "max_amount": F.max("amount"), "anomalies": F.sum(F.col("is_anomaly").cast("long"))})


def report_from_state(state: DataFrame, as_of) -> DataFrame:
    """The product report over all months of the state."""
    return report_of(distinct_counts(state, ["product"], "customers", list(FEW), _MERGES), as_of)
