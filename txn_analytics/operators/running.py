"""Running total and mean of each customer, transaction by transaction."""

from pyspark.sql import DataFrame

from txn_analytics.functions.values import per_unit
from txn_analytics.operators.blocks import with_running_sums
from txn_analytics.operators.measures import not_failed

ORDER = ["date", "transaction_id"]


def running_by_customer(txn: DataFrame, blocks: int | None = None) -> DataFrame:
    """Sum and mean of a customer's amounts up to each row, in order of date and transaction id.

    Rows are added up in blocks of even size and what earlier blocks hold of a customer is added to it: a customer, the
    NULL one too, or one day of it may hold any share of the rows. The sum is NULL until an amount is known.
    """
    rows = not_failed(txn).select("customer_id", "segment", *ORDER, "amount")
    totals = with_running_sums(rows, "customer_id", ORDER, {"running_total": "amount"}, blocks)
    return totals.select(
        "customer_id", "segment", *ORDER, "amount", "running_total",
        per_unit("running_total", "_seen", 6).alias("running_avg"),
    )
