"""The periodic report: extract a period, flag outliers, derive the result tables, save them by date."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txn_analytics import model
from txn_analytics.functions.dates import as_date
from txn_analytics.functions.values import per_unit
from txn_analytics.operators.anomalies import enrich_time, flag_anomalies
from txn_analytics.operators.measures import largest_first, measures, not_failed
from txn_analytics.operators.shares import with_share
from txn_analytics.sources.files import (
    extract, read_table, result_folder, staging_path, write_results, write_results_at_once, write_table,
)

VOLUMES = ("transactions", "total_volume")


def transform(txn: DataFrame) -> DataFrame:
    """Non-failed rows with time columns and outlier flags."""
    return flag_anomalies(enrich_time(not_failed(txn)))


def kpi_summary(txn: DataFrame, as_of) -> DataFrame:
    return txn.agg(
        F.count("*").alias("transactions"),
        F.sum("amount").alias("total_volume"),
        per_unit(F.sum("amount"), F.count("*")).alias("avg_transaction"),
        F.countDistinct("customer_id").alias("customers"),
        F.coalesce(F.sum(F.col("is_anomaly").cast("long")), F.lit(0)).alias("anomalies"),
        F.date_format(as_date(as_of), "dd MMMM yyyy").alias("report_date"),
    )


def monthly(txn: DataFrame) -> DataFrame:
    return measures(txn, ["month_start", "month"], VOLUMES).orderBy("month_start")


def by_branch(txn: DataFrame) -> DataFrame:
    groups = measures(txn, ["branch"], ("transactions", "total_volume", "customers"))
    return largest_first(groups.withColumn("avg_transaction", per_unit("total_volume", "transactions")), "branch")


def by_type(txn: DataFrame) -> DataFrame:
    return largest_first(
        with_share(measures(txn, ["transaction_type"], VOLUMES), "total_volume", "share_pct", digits=1),
        "transaction_type")


def by_product(txn: DataFrame) -> DataFrame:
    return largest_first(measures(txn, ["product"], VOLUMES), "product")


def by_segment(txn: DataFrame) -> DataFrame:
    groups = measures(txn, ["segment"], ("transactions", "total_volume", "customers"))
    return groups.withColumn("avg_per_customer", per_unit("total_volume", "customers")).orderBy("segment")


def top_customers(txn: DataFrame, k: int = 10) -> DataFrame:
    return largest_first(measures(txn, ["customer_id"], VOLUMES), "customer_id").limit(k)


def flagged(txn: DataFrame) -> DataFrame:
    """Every flagged row."""
    return txn.filter("is_anomaly").select(
        "transaction_id", F.date_format("date", "dd/MM/yyyy").alias("date"), "customer_id", "segment", "branch",
        "transaction_type", "amount")


def anomaly_list(txn: DataFrame, k: int = 20) -> DataFrame:
    """The k largest flagged rows."""
    return largest_first(flagged(txn), "transaction_id", value="amount").limit(k)


def month_ratios(months: DataFrame) -> DataFrame:
    """Change of volume and count from month to month as a fraction; NULL for the first month and after a zero."""
    along = Window.orderBy("month_start")
    for value, out in (("total_volume", "volume_change"), ("transactions", "transaction_change")):
        now = F.col(value).cast("double")
        before = F.lag(now).over(along)
        months = months.withColumn(out, F.try_divide(now - before, before))
    return months.orderBy("month_start")


def with_total(months: DataFrame) -> DataFrame:
    """The months followed by a row with their sums."""
    total = months.agg(
        F.lit(None).cast("date").alias("month_start"), F.lit(model.TOTAL).alias("month"),
        F.sum("transactions").alias("transactions"), F.sum("total_volume").alias("total_volume"))
    return months.unionByName(total, allowMissingColumns=True)


def branch_share(branches: DataFrame) -> DataFrame:
    return largest_first(with_share(branches, "total_volume", "volume_share_pct", digits=1), "branch")


def with_position(top: DataFrame) -> DataFrame:
    """Numbers a short, ranked list."""
    order = Window.orderBy(F.col("total_volume").desc(), "customer_id")
    return top.select(F.row_number().over(order).alias("position"), *top.columns)


def analyse(txn: DataFrame, as_of, top: int = 10, largest: int = 20) -> dict[str, DataFrame]:
    """All result tables of the report, each a lazy plan over the enriched rows.

    ``top`` customers and the ``largest`` flagged rows make the short lists; ``flagged`` has every flagged row.
    """
    return {
        "kpi": kpi_summary(txn, as_of),
        "monthly": with_total(month_ratios(monthly(txn))),
        "branch": branch_share(by_branch(txn)),
        "by_type": by_type(txn),
        "by_product": by_product(txn),
        "by_segment": by_segment(txn),
        "top_customers": with_position(top_customers(txn, top)),
        "anomalies": anomaly_list(txn, largest),
        "flagged": flagged(txn),
    }


def run(txn: DataFrame, first, last, as_of, folder: str, top: int = 10, largest: int = 20) -> dict[str, str]:
    """Build the report for one period. Returns where each result was saved.

    The enriched rows are written once and read back: each result then scans only the columns it needs,
    and a lost executor costs a reread and not the whole plan.
    """
    enriched = f"{result_folder(folder, as_of)}/transactions"
    write_table(transform(extract(txn, first, last)), enriched)
    return write_results(analyse(read_table(txn.sparkSession, enriched), as_of, top, largest), folder, as_of)


def run_at_once(txn: DataFrame, first, last, as_of, folder: str, top: int = 10, largest: int = 20) -> dict[str, str]:
    """``run`` whose results appear together: the enriched rows are staged, and the folder of the date comes last.

    The report has a ``manifest`` of its results and their rows. A report that fails leaves that of an earlier run as it was.
    """
    spark = txn.sparkSession
    enriched = staging_path(f"{folder}/transactions")
    write_table(transform(extract(txn, first, last)), enriched)
    rows = read_table(spark, enriched)
    return write_results_at_once({"transactions": rows} | analyse(rows, as_of, top, largest), folder, as_of)
