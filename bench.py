"""Times the headline queries over the tables in BENCH_SF_DIR and prints one line of JSON."""

import json
import os
import time

from txn_analytics.cluster import local_session
from txn_analytics.queries import QUERIES

HEADLINE = [
    "q04_1_kpis", "q04_5_by_segment", "q04_8_by_anomaly_flag", "q05_5_segment_by_branch", "q05_8_activity_bands",
    "q06_2_customer_ranks", "q06_3_rank_within_segment", "q06_6_top_customers_per_branch",
    "q07_4_weekday_trend", "q07_6_monthly_by_branch", "q08_4_running_by_branch", "q08_5_running_by_customer",
    "q09_1_month_over_month", "q09_3_branch_performance", "q09_5_customer_benchmark",
    "q10_1_rfm", "q10_2_transaction_risk_lines", "q10_4_tenure_summary",
    "q11_7_product_mix", "q12_customer_report", "q13_product_report", "report_saved_branch_table",
]


RUNS = 2  # the better one counts


def _run(spark, name: str, folder: str) -> float:
    """Seconds to build and run a query, all its rows computed and none kept."""
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    # One small query first, so that starting up is not charged to the first headline query.
    QUERIES["q02_7_statuses"](spark, folder).collect()
    seconds = {}
    for name in HEADLINE:
        seconds[name] = round(min(_run(spark, name, folder) for _ in range(RUNS)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "runs": RUNS, "sf": os.path.basename(folder).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
