"""Small hand-made inputs for the rules that are easy to get wrong."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from txn_analytics import model
from txn_analytics.functions.dates import month_gap, quarter_code, weekday_name, year_gap
from txn_analytics.functions.values import per_unit, percent
from txn_analytics.operators import anomalies, dimensions, measures as m, quality, segments, shares, trend
from txn_analytics.plans import period_report as report
from txn_analytics.plans.customer_report import customer_report
from txn_analytics.plans.product_report import product_report


def _one(df):
    (row,) = df.collect()
    return row


def _by(df, key):
    return {row[key]: row for row in df.collect()}


def test_gaps_count_boundaries(spark):
    days = spark.createDataFrame(
        [(date(2024, 1, 31), date(2024, 2, 1)), (date(2023, 12, 31), date(2024, 1, 1))], "a date, b date")
    rows = days.select(month_gap("a", "b").alias("m"), year_gap("a", "b").alias("y")).collect()
    assert [tuple(row) for row in rows] == [(1, 0), (1, 1)]


def test_rounding_is_half_up_on_exact_values(spark):
    row = _one(spark.range(1).select(
        per_unit(F.lit("1000.01").cast("decimal(25,2)"), F.lit(2)).alias("half"),
        per_unit(F.lit("5").cast("decimal(25,2)"), F.lit(0)).alias("none"),
        percent(F.lit(1), F.lit(8)).alias("eighth"), percent(F.lit(1), F.lit(0)).alias("nothing")))
    assert (row.half, row.none, row.eighth, row.nothing) == (Decimal("500.01"), None, 12.5, None)


def test_month_gap_of_spend(make_transactions, make_customers):
    rows = make_transactions({"date": "2024-01-31", "amount": "30"}, {"date": "2024-02-01", "amount": "10"})
    report_row = _one(customer_report(anomalies.flag_anomalies(rows), make_customers(("C1", "2020-01-01")), "2024-03-01"))
    assert (report_row.lifespan_months, report_row.avg_monthly_spend) == (1, Decimal("40.00"))
    assert (report_row.recency_months, report_row.activity_status) == (1, "Active (< 3 Months)")


def test_failed_and_unknown_status_are_left_out(make_transactions):
    rows = make_transactions({"amount": "1"}, {"amount": "2", "status": "Failed"}, {"amount": "4", "status": None},
                             {"amount": "8", "status": "Pending"})
    assert _one(m.kpis(rows)).total_volume == 9
    assert _one(m.measures(rows, exclude_failed=False)).total_volume == 15


def test_kpis_of_nothing(make_transactions):
    row = _one(m.kpis(make_transactions({"status": "Failed"})))
    assert (row.transactions, row.customers, row.total_volume, row.avg_amount) == (0, 0, None, None)


def test_outlier_is_flagged_once(make_transactions):
    rows = [{"amount": f"{9 + at % 3}"} for at in range(20)] + [{"amount": "10000"}]
    flagged = anomalies.flag_anomalies(make_transactions(*rows))
    assert [row.amount for row in flagged.filter("is_anomaly").collect()] == [Decimal("10000.00")]
    assert _one(anomalies.anomaly_rate(flagged)).anomalies == 1


def test_failed_rows_neither_count_nor_get_flagged(make_transactions):
    rows = [{"amount": f"{9 + at % 3}"} for at in range(20)] + [{"amount": "10000", "status": "Failed"}]
    flagged = anomalies.flag_anomalies(make_transactions(*rows))
    assert flagged.filter("is_anomaly").count() == 0
    assert flagged.count() == 21


def test_single_row_segment_has_no_flag(make_transactions):
    flagged = anomalies.flag_anomalies(make_transactions({"segment": "Alone"}, {"segment": None}))
    assert [row.is_anomaly for row in flagged.collect()] == [False, False]


def test_change_after_a_zero_month_and_over_a_gap(make_transactions):
    rows = make_transactions({"date": "2024-01-10", "amount": "0"}, {"date": "2024-03-10", "amount": "5"},
                             {"date": "2024-04-10", "amount": "5"})
    jan, mar, apr = trend.month_over_month(rows).collect()
    assert (jan.trend, jan.previous_volume, jan.change_pct) == ("Baseline", None, None)
    assert (mar.trend, mar.previous_volume, mar.change_pct) == ("Growth", 0, None)
    assert (apr.trend, apr.change_pct) == ("Flat", 0.0)
    ratios = report.month_ratios(report.monthly(anomalies.enrich_time(rows))).collect()
    assert [row.volume_change for row in ratios] == [None, None, 0.0]


def test_year_over_year_compares_the_same_month(make_transactions):
    rows = make_transactions({"date": "2023-05-01", "amount": "10"}, {"date": "2024-05-01", "amount": "8"},
                             {"date": "2024-06-01", "amount": "1"})
    got = {(row.year, row.month_num): (row.previous_volume, row.trend) for row in trend.year_over_year(rows).collect()}
    assert got == {(2023, 5): (None, "Baseline"), (2024, 5): (10, "Decline"), (2024, 6): (None, "Baseline")}


def test_moving_averages_use_short_frames_at_the_start(make_transactions):
    rows = make_transactions(*[{"date": f"2024-0{at}-01", "amount": str(at)} for at in range(1, 5)])
    got = [(float(row.moving_avg_3), float(row.moving_avg_6)) for row in trend.moving_average(rows).collect()]
    assert got == [(1, 1), (1.5, 1.5), (2, 2), (3, 2.5)]


def test_running_volume_does_not_reset_at_new_year(make_transactions):
    rows = make_transactions({"date": "2023-12-01", "amount": "3"}, {"date": "2024-01-01", "amount": "4"})
    assert [row.running_volume for row in trend.cumulative(rows).collect()] == [3, 7]
    assert [row.running_transactions for row in trend.daily_milestones(rows).collect()] == [1, 2]


def test_amount_bands_are_closed_below(make_transactions):
    amounts = ["999.99", "1000", "9999.99", "10000", "49999.99", "50000", "99999.99", "100000"]
    got = [(row.amount_band[0], row.transactions) for row in
           m.amount_bands(make_transactions(*[{"amount": amount} for amount in amounts])).collect()]
    assert got == [("1", 1), ("2", 2), ("3", 2), ("4", 2), ("5", 1)]


def test_activity_bands_in_band_order(make_transactions):
    rows = [{"customer_id": f"C{count}"} for count in (1, 2, 5, 6, 10, 11, 20, 21) for _ in range(count)]
    got = [(row.activity_band, row.customers) for row in m.activity_bands(make_transactions(*rows)).collect()]
    assert got == [("1 Transaction", 1), ("2–5 Transactions", 2), ("6–10 Transactions", 2),
                   ("11–20 Transactions", 2), ("20+ Transactions", 1)]


def test_recency_bands(make_transactions):
    rows = make_transactions(*[
        {"customer_id": name, "date": day} for name, day in
        (("new", "2024-06-30"), ("d30", "2024-05-31"), ("d31", "2024-05-30"), ("d90", "2024-04-01"), ("d91", "2024-03-31"))])
    got = {row.customer_id: (row.recency_days, row.recency_band) for row in segments.rfm(rows).collect()}
    assert got == {"new": (0, "Active"), "d30": (30, "Active"), "d31": (31, "Lapsing"), "d90": (90, "Lapsing"),
                   "d91": (91, "Dormant")}


def test_rfm_groups_take_the_first_match(make_transactions):
    rows = make_transactions(
        {"customer_id": "champion", "date": "2024-06-30", "amount": "100000"},
        {"customer_id": "risk", "date": "2024-05-01", "amount": "500000"},
        {"customer_id": "lost", "date": "2024-01-01", "amount": "500000"},
        {"customer_id": "plain", "date": "2024-06-30", "amount": "5"},
        *[{"customer_id": "loyal", "date": "2024-06-30", "amount": "1"} for _ in range(50)])
    got = {row.customer_id: row.customer_group for row in segments.rfm(rows).collect()}
    assert got == {"champion": "Champion", "risk": "At Risk - High Value", "lost": "Lost Customer",
                   "plain": "Regular Customer", "loyal": "Loyal Customer"}


def test_risk_looks_at_failure_before_the_flag(make_transactions):
    rows = make_transactions({"amount": "100000"}, {"amount": "99999.99"}, {"amount": "200000", "status": "Failed"},
                             {"amount": "10000"}, {"amount": "1"})
    flagged = rows.withColumn("is_anomaly", F.col("amount") >= 99999)
    got = [(row.risk_category, row.action) for row in segments.transaction_risk(flagged).collect()]
    assert got == [
        (model.RISK_OUTLIER, "Escalate to Compliance"), (model.RISK_OUTLIER, "Flag for Review"),
        (model.RISK_OUTLIER, "Review Failed"), ("Low Risk — Standard Large", "No Action Required"),
        (model.RISK_REST, "No Action Required")]


def test_inactive_customers_stay_in_tenure_bands(make_transactions, make_customers):
    customers = make_customers(("C1", "2019-12-31"), ("idle", "2024-01-01"), ("failed", "2021-06-01"))
    rows = make_transactions({"customer_id": "C1", "amount": "10"}, {"customer_id": "failed", "status": "Failed"})
    got = {row.customer_id: (row.tenure_band, row.transactions, row.total_volume)
           for row in segments.tenure_bands(customers, rows, "2024-06-30").collect()}
    assert got == {"C1": ("Veteran (5+ Years)", 1, 10), "idle": ("New (< 1 Year)", 0, None),
                   "failed": ("Established (3–5 Years)", 0, None)}
    report_rows = customer_report(anomalies.flag_anomalies(rows), customers, "2024-06-30").collect()
    assert [row.customer_id for row in report_rows] == ["C1"]


def test_tenure_summary_means_skip_inactive_customers(make_transactions, make_customers):
    customers = make_customers(("C1", "2024-01-01"), ("idle", "2024-01-01"))
    row = _one(segments.tenure_summary(customers, make_transactions({"customer_id": "C1", "amount": "10"}), "2024-06-30"))
    assert (row.customers, row.transactions, row.total_volume, row.avg_volume_per_customer) == (2, 1, 10, 10)


def test_report_tenure_edges(make_transactions, make_customers):
    joined = {"m11": "2023-07-01", "m12": "2023-06-30", "m35": "2021-07-01", "m36": "2021-06-01", "m59": "2019-07-01",
              "m60": "2019-06-30"}
    rows = make_transactions(*[{"customer_id": name, "date": "2024-06-01"} for name in joined])
    got = _by(customer_report(anomalies.flag_anomalies(rows), make_customers(*joined.items()), "2024-06-15"), "customer_id")
    assert {name: got[name].tenure_months for name in joined} == {name: int(name[1:]) for name in joined}
    assert [got[name].tenure_band[0] for name in joined] == ["N", "G", "G", "E", "E", "V"]


def test_customer_report_in_blocks_equals_plain(make_transactions, make_customers):
    rows = anomalies.flag_anomalies(make_transactions(*[
        {"customer_id": f"C{at % 40}", "segment": "SME" if at % 40 % 3 else "Retail", "amount": str(at % 40 // 4 + 1)}
        for at in range(80)]))
    customers = make_customers(*[(f"C{at}", "2020-01-01") for at in range(40)])
    blocks = customer_report(rows, customers, "2024-06-15", blocks=6)
    plain = customer_report(rows, customers, "2024-06-15")
    assert sorted(blocks.collect()) == sorted(plain.collect())


def test_product_health(make_transactions):
    mix = {"p9": 9, "p5": 5, "p7": 7}
    rows = make_transactions(*[
        {"product": name, "date": "2024-06-01", "status": "Completed" if at < done else "Failed"}
        for name, done in mix.items() for at in range(10)])
    got = _by(product_report(anomalies.flag_anomalies(rows), "2024-06-15"), "product")
    assert {name: (row.health, row.failed, row.completion_pct) for name, row in got.items()} == {
        "p9": ("Healthy", 1, 90.0), "p5": ("High Failure Rate", 5, 50.0), "p7": ("Monitor", 3, 70.0)}
    assert sum(row.revenue_share_pct for row in got.values()) - 100 < 0.05


def test_shares_add_up(make_transactions):
    rows = make_transactions(*[{"branch": f"B{at % 7}", "product": f"P{at % 3}", "segment": f"S{at % 2}",
                                "customer_id": f"C{at % 11}", "amount": str(at + 1)} for at in range(60)])
    branch = shares.volume_share(rows, "branch").collect()
    assert abs(sum(row.volume_share_pct for row in branch) - 100) < 0.05
    inside = shares.share_within(rows, "segment", "product").collect()
    assert abs(sum(row.share_pct for row in inside) - 200) < 0.05
    assert {row.segment_avg_amount for row in shares.product_mix(rows).filter("segment = 'S0'").collect()} == {
        Decimal(sum(Decimal(row.avg_amount) for row in shares.product_mix(rows).collect() if row.segment == "S0") / 3)
        .quantize(Decimal("0.000001"))}


def test_customers_of_two_segments_count_in_both(make_transactions):
    rows = make_transactions({"segment": "A"}, {"segment": "B"})
    assert [row.customer_share_pct for row in shares.segment_share(rows).collect()] == [50.0, 50.0]


def test_iso_week_and_labels(make_transactions):
    row = _one(anomalies.enrich_time(make_transactions({"date": "2024-12-30"})))
    assert (row.week, row.month, row.quarter, str(row.month_start)) == (1, "Dec 2024", "2024Q4", "2024-12-01")


def test_weekday_names(spark):
    got = [row[0] for row in spark.range(1, 8).select(weekday_name(F.col("id").cast("int"))).collect()]
    assert got[0] == "Sunday" and got[6] == "Saturday"
    assert _one(spark.range(1).select(quarter_code(F.lit("2024-03-31").cast("date")).alias("q"))).q == "2024Q1"


def test_date_dimension(spark):
    days = dimensions.date_dimension(spark, "2024-02-28", "2024-03-02").collect()
    assert [row.date_id for row in days] == [20240228, 20240229, 20240301, 20240302]
    assert [row.is_weekend for row in days] == [False, False, False, True]


def test_keys_and_nulls(make_transactions, make_customers):
    rows = make_transactions({"transaction_id": "X"}, {"transaction_id": "X"}, {"customer_id": "nobody", "branch": None})
    assert [tuple(row) for row in quality.check_unique(rows, ["transaction_id"]).collect()] == [("X", 2)]
    orphans = quality.check_foreign_key(rows, make_customers(("C1", "2020-01-01")), "customer_id").collect()
    assert [tuple(row) for row in orphans] == [("nobody", 1)]
    nulls = {row.column: row.nulls for row in quality.check_not_null(rows, ["branch", "amount"]).collect()}
    assert nulls == {"branch": 1, "amount": 0}


def test_profile_estimates_distinct_values(make_transactions):
    rows = make_transactions(*[{"branch": f"B{at % 9}"} for at in range(200)])
    profile = _by(quality.profile_columns(rows, "fact"), "column")
    assert profile["branch"].distinct_values == 9
    assert abs(profile["transaction_id"].distinct_values - 200) < 20
    assert (profile["amount"].type, profile["branch"].largest) == ("decimal(15,2)", "B8")


def test_defaults_fill_only_what_is_missing(make_transactions):
    rows = make_transactions({}, {}).withColumn("is_anomaly", F.when(F.col("transaction_id") == "T000000", True))
    filled = dimensions.apply_defaults(rows)
    assert [row.is_anomaly for row in filled.collect()] == [True, False]
    assert filled.filter("load_date is null").count() == 0


def test_numbers_follow_names(spark):
    names = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "product string")
    got = dimensions.name_dimension(names, "product", "product_id", "product_name").collect()
    assert [tuple(row) for row in got] == [(1, "a"), (2, "b")]


def test_list_of_anomalies_is_part_of_the_flagged_rows(make_transactions):
    rows = report.transform(make_transactions(
        *[{"amount": f"{9 + at % 3}"} for at in range(300)], *[{"amount": str(5000 + at)} for at in range(4)]))
    everything = {row.transaction_id for row in report.flagged(rows).collect()}
    top = [row.transaction_id for row in report.anomaly_list(rows, 3).collect()]
    assert len(everything) == 4 and len(top) == 3 and set(top) < everything
    assert report.kpi_summary(rows, "2024-06-05").collect()[0].report_date == "05 June 2024"


def test_both_halves_agree_on_totals(make_transactions):
    rows = make_transactions(*[{"branch": f"B{at % 4}", "amount": str(at), "status": "Failed" if at % 5 == 0 else "Completed"}
                               for at in range(40)])
    left = {row.branch: row.total_volume for row in m.measures(rows, ["branch"]).collect()}
    right = {row.branch: row.total_volume for row in report.by_branch(report.transform(rows)).collect()}
    assert left == right


@pytest.mark.parametrize("dense", [False, True])
def test_a_month_without_rows(make_transactions, dense):
    """January and March only: March is compared with January, or with an empty February."""
    rows = make_transactions({"date": "2024-01-31", "amount": "100"}, {"date": "2024-03-01", "amount": "150"},
                             {"date": "2024-03-02", "branch": "South", "amount": "1"}, {"date": "2024-05-01", "branch": None, "status": "Failed"})
    got = [(r.month_num, r.transactions, int(r.total_volume), r.change_pct) for r in trend.month_over_month(rows, dense).collect()]
    assert got == ([(1, 1, 100, None), (2, 0, 0, -100.0), (3, 2, 151, None)] if dense else [(1, 1, 100, None), (3, 2, 151, 51.0)])
    running = [(r.branch, r.month_num, int(r.running_volume)) for r in trend.cumulative(rows, ["branch"], dense).collect()]
    assert running == ([("North", 1, 100), ("North", 2, 100), ("North", 3, 250), ("South", 1, 0), ("South", 2, 0), ("South", 3, 1)]
                       if dense else [("North", 1, 100), ("North", 3, 250), ("South", 3, 1)])
    assert trend.month_over_month(rows.limit(0), dense).count() == 0
    averages = trend.trend(rows, "month", stats=("avg_amount",), dense=dense).collect()
    assert [r.avg_amount is None for r in averages] == ([False, True, False] if dense else [False, False])
