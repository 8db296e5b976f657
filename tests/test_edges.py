"""Edge values of labels, counts beyond any table of today, and where intermediate tables go."""

import os
from decimal import Decimal

from pyspark.sql import functions as F

import txn_analytics
from txn_analytics import cluster, model
from txn_analytics.functions.values import band_from, band_upto, per_unit
from txn_analytics.operators.measures import amount_bands
from txn_analytics.plans import period_report
from txn_analytics.plans.customer_report import customer_report
from txn_analytics.plans.product_report import product_report
from txn_analytics.sources import files


def test_means_over_ten_trillion_rows(spark):
    row = spark.sql("SELECT CAST('123456789012345.67' AS decimal(25,2)) AS total, 10000000000000L AS n").select(
        per_unit("total", "n", 6).alias("six"), per_unit("total", "n").alias("two"), per_unit("total", F.lit(0)).alias("none")).first()
    assert (row.six, row.two, row.none) == (Decimal("12.345679"), Decimal("12.35"), None)


def test_amount_bands_at_their_edges(make_transactions):
    amounts = ["999.99", "1000", "9999.99", "10000", "49999.99", "50000", "99999.99", "100000"]
    rows = make_transactions(*[{"amount": x} for x in amounts])
    rows = rows.unionByName(rows.limit(1).withColumn("amount", F.lit(None).cast("decimal(15,2)")))
    found = {r.amount_band: r.transactions for r in amount_bands(rows).collect()}
    assert found == {"1. Below RM 1,000": 1, "2. RM 1,000 – 9,999": 2, "3. RM 10,000 – 49,999": 2, "4. RM 50,000 – 99,999": 2,
                     "5. RM 100,000 and above": 2}


def _labels(spark, values, band):
    rows = spark.createDataFrame([(x,) for x in values], "v int")
    return [r[0] for r in rows.select(band(F.col("v"))).collect()]


def test_labels_at_their_edges(spark):
    def from_(steps, rest):
        return lambda v: band_from(v, steps, rest)

    assert _labels(spark, [499999, 500000, 99999, 100000, 19999, 20000], from_(model.TIERS, model.TIER_REST)) == [
        "Premium", "VIP", "Regular", "Premium", "New / Low Activity", "Regular"]
    assert _labels(spark, [100, 99, 50, 49, 20, 19], from_(model.ADOPTION, model.ADOPTION_REST)) == [
        "Widely Adopted", "Moderately Adopted", "Moderately Adopted", "Niche", "Niche", "Low Adoption"]
    assert _labels(spark, [3, 2, 1, 0], from_(model.CUSTOMER_RISK, model.RISK_CLEAN)) == ["High Risk", "Monitor", "Monitor", "Clean"]
    assert _labels(spark, [10, 9, 5, 4], from_(model.PRODUCT_RISK, model.RISK_CLEAN)) == ["High Risk", "Monitor", "Monitor", "Clean"]
    assert _labels(spark, [30, 31, 90, 91], lambda v: band_upto(v, model.RECENCY_BANDS, model.RECENCY_REST)) == [
        "Active", "Lapsing", "Lapsing", "Dormant"]


def test_activity_as_of_different_days(make_transactions, make_customers):
    rows = make_transactions({"date": "2024-06-15"}).withColumn("is_anomaly", F.lit(False))
    customers = make_customers(("C1", "2020-01-01"))
    for as_of, label in (("2024-05-31", "Active (< 3 Months)"), ("2024-06-01", "Active This Month"), ("2024-09-30", "Active (< 3 Months)"),
                         ("2024-12-31", "Lapsing (3–6 Months)"), ("2025-01-01", "Dormant (6+ Months)")):
        assert customer_report(rows, customers, as_of).first().activity_status == label


def test_unknown_dates_give_unknown_monthly_means(make_transactions, make_customers):
    rows = make_transactions({"amount": "50"}).withColumns({"is_anomaly": F.lit(False), "date": F.lit(None).cast("date")})
    assert customer_report(rows, make_customers(("C1", "2020-01-01")), "2024-06-30").first().avg_monthly_spend is None
    assert product_report(rows, "2024-06-30").first().avg_monthly_revenue is None


def test_saved_report_keeps_every_flagged_row_and_every_date(spark, make_transactions, tmp_path):
    rows = make_transactions(*[{"amount": "1"} for _ in range(400)], *[{"amount": "900", "customer_id": "X"} for _ in range(25)])
    first = period_report.run(rows, "2024-01-01", "2024-12-31", "2024-12-31", str(tmp_path), top=1, largest=3)
    second = period_report.run(rows.filter("amount = 1"), "2024-01-01", "2024-12-31", "2025-01-31", str(tmp_path))
    counts = {name: files.read_table(spark, path).count() for name, path in first.items()}
    assert counts["flagged"] == 25 and counts["anomalies"] == 3 and counts["top_customers"] == 1
    assert files.read_table(spark, second["flagged"]).count() == 0
    assert files.read_table(spark, f"{tmp_path}/as_of=20241231/transactions").count() == 425


def test_intermediate_tables_go_to_the_named_folder(spark, tmp_path, monkeypatch):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert cluster.work_folder(spark) == (named or f"{spark.conf.get('spark.sql.warehouse.dir')}/_work").rstrip("/")
    monkeypatch.setattr(cluster, "work_folder", lambda session: str(tmp_path))
    assert cluster.saved(spark.range(3), "some").count() == 3
    assert [name.split("-")[0] for name in os.listdir(tmp_path)] == ["some"]
    package = os.path.dirname(txn_analytics.__file__)
    sources = [os.path.join(d, f) for d, _, names in os.walk(package) for f in names if f.endswith(".py")]
    assert not any("tempfile" in open(path).read() or "localCheckpoint" in open(path).read() for path in sources)
