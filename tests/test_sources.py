"""Files in and out: typed CSV, rejected lines, tables by month, saved reports."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from txn_analytics import model
from txn_analytics.cluster import join_lookup
from txn_analytics.plans import period_report
from txn_analytics.plans.load import load
from txn_analytics.sources import files

TRANSACTIONS_CSV = """transaction_id,date,customer_id,segment,branch,product,transaction_type,category,amount,status
T1,2024-01-31,C1,Retail,North,Savings,Deposit,Cash,10.50,completed
T2,2024-02-01,C1,Retail,North,Savings,Deposit,Cash,20.00, Failed
T3,2024-02-30,C1,Retail,North,Savings,Deposit,Cash,1.00,Completed
T4,2024-02-10,C2,SME,South,Loan,Payment,Bills,abc,Completed
T5,2024-02-11,C9,SME,South,Loan,Payment,Bills,7.25,PENDING
T5,2024-03-11,C2,SME,,Loan,Payment,Bills,8.25,Completed
"""
CUSTOMERS_CSV = "customer_id,segment,branch,join_date\nC1,Retail,North,2020-05-01\nC2,SME,South,2021-06-02\n"


@pytest.fixture
def csv_files(tmp_path):
    (tmp_path / "transactions.csv").write_text(TRANSACTIONS_CSV)
    (tmp_path / "customers.csv").write_text(CUSTOMERS_CSV)
    return tmp_path


def test_csv_keeps_types_and_sets_bad_lines_apart(spark, csv_files):
    rows, rejected = files.read_csv(spark, str(csv_files / "transactions.csv"), model.TRANSACTIONS)
    assert rows.schema == model.TRANSACTIONS
    assert sorted(row.transaction_id for row in rows.collect()) == ["T1", "T2", "T5", "T5"]
    assert sorted(row[files.BAD_LINE][:2] for row in rejected.collect()) == ["T3", "T4"]


def test_csv_rejects_the_same_lines_whatever_is_read(spark, csv_files):
    rows, rejected = files.read_csv(spark, str(csv_files / "transactions.csv"), model.TRANSACTIONS)
    assert rows.count() == 4 and rejected.count() == 2
    assert sorted(row.branch or "" for row in rows.select("branch").collect()) == ["", "North", "North", "South"]
    assert rows.groupBy("customer_id").count().count() == 3


def test_csv_lines_of_wrong_length_are_set_apart(spark, tmp_path):
    (tmp_path / "customers.csv").write_text(
        CUSTOMERS_CSV + "C3,Retail,North\nC4,Retail,North,2020-01-01,more\nC5,,North,2020-01-01\nC6,SME,North,2020-1\n")
    rows, rejected = files.read_csv(spark, str(tmp_path / "customers.csv"), model.CUSTOMERS)
    assert sorted(row.customer_id for row in rows.select("customer_id").collect()) == ["C1", "C2", "C5"]
    assert sorted(row[0] for row in rejected.select(files.BAD_LINE).collect()) == [
        "C3,Retail,North", "C4,Retail,North,2020-01-01,more", "C6,SME,North,2020-1"]


def test_csv_with_swapped_columns_is_refused(spark, csv_files):
    (csv_files / "swapped.csv").write_text("segment,customer_id,branch,join_date\nRetail,C1,North,2020-05-01\n")
    rows, _ = files.read_csv(spark, str(csv_files / "swapped.csv"), model.CUSTOMERS)
    with pytest.raises(Exception, match="(?i)header"):
        rows.collect()


def test_load_writes_tables_and_reports_what_is_wrong(spark, csv_files):
    folder = str(csv_files / "bank")
    wrong = load(spark, str(csv_files / "transactions.csv"), str(csv_files / "customers.csv"), folder,
                 "2024-04-01 00:00:00")
    fact = spark.read.parquet(f"{folder}/fact_transactions")
    assert sorted((row.transaction_id, row.status) for row in fact.collect()) == [
        ("T1", "Completed"), ("T2", "Failed"), ("T5", "Completed"), ("T5", "Pending")]
    assert fact.filter("is_anomaly or load_date is null").count() == 0
    assert spark.read.parquet(f"{folder}/rejected_transactions").count() == 2
    assert [tuple(row) for row in wrong["duplicate_transactions"].collect()] == [("T5", 2)]
    assert [tuple(row) for row in wrong["unknown_customers"].collect()] == [("C9", 1)]
    assert wrong["duplicate_customers"].count() == 0
    missing = {row.column: row.nulls for row in wrong["missing_transaction_values"].collect()}
    assert {name for name, nulls in missing.items() if nulls} == {"branch"}
    # A second load replaces the first.
    load(spark, str(csv_files / "transactions.csv"), str(csv_files / "customers.csv"), folder)
    assert spark.read.parquet(f"{folder}/fact_transactions").count() == 4


def test_extract_takes_both_ends_and_opens_only_its_months(spark, make_transactions, tmp_path):
    path = str(tmp_path / "fact")
    files.write_table(make_transactions(*[{"date": day} for day in (
        "2023-12-31", "2024-01-01", "2024-01-31", "2024-02-01", "2024-12-31", "2025-01-01")]), path)
    rows = files.extract(files.read_table(spark, path), "2024-01-01", "2024-12-31")
    assert sorted(str(row.date) for row in rows.collect()) == ["2024-01-01", "2024-01-31", "2024-02-01", "2024-12-31"]
    january = files.extract(files.read_table(spark, path), "2024-01-01", "2024-01-31")
    assert january.count() == 2
    assert {Path(name).parent.name for name in january.inputFiles()} >= {"load_month=202401"}
    plan = january._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_month" in plan
    assert {row[0] for row in january.select(F.input_file_name()).distinct().collect()} == {
        row[0] for row in files.read_table(spark, path).filter("load_month = 202401")
        .select(F.input_file_name()).distinct().collect()}


def test_report_is_saved_under_its_date(spark, make_transactions, tmp_path):
    rows = make_transactions(*[
        {"date": f"2024-{1 + at % 12:02d}-05", "customer_id": f"C{at % 15}", "branch": f"B{at % 3}",
         "amount": "9000" if at == 7 else f"{10 + at % 5}", "status": "Failed" if at % 10 == 0 else "Completed"}
        for at in range(120)])
    saved = period_report.run(rows, "2024-01-01", "2024-12-31", "2025-01-02", str(tmp_path))
    assert set(saved) == {
        "kpi", "monthly", "branch", "by_type", "by_product", "by_segment", "top_customers", "anomalies", "flagged"}
    assert all("as_of=20250102" in path for path in saved.values())
    read = {name: spark.read.parquet(path) for name, path in saved.items()}
    kpi = read["kpi"].collect()[0]
    assert (kpi.transactions, kpi.anomalies, kpi.report_date) == (108, 1, "02 January 2025")
    assert read["monthly"].count() == 13
    total = read["monthly"].filter("month = 'TOTAL'").collect()[0]
    assert (total.transactions, total.total_volume) == (108, kpi.total_volume)
    assert [row.position for row in read["top_customers"].orderBy("position").collect()] == list(range(1, 11))
    assert read["anomalies"].collect()[0].amount == 9000


def test_results_as_csv(spark, make_transactions, tmp_path):
    results = {"by_product": period_report.by_product(make_transactions({}, {"product": "Loan"}))}
    saved = files.write_results(results, str(tmp_path), "2024-06-30", kind="csv")
    got = spark.read.option("header", True).csv(saved["by_product"]).collect()
    assert sorted(tuple(row) for row in got) == [("Loan", "1", "10.00"), ("Savings", "1", "10.00")]


def test_lookup_beyond_the_limit_is_joined_all_the_same(spark):
    rows = spark.range(100).selectExpr("id", "id % 10 as k")
    lookup = spark.range(10).selectExpr("id as k", "id * 2 as twice")
    small, large = join_lookup(rows, lookup, ["k"]), join_lookup(rows, lookup, ["k"], most_rows=3)
    assert sorted(small.collect()) == sorted(large.collect())
    assert small.filter("twice != k * 2").count() == 0


def test_lookup_made_from_the_rows_themselves(spark):
    rows = spark.range(100).selectExpr("id", "nullif(id % 4, 3) as k")
    counts = rows.groupBy("k").agg(F.count("*").alias("n"))
    for most in (20, 1):
        joined = join_lookup(rows, counts, ["k"], most_rows=most)
        assert joined.columns == ["id", "k", "n"] and joined.filter("n = 25").count() == 100


def test_a_report_appears_at_once_or_not_at_all(spark, make_transactions, tmp_path):
    rows = make_transactions(*[{"date": f"2024-{1 + at % 12:02d}-05", "customer_id": f"C{at % 15}"} for at in range(60)])
    place = tmp_path / "as_of=20250102"
    results = {"kpi": period_report.kpi_summary(rows.withColumn("is_anomaly", F.lit(False)), "2025-01-02"),
               "broken": rows.select(F.raise_error(F.lit("broken")).cast("string").alias("x"))}
    with pytest.raises(Exception, match="broken"):
        files.write_results_at_once(results, str(tmp_path), "2025-01-02")
    assert not place.exists()
    saved = period_report.run_at_once(rows, "2024-01-01", "2024-12-31", "2025-01-02", str(tmp_path))
    counts = {r.result: r["rows"] for r in spark.read.parquet(saved["manifest"]).collect()}
    assert counts["transactions"] == 60 and counts["monthly"] == 13 and set(counts) == set(saved) - {"manifest"}
    assert all(spark.read.parquet(saved[name]).count() == n for name, n in counts.items())
    with pytest.raises(Exception, match="broken"):
        files.write_results_at_once(results, str(tmp_path), "2025-01-02")
    assert spark.read.parquet(saved["by_type"]).count() == counts["by_type"]
    assert files.write_results_at_once({}, str(tmp_path), "2025-01-03") == {}


def test_rows_are_saved_in_order(spark, tmp_path):
    path = str(tmp_path / "ordered")
    rows = spark.range(3000).selectExpr("nullif(id * 7919 % 50, 3) AS k", "id").repartition(5)
    for _ in range(2):
        files.write_ordered(rows, path, [F.desc("k"), "id"])
    back = [(r.k, r.id) for r in files.read_ordered(spark, path).orderBy("_place").collect()]
    assert back == [(r.k, r.id) for r in rows.orderBy(F.desc("k"), "id").collect()] and len(back) == 3000
    sizes = [r["count"] for r in files.read_ordered(spark, path).groupBy("_place.file").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 3000 * 0.7
