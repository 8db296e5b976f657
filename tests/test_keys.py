"""Loads whose keys hold, dimensions whose numbers stay, and months that are put in place of their own."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from txn_analytics.operators import keys
from txn_analytics.operators.dimensions import extend_name_dimension, name_dimension
from txn_analytics.plans.load import load_keyed, load_months, write_checked
from txn_analytics.sources import files


def _by_verdict(df):
    return Counter((row.verdict, row.transaction_id, str(row.amount)) for row in df.collect())


def test_rows_add_up_and_one_of_each_key_is_kept(make_transactions, make_customers):
    rows = make_transactions(
        {"transaction_id": "A", "amount": "2"}, {"transaction_id": "A", "amount": "1"}, {"transaction_id": "A", "amount": "1"},
        {"transaction_id": "B", "customer_id": "C9"}, {"transaction_id": "B"}, {"transaction_id": "B", "customer_id": None},
        {"transaction_id": None}, {"transaction_id": "D"})
    got = _by_verdict(keys.with_verdicts(rows, "transaction_id", {"customer_id": make_customers(("C1", "2020-01-01")).select("customer_id")}))
    assert got == Counter([
        ("kept", "A", "1.00"), ("duplicate", "A", "1.00"), ("duplicate", "A", "2.00"), ("kept", "B", "10.00"),
        ("orphan", "B", "10.00"), ("orphan", "B", "10.00"), ("duplicate", None, "10.00"), ("kept", "D", "10.00")])


def test_taken_keys_are_refused(spark, make_transactions):
    taken = spark.createDataFrame([("A",), ("A",), ("Z",)], "transaction_id string")
    rows = make_transactions({"transaction_id": "A"}, {"transaction_id": "B"}, {"transaction_id": "B"})
    got = Counter((r.verdict, r.transaction_id) for r in keys.with_verdicts(rows, "transaction_id", taken=taken).collect())
    assert got == Counter([("duplicate", "A"), ("kept", "B"), ("duplicate", "B")])


@pytest.mark.parametrize("most", [20_000, 2])
def test_a_key_on_half_of_all_rows(spark, monkeypatch, most):
    """Also where too many keys are in doubt to be broadcast."""
    lookup = keys.join_lookup
    monkeypatch.setattr(keys, "join_lookup", lambda df, other, on: lookup(df, other, on, most))
    rows = spark.range(4000).selectExpr(
        "if(id % 2 = 0, 'HOT', concat('K', id div 4)) AS transaction_id", "if(id % 3 = 0, 'C0', concat('C', id % 50)) AS customer_id",
        "cast(id AS decimal(15,2)) AS amount")
    holders = spark.range(45).selectExpr("concat('C', id) AS customer_id")
    judged = keys.with_verdicts(rows, "transaction_id", {"customer_id": holders})
    count = {r.verdict: r["count"] for r in judged.groupBy("verdict").count().collect()}
    assert sum(count.values()) == 4000
    orphans = rows.join(holders, "customer_id", "left_anti")
    sound = rows.join(holders, "customer_id", "left_semi")
    assert count["orphan"] == orphans.count() and count["kept"] == sound.select("transaction_id").distinct().count()
    first = judged.filter("verdict = 'kept' AND transaction_id = 'HOT'").collect()
    least = sound.filter("transaction_id = 'HOT'").orderBy("customer_id", "amount").first()
    assert [tuple(r)[:3] for r in first] == [tuple(least)] or [r.amount for r in first] == [least.amount]


def test_no_rows_give_three_empty_tables(spark, make_transactions, make_customers, tmp_path):
    rows = make_transactions({}).limit(0)
    tables = write_checked(rows, make_customers(("C1", "2020-01-01")), str(tmp_path))
    assert {name: df.count() for name, df in tables.items()} == {"kept": 0, "duplicate": 0, "orphan": 0}


def test_keyed_load_writes_each_kind_apart(spark, tmp_path):
    (tmp_path / "t.csv").write_text(
        "transaction_id,date,customer_id,segment,branch,product,transaction_type,category,amount,status\n"
        "T1,2024-01-31,C1,Retail,North,Savings,Deposit,Cash,10.50,completed\n"
        "T1,2024-01-30,C1,Retail,North,Savings,Deposit,Cash,10.50,completed\n"
        "T2,2024-02-01,C9,Retail,North,Savings,Deposit,Cash,20.00, Failed\n"
        "T3,2024-02-30,C1,Retail,North,Savings,Deposit,Cash,1.00,Completed\n")
    (tmp_path / "c.csv").write_text("customer_id,segment,branch,join_date\nC1,SME,South,2021-06-02\nC1,Retail,North,2020-05-01\n")
    folder = str(tmp_path / "bank")
    for _ in range(2):      # a second load replaces the first
        wrong = load_keyed(spark, str(tmp_path / "t.csv"), str(tmp_path / "c.csv"), folder, "2024-04-01 00:00:00")
    read = {name: files.read_table(spark, f"{folder}/{name}") for name in (
        "fact_transactions", "duplicate_transactions", "orphan_transactions", "dim_customers", "rejected_transactions")}
    assert {name: df.count() for name, df in read.items()} == {
        "fact_transactions": 1, "duplicate_transactions": 1, "orphan_transactions": 1, "dim_customers": 1, "rejected_transactions": 1}
    kept = read["fact_transactions"].collect()[0]
    assert (str(kept.date), kept.load_month, kept.is_anomaly) == ("2024-01-30", 202401, False)
    assert read["dim_customers"].collect()[0].segment == "Retail"
    assert [tuple(r) for r in wrong["duplicate_transactions"].collect()] == [("T1", 2)]
    assert [tuple(r) for r in wrong["unknown_customers"].collect()] == [("C9", 1)]
    assert [tuple(r) for r in wrong["duplicate_customers"].collect()] == [("C1", 2)]
    assert not [p for p in (tmp_path / "bank").iterdir() if p.name.startswith("_duplicate")]


def test_numbers_of_names_stay(spark):
    def names(*values):
        return spark.createDataFrame([(v,) for v in values], "name string")
    first = name_dimension(names("m", "d", "d", None), "name", "id", "label")
    second = extend_name_dimension(first, names("a", "m", "z", "a", None), "name", "id", "label")
    assert [tuple(r) for r in second.collect()] == [(1, "d"), (2, "m"), (3, "a"), (4, "z")]
    third = extend_name_dimension(second, names("z", None), "name", "id", "label")
    assert [tuple(r) for r in third.collect()] == [tuple(r) for r in second.collect()]
    assert [tuple(r) for r in extend_name_dimension(first.limit(0), names("b"), "name", "id", "label").collect()] == [(1, "b")]


def _months(spark, path):
    return Counter((r.load_month, r.transaction_id, int(r.amount)) for r in spark.read.parquet(path).collect())


def test_a_month_replaces_only_itself(spark, make_transactions, tmp_path):
    path = str(tmp_path / "fact")
    files.write_table(make_transactions(
        {"transaction_id": "A", "date": "2024-01-05"}, {"transaction_id": "B", "date": "2024-02-05"}, {"transaction_id": "C", "date": "2024-02-06"}), path)
    new = make_transactions({"transaction_id": "B", "date": "2024-02-07", "amount": "7"}, {"transaction_id": "D", "date": "2024-03-01", "amount": "8"})
    for _ in range(2):
        files.replace_months(new, path)
        assert _months(spark, path) == Counter([(202401, "A", 10), (202402, "B", 7), (202403, "D", 8)])


def test_a_load_that_fails_midway_leaves_the_table(spark, make_transactions, tmp_path):
    path = str(tmp_path / "fact")
    rows = make_transactions(*[{"transaction_id": f"T{k}", "date": f"2024-0{1 + k % 3}-05"} for k in range(30)])
    files.write_table(rows, path)
    before = _months(spark, path)
    breaks = F.when(F.col("transaction_id") == "T29", F.raise_error(F.lit("broken")).cast("decimal(15,2)")).otherwise(F.col("amount") + 1)
    broken = rows.withColumn("amount", breaks.cast("decimal(15,2)"))
    for write in (files.replace_months, files.write_table):
        with pytest.raises(Exception, match="broken"):
            write(broken, path)
        assert _months(spark, path) == before


def test_loading_a_month_checks_keys_against_the_others(spark, make_transactions, make_customers, tmp_path):
    folder, customers = str(tmp_path), make_customers(("C1", "2020-01-01"))
    write_checked(make_transactions({"transaction_id": "A", "date": "2024-01-05"}, {"transaction_id": "B", "date": "2024-02-05"}), customers, folder)
    new = make_transactions(
        {"transaction_id": "A", "date": "2024-02-07"}, {"transaction_id": "B", "date": "2024-02-07", "amount": "7"},
        {"transaction_id": "E", "date": "2024-02-07", "customer_id": "C5"})
    for _ in range(2):
        refused = load_months(new, customers, folder)
        assert {(r.transaction_id, r.verdict) for r in refused.collect()} == {("A", "duplicate"), ("E", "orphan")}
        assert _months(spark, f"{folder}/fact_transactions") == Counter([(202401, "A", 10), (202402, "B", 7)])


def test_jdbc_conditions_share_out_all_rows(spark):
    predicates = files.month_predicates([("2024-01-01", "2024-02-01"), ("2024-02-01", "2024-03-01")])
    days = spark.sql("SELECT explode(sequence(date'2023-11-01', date'2024-05-01')) AS date UNION ALL SELECT NULL")
    assert sum(days.filter(p).count() for p in predicates) == days.count()
    assert days.filter(" OR ".join(f"({p})" for p in predicates)).count() == days.count()
    with pytest.raises(ValueError):
        files.month_predicates([("2024-01-01", "2024-02-01"), ("2024-03-01", "2024-04-01")])


@pytest.mark.parametrize("few", [20_000, 2])
def test_keys_in_doubt_are_found_once(spark, monkeypatch, few):
    """What rows are looked up in is a table that was written, whether its keys are few or many; verdicts are by definition."""
    lookup, plans = keys.join_lookup, []

    def watched(df, other, on):
        plans.append(other._jdf.queryExecution().executedPlan().toString())
        return lookup(df, other, on, few)
    monkeypatch.setattr(keys, "join_lookup", watched)
    monkeypatch.setattr(keys, "FEW", few, raising=False)
    rows = [(None if k % 10 == 0 else f"K{k % 23}", k * 7 % 3, None if k % 11 == 0 else f"C{k % 13}") for k in range(60)] + [("U", 1, "C1")]
    rows += rows[5:9]
    judged = keys.with_verdicts(
        spark.createDataFrame(rows, "id string, n int, customer_id string"), "id",
        {"customer_id": spark.createDataFrame([(f"C{k}",) for k in range(8)], "customer_id string")},
        spark.createDataFrame([("K3",), ("K3",), (None,), ("Z",)], "id string"))
    got = Counter((r.verdict, r.id, r.n, r.customer_id) for r in judged.collect())
    assert len(plans) >= 2 and not any("Exchange" in text for text in plans)
    sound = [row for row in rows if row[2] in {f"C{k}" for k in range(8)}]
    first = {i: min((n, c) for j, n, c in sound if j == i) for i, _, _ in sound if i not in (None, "K3")}
    want = Counter(("kept", i, *rest) for i, rest in first.items())
    want += Counter(("orphan", *row) for row in rows if row not in sound)
    want += Counter(("duplicate", *row) for row in sound) - Counter(("duplicate", i, *rest) for i, rest in first.items())
    assert got == want
