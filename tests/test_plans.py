"""The physical plans keep what the design relies on."""

import re

import pytest
from pyspark.sql import functions as F

from txn_analytics.operators import anomalies, measures as m, quality, ranking, trend
from txn_analytics.operators.blocks import Rank, with_ranks
from txn_analytics.sources import files, retail_tables

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def fact(spark, tmp_path_factory):
    """The model's fact table, written by month."""
    path = str(tmp_path_factory.mktemp("plans") / "fact")
    files.write_table(retail_tables.transactions(spark, FOLDER), path)
    return files.read_table(spark, path)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> list[str]:
    return re.findall(r"Exchange (\w+)", plan(df))


def test_filter_and_columns_reach_the_scan(fact):
    text = plan(m.measures(fact, ["branch"]))
    assert "PushedFilters: [IsNotNull(status), Not(EqualTo(status,Failed))]" in text
    read = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert sorted(column.split(":")[0] for column in read.split(",") if ":" in column) == ["amount", "branch", "status"]


def test_stored_status_reaches_the_orders_scan(spark):
    text = plan(m.measures(retail_tables.transactions(spark, FOLDER, ["amount", "status"], include_failed=False)))
    assert "Not(EqualTo(o_orderstatus,F))" in text
    assert "part.parquet" not in text and "customer.parquet" not in text


def test_only_needed_lookups_are_joined(spark):
    assert "Join" not in plan(retail_tables.transactions(spark, FOLDER, ["date", "transaction_type"]))


def test_grouping_takes_one_shuffle_with_partial_aggregation(fact):
    text = plan(m.measures(fact, ["segment", "branch"]))
    assert text.count("Exchange") == 1 and "partial_sum(amount" in text


def test_flagging_never_shuffles_the_rows(fact):
    flagged = anomalies.flag_anomalies(fact)
    assert "BroadcastHashJoin" in plan(flagged)
    assert not [kind for kind in exchanges(flagged) if kind != "HashedRelationBroadcastMode"]


def test_top_k_is_cut_before_the_shuffle(fact):
    assert "TakeOrderedAndProject(limit=10" in plan(ranking.top_k(fact, ["customer_id"]))
    within = ranking.top_k_within(fact, "branch")
    assert plan(within).count("WindowGroupLimit") == 2


def test_ranks_in_blocks_have_no_single_task(spark, fact):
    volumes = m.measures(fact, ["customer_id"]).select("customer_id", "total_volume")
    ranked = with_ranks(volumes, "total_volume", ["customer_id"], [Rank("place"), Rank("number", "number")], 20)
    assert "SinglePartition" not in plan(ranked)
    # Both ranks are read from one layout: one shuffle by block.
    assert exchanges(ranked).count("hashpartitioning") == 1


def test_single_task_windows_see_months_only(fact):
    text = plan(trend.month_over_month(fact))
    # Below the single-partition exchange there is the final aggregate: one row per month.
    assert re.search(r"Exchange SinglePartition[^\n]*\n\s*\+- HashAggregate\(keys=\[_period", text)


def test_lag_is_computed_once(fact):
    assert plan(trend.month_over_month(fact)).count("lag(") == 1


def test_period_opens_only_its_months(fact):
    rows = files.extract(fact, "1998-01-01", "1998-03-31")
    assert "PartitionFilters: [isnotnull(load_month" in plan(rows)
    assert rows.agg(F.count("*")).collect()[0][0] == fact.filter(
        "status != 'Failed' and date between '1998-01-01' and '1998-03-31'").count()


def test_exact_profile_counts_each_column_alone(spark):
    """One pass over all distinct values at once sorts as many copies of a row as there are columns, in every task."""
    df = spark.sql(
        "SELECT * FROM VALUES ('b', -1.5D, DATE'2024-01-02'), ('a', double('NaN'), NULL), ('b', -0.0D, NULL), (NULL, 0.0D, NULL) AS t(s, d, day)")
    profile = quality.profile_columns(df, "t", exact=True)
    assert not re.search(r"Expand|- Sort ", plan(profile))
    assert [tuple(row) for row in profile.collect()] == [
        ("t", 1, "s", "string", 1, 2, "a", "b"), ("t", 2, "d", "double", 0, 3, "-1.5", "NaN"),
        ("t", 3, "day", "date", 3, 1, "2024-01-02", "2024-01-02")]
    empty = [(row.nulls, row.distinct_values, row.smallest) for row in quality.profile_columns(df.limit(0), "t", exact=True).collect()]
    assert empty == [(0, 0, None)] * 3
