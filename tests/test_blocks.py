"""Ranks and running totals over many small blocks agree with plain windows."""

import random
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from txn_analytics.operators.blocks import Rank, ordered_blocks, with_ranks, with_running_sums
from txn_analytics.operators.ranking import global_rank, rank_within_segment
from txn_analytics.operators.running import running_by_customer

RANKS = [
    Rank("r"), Rank("d", "dense"), Rank("n", "number"),
    Rank("gr", within=("g",)), Rank("gd", "dense", ("g",)), Rank("gn", "number", ("g",)),
]


def _plain(df):
    falling = F.col("v").desc()
    everywhere, group = Window.orderBy(falling), Window.partitionBy("g").orderBy(falling)
    return (
        df.withColumn("r", F.rank().over(everywhere)).withColumn("d", F.dense_rank().over(everywhere))
        .withColumn("n", F.row_number().over(Window.orderBy(falling, "k")))
        .withColumn("gr", F.rank().over(group)).withColumn("gd", F.dense_rank().over(group))
        .withColumn("gn", F.row_number().over(Window.partitionBy("g").orderBy(falling, "k")))
    )


def _same(left, right):
    assert sorted(map(tuple, left.select(sorted(left.columns)).collect()), key=repr) == \
        sorted(map(tuple, right.select(sorted(right.columns)).collect()), key=repr)


def _check_ranks(spark, rows, blocks):
    df = spark.createDataFrame(rows, "k int, g string, v int")
    _same(with_ranks(df, "v", ["k"], RANKS, blocks), _plain(df))


def test_ranks_where_one_value_fills_many_blocks(spark):
    chance = random.Random(7)
    rows = [(k, chance.choice("ab"), 5 if k % 3 else chance.randint(0, 9)) for k in range(400)]
    _check_ranks(spark, rows, 25)


def test_ranks_where_null_fills_many_blocks(spark):
    _check_ranks(spark, [(k, "ab"[k % 2], None if k % 3 == 0 else k % 4) for k in range(60)], 9)


def test_ranks_where_all_values_are_equal(spark):
    _check_ranks(spark, [(k, "a" if k % 5 else None, 1) for k in range(100)], 10)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 5))), min_size=20, max_size=60))
def test_ranks_of_any_rows(spark, pairs):
    _check_ranks(spark, [(k, g, v) for k, (g, v) in enumerate(pairs)], 7)


def test_ties_rank_alike(make_transactions):
    rows = make_transactions(
        {"customer_id": "A", "amount": "10"}, {"customer_id": "B", "amount": "10"}, {"customer_id": "C", "amount": "5"})
    for blocks in (1, 3, None):
        got = {row[0]: tuple(row[3:]) for row in global_rank(rows, blocks).collect()}
        assert got == {"A": (1, 1, 1), "B": (1, 1, 2), "C": (3, 2, 3)}


def test_rank_within_segment_in_blocks(make_transactions):
    rows = make_transactions(*[
        {"customer_id": f"C{at:03d}", "segment": "SME" if at % 4 else "Retail", "amount": str(at % 17)}
        for at in range(120)])
    _same(rank_within_segment(rows, 20), rank_within_segment(rows))


@pytest.fixture(scope="module")
def skewed(make_transactions):
    """One customer with a third of the rows, most of them on one day."""
    chance = random.Random(3)
    rows = []
    for at in range(600):
        hot = at % 3 == 0
        day = 10 if hot and at % 5 else chance.randint(1, 28)
        rows.append({"customer_id": "HOT" if hot else f"C{chance.randint(0, 40)}", "date": f"2024-02-{day:02d}",
                     "amount": str(Decimal(chance.randint(0, 99999)) / 100)})
    return make_transactions(*rows)


def _plain_running(df):
    so_far = Window.partitionBy("customer_id").orderBy("date", "transaction_id").rowsBetween(Window.unboundedPreceding, 0)
    return df.select(
        "customer_id", "segment", "date", "transaction_id", "amount", F.sum("amount").over(so_far).alias("running_total"),
        F.round(F.sum("amount").over(so_far) / F.count("*").over(so_far), 6).cast("decimal(30,6)").alias("running_avg"))


def test_running_totals_of_a_hot_and_a_null_customer(skewed):
    rows = skewed.withColumn("customer_id", F.when(F.col("customer_id") != "C7", F.col("customer_id"))).withColumn(
        "amount", F.when(F.col("transaction_id") > "T000009", F.col("amount")))
    running = running_by_customer(rows)
    _same(running.withColumn("running_avg", F.col("running_avg").cast("decimal(30,6)")), _plain_running(rows))
    plan = running._jdf.queryExecution().optimizedPlan().toString()
    assert "customer_id" in plan and rows.filter("customer_id IS NULL").count() > 0


def test_last_running_total_is_the_volume(skewed):
    totals = running_by_customer(skewed).groupBy("customer_id").agg(
        F.max("running_total").alias("total"))
    volumes = skewed.groupBy("customer_id").agg(F.sum("amount").alias("total"))
    _same(totals, volumes)


@pytest.mark.parametrize("blocks", [2, 9, 40])
def test_running_totals_where_one_day_has_nearly_all_rows(spark, make_transactions, blocks):
    chance = random.Random(blocks)
    rows = make_transactions(*[{
        "customer_id": None if at % 3 == 0 else "HOT" if at % 25 else f"C{chance.randint(0, 9)}", "date": "2024-02-10" if at % 17 else "2024-02-11",
        "amount": str(Decimal(chance.randint(0, 99999)) / 100)} for at in range(500)])
    rows = rows.withColumn("amount", F.when(F.substring("transaction_id", 2, 6).cast("int") % 5 != 0, F.col("amount"))) if blocks == 9 else rows
    running = running_by_customer(rows, blocks)
    _same(running.withColumn("running_avg", F.col("running_avg").cast("decimal(30,6)")), _plain_running(rows))


def test_running_sums_spread_a_hot_day_over_the_blocks(spark):
    rows = spark.range(4000).selectExpr("'HOT' AS g", "1 AS day", "id", "cast(1 AS decimal(10,2)) AS v")
    summed = with_running_sums(rows, "g", ["day", "id"], {"total": "v"}, 16)
    assert summed.filter("total <> id + 1 OR _seen <> id + 1").count() == 0 and summed.columns == ["g", "day", "id", "v", "total", "_seen"]
    sizes = [r["count"] for r in ordered_blocks(rows, ["g", "day", "id"], 16).groupBy("_block").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 4 * 4000 / 16
    assert with_running_sums(rows.limit(0), "g", ["day", "id"], {"total": "v"}).count() == 0


def test_ranks_alike_share_one_summary(spark):
    df = spark.range(500).selectExpr("id AS k", "id % 7 AS v", "id % 3 AS g")
    ranked = with_ranks(df, "v", ["k"], [Rank("a"), Rank("b", "dense"), Rank("c", "number")], 8)
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and ranked.columns == ["k", "v", "g", "a", "b", "c"]
    physical = ranked._jdf.queryExecution().executedPlan().toString()
    assert physical.count("Sort [") == 1      # the order of the numbers serves the other ranks too
