"""States that merge: the same limits, flags and counts whatever the partitions and the order of loads."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from txn_analytics.operators import anomalies, dimensions, states
from txn_analytics.plans import product_report, product_state


@pytest.fixture(scope="module")
def rows(make_transactions):
    chance = random.Random(5)
    return make_transactions(*[{
        "date": f"2024-0{chance.randint(1, 6)}-1{at % 9}", "segment": chance.choice(["Retail", "SME", None]), "customer_id": f"C{chance.randint(0, 90)}" if at % 40 else None,
        "branch": f"B{at % 7}", "product": f"P{at * at % 4}" if at % 3 else "P0", "transaction_type": f"T{at % 5}",
        "status": ["Completed", "Failed", "Pending", "Completed"][at % 4], "amount": str(Decimal(int(chance.lognormvariate(7, 1.5) * 100)) / 100)}
        for at in range(900)] + [{"segment": "Single"}])


def _flags(df):
    return sorted((r.transaction_id, r.is_anomaly) for r in df.collect())


def test_flags_are_the_same_under_any_partitioning(rows):
    expected = _flags(anomalies.flag_anomalies(rows))
    assert sum(flag for _, flag in expected) > 3
    found = []
    for partitions in (1, 7, 200):
        state = states.moments(rows.repartition(partitions))
        found.append(sorted(map(tuple, states.limits(state).collect()), key=repr))
        assert _flags(anomalies.flag_anomalies(rows, moments=state)) == expected
    assert found[0] == found[1] == found[2] and ("Single", None) in found[0]


def test_moments_of_months_and_loads_merge(rows):
    whole = states.moments(rows)
    half = F.substring("transaction_id", 2, 6).cast("int") % 2 == 0
    parts = states.moments(rows.filter(half)).unionByName(states.moments(rows.filter(~half)))
    by = ["segment", "month_start"]
    assert sorted(map(tuple, states.merged_moments(parts, by).collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)
    assert sorted(map(tuple, states.limits(parts).collect()), key=repr) == sorted(map(tuple, states.limits(whole).collect()), key=repr)
    assert states.limits(states.moments(rows.limit(0))).count() == 0


def test_product_report_from_states_of_months(spark, rows):
    flagged = anomalies.flag_anomalies(rows)
    numbers = {c: dimensions.name_dimension(rows.select(c), c, "number", "name") for c in product_state.FEW.values()}
    holders = dimensions.name_dimension(rows.select("customer_id"), "customer_id", "number", "name")
    # Two loads, the second of which has months of its own and one that the first has too.
    first = product_state.product_state(flagged.filter("date < '2024-03-13'"), holders, numbers)
    second = product_state.product_state(flagged.filter("date >= '2024-03-13'"), holders, numbers)
    report = product_state.report_from_state(first.unionByName(second), "2024-07-01")
    expected = product_report.product_report(flagged, "2024-07-01")
    assert report.columns == expected.columns and report.collect() == expected.collect()
    plan = product_state.product_state(flagged, holders, numbers)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_bitmaps_count_numbers_of_many_buckets(spark):
    df = spark.range(200_000).selectExpr("id % 3 AS g", "1 + (id * 7919) % 150000 AS a", "1 + id % 11 AS b")
    state = states.bitmaps(df, ["g"], "a", {"b": "b"}, {"rows": F.count("*")})
    got = {r.g: (r.a, r.b, r.rows) for r in states.distinct_counts(state, ["g"], "a", ["b"], {"rows": F.sum}).collect()}
    assert got == {r.g: (r.a, r.b, r.n) for r in df.groupBy("g").agg(
        F.countDistinct("a").alias("a"), F.countDistinct("b").alias("b"), F.count("*").alias("n")).collect()}


def test_too_many_values_for_one_bitmap_are_refused(spark, rows):
    numbers = {c: spark.createDataFrame([(40_000, "x")], "number int, name string") for c in product_state.FEW.values()}
    with pytest.raises(ValueError):
        product_state.product_state(rows, numbers["branch"], numbers)
