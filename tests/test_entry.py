"""What the driver calls."""

import __spark_entry__ as entry_points
from txn_analytics.queries import QUERIES


def test_entry_gives_the_customer_report(spark):
    report = entry_points.entry(spark)
    assert len(report.columns) == 29 and report.count() > 0


def test_queries_and_sql_have_the_same_names():
    """Queries of the optional subpackage need no SQL where SQL cannot say it."""
    assert QUERIES.keys() <= entry_points.queries().keys()
    assert QUERIES.keys() <= entry_points.oracle_sql().keys() <= entry_points.queries().keys()
