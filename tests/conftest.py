import os
import sys
from datetime import date
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from txn_analytics import model  # noqa: E402
from txn_analytics.cluster import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, partitions=4, app="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_transactions(spark):
    """Transactions from dicts; what a dict leaves out gets a plain value."""
    def make(*rows):
        full = []
        for at, row in enumerate(rows):
            base = {"transaction_id": f"T{at:06d}", "date": "2024-01-15", "customer_id": "C1", "segment": "Retail",
                    "branch": "North", "product": "Savings", "transaction_type": "Deposit", "category": "Cash",
                    "amount": "10.00", "status": "Completed"}
            base.update(row)
            base["date"] = date.fromisoformat(base["date"])
            base["amount"] = Decimal(base["amount"])
            full.append(tuple(base[name] for name in model.TRANSACTIONS.fieldNames()))
        return spark.createDataFrame(full, model.TRANSACTIONS)
    return make


@pytest.fixture(scope="session")
def make_customers(spark):
    def make(*rows):
        return spark.createDataFrame(
            [(name, "Retail", "North", date.fromisoformat(joined)) for name, joined in rows], model.CUSTOMERS)
    return make
