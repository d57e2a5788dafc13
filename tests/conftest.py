from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from kohort.session import checkpoint_dir, get_session

    # catalog tables (bucketed layout tests) live in a scratch folder
    warehouse = tempfile.mkdtemp(prefix="kohort-warehouse-")
    s = get_session("local[4]", app="kohort-tests", shuffle_partitions=4,
                    extra={"spark.sql.warehouse.dir": warehouse})
    checkpoint_dir(s)  # unset in tests: a scratch folder is registered
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tmpdir_session():
    return tempfile.mkdtemp(prefix="kohort-test-")


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


SUBS_SCHEMA = ("subscription_id bigint, customer_id bigint, subscription_type string, "
               "contract_length string, start_date date, end_date date, is_active boolean")
INV_SCHEMA = ("invoice_id bigint, subscription_id bigint, invoice_date date, "
              "amount decimal(18,2), paid_late boolean, status string")


@pytest.fixture
def make_subs(spark):
    def f(rows):
        return spark.createDataFrame(rows, SUBS_SCHEMA)
    return f


@pytest.fixture
def make_inv(spark):
    def f(rows):
        return spark.createDataFrame(rows, INV_SCHEMA)
    return f
