import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidepanel.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session("8", "tests")


@pytest.fixture
def work(tmp_path):
    return str(tmp_path)


def day(n, start="2019-01-01"):
    return dt.date.fromisoformat(start) + dt.timedelta(days=n)


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)
