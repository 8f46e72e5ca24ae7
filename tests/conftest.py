import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from basketloom.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(4, "3g")


@pytest.fixture(scope="session")
def data_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def order_lines(spark):
    """Order lines from (kiosk, order, product, time) tuples."""
    def make(rows):
        full = [(o, k, p, t, 1.0) for k, o, p, t in rows]
        df = spark.createDataFrame(full, "order_id string, kiosk_id string, product_id string, t string, quantity double")
        return df.selectExpr("order_id", "kiosk_id", "product_id", "cast(t as timestamp_ntz) as order_dt", "quantity")
    return make


def rows_of(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)
