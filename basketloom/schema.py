"""Column groups, input schemas and the missing-column check."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

QUERY_KEYS = ["kiosk_id", "anchor_product_id"]
PAIR_KEYS = ["anchor_product_id", "candidate_product_id"]
ROW_KEYS = ["kiosk_id", "anchor_product_id", "candidate_product_id"]

# Columns of the raw order files.
RAW_ORDER_COLUMNS = ["documenttype", "orderid", "userid", "productid", "orderdt", "quantity"]
ORDER_KEY_COLUMNS = ["order_id", "kiosk_id", "product_id", "order_dt"]

# Fixed value: stands for an absent category in model features.
MISSING_CATEGORY = "__MISSING__"

# Numeric columns of the raw order files; every other column is text.
RAW_ORDER_NUMBERS = ["quantity", "priceperunit", "tax", "discountperunit", "discountedpriceperunit"]

PRODUCT_TYPES = {"productid": T.StringType(), "name": T.StringType(), "category": T.StringType(),
                 "blocked": T.StringType()}
COMMERCE_TYPES = {"userid": T.StringType(), "channel": T.StringType(), "region": T.StringType(),
                  "active": T.BooleanType()}


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    absent = [name for name in names if name not in df.columns]
    if absent:
        raise ValueError(f"Missing required columns: {', '.join(absent)}")
