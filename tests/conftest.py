from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql.types import StructField, StructType

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marketlens.session import build_session  # noqa: E402
from marketlens.sources.mart import Mart  # noqa: E402
from marketlens.sources.schemas import SCHEMAS  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app_name="marketlens-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="marketlens-test-", dir="/tmp")


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def D(x) -> Decimal:
    return Decimal(str(x))


_DEFAULTS = {
    "customers": {"customer_zip_code_prefix": 1000, "customer_city": "city", "customer_state": "SP"},
    "orders": {"order_status": "delivered", "order_purchase_timestamp": ts("2020-01-10 10:00:00"),
               "order_approved_at": None, "order_delivered_carrier_date": None,
               "order_delivered_customer_date": None, "order_estimated_delivery_date": None},
    "order_items": {"order_item_id": 1, "product_id": "p1", "seller_id": "s1", "shipping_limit_date": None,
                    "price": D("10.00"), "freight_value": D("1.00")},
    "products": {"product_category_name": "cat", "product_name_length": 10, "product_description_length": 100,
                 "product_photos_qty": 1, "product_weight_g": D(1), "product_length_cm": D(1),
                 "product_height_cm": D(1), "product_width_cm": D(1)},
    "sellers": {"seller_zip_code_prefix": 2000, "seller_city": "scity", "seller_state": "SP"},
    "order_payments": {"payment_sequential": 1, "payment_type": "credit_card", "payment_installments": 1,
                       "payment_value": D("11.00")},
    "order_reviews": {"review_score": 5, "review_comment_title": None, "review_comment_message": None,
                      "review_creation_date": None, "review_answer_timestamp": None},
    "product_category_name_translation": {"product_category_name_english": None},
    "geolocation": {"geolocation_lat": D(0), "geolocation_lng": D(0), "geolocation_city": "c",
                    "geolocation_state": "SP"},
}


def nullable(schema: StructType) -> StructType:
    return StructType([StructField(f.name, f.dataType, True, f.metadata) for f in schema.fields])


def make_mart(spark, **tables) -> Mart:
    """A mart from row dicts; unspecified columns take defaults, unspecified tables are empty."""
    frames = {}
    for name, schema in SCHEMAS.items():
        rows = []
        for r in tables.get(name, []):
            full = {**_DEFAULTS.get(name, {}), **r}
            rows.append(tuple(full.get(f.name) for f in schema.fields))
        # As stored tables are: whether a column has values is a rule, not a property of the frame.
        frames[name] = spark.createDataFrame(rows, nullable(schema))
    return Mart.from_frames(spark, frames)


def collect(df):
    return [r.asDict() for r in df.collect()]
