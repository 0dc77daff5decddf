"""Logical schema of the nine marketplace tables.

One registry serves reading, validating and writing: every table has one
``StructType`` (declared types, never inferred), table/column descriptions
stored as field metadata, and a load specification for CSV sources.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results.
# ---------------------------------------------------------------------------
ORDER_STATUSES = (
    "approved", "canceled", "created", "delivered",
    "invoiced", "processing", "shipped", "unavailable",
)
PAYMENT_TYPES = ("boleto", "credit_card", "debit_card", "not_defined", "voucher")
DELIVERED = "delivered"
UNKNOWN_CATEGORY = "Unknown"

# Table order = parents before children (the order tables are loaded in).
TABLE_ORDER = (
    "product_category_name_translation", "customers", "sellers", "products",
    "orders", "order_items", "order_payments", "order_reviews", "geolocation",
)

# What the tables and two of their columns hold (stored with published tables).
TABLE_COMMENTS = {
    "customers": "One row per order-level customer record, with the person it belongs to and an address area.",
    "orders": "One row per order: status and the times of its steps from purchase to delivery.",
    "order_items": "One row per unit sold: order, product, seller, price and freight.",
    "order_payments": "One row per payment of an order: kind, instalments and amount.",
    "order_reviews": "One row per review of an order: score, comment texts and times.",
    "products": "One row per product: category, text lengths, photo count, weight and size.",
    "sellers": "One row per seller with an address area.",
    "product_category_name_translation": "English name of each product category.",
    "geolocation": "Coordinates seen for postal-code areas, several per area.",
}
COLUMN_COMMENTS = {
    ("customers", "customer_id"): "Customer record of a single order; a person has a new one with every order.",
    ("customers", "customer_unique_id"): "The person behind the customer records.",
}


def with_comments(df, table: str):
    """The DataFrame with the declared column descriptions as field metadata (Parquet and catalog tables keep them)."""
    for f in SCHEMAS[table].fields:
        if f.metadata and f.name in df.columns:
            df = df.withMetadata(f.name, f.metadata)
    return df

# Declared maximum length of VARCHAR(n) / CHAR(n) columns (checked as a rule).
MAX_LENGTHS = {
    "product_category_name_translation": {"product_category_name": 100, "product_category_name_english": 100},
    "customers": {"customer_id": 32, "customer_unique_id": 32, "customer_city": 100, "customer_state": 2},
    "sellers": {"seller_id": 32, "seller_city": 100, "seller_state": 2},
    "products": {"product_id": 32, "product_category_name": 100},
    "orders": {"order_id": 32, "customer_id": 32, "order_status": 30},
    "order_items": {"order_id": 32, "product_id": 32, "seller_id": 32},
    "order_payments": {"order_id": 32, "payment_type": 30},
    "order_reviews": {"review_id": 32, "order_id": 32},
    "geolocation": {"geolocation_city": 100, "geolocation_state": 2},
}


def _f(table: str, name: str, dtype: T.DataType, nullable: bool = True) -> T.StructField:
    meta = {}
    comment = COLUMN_COMMENTS.get((table, name))
    if comment:
        meta["comment"] = comment
    return T.StructField(name, dtype, nullable, meta)


def _schema(table: str, cols: list[tuple]) -> T.StructType:
    return T.StructType([_f(table, *c) for c in cols])


S, I, L, TS = T.StringType(), T.IntegerType(), T.LongType(), T.TimestampNTZType()
DIM = T.DecimalType(10, 2)
MONEY = T.DecimalType(12, 2)
GEO = T.DecimalType(10, 7)

SCHEMAS: dict[str, T.StructType] = {
    "product_category_name_translation": _schema("product_category_name_translation", [
        ("product_category_name", S, False), ("product_category_name_english", S)]),
    "customers": _schema("customers", [
        ("customer_id", S, False), ("customer_unique_id", S, False),
        ("customer_zip_code_prefix", I), ("customer_city", S), ("customer_state", S)]),
    "sellers": _schema("sellers", [
        ("seller_id", S, False), ("seller_zip_code_prefix", I), ("seller_city", S), ("seller_state", S)]),
    "products": _schema("products", [
        ("product_id", S, False), ("product_category_name", S),
        ("product_name_length", I), ("product_description_length", I), ("product_photos_qty", I),
        ("product_weight_g", DIM), ("product_length_cm", DIM), ("product_height_cm", DIM),
        ("product_width_cm", DIM)]),
    "orders": _schema("orders", [
        ("order_id", S, False), ("customer_id", S, False), ("order_status", S, False),
        ("order_purchase_timestamp", TS), ("order_approved_at", TS), ("order_delivered_carrier_date", TS),
        ("order_delivered_customer_date", TS), ("order_estimated_delivery_date", TS)]),
    "order_items": _schema("order_items", [
        ("order_id", S, False), ("order_item_id", I, False), ("product_id", S, False),
        ("seller_id", S, False), ("shipping_limit_date", TS), ("price", MONEY, False),
        ("freight_value", MONEY, False)]),
    "order_payments": _schema("order_payments", [
        ("order_id", S, False), ("payment_sequential", I, False), ("payment_type", S, False),
        ("payment_installments", I, False), ("payment_value", MONEY, False)]),
    "order_reviews": _schema("order_reviews", [
        ("review_id", S, False), ("order_id", S, False), ("review_score", I, False),
        ("review_comment_title", S), ("review_comment_message", S),
        ("review_creation_date", TS), ("review_answer_timestamp", TS)]),
    "geolocation": _schema("geolocation", [
        ("geolocation_id", L, False), ("geolocation_zip_code_prefix", I, False),
        ("geolocation_lat", GEO), ("geolocation_lng", GEO),
        ("geolocation_city", S), ("geolocation_state", S)]),
}

PRIMARY_KEYS = {
    "product_category_name_translation": ("product_category_name",),
    "customers": ("customer_id",),
    "sellers": ("seller_id",),
    "products": ("product_id",),
    "orders": ("order_id",),
    "order_items": ("order_id", "order_item_id"),
    "order_payments": ("order_id", "payment_sequential"),
    "order_reviews": ("review_id", "order_id"),
    "geolocation": ("geolocation_id",),
}

# Foreign keys: (name, child table, child column, parent table, parent column).
FOREIGN_KEYS = (
    ("fk_products_category", "products", "product_category_name",
     "product_category_name_translation", "product_category_name"),
    ("fk_orders_customer", "orders", "customer_id", "customers", "customer_id"),
    ("fk_order_items_order", "order_items", "order_id", "orders", "order_id"),
    ("fk_order_items_product", "order_items", "product_id", "products", "product_id"),
    ("fk_order_items_seller", "order_items", "seller_id", "sellers", "seller_id"),
    ("fk_order_payments_order", "order_payments", "order_id", "orders", "order_id"),
    ("fk_order_reviews_order", "order_reviews", "order_id", "orders", "order_id"),
)


@dataclass(frozen=True)
class LoadSpec:
    """How one CSV source maps onto one table."""
    file: str
    table: str
    multi_line: bool = False  # quoted free text with line breaks
    renames: dict[str, str] = field(default_factory=dict)
    generated: tuple[str, ...] = ()  # columns the sink generates (not read)

    @property
    def schema(self) -> T.StructType:
        return SCHEMAS[self.table]

    @property
    def source_columns(self) -> list[str]:
        return [f.name for f in self.schema.fields if f.name not in self.generated]


# One CSV export per table, found as ``<table>.csv`` unless the caller maps
# other file names (``run_ingest(..., file_names={...})``). The product export
# spells two headers "lenght"; both spellings are accepted.
LOAD_PLAN: tuple[LoadSpec, ...] = (
    LoadSpec("product_category_name_translation.csv", "product_category_name_translation"),
    LoadSpec("customers.csv", "customers"),
    LoadSpec("sellers.csv", "sellers"),
    LoadSpec("products.csv", "products",
             renames={"product_name_lenght": "product_name_length",
                      "product_description_lenght": "product_description_length"}),
    LoadSpec("orders.csv", "orders"),
    LoadSpec("order_items.csv", "order_items"),
    LoadSpec("order_payments.csv", "order_payments"),
    LoadSpec("order_reviews.csv", "order_reviews", multi_line=True),
    LoadSpec("geolocation.csv", "geolocation", generated=("geolocation_id",)),
)

LOAD_PLAN_BY_TABLE = {spec.table: spec for spec in LOAD_PLAN}
