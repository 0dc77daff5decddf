"""Section 2: data-quality validation queries (duplicates, orphans, bad values, NULLs)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.operators.quality import duplicates, orphans
from marketlens.plans.registry import report
from marketlens.sources.mart import Mart


@report("q2_1_dup_customers", sql="""
SELECT customer_id, COUNT(*) AS duplicate_count FROM customers GROUP BY customer_id HAVING COUNT(*) > 1""")
def dup_customers(m: Mart) -> DataFrame:
    """customer_id values occurring more than once."""
    return duplicates(m.customers, ["customer_id"])


@report("q2_2_dup_orders", sql="""
SELECT order_id, COUNT(*) AS duplicate_count FROM orders GROUP BY order_id HAVING COUNT(*) > 1""")
def dup_orders(m: Mart) -> DataFrame:
    """order_id values occurring more than once."""
    return duplicates(m.orders, ["order_id"])


@report("q2_3_dup_order_items", sql="""
SELECT order_id, CAST(order_item_id AS BIGINT) AS order_item_id, COUNT(*) AS duplicate_count
FROM order_items GROUP BY order_id, order_item_id HAVING COUNT(*) > 1""")
def dup_order_items(m: Mart) -> DataFrame:
    """(order_id, order_item_id) keys occurring more than once."""
    return duplicates(m.order_items, ["order_id", "order_item_id"])


@report("q2_4_dup_payments", sql="""
SELECT order_id, CAST(payment_sequential AS BIGINT) AS payment_sequential, COUNT(*) AS duplicate_count
FROM order_payments GROUP BY order_id, payment_sequential HAVING COUNT(*) > 1""")
def dup_payments(m: Mart) -> DataFrame:
    """(order_id, payment_sequential) keys occurring more than once."""
    return duplicates(m.order_payments, ["order_id", "payment_sequential"])


@report("q2_5_orders_without_customer", sql="""
SELECT o.order_id, o.customer_id FROM orders AS o
LEFT JOIN customers AS c ON o.customer_id = c.customer_id WHERE c.customer_id IS NULL""")
def orders_without_customer(m: Mart) -> DataFrame:
    """Orders whose customer_id has no customer record."""
    return orphans(m.orders, m.customers, "customer_id").select("order_id", "customer_id")


@report("q2_6_items_without_order", sql="""
SELECT oi.order_id, CAST(oi.order_item_id AS BIGINT) AS order_item_id FROM order_items AS oi
LEFT JOIN orders AS o ON oi.order_id = o.order_id WHERE o.order_id IS NULL""")
def items_without_order(m: Mart) -> DataFrame:
    """Order items whose order does not exist."""
    return orphans(m.order_items, m.orders, "order_id").select("order_id", "order_item_id")


@report("q2_7_items_without_product", sql="""
SELECT oi.order_id, CAST(oi.order_item_id AS BIGINT) AS order_item_id, oi.product_id FROM order_items AS oi
LEFT JOIN products AS p ON oi.product_id = p.product_id WHERE p.product_id IS NULL""")
def items_without_product(m: Mart) -> DataFrame:
    """Order items whose product does not exist."""
    return orphans(m.order_items, m.products, "product_id").select("order_id", "order_item_id", "product_id")


@report("q2_8_items_without_seller", sql="""
SELECT oi.order_id, CAST(oi.order_item_id AS BIGINT) AS order_item_id, oi.seller_id FROM order_items AS oi
LEFT JOIN sellers AS s ON oi.seller_id = s.seller_id WHERE s.seller_id IS NULL""")
def items_without_seller(m: Mart) -> DataFrame:
    """Order items whose seller does not exist."""
    return orphans(m.order_items, m.sellers, "seller_id").select("order_id", "order_item_id", "seller_id")


@report("q2_9_negative_money", sql="""
SELECT order_id, CAST(order_item_id AS BIGINT) AS order_item_id,
       CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value
FROM order_items WHERE price < 0 OR freight_value < 0""")
def negative_money(m: Mart) -> DataFrame:
    """Items with a negative price or freight."""
    i = m.order_items
    return (i.where((F.col("price") < 0) | (F.col("freight_value") < 0))
             .select("order_id", "order_item_id", "price", "freight_value"))


@report("q2_10_invalid_scores", sql="""
SELECT review_id, order_id, CAST(review_score AS BIGINT) AS review_score
FROM order_reviews WHERE review_score NOT BETWEEN 1 AND 5""")
def invalid_scores(m: Mart) -> DataFrame:
    """Reviews with a score outside 1..5 (a NULL score is not reported)."""
    return (m.order_reviews.where(~F.col("review_score").between(1, 5))
             .select("review_id", "order_id", "review_score"))


@report("q2_11_null_timestamps", sql="""
SELECT COUNT(*) AS total_orders,
       COUNT(*) FILTER (WHERE order_purchase_timestamp IS NULL) AS missing_purchase_timestamp,
       COUNT(*) FILTER (WHERE order_approved_at IS NULL) AS missing_approval_timestamp,
       COUNT(*) FILTER (WHERE order_delivered_customer_date IS NULL) AS missing_customer_delivery_timestamp,
       COUNT(*) FILTER (WHERE order_estimated_delivery_date IS NULL) AS missing_estimated_delivery_timestamp
FROM orders""")
def null_timestamps(m: Mart) -> DataFrame:
    """Total orders and NULL counts of four lifecycle timestamps (one pass)."""
    c = lambda name: F.count_if(F.col(name).isNull())
    return m.orders.agg(
        F.count(F.lit(1)).alias("total_orders"),
        c("order_purchase_timestamp").alias("missing_purchase_timestamp"),
        c("order_approved_at").alias("missing_approval_timestamp"),
        c("order_delivered_customer_date").alias("missing_customer_delivery_timestamp"),
        c("order_estimated_delivery_date").alias("missing_estimated_delivery_timestamp"),
    )
