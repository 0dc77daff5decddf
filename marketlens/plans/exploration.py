"""Section 1: basic exploration (table sizes, samples, date range, entity counts)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.operators.grain import customer_orders
from marketlens.plans.registry import report
from marketlens.sources.mart import Mart

_COUNTED = ("customers", "orders", "order_items", "order_payments", "order_reviews", "products",
            "sellers", "product_category_name_translation", "geolocation")


@report("q1_1_table_counts", sql="\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in _COUNTED) + "\nORDER BY table_name")
def table_counts(m: Mart) -> DataFrame:
    """Row count of each of the nine tables."""
    parts = [m.table(t).agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(t).alias("table_name"), "row_count") for t in _COUNTED]
    return reduce(DataFrame.unionByName, parts).orderBy("table_name")


@report("q1_2_sample_customers", sql="""
SELECT customer_id, customer_unique_id, CAST(customer_zip_code_prefix AS BIGINT) AS customer_zip_code_prefix,
       customer_city, customer_state
FROM customers ORDER BY customer_id LIMIT 10""")
def sample_customers(m: Mart) -> DataFrame:
    """Ten customer records (deterministic: lowest customer_id)."""
    return m.customers.orderBy("customer_id").limit(10)


@report("q1_3_first_orders", sql="""
SELECT * FROM orders ORDER BY order_purchase_timestamp ASC NULLS LAST, order_id LIMIT 10""")
def first_orders(m: Mart) -> DataFrame:
    """The ten earliest orders (NULL purchase time last; ties by order_id)."""
    return m.orders.orderBy(F.col("order_purchase_timestamp").asc_nulls_last(), "order_id").limit(10)


@report("q1_4_order_date_range", sql="""
SELECT MIN(order_purchase_timestamp) AS earliest_order_date, MAX(order_purchase_timestamp) AS latest_order_date
FROM orders""")
def order_date_range(m: Mart) -> DataFrame:
    """Earliest and latest purchase timestamp."""
    ts = F.col("order_purchase_timestamp")
    return m.orders.agg(F.min(ts).alias("earliest_order_date"), F.max(ts).alias("latest_order_date"))


@report("q1_5_entity_counts", sql="""
WITH placed AS (SELECT order_id, customer_id FROM orders SEMI JOIN customers USING (customer_id)),
people AS (SELECT customer_unique_id AS who FROM customers SEMI JOIN placed USING (customer_id)),
sold AS (SELECT product_id, seller_id FROM order_items SEMI JOIN placed USING (order_id))
SELECT (SELECT len(list_distinct(list(who))) FROM people) AS unique_customers, (SELECT COUNT(DISTINCT order_id) FROM placed) AS total_orders,
       (SELECT COUNT(DISTINCT product_id) FROM sold) AS products_sold, (SELECT COUNT(DISTINCT seller_id) FROM sold) AS active_sellers""")
def entity_counts(m: Mart) -> DataFrame:
    """Distinct persons, orders, products sold and active sellers (orders with a customer).

    Each column is counted on its own, narrow: persons and orders never meet the
    items. The items meet the orders once; of what is left, distinct (product,
    seller) pairs serve both item counts, and their exchange is made once. So no
    row is multiplied by the number of columns counted.
    """
    oc = customer_orders(m.customers, m.orders).select("order_id", "customer_unique_id")
    items = m.order_items.select("order_id", "product_id", "seller_id")
    pairs = items.join(oc.select("order_id"), "order_id", "left_semi").select("product_id", "seller_id").distinct()

    def distinct(df: DataFrame, column: str, out: str) -> DataFrame:
        return df.select(column).where(F.col(column).isNotNull()).distinct().agg(F.count(F.lit(1)).alias(out))

    counts = [distinct(oc, "customer_unique_id", "unique_customers"), distinct(oc, "order_id", "total_orders"),
              distinct(pairs, "product_id", "products_sold"), distinct(pairs, "seller_id", "active_sellers")]
    return reduce(lambda a, b: a.crossJoin(F.broadcast(b)), counts)  # one row each
