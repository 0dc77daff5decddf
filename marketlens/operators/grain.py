"""Grain discipline: order-level pre-aggregation and the common star joins.

Items and payments are both children of an order; joining them directly
multiplies rows. Every report that needs order value starts from the items
aggregated to order grain (``order_summary``, published once with the mart):
the partial aggregate runs before the shuffle, so the exchange carries one
row per order and partition, not one row per item.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions import category_label, item_value
from marketlens.sources.schemas import DELIVERED


#: Items that one task groups by order, about.
ITEMS_PER_TASK = 250_000


def dealt_by_order(items: DataFrame, *others: DataFrame) -> tuple[DataFrame, ...]:
    """The tables, dealt out alike by order_id over tasks of about ITEMS_PER_TASK items.

    Left to Spark, the number of tasks stays the same while the tables grow, and each
    aggregate of the stage holds a share of all orders. While the default number of tasks
    is enough, nothing is dealt out. The rows are counted from the files' footers.
    """
    tasks = -(-items.count() // ITEMS_PER_TASK)
    if tasks <= items.sparkSession.sparkContext.defaultParallelism:
        return items, *others
    return tuple(t.repartition(tasks, "order_id") for t in (items, *others))


def delivered(orders: DataFrame) -> DataFrame:
    """Orders with status 'delivered' (equality filter; pushed into the scan)."""
    return orders.where(F.col("order_status") == DELIVERED)


def order_summary(items: DataFrame) -> DataFrame:
    """The order-grain relation most reports start from (materialised by ``Mart.write``).

    order_id -> item_count (rows), item_id_count (non-NULL item ids),
    product_value, freight_value, total_order_value (exact DECIMAL sums;
    the total is summed per item so a NULL part is handled as in SQL).
    """
    return items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("item_count"), F.count("order_item_id").alias("item_id_count"),
        F.sum("price").alias("product_value"), F.sum("freight_value").alias("freight_value"),
        F.sum(item_value()).alias("total_order_value"))


def order_category_counts(items: DataFrame, products: DataFrame) -> DataFrame:
    """order_id, product_category_name -> item_count: how many items of a category an order has (published by ``Mart.write``).

    Items are counted per order and product before they meet the products; an item of an unknown product counts nowhere.
    """
    per_product = items.groupBy("order_id", "product_id").agg(F.count(F.lit(1)).alias("n"))
    return (per_product.join(products.select("product_id", "product_category_name"), "product_id")
            .groupBy("order_id", "product_category_name").agg(F.sum("n").alias("item_count")))


def delivered_items(items: DataFrame, orders: DataFrame, *order_cols: str) -> DataFrame:
    """Items of delivered orders, with the requested order columns attached."""
    o = delivered(orders).select("order_id", *order_cols)
    return items.join(o, "order_id")


def labeled_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """product_id -> product_category (English, else native, else 'Unknown').

    The lookup is a left join; Spark broadcasts the lookup when its measured
    size is under the broadcast threshold (AQE re-checks at run time) and
    falls back to a shuffle join otherwise.
    """
    t = translation.select("product_category_name", "product_category_name_english")
    p = products.select("product_id", "product_category_name")
    return (p.join(t, "product_category_name", "left")
             .select("product_id", category_label().alias("product_category")))


def with_category(rows: DataFrame, products: DataFrame, translation: DataFrame) -> DataFrame:
    """Attach ``product_category`` to rows carrying ``product_id`` (inner join to products).

    Joined in two steps, each against a stored table: rows x products, then
    the lookup. Spark's size check then sees the real size of each table
    (broadcast when small, sort-merge otherwise); a pre-joined labeled
    product relation would be estimated as the product of both sizes and
    never broadcast.
    """
    p = products.select("product_id", "product_category_name")
    t = translation.select("product_category_name", "product_category_name_english")
    return (rows.join(p, "product_id").join(t, "product_category_name", "left")
            .withColumn("product_category", category_label())
            .drop("product_category_name", "product_category_name_english"))


def customer_orders(customers: DataFrame, orders: DataFrame, *order_cols: str) -> DataFrame:
    """orders joined to their customer record (customer_id is per order)."""
    c = customers.select("customer_id", "customer_unique_id")
    return orders.select("order_id", "customer_id", *order_cols).join(c, "customer_id")
