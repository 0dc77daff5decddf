"""Section 15: reusable views (order summary, customer summary, monthly sales).

Views are functions returning lazy DataFrames; ``register_views`` also
publishes them as temporary views for SQL users. Nothing is materialised:
each query recomputes from the base tables, as a database view would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions import month_of, round2
from marketlens.plans.registry import MONEY, MONTH, report
from marketlens.sources.mart import Mart

_TS = "order_purchase_timestamp"

#: Orders with the sums of their items; equal order rows are one row that counts as often as it occurs.
ORDER_VIEW = """lines AS (
    SELECT order_id, COUNT(order_item_id) AS units, SUM(price) AS goods, SUM(freight_value) AS freight,
           SUM(price + freight_value) AS both_parts FROM order_items GROUP BY order_id),
heads AS (SELECT order_id, customer_id, order_status, order_purchase_timestamp, COUNT(*) AS copies FROM orders GROUP BY ALL),
order_view AS (
    SELECT h.* EXCLUDE (copies), COALESCE(copies * units, 0) AS item_count, copies * goods AS product_value,
           copies * freight AS freight_value, copies * both_parts AS total_order_value
    FROM heads h LEFT JOIN lines USING (order_id))"""

PERSON_VIEW = """visits AS (
    SELECT c.customer_unique_id AS who, o.order_id, o.order_status = 'delivered' AS got, o.order_purchase_timestamp AS moment,
           (SELECT SUM(v.total_order_value) FROM order_view v WHERE v.order_id = o.order_id) AS worth
    FROM customers c LEFT JOIN orders o USING (customer_id)),
person_view AS (
    SELECT who AS customer_unique_id, len(list_distinct(list(order_id))) AS total_orders,
           len(list_distinct(list(CASE WHEN got THEN order_id END))) AS delivered_orders,
           MIN(moment) AS first_purchase_date, MAX(moment) AS latest_purchase_date,
           COALESCE(SUM(CASE WHEN got THEN worth END), 0) AS customer_lifetime_value
    FROM visits GROUP BY who)"""

MONTH_VIEW = f"""month_view AS (
    SELECT {MONTH} AS order_month, COUNT(DISTINCT o.order_id) AS delivered_orders, CAST(SUM(l.units) AS BIGINT) AS items_sold,
           SUM(l.goods) AS product_revenue, SUM(l.freight) AS freight_revenue, SUM(l.both_parts) AS total_revenue
    FROM orders o JOIN lines l USING (order_id) WHERE o.order_status = 'delivered' GROUP BY 1)"""


def order_financial_summary(m: Mart) -> DataFrame:
    """Every order with item count (0 without items) and NULL-able value sums.

    Starts from the order summary (items already summed per order), left
    joined to orders and grouped by the order columns as the SQL view is, so
    a duplicated order row adds up the same way. The join output is already
    partitioned by ``order_id``, so the grouping needs no further shuffle.
    """
    ofn = m.order_summary.select("order_id", "item_id_count", "product_value", "freight_value", "total_order_value")
    o = m.orders.select("order_id", "customer_id", "order_status", _TS)
    return (o.join(ofn, "order_id", "left")
            .groupBy("order_id", "customer_id", "order_status", _TS)
            .agg(F.coalesce(F.sum("item_id_count"), F.lit(0)).cast("long").alias("item_count"),
                 F.sum("product_value").alias("product_value"), F.sum("freight_value").alias("freight_value"),
                 F.sum("total_order_value").alias("total_order_value")))


def customer_summary(m: Mart) -> DataFrame:
    """Per person: total and delivered orders, first/latest purchase, delivered lifetime value."""
    # Orders are read once. An order's value counts once per order row that shares its id, as in the view.
    totals = m.order_summary.select("order_id", "total_order_value")
    copies = F.count(F.lit(1)).over(Window.partitionBy("order_id"))
    o = (m.orders.select("order_id", "customer_id", "order_status", _TS).withColumn("copies", copies.cast("decimal(10,0)"))
         .join(totals, "order_id", "left"))
    j = m.customers.select("customer_id", "customer_unique_id").join(o, "customer_id", "left")
    is_dlv = F.col("order_status") == "delivered"
    value = F.when(is_dlv, F.col("total_order_value").cast("decimal(24,2)") * F.col("copies"))
    # Per person and order first, then per person: plain counts instead of two distinct counts.
    per_order = (j.groupBy("customer_unique_id", "order_id")
                 .agg(F.max(is_dlv).alias("dlv"), F.min(_TS).alias("lo"), F.max(_TS).alias("hi"), F.sum(value).alias("value")))
    return (per_order.groupBy("customer_unique_id")
            .agg(F.count("order_id").alias("total_orders"),
                 F.count_if(F.col("dlv") & F.col("order_id").isNotNull()).alias("delivered_orders"),
                 F.min("lo").alias("first_purchase_date"), F.max("hi").alias("latest_purchase_date"),
                 F.coalesce(F.sum("value"), F.lit(0).cast("decimal(12,2)")).alias("customer_lifetime_value")))


def monthly_sales(m: Mart) -> DataFrame:
    """Per purchase month of delivered orders: orders, items, product/freight/total revenue (unrounded)."""
    from marketlens.plans.time_sales import delivered_order_rows
    j = delivered_order_rows(m, month_of(_TS).alias("order_month"))
    return (j.groupBy("order_month")
            .agg(F.count_distinct("order_id").alias("delivered_orders"), F.sum("__n").alias("items_sold"),
                 F.sum("__p").alias("product_revenue"), F.sum("__f").alias("freight_revenue"),
                 F.sum("__t").alias("total_revenue")))


def register_views(m: Mart) -> None:
    """Publish the three views as session temporary views."""
    order_financial_summary(m).createOrReplaceTempView("vw_order_financial_summary")
    customer_summary(m).createOrReplaceTempView("vw_customer_summary")
    monthly_sales(m).createOrReplaceTempView("vw_monthly_sales")


@report("q15_1_order_summary_view", sql=f"""
WITH {ORDER_VIEW}
SELECT * REPLACE (CAST(item_count AS BIGINT) AS item_count, CAST(product_value AS DOUBLE) AS product_value,
                  CAST(freight_value AS DOUBLE) AS freight_value, CAST(total_order_value AS DOUBLE) AS total_order_value)
FROM order_view""")
def order_summary_view(m: Mart) -> DataFrame:
    """The order financial summary view (all orders)."""
    return order_financial_summary(m)


@report("q15_1_top_orders", sql=f"""
WITH {ORDER_VIEW}
SELECT * REPLACE (CAST(item_count AS BIGINT) AS item_count, CAST(product_value AS DOUBLE) AS product_value,
                  CAST(freight_value AS DOUBLE) AS freight_value, CAST(total_order_value AS DOUBLE) AS total_order_value)
FROM order_view ORDER BY order_view.total_order_value DESC NULLS LAST, order_id LIMIT 20""")
def top_orders(m: Mart) -> DataFrame:
    """Top 20 orders by total value (orders without items last; ties by order_id)."""
    return (order_financial_summary(m)
            .orderBy(F.col("total_order_value").desc_nulls_last(), "order_id").limit(20))


@report("q15_2_customer_summary_view", sql=f"""
WITH {ORDER_VIEW}, {PERSON_VIEW}
SELECT * REPLACE (CAST(customer_lifetime_value AS DOUBLE) AS customer_lifetime_value) FROM person_view""")
def customer_summary_view(m: Mart) -> DataFrame:
    """The customer summary view (all persons)."""
    return customer_summary(m)


@report("q15_2_top_customers", sql=f"""
WITH {ORDER_VIEW}, {PERSON_VIEW}
SELECT * REPLACE ({MONEY('customer_lifetime_value')} AS customer_lifetime_value) FROM person_view
ORDER BY 6 DESC, 1 LIMIT 20""")
def top_customers_view(m: Mart) -> DataFrame:
    """Top 20 persons by rounded lifetime value (ties by person id)."""
    return (customer_summary(m)
            .withColumn("customer_lifetime_value", round2("customer_lifetime_value"))
            .orderBy(F.col("customer_lifetime_value").desc(), "customer_unique_id").limit(20))


@report("q15_3_monthly_sales_view", sql=f"""
WITH {ORDER_VIEW}, {MONTH_VIEW}
SELECT * REPLACE (CAST(product_revenue AS DOUBLE) AS product_revenue, CAST(freight_revenue AS DOUBLE) AS freight_revenue,
                  CAST(total_revenue AS DOUBLE) AS total_revenue) FROM month_view""")
def monthly_sales_view(m: Mart) -> DataFrame:
    """The monthly sales view."""
    return monthly_sales(m)


@report("q15_3_monthly_sales", sql=f"""
WITH {ORDER_VIEW}, {MONTH_VIEW}
SELECT * REPLACE ({MONEY('product_revenue')} AS product_revenue, {MONEY('freight_revenue')} AS freight_revenue,
                  {MONEY('total_revenue')} AS total_revenue) FROM month_view ORDER BY 1 NULLS LAST""")
def monthly_sales_report(m: Mart) -> DataFrame:
    """Rounded monthly sales, by month."""
    return (monthly_sales(m)
            .select("order_month", "delivered_orders", "items_sold", round2("product_revenue").alias("product_revenue"),
                    round2("freight_revenue").alias("freight_revenue"), round2("total_revenue").alias("total_revenue"))
            .orderBy(F.col("order_month").asc_nulls_last()))
