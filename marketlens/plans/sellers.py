"""Section 9: seller analysis."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions import item_value, pct, round2
from marketlens.functions.money import ratio_round
from marketlens.operators.grain import delivered, delivered_items
from marketlens.operators.ranking import global_dense_rank, kept
from marketlens.plans.registry import AVG2, MONEY, PCT, report
from marketlens.sources.mart import Mart

#: Item rows, once per delivered order row with their order id.
_DONE = "(SELECT x.* FROM order_items x JOIN orders o USING (order_id) WHERE o.order_status = 'delivered')"


@report("q9_1_sellers_by_state", sql="""
SELECT seller_state, COUNT(DISTINCT seller_id) AS seller_count FROM sellers
GROUP BY seller_state ORDER BY seller_count DESC, seller_state""")
def sellers_by_state(m: Mart) -> DataFrame:
    """Distinct sellers per state."""
    return (m.sellers.groupBy("seller_state").agg(F.count_distinct("seller_id").alias("seller_count"))
            .orderBy(F.col("seller_count").desc(), "seller_state"))


def _seller_sums(m: Mart, orders: bool = False) -> DataFrame:
    """Delivered items summed per seller (n, p, pn, f, t; distinct orders as oc), then joined to the seller table."""
    items = delivered_items(m.order_items.select("order_id", "seller_id", "price", "freight_value"), m.orders)
    distinct = [F.count_distinct("order_id").alias("oc")] if orders else []
    sums = items.groupBy("seller_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("price").alias("p"), F.count("price").alias("pn"),
        F.sum("freight_value").alias("f"), F.sum(item_value()).alias("t"), *distinct)
    return sums.join(m.sellers.select("seller_id", "seller_city", "seller_state"), "seller_id")


@report("q9_2_top_sellers", sql=f"""
SELECT s.seller_id, s.seller_city, s.seller_state, COUNT(DISTINCT i.order_id) AS order_count, COUNT(*) AS items_sold,
       {MONEY('SUM(i.price)')} AS product_revenue, {MONEY('SUM(i.freight_value)')} AS freight_value,
       {MONEY('SUM(i.price + i.freight_value)')} AS total_revenue
FROM {_DONE} i JOIN sellers s USING (seller_id) GROUP BY ALL ORDER BY 8 DESC, 1 LIMIT 20""")
def top_sellers(m: Mart) -> DataFrame:
    """Top 20 sellers by delivered revenue (ties by seller_id)."""
    return (_seller_sums(m, orders=True).groupBy("seller_id", "seller_city", "seller_state")
            .agg(F.max("oc").alias("order_count"), F.sum("n").alias("items_sold"),
                 round2(F.sum("p")).alias("product_revenue"), round2(F.sum("f")).alias("freight_value"),
                 round2(F.sum("t")).alias("total_revenue"))
            .orderBy(F.col("total_revenue").desc(), "seller_id").limit(20))


@report("q9_3_seller_avg_item", sql=f"""
SELECT s.seller_id, s.seller_city, s.seller_state, COUNT(*) AS items_sold, {AVG2('i.price')} AS average_item_price
FROM {_DONE} i JOIN sellers s USING (seller_id) GROUP BY s.seller_id, s.seller_city, s.seller_state HAVING COUNT(*) > 9
ORDER BY 5 DESC, 1""")
def seller_avg_item(m: Mart) -> DataFrame:
    """Mean delivered item price per seller with at least 10 items."""
    return (_seller_sums(m).groupBy("seller_id", "seller_city", "seller_state")
            .agg(F.sum("n").alias("items_sold"), ratio_round(F.sum("p"), F.sum("pn")).alias("average_item_price"))
            .where(F.col("items_sold") >= 10)
            .orderBy(F.col("average_item_price").desc(), "seller_id"))


@report("q9_4_seller_share", sql=f"""
WITH per AS (SELECT seller_id, SUM(price) AS earned FROM {_DONE} i GROUP BY seller_id),
levels AS (SELECT earned, row_number() OVER (ORDER BY earned DESC NULLS FIRST) AS place FROM (SELECT DISTINCT earned FROM per) AS d)
SELECT per.seller_id, {MONEY('per.earned')} AS revenue, {PCT('per.earned', '(SELECT SUM(earned) FROM per)')} AS revenue_share_percentage,
       levels.place AS seller_rank
FROM per JOIN levels ON per.earned IS NOT DISTINCT FROM levels.earned ORDER BY 4, 1""")
def seller_share(m: Mart) -> DataFrame:
    """Share of delivered product revenue and dense rank per seller.

    Sellers grow with the data, so the total is a broadcast one-row aggregate
    and the rank is the distributed dense rank (no single-task window).
    """
    sr = (delivered_items(m.order_items.select("order_id", "seller_id", "price"), m.orders)
          .groupBy("seller_id").agg(F.sum("price").alias("revenue")))
    # One row a seller, kept once: the total, the ranks and the result all read it.
    sr = kept(sr)
    total = F.broadcast(sr.agg(F.sum("revenue").alias("__t")))  # one row
    ranked = global_dense_rank(sr, "revenue", "seller_rank").crossJoin(total)
    return (ranked.select("seller_id", round2("revenue").alias("revenue"),
                          pct("revenue", "__t").alias("revenue_share_percentage"), "seller_rank")
            .orderBy("seller_rank", "seller_id"))


@report("q9_5_seller_lateness", sql=f"""
WITH trips AS (
    SELECT i.seller_id, i.order_id, bool_or(o.order_delivered_customer_date > o.order_estimated_delivery_date) AS late
    FROM orders o JOIN order_items i USING (order_id)
    WHERE o.order_status = 'delivered' AND o.order_delivered_customer_date IS NOT NULL
      AND o.order_estimated_delivery_date IS NOT NULL GROUP BY ALL)
SELECT seller_id, COUNT(*) AS delivered_orders, SUM(CAST(late AS BIGINT))::BIGINT AS late_orders,
       {PCT('SUM(CAST(late AS BIGINT))', 'COUNT(*)')} AS late_delivery_rate
FROM trips GROUP BY seller_id HAVING COUNT(*) > 9 ORDER BY 4 DESC NULLS FIRST, 1""")
def seller_lateness(m: Mart) -> DataFrame:
    """Per seller: delivered orders, late orders (distinct) and late rate; at least 10 orders."""
    dlv, est = F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
    o = (delivered(m.orders).where(dlv.isNotNull() & est.isNotNull())
         .select("order_id", (dlv > est).alias("__late")))
    j = m.order_items.select("order_id", "seller_id").join(o, "order_id")
    per_order = j.groupBy("seller_id", "order_id").agg(F.max("__late").alias("__late"))
    g = (per_order.groupBy("seller_id")
         .agg(F.count(F.lit(1)).alias("delivered_orders"), F.count_if("__late").alias("late_orders")))
    return (g.where(F.col("delivered_orders") >= 10)
            .withColumn("late_delivery_rate", pct("late_orders", "delivered_orders"))
            .orderBy(F.col("late_delivery_rate").desc_nulls_first(), "seller_id"))
