"""Section 16: executive KPI summary (canonical and order-weighted variants).

All inputs are reduced to one-row aggregates and combined with broadcast
cross joins of single rows, so the summary adds no shuffle beyond the
order-grain aggregation it shares with the other reports.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions import avg_elapsed, avg_exact, pct, round2
from marketlens.functions.money import ratio_round
from marketlens.operators.grain import customer_orders, delivered
from marketlens.plans.delivery import DLV, EST, PUR
from marketlens.plans.registry import AVG2, BUYER, ELAPSED, MONEY, PCT, SOLD, WORTH, report
from marketlens.sources.mart import Mart

_ID = "customer_unique_id"

#: Delivered order rows with a customer record and items: the person, the worth, and the person's number of orders.
_DONE = f"""WITH done AS (SELECT o.order_id, b.customer_unique_id AS who, {WORTH} AS worth FROM orders o JOIN {BUYER} WHERE {SOLD}),
people AS (SELECT who, COUNT(DISTINCT order_id) AS visits FROM done GROUP BY who),
others AS (
    SELECT (SELECT {AVG2('review_score')} FROM order_reviews) AS average_review_score,
           {ELAPSED('order_purchase_timestamp', 'order_delivered_customer_date')} AS average_delivery_days,
           {PCT('SUM(CAST(order_delivered_customer_date <= order_estimated_delivery_date AS BIGINT))', 'COUNT(*)')} AS on_time_delivery_rate
    FROM orders WHERE order_status = 'delivered' AND order_purchase_timestamp IS NOT NULL
      AND order_delivered_customer_date IS NOT NULL AND order_estimated_delivery_date IS NOT NULL)"""


def delivered_order_metrics(m: Mart) -> DataFrame:
    """Delivered orders with person id and order value (order grain)."""
    ofn = m.order_summary.select("order_id", F.col("total_order_value").alias("order_value"))
    return customer_orders(m.customers, delivered(m.orders)).join(ofn, "order_id").select("order_id", _ID, "order_value")


def person_metrics(m: Mart, known_only: bool = False) -> DataFrame:
    """Per person: distinct orders (oc), order rows (n), value sum and count (v, vn), and orders first seen here (own).

    Rows are grouped by (order, person) once. An order that two customer records
    share counts for its first person only, so ``own`` adds up to the distinct orders.
    """
    dom = delivered_order_metrics(m)
    if known_only:
        dom = dom.where(F.col(_ID).isNotNull())
    per_order = dom.groupBy("order_id", _ID).agg(
        F.count(F.lit(1)).alias("n"), F.sum("order_value").alias("v"), F.count("order_value").alias("vn"))
    first = F.row_number().over(Window.partitionBy("order_id").orderBy(F.col(_ID).asc_nulls_last())) == 1
    return (per_order.withColumn("own", first.cast("long")).groupBy(_ID)
            .agg(F.count("order_id").alias("oc"), F.sum("n").alias("n"), F.sum("v").alias("v"),
                 F.sum("vn").alias("vn"), F.sum("own").alias("own")))


def review_kpis(m: Mart) -> DataFrame:
    return m.order_reviews.agg(avg_exact("review_score").alias("average_review_score"))


def delivery_kpis(m: Mart) -> DataFrame:
    o = delivered(m.orders)
    for c in (PUR, DLV, EST):
        o = o.where(F.col(c).isNotNull())
    on_time = F.count_if(F.col(DLV) <= F.col(EST))
    return o.agg(avg_elapsed(PUR, DLV).alias("average_delivery_days"),
                 pct(on_time, F.count(F.lit(1))).alias("on_time_delivery_rate"))


@report("q16_kpi_summary", sql=f"""
{_DONE}
SELECT (SELECT COUNT(DISTINCT order_id) FROM done) AS delivered_orders, (SELECT COUNT(DISTINCT who) FROM done) AS delivered_customers,
       (SELECT {MONEY('SUM(worth)')} FROM done) AS total_revenue, (SELECT {AVG2('worth')} FROM done) AS average_order_value,
       (SELECT {PCT('SUM(CAST(visits > 1 AS BIGINT))', 'COUNT(*)')} FROM people) AS repeat_customer_rate, others.*
FROM others""")
def kpi_summary(m: Mart) -> DataFrame:
    """One-row executive summary: order, customer, review and delivery KPIs (repeat rate per person)."""
    order_kpis = person_metrics(m).agg(
        F.coalesce(F.sum("own"), F.lit(0)).alias("delivered_orders"), F.count(_ID).alias("delivered_customers"),
        round2(F.sum("v")).alias("total_revenue"), ratio_round(F.sum("v"), F.sum("vn")).alias("average_order_value"),
        pct(F.count_if(F.col("oc") > 1), F.count(F.lit(1))).alias("repeat_customer_rate"))
    return order_kpis.crossJoin(F.broadcast(review_kpis(m))).crossJoin(F.broadcast(delivery_kpis(m)))


@report("q16_kpi_order_weighted", sql=f"""
{_DONE}
SELECT COUNT(DISTINCT d.order_id) AS delivered_orders, COUNT(DISTINCT d.who) AS delivered_customers,
       {MONEY('SUM(d.worth)')} AS total_revenue, {AVG2('d.worth')} AS average_order_value,
       {PCT('SUM(CAST(people.visits > 1 AS BIGINT))', 'COUNT(*)')} AS repeat_customer_rate,
       any_value(others.average_review_score) AS average_review_score, any_value(others.average_delivery_days) AS average_delivery_days,
       any_value(others.on_time_delivery_rate) AS on_time_delivery_rate
FROM done d JOIN people USING (who), others HAVING COUNT(*) > 0""")
def kpi_order_weighted(m: Mart) -> DataFrame:
    """First summary variant: repeat rate weighted by delivered orders; no row without delivered orders.

    Its repeat share is the share of delivered *orders* placed by repeat
    persons (each order row of a repeat person counts), a different and
    legitimate figure from the canonical per-person rate.
    """
    rows = person_metrics(m, known_only=True).agg(
        F.sum("own").alias("delivered_orders"), F.count(_ID).alias("delivered_customers"),
        round2(F.sum("v")).alias("total_revenue"), ratio_round(F.sum("v"), F.sum("vn")).alias("average_order_value"),
        pct(F.sum(F.when(F.col("oc") > 1, F.col("n")).otherwise(0)), F.sum("n")).alias("repeat_customer_rate"))
    return (rows.where(F.col("delivered_orders").isNotNull())
            .crossJoin(F.broadcast(review_kpis(m))).crossJoin(F.broadcast(delivery_kpis(m))))
