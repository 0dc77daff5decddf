"""Section 14: window-function reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions import month_num, pct, round2, year_of
from marketlens.functions.money import ratio_round
from marketlens.operators.grain import delivered_items
from marketlens.operators.ranking import kept, ntile_cuts, ntile_from_cuts, with_total
from marketlens.plans.products import _BY_CATEGORY, category_revenue
from marketlens.plans.registry import EXACT, MONEY, PCT, SOLD, WORTH, report
from marketlens.plans.time_sales import _BY_MONTH, delivered_order_rows, monthly_delivered_revenue
from marketlens.sources.mart import Mart

_TS = "order_purchase_timestamp"


@report("q14_1_month_rank_in_year", sql=f"""
WITH m AS (SELECT year(o.order_purchase_timestamp) AS y, month(o.order_purchase_timestamp) AS mo, SUM({WORTH}) AS taken
           FROM orders o WHERE {SOLD} GROUP BY 1, 2)
SELECT y AS order_year, mo AS order_month, {MONEY('taken')} AS revenue,
       1 + (SELECT COUNT(DISTINCT n.taken) FROM m n WHERE n.y IS NOT DISTINCT FROM m.y AND n.taken > m.taken) AS revenue_rank_within_year
FROM m ORDER BY 1 NULLS LAST, 4, 2""")
def month_rank_in_year(m: Mart) -> DataFrame:
    """Months ranked by delivered revenue within their year (at most 12 rows per year)."""
    mr = (delivered_order_rows(m, year_of(_TS).alias("order_year"), month_num(_TS).alias("order_month"))
          .groupBy("order_year", "order_month").agg(F.sum("__t").alias("revenue")))
    w = Window.partitionBy("order_year").orderBy(F.col("revenue").desc_nulls_first())
    return (mr.select("order_year", "order_month", round2("revenue").alias("revenue"),
                      F.dense_rank().over(w).cast("long").alias("revenue_rank_within_year"))
            .orderBy(F.col("order_year").asc_nulls_last(), "revenue_rank_within_year", "order_month"))


@report("q14_2_moving_avg_3m", sql=f"""
WITH numbered AS (SELECT *, row_number() OVER (ORDER BY order_month NULLS LAST) AS nth FROM {_BY_MONTH} AS m)
SELECT a.order_month, {MONEY('MAX(a.taken)')} AS monthly_revenue, {EXACT('SUM(b.taken)', 'COUNT(b.taken)')} AS three_month_moving_average
FROM numbered a JOIN numbered b ON b.nth BETWEEN a.nth - 2 AND a.nth GROUP BY a.order_month, a.nth ORDER BY a.nth""")
def moving_avg_3m(m: Mart) -> DataFrame:
    """Monthly revenue and the mean of the current and two previous month rows."""
    w = Window.orderBy(F.col("order_month").asc_nulls_last()).rowsBetween(-2, Window.currentRow)  # bounded rows
    return (monthly_delivered_revenue(m)
            .select("order_month", round2("revenue").alias("monthly_revenue"),
                    ratio_round(F.sum("revenue").over(w), F.count("revenue").over(w))
                    .alias("three_month_moving_average"))
            .orderBy(F.col("order_month").asc_nulls_last()))


# Fixed quartile segment names.
QUARTILE_NAMES = {1: "Low-value orders", 2: "Lower-middle orders", 3: "Upper-middle orders", 4: "High-value orders"}


@report("q14_3_value_quartiles", sql=f"""
WITH w AS (SELECT o.order_id, SUM({WORTH}) AS worth FROM orders o WHERE {SOLD} GROUP BY 1),
placed AS (SELECT *, row_number() OVER (ORDER BY worth NULLS LAST, order_id) - 1 AS nth, COUNT(*) OVER () AS n FROM w),
quarters AS (SELECT *, CASE WHEN nth < (n % 4) * (n // 4 + 1) THEN nth // (n // 4 + 1)
                            ELSE n % 4 + (nth - (n % 4) * (n // 4 + 1)) // greatest(n // 4, 1) END + 1 AS q FROM placed)
SELECT order_id, {MONEY('worth')} AS order_value, CAST(q AS BIGINT) AS value_quartile,
       ['Low-value orders', 'Lower-middle orders', 'Upper-middle orders', 'High-value orders'][q] AS value_segment
FROM quarters ORDER BY 2 DESC, 1""")
def value_quartiles(m: Mart) -> DataFrame:
    """Delivered orders split into value quartiles (cut keys of the distributed NTILE, ties by order_id)."""
    ofn = (delivered_items(m.order_summary.select("order_id", "total_order_value"), m.orders)
           .groupBy("order_id").agg(F.sum("total_order_value").alias("order_value")))
    ofn = kept(ofn)
    cuts = ntile_cuts(ofn, 4, ["order_value"], "order_id")["order_value"]
    q = ofn.withColumn("value_quartile", ntile_from_cuts(ofn, cuts, "order_value", "order_id"))
    seg = None
    for k, name in QUARTILE_NAMES.items():
        cond = F.col("value_quartile") == k
        seg = F.when(cond, name) if seg is None else seg.when(cond, name)
    # ORDER BY resolves to the rounded output column, as in the SQL.
    return (q.select("order_id", round2("order_value").alias("order_value"), "value_quartile",
                     seg.alias("value_segment"))
            .orderBy(F.col("order_value").desc_nulls_first(), "order_id"))


@report("q14_4_pareto", sql=f"""
WITH ranked AS (SELECT *, row_number() OVER (ORDER BY taken DESC NULLS FIRST, label) AS nth FROM {_BY_CATEGORY} AS t)
SELECT a.label AS product_category, {MONEY('a.taken')} AS revenue, {PCT('a.taken', '(SELECT SUM(taken) FROM ranked)')} AS revenue_percentage,
       {PCT('(SELECT SUM(b.taken) FROM ranked b WHERE b.nth <= a.nth)', '(SELECT SUM(taken) FROM ranked)')} AS cumulative_revenue_percentage
FROM ranked a ORDER BY 2 DESC, 1""")
def pareto(m: Mart) -> DataFrame:
    """Category revenue share and cumulative share, largest first (one row per category)."""
    w = (Window.orderBy(F.col("revenue").desc_nulls_first(), "product_category")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cr = with_total(category_revenue(m), "revenue", "__t", bounded=True).withColumn("__cum", F.sum("revenue").over(w))
    return (cr.select("product_category", round2("revenue").alias("revenue"),
                      pct("revenue", "__t").alias("revenue_percentage"),
                      pct("__cum", "__t").alias("cumulative_revenue_percentage"))
            .orderBy(F.col("revenue").desc_nulls_first(), "product_category"))
