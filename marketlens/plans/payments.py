"""Section 10: payment analysis (all statuses; payments are never joined to items row-wise)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions import avg_exact, pct, round2
from marketlens.operators.ranking import with_total
from marketlens.plans.registry import AVG2, MONEY, PCT, report
from marketlens.sources.mart import Mart

_V = "payment_value"


@report("q10_1_payments_by_type", sql=f"""
SELECT payment_type, COUNT(*) AS payment_record_count, {MONEY('SUM(payment_value)')} AS payment_value
FROM order_payments GROUP BY payment_type ORDER BY 3 DESC, payment_type""")
def payments_by_type(m: Mart) -> DataFrame:
    """Payment records and value per payment type."""
    return (m.order_payments.groupBy("payment_type")
            .agg(F.count(F.lit(1)).alias("payment_record_count"), round2(F.sum(_V)).alias(_V))
            .orderBy(F.col(_V).desc(), "payment_type"))


@report("q10_2_payment_share", sql=f"""
SELECT payment_type, COUNT(*) AS payment_record_count, {MONEY('SUM(payment_value)')} AS payment_value,
       {PCT('SUM(payment_value)', 'SUM(SUM(payment_value)) OVER ()')} AS payment_value_percentage
FROM order_payments GROUP BY payment_type ORDER BY 3 DESC, payment_type""")
def payment_share(m: Mart) -> DataFrame:
    """Payment value per type and its share of all payment value."""
    g = m.order_payments.groupBy("payment_type").agg(F.count(F.lit(1)).alias("payment_record_count"),
                                                     F.sum(_V).alias("__v"))
    return (with_total(g, "__v", "__t", bounded=True)
            .select("payment_type", "payment_record_count", round2("__v").alias(_V),
                    pct("__v", "__t").alias("payment_value_percentage"))
            .orderBy(F.col(_V).desc(), "payment_type"))


@report("q10_3_payment_avg", sql=f"""
SELECT payment_type, COUNT(*) AS payment_count, {AVG2('payment_value')} AS average_payment_value
FROM order_payments GROUP BY payment_type ORDER BY average_payment_value DESC, payment_type""")
def payment_avg(m: Mart) -> DataFrame:
    """Mean payment value per type."""
    return (m.order_payments.groupBy("payment_type")
            .agg(F.count(F.lit(1)).alias("payment_count"), avg_exact(_V).alias("average_payment_value"))
            .orderBy(F.col("average_payment_value").desc(), "payment_type"))


@report("q10_4_installments", sql=f"""
SELECT CAST(payment_installments AS BIGINT) AS payment_installments, COUNT(*) AS payment_count,
       {AVG2('payment_value')} AS average_payment_value, {MONEY('SUM(payment_value)')} AS total_payment_value
FROM order_payments WHERE payment_type = 'credit_card'
GROUP BY payment_installments ORDER BY payment_installments""")
def installments(m: Mart) -> DataFrame:
    """Credit-card payments per number of installments."""
    return (m.order_payments.where(F.col("payment_type") == "credit_card").groupBy("payment_installments")
            .agg(F.count(F.lit(1)).alias("payment_count"), avg_exact(_V).alias("average_payment_value"),
                 round2(F.sum(_V)).alias("total_payment_value"))
            .orderBy("payment_installments"))


@report("q10_5_multi_payment_orders", sql=f"""
SELECT order_id, COUNT(*) AS payment_record_count, COUNT(DISTINCT payment_type) AS payment_type_count,
       {MONEY('SUM(payment_value)')} AS total_payment_value
FROM order_payments GROUP BY order_id HAVING COUNT(*) > 1 ORDER BY payment_record_count DESC, order_id""")
def multi_payment_orders(m: Mart) -> DataFrame:
    """Orders paid with more than one payment record."""
    return (m.order_payments.groupBy("order_id")
            .agg(F.count(F.lit(1)).alias("payment_record_count"),
                 F.count_distinct("payment_type").alias("payment_type_count"),
                 round2(F.sum(_V)).alias("total_payment_value"))
            .where(F.col("payment_record_count") > 1)
            .orderBy(F.col("payment_record_count").desc(), "order_id"))


def reconcile_totals(m: Mart, how: str = "inner", tolerance: str = "0.01") -> DataFrame:
    """Item total vs payment total per order; rows whose |difference| exceeds ``tolerance``.

    Both sides are aggregated to order grain before the join (never item x
    payment rows). ``how='full'`` also reports orders present on one side
    only, counting the missing side as 0.
    """
    it = m.order_summary.select("order_id", F.col("total_order_value").alias("item_total"))
    pt = m.order_payments.groupBy("order_id").agg(F.sum(_V).alias("payment_total"))
    j = it.join(pt, "order_id", how)
    if how == "inner":
        diff = F.col("payment_total") - F.col("item_total")
    else:
        zero = F.lit(0).cast("decimal(12,2)")
        diff = F.coalesce("payment_total", zero) - F.coalesce("item_total", zero)
    return (j.withColumn("__d", diff).where(F.abs("__d") > F.lit(tolerance).cast("decimal(4,2)"))
            .select("order_id", round2("item_total").alias("item_total"),
                    round2("payment_total").alias("payment_total"), round2("__d").alias("difference"),
                    F.abs("__d").alias("__abs"))
            .orderBy(F.col("__abs").desc(), "order_id").drop("__abs"))


_BOOKS = """WITH entries AS (
    SELECT order_id, price + freight_value AS due, CAST(NULL AS DECIMAL(12,2)) AS paid, 'due' AS side FROM order_items
    UNION ALL SELECT order_id, NULL, payment_value, 'paid' FROM order_payments),
books AS (
    SELECT order_id, SUM(due) AS due, SUM(paid) AS paid, bool_or(side = 'due') AND bool_or(side = 'paid') AS two_sided
    FROM entries GROUP BY order_id, CASE WHEN order_id IS NULL THEN side END)"""


@report("q10_6_reconcile_totals", sql=f"""
{_BOOKS}
SELECT order_id, {MONEY('due')} AS item_total, {MONEY('paid')} AS payment_total, {MONEY('paid - due')} AS difference
FROM books WHERE two_sided AND (paid - due > 0.01 OR due - paid > 0.01)
ORDER BY greatest(paid - due, due - paid) DESC, order_id""")
def reconcile(m: Mart) -> DataFrame:
    """Orders whose item total and payment total differ by more than 0.01."""
    return reconcile_totals(m, "inner")


@report("reconcile_totals_full", sql=f"""
{_BOOKS}
SELECT order_id, {MONEY('due')} AS item_total, {MONEY('paid')} AS payment_total,
       {MONEY('COALESCE(paid, 0) - COALESCE(due, 0)')} AS difference
FROM books WHERE COALESCE(paid, 0) - COALESCE(due, 0) NOT BETWEEN -0.01 AND 0.01""")
def reconcile_full(m: Mart) -> DataFrame:
    """Full-outer reconciliation: also orders with items but no payments, or payments but no items."""
    return reconcile_totals(m, "full")
