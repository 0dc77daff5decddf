"""Registry of report queries: key -> (Spark plan over a Mart, oracle SQL).

A report function takes a ``Mart`` and returns a DataFrame. ``run_report``
applies the output typing once, at the boundary.
The oracle SQL is written against the nine logical table names; ``oracle_sql``
prefixes the test-mart CTEs so DuckDB can run it on the raw parquet views.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from marketlens.operators.output import finalize
from marketlens.sources.mart import Mart
from marketlens.sources.mart_sql import with_mart


@dataclass(frozen=True)
class Report:
    key: str
    build: Callable[[Mart], DataFrame]
    sql: str | None
    doc: str


REPORTS: dict[str, Report] = {}


def report(key: str, sql: str | None = None):
    def deco(fn: Callable[[Mart], DataFrame]):
        if key in REPORTS:
            raise ValueError(f"duplicate report key {key}")
        REPORTS[key] = Report(key, fn, sql, (fn.__doc__ or "").strip())
        return fn
    return deco


def run_report(key: str, mart: Mart, doubles: bool = False) -> DataFrame:
    """The report over a mart; money and ratios stay DECIMAL unless ``doubles``."""
    return finalize(REPORTS[key].build(mart), doubles)


def as_query(key: str) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        from marketlens.session import configure
        configure(spark)
        return run_report(key, Mart.from_testdata(spark, sf_dir), doubles=True)
    q.__name__ = key
    return q


def oracle_sql(key: str) -> str | None:
    sql = REPORTS[key].sql
    return with_mart(sql) if sql else None


# -- SQL snippets shared by the oracle texts ---------------------------------------
# DuckDB divides decimals in double precision, so the oracle rounds exactly
# with 128-bit integers: with a = num and d = den in hundredths,
# ROUND(factor * num / den, 2) * 100 = sign * (2 * 100 * factor * |a| + |d|) // (2 * |d|).
def EXACT(num: str, den: str, factor: int = 1) -> str:
    a = f"CAST(CAST({num} AS DECIMAL(38,2)) * 100 AS HUGEINT)"
    d = f"CAST(CAST({den} AS DECIMAL(38,2)) * 100 AS HUGEINT)"
    q = f"(2 * {100 * factor} * abs({a}) + abs({d})) // (2 * abs({d}))"
    return f"(CASE WHEN {d} = 0 THEN NULL ELSE CAST(sign({a}) * sign({d}) * {q} AS DOUBLE) / 100 END)"


def PCT(num: str, den: str) -> str:
    return EXACT(num, den, 100)


def AVG2(x: str) -> str:
    return EXACT(f"SUM({x})", f"COUNT({x})")


def MONEY(x: str) -> str:
    return f"CAST(ROUND({x}, 2) AS DOUBLE)"


def ELAPSED(start: str, end: str, unit: str = "day") -> str:
    per_unit = {"hour": 3600, "day": 86400}[unit] * 1_000_000
    us = f"(epoch_us({end}) - epoch_us({start}))"
    return EXACT(f"SUM({us})", f"COUNT({us}) * {per_unit}")


LABEL = "COALESCE(pct.product_category_name_english, p.product_category_name, 'Unknown')"

# The oracle texts start from what a report means, per order or per person, not from
# the plan of the Spark code: an order's worth is looked up for each order row.
#: Value of the items of order row o.
WORTH = "(SELECT SUM(x.price + x.freight_value) FROM order_items x WHERE x.order_id = o.order_id)"
#: Order row o is delivered and has items.
SOLD = "o.order_status = 'delivered' AND EXISTS (FROM order_items x WHERE x.order_id = o.order_id)"
#: First day of the purchase month of order row o.
MONTH = "CAST(make_date(year(o.order_purchase_timestamp), month(o.order_purchase_timestamp), 1) AS DATE)"
#: The person behind order row o, once per customer record.
BUYER = "customers b ON b.customer_id = o.customer_id"
#: Label of each product, for a WITH clause.
NAMED = """named AS (
    SELECT product_id, coalesce(t.product_category_name_english, product_category_name, 'Unknown') AS label
    FROM products LEFT JOIN product_category_name_translation t USING (product_category_name))"""
#: Days, in microseconds.
DAY_US = 86_400_000_000
