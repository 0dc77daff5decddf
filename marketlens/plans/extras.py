"""Reports for the ingest and constraint work of the source system.

``dq_rule_report``: every declared constraint (keys, references, NOT NULL,
CHECK, string lengths) checked over the mart, one row per rule.
``ingest_backfill_categories``: the category lookup after the loader's
back-fill step (categories used by products but missing from the lookup are
added with their native name as English name).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.operators.quality import check_rules, rules_sql
from marketlens.plans.registry import report
from marketlens.sources.ingest import backfill_categories
from marketlens.sources.mart import Mart


@report("dq_rule_report", sql=rules_sql())
def dq_rule_report(m: Mart) -> DataFrame:
    """Violations per data-quality rule over the nine tables."""
    return check_rules(m.tables()).orderBy("table_name", "rule_type", "rule")


@report("ingest_backfill_categories", sql="""
WITH missing AS (
    SELECT DISTINCT p.product_category_name FROM products AS p
    WHERE p.product_category_name IS NOT NULL
      AND NOT EXISTS (SELECT 1 FROM product_category_name_translation AS t
                      WHERE t.product_category_name = p.product_category_name))
SELECT product_category_name, product_category_name_english FROM product_category_name_translation
UNION ALL
SELECT product_category_name, product_category_name FROM missing
ORDER BY product_category_name""")
def ingest_backfill(m: Mart) -> DataFrame:
    """Category lookup completed with every product category it lacked."""
    full, _added = backfill_categories(m.products, m.product_category_name_translation)
    return full.orderBy(F.col("product_category_name").asc_nulls_last())
