"""Report queries, one module per section of the workload.

Importing this package registers every report in ``registry.REPORTS``.
"""

from marketlens.plans import (  # noqa: F401
    exploration, quality_reports, joins, orders, time_sales, customers, rfm, products, sellers,
    payments, delivery, reviews, geography, windows, views, kpi, extras,
)
from marketlens.plans.registry import REPORTS, oracle_sql, run_report  # noqa: F401
