"""Section 7: recency-frequency-monetary segmentation.

Recency is measured against the latest purchase date of all orders. The
three NTILE(5) scores are global quintiles over all persons; the keys where
the quintiles start are found from range counts (``ntile_cuts``) rather than by
a window without PARTITION BY, which would put every person into one task. Ties are
broken by the person id so the quintiles are reproducible.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions import round2
from marketlens.operators.grain import customer_orders, delivered
from marketlens.operators.ranking import kept, ntile_cuts, ntile_from_cuts
from marketlens.plans.registry import BUYER, MONEY, SOLD, WORTH, report
from marketlens.sources.mart import Mart

_TS = "order_purchase_timestamp"
_ID = "customer_unique_id"

# Fixed segment names and thresholds (first matching rule wins).
SEGMENTS = (
    ("Champions", lambda r, f, m: (r >= 4) & (f >= 4) & (m >= 4)),
    ("Loyal customers", lambda r, f, m: (r >= 3) & (f >= 3) & (m >= 3)),
    ("Recent customers", lambda r, f, m: (r >= 4) & (f <= 2)),
    ("At risk", lambda r, f, m: (r <= 2) & (f >= 3)),
    ("Lost customers", lambda r, f, m: (r == 1) & (f == 1)),
)
OTHER_SEGMENT = "Potential customers"


def rfm_values(m: Mart) -> DataFrame:
    """person -> recency_days, frequency, monetary_value (delivered orders)."""
    reference = m.orders.agg(F.max(_TS).cast("date").alias("reference_date"))
    per_person = (customer_orders(m.customers, delivered(m.orders), _TS)
                  .join(m.order_summary.select("order_id", F.col("total_order_value").alias("order_value")),
                        "order_id")
                  .groupBy(_ID)
                  .agg(F.max(_TS).cast("date").alias("latest_purchase_date"),
                       F.count_distinct("order_id").alias("frequency"),
                       F.sum("order_value").alias("monetary_value")))
    # The reference date is one row: broadcasting it is bounded.
    return (per_person.crossJoin(F.broadcast(reference))
            .select(_ID, F.datediff("reference_date", "latest_purchase_date").cast("long").alias("recency_days"),
                    "frequency", "monetary_value"))


def segment(r, f, m):
    expr = None
    for name, rule in SEGMENTS:
        cond = rule(r, f, m)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr.otherwise(OTHER_SEGMENT)


def rfm_scores(m: Mart) -> DataFrame:
    """The values stored once, the cut keys of all three scores from shared passes, and the scores by comparison with the cuts."""
    v = kept(rfm_values(m))
    cuts = ntile_cuts(v, 5, ["recency_days", "frequency", "monetary_value"], _ID)
    r, f, mo = (ntile_from_cuts(v, cuts[c], c, _ID) for c in cuts)
    return v.withColumns({"recency_score": (6 - r).cast("long"), "frequency_score": f, "monetary_score": mo})


def _FIFTH(place: str) -> str:
    """Oracle text: the fifth that a place (from 1) falls in; the first (everyone mod 5) fifths hold one more."""
    size, extra = "(everyone // 5)", "(everyone % 5)"
    return (f"CAST(CASE WHEN {place} <= {extra} * ({size} + 1) THEN ({place} - 1) // ({size} + 1) + 1 "
            f"ELSE {extra} + ({place} - {extra} * ({size} + 1) - 1) // greatest({size}, 1) + 1 END AS BIGINT)")


@report("q7_rfm", sql=f"""
WITH p AS (SELECT b.customer_unique_id AS who, MAX(CAST(o.order_purchase_timestamp AS DATE)) AS seen,
                  COUNT(DISTINCT o.order_id) AS visits, SUM({WORTH}) AS spent
           FROM orders o JOIN {BUYER} WHERE {SOLD} GROUP BY 1),
placed AS (SELECT *, date_diff('day', seen, (SELECT CAST(MAX(order_purchase_timestamp) AS DATE) FROM orders)) AS away,
                  COUNT(*) OVER () AS everyone,
                  row_number() OVER (ORDER BY seen DESC NULLS LAST, who) AS r, row_number() OVER (ORDER BY visits NULLS LAST, who) AS f,
                  row_number() OVER (ORDER BY spent NULLS LAST, who) AS m FROM p),
fifths AS (SELECT *, 6 - ({_FIFTH('r')}) AS rs, {_FIFTH('f')} AS fs, {_FIFTH('m')} AS ms FROM placed)
SELECT who AS customer_unique_id, away AS recency_days, visits AS frequency, {MONEY('spent')} AS monetary_value,
       rs AS recency_score, fs AS frequency_score, ms AS monetary_score, printf('%d%d%d', rs, fs, ms) AS rfm_score,
       CASE WHEN least(rs, fs, ms) > 3 THEN 'Champions' WHEN least(rs, fs, ms) > 2 THEN 'Loyal customers'
            WHEN rs > 3 AND fs < 3 THEN 'Recent customers' WHEN rs < 3 AND fs > 2 THEN 'At risk'
            WHEN greatest(rs, fs) = 1 THEN 'Lost customers' ELSE 'Potential customers' END AS customer_segment
FROM fifths ORDER BY rs DESC, fs DESC, ms DESC, who""")
def rfm(m: Mart) -> DataFrame:
    """RFM values, quintile scores, score string and segment per person."""
    s = rfm_scores(m)
    r, f, mo = F.col("recency_score"), F.col("frequency_score"), F.col("monetary_score")
    return (s.select(_ID, "recency_days", "frequency", round2("monetary_value").alias("monetary_value"),
                     "recency_score", "frequency_score", "monetary_score",
                     F.concat_ws("", r.cast("string"), f.cast("string"), mo.cast("string")).alias("rfm_score"),
                     segment(r, f, mo).alias("customer_segment"))
            .orderBy(r.desc(), f.desc(), mo.desc(), _ID))
