"""The test mart as ANSI SQL, for the independent DuckDB oracle.

Same mapping as ``Mart.from_testdata`` (FIXTURES.md, section B), written as
common table expressions over the raw views the oracle pre-registers. The raw
``orders`` view is renamed first (``src_orders``) because the mart has its own
``orders`` table.
"""

from __future__ import annotations

import re

_PUR = "o_orderdate + INTERVAL '1' MINUTE * (o_orderkey * 7 % 1440)"

# Dependency order: a CTE may only use CTEs defined before it.
MART_CTES: dict[str, str] = {
    "src_orders": "SELECT * FROM orders",
    "customers": """
        SELECT o.o_orderkey AS customer_id,
               c.c_custkey AS customer_unique_id,
               CAST(c.c_nationkey * 1000 + c.c_custkey % 1000 AS INTEGER) AS customer_zip_code_prefix,
               c.c_mktsegment AS customer_city,
               n.n_name AS customer_state
        FROM src_orders AS o
        JOIN customer AS c ON o.o_custkey = c.c_custkey
        JOIN nation AS n ON c.c_nationkey = n.n_nationkey""",
    "orders": f"""
        SELECT o_orderkey AS order_id,
               o_orderkey AS customer_id,
               CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
                    ELSE 'processing' END AS order_status,
               {_PUR} AS order_purchase_timestamp,
               CASE WHEN o_orderkey % 101 <> 0
                    THEN {_PUR} + INTERVAL '1' HOUR * (o_orderkey % 72) END AS order_approved_at,
               CASE WHEN o_orderkey % 103 <> 0
                    THEN {_PUR} + INTERVAL '1' DAY * (1 + o_orderkey % 5) END AS order_delivered_carrier_date,
               CASE WHEN o_orderkey % 107 <> 0
                    THEN {_PUR} + INTERVAL '1' DAY * (1 + o_orderkey % 45) END AS order_delivered_customer_date,
               o_orderdate + INTERVAL '1' DAY * (15 + o_custkey % 20) AS order_estimated_delivery_date
        FROM src_orders""",
    "order_items": """
        SELECT l_orderkey AS order_id,
               l_linenumber AS order_item_id,
               l_partkey AS product_id,
               l_suppkey AS seller_id,
               l_shipdate AS shipping_limit_date,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
               CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(12,2))
                   AS freight_value
        FROM lineitem""",
    "products": """
        SELECT p_partkey AS product_id,
               CASE WHEN p_partkey % 97 = 0 THEN NULL ELSE concat(p_type, '_', p_brand) END
                   AS product_category_name,
               CAST(length(p_name) AS INTEGER) AS product_name_length,
               CAST(NULL AS INTEGER) AS product_description_length,
               CAST(NULL AS INTEGER) AS product_photos_qty,
               CAST(p_size AS DECIMAL(10,2)) AS product_weight_g,
               CAST(NULL AS DECIMAL(10,2)) AS product_length_cm,
               CAST(NULL AS DECIMAL(10,2)) AS product_height_cm,
               CAST(NULL AS DECIMAL(10,2)) AS product_width_cm
        FROM part""",
    "product_category_name_translation": """
        SELECT product_category_name, lower(product_category_name) AS product_category_name_english
        FROM (SELECT DISTINCT concat(p_type, '_', p_brand) AS product_category_name
              FROM part WHERE p_brand <> 'Brand#13') AS t""",
    "sellers": """
        SELECT s.s_suppkey AS seller_id,
               CAST(s.s_nationkey * 1000 AS INTEGER) AS seller_zip_code_prefix,
               s.s_name AS seller_city,
               n.n_name AS seller_state
        FROM supplier AS s JOIN nation AS n ON s.s_nationkey = n.n_nationkey""",
    "order_payments": """
        SELECT o_orderkey AS order_id,
               1 AS payment_sequential,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'credit_card' WHEN '2-HIGH' THEN 'boleto'
                    WHEN '3-MEDIUM' THEN 'voucher' WHEN '4-NOT SPECIFIED' THEN 'debit_card'
                    ELSE 'not_defined' END AS payment_type,
               CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 + o_orderkey % 10 ELSE 1 END AS INTEGER)
                   AS payment_installments,
               CAST(o_totalprice AS DECIMAL(12,2)) AS payment_value
        FROM src_orders
        UNION ALL
        SELECT o_orderkey, 2, 'voucher', 1, CAST(10 AS DECIMAL(12,2))
        FROM src_orders WHERE o_orderkey % 5 = 0""",
    "order_reviews": """
        SELECT event_id AS review_id,
               event_id AS order_id,
               CAST(CASE event_type WHEN 'error' THEN 1 WHEN 'click' THEN 2 WHEN 'view' THEN 3
                    WHEN 'signup' THEN 4 ELSE 5 END AS INTEGER) AS review_score,
               CAST(NULL AS VARCHAR) AS review_comment_title,
               CASE event_id % 3 WHEN 0 THEN NULL WHEN 1 THEN '  ' ELSE props END AS review_comment_message,
               ts AS review_creation_date,
               ts + INTERVAL '1' DAY AS review_answer_timestamp
        FROM events""",
    "geolocation": """
        SELECT CAST(n.n_nationkey AS BIGINT) AS geolocation_id,
               CAST(n.n_nationkey * 1000 AS INTEGER) AS geolocation_zip_code_prefix,
               CAST(n.n_nationkey - 12 AS DECIMAL(10,7)) AS geolocation_lat,
               CAST(n.n_nationkey * 2 - 24 AS DECIMAL(10,7)) AS geolocation_lng,
               n.n_name AS geolocation_city,
               r.r_name AS geolocation_state
        FROM nation AS n JOIN region AS r ON n.n_regionkey = r.r_regionkey""",
}

_NEEDS = {"customers": ("src_orders",), "orders": ("src_orders",), "order_payments": ("src_orders",)}
_TABLE_RE = {name: re.compile(rf"\b{name}\b") for name in MART_CTES if name != "src_orders"}


def with_mart(body: str) -> str:
    """Prefix a report's SQL with the mart tables it mentions.

    ``body`` may start with its own ``WITH``; its CTEs are appended after the
    mart's so they can use them.
    """
    used = {name for name, rx in _TABLE_RE.items() if rx.search(body)}
    needed = set(used)
    for name in used:
        needed.update(_NEEDS.get(name, ()))
    ctes = [f"{name} AS ({sql}\n)" for name, sql in MART_CTES.items() if name in needed]
    text = body.strip().rstrip(";")
    if re.match(r"(?is)^with\s", text):
        text = text[4:].lstrip()
        return "WITH " + ",\n".join(ctes) + ",\n" + text
    if not ctes:
        return text
    return "WITH " + ",\n".join(ctes) + "\n" + text
