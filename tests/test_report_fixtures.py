"""Hand-written micro fixtures for cases the generated data cannot show."""

from decimal import Decimal

from pyspark.sql import functions as F

from marketlens.operators import grain
from marketlens.plans import REPORTS
from marketlens.plans.registry import run_report
from marketlens.plans.rfm import segment
from tests.conftest import D, collect, make_mart, ts


def run(key, mart):
    return collect(run_report(key, mart, doubles=True))


def _people(spark, delivered_counts):
    customers, orders, items = [], [], []
    n = 0
    for person, k in enumerate(delivered_counts):
        for _ in range(k):
            n += 1
            customers.append({"customer_id": f"c{n}", "customer_unique_id": f"u{person}"})
            orders.append({"order_id": f"o{n}", "customer_id": f"c{n}",
                           "order_purchase_timestamp": ts(f"2020-01-{n:02d} 10:00:00")})
            items.append({"order_id": f"o{n}", "price": D("10.00"), "freight_value": D("0.00")})
    return make_mart(spark, customers=customers, orders=orders, order_items=items)


def test_fan_out_counted_once(spark):
    m = make_mart(spark,
                  customers=[{"customer_id": "c1", "customer_unique_id": "u1"}],
                  orders=[{"order_id": "o1", "customer_id": "c1"}],
                  order_items=[{"order_id": "o1", "order_item_id": 1, "price": D("10.00"), "freight_value": D("1.00")},
                               {"order_id": "o1", "order_item_id": 2, "price": D("20.00"), "freight_value": D("2.00")}],
                  order_payments=[{"order_id": "o1", "payment_sequential": 1, "payment_value": D("30.00")},
                                  {"order_id": "o1", "payment_sequential": 2, "payment_value": D("3.00")}])
    assert run("q4_6_total_order_value", m) == [{"total_order_value": 33.0}]
    assert run("q10_6_reconcile_totals", m) == []


def test_one_person_two_order_ids(spark):
    m = _people(spark, [2])
    assert run("q6_1_unique_customers", m) == [{"unique_customers": 1}]
    assert run("q6_5_onetime_vs_repeat", m) == [
        {"customer_type": "Repeat customer", "customer_count": 1, "customer_percentage": 100.0}]


def test_repeat_rate_canonical_vs_order_weighted(spark):
    m = _people(spark, [1, 1, 3])
    assert run("q16_kpi_summary", m)[0]["repeat_customer_rate"] == 33.33
    assert run("q16_kpi_order_weighted", m)[0]["repeat_customer_rate"] == 60.0
    assert run("q6_6_repeat_rate", m)[0]["repeat_purchase_rate"] == 33.33


def test_no_delivered_orders(spark):
    m = make_mart(spark, customers=[{"customer_id": "c1", "customer_unique_id": "u1"}],
                  orders=[{"order_id": "o1", "customer_id": "c1", "order_status": "shipped"}],
                  order_items=[{"order_id": "o1"}])
    kpi = run("q16_kpi_summary", m)
    assert len(kpi) == 1 and kpi[0]["delivered_orders"] == 0 and kpi[0]["total_revenue"] is None
    assert run("q16_kpi_order_weighted", m) == []


def test_order_without_items(spark):
    m = make_mart(spark, customers=[{"customer_id": "c1", "customer_unique_id": "u1"}],
                  orders=[{"order_id": "o1", "customer_id": "c1"}, {"order_id": "o2", "customer_id": "c1"}],
                  order_items=[{"order_id": "o1"}])
    top = run("q15_1_top_orders", m)
    assert [r["order_id"] for r in top] == ["o1", "o2"]
    assert top[1]["item_count"] == 0 and top[1]["total_order_value"] is None
    assert [r["order_id"] for r in run("q4_7_order_financials", m)] == ["o1"]


def test_null_purchase_month_sorted_last(spark):
    m = make_mart(spark, orders=[{"order_id": "o1", "customer_id": "c1"},
                                 {"order_id": "o2", "customer_id": "c1", "order_purchase_timestamp": None}],
                  order_items=[{"order_id": "o1"}, {"order_id": "o2"}])
    rows = run("q5_3_monthly_revenue", m)
    assert [str(r["order_month"]) for r in rows] == ["2020-01-01", "None"]
    growth = run("q5_7_monthly_growth", m)
    assert growth[1]["previous_month_revenue"] == 11.0  # LAG sees the NULL month last, as PostgreSQL


def test_dense_rank_top3_keeps_ties(spark):
    prices = [10, 10, 5, 4, 3]
    items = [{"order_id": "o1", "order_item_id": i, "product_id": f"p{i}", "price": D(p)} for i, p in enumerate(prices)]
    products = [{"product_id": f"p{i}", "product_category_name": "cat"} for i in range(5)]
    m = make_mart(spark, orders=[{"order_id": "o1", "customer_id": "c1"}], order_items=items, products=products)
    out = run("q8_9_top3_per_category", m)
    assert [(r["product_id"], r["product_rank"]) for r in out] == [("p0", 1), ("p1", 1), ("p2", 2), ("p3", 3)]


def test_segment_order(spark):
    combos = [(5, 1, 1), (2, 3, 1), (1, 1, 1), (5, 5, 5), (3, 3, 3), (3, 1, 1)]
    df = spark.createDataFrame(combos, "r long, f long, m long")
    got = [r[0] for r in df.select(segment(F.col("r"), F.col("f"), F.col("m"))).collect()]
    assert got == ["Recent customers", "At risk", "Lost customers", "Champions", "Loyal customers",
                   "Potential customers"]


def test_category_fallback(spark):
    m = make_mart(spark,
                  products=[{"product_id": "p1", "product_category_name": "a"},
                            {"product_id": "p2", "product_category_name": "b"},
                            {"product_id": "p3", "product_category_name": None}],
                  product_category_name_translation=[{"product_category_name": "a",
                                                      "product_category_name_english": "A"}])
    out = {r["product_category"] for r in run("q8_1_products_by_category", m)}
    assert out == {"A", "b", "Unknown"}
    backfilled = run("ingest_backfill_categories", m)
    assert [(r["product_category_name"], r["product_category_name_english"]) for r in backfilled] == [
        ("a", "A"), ("b", "b")]


def test_blank_comments(spark):
    reviews = [{"review_id": f"r{i}", "order_id": "o1", "review_comment_message": msg}
               for i, msg in enumerate([None, "", "  ", "ok"])]
    m = make_mart(spark, order_reviews=reviews)
    assert run("q12_3_comment_rate", m) == [{"total_reviews": 4, "reviews_with_comments": 1, "comment_rate": 25.0}]


def test_delivered_on_estimate_is_on_time(spark):
    t = ts("2020-02-01 12:00:00")
    m = make_mart(spark, orders=[{"order_id": "o1", "customer_id": "c1", "order_delivered_customer_date": t,
                                  "order_estimated_delivery_date": t}])
    assert run("q11_4_on_time_vs_late", m)[0]["delivery_status"] == "On time"


def test_reconcile_tolerance(spark):
    m = make_mart(spark,
                  order_items=[{"order_id": "o1", "price": D("10.00"), "freight_value": D("0")},
                               {"order_id": "o2", "price": D("10.00"), "freight_value": D("0")}],
                  order_payments=[{"order_id": "o1", "payment_value": D("10.01")},
                                  {"order_id": "o2", "payment_value": D("10.02")},
                                  {"order_id": "o3", "payment_value": D("5.00")}])
    assert [r["order_id"] for r in run("q10_6_reconcile_totals", m)] == ["o2"]
    full = run("reconcile_totals_full", m)
    assert [(r["order_id"], r["difference"]) for r in full] == [("o3", 5.0), ("o2", 0.02)]


def test_review_average_is_item_weighted(spark):
    orders, items, reviews = [], [], []
    for i in range(20):
        orders.append({"order_id": f"o{i}", "customer_id": "c1"})
        n_items = 3 if i == 0 else 1
        for j in range(n_items):
            items.append({"order_id": f"o{i}", "order_item_id": j + 1, "product_id": "p1"})
        reviews.append({"review_id": f"r{i}", "order_id": f"o{i}", "review_score": 1 if i == 0 else 5})
    m = make_mart(spark, orders=orders, order_items=items, order_reviews=reviews,
                  products=[{"product_id": "p1", "product_category_name": "cat"}])
    out = run("q12_5_score_by_category", m)
    assert out == [{"product_category": "cat", "review_count": 20, "average_review_score": 4.45}]


def test_orders_are_dealt_over_more_tasks_as_items_grow(spark, monkeypatch):
    items = [{"order_id": f"o{i % 40}", "order_item_id": i, "product_id": "p1"} for i in range(100)] + [{"order_id": None, "product_id": "p1"}]
    reviews = [{"review_id": f"r{i}", "order_id": f"o{i % 40}" if i % 9 else None, "review_score": i % 5 + 1} for i in range(60)]
    m = make_mart(spark, order_items=items, order_reviews=reviews, products=[{"product_id": "p1", "product_category_name": "cat"}])
    before = run("q12_5_score_by_category", m)
    assert before[0]["review_count"] > 19 and grain.dealt_by_order(m.order_items)[0] is m.order_items
    monkeypatch.setattr(grain, "ITEMS_PER_TASK", 2)
    dealt = grain.dealt_by_order(m.order_items, m.order_reviews)
    assert [t.rdd.getNumPartitions() for t in dealt] == [51, 51]
    assert run("q12_5_score_by_category", m) == before


def test_null_state_is_different_state(spark):
    m = make_mart(spark, customers=[{"customer_id": "c1", "customer_unique_id": "u1", "customer_state": None}],
                  orders=[{"order_id": "o1", "customer_id": "c1"}], order_items=[{"order_id": "o1"}],
                  sellers=[{"seller_id": "s1", "seller_state": "SP"}])
    assert run("q13_4_same_vs_cross_state", m)[0]["transaction_type"] == "Different state"


def test_every_report_runs_on_empty_tables(spark):
    m = make_mart(spark)
    for key in REPORTS:
        run_report(key, m).collect()


def test_money_stays_exact(spark):
    items = [{"order_id": "o1", "order_item_id": i, "price": D("0.10"), "freight_value": D("0.20")} for i in range(10)]
    m = make_mart(spark, orders=[{"order_id": "o1", "customer_id": "c1"}], order_items=items)
    assert run("q4_4_product_revenue", m) == [{"product_revenue": 1.0}]
    assert Decimal(str(run("q4_6_total_order_value", m)[0]["total_order_value"])) == Decimal("3.0")


def test_item_with_a_missing_part_counts_in_no_total(spark):
    """(10.00, 1.00) and (20.00, NULL): price + freight is NULL for the second item, so all totals are 11.00."""
    m = make_mart(spark, customers=[{"customer_id": "c1", "customer_unique_id": "u1"}],
                  orders=[{"order_id": "o1", "customer_id": "c1", "order_purchase_timestamp": ts("2020-01-05 10:00:00")}],
                  order_items=[{"order_id": "o1", "order_item_id": 1, "price": D("10.00"), "freight_value": D("1.00")},
                               {"order_id": "o1", "order_item_id": 2, "price": D("20.00"), "freight_value": None}])
    for key, column in [("q4_6_total_order_value", "total_order_value"), ("q5_3_monthly_revenue", "total_revenue"),
                        ("q5_7_monthly_growth", "current_month_revenue"), ("q5_8_cumulative_revenue", "cumulative_revenue"),
                        ("q14_1_month_rank_in_year", "revenue"), ("q14_2_moving_avg_3m", "three_month_moving_average"),
                        ("q15_3_monthly_sales", "total_revenue"), ("q15_3_monthly_sales_view", "total_revenue")]:
        assert run(key, m)[0][column] == 11.0, key


def test_scores_outside_one_to_five_are_listed(spark):
    m = make_mart(spark, order_reviews=[{"review_id": f"r{s}", "order_id": "o1", "review_score": s} for s in (0, 1, 5, 6, None)])
    assert sorted(r["review_score"] for r in run("q2_10_invalid_scores", m)) == [0, 6]
