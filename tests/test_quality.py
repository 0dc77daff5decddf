from marketlens.operators.quality import RULES, check_rules, constraints_catalog, duplicates, orphans, violating_rows
from tests.conftest import D, collect, make_mart


def test_duplicates_and_orphans(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5)], "k string, v int")
    got = {(r.k, r.duplicate_count) for r in duplicates(df, ["k"]).collect()}
    assert got == {(None, 2), ("a", 2)}
    parent = spark.createDataFrame([("a",)], "k string")
    assert sorted(r.v for r in orphans(df, parent, "k").collect()) == [3, 4, 5]  # NULL keys kept
    assert sorted(r.v for r in orphans(df, parent, "k", keep_null_keys=False).collect()) == [3]


def test_rule_report_counts_violations(spark):
    m = make_mart(spark,
                  customers=[{"customer_id": "c1", "customer_unique_id": "u1", "customer_zip_code_prefix": None},
                             {"customer_id": "c1", "customer_unique_id": "u2", "customer_zip_code_prefix": -5}],
                  orders=[{"order_id": "o1", "customer_id": "c9", "order_status": "lost"}],
                  order_items=[{"order_id": "o1", "price": D("-1.00")}],
                  order_reviews=[{"review_id": "r1", "order_id": "o1", "review_score": 9}])
    report = {r["rule"]: r["violations"] for r in collect(check_rules(m.tables()))}
    assert report["customers_pkey"] == 1
    assert report["chk_customer_zip_code"] == 1          # NULL zip passes the CHECK
    assert report["fk_orders_customer"] == 1
    assert report["chk_order_status"] == 1
    assert report["chk_order_item_price"] == 1
    assert report["chk_review_score"] == 1
    assert report["fk_order_items_product"] == 1         # product p1 absent
    assert report["len_customers_customer_state"] == 0
    assert len(report) == len(RULES)
    assert collect(violating_rows(m.tables(), "chk_review_score"))[0]["review_id"] == "r1"


def test_constraints_catalog_order(spark):
    rows = collect(constraints_catalog(spark))
    keys = [(r["table_name"], r["constraint_type"], r["constraint_name"]) for r in rows]
    assert keys == sorted(keys)
    assert ("order_items", "PRIMARY KEY", "pk_order_items") in keys
