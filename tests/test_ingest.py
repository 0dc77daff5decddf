import os

import pytest

from marketlens.plans.registry import run_report
from marketlens.sources import manifest
from marketlens.sources.ingest import (
    IngestError, backfill_categories, prepare, preflight_sources, read_source_csv, run_ingest,
)
from marketlens.sources.mart import Mart
from marketlens.sources.schemas import LOAD_PLAN, LOAD_PLAN_BY_TABLE, TABLE_ORDER

CSV = {
    "product_category_name_translation.csv":
        "product_category_name,product_category_name_english\nbeleza,health_beauty\n",
    "customers.csv":
        "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
        "c1,u1,01001,sao paulo,SP\nc2,u1,NA,rio,RJ\n",
    "sellers.csv": "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,2000,campinas,SP\n",
    "products.csv":
        "product_id,product_category_name,product_name_lenght,product_description_lenght,product_photos_qty,"
        "product_weight_g,product_length_cm,product_height_cm,product_width_cm,extra\n"
        "p1,beleza,40,287,1,225,16,10,14,x\np2,brinquedos,44.0,,2,1000,30,18,20,y\n",
    "orders.csv":
        "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,"
        "order_delivered_customer_date,order_estimated_delivery_date\n"
        "o1,c1,delivered,2017-10-02 10:56:33,2017-10-02 11:07:15,not a date,2017-10-10 21:25:13,2017-10-18 00:00:00\n",
    "order_items.csv":
        "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
        "o1,1,p1,s1,2017-10-06 11:07:15,29.99,8.72\n",
    "order_payments.csv":
        "order_id,payment_sequential,payment_type,payment_installments,payment_value\no1,1,credit_card,1,38.71\n",
    "order_reviews.csv":
        "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,"
        "review_answer_timestamp\n"
        'r1,o1,4,,"line one\nline ""two""",2017-10-11 00:00:00,2017-10-12 03:43:48\n',
    "geolocation.csv":
        "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state\n"
        "1037,-23.54562128115268,-46.63929204800168,sao paulo,SP\n",
}


def _write(folder, files):
    for name, text in files.items():
        with open(os.path.join(folder, name), "w") as fh:
            fh.write(text)


def test_full_ingest(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "src")
    os.makedirs(src)
    files = dict(CSV)
    files["customer_export.csv"] = files.pop("customers.csv")  # an export with its own file name
    _write(src, files)
    res = run_ingest(spark, src, os.path.join(tmpdir_path, "mart"), file_names={"customers": "customer_export.csv"})
    assert res.written == res.stored and set(res.before.values()) == {0}
    assert res.categories_added == 1 and res.violations == {}
    assert res.coerced["orders"] == {"order_delivered_carrier_date": 1}
    mart = Mart.from_tables(spark, os.path.join(tmpdir_path, "mart"))
    assert set(res.tables) == set(TABLE_ORDER) and mart.manifest["rows"] == res.stored
    products = mart.products.orderBy("product_id").collect()
    assert products[0].product_name_length == 40 and "extra" not in products[0].asDict()
    assert products[1].product_name_length == 44 and products[1].product_description_length is None
    cust = mart.customers.orderBy("customer_id").collect()
    assert cust[0].customer_zip_code_prefix == 1001 and cust[1].customer_zip_code_prefix is None
    assert mart.customers.schema["customer_unique_id"].metadata["comment"].startswith("The person")
    review = mart.order_reviews.first()
    assert review.review_comment_message == 'line one\nline "two"' and review.review_comment_title is None
    geo = mart.geolocation.first()
    assert str(geo.geolocation_lat) == "-23.5456213" and geo.geolocation_id is not None
    lookup = {r[0]: r[1] for r in mart.product_category_name_translation.collect()}
    assert lookup == {"beleza": "health_beauty", "brinquedos": "brinquedos"}


def _load(spark, folder, mart, mode="overwrite", **changes):
    """Ingest the sample files with some of them changed (keyword = table)."""
    src = os.path.join(folder, f"src{len(os.listdir(folder))}")
    os.makedirs(src)
    _write(src, {**CSV, **{f"{t}.csv": text for t, text in changes.items()}})
    return run_ingest(spark, src, mart, mode)


HEADS = {name[:-4]: text.split("\n")[0] + "\n" for name, text in CSV.items()}
SECOND = {t: HEADS[t] for t in ("product_category_name_translation", "customers", "sellers", "products", "orders", "order_payments", "order_reviews")}


def test_reload_is_seen_by_reports_and_old_summary_is_not_used(spark, tmpdir_path):
    mart = os.path.join(tmpdir_path, "mart")
    _load(spark, tmpdir_path, mart)
    total = lambda: float(run_report("q4_6_total_order_value", Mart.from_tables(spark, mart)).first()[0])
    assert total() == 38.71
    _load(spark, tmpdir_path, mart, order_items=HEADS["order_items"] + "o1,1,p1,s1,2017-10-06 11:07:15,500.00,5.00\n")
    assert total() == 505.0
    # an item folder replaced behind the manifest's back: the summary made from other files is ignored
    m = Mart.from_tables(spark, mart)
    (folder,) = manifest.folders(spark, mart, "order_items", m.manifest)
    rows = [r.asDict() | {"price": r.price * 2} for r in m.order_items.collect()]
    spark.createDataFrame(rows, m.order_items.schema).write.mode("overwrite").parquet(folder)
    assert total() == 1005.0
    assert len(manifest.drop_unused(spark, mart)) == 1 and total() == 1005.0


def test_two_appends_and_unique_ids(spark, tmpdir_path):
    mart = os.path.join(tmpdir_path, "mart")
    _load(spark, tmpdir_path, mart)
    for n in (2, 3):
        res = _load(spark, tmpdir_path, mart, "append", **SECOND, order_items=HEADS["order_items"] + f"o1,{n},p1,s1,2017-10-06 11:07:15,10.00,1.00\n")
        assert res.before["order_items"] == n - 1 and res.written["order_items"] == 1 and res.stored["order_items"] == n
    m = Mart.from_tables(spark, mart)
    ids = [r[0] for r in m.geolocation.select("geolocation_id").collect()]
    assert len(ids) == 3 == len(set(ids)) and m.order_items.count() == 3
    assert float(run_report("q4_6_total_order_value", m).first()[0]) == 60.71


def test_rejected_load_leaves_the_old_tables(spark, tmpdir_path):
    mart = os.path.join(tmpdir_path, "mart")
    _load(spark, tmpdir_path, mart)
    bad = HEADS["order_items"] + "o1,1,p1,s1,2017-10-06 11:07:15,cheap,8.72\no9,3.7,p1,s1,2017-10-06 11:07:15,1.00,1.00\n"
    with pytest.raises(IngestError) as e:
        _load(spark, tmpdir_path, mart, order_items=bad)
    for rule in ("nn_order_items_price", "fk_order_items_order", "nn_order_items_order_item_id"):
        assert rule in str(e.value)
    with pytest.raises(IngestError):
        _load(spark, tmpdir_path, mart, "append")  # the same keys again
    m = Mart.from_tables(spark, mart)
    assert m.order_items.count() == 1 and m.manifest["rows"]["order_items"] == 1
    res = run_ingest(spark, os.path.join(tmpdir_path, "src2"), mart, gate=False)
    assert res.violations["nn_order_items_price"] == 1 and res.coerced["order_items"] == {"price": 1, "order_item_id": 1}


def test_append_needs_a_target(spark, tmpdir_path):
    with pytest.raises(IngestError) as e:
        _load(spark, tmpdir_path, os.path.join(tmpdir_path, "nothing"), "append")
    assert "orders" in str(e.value) and "geolocation" in str(e.value)


def test_published_table_without_a_column_is_an_error(spark, tmpdir_path):
    spark.createDataFrame([("s1",)], "seller_id string").write.parquet(os.path.join(tmpdir_path, "mart", "sellers"))
    with pytest.raises(ValueError, match="seller_city"):
        Mart.from_tables(spark, os.path.join(tmpdir_path, "mart")).sellers


def test_missing_files_listed_together(spark, tmpdir_path):
    with pytest.raises(IngestError) as e:
        preflight_sources(spark, [os.path.join(tmpdir_path, "a.csv"), os.path.join(tmpdir_path, "b.csv")])
    assert "a.csv" in str(e.value) and "b.csv" in str(e.value)


def test_missing_column_named(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "sellers.csv")
    with open(path, "w") as fh:
        fh.write("seller_id,seller_city\ns1,x\n")
    with pytest.raises(IngestError) as e:
        prepare(read_source_csv(spark, path), LOAD_PLAN_BY_TABLE["sellers"])
    assert "seller_zip_code_prefix" in str(e.value) and "seller_state" in str(e.value)


def test_backfill_only_missing_non_null(spark):
    products = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "product_category_name string")
    lookup = spark.createDataFrame([("a", "A")], "product_category_name string, product_category_name_english string")
    full, added = backfill_categories(products, lookup)
    assert [tuple(r) for r in added.collect()] == [("b", "b")]
    assert full.count() == 2


def test_load_plan_is_parent_first():
    tables = [s.table for s in LOAD_PLAN]
    assert tables.index("orders") < tables.index("order_items") and tables.index("customers") < tables.index("orders")
