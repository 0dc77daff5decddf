import os

from marketlens.sources.catalog import describe, drop_tables, list_tables
from marketlens.sources.ingest import tables_missing
from marketlens.sources.mart import Mart
from marketlens.sources.schemas import TABLE_ORDER
from tests.conftest import SF_SMALL


def test_catalog_lifecycle(spark, tmpdir_path):
    db = "ml_catalog_" + os.path.basename(tmpdir_path).replace("-", "_")
    Mart.from_testdata(spark, SF_SMALL).write_bucketed(db, tmpdir_path + "/wh", buckets=2)
    names = [r.table_name for r in list_tables(spark, db).collect()]
    assert names == sorted(names) and set(TABLE_ORDER) <= set(names)
    assert tables_missing(spark, [f"{db}.orders", f"{db}.nope"]) == [f"{db}.nope"]
    about = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED `{db}`.`orders`").select("col_name", "data_type").collect()}
    assert about["Comment"].startswith("One row per order")
    drop_tables(spark, list(reversed(TABLE_ORDER)) + ["order_summary"], database=db)
    assert list_tables(spark, db).count() == 0


def test_describe_carries_comments(spark):
    rows = describe(spark).collect()
    comments = {(r.table_name, r.column_name): r.comment for r in rows}
    assert comments[("customers", "customer_unique_id")].startswith("The person")
    assert comments[("orders", None)].startswith("One row per order")
    assert sum(1 for r in rows if r.column_name) == sum(len(s) for s in __import__(
        "marketlens.sources.schemas", fromlist=["SCHEMAS"]).SCHEMAS.values())
