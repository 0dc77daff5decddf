import os

from marketlens.__main__ import main
from tests.conftest import SF_SMALL


def test_publish_report_check_sql(spark, tmpdir_path):
    mart, out = os.path.join(tmpdir_path, "mart"), os.path.join(tmpdir_path, "out")
    assert main(["publish", SF_SMALL, mart]) == 0
    assert main(["report", "--mart", mart, "--out", out, "q4_*", "q16_kpi_summary"]) == 0
    assert spark.read.parquet(os.path.join(out, "q16_kpi_summary")).count() == 1
    assert spark.read.parquet(os.path.join(out, "q4_3_orders_by_status")).count() == 3
    assert main(["check", "--mart", mart, "--out", os.path.join(out, "dq")]) == 0
    assert spark.read.parquet(os.path.join(out, "dq")).count() == 84
    sql = "SELECT COUNT(*) AS n FROM vw_order_financial_summary WHERE item_count = 0"
    assert main(["sql", "--mart", mart, "--out", os.path.join(out, "sql"), sql]) == 0
    assert spark.read.parquet(os.path.join(out, "sql")).first().n > 0
    assert main(["report", "--mart", mart, "no_such_key"]) == 2
    assert main(["report", "--mart", mart, "--explain", "q4_7_order_financials"]) == 0


def test_ingest_with_own_file_names(spark, tmpdir_path):
    from tests.test_ingest import CSV, _write
    src, mart = os.path.join(tmpdir_path, "src"), os.path.join(tmpdir_path, "mart")
    os.makedirs(src)
    files = dict(CSV)
    files["shop_orders_2017.csv"] = files.pop("orders.csv")
    _write(src, files)
    assert main(["ingest", src, mart, "--file", "orders=shop_orders_2017.csv"]) == 0
    assert main(["ingest", src, mart, "--file", "nope=x.csv"]) == 2
    assert main(["report", "--mart", mart, "--out", os.path.join(tmpdir_path, "out"), "q4_1_total_orders"]) == 0
