"""Every report against its DuckDB oracle on the smallest generated data set."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tools.oracle_check import compare, duck

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_matches_oracle(spark, con, key):
    got = QUERIES[key](spark, SF_SMALL).toPandas()
    want = con.execute(ORACLES[key]).df()
    assert compare(got, want) is None


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 1 and "delivered_orders" in df.columns


def test_every_report_has_an_oracle():
    from marketlens.plans import REPORTS
    assert set(REPORTS) <= set(ORACLES)


@pytest.fixture(scope="module", params=["folder", "bucketed"])
def published(spark, request, tmp_path_factory):
    """The same data as a published mart (with its stored order summary)."""
    from marketlens.sources.mart import Mart
    root = str(tmp_path_factory.mktemp("published"))
    source = Mart.from_testdata(spark, SF_SMALL)
    mart = source.write(root) if request.param == "folder" else source.write_bucketed("ml_oracle_" + root.rsplit("-", 1)[-1][-6:].replace("/", "_"), root, buckets=4)
    assert mart._summary_of() is not None
    return mart


@pytest.mark.parametrize("key", sorted(k for k in ORACLES if k not in ("ingest_backfill_categories",)))
def test_published_mart_matches_oracle(con, published, key):
    from marketlens.plans import REPORTS
    from marketlens.plans.registry import run_report
    if key not in REPORTS:
        pytest.skip("no report over the mart")
    assert compare(run_report(key, published, doubles=True).toPandas(), con.execute(ORACLES[key]).df()) is None
