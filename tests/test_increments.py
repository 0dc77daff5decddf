"""Appends: the order summary, the rules and the manifest as a load changes them, against making them anew."""

import json
import os
import random

import pytest

from marketlens.operators.grain import order_category_counts, order_summary
from marketlens.operators.quality import RULES, check_rules
from marketlens.plans.registry import run_report
from marketlens.sources import increments, manifest
from marketlens.sources.increments import Stored, changed_rules, meets, merged_rollups, rollups_are_current, spans_of
from marketlens.sources.ingest import IngestError
from marketlens.sources.mart import Mart
from marketlens.sources.schemas import SCHEMAS, TABLE_ORDER
from tests.conftest import D, SF_SMALL, make_mart
from tests.test_ingest import CSV, HEADS, SECOND, _load


def item(order, n, price="1.00", freight="0.10", product="p1", seller="s1"):
    return {"order_id": order, "order_item_id": n, "product_id": product, "seller_id": seller,
            "price": None if price is None else D(price), "freight_value": None if freight is None else D(freight)}


def key(i):
    return f"o{i:05d}"


def base_tables(orders=200):
    return {
        "product_category_name_translation": [{"product_category_name": "cat"}], "customers": [{"customer_id": f"c{i:05d}", "customer_unique_id": "u"} for i in range(orders)],
        "sellers": [{"seller_id": f"s{i}"} for i in range(1, 4)], "products": [{"product_id": f"p{i}"} for i in range(1, 4)],
        "orders": [{"order_id": key(i), "customer_id": f"c{i:05d}"} for i in range(orders)], "order_items": [item(key(i), 1) for i in range(orders)],
        "order_payments": [{"order_id": key(i)} for i in range(orders)], "order_reviews": [{"review_id": f"r{i}", "order_id": key(i)} for i in range(0, orders, 3)]}


def stored_mart(spark, root, files=8, **tables) -> Stored:
    """A published mart whose keyed files hold disjoint ranges, ready for appends."""
    make_mart(spark, **tables).write(root, files=files)
    return Stored.read(spark, root, manifest.read(spark, root))


def published(spark, root, stored, new, number):
    """Publishes the new rows of a mart as an append does."""
    run = f"run-test{number}"
    tables, files = {}, {}
    for t in TABLE_ORDER:
        new[t].orderBy(increments.RANGE_KEY[t]).write.parquet(f"{root}/{run}/{t}")
        tables[t] = stored.manifest["tables"][t] + [f"{run}/{t}"]
        files[t] = stored.files[t] + increments.file_ranges(spark, root, f"{run}/{t}", increments.RANGE_KEY[t])
    from marketlens.sources.mart import publish
    products = spark.read.parquet(*[f"{root}/{f}" for f in tables["products"]])
    publish(spark, root, tables, run, manifest.head(spark, root)[0], merged_rollups(new["order_items"], products, stored), files=files, violations=stored.manifest.get("violations"))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is not None, x) for x in r))


@pytest.fixture()
def many_files(spark):
    """Small tables keep their partitions, so that they have several files as large ones do."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


# order summary ----------------------------------------------------------------------------------------
def test_summary_after_appends_equals_a_rebuild(spark, tmpdir_path, many_files):
    """Repeated and NULL order ids, missing parts, orders before, between and after the stored ones."""
    rng, root = random.Random(1), os.path.join(tmpdir_path, "mart")
    tables = base_tables()
    tables["order_items"] += [item(None, 1), item(None, 2, None), item(key(7), 1, "5.00"), item(key(7), 2, None, "1.00")]
    stored = stored_mart(spark, root, **tables)
    for number in range(3):
        extra = [item(key(rng.randrange(-5, 260)), rng.randrange(3), rng.choice(["2.50", None]), rng.choice(["0.25", None])) for _ in range(25)]
        extra += [item(None, 5, "9.99")] * number + [item("a", 1, product="p2"), item("z", 1, product="p4")]
        published(spark, root, stored, make_mart(spark, order_items=extra, products=[{"product_id": "p4", "product_category_name": None}] if not number else []).frames, number)
        m = Mart.from_tables(spark, root)
        assert rollups_are_current(spark, root, m.manifest)
        assert rows(m._published("order_summary")) == rows(order_summary(m.order_items))
        assert rows(m.order_category_counts) == rows(order_category_counts(m.order_items, m.products))
        assert m.order_summary.columns == order_summary(m.order_items).columns
        assert [f.dataType for f in m.order_summary.schema] == [f.dataType for f in order_summary(m.order_items).schema]
        stored = Stored.read(spark, root, m.manifest)


def test_append_reads_and_writes_only_the_ranges_it_touches(spark, tmpdir_path, many_files):
    root = os.path.join(tmpdir_path, "mart")
    stored = stored_mart(spark, root, **base_tables(400))
    before = stored.files["order_summary"]
    assert len(before) >= 4
    new = make_mart(spark, order_items=[item(key(401), 1), item(key(402), 1), item(before[-1]["high"], 2)]).frames["order_items"]
    both = merged_rollups(new, spark.read.parquet(*[f"{root}/{f}" for f in stored.manifest["tables"]["products"]]), Stored(spark, root, stored.manifest | {"violations": {}}))
    assert set(both) == {"order_summary", "order_category_counts"} and both["order_category_counts"][1] == stored.files["order_category_counts"][:-1]
    merged, rest = both["order_summary"]
    assert rest == before[:-1]
    read = {f.rsplit("/", 1)[-1] for f in merged.inputFiles()}
    assert read & {f["file"].rsplit("/", 1)[-1] for f in before} == {before[-1]["file"].rsplit("/", 1)[-1]}
    assert not any(f["file"].rsplit("/", 1)[-1] in read for f in stored.files["order_items"])
    assert merged.count() == before[-1]["rows"] + 2
    published(spark, root, stored, make_mart(spark, order_items=[item(key(401), 1)]).frames, 9)
    kept = {f["file"] for f in manifest.read(spark, root)["files"]["order_summary"]}
    assert {f["file"] for f in before} <= kept and len(kept) == len(before) + 1  # an order past all ranges moves nothing


def test_rollups_made_anew_when_files_changed(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "mart")
    stored_mart(spark, root, **base_tables(20))
    m = manifest.read(spark, root)
    assert rollups_are_current(spark, root, m) and not rollups_are_current(spark, root, None)
    assert not rollups_are_current(spark, root, m | {"rollups_of": "other"})
    assert not rollups_are_current(spark, root, {k: v for k, v in m.items() if k != "files"})


def test_category_counts_made_anew_where_items_lack_a_product(spark, tmpdir_path):
    """The product of a stored item comes with a later load: its items count from then on."""
    root, tables = os.path.join(tmpdir_path, "mart"), base_tables(20)
    tables["order_items"] += [item(key(3), 2, product="late")]
    stored = stored_mart(spark, root, **tables)
    stored = Stored(spark, root, stored.manifest | {"violations": {"fk_order_items_product": 1}})
    published(spark, root, stored, make_mart(spark, products=[{"product_id": "late", "product_category_name": "new"}], order_items=[item(key(4), 2)]).frames, 1)
    m = Mart.from_tables(spark, root)
    assert rows(m.order_category_counts) == rows(order_category_counts(m.order_items, m.products))
    assert (key(3), "new", 1) in rows(m.order_category_counts)


def test_category_scores_read_no_item_of_a_published_mart(spark, tmpdir_path):
    m = Mart.from_testdata(spark, SF_SMALL).write(os.path.join(tmpdir_path, "mart"))
    report = run_report("q12_5_score_by_category", m)
    assert not {f.rsplit("/", 1)[-1] for f in report.inputFiles()} & {f.rsplit("/", 1)[-1] for f in m.order_items.inputFiles()}
    assert rows(report) == rows(run_report("q12_5_score_by_category", Mart.from_testdata(spark, SF_SMALL)))


def test_spans_and_files(spark):
    keys = spark.createDataFrame([(key(i),) for i in (3, 4, 5, 90, 91)] + [(None,)], "k string")
    spans = spans_of(keys, "k")
    assert spans[0][0] == key(3) and spans[-1][1] == key(91) and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    spans = [(key(3), key(5)), (key(90), key(91))]
    file = lambda low, high, nulls=0: {"low": low, "high": high, "nulls": nulls}
    assert [meets(file(key(a), key(b)), spans) for a, b in ((0, 2), (0, 3), (4, 4), (5, 7), (6, 89), (80, 95), (91, 99), (92, 99))] == [False, True, True, True, False, True, True, False]
    assert meets(file(None, None, 2), spans, True) and not meets(file(None, None, 2), spans) and not meets(file(key(0), key(99)), [])


# rules ------------------------------------------------------------------------------------------------
NEW = {  # what the loads of the tests add
    "good": {"orders": [{"order_id": key(300), "customer_id": "c00300"}], "customers": [{"customer_id": "c00300", "customer_unique_id": "u"}],
             "order_items": [item(key(300), 1), item(key(5), 2)], "order_payments": [{"order_id": key(5), "payment_sequential": 2}]},
    "stored keys again": {"orders": [{"order_id": key(3), "customer_id": "c00003"}], "order_items": [item(key(4), 1), item(key(4), 2), item(key(150), 1)],
                          "sellers": [{"seller_id": "s2"}], "order_reviews": [{"review_id": "r3", "order_id": key(3)}, {"review_id": "r3", "order_id": key(4)}]},
    "keys twice in the load": {"order_items": [item(key(9), 4), item(key(9), 4), item(key(9), 4)], "products": [{"product_id": "p9"}, {"product_id": "p9"}]},
    "keys missing": {"order_items": [item(None, 1), item(key(1), None)], "orders": [{"order_id": None, "customer_id": "c00001"}]},
    "orphans": {"order_items": [item("nowhere", 1), item("nowhere", 2), item(key(2), 7, product="p77", seller="s77")], "orders": [{"order_id": key(777), "customer_id": "c77777"}],
                "order_payments": [{"order_id": "zzz"}], "order_reviews": [{"review_id": "x", "order_id": "aaa"}], "products": [{"product_id": "p5", "product_category_name": "none"}]},
    "values": {"order_items": [item(key(8), 0, "-1.00", None)], "order_reviews": [{"review_id": "y", "order_id": key(8), "review_score": 9}], "geolocation": [{"geolocation_id": 1, "geolocation_zip_code_prefix": 1, "geolocation_lat": D(91)}]},
    "nothing": {},
}


def full_gate(spark, root, stored, new):
    tables = {t: spark.read.schema(SCHEMAS[t]).parquet(*[f"{root}/{f}" for f in stored.manifest["tables"][t]]).unionByName(new[t]) for t in TABLE_ORDER}
    return tables, {r["rule"]: r["violations"] for r in check_rules(tables).where("violations > 0").collect()}


@pytest.fixture(scope="module")
def clean(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("clean") / "mart")
    stored = stored_mart(spark, root, **base_tables())
    return root, Stored(spark, root, stored.manifest | {"violations": {}})


@pytest.mark.parametrize("load", NEW)
def test_changed_rules_give_the_verdict_of_the_whole_job(spark, clean, load):
    root, stored = clean
    new = make_mart(spark, **NEW[load]).frames
    tables, want = full_gate(spark, root, stored, new)
    assert changed_rules(new, stored, lambda t: pytest.fail(f"reads all of {t}")) == want
    assert (want == {}) == (load in ("good", "nothing"))


@pytest.mark.parametrize("load", ["good", "orphans"])
def test_rules_a_mart_already_breaks_are_checked_whole(spark, tmpdir_path, load):
    root, tables = os.path.join(tmpdir_path, "mart"), base_tables(60)
    tables["order_items"] += [item(key(4), 1), item(key(300), 3), item("nowhere", 3)]  # a key twice, orphans of which a load mends one
    stored = stored_mart(spark, root, **tables)
    new = make_mart(spark, **NEW[load]).frames
    broken = {r["rule"]: r["violations"] for r in check_rules({t: spark.read.schema(SCHEMAS[t]).parquet(*[f"{root}/{f}" for f in stored.manifest["tables"][t]]) for t in TABLE_ORDER}).where("violations > 0").collect()}
    assert broken == {"pk_order_items": 1, "fk_order_items_order": 2}
    whole, want = full_gate(spark, root, stored, new)
    assert changed_rules(new, Stored(spark, root, stored.manifest | {"violations": broken}), whole.__getitem__) == want
    assert changed_rules(new, stored, whole.__getitem__) == want  # nothing is known of the mart


def test_new_keys_are_looked_up_in_files_that_may_hold_them(spark, clean):
    root, stored = clean
    new = make_mart(spark, order_items=[item(key(199), 2)]).frames
    rule = next(r for r in RULES if r.name == "pk_order_items")
    plan = increments._primary(rule, new, stored)
    read = {f.rsplit("/", 1)[-1] for f in plan.inputFiles()}
    held = {f["file"].rsplit("/", 1)[-1]: f for f in stored.files["order_items"]}
    assert len(held) > 3 and [f["high"] for name, f in held.items() if name in read] == [key(199)]
    scans = [line for line in plan._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in line]
    assert scans and all("ReadSchema: struct<order_id:string,order_item_id:int>" in line for line in scans)  # key columns only
    rule = next(r for r in RULES if r.name == "fk_order_items_order")
    read = {f.rsplit("/", 1)[-1] for f in increments._foreign(rule, new, stored).inputFiles()}
    assert sum(f["file"].rsplit("/", 1)[-1] in read for f in stored.files["orders"]) == 1


# manifest ---------------------------------------------------------------------------------------------
def test_of_two_loads_from_one_manifest_the_second_fails(spark, tmpdir_path):
    root = tmpdir_path
    manifest.write(spark, root, {"tables": {}, "n": 1}, 0)
    base, _ = manifest.head(spark, root)
    manifest.write(spark, root, {"tables": {}, "n": 2}, base)
    with pytest.raises(OSError, match="meanwhile"):
        manifest.write(spark, root, {"tables": {}, "n": 3}, base)
    assert manifest.read(spark, root)["n"] == 2 and manifest.head(spark, root)[0] == 2


def test_racing_loads_keep_the_first(spark, tmpdir_path, monkeypatch):
    """The second load starts and publishes while the first is about to."""
    mart = os.path.join(tmpdir_path, "mart")
    _load(spark, tmpdir_path, mart)
    real, seen = increments.changed_rules, []

    def slow(*args, **kwargs):
        if not seen:
            seen.append(1)
            _load(spark, tmpdir_path, mart, "append", **SECOND, geolocation=HEADS["geolocation"], order_items=HEADS["order_items"] + "o1,2,p1,s1,2017-10-06 11:07:15,10.00,1.00\n")
        return real(*args, **kwargs)

    monkeypatch.setattr(increments, "changed_rules", slow)
    with pytest.raises(OSError, match="meanwhile"):
        _load(spark, tmpdir_path, mart, "append", **SECOND, geolocation=HEADS["geolocation"], order_items=HEADS["order_items"] + "o1,3,p1,s1,2017-10-06 11:07:15,20.00,1.00\n")
    m = Mart.from_tables(spark, mart)
    assert sorted(r.order_item_id for r in m.order_items.collect()) == [1, 2]
    assert rows(m._published("order_summary")) == rows(order_summary(m.order_items))


def test_an_unfinished_manifest_is_not_read_and_not_built_on(spark, tmpdir_path):
    manifest.write(spark, tmpdir_path, {"tables": {}, "n": 1})
    with open(os.path.join(tmpdir_path, "_manifest-2.json"), "w") as fh:
        fh.write(json.dumps({"tables": {}})[:5])
    assert manifest.read(spark, tmpdir_path)["n"] == 1
    with pytest.raises(OSError, match="incomplete"):
        manifest.head(spark, tmpdir_path)


def test_append_to_a_mart_that_was_published_whole(spark, tmpdir_path):
    """No ranges, no verdict: the first append reads them once, the next one has them."""
    src, mart = os.path.join(tmpdir_path, "first"), os.path.join(tmpdir_path, "mart")
    _load(spark, tmpdir_path, src)
    Mart.from_tables(spark, src).write(mart)
    assert "violations" not in manifest.read(spark, mart)
    res = _load(spark, tmpdir_path, mart, "append", **SECOND, order_items=HEADS["order_items"] + "o1,2,p1,s1,2017-10-06 11:07:15,10.00,1.00\n")
    assert res.stored["order_items"] == 2 and manifest.read(spark, mart)["violations"] == {}
    with pytest.raises(IngestError, match="pk_order_items"):
        _load(spark, tmpdir_path, mart, "append", **SECOND, order_items=CSV["order_items.csv"])
