"""Texts that the near-duplicate stage keeps are not moved between executors, however many rows go."""

from __future__ import annotations

import random

import numpy as np
import pytest

from marketlens.llm import jaccard_join
from tests.llm.fixtures import documents, prose

THRESHOLDS = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.fixture()
def no_broadcast(spark):
    """As on tables whose list of dropped ids is too long to be broadcast."""
    before = {k: spark.conf.get(k, None) for k in THRESHOLDS}
    for k in THRESHOLDS:
        spark.conf.set(k, "-1")
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shuffled_bytes(df) -> int:
    """What the shuffles of a collected table wrote, uncompressed."""
    def of(node) -> int:
        if node.nodeName() == "AdaptiveSparkPlan":
            return of(node.executedPlan())
        if node.nodeName().endswith("QueryStage"):
            return of(node.plan())
        own = node.metrics().apply("dataSize").value() if node.nodeName() == "Exchange" else 0
        return own + sum(of(node.children().apply(i)) for i in range(node.children().size()))

    return of(df._jdf.queryExecution().executedPlan())


@pytest.mark.parametrize("repeated_ids", [False, True])
def test_kept_texts_are_not_shuffled(spark, no_broadcast, repeated_ids):
    rng = random.Random(15)
    single = [prose(rng, 400) for _ in range(300)]
    docs = documents(spark, single + single[:20])
    if repeated_ids:
        docs = docs.unionByName(docs.where("doc_id = 299"))
    kept = jaccard_join.keep_one_per_component(docs)
    rows = kept.collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(300)) and kept.columns == docs.columns
    assert [r["text"] for r in sorted(rows, key=lambda r: r["doc_id"])] == single
    assert shuffled_bytes(kept) < 0.3 * sum(map(len, single))


@pytest.mark.parametrize("full", [False, True])
def test_rows_that_the_bitmap_cannot_clear_are_joined(spark, monkeypatch, full):
    if full:
        monkeypatch.setattr(jaccard_join, "marked", lambda nodes, per_row: np.full(1 << 17, 255, dtype=np.uint8))
    docs = spark.createDataFrame([(f"k.{i}", i) for i in range(50)], "`a.id` string, id long")
    gone = docs.where("id % 7 = 0")
    kept = jaccard_join.without(docs, "id", gone)
    assert sorted(r["id"] for r in kept.collect()) == [i for i in range(50) if i % 7] and kept.columns == docs.columns
    assert jaccard_join.without(docs, "id", gone.limit(0)).count() == 50
