"""What executors and their Python workers hold of texts at a time is bounded, and results do not depend on the bounds."""

from __future__ import annotations

import random
import tracemalloc

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from marketlens.llm import jaccard_join, packing
from marketlens.llm.common import Scratch, small_batches, texts_in_steps
from tests.llm.fixtures import documents, odd_texts, prose

BOUNDS = ("spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.parquet.columnarReaderBatchSize", "parquet.block.size")


@pytest.fixture()
def unbounded(spark):
    """As in a session that has run no operator yet."""
    before = {k: spark.conf.get(k, None) for k in BOUNDS}
    for k in BOUNDS:
        spark.conf.unset(k)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_stored_texts_are_written_and_read_in_small_parts(spark, unbounded):
    small_batches(spark)
    scratch = Scratch(spark, "test-groups")
    stored = scratch.put(spark.range(0, 400_000, 1, 1).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text")), "texts")
    [file] = [f.removeprefix("file://") for f in stored.inputFiles()]
    assert pq.ParquetFile(file).num_row_groups > 2
    assert int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")) <= 512
    assert stored.agg(F.sum("id"), F.countDistinct("text")).first()[:] == (399_999 * 200_000, 400_000)
    scratch.drop("texts")


def test_words_of_packing_are_dropped_when_texts_are_read_for_something_else():
    path, batches = packing.vocabulary(), [pa.RecordBatch.from_pydict({"text": ["a few words", None]})]
    first = packing.word_ids(path)
    ids = first("a few words")
    assert [t for _, t in texts_in_steps(batches, keep=f"words of {path}")] == [["a few words", ""]]
    assert packing.word_ids(path) is first
    assert [t for _, t in texts_in_steps(batches)] == [["a few words", ""]]
    assert packing.word_ids(path) is not first and packing.word_ids(path)("a few words") == ids


def test_the_near_duplicate_join_bounds_batches_by_itself(spark, unbounded):
    jaccard_join.JaccardJoin(documents(spark, ["a"]))
    assert all(spark.conf.get(k, None) for k in BOUNDS) and int(spark.conf.get(BOUNDS[1])) <= 512


def test_hashing_shingles_takes_little_memory_at_a_time():
    rng = random.Random(21)
    batches = [pa.RecordBatch.from_pydict({"text": [prose(rng, 400) for _ in range(1000)]})]
    tracemalloc.start()
    hasher = jaccard_join.Hasher()
    for _, texts in texts_in_steps(batches, chars=jaccard_join.HASH_CHARS):
        hasher.sets(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40_000_000  # tables for 2^21 bytes alone would take 34 MB


def test_components_do_not_depend_on_how_much_a_task_gathers(spark, monkeypatch):
    rng = random.Random(22)
    words = [prose(rng, 60).split() for _ in range(30)]
    texts = odd_texts() + [" ".join(w) for w in words] + [" ".join(w[:-1] + ["changed"]) for w in words[:15]]
    docs = documents(spark, texts)

    def found() -> list:
        return sorted(map(tuple, jaccard_join.near_duplicate_components(docs).collect()))

    whole = found()
    assert len(whole) == len(texts)
    for name, value in (("HASH_CHARS", 300), ("COUNTED", 100), ("LISTED", 40)):
        monkeypatch.setattr(jaccard_join, name, value)
    assert found() == whole
