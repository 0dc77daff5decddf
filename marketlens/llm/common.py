"""Helpers shared by the operators: input tables, shared scratch tables, memo tables for words."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.session import scratch_path

#: Characters handed to one Python step at a time; a single longer text is one step of its own.
STEP_CHARS = 1_000_000
#: What Spark hands to a Python worker at a time, the rows that it reads from Parquet at a time, and the bytes of a Parquet row group that it writes.
BATCH_BYTES, READ_ROWS, GROUP_BYTES = "4m", "256", str(8 << 20)
#: The byte values that separate words in every word contract: \x20 and \x09-\x0D (what bytes.split() uses).
SPACES = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_crc(col: str | Column) -> Column:
    """crc32 of an id written as text; a null id counts as the empty text."""
    c = F.col(col) if isinstance(col, str) else col
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary"))


def hash_share(value: str | Column, part: float) -> Column:
    """Whether a value is among about this share of all values, drawn by hash in steps of 2^-63; ``part`` below 1."""
    return F.xxhash64(value).bitwiseAND(F.lit((1 << 63) - 1)) < F.lit(int(part * (1 << 63)))


def small_batches(spark: SparkSession) -> None:
    """Bounds what Spark holds of texts at a time, unless the deployment has set bounds.

    By default ten thousand rows and 64 MB go to a Python worker at a time, four thousand rows are
    read from Parquet at a time and row groups of 128 MB are gathered before they are written. With
    texts, that is much memory several times over, in the executor (whose heap grows by arrays too
    large for its young generation, and stays so) and in each of its workers. Results do not depend on it.
    """
    given = spark.sparkContext.getConf()
    for key, value in (("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES), ("spark.sql.parquet.columnarReaderBatchSize", READ_ROWS), ("parquet.block.size", GROUP_BYTES)):
        if not given.contains(key) and not given.contains(f"spark.hadoop.{key}"):
            spark.conf.set(key, value)


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the jobs inside are deleted when each job ends, not when the driver collects its garbage.

    For jobs that store their result: what they shuffled is never read again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


class Scratch:
    """Parquet tables in the session's shared checkpoint folder; used to cut lineage.

    A lost executor only costs the tasks that read these files again.
    ``drop`` removes a table that no later step reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base = spark, scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def put(self, df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
        with shuffles_released(self.spark):
            df.write.mode("overwrite").parquet(self.path(name), compression=compression)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


class Memo(dict):
    """word -> value with a bounded number of entries.

    Two generations: when the young one is full it becomes the old one, and
    entries still in use move back on their next lookup. What is dropped is
    computed again, so results do not depend on the bound.
    """

    def __init__(self, compute: Callable, limit: int = 400_000):
        super().__init__()
        self.compute, self.limit, self.old = compute, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        self.admit(key, value)
        return value

    def admit(self, key, value) -> None:
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value


#: What this worker keeps for its next task, by name; see ``kept_by_worker``.
_kept: dict[str, object] = {}


def kept_by_worker(name: str, make: Callable):
    """What ``make`` returned when this worker first asked for ``name``, until its texts are read for something else."""
    if name not in _kept:
        _kept[name] = make()
    return _kept[name]


def texts_in_steps(batches: Iterable[pa.RecordBatch], column: str = "text", chars: int = STEP_CHARS, keep: str | None = None) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """(rows, their texts; null as "") in steps of about ``chars`` characters.

    Of what the worker keeps, all but ``keep`` is dropped: a worker that is used again by another
    stage would hold its words next to that stage's arrays.
    """
    for name in [x for x in _kept if x != keep]:
        del _kept[name]
    gc.set_threshold(100_000, 50, 1000)  # large memo tables hold no cycles; scanning them again and again costs more than it frees
    for batch in batches:
        texts = [t or "" for t in batch.column(column).to_pylist()]
        start, size = 0, 0
        for i, t in enumerate(texts):
            if size and size + len(t) > chars:
                yield batch.slice(start, i - start), texts[start:i]
                start, size = i, 0
            size += len(t)
        if start < len(texts):
            yield batch.slice(start), texts[start:]
        del batch, texts
        pa.default_memory_pool().release_unused()  # a worker that is used again would keep what its largest batch took
