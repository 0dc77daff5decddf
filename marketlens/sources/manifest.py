"""Manifest of a published mart: which folders make up each table.

Every load writes into folders of its own (``<root>/<run>/<table>``) and then
creates one small file, ``_manifest-<n>.json`` with the next number. The highest
complete one counts, so readers see either the old tables or the new ones, and a
load that fails midway changes nothing. A file of that name is created once: of
two loads that began from the same manifest the second fails, on every store
where creating without overwriting is one step. A mart folder without a
manifest is read as ``<root>/<table>``; a table may be named by folders or by files.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

NAME = re.compile(r"_manifest-(\d+)\.json")


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the path is there; any other storage error is raised as it is."""
    p, fs = _path(spark, path)
    return bool(fs.exists(p))


def _numbers(spark: SparkSession, root: str) -> list[int]:
    p, fs = _path(spark, root)
    if not fs.exists(p):
        return []
    found = (NAME.fullmatch(f.getPath().getName()) for f in fs.listStatus(p))
    return sorted((int(m[1]) for m in found if m), reverse=True)


def _load(spark: SparkSession, root: str, number: int) -> dict | None:
    """The manifest of this number; None if it isn't written to its end."""
    p, fs = _path(spark, f"{root.rstrip('/')}/_manifest-{number}.json")
    stream = fs.open(p)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    except json.JSONDecodeError:
        return None
    finally:
        stream.close()


def read(spark: SparkSession, root: str) -> dict | None:
    """The published manifest; one that is just being written doesn't count yet."""
    return next((m for n in _numbers(spark, root) if (m := _load(spark, root, n)) is not None), None)


def head(spark: SparkSession, root: str) -> tuple[int, dict | None]:
    """(number, manifest) that a load builds on; (0, None) without one."""
    number = next(iter(_numbers(spark, root)), 0)
    manifest = _load(spark, root, number) if number else None
    if number and manifest is None:
        raise OSError(f"{root}/_manifest-{number}.json is incomplete: another load is publishing, or died while it did; in that case delete this file")
    return number, manifest


def write(spark: SparkSession, root: str, manifest: dict, base: int | None = None) -> None:
    """Publishes the manifest after number ``base`` (the highest, if not given); fails if another load published meanwhile."""
    root = root.rstrip("/")
    number = (next(iter(_numbers(spark, root)), 0) if base is None else base) + 1
    if any(n >= number for n in _numbers(spark, root)):
        raise OSError(f"{root} has a manifest {number}: another load published meanwhile")
    final, fs = _path(spark, f"{root}/_manifest-{number}.json")
    try:
        stream = fs.create(final, False)
    except Py4JJavaError as e:
        raise OSError(f"{final} can't be created: another load published meanwhile") from e
    try:
        stream.write(bytearray(json.dumps(manifest, indent=1).encode()))
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def new_run() -> str:
    """Name of a load's own folder."""
    return f"run-{datetime.now(timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"


def drop_unused(spark: SparkSession, root: str) -> list[str]:
    """Deletes the folders of earlier loads of which the current manifest names nothing; their names."""
    manifest = read(spark, root)
    if manifest is None:
        return []
    used = {n.split("/")[0] for names in manifest["tables"].values() for n in names}
    p, fs = _path(spark, root)
    old = [f.getPath() for f in fs.listStatus(p) if f.isDirectory() and f.getPath().getName().startswith("run-") and f.getPath().getName() not in used]
    for folder in old:
        fs.delete(folder, True)
    return sorted(f.getName() for f in old)


def folders(spark: SparkSession, root: str, table: str, manifest: dict | None) -> list[str]:
    """The folders or files of a table, as full paths."""
    names = (manifest or {}).get("tables", {}).get(table, [table])
    return [f"{root.rstrip('/')}/{n}" for n in names]


def files_digest(*tables: DataFrame) -> str:
    """Digest of the names of the files behind tables; file names are unique to a write."""
    names = sorted(f.rsplit("/", 1)[-1] for df in tables for f in df.inputFiles())
    return hashlib.sha256("\n".join(names).encode()).hexdigest()
