"""What an append needs to know of the mart it adds to, so that it costs in proportion to the load.

* The manifest has the key range of every file (``file_ranges``). Keys of a load
  are looked up only in files whose range meets the load's own ranges
  (``Stored.meeting``), and only their key columns are read.
* ``changed_rules`` gives the verdict of the whole rule job from the new rows: row
  rules see only them, a new key is looked up among the stored ones, a new
  reference among new and stored parents. Rows are only added, so a stored
  reference can't lose its parent. A rule that the stored mart breaks is checked
  on everything, as an append may mend it.
* ``merged`` keeps the rollups of the items (order summary, items per order and
  category): sums of the new items are added to the stored sums of the ranges
  they meet; the other files stay as they are.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.operators.grain import order_category_counts, order_summary
from marketlens.operators.quality import RULES, Rule, check_rules
from marketlens.sources import manifest as manifests
from marketlens.sources.schemas import PRIMARY_KEYS, SCHEMAS, TABLE_ORDER

#: The column whose range is kept for each table's files.
RANGE_KEY = {t: PRIMARY_KEYS[t][0] for t in TABLE_ORDER} | {"order_summary": "order_id", "order_category_counts": "order_id"}
#: Rollups of the items: their grouping columns. All else in them is sums.
ROLLUPS = {"order_summary": ("order_id",), "order_category_counts": ("order_id", "product_category_name")}

Spans = list[tuple]


def file_ranges(spark: SparkSession, root: str, folder: str, key: str) -> list[dict]:
    """One entry for each file of a folder: its rows, rows without a key, smallest and largest key. Reads the key column only."""
    found = spark.read.parquet(f"{root}/{folder}").groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col(key).isNull()).alias("nulls"), F.min(key).alias("low"), F.max(key).alias("high"))
    return [r.asDict() | {"file": f"{folder}/{r['file'].rsplit('/', 1)[-1]}"} for r in found.orderBy("file").collect()]  # one row a file


def spans_of(keys: DataFrame, key: str) -> Spans:
    """Ascending ranges that hold every key of the load, from one range partitioning of that column into shuffle partitions."""
    spans = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = keys.select(key).where(F.col(key).isNotNull()).repartitionByRange(spans, key).groupBy(F.spark_partition_id().alias("p"))
    return sorted((r["low"], r["high"]) for r in parts.agg(F.min(key).alias("low"), F.max(key).alias("high")).collect())  # one row a partition


def meets(file: dict, spans: Spans, nulls: bool = False) -> bool:
    """Whether a file may hold a key of the spans, or rows without a key if ``nulls``."""
    if nulls and file["nulls"]:
        return True
    if file["low"] is None:
        return False
    at = bisect_left(spans, file["low"], key=lambda s: s[1])  # the first span that doesn't end before the file
    return at < len(spans) and spans[at][0] <= file["high"]


class Stored:
    """The tables that a load adds to, by manifest."""

    def __init__(self, spark: SparkSession, root: str, manifest: dict):
        self.spark, self.root, self.manifest = spark, root, manifest
        self.files: dict[str, list[dict]] = manifest["files"]

    @classmethod
    def read(cls, spark: SparkSession, root: str, manifest: dict) -> Stored:
        """Key ranges that the manifest doesn't have (the mart was published as a whole) are read from the files once."""
        files = dict(manifest.get("files", {}))
        for t in TABLE_ORDER:
            if t not in files:
                files[t] = [f for folder in manifest["tables"].get(t, [t]) for f in file_ranges(spark, root, folder, RANGE_KEY[t])]
        return cls(spark, root, manifest | {"files": files})

    def rows(self, table: str) -> int:
        return sum(f["rows"] for f in self.files[table])

    def largest(self, table: str):
        return max((f["high"] for f in self.files[table] if f["high"] is not None), default=None)

    def meeting(self, table: str, spans: Spans, nulls: bool = False) -> tuple[DataFrame, list[dict]]:
        """(rows of the files that meet the spans, the files that don't)."""
        hit = [f for f in self.files[table] if meets(f, spans, nulls)]
        rest = [f for f in self.files[table] if not meets(f, spans, nulls)]
        reader = self.spark.read.schema(SCHEMAS[table]) if table in SCHEMAS else self.spark.read
        if hit:
            return reader.parquet(*[f"{self.root}/{f['file']}" for f in hit]), rest
        some = self.manifest["tables"].get(table, [table])[0]
        return reader.parquet(f"{self.root}/{some}").where(F.lit(False)), rest


def _whole(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def _primary(rule: Rule, new: dict[str, DataFrame], stored: Stored) -> DataFrame:
    """Rows without a key, and key values that the load repeats or that are stored already."""
    keys, rows = list(rule.keys), new[rule.table].select(*rule.keys)
    fresh = rows.where(_whole(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    old, _ = stored.meeting(rule.table, spans_of(rows, keys[0]))
    known = old.select(*keys).where(_whole(keys)).join(fresh.select(*keys), keys, "left_semi").distinct().withColumn("known", F.lit(1))
    again = fresh.join(known, keys, "left").agg(F.count_if((F.col("n") > 1) | F.col("known").isNotNull()).alias("violations"))
    return again.unionByName(rows.agg(F.count_if(~_whole(keys)).alias("violations"))).agg(F.sum("violations").alias("violations"))


def _foreign(rule: Rule, new: dict[str, DataFrame], stored: Stored) -> DataFrame:
    """New references that neither the load nor the stored parents have."""
    ck, parent, pk = rule.keys
    asked = new[rule.table].select(F.col(ck).alias("k")).where("k IS NOT NULL").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    asked = asked.join(new[parent].select(F.col(pk).alias("k")), "k", "left_anti")
    old, _ = stored.meeting(parent, spans_of(asked, "k"))
    return asked.join(old.select(F.col(pk).alias("k")), "k", "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))


def changed_rules(new: dict[str, DataFrame], stored: Stored, whole: Callable[[str], DataFrame], rules: Sequence[Rule] = RULES) -> dict[str, int]:
    """Rules that the tables break once the new rows are added, with the number of violations."""
    before = stored.manifest.get("violations")
    broken = [r for r in rules if before is None or before.get(r.name)]
    kept = [r for r in rules if r not in broken]
    found = {}
    if broken:
        tables = {t: whole(t) for t in TABLE_ORDER}
        found |= {r["rule"]: r["violations"] for r in check_rules(tables, broken).where("violations > 0").collect()}  # one row a rule
    parts = [check_rules(new, rows).select("rule", "violations")] if (rows := [r for r in kept if r.row_violation is not None]) else []
    for rule in kept:
        if rule.kind in ("PRIMARY KEY", "FOREIGN KEY"):
            check = _primary if rule.kind == "PRIMARY KEY" else _foreign
            parts.append(check(rule, new, stored).select(F.lit(rule.name).alias("rule"), "violations"))
    if parts:
        found |= {r["rule"]: r["violations"] for r in reduce(DataFrame.unionByName, parts).where("violations > 0").collect()}
    return found


def rollup(name: str, items: DataFrame, products: DataFrame) -> DataFrame:
    return order_summary(items) if name == "order_summary" else order_category_counts(items, products)


def write_rollup(rows: DataFrame, root: str, run: str, name: str) -> list[dict]:
    """Writes a rollup in key order; every file holds a range of its own. The files' ranges."""
    rows.orderBy(*ROLLUPS[name]).write.parquet(f"{root}/{run}/{name}")
    return file_ranges(rows.sparkSession, root, f"{run}/{name}", RANGE_KEY[name])


def merged(name: str, added: DataFrame, stored: Stored, spans: Spans, without_key: bool) -> tuple[DataFrame, list[dict]]:
    """(rows of the rollup in the ranges that ``added`` meets, the files of the others).

    Counts and exact sums of two sets of items add up to those of both; a sum without a value stays NULL.
    """
    old, rest = stored.meeting(name, spans, without_key)
    sums = [F.sum(f.name).cast(f.dataType).alias(f.name) for f in added.schema.fields if f.name not in ROLLUPS[name]]
    return old.unionByName(added).groupBy(*ROLLUPS[name]).agg(*sums), rest


def merged_rollups(new_items: DataFrame, products: DataFrame, stored: Stored) -> dict[str, tuple[DataFrame, list[dict]]]:
    """All rollups that the stored mart has, with the new items added.

    Items that were stored without a product count in no category; since a load may bring
    their product, the counts are made anew on a mart that has such items, or may have.
    """
    spans, without_key = spans_of(new_items, "order_id"), bool(new_items.where("order_id IS NULL").limit(1).count())
    sure = (stored.manifest.get("violations") or {}).get("fk_order_items_product", 0) == 0 and "violations" in stored.manifest
    kept = [name for name in ROLLUPS if stored.files.get(name) and (sure or name == "order_summary")]
    return {name: merged(name, rollup(name, new_items, products), stored, spans, without_key) for name in kept}


def rollups_are_current(spark: SparkSession, root: str, manifest: dict | None) -> bool:
    """Whether the stored rollups have known files and were made from the item and product files that are there."""
    if not (manifest or {}).get("files", {}).get("order_summary") or not manifest.get("rollups_of"):
        return False
    tables = (spark.read.parquet(*manifests.folders(spark, root, t, manifest)) for t in ("order_items", "products"))
    return manifests.files_digest(*tables) == manifest["rollups_of"]
