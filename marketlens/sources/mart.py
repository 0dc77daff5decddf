"""The nine marketplace tables as lazily evaluated DataFrames.

Two sources produce the same logical tables:

* ``Mart.from_testdata`` derives them from the TPC-H-like parquet tables the
  test driver generates (column mapping fixed in FIXTURES.md, section B).
  Every expression is a built-in column expression, so Catalyst prunes the
  raw columns each report needs and pushes its filters into the scan.
* ``Mart.from_tables`` reads a published mart (the ingest job's output).

Nothing is cached here: each report is one plan from scan to result, and
Spark re-reads only the columns it uses.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.sources import manifest as manifests
from marketlens.sources.schemas import SCHEMAS, TABLE_COMMENTS, TABLE_ORDER, with_comments

RAW_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def read_raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _add(unit: str, amount: Column, ts: Column) -> Column:
    return F.timestamp_add(unit, amount, ts)


#: Table property that names the item files a catalog summary was made from.
SUMMARY_PROPERTY = "marketlens.order_summary_of"


def publish(spark: SparkSession, root: str, tables: dict[str, list[str]], run: str, base: int, rollups: dict[str, tuple[DataFrame, list[dict]]] | None = None, **more) -> None:
    """Writes the rollups of the items and then the manifest after number ``base``, which makes all of it visible at once.

    ``rollups`` has the rows to write and the files that stay; what is missing there is made of all item folders.
    ``more`` are further entries of the manifest (rows, files, violations).
    """
    from marketlens.sources.increments import ROLLUPS, rollup, write_rollup
    items, products = (spark.read.parquet(*manifests.folders(spark, root, t, {"tables": tables})) for t in ("order_items", "products"))
    files, named = dict(more.pop("files", {})), {}
    for name in ROLLUPS:
        rows, kept = (rollups or {}).get(name) or (rollup(name, items, products), [])
        files[name] = kept + write_rollup(rows, root, run, name)
        named[name] = [f["file"] for f in files[name]] or [f"{run}/{name}"]
    manifests.write(spark, root, {"tables": tables | named, "rollups_of": manifests.files_digest(items, products), "comments": TABLE_COMMENTS, **more, "files": files}, base)


@dataclass
class Mart:
    """Container of the nine tables; each attribute is a lazy DataFrame."""
    spark: SparkSession
    source: str
    kind: str = "testdata"
    frames: dict[str, DataFrame] = field(default_factory=dict)

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str) -> Mart:
        return cls(spark, sf_dir, "testdata")

    @classmethod
    def from_tables(cls, spark: SparkSession, root: str) -> Mart:
        return cls(spark, root, "tables")

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str) -> Mart:
        """A mart over catalog tables ``database.<table>`` (e.g. the bucketed layout)."""
        return cls(spark, database, "catalog")

    @classmethod
    def from_frames(cls, spark: SparkSession, frames: dict[str, DataFrame]) -> Mart:
        """A mart over given DataFrames (tests, or tables loaded elsewhere)."""
        return cls(spark, "<frames>", "frames", dict(frames))

    # -- raw access ---------------------------------------------------------
    def _raw(self, name: str) -> DataFrame:
        return read_raw(self.spark, self.source, name)

    @cached_property
    def manifest(self) -> dict | None:
        return manifests.read(self.spark, self.source) if self.kind == "tables" else None

    def _published(self, name: str) -> DataFrame:
        if self.kind == "frames":
            return self.frames[name]
        if self.kind == "catalog":
            df = self.spark.table(f"`{self.source}`.`{name}`")
        else:
            df = self.spark.read.parquet(*manifests.folders(self.spark, self.source, name, self.manifest))
        if name not in SCHEMAS:
            return df
        missing = [c for c in SCHEMAS[name].fieldNames() if c not in df.columns]
        if missing:
            raise ValueError(f"published table {name} lacks columns: {', '.join(missing)}")
        return df.select(*SCHEMAS[name].fieldNames())

    def table(self, name: str) -> DataFrame:
        if name not in TABLE_ORDER:
            raise KeyError(name)
        return getattr(self, name)

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in TABLE_ORDER}

    # -- the nine tables ----------------------------------------------------
    @cached_property
    def orders(self) -> DataFrame:
        if self.kind != "testdata":
            return self._published("orders")
        o = self._raw("orders")
        key = o.o_orderkey
        purchase = _add("MINUTE", key * 7 % 1440, o.o_orderdate)
        return o.select(
            key.alias("order_id"),
            key.alias("customer_id"),
            F.when(o.o_orderstatus == "F", "delivered")
             .when(o.o_orderstatus == "O", "shipped")
             .otherwise("processing").alias("order_status"),
            purchase.alias("order_purchase_timestamp"),
            F.when(key % 101 != 0, _add("HOUR", key % 72, purchase)).alias("order_approved_at"),
            F.when(key % 103 != 0, _add("DAY", 1 + key % 5, purchase)).alias("order_delivered_carrier_date"),
            F.when(key % 107 != 0, _add("DAY", 1 + key % 45, purchase)).alias("order_delivered_customer_date"),
            _add("DAY", 15 + o.o_custkey % 20, o.o_orderdate).alias("order_estimated_delivery_date"),
        )

    @cached_property
    def customers(self) -> DataFrame:
        if self.kind != "testdata":
            return self._published("customers")
        o = self._raw("orders").select("o_orderkey", "o_custkey")
        c = self._raw("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
        # nation is a fixed 25-row dimension: broadcasting it is bounded.
        n = F.broadcast(self._raw("nation").select("n_nationkey", "n_name"))
        j = (o.join(c, o.o_custkey == c.c_custkey)
              .join(n, c.c_nationkey == n.n_nationkey))
        return j.select(
            j.o_orderkey.alias("customer_id"),
            j.c_custkey.alias("customer_unique_id"),
            (j.c_nationkey * 1000 + j.c_custkey % 1000).cast("int").alias("customer_zip_code_prefix"),
            j.c_mktsegment.alias("customer_city"),
            j.n_name.alias("customer_state"),
        )

    @cached_property
    def order_items(self) -> DataFrame:
        if self.kind != "testdata":
            return self._published("order_items")
        li = self._raw("lineitem")
        price = li.l_extendedprice.cast("decimal(12,2)")
        return li.select(
            li.l_orderkey.alias("order_id"),
            li.l_linenumber.alias("order_item_id"),
            li.l_partkey.alias("product_id"),
            li.l_suppkey.alias("seller_id"),
            li.l_shipdate.alias("shipping_limit_date"),
            price.alias("price"),
            (price * li.l_tax.cast("decimal(4,2)")).cast("decimal(12,2)").alias("freight_value"),
        )

    @cached_property
    def products(self) -> DataFrame:
        if self.kind != "testdata":
            return self._published("products")
        p = self._raw("part")
        return p.select(
            p.p_partkey.alias("product_id"),
            F.when(p.p_partkey % 97 != 0, F.concat(p.p_type, F.lit("_"), p.p_brand))
             .alias("product_category_name"),
            F.length(p.p_name).cast("int").alias("product_name_length"),
            F.lit(None).cast("int").alias("product_description_length"),
            F.lit(None).cast("int").alias("product_photos_qty"),
            p.p_size.cast("decimal(10,2)").alias("product_weight_g"),
            F.lit(None).cast("decimal(10,2)").alias("product_length_cm"),
            F.lit(None).cast("decimal(10,2)").alias("product_height_cm"),
            F.lit(None).cast("decimal(10,2)").alias("product_width_cm"),
        )

    @cached_property
    def product_category_name_translation(self) -> DataFrame:
        if self.kind != "testdata":
            return self._published("product_category_name_translation")
        p = self._raw("part")
        name = F.concat(p.p_type, F.lit("_"), p.p_brand)
        return (p.where(p.p_brand != "Brand#13")
                 .select(name.alias("product_category_name"))
                 .distinct()
                 .select("product_category_name",
                         F.lower("product_category_name").alias("product_category_name_english")))

    @cached_property
    def sellers(self) -> DataFrame:
        if self.kind != "testdata":
            return self._published("sellers")
        s = self._raw("supplier")
        n = F.broadcast(self._raw("nation").select("n_nationkey", "n_name"))
        j = s.join(n, s.s_nationkey == n.n_nationkey)
        return j.select(
            j.s_suppkey.alias("seller_id"),
            (j.s_nationkey * 1000).cast("int").alias("seller_zip_code_prefix"),
            j.s_name.alias("seller_city"),
            j.n_name.alias("seller_state"),
        )

    @cached_property
    def order_payments(self) -> DataFrame:
        if self.kind != "testdata":
            return self._published("order_payments")
        o = self._raw("orders")
        pri = o.o_orderpriority
        first = o.select(
            o.o_orderkey.alias("order_id"),
            F.lit(1).alias("payment_sequential"),
            F.when(pri == "1-URGENT", "credit_card").when(pri == "2-HIGH", "boleto")
             .when(pri == "3-MEDIUM", "voucher").when(pri == "4-NOT SPECIFIED", "debit_card")
             .otherwise("not_defined").alias("payment_type"),
            F.when(pri == "1-URGENT", 1 + o.o_orderkey % 10).otherwise(1).cast("int")
             .alias("payment_installments"),
            o.o_totalprice.cast("decimal(12,2)").alias("payment_value"),
        )
        second = o.where(o.o_orderkey % 5 == 0).select(
            o.o_orderkey.alias("order_id"),
            F.lit(2).alias("payment_sequential"),
            F.lit("voucher").alias("payment_type"),
            F.lit(1).alias("payment_installments"),
            F.lit(10).cast("decimal(12,2)").alias("payment_value"),
        )
        return first.unionByName(second)

    @cached_property
    def order_reviews(self) -> DataFrame:
        if self.kind != "testdata":
            return self._published("order_reviews")
        e = self._raw("events")
        et = e.event_type
        return e.select(
            e.event_id.alias("review_id"),
            e.event_id.alias("order_id"),
            F.when(et == "error", 1).when(et == "click", 2).when(et == "view", 3)
             .when(et == "signup", 4).otherwise(5).cast("int").alias("review_score"),
            F.lit(None).cast("string").alias("review_comment_title"),
            F.when(e.event_id % 3 == 0, F.lit(None).cast("string"))
             .when(e.event_id % 3 == 1, F.lit("  "))
             .otherwise(e.props).alias("review_comment_message"),
            e.ts.alias("review_creation_date"),
            _add("DAY", F.lit(1), e.ts).alias("review_answer_timestamp"),
        )

    @cached_property
    def geolocation(self) -> DataFrame:
        if self.kind != "testdata":
            return self._published("geolocation")
        n = self._raw("nation")
        r = F.broadcast(self._raw("region"))
        j = n.join(r, n.n_regionkey == r.r_regionkey)
        return j.select(
            j.n_nationkey.cast("long").alias("geolocation_id"),
            (j.n_nationkey * 1000).cast("int").alias("geolocation_zip_code_prefix"),
            (j.n_nationkey - 12).cast("decimal(10,7)").alias("geolocation_lat"),
            (j.n_nationkey * 2 - 24).cast("decimal(10,7)").alias("geolocation_lng"),
            j.n_name.alias("geolocation_city"),
            j.r_name.alias("geolocation_state"),
        )

    @cached_property
    def order_summary(self) -> DataFrame:
        """Order-grain sums of the items: the published ones if they were made from the items' present files, else derived."""
        from marketlens.operators.grain import order_summary
        return self._published("order_summary") if self._is_rolled_up else order_summary(self.order_items)

    @cached_property
    def order_category_counts(self) -> DataFrame | None:
        """Items per order and category, if they are published and were made from the present files."""
        published = self.kind == "tables" and "order_category_counts" in (self.manifest or {}).get("tables", {})
        return self._published("order_category_counts") if published and self._is_rolled_up else None

    @cached_property
    def _is_rolled_up(self) -> bool:
        """Whether published rollups were made from the present item files (and product files, in a folder)."""
        made_of = self._summary_of()
        if made_of is None:
            return False
        tables = (self.order_items, self.products) if self.kind == "tables" else (self.order_items,)
        return made_of == manifests.files_digest(*tables)

    def _summary_of(self) -> str | None:
        """Digest of the files that published rollups were made from; None without any."""
        if self.kind == "tables":
            return (self.manifest or {}).get("rollups_of")
        if self.kind == "catalog" and self.spark.catalog.tableExists(f"`{self.source}`.`order_summary`"):
            rows = self.spark.sql(f"SHOW TBLPROPERTIES `{self.source}`.`order_summary`").collect()
            return {r[0]: r[1] for r in rows}.get(SUMMARY_PROPERTY)
        return None

    def write(self, root: str, mode: str = "overwrite", files: int | None = None) -> Mart:
        """Publish all nine tables and the rollups of the items as parquet below ``root``; return a Mart over them.

        Files go to a folder of this run; the manifest that names it is
        written last, so readers never see a part of it. ``mode="error"``
        raises if ``root`` has a published mart.

        Order-keyed tables are sorted by their key inside each output file, so
        parquet row-group statistics on ``order_id`` / ``customer_id`` are
        tight and filters on the key skip row groups.

        By default the file count follows the input splits (Spark cuts the
        input into ~``spark.sql.files.maxPartitionBytes`` pieces), so it
        grows with the data without a counting pass. ``files=n``
        range-partitions the keyed tables into ``n`` files with disjoint key
        ranges instead (the range partitioner samples the key, so files stay
        balanced under skew) at the cost of one shuffle.
        """
        root, run = root.rstrip("/"), manifests.new_run()
        if mode not in ("overwrite", "error"):
            raise ValueError("mode is overwrite or error")
        base, published = manifests.head(self.spark, root)
        if mode == "error" and published is not None:
            raise ValueError(f"{root} has a published mart")
        cluster = {"orders": "order_id", "order_items": "order_id", "order_payments": "order_id",
                   "order_reviews": "order_id", "customers": "customer_id", "products": "product_id"}
        for name in TABLE_ORDER:
            df = with_comments(self.table(name), name)
            if name in cluster:
                key = cluster[name]
                if files:
                    df = df.repartitionByRange(files, F.col(key))
                df = df.sortWithinPartitions(key)
            df.write.parquet(f"{root}/{run}/{name}")
        publish(self.spark, root, {name: [f"{run}/{name}"] for name in TABLE_ORDER}, run, base)
        return Mart.from_tables(self.spark, root)

    def write_bucketed(self, database: str, root: str, buckets: int, mode: str = "overwrite") -> Mart:
        """Publish as catalog tables; order-keyed tables bucketed on their key.

        Orders, items, payments and reviews are bucketed (and sorted) by
        ``order_id``, customers by ``customer_id``, all with ``buckets``
        buckets. Order-grain aggregations and the joins of the order-keyed
        tables on ``order_id`` then need no shuffle at all: each task reads
        matching buckets of both sides. Each table is first hash-partitioned
        on its key into ``buckets`` partitions, so every bucket is one file.
        """
        keyed = {"orders": "order_id", "order_items": "order_id", "order_payments": "order_id",
                 "order_reviews": "order_id", "customers": "customer_id"}
        base = root.rstrip("/")
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{base}'")
        for name in TABLE_ORDER:
            df = with_comments(self.table(name), name)
            if name in keyed:
                key = keyed[name]
                writer = (df.repartition(buckets, F.col(key)).write
                          .bucketBy(buckets, key).sortBy(key))
            else:
                writer = df.write
            (writer.mode(mode).format("parquet").option("path", f"{base}/{name}")
                   .saveAsTable(f"`{database}`.`{name}`"))
            self.spark.sql(f"COMMENT ON TABLE `{database}`.`{name}` IS '{TABLE_COMMENTS[name]}'")
        # Aggregating bucketed items by order_id needs no shuffle; the summary
        # keeps the same bucketing, so joins with orders stay shuffle-free.
        from marketlens.operators.grain import order_summary
        summary = order_summary(Mart.from_catalog(self.spark, database).order_items)
        (summary.write.bucketBy(buckets, "order_id").sortBy("order_id").mode(mode).format("parquet")
                .option("path", f"{base}/order_summary").saveAsTable(f"`{database}`.`order_summary`"))
        digest = manifests.files_digest(Mart.from_catalog(self.spark, database).order_items)
        self.spark.sql(f"ALTER TABLE `{database}`.`order_summary` SET TBLPROPERTIES ('{SUMMARY_PROPERTY}' = '{digest}')")
        return Mart.from_catalog(self.spark, database)
