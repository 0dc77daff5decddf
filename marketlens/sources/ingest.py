"""Batch ingest: nine CSV exports -> typed parquet tables.

Each file is one distributed scan: every column is read as a string, null
tokens are mapped to NULL, values are cast with ``try_cast`` to the declared
type, and each table is written as parquet to a folder of this run. The same
job observes the rows written and, per column, how many values could not be
typed, so a CSV is parsed once. Then the declared rules (keys, NOT NULL,
CHECK, lengths) are checked on the tables as they would be, row counts are
compared, and one manifest file publishes everything at once
(``sources.manifest``). A load that fails before that changes nothing.

Review texts hold line breaks; ``sources.split_csv`` finds the records of such
an export from the quotes of its splits, so it is read by many tasks as well.

An append costs in proportion to the load: the manifest keeps the key range of
every file and the rules the mart breaks, so that only new rows are checked,
their keys are looked up in the files whose range they meet, and of the rollups
of the items only those ranges are made anew (``sources.increments``).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.sources import manifest as manifests
from marketlens.sources import increments
from marketlens.sources.mart import publish
from marketlens.sources.schemas import LOAD_PLAN, LoadSpec, PRIMARY_KEYS, SCHEMAS, TABLE_ORDER, with_comments
from marketlens.sources.split_csv import read_quoted_csv

# pandas' default missing-value tokens (read_csv without na_values).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


class IngestError(RuntimeError):
    pass


# -- A3 / A4: preflight ---------------------------------------------------
def preflight_sources(spark: SparkSession, paths: Iterable[str]) -> None:
    """Fail once, naming every missing source file."""
    missing = [p for p in paths if not manifests.exists(spark, p)]
    if missing:
        raise IngestError("Missing source files: " + ", ".join(missing))


def tables_missing(spark: SparkSession, names: Sequence[str]) -> list[str]:
    """Names of catalog tables that do not exist, sorted."""
    return sorted(n for n in names if not spark.catalog.tableExists(n))


# -- A1: read ---------------------------------------------------------------
def read_source_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Header CSV with quoted fields, over several lines if ``multi_line``; every column as STRING."""
    if multi_line:
        return read_quoted_csv(spark, path)
    return (spark.read.option("header", True).option("quote", '"').option("escape", '"').option("inferSchema", False)
            .option("mode", "PERMISSIVE").csv(path))


# -- A5, A7, A8: column handling ---------------------------------------------
def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename present columns; names already fixed are left alone."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def normalize_nulls(df: DataFrame, tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """Map missing-value tokens to NULL in every string column."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            c = F.when(c.isin(*tokens), F.lit(None).cast("string")).otherwise(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def require_columns(df: DataFrame, expected: Sequence[str], source: str) -> None:
    missing = [c for c in expected if c not in df.columns]
    if missing:
        raise IngestError(f"{source} is missing expected columns: {', '.join(missing)}")


# -- A6, A9: typing -----------------------------------------------------------
def _typed(name: str, dtype: T.DataType) -> Column:
    c = F.col(f"`{name}`")
    if isinstance(dtype, T.TimestampNTZType):
        return F.try_to_timestamp(c).cast("timestamp_ntz")
    if isinstance(dtype, T.DecimalType):
        # Round to the declared scale as the database does (values with more
        # digits are rounded, not rejected).
        return F.round(c.try_cast("decimal(38,18)"), dtype.scale).try_cast(dtype)
    if isinstance(dtype, T.IntegerType):
        # Integer columns exported by pandas may carry a ".0" suffix; a real fraction is no integer.
        d = c.try_cast("decimal(28,10)")
        return F.coalesce(c.try_cast("int"), F.when(d == F.floor(d), d).try_cast("int"))
    return c.try_cast(dtype)


def project_expected(df: DataFrame, spec: LoadSpec) -> DataFrame:
    """Select the declared columns in declared order, cast; extra columns are dropped."""
    fields = [f for f in spec.schema.fields if f.name not in spec.generated]
    return df.select(*[_typed(f.name, f.dataType).alias(f.name) for f in fields])


def prepare(raw: DataFrame, spec: LoadSpec, observation: Observation | None = None, first_id: int = 0) -> DataFrame:
    """A5 -> A7 -> A8 -> A9 (+ A15 for generated keys).

    With ``observation``, the job that consumes the result reports ``rows``
    and, as ``lost_<column>``, how many non-NULL values became NULL when typed.
    Generated ids start at ``first_id``, so that loads do not share ids.
    """
    df = normalize_nulls(rename_columns(raw, spec.renames))
    require_columns(df, spec.source_columns, spec.file)
    fields = [f for f in spec.schema.fields if f.name not in spec.generated]
    if observation is not None:
        both = df.select(*[F.col(f"`{f.name}`").alias(f"s_{f.name}") for f in fields], *[_typed(f.name, f.dataType).alias(f.name) for f in fields])
        lost = [F.count_if(F.col(f"s_{f.name}").isNotNull() & F.col(f.name).isNull()).alias(f"lost_{f.name}") for f in fields]
        typed = both.observe(observation, F.count(F.lit(1)).alias("rows"), *lost).select(*[f.name for f in fields])
    else:
        typed = project_expected(df, spec)
    if "geolocation_id" in spec.generated:
        typed = typed.withColumn("geolocation_id", F.monotonically_increasing_id() + F.lit(first_id).cast("long"))
        typed = typed.select(*spec.schema.fieldNames())
    return typed


# -- A12: category back-fill ----------------------------------------------------
def backfill_categories(products: DataFrame, translation: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lookup rows for product categories absent from the lookup (English = native name).

    Returns (completed lookup, added rows). Distinct categories of the
    product table are anti-joined against the lookup: both sides are small
    and the anti join needs no fan-out.
    """
    used = (products.select("product_category_name").where(F.col("product_category_name").isNotNull())
            .distinct())
    added = (used.join(translation.select("product_category_name"), "product_category_name", "left_anti")
             .select("product_category_name",
                     F.col("product_category_name").alias("product_category_name_english")))
    full = translation.select("product_category_name", "product_category_name_english").unionByName(added)
    return full, added


# -- A10, A11, A13, A14: write and validate --------------------------------------
@dataclass
class IngestResult:
    run: str = ""
    tables: dict[str, list[str]] = field(default_factory=dict)  # table -> folders of the published mart, below its root
    before: dict[str, int] = field(default_factory=dict)        # rows there were
    written: dict[str, int] = field(default_factory=dict)       # rows of this load
    stored: dict[str, int] = field(default_factory=dict)        # rows there are
    coerced: dict[str, dict[str, int]] = field(default_factory=dict)
    violations: dict[str, int] = field(default_factory=dict)
    categories_added: int = 0


def write_table(df: DataFrame, path: str, mode: str = "error") -> Observation:
    """Write parquet, observing the number of rows written in the same job."""
    obs = Observation()
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).parquet(path)
    return obs


def validate_row_counts(spark: SparkSession, result: IngestResult) -> DataFrame:
    """One row per table: rows before, written and stored; raises naming every table where they do not add up."""
    rows = [(t, result.before.get(t, 0), result.written[t], result.stored[t]) for t in result.tables]
    bad = [f"{t}: expected {b + w}, found {s}" for t, b, w, s in rows if b + w != s]
    if bad:
        raise IngestError("Row-count validation failed: " + "; ".join(bad))
    return spark.createDataFrame(rows, "table_name string, rows_before long, rows_written long, rows_stored long")


def check_gate(tables: dict[str, DataFrame]) -> dict[str, int]:
    """Rules that the tables of a whole load break, with the number of violations (an append: ``increments.changed_rules``)."""
    from marketlens.operators.quality import check_rules
    return {r["rule"]: r["violations"] for r in check_rules(tables).where("violations > 0").collect()}  # one row a rule


def run_ingest(spark: SparkSession, source_dir: str, target_dir: str, mode: str = "overwrite",
               plan: Sequence[LoadSpec] = LOAD_PLAN, file_names: dict[str, str] | None = None,
               gate: bool = True) -> IngestResult:
    """Load every CSV of ``plan`` from ``source_dir`` into the mart at ``target_dir`` and publish it in one step.

    ``mode``: "overwrite" replaces the nine tables, "append" adds to them.
    ``file_names`` maps table names to export file names that differ from
    ``<table>.csv``. With ``gate`` a load that would break a declared rule is
    rejected; otherwise the violations are only reported in the result.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError("mode is overwrite or append")
    src, dst, run = source_dir.rstrip("/"), target_dir.rstrip("/"), manifests.new_run()
    names = {s.table: (file_names or {}).get(s.table, s.file) for s in plan}
    preflight_sources(spark, [f"{src}/{names[s.table]}" for s in plan])
    base, old = manifests.head(spark, dst)
    stored = None
    if mode == "append":
        missing = sorted(t for t in TABLE_ORDER if not all(manifests.exists(spark, p) for p in manifests.folders(spark, dst, t, old)))
        if missing:
            raise IngestError("Missing target tables: " + ", ".join(missing))
        stored = increments.Stored.read(spark, dst, old or {"tables": {t: [t] for t in TABLE_ORDER}})
    elif {s.table for s in plan} != set(TABLE_ORDER):
        raise ValueError("overwrite needs all nine tables in the plan")
    result = IngestResult(run=run)
    added: dict[str, list[str]] = {t: [] for t in TABLE_ORDER}  # folders of this load
    kept = {t: list(stored.manifest["tables"].get(t, [t])) if stored else [] for t in TABLE_ORDER}

    def read(t: str, folders: Sequence[str]) -> DataFrame:
        return spark.read.schema(SCHEMAS[t]).parquet(*[f"{dst}/{f}" for f in folders]) if folders else spark.createDataFrame([], SCHEMAS[t])

    result.before = {t: stored.rows(t) if stored else 0 for t in TABLE_ORDER}
    result.written = dict.fromkeys(TABLE_ORDER, 0)
    for spec in sorted(plan, key=lambda s: TABLE_ORDER.index(s.table)):
        t, obs = spec.table, Observation()
        first_id = (stored.largest(t) or 0) + 1 if "geolocation_id" in spec.generated and stored else 0
        raw = read_source_csv(spark, f"{src}/{names[t]}", spec.multi_line)
        prepare(raw, spec, obs, first_id).write.parquet(f"{dst}/{run}/_typed/{t}")
        # In key order, so that each file holds a range of keys of its own.
        with_comments(read(t, [f"{run}/_typed/{t}"]), t).orderBy(*PRIMARY_KEYS[t]).write.parquet(f"{dst}/{run}/{t}")
        added[t].append(f"{run}/{t}")
        result.written[t] = int(obs.get["rows"])
        result.coerced[t] = {k.removeprefix("lost_"): v for k, v in obs.get.items() if k.startswith("lost_") and v}
    manifests.delete(spark, f"{dst}/{run}/_typed")
    lookup = "product_category_name_translation"
    # Stored products have their categories, if the rules were checked when they came.
    checked = stored is not None and "violations" in stored.manifest
    _full, more = backfill_categories(read("products", added["products"] if checked else kept["products"] + added["products"]), read(lookup, kept[lookup] + added[lookup]))
    result.categories_added = int(write_table(with_comments(more, lookup), f"{dst}/{run}/{lookup}_added").get["rows"])
    added[lookup].append(f"{run}/{lookup}_added")
    result.written[lookup] += result.categories_added
    result.tables = {t: kept[t] + added[t] for t in TABLE_ORDER}
    files = {t: [f for folder in added[t] for f in increments.file_ranges(spark, dst, folder, increments.RANGE_KEY[t])] for t in TABLE_ORDER}
    result.stored = {t: result.before[t] + sum(f["rows"] for f in files[t]) for t in TABLE_ORDER}
    validate_row_counts(spark, result)
    new = {t: read(t, added[t]) for t in TABLE_ORDER}
    result.violations = increments.changed_rules(new, stored, lambda t: read(t, result.tables[t])) if stored else check_gate(new)
    if gate and result.violations:
        raise IngestError("Load rejected, rules broken: " + ", ".join(f"{k} ({v})" for k, v in sorted(result.violations.items())))
    rollups = increments.merged_rollups(new["order_items"], read("products", result.tables["products"]), stored) if stored and increments.rollups_are_current(spark, dst, old) else None
    if stored:
        files = {t: stored.files[t] + files[t] for t in TABLE_ORDER}  # publish adds the rollups'
    publish(spark, dst, result.tables, run, base, rollups, rows=result.stored, files=files, violations=result.violations)
    return result


__all__ = [
    "NA_TOKENS", "IngestError", "IngestResult", "backfill_categories", "check_gate", "normalize_nulls", "prepare",
    "preflight_sources", "project_expected", "read_source_csv", "rename_columns", "require_columns", "run_ingest",
    "tables_missing", "validate_row_counts", "write_table",
]
