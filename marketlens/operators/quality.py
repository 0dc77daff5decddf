"""Data-quality operators: key uniqueness, orphans and declarative rules.

The relational constraints of the source schema (primary keys, foreign keys,
NOT NULL, CHECK, declared string lengths) become rules checked by one Spark
job: each rule yields its violation count, and ``violating_rows`` returns the
offending rows for inspection. A CHECK passes when its predicate is TRUE or
NULL (SQL semantics), so violations are rows where the predicate is FALSE.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.sources.schemas import (
    FOREIGN_KEYS, MAX_LENGTHS, ORDER_STATUSES, PAYMENT_TYPES, PRIMARY_KEYS, SCHEMAS,
)


def duplicates(df: DataFrame, keys: Sequence[str], out: str = "duplicate_count") -> DataFrame:
    """Key values that occur more than once, with their count (map-side combined)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))
              .where(F.col(out) > 1))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str | None = None,
            keep_null_keys: bool = True) -> DataFrame:
    """Child rows without a parent (``LEFT JOIN ... WHERE parent.key IS NULL``).

    Written as a left-anti join, which Spark does not derive from the
    LEFT JOIN + IS NULL spelling. A NULL child key never matches, so it is
    returned when ``keep_null_keys`` (the spelling's semantics); foreign-key
    checking passes NULL keys instead (``keep_null_keys=False``).
    """
    parent_key = parent_key or child_key
    p = parent.select(F.col(parent_key).alias("__pk")).where(F.col("__pk").isNotNull())
    c = child if keep_null_keys else child.where(F.col(child_key).isNotNull())
    return c.join(p, c[child_key] == p["__pk"], "left_anti")


@dataclass(frozen=True)
class Rule:
    name: str
    table: str
    kind: str            # PRIMARY KEY / FOREIGN KEY / NOT NULL / CHECK / LENGTH
    violations: Callable[[dict[str, DataFrame]], DataFrame]
    # Row-level rules also expose their violation predicate, so all of them
    # on one table are counted in a single scan.
    row_violation: Callable[[], Column] | None = None
    # The same violation as SQL text (row rules) or the key columns (key rules),
    # used to state the rule job as SQL.
    sql: str | None = None
    keys: tuple = ()


def _row_rule(name: str, table: str, kind: str, violation: Callable[[], Column], sql: str) -> Rule:
    return Rule(name, table, kind, lambda t: t[table].where(violation()), violation, sql)


def _check(name: str, table: str, predicate: Callable[[], Column], sql: str) -> Rule:
    # Violation = predicate is FALSE (NULL passes, as in SQL CHECK constraints).
    return _row_rule(name, table, "CHECK", lambda: ~F.coalesce(predicate(), F.lit(True)),
                     f"NOT COALESCE({sql}, TRUE)")


def _pk(table: str, keys: Sequence[str]) -> Rule:
    name = f"pk_{table}" if len(keys) > 1 else f"{table}_pkey"

    def viol(t: dict[str, DataFrame]) -> DataFrame:
        df = t[table]
        null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        dup = duplicates(df.where(~null_key), keys).drop("duplicate_count")
        return df.where(null_key).select(*keys).unionByName(dup)

    return Rule(name, table, "PRIMARY KEY", viol, keys=tuple(keys))


def _fk(name: str, child: str, ck: str, parent: str, pk: str) -> Rule:
    return Rule(name, child, "FOREIGN KEY",
                lambda t: orphans(t[child], t[parent], ck, pk, keep_null_keys=False), keys=(ck, parent, pk))


def _not_null(table: str, col: str) -> Rule:
    return _row_rule(f"nn_{table}_{col}", table, "NOT NULL", lambda: F.col(col).isNull(), f"{col} IS NULL")


def _length(table: str, col: str, n: int) -> Rule:
    return _row_rule(f"len_{table}_{col}", table, "LENGTH",
                     lambda: F.coalesce(F.length(F.col(col).cast("string")) > n, F.lit(False)),
                     f"COALESCE(length(CAST({col} AS VARCHAR)) > {n}, FALSE)")


def _non_negative(name: str, table: str, col: str) -> Rule:
    return _check(name, table, lambda: F.col(col) >= 0, f"{col} >= 0")


def _in_sql(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def build_rules() -> list[Rule]:
    rules: list[Rule] = [_pk(t, k) for t, k in PRIMARY_KEYS.items()]
    rules += [_fk(*fk) for fk in FOREIGN_KEYS]
    for table, schema in SCHEMAS.items():
        rules += [_not_null(table, f.name) for f in schema.fields if not f.nullable]
    rules += [
        _non_negative("chk_customer_zip_code", "customers", "customer_zip_code_prefix"),
        _non_negative("chk_seller_zip_code", "sellers", "seller_zip_code_prefix"),
        _non_negative("chk_geolocation_zip_code", "geolocation", "geolocation_zip_code_prefix"),
        _non_negative("chk_product_name_length", "products", "product_name_length"),
        _non_negative("chk_product_description_length", "products", "product_description_length"),
        _non_negative("chk_product_photos", "products", "product_photos_qty"),
        _non_negative("chk_product_weight", "products", "product_weight_g"),
        _non_negative("chk_product_length", "products", "product_length_cm"),
        _non_negative("chk_product_height", "products", "product_height_cm"),
        _non_negative("chk_product_width", "products", "product_width_cm"),
        _check("chk_order_status", "orders", lambda: F.col("order_status").isin(*ORDER_STATUSES),
               f"order_status IN {_in_sql(ORDER_STATUSES)}"),
        _check("chk_order_item_id", "order_items", lambda: F.col("order_item_id") > 0, "order_item_id > 0"),
        _non_negative("chk_order_item_price", "order_items", "price"),
        _non_negative("chk_order_item_freight", "order_items", "freight_value"),
        _check("chk_payment_sequential", "order_payments", lambda: F.col("payment_sequential") > 0,
               "payment_sequential > 0"),
        _check("chk_payment_type", "order_payments", lambda: F.col("payment_type").isin(*PAYMENT_TYPES),
               f"payment_type IN {_in_sql(PAYMENT_TYPES)}"),
        _non_negative("chk_payment_installments", "order_payments", "payment_installments"),
        _non_negative("chk_payment_value", "order_payments", "payment_value"),
        _check("chk_review_score", "order_reviews", lambda: F.col("review_score").between(1, 5),
               "review_score BETWEEN 1 AND 5"),
        _check("chk_geolocation_latitude", "geolocation", lambda: F.col("geolocation_lat").between(-90, 90),
               "geolocation_lat BETWEEN -90 AND 90"),
        _check("chk_geolocation_longitude", "geolocation",
               lambda: F.col("geolocation_lng").between(-180, 180), "geolocation_lng BETWEEN -180 AND 180"),
    ]
    for table, cols in MAX_LENGTHS.items():
        rules += [_length(table, c, n) for c, n in cols.items()]
    return rules


RULES: list[Rule] = build_rules()


def key_counts(tables: dict[str, DataFrame], rules: Sequence[Rule]) -> list[DataFrame]:
    """(rule, violations), one row, of each primary- and foreign-key rule.

    Every rule reads its key columns only, in their own type. A child's references
    are counted per key before they meet the parents, so a popular product is one
    row a task. On a mart bucketed by a key, grouping and joining on it (items,
    payments and reviews against orders) need no exchange; elsewhere the parents'
    exchange is made once for all children.
    """
    parts = []
    for r in rules:
        if r.kind == "PRIMARY KEY":
            whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in r.keys])
            # Keys with a NULL part are no keys: each such row is a violation of its own.
            sizes = tables[r.table].groupBy(*r.keys).agg(F.count(F.lit(1)).alias("__n"))
            count = F.sum(F.when(~whole, F.col("__n")).when(F.col("__n") > 1, 1).otherwise(0))
        elif r.kind == "FOREIGN KEY":
            ck, parent, pk = r.keys
            # Both sides keep their column: a renamed one would hide the bucketing.
            asked = tables[r.table].where(F.col(ck).isNotNull()).groupBy(ck).agg(F.count(F.lit(1)).alias("__n"))
            known = tables[parent].select(pk)
            sizes = asked.join(known, asked[ck] == known[pk], "left_anti")
            count = F.sum("__n")
        else:
            continue
        parts.append(sizes.agg(F.coalesce(count, F.lit(0)).cast("long").alias("violations")).select(F.lit(r.name).alias("rule"), "violations"))
    return parts


def check_rules(tables: dict[str, DataFrame], rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per rule: (rule, table_name, rule_type, violations).

    All row-level rules of a table (NOT NULL, CHECK, LENGTH) are counted in
    one pass over that table: one ``count_if`` per rule in a single global
    aggregate, unpivoted to rows. Key rules: ``key_counts``.
    """
    parts: list[DataFrame] = []
    by_table: dict[str, list[Rule]] = {}
    for r in rules:
        if r.row_violation is not None:
            by_table.setdefault(r.table, []).append(r)
    keyed = [r for r in rules if r.row_violation is None]
    for r, counted in zip(keyed, key_counts(tables, keyed)):
        parts.append(counted.select("rule", F.lit(r.table).alias("table_name"), F.lit(r.kind).alias("rule_type"), "violations"))
    for table, table_rules in by_table.items():
        counts = tables[table].agg(*[F.count_if(r.row_violation()).alias(f"r{i}")
                                     for i, r in enumerate(table_rules)])
        # Unpivot the one-row result with a single stack() expression.
        cells = ", ".join(f"'{r.name}', '{r.table}', '{r.kind}', r{i}" for i, r in enumerate(table_rules))
        parts.append(counts.selectExpr(
            f"stack({len(table_rules)}, {cells}) AS (rule, table_name, rule_type, violations)"))
    return reduce(DataFrame.unionByName, parts)


def violating_rows(tables: dict[str, DataFrame], rule_name: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    for r in rules:
        if r.name == rule_name:
            return r.violations(tables)
    raise KeyError(rule_name)


def constraints_catalog(spark, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(table_name, constraint_name, constraint_type) ordered like the catalog listing."""
    rows = [(r.table, r.name, r.kind) for r in rules]
    df = spark.createDataFrame(rows, "table_name string, constraint_name string, constraint_type string")
    return df.orderBy("table_name", "constraint_type", "constraint_name")


def rules_sql(rules: Sequence[Rule] = RULES) -> str:
    """The rule job as one SQL statement (same output as ``check_rules``)."""
    parts = []
    for r in rules:
        head = f"SELECT '{r.name}' AS rule, '{r.table}' AS table_name, '{r.kind}' AS rule_type"
        if r.kind == "PRIMARY KEY":
            k = ", ".join(r.keys)
            any_null = " OR ".join(f"{c} IS NULL" for c in r.keys)
            body = (f"(SELECT COUNT(*) FROM {r.table} WHERE {any_null}) + "
                    f"(SELECT COUNT(*) FROM (SELECT {k} FROM {r.table} WHERE NOT ({any_null}) "
                    f"GROUP BY {k} HAVING COUNT(*) > 1) AS d)")
            parts.append(f"{head}, {body} AS violations")
        elif r.kind == "FOREIGN KEY":
            ck, parent, pk = r.keys
            parts.append(f"{head}, COUNT(*) AS violations FROM {r.table} AS c WHERE c.{ck} IS NOT NULL "
                         f"AND NOT EXISTS (SELECT 1 FROM {parent} AS p WHERE p.{pk} = c.{ck})")
        else:
            parts.append(f"{head}, COUNT(*) FILTER (WHERE {r.sql}) AS violations FROM {r.table}")
    return "\nUNION ALL\n".join(parts) + "\nORDER BY table_name, rule_type, rule"
