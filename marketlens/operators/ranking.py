"""Ranking operators that stay distributed.

``Window.orderBy`` without ``partitionBy`` (NTILE, DENSE_RANK, ROW_NUMBER over a
whole table) makes Spark move every row into one task. The operators here cut the
order into ranges at sampled keys and give each row the number of its range by a
binary search (``part_of``). The cuts are plain values, so every pass over the
data sees the same ranges, whatever is computed again after a lost executor. What
goes over the edge of a range is a count: one row a range, broadcast to all.

* ``group_row_number``: a window by group; only groups of more than HOT_ROWS rows
  are cut into ranges, each of which is told how many rows of its group come before.
* ``global_dense_rank``: a window by range, plus the distinct values of the ranges
  before, less one for each value that lies on both sides of an edge.
* ``ntile_cuts``: the keys where buckets start, for several columns at once.
* ``global_row_index``: every row's place; needs the rows stored (``positioned``).

Bounded key sets (months, states, categories) may still use a plain window;
the callers say so where they do.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.session import ensure_checkpoint_dir

_PID, _LPOS = "__pid", "__lpos"


def _sort_cols(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order]


def kept(df: DataFrame) -> DataFrame:
    """The rows written once to the reliable checkpoint folder, for relations that are read several times."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def positioned(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Globally sorted rows with partition id and position inside it, checkpointed."""
    ranked = (df.orderBy(*_sort_cols(order))
                .withColumn(_PID, F.spark_partition_id())
                .withColumn(_LPOS, F.monotonically_increasing_id()))
    ranked = ranked.withColumn(_LPOS, F.col(_LPOS) - F.shiftleft(F.col(_PID).cast("long"), 33))
    return kept(ranked)


def _offsets(pos: DataFrame) -> DataFrame:
    counts = pos.groupBy(_PID).agg(F.count(F.lit(1)).alias("__cnt"))
    # One row per partition: a window over it is a tiny, bounded job.
    w = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, 0)
    return counts.select(
        _PID,
        (F.sum("__cnt").over(w) - F.col("__cnt")).alias("__off"),
        F.sum("__cnt").over(Window.partitionBy()).alias("__n"),
    )


def global_row_index(df: DataFrame, order: Sequence[Column | str], out: str = "row_index",
                     with_total: str | None = None) -> DataFrame:
    """0-based position of each row in the total order ``order`` (must be unique)."""
    pos = positioned(df, order)
    off = F.broadcast(_offsets(pos))
    res = pos.join(off, _PID).withColumn(out, F.col("__off") + F.col(_LPOS))
    if with_total:
        res = res.withColumn(with_total, F.col("__n"))
    return res.drop(_PID, _LPOS, "__off", "__n")


def ntile_of(index: Column, n: Column, k: int) -> Column:
    """NTILE(k) bucket (1-based) of 0-based row ``index`` among ``n`` rows.

    The first ``n mod k`` buckets hold ``n div k + 1`` rows, the rest
    ``n div k`` (the SQL definition); with fewer rows than buckets each row
    gets its own bucket.
    """
    b = F.floor(n / k).cast("long")
    r = (n % k).cast("long")
    big = r * (b + 1)
    return (F.when(index < big, F.floor(index / (b + 1)))
             .otherwise(r + F.floor((index - big) / F.greatest(b, F.lit(1))))
            + 1).cast("long")


def global_ntile(df: DataFrame, k: int, order: Sequence[Column | str], out: str) -> DataFrame:
    """``NTILE(k) OVER (ORDER BY order)`` without a single-partition window."""
    idx = global_row_index(df, order, "__idx", with_total="__total")
    return idx.withColumn(out, ntile_of(F.col("__idx"), F.col("__total"), k)).drop("__idx", "__total")


#: Sampled keys for each range; more make the ranges more even.
SAMPLED = 20
#: Rows of a group that one task may number.
HOT_ROWS = 1_000_000


def sort_key(columns: Sequence[str]) -> Column:
    """A struct that compares as ``ORDER BY columns`` (ascending, NULLS LAST)."""
    return F.struct(*[c for i, name in enumerate(columns) for c in (F.col(name).isNull().alias(f"n{i}"), F.col(name).alias(f"v{i}"))])


def key_bounds(df: DataFrame, keys: dict[str, Column]) -> dict[str, list]:
    """For each key: ascending values that cut it into ranges of about equal size, from one sample of the rows.

    SAMPLED rows for each shuffle partition come to the driver. Any cuts give right results.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sample = df.select(*[k.alias(name) for name, k in keys.items()]).orderBy(F.rand()).limit(SAMPLED * parts).collect()
    every = {name: sorted({r[name] for r in sample}, key=_comparable) for name in keys}
    return {name: found[max(1, len(found) // parts) - 1::max(1, len(found) // parts)] for name, found in every.items()}


def _comparable(key) -> tuple:
    return tuple(x for n, v in zip(key[::2], key[1::2]) for x in (n, 0 if v is None else v))


def key_literal(key, kind: T.StructType) -> Column:
    return F.struct(*[F.lit(key[f.name]).cast(f.dataType).alias(f.name) for f in kind.fields])


def part_of(bounds: Column, key: Column) -> Column:
    """How many of the ascending ``bounds`` are at or below ``key``, by binary search; 0 without bounds."""
    def halve(range_: Column, _: Column) -> Column:
        middle = F.shiftright(range_["low"] + range_["high"], 1)
        below = F.get(bounds, middle) <= key
        return F.when(range_["low"] >= range_["high"], range_).otherwise(F.struct(F.when(below, middle + 1).otherwise(range_["low"]).alias("low"), F.when(below, range_["high"]).otherwise(middle).alias("high")))

    size = F.coalesce(F.size(bounds), F.lit(0))
    turns = F.sequence(F.lit(0), F.ceil(F.log2(size + 1)).cast("int"))
    return F.when(size > 0, F.aggregate(turns, F.struct(F.lit(0).alias("low"), size.alias("high")), halve)["low"]).otherwise(0)


def _part(df: DataFrame, key: str, bounds: list) -> Column:
    """``part_of`` for cuts that are known: nested comparisons, of which a row takes log2 of their number, without an array."""
    kind = df.schema[key].dataType

    def choose(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(F.col(key) >= key_literal(bounds[middle], kind), choose(middle + 1, high)).otherwise(choose(low, middle))

    return choose(0, len(bounds))


def ntile_cuts(df: DataFrame, k: int, values: Sequence[str], tiebreak: str) -> dict[str, list[tuple]]:
    """Per column: the first (value, tiebreak) of buckets 2..k of ``NTILE(k) OVER (ORDER BY value NULLS LAST, tiebreak)``.

    All columns share the passes over ``df``, which should be stored: a sample finds ranges, a count of the
    ranges (one row each) tells where the buckets start, and only those ranges are ordered, by a task each.
    (value, tiebreak) must be unique.
    """
    keys = {c: f"__key{i}" for i, c in enumerate(values)}
    bounds = key_bounds(df, {c: sort_key([c, tiebreak]) for c in values})
    df = df.select(*[sort_key([c, tiebreak]).alias(q) for c, q in keys.items()])
    parts = {c: _part(df, q, bounds[c]) for c, q in keys.items()}
    each = F.array(*[F.struct(F.lit(i).alias("which"), p.alias("part")) for i, p in enumerate(parts.values())])
    sizes = df.select(F.explode(each).alias("x")).groupBy("x.which", "x.part").count().orderBy("which", "part").collect()
    found: dict[str, list[tuple]] = {}
    need: dict[tuple[int, int, int], int] = {}  # (column, range, place in it) -> bucket
    for i in range(len(values)):
        own = [(r["part"], r["count"]) for r in sizes if r["which"] == i]
        total, seen = sum(n for _, n in own), 0
        starts = [sum(total // k + (b < total % k) for b in range(j)) for j in range(1, k)]
        for part, n in own:
            need |= {(i, part, start - seen): j for j, start in enumerate(starts) if seen <= start < seen + n}
            seen += n
    if not need:
        return {c: [] for c in values}
    # The columns' types differ: each has a place of its own in the rows that are ordered.
    empty = [F.lit(None).cast(df.schema[q].dataType) for q in keys.values()]
    wanted = [F.when(parts[c].isin(sorted({p for w, p, _ in need if w == i})), F.struct(F.lit(i).alias("which"), parts[c].alias("part"), *[(F.col(keys[c]) if j == i else empty[j]).alias(f"k{j}") for j in range(len(values))])) for i, c in enumerate(values)]
    rows = df.select(F.explode(F.array_compact(F.array(*wanted))).alias("x")).select("x.*")
    order = Window.partitionBy("which", "part").orderBy(*[f"k{j}" for j in range(len(values))])
    hits = F.lit(False)
    for which, part, at in need:
        hits = hits | ((F.col("which") == which) & (F.col("part") == part) & (F.col("at") == at))
    for r in rows.withColumn("at", F.row_number().over(order) - 1).where(hits).collect():  # k - 1 rows a column
        found.setdefault(values[r["which"]], []).append((need[r["which"], r["part"], r["at"]], r[f"k{r['which']}"]))
    return {c: [(key["v0"], key["v1"]) for _, key in sorted(found.get(c, []), key=lambda x: x[0])] for c in values}


def ntile_from_cuts(df: DataFrame, cuts: Sequence[tuple], value: str, tiebreak: str) -> Column:
    """The bucket of each row, given the cuts: one comparison a bucket, no shuffle."""
    types = {f.name: f.dataType for f in df.schema.fields}
    key = F.struct(F.col(value).isNull().alias("n"), F.col(value).alias("v"), F.col(tiebreak).alias("t"))
    out = F.lit(1).cast("long")
    for v, t in cuts:
        cut = F.struct(F.lit(v is None).alias("n"), F.lit(v).cast(types[value]).alias("v"), F.lit(t).cast(types[tiebreak]).alias("t"))
        out = out + F.when(key >= cut, 1).otherwise(0)
    return out.cast("long")


def global_dense_rank(df: DataFrame, value: str, out: str, descending: bool = True, bounds: list | None = None) -> DataFrame:
    """``DENSE_RANK() OVER (ORDER BY value [DESC])`` in one ordered pass; ``df`` is read three times, so it should be stored.

    Rows are cut into ranges by (value, a hash of the row), so that a value of many rows is spread as well. A
    range's ranks start after the distinct values of the ranges before; a value on both sides of an edge is one.
    NULL values rank last for ASC and first for DESC, as in PostgreSQL.
    """
    tie = df.withColumn("__tie", F.xxhash64(*df.columns))
    level = sort_key([value])
    tie = tie.withColumn("__key", sort_key([value, "__tie"]))
    cuts = key_bounds(tie, {"k": F.col("__key")})["k"] if bounds is None else bounds
    parted = tie.withColumn("__part", _part(tie, "__key", cuts))
    edges = parted.groupBy("__part").agg(F.count_distinct(level).alias("n"), F.min(level).alias("low"), F.max(level).alias("high")).orderBy("__part").collect()  # one row a range
    offsets, before, last = [], 0, None
    for r in edges:
        shared = int(last is not None and r["low"] == last)
        offsets.append((r["__part"], before - shared))
        before, last = before - shared + r["n"], r["high"]
    carried = F.broadcast(df.sparkSession.createDataFrame(offsets, "__part int, __before long"))  # one row a range
    rank = F.dense_rank().over(Window.partitionBy("__part").orderBy(level)) + F.col("__before")
    ranked = parted.join(carried, "__part").withColumn(out, (before + 1 - rank if descending else rank).cast("long"))
    return ranked.select(*df.columns, out)


def top_with_dense_rank(df: DataFrame, value: str, tiebreak: Sequence[str], limit: int,
                        out: str) -> DataFrame:
    """First ``limit`` rows by (value DESC, tiebreak) with their global dense rank.

    For a prefix of the descending order every larger value is inside the
    prefix, so the dense rank computed on the prefix equals the global one.
    The prefix is a TakeOrderedAndProject (per-partition top-k, then merge).
    """
    order = [F.col(value).desc_nulls_first()] + [F.col(c).asc_nulls_last() for c in tiebreak]
    top = df.orderBy(*order).limit(limit)
    w = Window.orderBy(F.col(value).desc_nulls_first())  # at most ``limit`` rows
    return top.withColumn(out, F.dense_rank().over(w).cast("long"))


def group_row_number(df: DataFrame, group: Sequence[str], order: Sequence[str], out: str, most: int = HOT_ROWS) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY group ORDER BY order)`` (ascending, NULLS LAST) that splits hot groups.

    One aggregate finds the groups of more than ``most`` rows. Without any, a window by group is all. Otherwise
    these are cut into ranges of about ``most`` rows: the cuts (one for ``most`` rows) go to every task, the window
    is by (group, range), and a range is told the number of its group's rows in earlier ranges. Rows are shuffled
    once, for the window; ``order`` must be unique within a group.
    """
    by = [F.col(c).asc_nulls_last() for c in order]
    number = F.row_number().over(Window.partitionBy(*group).orderBy(*by))
    hot = kept(df.groupBy(*group).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > most))
    if hot.isEmpty():
        return df.withColumn(out, number.cast("long"))

    def same(left: DataFrame, right: DataFrame, extra: Sequence[str] = ()) -> Column:
        return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[f"__{c}"]) for c in [*group, *extra]])

    def named(rows: DataFrame, *columns: str) -> DataFrame:
        return rows.select(*[F.col(c).alias(f"__{c}") for c in [*group, *columns]])

    # Groups of more than ``most`` rows and their cuts: one of each for ``most`` rows at most.
    hot = F.broadcast(named(hot))
    sample = df.join(hot, same(df, hot), "left_semi").where(F.rand() < SAMPLED / most)
    keys = F.sort_array(F.collect_list(sort_key(order)))
    cuts = kept(sample.groupBy(*group).agg(keys.alias("keys")).withColumn("cuts", F.filter("keys", lambda _, i: i % SAMPLED == SAMPLED - 1)).drop("keys"))
    cuts = F.broadcast(named(cuts, "cuts"))
    parted = df.join(cuts, same(df, cuts), "left").withColumn("part", part_of(F.col("__cuts"), sort_key(order))).select(*df.columns, "part")
    sizes = df.join(hot, same(df, hot), "left_semi")
    sizes = sizes.join(cuts, same(sizes, cuts), "left").withColumn("part", part_of(F.col("__cuts"), sort_key(order))).groupBy(*group, "part").count()
    earlier = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carry = F.broadcast(named(sizes.withColumn("carry", F.sum("count").over(earlier)), "part", "carry"))
    number = F.row_number().over(Window.partitionBy(*group, "part").orderBy(*by)) + F.coalesce("__carry", F.lit(0))
    return parted.join(carry, same(parted, carry, ["part"]), "left").withColumn(out, number.cast("long")).select(*df.columns, out)


def with_total(df: DataFrame, value: Column | str, out: str, bounded: bool = False) -> DataFrame:
    """Attach ``SUM(value) OVER ()`` as a column.

    ``bounded=True`` is for relations with a fixed, small number of rows
    (one row per status, category, score, month...): a window over the whole
    relation is then one cheap stage. Otherwise the total is computed as a
    one-row aggregate (a proven bound) and broadcast to every task, so no
    task ever receives the whole relation.
    """
    v = F.col(value) if isinstance(value, str) else value
    if bounded:
        return df.withColumn(out, F.sum(v).over(Window.partitionBy()))
    total = df.agg(F.sum(v).alias(out))
    return df.crossJoin(F.broadcast(total))
