from pyspark.sql import Window
from pyspark.sql import functions as F

from marketlens.operators.ranking import (
    global_dense_rank, global_ntile, global_row_index, group_row_number, ntile_cuts, ntile_from_cuts, part_of,
    top_with_dense_rank,
)


def _frame(spark, n, distinct=7):
    return spark.createDataFrame([(i, (i * 37) % distinct) for i in range(n)], "id long, v long").repartition(5)


def test_global_ntile_equals_window_ntile(spark):
    for n, k in [(1000, 4), (17, 5), (3, 5), (5, 5), (1, 3)]:
        df = _frame(spark, n)
        ours = global_ntile(df, k, ["v", "id"], "t").select("id", "t")
        ref = df.select("id", F.ntile(k).over(Window.orderBy("v", "id")).alias("t"))
        assert sorted(ours.collect()) == sorted(ref.collect()), (n, k)


def test_ntile_fewer_rows_than_buckets(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, 5)], "id long, v long")
    out = sorted((r.id, r.t) for r in global_ntile(df, 5, ["v", "id"], "t").collect())
    assert out == [(1, 1), (2, 2), (3, 3)]


def test_global_row_index_is_dense_and_ordered(spark):
    df = _frame(spark, 500)
    rows = global_row_index(df, ["v", "id"], "ix").orderBy("ix").collect()
    assert [r.ix for r in rows] == list(range(500))
    assert [(r.v, r.id) for r in rows] == sorted((r.v, r.id) for r in rows)


def test_global_dense_rank_ties(spark):
    df = spark.createDataFrame([(1, 10), (2, 10), (3, 5), (4, 4), (5, 3)], "id long, v long")
    out = sorted((r.id, r.rk) for r in global_dense_rank(df, "v", "rk").collect())
    assert out == [(1, 1), (2, 1), (3, 2), (4, 3), (5, 4)]


def test_top_with_dense_rank_prefix(spark):
    df = _frame(spark, 300)
    top = top_with_dense_rank(df, "v", ["id"], 20, "rk").collect()
    ref = (df.select("id", "v", F.dense_rank().over(Window.orderBy(F.col("v").desc())).alias("rk"))
           .orderBy(F.col("v").desc(), "id").limit(20).collect())
    assert [(r.id, r.rk) for r in top] == [(r.id, r.rk) for r in ref]


def test_group_row_number_hot_group(spark):
    # one group holds most rows: it must be numbered 1..n across partitions
    rows = [(0 if i % 10 else i, i) for i in range(2000)]
    df = spark.createDataFrame(rows, "g long, id long").repartition(7)
    ours = group_row_number(df, ["g"], ["id"], "rn").select("g", "id", "rn")
    ref = df.select("g", "id", F.row_number().over(Window.partitionBy("g").orderBy("id")).alias("rn"))
    assert sorted(ours.collect()) == sorted(ref.collect())


def _python_ntile(n, k):
    sizes = [n // k + (1 if j < n % k else 0) for j in range(k)]
    out = []
    for j, size in enumerate(sizes):
        out += [j + 1] * size
    return out


def test_ntile_formula_exhaustive(spark):
    from marketlens.operators.ranking import ntile_of
    rows = [(n, i) for n in range(1, 61) for i in range(n)]
    df = spark.createDataFrame(rows, "n long, i long")
    ks = range(1, 8)
    got = df.select("n", "i", *[ntile_of(F.col("i"), F.col("n"), k).alias(f"k{k}") for k in ks]).collect()
    for r in got:
        for k in ks:
            assert r[f"k{k}"] == _python_ntile(r.n, k)[r.i], (r.n, r.i, k)


def test_ntile_cuts_equal_window_ntile(spark):
    for n, k in [(1000, 4), (17, 5), (3, 5), (5, 5), (1, 3)]:
        df = _frame(spark, n).withColumn("v", F.when(F.col("v") != 3, F.col("v"))).cache()
        cuts = ntile_cuts(df, k, ["v"], "id")["v"]
        ours = df.select("id", ntile_from_cuts(df, cuts, "v", "id").alias("t"))
        ref = df.select("id", F.ntile(k).over(Window.orderBy(F.col("v").asc_nulls_last(), "id")).cast("long").alias("t"))
        assert sorted(ours.collect()) == sorted(ref.collect()), (n, k)
    assert ntile_cuts(_frame(spark, 1000).limit(0), 4, ["v"], "id") == {"v": []}


def test_ntile_cuts_of_several_columns_of_different_types(spark):
    df = _frame(spark, 900).select("id", "v", (F.col("id") % 11).cast("decimal(32,2)").alias("d"), F.when(F.col("v") > 2, F.col("v").cast("string")).alias("s")).cache()
    cuts = ntile_cuts(df, 5, ["v", "d", "s"], "id")
    for c in cuts:
        ours = df.select("id", ntile_from_cuts(df, cuts[c], c, "id").alias("t"))
        ref = df.select("id", F.ntile(5).over(Window.orderBy(F.col(c).asc_nulls_last(), "id")).cast("long").alias("t"))
        assert sorted(ours.collect()) == sorted(ref.collect()), c


def test_dense_rank_over_range_edges(spark):
    """Every tie at an edge, inside a range and over several ranges; NULLs; both directions."""
    rows = [(i, None if i % 10 == 0 else (5 if i % 3 == 0 else i % 17)) for i in range(600)] + [(1, 1), (1, 1)]
    df = spark.createDataFrame(rows, "id long, v long").repartition(5).cache()
    for descending, order in ((True, F.col("v").desc_nulls_first()), (False, F.col("v").asc_nulls_last())):
        ref = sorted(df.select("id", "v", F.dense_rank().over(Window.orderBy(order)).cast("long").alias("rk")).collect(), key=str)
        assert sorted(global_dense_rank(df, "v", "rk", descending).collect(), key=str) == ref
        for values in ([5], [1, 5, 5, 5, 9], [None], list(range(18)) + [None]):  # cuts in the middle of a value's rows
            bounds = [{"n0": x is None, "v0": x, "n1": False, "v1": tie} for x, tie in zip(values, range(-8 * 10**18, 9 * 10**18, 8 * 10**17))]
            bounds.sort(key=lambda b: (b["n0"], b["v0"] or 0, b["v1"]))
            assert sorted(global_dense_rank(df, "v", "rk", descending, bounds).collect(), key=str) == ref
    assert global_dense_rank(df.limit(0), "v", "rk").collect() == []


def test_hot_groups_are_cut_into_ranges(spark):
    rows = [(None if i % 7 == 0 else (0 if i % 3 else i), None if i % 5 == 0 else i % 40, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g long, at long, id long").repartition(7)
    ours = group_row_number(df, ["g"], ["at", "id"], "rn", most=100)
    order = Window.partitionBy("g").orderBy(F.col("at").asc_nulls_last(), "id")
    ref = df.withColumn("rn", F.row_number().over(order).cast("long"))
    assert sorted(map(str, ours.collect())) == sorted(map(str, ref.collect()))
    assert ours.select(F.count_distinct("g")).first()[0] > 100
    for most in (100, 10**6):
        plan = group_row_number(df, ["g"], ["at", "id"], "rn", most=most)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def test_part_of_is_a_binary_search(spark):
    rows = [([], 3), ([5], 4), ([5], 5), ([1, 3, 3, 7], 3), ([1, 3, 3, 7], 0), ([1, 3, 3, 7], 9), (None, 2), (list(range(0, 200, 2)), 101)]
    df = spark.createDataFrame(rows, "b array<int>, x int")
    assert [r[0] for r in df.select(part_of(F.col("b"), F.col("x"))).collect()] == [0, 0, 1, 3, 0, 4, 0, 51]
