"""Approximate nearest neighbours by cosine with a forest of random-projection trees.

Index
    Equal vectors are one entry with its few smallest ids (all that a result
    can show). Trees are fitted on a sample of the entries of about SAMPLE rows
    (``sample_rows``; the only sampled step): an inner node splits its sample
    at the median of the projection on the difference of two random members.
    Every entry is then routed to its leaf in each tree. Leaves hold about
    LEAF_ROWS entries as long as the sample can make that many; the number of
    nodes, and so what is broadcast, is bounded by SAMPLE and ``trees``.

Search
    For a query, one priority queue over the nodes of all trees, ordered by the
    smallest margin to the planes crossed so far, yields leaves until they hold
    ``share`` of all trees' entries, and ``candidates`` at least, so the part of
    a table that is looked at does not fall as the table grows. Leaf members and the queries that chose the leaf
    meet in blocks of at most about BLOCK_ROWS entries, where cosines are
    computed exactly in double precision, and each block returns its best few.

Defined results: a vector that is null, empty, all zero or has a null or
non-finite component takes no part, nor does one with a null id or with another
length than most; with equal ids the smallest vector counts; ties go to the
smaller id; with fewer candidates than ``k`` all are returned; no queries or an
empty table give no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.common import Scratch, hash_share

SAMPLE, LEAF_ROWS, BLOCK_ROWS = 20_000, 128, 4096
#: Leaf members looked at per query: SHARE of trees x entries, and CANDIDATES at least.
TREES, SHARE, CANDIDATES = 8, 0.09, 36_000
INF = float("inf")


class Tree:
    """One tree: planes[i] . x - offsets[i] < 0 goes to left[i], else to right[i]; children below 0 are leaves ~child."""

    def __init__(self, points: np.ndarray, leaf_rows: int, rng: np.random.Generator):
        planes, offsets, left, right, self.leaves = [], [], [], [], 0

        def grow(rows: np.ndarray) -> int:
            plane = None
            if len(rows) > leaf_rows:
                for _ in range(5):
                    a, b = points[rng.choice(rows, 2, replace=False)]
                    side = points[rows] @ (a - b)
                    cut = float(np.median(side))
                    if 0 < (side < cut).sum() < len(rows):
                        plane = a - b
                        break
            if plane is None:
                self.leaves += 1
                return ~(self.leaves - 1)
            me = len(planes)
            norm = np.linalg.norm(plane)
            planes.append(plane / norm)
            offsets.append(cut / norm)
            left.append(0)
            right.append(0)
            left[me], right[me] = grow(rows[side < cut]), grow(rows[side >= cut])
            return me

        self.root = grow(np.arange(len(points)))
        d = points.shape[1]
        self.planes, self.offsets = np.array(planes, dtype=np.float32).reshape(-1, d), np.array(offsets, dtype=np.float32)
        self.left, self.right = np.array(left, dtype=np.int64), np.array(right, dtype=np.int64)

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        at = np.full(len(x), self.root, dtype=np.int64)
        while (inner := np.flatnonzero(at >= 0)).size:
            i = at[inner]
            margin = np.einsum("ij,ij->i", x[inner], self.planes[i]) - self.offsets[i]
            at[inner] = np.where(margin < 0, self.left[i], self.right[i])
        return ~at


class Forest:
    def __init__(self, points: np.ndarray, leaf_rows: int, trees: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        points = unit(points)
        self.trees = [Tree(points, leaf_rows, rng) for _ in range(trees)]

    def route(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector [row, tree]."""
        x = unit(x)
        return np.stack([t.leaf_of(x) for t in self.trees], axis=1)

    def search(self, x: np.ndarray, sizes: dict[tuple[int, int], int], wanted: int) -> list[tuple[int, int]]:
        """(tree, leaf) in the order of the shared queue, until the leaves hold ``wanted`` entries."""
        x = unit(x[None, :])[0]
        margins = [t.planes @ x - t.offsets for t in self.trees]
        queue = [(-INF, i, t.root) for i, t in enumerate(self.trees)]
        heapq.heapify(queue)
        out, held = [], 0
        while queue and held < wanted:
            far, i, node = heapq.heappop(queue)
            if node < 0:
                size = sizes.get((i, ~node), 0)
                if size:
                    out.append((i, ~node))
                    held += size
                continue
            tree, m = self.trees[i], float(margins[i][node])
            near, other = (tree.left, tree.right) if m < 0 else (tree.right, tree.left)
            heapq.heappush(queue, (far, i, int(near[node])))
            heapq.heappush(queue, (max(far, abs(m)), i, int(other[node])))
        return out


def unit(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, dtype=np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision, from the vectors as they are."""
    return np.einsum("ij,ij->i", a, b) / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))


def matrix(column) -> np.ndarray:
    """An Arrow list column of equally long vectors as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def usable(col: str) -> Column:
    c = F.col(col)
    fine = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < INF))
    return c.isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists(c, lambda x: x != 0)


def nearest(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5,
            trees: int = TREES, candidates: int = CANDIDATES, sample_rows: int = SAMPLE, share: float = SHARE) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of each row where ``is_query`` holds."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "rp-forest")
    rows = vectors.where(F.col(id_col).isNotNull() & usable(vec_col)).select(F.col(id_col).cast("long").alias("id"), is_query.alias("asks"), F.col(vec_col).cast("array<double>").alias("v"))
    rows = rows.groupBy("id", "asks").agg(F.min("v").alias("v"))
    usual = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if usual is None:
        return empty
    rows = scratch.put(rows.where(F.size("v") == usual["d"]), "rows")

    # Entries: a vector's k + 1 smallest ids are all that its neighbours can list; Spark keeps that many per task before the shuffle.
    nth = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    entries = rows.withColumn("nth", nth).where(F.col("nth") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    entries = scratch.put(entries.select(F.col("ids")[0].alias("node"), "ids", "v"), "entries")
    asking = rows.where("asks").groupBy("v").agg(F.min("id").alias("first"))
    asking = scratch.put(asking.join(entries.select("v", "node"), "v").select("node", "v"), "asking")
    queries = rows.where("asks").select(F.col("id").alias("query_id"), "v").join(entries.select("v", "node"), "v").select("query_id", "node")

    count = entries.count()
    wanted = max(candidates, int(np.ceil(share * trees * count)))
    part = min(1.0, sample_rows / max(count, 1))
    chosen = entries.where(hash_share("node", part) if part < 1 else F.lit(True))
    sample = matrix(chosen.orderBy("node").select("v").toArrow().column("v"))
    if not len(sample):
        return empty
    forest = Forest(sample, max(8, int(LEAF_ROWS * part)), trees)
    shared = spark.sparkContext.broadcast(forest)  # at most trees x sample_rows / 4 planes

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                leaves = shared.value.route(matrix(b.column("v")))
                yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(list(leaves), pa.list_(pa.int32())), b.column("v")], names=["node", "leaves", "v"])

    routed = scratch.put(entries.select("node", "v").mapInArrow(route, "node long, leaves array<int>, v array<double>"), "routed")
    placed = routed.select("node", "v", F.posexplode("leaves").alias("tree", "leaf"))
    sizes = {(r[0], r[1]): r[2] for r in placed.groupBy("tree", "leaf").count().collect()}  # one row a leaf of the bounded forest
    sizes_shared = spark.sparkContext.broadcast(sizes)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in range(4)]
            for i, x in enumerate(matrix(b.column("v")) if b.num_rows else ()):
                for tree, leaf in shared.value.search(x, sizes_shared.value, wanted):
                    for block in range(-(-sizes_shared.value[tree, leaf] // BLOCK_ROWS)):
                        for col, y in zip(out, (i, tree, leaf, block)):
                            col.append(y)
            took = pa.array(out[0], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("node").take(took), *(pa.array(x, pa.int32()) for x in out[1:]), b.column("v").take(took)], names=["query", "tree", "leaf", "block", "q"])

    visits = asking.repartition("node").mapInArrow(ask, "query long, tree int, leaf int, block int, q array<double>")
    blocks = spark.createDataFrame([(t, leaf, -(-n // BLOCK_ROWS)) for (t, leaf), n in sizes.items()], "tree int, leaf int, blocks int")
    members = placed.join(F.broadcast(blocks), ["tree", "leaf"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    keep = k + 4  # a few more than needed, since the matrix product rounds differently from the row by row score

    def rank(key: tuple, found: pa.Table, asked: pa.Table) -> pa.Table:
        out_q, out_n, out_s = [], [], []
        if found.num_rows and asked.num_rows:
            x, nodes = matrix(found.column("v")), np.asarray(found.column("node"))
            scaled = x / np.linalg.norm(x, axis=1, keepdims=True)
            q_all, ids = matrix(asked.column("q")), np.asarray(asked.column("query"))
            for i in range(0, len(ids), 512):
                q = q_all[i:i + 512]
                near = (q / np.linalg.norm(q, axis=1, keepdims=True)) @ scaled.T
                n = min(keep, len(nodes))
                best = np.argpartition(-near, n - 1, axis=1)[:, :n]
                row, col = np.repeat(np.arange(len(q)), n), best.ravel()
                out_q.append(ids[i:i + 512][row])
                out_n.append(nodes[col])
                out_s.append(cosines(q[row], x[col]))
        cat = [np.concatenate(x) if x else np.zeros(0, dtype=t) for x, t in ((out_q, np.int64), (out_n, np.int64), (out_s, np.float64))]
        return pa.table({"node": pa.array(cat[0], pa.int64()), "entry": pa.array(cat[1], pa.int64()), "score": pa.array(cat[2], pa.float64())})

    found = members.groupBy("tree", "leaf", "block").cogroup(visits.groupBy("tree", "leaf", "block")).applyInArrow(rank, "node long, entry long, score double")
    found = found.groupBy("node", "entry").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("score"), "entry"))
    best = found.withColumn("place", place).where(F.col("place") <= k + 1).drop("place")
    best = best.join(entries.select(F.col("node").alias("entry"), "ids"), "entry").select("node", "score", F.explode("ids").alias("vec_id"))
    # at most (k + 1)^2 rows a distinct vector; its queries share them
    listed = best.groupBy("node").agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id"))), 1, k + 1).alias("near"))
    own = queries.join(listed, "node").select("query_id", F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k).alias("near"))
    return own.select("query_id", F.posexplode("near").alias("at", "x")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.far")).alias("score"))
