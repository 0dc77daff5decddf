"""Near duplicates: a Jaccard self-join on word shingles by T-occurrence search.

Two documents link when their sets of five-word shingles have a Jaccard
similarity of 0.75 or more; a component is what links connect. Documents with
equal sets form one *class* first (a 64-bit digest of the set is the class's
key), so copies cost one row each and nothing more.

1. One Arrow pass hashes words and shingles, and gives each document its set
   size and class. Each task also counts its shingles in a table of counters,
   about one for four shingles of the corpus, and 2^MAX_COUNTERS at most; the
   summed table, one byte a counter, orders shingles from rare to frequent, the
   same way everywhere. The order only decides which pairs are looked at first
   and how many, never which links are found.
2. A second pass sends, per class, the rarest quarter of its shingles to the
   inverted lists. Two similar sets must meet there: the smaller one within
   its first n - ceil(6n/7) + 1 shingles, the larger one within its first
   n - ceil(3n/4) + 1. These are DivideSkip's short lists; the rest are its long lists.
3. Within a list each class is paired with the list's smallest class only
   (a star), so a list of k classes gives k - 1 pairs. Of a class's pairs the
   one that most lists ask for is looked at first; further pairs are looked at
   only if their classes are still in different components, first the other
   star pairs, then the pairs of lists of three or more that still hold several
   components. The latter are tried inside tasks, in blocks of bounded size: a
   class carries how many of its shingles fall into each of SKETCH bins, and the
   differences of two classes' bins add up to at most the shingles that only one
   of them has. Only pairs that this can't refuse become rows; first, of each
   class in a block, the one with the least difference, then, by the components
   that these links leave, all others.
   So no link between components is missed, and copies never meet all copies.
4. Pairs are grouped by one of their classes, the query, in chunks of bounded
   size. ``divide_skip`` finds the documents of a chunk that reach the required
   overlap: a heap merges the short lists, binary search probes the long ones.
   The exact Jaccard test on the full sets decides.
5. Components by contraction: each class points to its smallest neighbour,
   links are rewritten to the targets, until none is left.

Defined results: a null text or one without a word has an empty set, links
with nothing and is its own component; with one to four words the whole
sequence is the one shingle; repeated rows are in one component; an empty table
gives none. A null doc_id never is the smallest id of a component that has another.
Set and list sizes are not capped anywhere.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import SPACES, Scratch, shuffles_released, small_batches, texts_in_steps

WIDTH = 5
#: log2 of the fewest and most counters that order shingles by frequency (64 MB at most), and of those in one shuffled block.
MIN_COUNTERS, MAX_COUNTERS, BLOCK = 20, 26, 16
#: Characters of text for which there is one counter: about four shingles.
CHARS_PER_COUNTER = 24
#: log2 of the fewest and most bits of a bitmap of classes or keys (128 MB at most), and of those in one shuffled block.
MIN_MARKS, MAX_MARKS, MARK_BLOCK = 23, 30, 17
#: Characters hashed at a time (an array of one number a byte takes 2 MB), and shingles that a task gathers before it sends their counts or their lists.
HASH_CHARS, COUNTED, LISTED = 250_000, 2_000_000, 1_000_000
#: Classes that one group of ``divide_skip`` searches.
CHUNK = 256
#: Bins of a class's sketch, members of a list that one block of pairs takes from each side, and pairs tried in one step.
SKETCH, SIDE, PAIRS = 128, 1024, 1 << 18
#: Lists whose counter exceeds the average by this much are dealt out over several tasks, by class; see ``lists``.
HOT = 1 << 18
MU = 0.0085  # DivideSkip's constant that balances heap and probes
U64 = np.uint64


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


class Hasher:
    """64-bit hashes of words and shingles for many texts at once, by array operations.

    A word's hash is a polynomial over random numbers for its bytes, taken from
    one running sum over all texts; a shingle's combines five words' hashes.
    """

    R = 0x9E3779B97F4A7C15

    def __init__(self, width: int = WIDTH):
        rng = np.random.default_rng(5_240_961)
        self.width, self.value = width, rng.integers(1, 2 ** 63, 256, dtype=U64)
        self.places = rng.integers(1, 2 ** 63, width, dtype=U64) | U64(1)
        self.space = np.zeros(256, dtype=bool)
        self.space[list(SPACES)] = True
        self.powers = self.inverses = np.ones(1, dtype=U64)

    def _words(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(start of each word, its hash)."""
        data = np.frombuffer(raw, dtype=np.uint8)
        n = len(data)
        if len(self.powers) <= n:
            size = max(n + 1, 1 << 19)
            one = np.ones(1, dtype=U64)
            self.powers = np.cumprod(np.concatenate([one, np.full(size, U64(self.R))]))
            self.inverses = np.cumprod(np.concatenate([one, np.full(size, U64(pow(self.R, -1, 2 ** 64)))]))
        gap = np.concatenate([[True], self.space[data], [True]])
        starts, ends = np.flatnonzero(gap[:-1] & ~gap[1:]), np.flatnonzero(~gap[:-1] & gap[1:])
        total = np.concatenate([np.zeros(1, dtype=U64), np.cumsum(self.value[data] * self.powers[:n])])
        return starts, mix((total[ends] - total[starts]) * self.inverses[starts] + (ends - starts).astype(U64))

    def sets(self, texts: list[str]) -> list[np.ndarray]:
        """The sorted distinct shingle hashes of each text."""
        raws = [t.encode("utf-8", "replace").lower() for t in texts]  # bytes.lower() changes A-Z only
        starts, words = self._words(b"\n".join([*raws, b""]))
        edges = np.cumsum([0, *(len(r) + 1 for r in raws)])
        cut = np.searchsorted(starts, edges).tolist()
        w, many = self.width, max(len(words) - self.width + 1, 0)
        shingles = np.zeros(many, dtype=U64)
        for j in range(w if many else 0):
            shingles += words[j:j + many] * self.places[j]
        shingles = mix(shingles)
        out = []
        for a, b in zip(cut, cut[1:]):
            if b - a >= w:
                s = np.sort(shingles[a:b - w + 1])
                out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
            elif b > a:
                short = np.zeros(1, dtype=U64) + U64(b - a)
                for j in range(b - a):
                    short += words[a + j:a + j + 1] * self.places[j]
                out.append(mix(short))
            else:
                out.append(np.zeros(0, dtype=U64))
        return out


def class_key(s: np.ndarray) -> int:
    """The signed 64-bit digest of a set."""
    return int(mix(np.array([mix(s ^ U64(0xA5A5A5A5A5A5A5A5)).sum(dtype=U64) + U64(len(s))], dtype=U64)).view(np.int64)[0])


def log2_between(wanted: float, low: int, high: int) -> int:
    """The smallest whole power of two that reaches ``wanted``, as its logarithm, within the bounds."""
    return min(max(int(np.ceil(np.log2(max(wanted, 1)))), low), high)


def mark_of(nodes: np.ndarray, marks: int) -> np.ndarray:
    return (mix(nodes.view(U64)) >> U64(64 - marks)).astype(np.int64)


def is_marked(bits: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    at = mark_of(nodes, int(len(bits)).bit_length() + 2)  # a power of two of bytes
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


def coded(counts: np.ndarray) -> np.ndarray:
    """Counts as bytes that keep their order: eight steps for each doubling."""
    return np.minimum(np.rint(8 * np.log2(counts + 1.0)), 255).astype(np.uint8)


def probe_length(n: int) -> int:
    return n - (3 * n + 3) // 4 + 1


def index_length(n):
    """How many of the rarest shingles of a set must hold one that a similar set of at least its size has among its own first."""
    return n - (6 * n + 6) // 7 + 1


def similar(common: int, a: int, b: int) -> bool:
    return 100 * common >= 75 * (a + b - common)


def divide_skip(lists: list[list[int]], need: int) -> dict[int, int]:
    """{id: in how many lists it is} of the ids that are in at least ``need`` of the sorted lists.

    The longest lists are set aside; ids that are in enough of the others
    (merged by a heap) are looked up in the long ones by binary search.
    """
    if need <= 0 or not lists:
        return {}
    by_size = sorted((x for x in lists if x), key=len)
    if not by_size:
        return {}
    aside = min(need - 1, len(by_size) - 1, int(need / (MU * np.log2(max(len(by_size[-1]), 2)) + 1)))
    short, long = by_size[:len(by_size) - aside], by_size[len(by_size) - aside:]
    out, last, seen = {}, None, 0

    def settle(i: int, n: int) -> None:
        if n >= need - aside:
            for x in long:
                at = bisect_left(x, i)
                n += at < len(x) and x[at] == i
            if n >= need:
                out[i] = n

    for i in heapq.merge(*short):
        if i != last:
            if last is not None:
                settle(last, seen)
            last, seen = i, 0
        seen += 1
    settle(last, seen)
    return out


def _inverted(query: np.ndarray, sets: list[np.ndarray]) -> list[list[int]]:
    """For each shingle of the query, the numbers of the sets that have it."""
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    at = np.searchsorted(query, every)
    hit = np.append(query, U64(0))[at] == every
    hit &= at < len(query)
    at, owner = at[hit], owner[hit]
    order = np.argsort(at, kind="stable")  # sets come in rising order, so owners rise within a shingle
    return [x.tolist() for x in np.split(owner[order], np.searchsorted(at[order], np.arange(1, len(query))))]


def sketch(s: np.ndarray) -> bytes:
    """How many shingles of a set fall into each bin, one byte a bin (255: that many or more)."""
    return np.minimum(np.bincount((s & U64(SKETCH - 1)).astype(np.int64), minlength=SKETCH), 255).astype(np.uint8).tobytes()


def pairs_left(rows: pa.RecordBatch, best: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, row) of the pairs within blocks that can be similar and lie in different components.

    Rows are sorted by block (h, low, high). Members of two chunks meet in the
    block of both, those of one chunk in a block of their own. ``best``: of a
    step's pairs with the same first row only the one whose sketches differ least.
    """
    h, low, high, chunk, n, pos, x = (np.asarray(rows.column(c)) for c in ("h", "low", "high", "chunk", "n", "pos", "x"))
    bins = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), dtype=np.uint8).reshape(-1, SKETCH)
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])])
    first = np.flatnonzero(new)
    block = np.cumsum(new) - 1
    start, size = first[block], np.diff(np.append(first, len(h)))[block]
    until = np.cumsum(size)
    at = 0
    while at < len(h):
        end = max(int(np.searchsorted(until, until[at] - size[at] + PAIRS, "right")), at + 1)
        many = size[at:end]
        a = np.repeat(np.arange(at, end), many)
        b = np.arange(len(a)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(start[at:end], many)
        fine = (x[a] < x[b]) & ((low[a] == high[a]) | (chunk[a] != chunk[b]))
        a, b = a[fine], b[fine]
        need = (3 * (n[a] + n[b]) + 6) // 7
        early = np.where(n[a] <= n[b], pos[a] < index_length(n[a]), pos[b] < index_length(n[b]))
        fine = early & (4 * np.minimum(n[a], n[b]) >= 3 * np.maximum(n[a], n[b])) & (np.minimum(n[a] - pos[a], n[b] - pos[b]) >= need)
        a, b, need = a[fine], b[fine], need[fine]
        for i in range(0, len(a), PAIRS // 8):
            p, q = a[i:i + PAIRS // 8], b[i:i + PAIRS // 8]
            apart = np.abs(bins[p].astype(np.int16) - bins[q]).sum(axis=1)
            fine = apart <= n[p] + n[q] - 2 * need[i:i + PAIRS // 8]
            p, q, apart = p[fine], q[fine], apart[fine]
            if best and len(p):
                by = np.lexsort((apart, p))
                by = by[np.concatenate([[True], p[by][1:] != p[by][:-1]])]
                p, q = p[by], q[by]
            yield p, q
        at = end


def _plane(x: np.ndarray) -> bytes:
    """The bytes of an array by significance, so that leading zeros compress away."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def _unplane(raw: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(size, -1).T).view(dtype).ravel()


class JaccardJoin:
    """The steps above for one table; ``components()`` runs them."""

    def __init__(self, docs: DataFrame, width: int = WIDTH, hot: int = HOT):
        self.spark, self.width, self.hot = docs.sparkSession, width, hot
        small_batches(self.spark)
        self.docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
        self.scratch = Scratch(self.spark, "jaccard")

    # step 1 -------------------------------------------------------------------------------------------
    def sized(self, bits: int) -> DataFrame:
        """doc_id, n_shingles, node (the class) of each row, and the tasks' 2^bits counters as rows with n_shingles = -1."""
        schema = self.docs.select("doc_id").schema.add("n_shingles", "long").add("node", "long").add("places", "binary").add("counts", "binary")
        width = self.width

        def counted(found: list[np.ndarray], id_type) -> pa.RecordBatch:
            """One row a block of counters: which of them are not zero, and what they hold."""
            at, counts = np.unique(np.concatenate(found), return_counts=True)
            block = at >> BLOCK
            cuts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
            spans = list(zip(cuts, [*cuts[1:], len(at)]))
            places = [_plane(np.diff(at[a:b] & ((1 << BLOCK) - 1), prepend=np.uint32(0)).astype(np.uint16)) for a, b in spans]
            return pa.RecordBatch.from_arrays([pa.nulls(len(cuts), id_type), pa.array([-1] * len(cuts), pa.int64()), pa.array(block[cuts].astype(np.int64)), pa.array(places, pa.binary()), pa.array([_plane(counts[a:b].astype(np.uint32)) for a, b in spans], pa.binary())], names=schema.names)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hasher, found, size, known = Hasher(width), [], 0, set()
            id_type = None
            for batch, texts in texts_in_steps(batches, chars=HASH_CHARS):
                id_type = batch.schema.field("doc_id").type
                sets = hasher.sets(texts)
                nodes = [class_key(s) for s in sets]
                for s, node in zip(sets, nodes):
                    if len(s) and node not in known:
                        if len(known) < 1_000_000:
                            known.add(node)
                        found.append((s >> U64(64 - bits)).astype(np.uint32))
                        size += len(s)
                if size > COUNTED:
                    yield counted(found, id_type)
                    found, size = [], 0
                none = pa.nulls(len(sets), pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(nodes, pa.int64()), none, none], names=schema.names)
            if found:
                yield counted(found, id_type)

        return self.scratch.put(self.docs.mapInArrow(run, schema), "sized")

    def counters(self, sized: DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """(the summed counters as bytes, over how many tasks the list of a shingle with each such byte is dealt out)."""
        def add(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
            total = np.zeros(1 << BLOCK, dtype=np.int64)
            for places, counts in zip(frame["places"], frame["counts"]):
                total[np.cumsum(_unplane(places, np.uint16), dtype=np.int64)] += _unplane(counts, np.uint32)
            return pd.DataFrame({"block": [key[0]], "total": [int(total.sum())], "codes": [coded(total).tobytes()]})

        rows = sized.where("n_shingles = -1").groupBy(F.col("node").alias("block")).applyInPandas(add, "block long, total long, codes binary")
        table, total = np.zeros((1 << bits - BLOCK, 1 << BLOCK), dtype=np.uint8), 0
        with shuffles_released(self.spark):
            for block, held, raw in rows.collect():  # at most 2^(MAX_COUNTERS - BLOCK) rows, 64 MB in all
                table[block] = np.frombuffer(raw, dtype=np.uint8)
                total += held
        above = np.exp2(np.arange(256) / 8) - 1 - total / (1 << bits)  # less what other shingles add to a counter
        return table.ravel(), np.where(above >= self.hot, above // self.hot + 1, 1).astype(np.uint64)

    # step 2 and 3 -------------------------------------------------------------------------------------
    def lists(self, counters: np.ndarray, deal: np.ndarray, buckets: int) -> DataFrame:
        """h, node, n, pos, hub, hub_n, hub_pos, k: the members of each inverted list with at least two (k) classes.

        Lists travel as one binary value per task and bucket of shingles, which
        holds the members sorted by shingle. The hub is the smallest class of a
        list. A list with a high counter is split by class over several buckets,
        each with a hub of its own (and k above 3); ``stars`` joins those hubs.
        """
        shared, width, away = self.spark.sparkContext.broadcast(counters), self.width, U64(65 - int(len(counters)).bit_length())

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hasher, order, known = Hasher(width), shared.value, set()
            held, size = [], 0
            for _, texts in texts_in_steps(batches, chars=HASH_CHARS):
                for s in hasher.sets(texts):
                    if not len(s) or (node := class_key(s)) in known:
                        continue
                    if len(known) < 1_000_000:
                        known.add(node)
                    first = s[np.lexsort((s, order[(s >> away).astype(np.int64)]))[:probe_length(len(s))]]
                    held.append((node, len(s), first))
                    size += len(first)
                if size > LISTED:
                    yield flush(held)
                    held, size = [], 0
            if held:
                yield flush(held)

        def flush(held) -> pa.RecordBatch:
            h = np.concatenate([x for _, _, x in held])
            sizes = [len(x) for _, _, x in held]
            nodes, ns = np.array([a for a, _, _ in held], dtype=np.int64), np.array([b for _, b, _ in held], dtype=np.uint32)
            doc = np.repeat(np.arange(len(held), dtype=np.uint32), sizes)
            pos = np.arange(len(h), dtype=np.uint32) - np.repeat((np.cumsum(sizes) - sizes).astype(np.uint32), sizes)
            split = deal[shared.value[(h >> away).astype(np.int64)]]
            bucket = (mix(h + mix(nodes[doc].view(U64)) % split) % U64(buckets)).astype(np.int64)
            by = np.lexsort((h, bucket))
            h, doc, pos, bucket = h[by], doc[by], pos[by], bucket[by]
            at = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            out: list[list] = [[] for _ in range(6)]
            for a, b in zip(at, [*at[1:], len(h)]):
                used, index = np.unique(doc[a:b], return_inverse=True)  # a block names its classes once
                for col, x in zip(out, (int(bucket[a]), _plane(np.diff(h[a:b], prepend=U64(0))), nodes[used].tobytes(), _plane(ns[used]), _plane(index.astype(np.uint32)), _plane(pos[a:b]))):
                    col.append(x)
            return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), *(pa.array(x, pa.binary()) for x in out[1:])], names=["bucket", "h", "node", "n", "doc", "pos"])

        def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts: dict[int, list] = {}
            for b in batches:
                for row in b.to_pylist():
                    doc = _unplane(row["doc"], np.uint32)
                    parts.setdefault(row["bucket"], []).append((np.cumsum(_unplane(row["h"], U64)), np.frombuffer(row["node"], dtype=np.int64)[doc], _unplane(row["n"], np.uint32)[doc], _unplane(row["pos"], np.uint32)))
            for key in sorted(parts):
                h, node, n, pos = (np.concatenate(x) for x in zip(*parts.pop(key)))
                split = deal[shared.value[(h >> away).astype(np.int64)]] > 1
                rise = np.sort(h)
                several = np.unique(rise[1:][rise[1:] == rise[:-1]])
                several = np.append(several, several[-1:]) if len(several) else np.zeros(1, dtype=U64)
                some = split | (several[np.minimum(np.searchsorted(several, h), len(several) - 1)] == h)
                h, node, n, pos, split = h[some], node[some], n[some], pos[some], split[some]
                by = np.lexsort((node, h))
                h, node, n, pos, split = h[by], node[by], n[by], pos[by], split[by]
                new_list = np.concatenate([np.ones(min(len(h), 1), dtype=bool), h[1:] != h[:-1]])
                once = new_list | np.concatenate([np.ones(min(len(h), 1), dtype=bool), node[1:] != node[:-1]])  # a class sent by several tasks
                h, node, n, pos, split = h[once], node[once], n[once], pos[once], split[once]
                first = np.flatnonzero(np.concatenate([np.ones(min(len(h), 1), dtype=bool), h[1:] != h[:-1]]))
                size = np.diff(np.append(first, len(h)))
                keep, hub = np.repeat(size > 1, size) | split, np.repeat(first, size)
                if keep.any():
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (h[keep].view(np.int64), node[keep], n[keep].astype(np.int64), pos[keep].astype(np.int64), node[hub][keep], n[hub][keep].astype(np.int64), pos[hub][keep].astype(np.int64), (np.repeat(size, size) + 3 * split)[keep])], names=["h", "node", "n", "pos", "hub", "hub_n", "hub_pos", "k"])

        sent = self.docs.mapInArrow(send, "bucket long, h binary, node binary, n binary, doc binary, pos binary").repartition("bucket")
        return self.scratch.put(sent.mapInArrow(gather, "h long, node long, n long, pos long, hub long, hub_n long, hub_pos long, k long"), "lists")

    def stars(self, lists: DataFrame) -> DataFrame:
        """node, query, shared: pairs of a class and a hub, and how many lists ask for each."""
        hubs = lists.where("node = hub")
        top = hubs.groupBy("h").agg(F.min(F.struct("node", "n", "pos")).alias("top"), F.count("*").alias("hubs")).where("hubs > 1")
        over = hubs.join(top, "h").select("node", "n", "pos", F.col("top.node").alias("hub"), F.col("top.n").alias("hub_n"), F.col("top.pos").alias("hub_pos"))
        pairs = lists.drop("h", "k").unionByName(over).where("node <> hub").where(self.possible("n", "pos", "hub_n", "hub_pos"))
        return self.scratch.put(pairs.groupBy("node", F.col("hub").alias("query")).agg(F.count("*").alias("shared")), "stars")

    @staticmethod
    def possible(n: str, pos: str, other_n: str, other_pos: str):
        """Whether two sets that share a list can be similar: by size, by place in the order, and by whose first shingles must meet.

        Judged at the first list that a similar pair shares, the test never fails.
        """
        a, p, b, q = (F.col(x) for x in (n, pos, other_n, other_pos))
        need = F.ceil(3 * (a + b) / 7)
        smaller_first = F.when(a <= b, p < a - F.ceil(6 * a / 7) + 1).otherwise(q < b - F.ceil(6 * b / 7) + 1)
        return (4 * F.least(a, b) >= 3 * F.greatest(a, b)) & (F.least(a - p, b - q) >= need) & smaller_first

    # step 4 -------------------------------------------------------------------------------------------
    def sets_of(self, nodes: DataFrame, name: str) -> DataFrame:
        """node, task, shingles and sketch (binary) of the given classes, at least; a class that several tasks met has a row from each.

        Texts are hashed again rather than moved: the bitmap tells each task which
        classes may be wanted, and it keeps one copy of each.
        """
        bits, width = self.spark.sparkContext.broadcast(marked(nodes)), self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hasher, known, task = Hasher(width), set(), TaskContext.get().partitionId()
            for _, texts in texts_in_steps(batches, chars=HASH_CHARS):
                found = []
                for s in hasher.sets(texts):
                    node = class_key(s) if len(s) else None
                    if node is not None and node not in known and is_marked(bits.value, np.array([node]))[0]:
                        known.add(node)
                        found.append((node, s.tobytes(), sketch(s)))
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([task] * len(found), pa.int32()), *(pa.array([x[i] for x in found], pa.binary()) for i in (1, 2))], names=["node", "task", "shingles", "sketch"])

        return self.scratch.put(self.docs.select("text").mapInArrow(run, "node long, task int, shingles binary, sketch binary"), name)

    def pairs_of(self, members: DataFrame, sets: DataFrame, best: bool) -> DataFrame:
        """query, node: pairs of members (h, node, n, pos, x, k) of a list with different x that neither places nor sketches refuse."""
        sketches = sets.groupBy("node").agg(F.min("sketch").alias("sketch"))
        chunks = F.ceil(F.col("k") / SIDE)
        dealt = members.withColumn("chunk", F.pmod(F.xxhash64("node"), chunks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)))
        dealt = dealt.select("h", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"), "chunk", "node", "n", "pos", "x")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rest: list[pa.RecordBatch] = []  # the last block may go on in the next batch
            for b in batches:
                if not b.num_rows:
                    continue
                rows = pa.Table.from_batches([*rest, b]).combine_chunks().to_batches()[0]
                keys = np.stack([np.asarray(rows.column(c)) for c in ("h", "low", "high")])
                cut = int((keys == keys[:, -1:]).all(axis=0).argmax())
                if cut:
                    yield from found(rows.slice(0, cut))
                rest = [rows.slice(cut)]
            if rest:
                yield from found(rest[0])

        def found(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            node = np.asarray(rows.column("node"))
            for a, b in pairs_left(rows, best):
                yield pa.RecordBatch.from_arrays([pa.array(node[a], pa.int64()), pa.array(node[b], pa.int64())], names=["query", "node"])

        blocks = dealt.join(sketches, "node").repartition("h", "low", "high").sortWithinPartitions("h", "low", "high")
        return blocks.mapInArrow(run, "query long, node long").distinct()

    def among(self, sets: DataFrame, nodes: DataFrame) -> DataFrame:
        """The rows of ``sets`` that may belong to the given classes, by bitmap, so that few are moved."""
        bits = self.spark.sparkContext.broadcast(marked(nodes))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield b.filter(pa.array(is_marked(bits.value, np.asarray(b.column("node")))))

        return sets.mapInArrow(run, sets.schema)

    def verified(self, pairs: DataFrame, sets: DataFrame, name: str) -> DataFrame:
        """The similar ones of the pairs (query, node), found by T-occurrence search for each query."""
        chunks = pairs.groupBy("query").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
        nodes = pairs.select("node").unionByName(pairs.select(F.col("query").alias("node")))
        own = self.among(sets, nodes)
        which = sets.select("node", "task").groupBy("node").agg(F.min("task").alias("task"))
        spread = pairs.join(chunks, "query").withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks"))).join(which, "node")
        members = spread.join(own, ["node", "task"]).select("query", "chunk", "node", "shingles")
        asked = chunks.select(F.col("query").alias("node"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("part")).join(which, "node")
        queries = asked.join(own, ["node", "task"]).select(F.col("node").alias("asker"), "part", F.col("shingles").alias("own"))

        def search(key: tuple, found: pd.DataFrame, query: pd.DataFrame) -> pd.DataFrame:
            if not len(found) or not len(query):
                return pd.DataFrame({"a": [], "b": []}).astype("int64")
            own = np.frombuffer(query["own"].iloc[0], dtype=U64)
            out = []
            for i in range(0, len(found), 2 * CHUNK):
                part = found.iloc[i:i + 2 * CHUNK]
                sets = [np.frombuffer(x, dtype=U64) for x in part["shingles"]]
                least = min(map(len, sets))
                hits = divide_skip(_inverted(own, sets), -(-3 * (len(own) + least) // 7))
                nodes = part["node"].to_numpy()
                out += [int(nodes[j]) for j, n in hits.items() if similar(n, len(own), len(sets[j]))]
            return pd.DataFrame({"a": np.full(len(out), key[0], dtype=np.int64), "b": np.array(out, dtype=np.int64)})

        links = members.groupBy("query", "chunk").cogroup(queries.groupBy("asker", "part")).applyInPandas(search, "a long, b long")
        return self.scratch.put(links, name)

    # step 5 -------------------------------------------------------------------------------------------
    def labels(self, links: DataFrame, name: str) -> DataFrame:
        """node, label for each class with a link; equal labels mean connected."""
        edges, pointers, turn = links.select("a", "b").where("a <> b").distinct(), [], 0
        while True:
            edges = self.scratch.put(edges, f"{name}-edges-{turn}")
            if turn:
                self.scratch.drop(f"{name}-edges-{turn - 1}")
            if edges.isEmpty():
                break
            both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
            to = self.scratch.put(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("to")), f"{name}-to-{turn}")
            pointers.append(to)
            edges = (edges.join(to, "a").select(F.col("to").alias("x"), F.col("b").alias("a")).join(to, "a")
                     .select(F.least("x", "to").alias("a"), F.greatest("x", "to").alias("b")).where("a <> b").distinct())
            turn += 1
        if not pointers:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
        found = pointers[0].select(F.col("a").alias("node"), F.col("to").alias("label"))
        for to in pointers[1:]:
            step = to.select(F.col("a").alias("label"), "to")
            found = found.join(step, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
        found = self.scratch.put(found, f"{name}-labels")
        for i in range(turn):
            self.scratch.drop(f"{name}-to-{i}")
        return found

    def links(self, counters: np.ndarray, deal: np.ndarray) -> tuple[DataFrame, DataFrame]:
        """(links between classes that connect all that is connected, the classes' labels)."""
        buckets = max(self.docs.rdd.getNumPartitions(), 12)
        lists = self.lists(counters, deal, buckets)
        stars = self.stars(lists)
        sets = self.sets_of(stars.select("node").unionByName(stars.select(F.col("query").alias("node"))), "sets")
        best = stars.groupBy("node").agg(F.max_by("query", F.struct("shared", "query")).alias("query"))
        links = self.verified(best, sets, "links-best")
        labels = self.labels(links, "best")

        def label(df: DataFrame, col: str, out: str) -> DataFrame:
            step = labels.select(F.col("node").alias(col), F.col("label").alias(out))
            return df.join(step, col, "left").withColumn(out, F.coalesce(out, col))

        apart = label(label(stars.select("node", "query"), "node", "x"), "query", "y").where("x <> y").select("node", "query")
        links = links.unionByName(self.verified(apart.join(best, ["node", "query"], "left_anti"), sets, "links-stars"))
        self.scratch.drop("sets")
        labels = self.labels(links, "stars")

        # The only pair of a list with two classes is its star.
        def open_lists(df: DataFrame, name: str) -> DataFrame:
            """h, node, n, pos, x, k: the members of the lists that hold several components."""
            members = label(df.select("h", "node", "n", "pos"), "node", "x")
            several = members.groupBy("h").agg(F.min("x").alias("low"), F.max("x").alias("high"), F.count("*").alias("k")).where("low <> high").select("h", "k")
            return self.scratch.put(members.join(several, "h"), name)

        members = open_lists(lists.where("k > 2"), "members")
        self.scratch.drop("lists")
        if not members.isEmpty():
            more = self.sets_of(members, "more-sets")
            tried = stars.select("node", "query").unionByName(stars.select(F.col("query").alias("node"), F.col("node").alias("query")))
            pairs = self.scratch.put(self.pairs_of(members, more, best=True).join(tried, ["node", "query"], "left_anti"), "pairs-closest")
            links = links.unionByName(self.verified(pairs, more, "links-closest"))
            labels = self.labels(links, "closest")
            tried = tried.unionByName(pairs.select("node", "query")).unionByName(pairs.select(F.col("query").alias("node"), F.col("node").alias("query")))
            members = open_lists(members, "members-left")
            pairs = self.scratch.put(self.pairs_of(members, more, best=False).join(tried, ["node", "query"], "left_anti"), "pairs")
            links = links.unionByName(self.verified(pairs, more, "links-rest"))
            for name in ("more-sets", "members-left", "pairs-closest", "pairs"):
                self.scratch.drop(name)
        for name in ("members", "stars"):
            self.scratch.drop(name)
        return links, self.labels(links, "all")

    def components(self) -> DataFrame:
        """doc_id, n_shingles, component_id of every row."""
        chars = self.docs.agg(F.sum(F.length("text"))).first()[0] or 0
        bits = log2_between(chars / CHARS_PER_COUNTER, MIN_COUNTERS, MAX_COUNTERS)
        sized = self.sized(bits)
        counters, deal = self.counters(sized, bits)
        rows = self.scratch.put(sized.where("n_shingles >= 0").drop("places", "counts"), "rows")
        self.scratch.drop("sized")
        _, labels = self.links(counters, deal)
        classes = rows.where("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("first"))
        classes = classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        smallest = classes.groupBy("label").agg(F.min("first").alias("component_id"))
        by_class = classes.join(smallest, "label").select("node", "component_id")
        empty = rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
        return rows.where("n_shingles > 0").join(by_class, "node").select("doc_id", "n_shingles", "component_id").unionByName(empty)


def marked(nodes: DataFrame, per_row: int = 8) -> np.ndarray:
    """A bitmap with the bits of the rows' ``node`` set; about ``per_row`` bits a row, within fixed bounds."""
    marks = log2_between(per_row * nodes.count(), MIN_MARKS, MAX_MARKS)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.unique(mark_of(np.asarray(b.column("node")), marks))
            block, out = at >> MARK_BLOCK, []
            full = np.unique(block)
            for start, end in zip(np.searchsorted(block, full), np.searchsorted(block, full, "right")):
                bits = np.zeros(1 << MARK_BLOCK, dtype=bool)
                bits[at[start:end] & ((1 << MARK_BLOCK) - 1)] = True
                out.append(np.packbits(bits).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(full, pa.int64()), pa.array(out, pa.binary())], names=["block", "bits"])

    def join(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(1 << MARK_BLOCK - 3, dtype=np.uint8)
        for raw in frame["bits"]:
            total |= np.frombuffer(raw, dtype=np.uint8)
        return pd.DataFrame({"block": [key[0]], "bits": [total.tobytes()]})

    table = np.zeros((1 << marks - MARK_BLOCK, 1 << MARK_BLOCK - 3), dtype=np.uint8)
    for block, raw in nodes.select("node").mapInArrow(mark, "block long, bits binary").groupBy("block").applyInPandas(join, "block long, bits binary").collect():
        table[block] = np.frombuffer(raw, dtype=np.uint8)
    return table.ravel()


def without(docs: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose key is not among those of ``gone``; no key is null.

    A bitmap of the gone keys clears nearly all rows that stay, and these are not moved: only
    the rest, the gone rows and few others, are joined, so most texts are never shuffled.
    """
    bits = docs.sparkSession.sparkContext.broadcast(marked(gone.select(F.xxhash64(key).alias("node")), per_row=32))

    @F.pandas_udf("boolean")
    def doubtful(nodes: pd.Series) -> pd.Series:
        return pd.Series(is_marked(bits.value, nodes.to_numpy()))

    doubt = doubtful(F.xxhash64(key))
    return docs.where(~doubt).unionByName(docs.where(doubt).join(gone.select(key), key, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns]))


def near_duplicate_components(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    return JaccardJoin(docs, width).components()


def keep_one_per_component(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stand for their component: the one with its smallest doc_id.

    Where ids repeat or are null, rows are told apart by a number of their own; of rows with
    an equal smallest id one stays. Rows with an empty set are components of their own.
    """
    join = JaccardJoin(docs)
    found = join.scratch.put(join.components(), "components")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    if found.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").isEmpty():
        return without(docs, "doc_id", found.where("doc_id <> component_id")).select(*columns)
    numbered = join.scratch.put(docs.withColumn("_llm_j_row", F.monotonically_increasing_id()), "numbered")
    found = JaccardJoin(numbered.select(F.col("_llm_j_row").alias("doc_id"), "text")).components()
    keyed = join.scratch.put(numbered.select("_llm_j_row", "doc_id").join(found.withColumnRenamed("doc_id", "_llm_j_row"), "_llm_j_row"), "keyed")
    best = keyed.groupBy("component_id").agg(F.min_by("_llm_j_row", F.struct(F.col("doc_id").isNull(), "doc_id", "_llm_j_row")).alias("_llm_j_row"))
    gone = join.scratch.put(keyed.join(best.select("_llm_j_row"), "_llm_j_row", "left_anti").select("_llm_j_row"), "gone")
    return without(numbered, "_llm_j_row", gone).select(*columns)
