"""SimHash near duplicates through an inverted index of byte positions, with count filtering.

A document's fingerprint has 64 bits: bit i is set if it is set in over half of
the XXH64 values (seed 42) of its three-word shingles. Fingerprints link at
``distance`` (3) or fewer differing bits; a component is what links connect.

1. One Arrow pass makes the fingerprints. Equal ones are one row from here on
   (with the smallest doc_id), so copies cost nothing more.
2. A fingerprint is eight bytes. Three differing bits touch three of them at
   most, so two that link share the byte at five positions at least: the
   guaranteed number of matches. The inverted index is cut into *cells* by the
   bytes at s positions: ``position_sets(s)`` is a family of s-sets one of which
   lies in every five positions, so a linked pair meets in a cell.
   s follows the number of fingerprints (2, 3, 4 or 5 positions, 4, 8, 14 or 56
   cells a fingerprint), so that a cell holds few that meet by chance; it changes
   the cost only, never the result.
3. In a cell each further (position, byte) has its list of fingerprints. The
   lists are run through, shared positions are tallied for each pair, pairs that
   reach five with the cell's own are kept and verified by their differing bits.
   A cell of more than CHUNK fingerprints is dealt into chunks, and each pair of
   chunks is a group of its own, so neither a task nor a step holds a cell whole.
   A group gives one link a fingerprint (to the smallest it is connected with
   there), not all pairs.
4. Components by contraction; the smallest doc_id names a component.

Defined results: a null text or one without words has fingerprint zero, linked
like any other; with one or two words the whole sequence is the one shingle;
repeated shingles and rows count as often as they occur; an empty table gives no
rows. A null doc_id names a component only if it has no other.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import Scratch, texts_in_steps
from marketlens.llm.components import labels

WIDTH, SEED, DISTANCE, BYTES = 3, 42, 3, 8
#: Fingerprints that a cell may hold by chance before more positions are used.
CROWD = 16
#: Fingerprints of one chunk of a cell; a group holds two chunks at most.
CHUNK = 256
#: Pairs of members (squares of sizes) of the whole groups that are tallied at a time; one larger group is a step of its own.
STEP = 500_000
U64 = np.uint64


def shingle_hashes(text: str, width: int = WIDTH) -> list[int]:
    """XXH64 of each shingle of the text, repeats included; A-Z are lower-cased, words end at \\x20 and \\x09-\\x0D."""
    words = text.encode().lower().split()
    if not words:
        return []
    joined = memoryview(b" ".join(words))
    ends = (np.cumsum([len(w) + 1 for w in words]) - 1).tolist()
    starts = [0] + [e + 1 for e in ends[:-1]]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1:] or ends[-1:])]


def majority_bits(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The fingerprint of each run of ``sizes`` hashes; an empty run has fingerprint zero."""
    out = np.zeros(len(sizes), dtype=U64)
    full = np.flatnonzero(sizes)
    if len(full):
        starts = np.cumsum(sizes[full]) - sizes[full]
        for bit in range(64):
            ones = np.add.reduceat((hashes >> U64(bit)) & U64(1), starts)
            out[full] |= (2 * ones > sizes[full].astype(U64)).astype(U64) << U64(bit)
    return out


def fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in texts_in_steps(batches):
            each = [shingle_hashes(t, width) for t in texts]
            sizes = np.array([len(h) for h in each], dtype=np.int64)
            flat = np.fromiter((x for h in each for x in h), dtype=U64, count=int(sizes.sum()))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(majority_bits(flat, sizes).view(np.int64))], ["doc_id", "fp"])

    docs = docs.select("doc_id", "text")
    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long")


def position_sets(s: int) -> list[tuple[int, ...]]:
    """s-sets of the eight byte positions, one of which lies in every five positions.

    2: the four neighbours, as five positions put two in one of four pairs. 3: the triples within
    each half, as five put three in one half. 4: the sets whose numbers XOR to zero; every three
    positions lie in one of these, so do the three left out by five, and what it leaves out is another. 5: all.
    """
    if s == 2:
        return [(i, i + 1) for i in range(0, BYTES, 2)]
    if s == 3:
        return [c for half in (range(4), range(4, 8)) for c in combinations(half, 3)]
    if s == 4:
        return [c for c in combinations(range(BYTES), 4) if c[0] ^ c[1] ^ c[2] ^ c[3] == 0]
    return list(combinations(range(BYTES), BYTES - DISTANCE))


def positions_for(n: int) -> int:
    """Positions of a cell's key for n fingerprints."""
    return next((s for s in (2, 3, 4) if n <= CROWD << (8 * s)), BYTES - DISTANCE)


def tally(fps: np.ndarray, group: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of one group that share the byte at ``least`` or more positions; ``group`` is ascending.

    Lists of (group, position, byte) are the runs of equal keys; every pair in a run gets one count.
    """
    octets = fps.view(np.uint8).reshape(-1, BYTES).astype(np.int64)
    keys = ((group[:, None] * BYTES + np.arange(BYTES)) * 256 + octets).ravel()
    order = np.argsort(keys, kind="stable")
    keys, member = keys[order], order // BYTES
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    ends = np.repeat(starts + sizes, sizes)  # of each entry's run
    after = ends - np.arange(len(keys)) - 1  # entries that follow it in its list
    first = np.repeat(np.arange(len(keys)), after)
    second = first + 1 + np.arange(len(first)) - np.repeat(np.cumsum(after) - after, after)
    pairs, shared = np.unique(member[first] * len(fps) + member[second], return_counts=True)
    pairs = pairs[shared >= least]
    return pairs // len(fps), pairs % len(fps)


def connect(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest number each of 0..n-1 is connected with."""
    lab = np.arange(n)
    while True:
        new = lab.copy()
        low = np.minimum(lab[i], lab[j])
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == lab).all():
            return lab
        lab = new


def links(nodes: DataFrame, scratch: Scratch, n: int, distance: int = DISTANCE, s: int | None = None) -> DataFrame:
    """a, b: links that connect all fingerprints (column fp, distinct) that differ in ``distance`` bits at most."""
    least = BYTES - distance
    families = position_sets(s or positions_for(n))
    masks = [sum(0xFF << (8 * p) for p in c) for c in families]
    masks = [m - (1 << 64) if m >> 63 else m for m in masks]
    cells = F.array(*[F.struct(F.lit(k).alias("family"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("cell")) for k, m in enumerate(masks)])
    index = nodes.select("fp", F.explode(cells).alias("c")).select("fp", "c.family", "c.cell")
    # Most cells hold one fingerprint: only the others' members are moved for the second time.
    crowds = scratch.put(index.groupBy("family", "cell").agg(F.count("*").alias("k")).where("k > 1").withColumn("chunks", F.ceil(F.col("k") / CHUNK)), "crowds")
    dealt = index.join(crowds, ["family", "cell"]).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("chunks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    groups = dealt.groupBy("family", "cell", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")).agg(F.collect_list("fp").alias("fps"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = b.column("fps")
            offsets = column.offsets.to_numpy()
            every = column.values.to_numpy(zero_copy_only=False).view(U64)
            sizes = np.diff(offsets)
            cost = np.cumsum(sizes * sizes)
            at = 0
            while at < len(sizes):
                to = max(at + 1, int(np.searchsorted(cost, (cost[at - 1] if at else 0) + STEP, "right")))
                fps = every[offsets[at]:offsets[to]].copy()
                i, j = tally(fps, np.repeat(np.arange(to - at), sizes[at:to]), least)
                near = np.bitwise_count(fps[i] ^ fps[j]) <= distance
                lab = connect(len(fps), i[near], j[near])
                away = np.flatnonzero(lab != np.arange(len(fps)))
                yield pa.RecordBatch.from_arrays([pa.array(fps[away].view(np.int64)), pa.array(fps[lab[away]].view(np.int64))], ["a", "b"])
                at = to

    return groups.select("fps").mapInArrow(run, "a long, b long")


def near_duplicate_components(docs: DataFrame, distance: int = DISTANCE, width: int = WIDTH) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits), component_id of every row."""
    if not 0 <= distance <= DISTANCE:
        raise ValueError(f"distance must be 0 to {DISTANCE}: the cells' position sets are made for five shared bytes")
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = scratch.put(fingerprints(docs, width), "fingerprints")
    nodes = scratch.put(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    found = labels(scratch, links(nodes, scratch, nodes.count(), distance))
    scratch.drop("crowds")
    named = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    smallest = named.groupBy("label").agg(F.min("first").alias("component_id"))
    by_fp = named.join(smallest, "label").select("fp", "component_id")
    return rows.join(by_fp, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
