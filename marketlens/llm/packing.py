"""Packing of tokenised documents into windows of fixed capacity by minimum bin slack.

1. One Arrow pass tokenises every document, adds the end id and cuts it into
   pieces: whole windows from the front, and one remainder shorter than a
   window. Each piece is numbered within its task and length.
2. Spark counts pieces per (length, task); a running sum per length gives every
   piece its rank among all pieces of its length. This table has at most
   capacity x tasks rows and is cumulated by windows over one length each.
3. The plan is made from the histogram of lengths alone (at most ``capacity``
   rows, whatever the corpus size): while pieces remain, the longest remaining
   length is placed and a subset-sum bitset over the remaining lengths (each
   with its multiplicity) finds the fill closest to the capacity; walking the
   saved bitsets back gives how many of each length it takes. The pattern is
   then repeated as often as the counts allow, so the plan has a few thousand
   patterns at most, not one per window.
4. A last pass maps (length, rank) to (sequence, offset) by the plan.

Defined results: a null text is empty, so the document is its end id alone;
repeated rows are packed separately; an empty table gives no pieces. Lengths
only matter, so ties need no order. Extra columns are ignored.
"""

from __future__ import annotations

import functools
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.common import Memo, Scratch, kept_by_worker, texts_in_steps

CAPACITY, END_ID = 2048, 1
#: Marks that the vocabulary's pre-tokeniser splits off a preceding letter or digit.
TAIL = b".,!?;:&$%*#|"


def vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@functools.cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


@functools.cache
def _byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write bytes: printable Latin-1 as itself, the rest in order from U+0100."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordIds:
    """Token ids of whole texts for a vocabulary whose tokens never span white space.

    The library tokenises each distinct part (between ASCII white space) once; a
    text's ids are its parts' ids in order. The vocabulary lower-cases after
    composing characters, so lower-casing ASCII letters first changes nothing
    as long as the text stays composed; texts that may hold a special token are
    left as they are. Marks after a letter or digit are tokens of their own, so
    a part is looked up without them first. Tests compare all this with
    tokenising the whole text.
    """

    def __init__(self, path: str):
        self.path, self.memo = path, Memo(self.ids, 500_000)

    def ids(self, part: bytes) -> bytes:
        stem = part.rstrip(TAIL)
        if stem and len(stem) < len(part) and stem.decode("utf-8", "replace")[-1].isalnum():
            return self.memo[stem] + self.memo[part[len(stem):]]
        text = part.decode("utf-8", "replace")
        if text.isalpha() and text == text.lower() and is_normalized("NFC", text):  # one word for the model as it is
            found = [t.id for t in _tokenizer(self.path).model.tokenize(part.decode("latin-1").translate(_byte_letters()))]
        else:
            found = _tokenizer(self.path).encode(text, add_special_tokens=False).ids
        return np.array(found, dtype="<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        """The ids of one text, little-endian, four bytes each."""
        raw = text.encode("utf-8", "replace")
        if b"<|" not in raw and (len(raw) == len(text) or is_normalized("NFC", text) and is_normalized("NFC", raw.lower().decode())):
            raw = raw.lower()
        return b"".join(map(self.memo.__getitem__, raw.split()))


def word_ids(path: str) -> WordIds:
    return kept_by_worker(f"words of {path}", lambda: WordIds(path))


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, and (task, nth): the piece's number among its task's pieces of this length."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = rows.select("doc_id").schema
    for name in ("start", "length", "ids_crc32", "doc_tokens", "task", "nth"):
        schema = schema.add(name, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task, seen = word_ids(path), TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch, texts in texts_in_steps(batches, keep=f"words of {path}"):
            out: list[list[int]] = [[] for _ in range(7)]
            for i, raw in enumerate(map(encode, texts)):
                raw += int(end_id).to_bytes(4, "little")
                total = len(raw) // 4
                for start in range(0, total, capacity):
                    length = min(capacity, total - start)
                    for col, x in zip(out, (i, start, length, zlib.crc32(raw[4 * start:4 * (start + length)]), total, task, seen[length])):
                        col.append(x)
                    seen[length] += 1
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(out[0], pa.int64())), *(pa.array(x, pa.int64()) for x in out[1:])], names=schema.names)

    return rows.mapInArrow(run, schema)


def fill(capacity: int, sizes: list[int], counts: list[int]) -> list[tuple[int, int]]:
    """[(size, how many)] with the largest sum of at most ``capacity``; ``sizes`` fall, each is there ``counts`` times.

    ``reach`` has bit s set if some multiset sums to s. A size with several
    copies is added in chunks of 1, 2, 4, ... copies, so few shifts cover all counts.
    """
    mask, reach = (1 << capacity + 1) - 1, 1
    steps: list[tuple[int, int, int]] = []  # size, copies, reach before
    for size, count in zip(sizes, counts):
        if size > capacity:
            continue
        left, chunk = min(count, capacity // size), 1
        while left:
            take = min(chunk, left)
            grown = reach | reach << take * size & mask
            if grown != reach:
                steps.append((size, take, reach))
                reach = grown
            left, chunk = left - take, 2 * chunk
        if reach >> capacity & 1:
            break
    goal, used = reach.bit_length() - 1, {}
    for size, take, before in reversed(steps):
        if not before >> goal & 1:
            used[size] = used.get(size, 0) + take
            goal -= size * take
    return sorted(used.items(), reverse=True)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """[(repeats, [(length, copies)])]: patterns that together use every piece exactly once."""
    counts = {k: v for k, v in histogram.items() if v > 0}
    if any(k < 1 or k > capacity for k in counts):
        raise ValueError("piece lengths must lie between 1 and the capacity")
    out = []
    order = sorted(counts, reverse=True)
    while order:
        longest = order[0]
        counts[longest] -= 1
        rest = [x for x in order if x <= capacity - longest and counts[x]]
        pattern = dict(fill(capacity - longest, rest, [counts[x] for x in rest]))
        counts[longest] += 1
        pattern[longest] = pattern.get(longest, 0) + 1
        repeats = min(counts[x] // n for x, n in pattern.items())
        for x, n in pattern.items():
            counts[x] -= repeats * n
        out.append((repeats, sorted(pattern.items(), reverse=True)))
        order = [x for x in order if counts[x]]
    return out


class Places:
    """(length, rank) -> (sequence, offset) under a plan."""

    def __init__(self, patterns: list[tuple[int, list[tuple[int, int]]]]):
        self.rows: dict[int, tuple[list[int], list[tuple[int, int, int]]]] = {}
        base = 0
        for repeats, pattern in patterns:
            offset = 0
            for length, copies in pattern:
                firsts, rows = self.rows.setdefault(length, ([], []))
                firsts.append(rows[-1][3] if rows else 0)
                rows.append((base, copies, offset, firsts[-1] + repeats * copies))
                offset += length * copies
            base += repeats
        self.sequences = base

    def __call__(self, length: int, rank: int) -> tuple[int, int]:
        firsts, rows = self.rows[length]
        i = bisect_right(firsts, rank) - 1
        base, copies, offset, _ = rows[i]
        nth = rank - firsts[i]
        return base + nth // copies, offset + length * (nth % copies)


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    cut = scratch.put(pieces(docs, path or vocabulary(), capacity, end_id), "pieces")
    per_task = cut.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    firsts = scratch.put(per_task.withColumn("first", F.coalesce(before, F.lit(0))), "firsts")
    histogram = {r[0]: r[1] for r in firsts.groupBy("length").agg(F.sum("n")).collect()}  # at most `capacity` rows
    places = Places(plan(histogram, capacity))
    fields = [f for f in cut.schema.fields if f.name not in ("task", "nth")]
    schema = cut.select(*[f.name for f in fields]).schema.add("sequence_id", "long").add("offset", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = [places(*x) for x in zip(b.column("length").to_pylist(), b.column("rank").to_pylist())]
            yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in fields), pa.array([s for s, _ in at], pa.int64()), pa.array([o for _, o in at], pa.int64())], names=schema.names)

    ranked = cut.join(firsts.select("length", "task", "first"), ["length", "task"]).withColumn("rank", F.col("first") + F.col("nth"))
    return ranked.mapInArrow(run, schema)
