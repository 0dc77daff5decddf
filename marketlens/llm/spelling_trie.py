"""Spelling variants: words one edit apart, found in tries of letter-group counts.

1. One Arrow pass takes the words of every text and counts them; a task sends
   each word of a batch once, and Spark adds the counts up.
2. The letters are dealt into GROUPS groups of about equal weight. A word's
   *frequency vector* holds how many of its letters fall in each group. One
   inserted, deleted or replaced letter adds one to at most one count (surplus)
   and takes one from at most one (deficit).
3. The trie's levels are the successive counts of the vector. Its top levels
   part the words into *shards*: a word is indexed in the shard of its own first
   counts and asked in those shards that a budget of one surplus and one deficit
   reaches. Being near is mutual, so of a step and its opposite only one is
   asked. Shards of many words or askers are dealt into chunks, and each chunk of
   words meets each chunk of askers in a group of its own.
4. A group builds the trie of its words and goes through it depth first with all
   its askers: a node keeps those whose budgets last to it, each with what is left
   of its surplus and deficit. Words of a leaf are verified code point by code point.
5. A word's *form* is its most frequent near word, if that is at least twice as
   frequent; roots are found by doubling the step along forms. Frequency doubles
   at every step, so there are no cycles and few rounds.

Defined results: a null text has no words; a null doc_id is written as the empty
text in what is hashed; repeated rows count as often as they occur; an empty
table gives no rows. Words of any length take part.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import Scratch, texts_in_steps

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LEAST_LENGTH, LEAST_COUNT, NOISE, RATIO = 5, 3, 97, 2
GROUPS = 12
#: Words whose counts a task holds before it sends them on.
HELD = 300_000
#: Words, and askers, of one group.
WORDS, ASKERS = 16_000, 64_000
#: A node with so few words is a leaf: their remaining counts are compared at once.
LEAF = 4
#: Candidates verified at a time; words up to this length in one array, longer ones one by one.
STEP, WIDE = 200_000, 40


def count_words(docs: DataFrame, noise: int = NOISE) -> DataFrame:
    """word, n: all words with their number of occurrences (with the dealt deletions)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def sent() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for rows, texts in texts_in_steps(batches):
            for doc, text in zip(rows.column("doc_id").to_pylist(), texts):
                start = zlib.crc32(b"%s:" % (b"" if doc is None else str(doc).encode()))
                for word, n in Counter(RUN.findall(text.encode().lower().decode())).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % noise == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                    held[word] += n
            if len(held) >= HELD:
                yield sent()
        yield sent()

    return docs.select("doc_id", "text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def letter_groups(words: DataFrame, groups: int = GROUPS) -> np.ndarray:
    """Group of each code point up to U+00FF: heaviest letter first, each to the lightest group so far (ties: smaller numbers)."""
    letter = F.explode(F.split("word", "")).alias("letter")
    weights = words.select(letter).where("letter <> ''").groupBy("letter").count().collect()  # one row a letter, 90 at most
    load, group = [0] * groups, np.zeros(256, dtype=np.int64)
    for letter, n in sorted(weights, key=lambda r: (-r[1], r[0])):
        g = min(range(groups), key=lambda i: (load[i], i))
        load[g] += n
        group[ord(letter)] = g
    return group


def vectors(letters: np.ndarray, sizes: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """A row of counts for each word; ``letters`` holds all words' code points, one after the other."""
    cell = np.repeat(np.arange(len(sizes)), sizes) * groups + group[letters]
    return np.bincount(cell, minlength=len(sizes) * groups).reshape(-1, groups)


def spelled(column: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The words as Latin-1 (one byte a code point), their code points and lengths."""
    words = [w.encode("latin-1") for w in column.to_pylist()]
    return words, np.frombuffer(b"".join(words), dtype=np.uint8), np.array([len(w) for w in words], dtype=np.int64)


def shard_numbers(levels: int) -> np.ndarray:
    """Odd 64-bit multipliers; a shard's number is the sum of count x multiplier, so a step is an addition."""
    return np.array([(0x9E3779B97F4A7C15 * (2 * i + 3) ** 3 | 1) & (2**64 - 1) for i in range(levels)], dtype=np.uint64)


def reachable(vector: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, shard) of all shards to ask: no step, one more in a group, or one more in a group and one less in a later one."""
    own = (vector.astype(np.uint64) * numbers).sum(axis=1, dtype=np.uint64)
    every = np.arange(len(own))
    who, where = [every], [own]
    for i, up in enumerate(numbers):
        who.append(every)
        where.append(own + up)
        for j in range(i + 1, len(numbers)):
            has = np.flatnonzero(vector[:, j])
            who.append(has)
            where.append(own[has] + up - numbers[j])
    return np.concatenate(who), np.concatenate(where)


def one_edit(a: bytes, b: bytes) -> bool:
    if len(a) > len(b):
        a, b = b, a
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1:] == b[i + 1:] and i < len(a) if len(a) == len(b) else len(b) == len(a) + 1 and a[i:] == b[i + 1:]


def one_edit_rows(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """``one_edit`` of rows of zero-padded letters; the last column is zero in all."""
    out = (size_a == size_b) & ((a != b).sum(axis=1) == 1)
    apart = np.flatnonzero(np.abs(size_a - size_b) == 1)
    if len(apart):
        swap = (size_a < size_b)[apart, None]
        long, short = np.where(swap, b[apart], a[apart]), np.where(swap, a[apart], b[apart])
        differ = long != short
        first = differ.argmax(axis=1)  # there is one, as the longer has a letter where the shorter ended
        shifted = long[:, 1:] != short[:, :-1]
        out[apart] = ~(shifted & (np.arange(shifted.shape[1]) >= first[:, None])).any(axis=1)
    return out


class Trie:
    """Words in the order of their vectors: a node is a run of rows that agree in the first counts."""

    def __init__(self, vector: np.ndarray):
        self.order = np.lexsort(vector.T[::-1])
        self.vector = vector[self.order]

    def search(self, asked: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows of ``asked``, words) that a surplus of one and a deficit of one let meet in a leaf, depth first."""
        n, groups = self.vector.shape
        one = np.ones(len(asked), dtype=np.int8)
        stack = [(0, n, 0, np.arange(len(asked)), one, one)] if n else []
        while stack:
            low, high, level, alive, more, less = stack.pop()
            if high - low <= LEAF or level == groups:
                yield np.repeat(alive, high - low), np.tile(self.order[low:high], len(alive))
                continue
            column = self.vector[low:high, level]
            starts = np.r_[0, np.flatnonzero(column[1:] != column[:-1]) + 1, high - low]
            counts = asked[alive, level]
            for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
                over = column[a] - counts
                on = np.flatnonzero((over <= more) & (-over <= less))
                if len(on):
                    over = over[on].astype(np.int8)
                    stack.append((low + a, low + b, level + 1, alive[on], more[on] - (over > 0), less[on] - (over < 0)))


def near_pairs(words: pa.Array, asked: pa.Array, group: np.ndarray, groups: int = GROUPS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of ``asked``, rows of ``words``) one edit apart."""
    spell_w, letters_w, sizes_w = spelled(words)
    spell_q, letters_q, sizes_q = spelled(asked)
    vector_w, vector_q = vectors(letters_w, sizes_w, group, groups), vectors(letters_q, sizes_q, group, groups)

    def padded(spell: list[bytes]) -> np.ndarray:
        return np.array([w[:WIDE] for w in spell], dtype=f"S{WIDE + 1}").view(np.uint8).reshape(len(spell), WIDE + 1)

    wide_w, wide_q = padded(spell_w), padded(spell_q)

    def verified(q: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        over = vector_w[w] - vector_q[q]
        fits = (np.abs(over).max(axis=1, initial=0) <= 1) & ((over > 0).sum(axis=1) <= 1) & ((over < 0).sum(axis=1) <= 1)
        q, w = q[fits], w[fits]
        long = (sizes_q[q] > WIDE) | (sizes_w[w] > WIDE)
        ok = ~long & one_edit_rows(wide_q[q], wide_w[w], sizes_q[q], sizes_w[w])
        for k in np.flatnonzero(long):
            ok[k] = one_edit(spell_q[q[k]], spell_w[w[k]])
        return q[ok], w[ok]

    held, size = [], 0
    for q, w in Trie(vector_w).search(vector_q):
        for at in range(0, len(q), STEP):
            held.append((q[at:at + STEP], w[at:at + STEP]))
            size += len(held[-1][0])
            if size >= STEP:
                yield verified(*(np.concatenate(x) for x in zip(*held)))
                held, size = [], 0
    if held:
        yield verified(*(np.concatenate(x) for x in zip(*held)))


def best_of(words: list[str], n: np.ndarray, target: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(target, how many others it has, its best other): largest n, ties to the smallest in code-point order."""
    rank = np.empty(len(words), dtype=np.int64)
    rank[np.array(sorted(range(len(words)), key=words.__getitem__), dtype=np.int64)] = np.arange(len(words))
    order = np.lexsort((rank[other], -n[other], target))
    target, other = target[order], other[order]
    starts = np.flatnonzero(np.r_[True, target[1:] != target[:-1]]) if len(target) else np.array([], dtype=np.int64)
    return target[starts], np.diff(np.r_[starts, len(target)]), other[starts]


def near_words(words: DataFrame, scratch: Scratch, group: np.ndarray, levels: int, groups: int = GROUPS, most: tuple[int, int] = (WORDS, ASKERS)) -> DataFrame:
    """word, n_near, best (struct n, word) for each word with a near word."""
    numbers = shard_numbers(levels)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in (batch.slice(i, 20_000) for i in range(0, batch.num_rows, 20_000)):
                _, letters, sizes = spelled(b.column("word"))
                who, where = reachable(vectors(letters, sizes, group, groups)[:, :levels], numbers)
                n = b.num_rows  # the first n are the words' own shards
                own = pa.RecordBatch.from_arrays([pa.array(where[:n].view(np.int64)), pa.array(np.ones(n, dtype=bool)), b.column("word"), b.column("n")], ["shard", "indexed", "word", "n"])
                yield own
                yield pa.RecordBatch.from_arrays([pa.array(where.view(np.int64)), pa.array(np.zeros(len(who), dtype=bool)), *(b.column(c).take(pa.array(who)) for c in ("word", "n"))], own.schema.names)

    sent = words.mapInArrow(send, "shard long, indexed boolean, word string, n long")
    indexed = F.count_if("indexed")
    sizes = sent.groupBy("shard").agg(F.ceil(indexed / most[0]).alias("parts"), F.ceil((F.count("*") - indexed) / most[1]).alias("turns"))
    sizes = scratch.put(sizes.where("parts > 0"), "shards")  # nobody needs to be asked where no word is
    # A word has one part and meets every turn of askers; an asker has one turn and meets every part.
    own = F.pmod(F.xxhash64("word"), F.when(F.col("indexed"), F.col("parts")).otherwise(F.col("turns")))
    every = F.sequence(F.lit(0).cast("long"), F.when(F.col("indexed"), F.col("turns")).otherwise(F.col("parts")) - 1)
    dealt = sent.join(sizes, "shard").select("shard", "indexed", "word", "n", own.alias("own"), F.explode(every).alias("other")).select(
        "shard", "indexed", "word", "n", F.when(F.col("indexed"), F.col("own")).otherwise(F.col("other")).alias("part"),
        F.when(F.col("indexed"), F.col("other")).otherwise(F.col("own")).alias("turn"))
    schema = pa.schema([("word", pa.string()), ("k", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])

    def search(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([("indexed", "descending")])
        k = table.column("indexed").to_numpy().sum()  # words first, then askers
        if not 0 < k < table.num_rows:
            return schema.empty_table()
        every = table.column("word").combine_chunks()
        n = table.column("n").to_numpy()
        found = [(q + k, w) for q, w in near_pairs(every.slice(0, k), every.slice(k), group, groups)]
        q, w = (np.concatenate(x) for x in zip(*found)) if found else (np.array([], dtype=np.int64),) * 2
        names = every.to_pylist()
        # A word met in its own shard is asked there itself; of two shards only one asks the other.
        shards = shard_of(every, levels)
        back = shards[q] != shards[w]
        target, size, best = best_of(names, n, np.r_[q, w[back]], np.r_[w, q[back]])
        return pa.Table.from_arrays([every.take(pa.array(target)), pa.array(size), pa.array(n[best]), every.take(pa.array(best))], schema=schema)

    def shard_of(column: pa.Array, levels: int) -> np.ndarray:
        _, letters, sizes = spelled(column)
        return (vectors(letters, sizes, group, groups)[:, :levels].astype(np.uint64) * numbers).sum(axis=1, dtype=np.uint64)

    found = dealt.groupBy("shard", "part", "turn").applyInArrow(search, "word string, k long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("minus_n"), F.col("best").alias("word")))
    return found.groupBy("word").agg(F.sum("k").alias("n_near"), best.alias("best"))


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """word, root for each row (word, form): the last of the forms that follow; the step doubles each round."""
    at, turn = scratch.put(forms.select("word", F.col("form").alias("root")), "roots-0"), 0
    while True:
        step = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = scratch.put(at.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), f"roots-{turn + 1}")
        scratch.drop(f"roots-{turn}")
        at, turn = moved.select("word", "root"), turn + 1
        if moved.where("moved").isEmpty():
            return at


def spelling_forms(docs: DataFrame, ratio: int = RATIO, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, levels: int | None = None) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the texts."""
    scratch = Scratch(docs.sparkSession, "spelling")
    words = scratch.put(count_words(docs).where((F.char_length("word") >= least_length) & (F.col("n") >= least_count)), "words")
    size = words.count()
    if levels is None:  # every level halves a shard, about
        levels = min(GROUPS, max(1, (size // WORDS).bit_length()))
    near = near_words(words, scratch, letter_groups(words), levels)
    known = words.join(near, "word", "left").withColumn("best_n", -F.col("best.minus_n"))
    formed = F.col("best_n") >= ratio * F.col("n")
    known = known.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(formed, F.col("best.word")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n"))
    known = scratch.put(known, "known")
    last = roots(known.where("form IS NOT NULL"), scratch)
    return known.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
