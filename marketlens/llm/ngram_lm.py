"""An interpolated n-gram language model (up to three words) in an Elias-Fano trie.

Training documents are counted in three Arrow passes, one per order, each with
numpy sums within the task and Spark sums across tasks; every pair and triple
that is counted is in the model:

1. words: every distinct word with its exact count (the counts of the base
   score too). A word's number is the rank of its 64-bit hash.
2. pairs of word numbers, and 3. triples, each the number of its pair and the
   last word's rank among the words that follow the middle one.

The trie has a level per order. A level is a rising sequence of keys, context
number x width + successor, so the successors of one context are one range of
it and the context's pointer is the place where that range starts. Successors
in the third level are written relative to their context: as the rank of the
last word among the successors of the word before it. Counts are sent by range
of keys, never within a context, so the task that sums a range also builds its
Elias-Fano shard, with one byte for each smoothed probability and each back-off
weight (absolute discounting, interpolated down to add-one word probabilities),
and counts are never stored as a table of their own.

Model files are Parquet tables in the shared checkpoint folder. The first worker
that needs one unpacks its arrays beside them, and all workers memory-map these,
so there is one copy of the model. Where only Hadoop reaches the folder, each
executor fetches the tables by ``addFile`` and unpacks a copy of its own; nothing
passes through the driver's memory. Scoring is a fourth
pass; a text's n-grams are looked up by array operations.

Defined results: a null text is empty and has the end token only. Scores are per
row, so repeated rows get equal scores. With no training document every token
is unknown and N and V are 0. An empty table gives none. The model's score of
a token never needs more than the two words before it in its own text.
"""

from __future__ import annotations

import fcntl
import json
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import Scratch, texts_in_steps
from marketlens.llm.elias_fano import EliasFano, Shards, restored_order, rising
from marketlens.llm.jaccard_join import Hasher, _plane, _unplane

#: KEEP: pairs and triples seen less often are left out of the trie; 1 leaves out none.
DISCOUNT, KEEP = 0.75, 1
#: Logarithms are stored as one byte, in steps of 1 / STEPS.
STEPS = 24.0
#: Characters looked up in the model at a time: keys are looked up in order, so those of more text share more of its cache lines.
STEP_CHARS = 3_000_000
#: Pairs or triples that a task holds before it sends their sums.
HELD = 1_500_000
#: Training tokens whose pairs or triples make one shard, about, and the fewest shards.
SHARD_TOKENS, LEAST_SHARDS = 2_000_000, 12
#: Counts of contexts are stored as 16-bit logarithms, within 0.02 per cent.
COUNT_STEPS = 2048
#: A shard's arrays: those of its Elias-Fano sequence, probability codes, counts (none if no level follows).
ARRAYS = (*EliasFano.FIELDS, "codes", "counts")
#: What stands for the hash of the end token.
END = 0x5DEECE66D1234567


def quantised(log10: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-log10 * STEPS), 0, 255).astype(np.uint8)


def restored(code: np.ndarray) -> np.ndarray:
    return code.astype(np.float64) / -STEPS


class Words:
    """Hashes of the words of texts, with the end token after each text."""

    def __init__(self):
        self.hasher = Hasher()

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(hashes as signed numbers, where each text starts; one more for the end)."""
        raws = [t.encode("utf-8", "replace").lower() for t in texts]
        starts, h = self.hasher._words(b"\n".join([*raws, b""]))
        edges = np.cumsum([0, *(len(r) + 1 for r in raws)])
        cut = np.searchsorted(starts, edges)
        at = cut + np.arange(len(cut))
        out = np.empty(len(h) + len(texts), dtype=np.int64)
        ends = at[1:] - 1
        is_word = np.ones(len(out), dtype=bool)
        is_word[ends] = False
        out[is_word], out[ends] = h.view(np.int64), END
        return out, at


def summed(keys: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, rising, and the sums of their counts."""
    if n is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys)
        keys, n = keys[order], n[order]
    at = np.flatnonzero(np.concatenate([np.ones(min(len(keys), 1), dtype=bool), keys[1:] != keys[:-1]]))
    return keys[at], np.diff(np.append(at, len(keys))) if n is None else np.add.reduceat(n, at) if len(at) else n


# Files --------------------------------------------------------------------------------------------------
def publish(df: DataFrame, path: str) -> list[str]:
    """Lets every executor read the table's files; in order, their paths in a shared folder or the names they are fetched by."""
    spark = df.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files = sorted((f.getPath() for f in system.listStatus(folder)), key=lambda p: p.getName())
    files = [p for p in files if p.getName().endswith(".parquet")]
    if system.getScheme() == "file":  # the checkpoint folder is shared, and copies would only take disk
        return [p.toUri().getPath() for p in files]
    for p in files:
        spark.sparkContext.addFile(p.toString())
    return [p.getName() for p in files]


def unpacked(tag: str, files: list[str], make) -> dict:
    """The arrays that ``make`` draws from published files, memory-mapped, and its other values.

    The first worker that needs them (in the shared folder of all, else of its executor)
    saves them beside the files and removes those; the others wait for it and then share the mapped pages.
    """
    shared = bool(files) and os.path.isabs(files[0])
    root = os.path.dirname(os.path.dirname(files[0])) if shared else SparkFiles.getRootDirectory()
    done = os.path.join(root, f"{tag}.json")
    if not os.path.exists(done):
        with open(os.path.join(root, f"{tag}.lock"), "w") as lock:
            fcntl.flock(lock, fcntl.LOCK_EX)
            if not os.path.exists(done):
                paths = files if shared else [SparkFiles.get(f) for f in files]
                arrays, values = make(paths)
                for name, array in arrays.items():
                    np.save(os.path.join(root, f"{tag}-{name}.npy"), array)
                with open(f"{done}.part", "w") as f:
                    json.dump({"arrays": list(arrays), "values": values}, f)
                os.replace(f"{done}.part", done)
                for p in paths:
                    os.remove(p)
    with open(done) as f:
        known = json.load(f)
    out = dict(known["values"])
    for name in known["arrays"]:
        path = os.path.join(root, f"{tag}-{name}.npy")
        # a file of 128 bytes is a header without an array
        out[name] = np.load(path, mmap_mode="r" if os.path.getsize(path) > 128 else None).view(np.ndarray)
    return out


def column(paths: list[str], name: str, kind) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *(np.asarray(pq.read_table(p, columns=[name]).column(name)).astype(kind) for p in paths)])


class Vocabulary:
    """Word numbers (ranks of the hashes) and counts."""

    def __init__(self, files: list[str], tag: str):
        self.files, self.tag, self.hashes = files, tag, None

    def load(self) -> "Vocabulary":
        if self.hashes is None:
            def make(paths):
                n = column(paths, "n", np.int64)
                return {"h": column(paths, "h", np.int64), "n": n.astype(np.uint32) if n.max(initial=0) < 2 ** 32 else n}, {"total": int(n.sum())}

            found = unpacked(self.tag, self.files, make)
            self.hashes, self.counts, self.total, self.size = found["h"], found["n"], found["total"], len(found["h"])
            self.before = None
        return self

    def __getstate__(self):
        return {"files": self.files, "tag": self.tag, "hashes": None}

    def ids(self, h: np.ndarray) -> np.ndarray:
        """Word numbers, -1 for unknown words."""
        if not self.size:
            return np.full(len(h), -1, dtype=np.int64)
        distinct, back = np.unique(h, return_inverse=True)
        at = np.minimum(np.searchsorted(self.hashes, distinct), self.size - 1)
        return np.where(self.hashes[at] == distinct, at, -1)[back]

    def shard_of(self, first: np.ndarray, second: np.ndarray | None, shards: int) -> np.ndarray:
        """Shard numbers that rise with the first word and then the second, with about as many tokens each."""
        if self.before is None:
            self.before = np.cumsum(self.counts, dtype=np.int64) - self.counts
        place = self.before[first].astype(np.float64)
        if second is not None:
            place += self.counts[first] * (self.before[second] / self.total)
        return np.minimum(place * (shards / self.total), shards - 1).astype(np.int64)

    def probability(self, ids: np.ndarray) -> np.ndarray:
        """Add-one probability of words; of an unknown word for -1."""
        known = np.where(ids >= 0, self.counts[ids].astype(np.int64) if self.size else 0, 0)
        return (known + 1) / (self.total + self.size + 1)


class Level:
    """One order above words: keys, a probability each, and a back-off weight for each of the ``n_contexts`` numbers below."""

    def __init__(self, files: list[str], n_contexts: int, tag: str):
        self.files, self.n_contexts, self.tag, self.keys = files, n_contexts, tag, None

    def __getstate__(self):
        return {"files": self.files, "n_contexts": self.n_contexts, "tag": self.tag, "keys": None}

    def load(self) -> "Level":
        if self.keys is None:
            def shards(paths):
                arrays, heads = {"weights": np.zeros(self.n_contexts, dtype=np.uint8)}, []  # code 0: weight 1, for contexts without successors
                for p in paths:
                    for row in (row for b in pq.ParquetFile(p).iter_batches(batch_size=1) for row in b.to_pylist()):
                        arrays |= {f"{len(heads)}-{x}": np.frombuffer(row[x], dtype=row["kinds"][i]) for i, x in enumerate(ARRAYS)}
                        arrays["weights"][np.cumsum(_unplane(row["contexts"], np.int64))] = np.frombuffer(row["weights"], dtype=np.uint8)
                        heads.append([row["base"], row["n"], row["shift"]])
                return arrays, {"heads": heads}

            found = unpacked(self.tag, self.files, shards)
            self.weights = found["weights"]
            made = sorted(((head, [found[f"{i}-{x}"] for x in ARRAYS]) for i, head in enumerate(found["heads"])), key=lambda x: x[0][0])
            self.keys = Shards([EliasFano(*head, *arrays[:4]) for head, arrays in made])
            self.codes, self.counts = [a[4] for _, a in made], [a[5] for _, a in made]
        return self

    def key_of(self, i: np.ndarray) -> np.ndarray:
        """The keys with these numbers. Decodes the shards they are in; only used to build the next level."""
        i, order = rising(i)
        out, cut = np.zeros(len(i), dtype=np.int64), np.searchsorted(i, self.keys.first)
        for s in np.flatnonzero(cut[1:] > cut[:-1]):
            own = slice(cut[s], cut[s + 1])
            out[own] = self.keys.shards[s].values()[i[own] - self.keys.first[s]]
        return restored_order(out, order)

    def _pick(self, arrays: list[np.ndarray], i: np.ndarray) -> np.ndarray:
        i, order = rising(i)
        out, cut = np.zeros(len(i), dtype=np.int64), np.searchsorted(i, self.keys.first)
        for s in np.flatnonzero(cut[1:] > cut[:-1]):
            own = slice(cut[s], cut[s + 1])
            out[own] = arrays[s][i[own] - self.keys.first[s]]
        return restored_order(out, order)

    def log(self, i: np.ndarray) -> np.ndarray:
        return restored(self._pick(self.codes, i))

    def count(self, i: np.ndarray) -> np.ndarray:
        return 2 ** (self._pick(self.counts, i) / COUNT_STEPS)

    def backoff(self, context: np.ndarray) -> np.ndarray:
        """log10 of the weights of contexts; 0 for -1."""
        if not self.n_contexts:
            return np.zeros(len(context))
        return np.where(context >= 0, restored(self.weights[context]), 0.0)


class Model:
    """The trie: words, pairs, triples."""

    def __init__(self, words: Vocabulary, pairs: Level | None = None, triples: Level | None = None, width: int = 0):
        self.words, self.pairs, self.triples, self.width = words, pairs, triples, width

    def load(self) -> "Model":
        self.words.load()
        for level in (self.pairs, self.triples):
            if level is not None:
                level.load()
        return self

    def pair_numbers(self, ids: np.ndarray, follows: np.ndarray) -> np.ndarray:
        """For each token, the number of the pair of it and the token before it; -1 if there is none."""
        out = np.full(len(ids), -1, dtype=np.int64)
        at = np.flatnonzero(follows[1:] & (ids[1:] >= 0) & (ids[:-1] >= 0)) + 1
        if len(at):
            keys, back = np.unique(ids[at - 1] * self.words.size + ids[at], return_inverse=True)
            out[at] = self.pairs.keys.find(keys)[back]
        return out

    def triple_keys(self, ids: np.ndarray, pair: np.ndarray, follows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tokens that end a triple of two known pairs, the triples' keys). The last word is its rank among the middle word's successors."""
        at = np.flatnonzero((pair[2:] >= 0) & (pair[1:-1] >= 0) & follows[2:]) + 2
        middle, back = np.unique(ids[at - 1], return_inverse=True)
        first = self.pairs.keys.lower_bound(middle * self.words.size)[0][back]
        return at, pair[at - 1] * self.width + (pair[at] - first)

    def scores(self, h: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word numbers, log10 probability of each token)."""
        ids = self.words.ids(h)
        log = np.log10(self.words.probability(ids))
        follows = np.ones(len(ids), dtype=bool)
        follows[cut[:-1]] = False  # the first token of a text has no context
        if not len(ids) or not len(self.pairs.keys):
            return ids, log
        pair = self.pair_numbers(ids, follows)
        lower = np.flatnonzero(follows & (pair < 0))
        log[lower] += self.pairs.backoff(ids[lower - 1])
        known = np.flatnonzero(pair >= 0)
        log[known] = self.pairs.log(pair[known])
        if len(self.triples.keys):
            after = np.flatnonzero((pair[:-1] >= 0) & follows[1:]) + 1
            log[after] += self.triples.backoff(pair[after - 1])
            at, keys = self.triple_keys(ids, pair, follows)
            found = self.triples.keys.find(keys)
            log[at[found >= 0]] = self.triples.log(found[found >= 0])
        return ids, log


class Trainer:
    def __init__(self, docs: DataFrame, train: Column):
        self.spark = docs.sparkSession
        self.docs = docs
        self.train = docs.where(train).select(F.col("text").cast("string").alias("text"))
        self.scratch = Scratch(self.spark, "ngram")
        self.tag = uuid.uuid4().hex[:10]

    def vocabulary(self) -> Vocabulary:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words, held, size = Words(), [], 0
            for _, texts in texts_in_steps(batches):
                held.append(summed(words(texts)[0]))
                size += len(held[-1][0])
                if size > HELD:
                    yield rows(held)
                    held, size = [], 0
            if held:
                yield rows(held)

        def rows(held) -> pa.RecordBatch:
            h, n = summed(*(np.concatenate(x) for x in zip(*held)))
            return pa.RecordBatch.from_arrays([pa.array(h), pa.array(n.astype(np.int64))], names=["h", "n"])

        counts = self.train.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
        # written in order of the hash, file by file, so a word's number is its place
        table = self.scratch.put(counts.repartitionByRange("h").sortWithinPartitions("h"), "words")
        return Vocabulary(publish(table, self.scratch.path("words")), f"{self.tag}-words")

    def level(self, keys_of, width: int, n_contexts: int, count_of, lower_log, name: str, last: bool = False) -> tuple[Level, int, int]:
        """(one order, how many keys it has, the most successors of one context).

        ``keys_of`` yields the training texts' keys and the shard of each, ``count_of``(contexts) and
        ``lower_log``(contexts, successors) come from the levels below. Sums travel as one binary value
        per task and shard.
        """
        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words, held, size = Words(), [], 0
            for _, texts in texts_in_steps(batches, chars=STEP_CHARS):
                keys, shard = keys_of(*words(texts))
                order = np.argsort(keys)
                keys = keys[order]
                at = np.flatnonzero(np.concatenate([np.ones(min(len(keys), 1), dtype=bool), keys[1:] != keys[:-1]]))
                held.append((keys[at], np.diff(np.append(at, len(keys))), shard[order[at]]))
                size += len(at)
                if size > HELD:
                    yield blocks(held)
                    held, size = [], 0
            if size:
                yield blocks(held)

        def blocks(held) -> pa.RecordBatch:
            keys, n, shard = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(keys)
            keys, n, shard = keys[order], n[order], shard[order]
            at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            keys, n, shard = keys[at], np.add.reduceat(n, at), shard[at]  # shards rise with the keys
            at = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]]))
            spans = list(zip(at.tolist(), [*at[1:].tolist(), len(keys)]))
            return pa.RecordBatch.from_arrays([pa.array(shard[at], pa.int64()), pa.array([_plane(np.diff(keys[a:b], prepend=0)) for a, b in spans], pa.binary()),
                                               pa.array([_plane(n[a:b].astype(np.uint32)) for a, b in spans], pa.binary())], names=["shard", "keys", "n"])

        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts: dict[int, list] = {}
            for b in batches:
                for row in b.to_pylist():
                    parts.setdefault(row["shard"], []).append((row["keys"], row["n"]))
            for shard in sorted(parts):
                own = parts.pop(shard)
                keys, n = summed(np.concatenate([np.cumsum(_unplane(k, np.int64)) for k, _ in own]), np.concatenate([_unplane(n, np.uint32).astype(np.int64) for _, n in own]))
                keys, n = keys[n >= KEEP], n[n >= KEEP]
                if len(keys):
                    yield built(keys, n)

        def built(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            context, word = keys // width, keys % width
            at = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
            many, each = np.diff(np.append(at, len(keys))), np.maximum(count_of(context[at]), 1)
            weights = quantised(np.log10(np.maximum(1 - np.add.reduceat(n - DISCOUNT, at) / each, 1e-10)))
            p = (n - DISCOUNT) / np.repeat(each, many) + 10 ** (np.repeat(restored(weights), many) + lower_log(context, word))
            ef = EliasFano.build(keys)
            counts = np.minimum(np.rint(np.log2(n) * COUNT_STEPS), 2 ** 16 - 1).astype(np.uint16)
            arrays = [*(np.ascontiguousarray(getattr(ef, x)) for x in EliasFano.FIELDS), quantised(np.log10(np.minimum(p, 1.0))), counts[:0] if last else counts]
            row = {"base": ef.base, "n": ef.n, "shift": ef.shift, "widest": int(many.max()), "kinds": [a.dtype.str for a in arrays],
                   "contexts": _plane(np.diff(context[at], prepend=0)), "weights": weights.tobytes()} | {x: a.tobytes() for x, a in zip(ARRAYS, arrays)}
            kinds = dict.fromkeys(("base", "n", "shift", "widest"), pa.int64()) | {"kinds": pa.list_(pa.string())}
            return pa.RecordBatch.from_pylist([row], schema=pa.schema([(k, kinds.get(k, pa.binary())) for k in row]))

        schema = "base long, n long, shift long, widest long, kinds array<string>, contexts binary, weights binary, " + ", ".join(f"{x} binary" for x in ARRAYS)
        sent = self.train.mapInArrow(send, "shard long, keys binary, n binary").repartition("shard")
        table = self.scratch.put(sent.mapInArrow(build, schema), name, compression="zstd")
        n, widest = table.agg(F.sum("n"), F.max("widest")).first()
        return Level(publish(table, self.scratch.path(name)), n_contexts, f"{self.tag}-{name}"), n or 0, widest or 1

    def fit(self) -> Model:
        words = self.vocabulary()
        size, total = self.spark.read.parquet(self.scratch.path("words")).agg(F.count("*"), F.sum("n")).first()
        shards = max(-(-(total or 0) // SHARD_TOKENS), LEAST_SHARDS)

        def starts(n: int, cut: np.ndarray) -> np.ndarray:
            follows = np.ones(n, dtype=bool)
            follows[cut[:-1]] = False
            return follows

        def pair_keys(h: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            ids = words.load().ids(h)
            at = np.flatnonzero(starts(len(ids), cut)[1:]) + 1
            return ids[at - 1] * size + ids[at], words.shard_of(ids[at - 1], None, shards)

        pairs, n_pairs, widest = self.level(pair_keys, max(size, 1), size, lambda c: words.load().counts[c], lambda c, w: np.log10(words.load().probability(w)), "pairs")
        half = Model(words, pairs, None, widest)

        def triple_keys(h: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            half.load()
            ids = words.ids(h)
            if not len(half.pairs.keys):
                return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
            follows = starts(len(ids), cut)
            at, keys = half.triple_keys(ids, half.pair_numbers(ids, follows), follows)
            return keys, words.shard_of(ids[at - 2], ids[at - 1], shards)

        def below(context: np.ndarray, rank: np.ndarray) -> np.ndarray:
            """log10 of the pair probability of a triple's last two words."""
            middle = pairs.load().key_of(context) % size
            return pairs.log(pairs.keys.lower_bound(middle * size)[0] + rank)

        triples, _, _ = self.level(triple_keys, widest, n_pairs, lambda c: pairs.load().count(c), below, "triples", last=True)
        return Model(words, pairs, triples, widest)


def score(docs: DataFrame, train: Column) -> DataFrame:
    """All of doc_id, n_tokens, n_known, train_tokens, base_score and score for every row; trained where ``train`` holds."""
    model = Trainer(docs, train).fit()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = rows.select("doc_id").schema.add("n_tokens", "long").add("n_known", "long").add("train_tokens", "long").add("base_score", "double").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch, texts in texts_in_steps(batches, chars=STEP_CHARS):
            model.load()
            h, cut = words(texts)
            ids, log = model.scores(h, cut)
            base = np.log10(model.words.probability(ids))
            first = cut[:-1]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(cut)), pa.array(np.add.reduceat((ids >= 0).astype(np.int64), first)),
                                              pa.array(np.full(len(texts), model.words.total, dtype=np.int64)), pa.array(np.add.reduceat(base, first)), pa.array(np.add.reduceat(log, first))], names=schema.names)

    return rows.mapInArrow(run, schema)
