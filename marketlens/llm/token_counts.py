"""Token counts by a compiled finite-state tokenizer.

The vocabulary is byte-pair encoding after a splitting pattern. Both parts are
run as deterministic transducers whose transitions carry counts:

* ``SPLIT``: 13 states over 11 letter classes. A transition says whether a new
  part starts at the current character, and whether one started at the one
  before (white space and contractions are only decided one character later).
* ``Merges``: inside a part, the state after a byte holds the longest suffix
  that still is a prefix of some token and, for that many positions back, the
  last token of the encoding that ends there. The next byte fixes the next last
  token, since exactly one token that ends there follows on from an encoding
  before it, so the number of tokens changes by a fixed amount on each
  transition. States and transitions are made when first met.

Long texts need no serial scan for the splitting: every chunk of CHUNK
characters is run from all 13 states at once, which gives its state map; the
maps compose associatively, and a parallel prefix scan over a text's chunks
gives each chunk's first state. A second run from that state emits the starts
of parts.

Defined results: a null text is empty and has no tokens. Rows are counted one
by one, so repeated rows get equal counts; an empty table gives none. Strings
of special tokens inside a text are one token each, as the library has it.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import texts_in_steps

CHUNK, SYNC = 256, 12
LIMIT = 1024
#: Letter classes. The small letters are those of the pattern's contractions 's 't 'm 'd 're 've 'll.
CLASSES = ("letter", "stmd", "r", "v", "l", "e", "number", "other", "quote", "blank", "space")
LETTER, STMD, R, V, ELL, E, NUMBER, OTHER, QUOTE, BLANK, SPACE = range(11)
STATES = ("start", "letters", "numbers", "others", "quote", "quote_r", "quote_v", "quote_l", "contracted", "blank", "space", "spaces_blank", "spaces")
START, LETTERS, NUMBERS, OTHERS, Q, QR, QV, QL, DONE, B1, S1, BN, SN = range(13)


def split_table() -> tuple[np.ndarray, np.ndarray]:
    """(next state, output) by [state, class]; output bit 0: a part starts here, bit 1: one started at the character before."""
    to, out = np.zeros((13, 11), dtype=np.uint8), np.zeros((13, 11), dtype=np.uint8)
    run = {NUMBER: NUMBERS, OTHER: OTHERS, QUOTE: Q, BLANK: B1, SPACE: S1}
    fresh = [run.get(c, LETTERS) for c in range(11)]  # the state after c as the first character of a part
    same = {LETTERS: {LETTER, STMD, R, V, ELL, E}, NUMBERS: {NUMBER}, OTHERS: {OTHER, QUOTE}}
    for s in range(13):
        for c in range(11):
            to[s, c], out[s, c] = fresh[c], 1
            if s in same and c in same[s]:
                to[s, c], out[s, c] = s, 0
            elif s in (B1, S1, BN, SN):
                late = 2 if s in (BN, SN) else 0  # the last white space of several stands apart, or joins what follows
                if c in (BLANK, SPACE):
                    to[s, c], out[s, c] = (BN if c == BLANK else SN), 0
                elif s in (B1, BN):
                    to[s, c], out[s, c] = (OTHERS if c == QUOTE else fresh[c]), late
                else:
                    out[s, c] = 1 | late
            elif s == Q:
                if c in (OTHER, QUOTE):
                    to[s, c], out[s, c] = OTHERS, 0
                elif c == STMD:
                    to[s, c], out[s, c] = DONE, 0
                elif c in (R, V, ELL):
                    to[s, c], out[s, c] = {R: QR, V: QV, ELL: QL}[c], 0
            elif (s, c) in ((QR, E), (QV, E), (QL, ELL)):
                to[s, c], out[s, c] = DONE, 0
            elif s in (QR, QV, QL):  # no contraction: the quote was a part, the letter began the next
                word = c in same[LETTERS]
                to[s, c], out[s, c] = (LETTERS, 2) if word else (fresh[c], 3)
    return to, out


@functools.cache
def classes() -> np.ndarray:
    """The letter class of each code point."""
    every = "".join(map(chr, range(0xD800))) + "퟿" * 0x800 + "".join(map(chr, range(0xE000, 0x110000)))
    table = np.full(0x110000, OTHER, dtype=np.uint8)
    for pattern, c in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", SPACE)):
        table[[m.start() for m in regex.finditer(pattern, every)]] = c
    table[0x1C:0x20] = OTHER  # no white space in the Unicode sense
    for letters, c in (("stmd", STMD), ("r", R), ("v", V), ("l", ELL), ("e", E), ("'", QUOTE), (" ", BLANK)):
        for ch in letters:
            table[ord(ch)] = c
    return table


def prefix_states(maps: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The state before each chunk, from the chunks' state maps [chunk, state]; ``first``: where a text's chunks begin.

    Inclusive scan by doubling: after round r each map covers up to 2^r chunks of its text.
    """
    n = len(maps)
    begin = np.repeat(first, np.diff(np.append(first, n)))
    index, step, maps = np.arange(n), 1, maps.copy()
    while True:
        at = np.flatnonzero(index - step >= begin)
        if not len(at):
            break
        maps[at] = np.take_along_axis(maps[at], maps[at - step], axis=1)
        step *= 2
    state = np.full(n, START, dtype=np.uint8)
    inner = index > begin
    state[inner] = maps[index[inner] - 1, START]
    return state


def code_points(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "replace"), dtype="<u4")


def part_starts(texts: list[str], points: np.ndarray) -> np.ndarray:
    """Where the parts of the texts start, counted through all texts; ``points``: their code points."""
    to, out = split_table()
    flat_to, flat_out = to.ravel(), out.ravel()
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    kind = classes()[points]
    chunks = (sizes + CHUNK - 1) // CHUNK
    first = np.cumsum(chunks) - chunks
    begin = np.cumsum(sizes) - sizes
    # one row a chunk; the unused end of a text's last chunk is never read back
    rows = np.repeat(np.arange(len(texts)), chunks)
    at = begin[rows] + (np.arange(len(rows)) - first[rows]) * CHUNK
    grid = np.append(kind, np.full(CHUNK, OTHER, dtype=np.uint8))[at[:, None] + np.arange(CHUNK)].T.copy()
    maps = np.tile(np.arange(13, dtype=np.uint8), (len(rows), 1))
    if chunks.max(initial=0) > 1:
        for c in grid[:SYNC]:
            maps = flat_to[maps * np.uint8(11) + c[:, None]]
        # almost everywhere all 13 runs have met by now; the others go on as 13
        apart = (maps != maps[:, :1]).any(axis=1)
        one, many = maps[:, 0].copy(), maps[apart]
        for c in grid[SYNC:]:
            one = flat_to[one * np.uint8(11) + c]
            if len(many):
                many = flat_to[many * np.uint8(11) + c[apart][:, None]]
        maps[:] = one[:, None]
        maps[apart] = many
    state = prefix_states(maps, first[chunks > 0]) if len(rows) else np.zeros(0, dtype=np.uint8)
    emitted = np.empty_like(grid)
    for j, c in enumerate(grid):
        edge = state * np.uint8(11) + c
        emitted[j], state = flat_out[edge], flat_to[edge]
    place = at[:, None] + np.arange(CHUNK)
    used = place < (begin + sizes)[rows][:, None]
    place, emitted = place[used], emitted.T[used]
    late = place[emitted & 2 > 0] - 1
    # a text that ends within what might have become a contraction: its quote is a part, and so is the letter
    ends = (begin + sizes - 1)[[t[-2:] in ("'r", "'v", "'l") for t in texts]]
    on = np.zeros(len(kind) + 1, dtype=bool)
    on[place[emitted & 1 > 0]] = on[late] = True
    on[ends[on[ends - 1]]] = True
    return np.flatnonzero(on)


class PartTable:
    """Counts of parts by a 64-bit hash of their characters, in an open-addressed array of bounded size.

    The hash is a polynomial over one random 64-bit number per code point, so all
    parts of a step are hashed and looked up by array operations. (With a million
    different parts the chance that any two share a hash is about 3 in 10^8.)
    """

    BITS = 21

    def __init__(self):
        rng = np.random.default_rng(20240229)
        self.value = rng.integers(1, 2 ** 63, 0x110000, dtype=np.uint64)
        self.r = np.uint64(0x9E3779B97F4A7C15)
        self.r_inverse = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2 ** 64))
        self.powers = self.inverses = np.ones(1, dtype=np.uint64)
        self.clear()

    def clear(self) -> None:
        self.keys, self.counts, self.size = np.zeros(1 << self.BITS, dtype=np.uint64), np.zeros(1 << self.BITS, dtype=np.int32), 0

    def hashes(self, points: np.ndarray, starts: np.ndarray) -> np.ndarray:
        n = len(points)
        if len(self.powers) <= n:
            size = max(n + 1, 1 << 20)
            one = np.ones(1, dtype=np.uint64)
            self.powers = np.cumprod(np.concatenate([one, np.full(size, self.r)]))
            self.inverses = np.cumprod(np.concatenate([one, np.full(size, self.r_inverse)]))
        total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(self.value[points] * self.powers[:n])])
        ends = np.append(starts[1:], n)
        h = (total[ends] - total[starts]) * self.inverses[starts]
        h ^= h >> np.uint64(32)
        h = h * np.uint64(0xD6E8FEB86659FD93) + (ends - starts).astype(np.uint64)
        h ^= h >> np.uint64(29)
        return np.maximum(h * np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(1))

    def find(self, h: np.ndarray) -> np.ndarray:
        """The counts, -1 where unknown."""
        out, at, todo = np.full(len(h), -1, dtype=np.int64), (h >> np.uint64(64 - self.BITS)).astype(np.int64), np.arange(len(h))
        while len(todo):
            key = self.keys[at]
            hit = key == h[todo]
            out[todo[hit]] = self.counts[at[hit]]
            on = ~hit & (key != 0)
            todo, at = todo[on], (at[on] + 1) & ((1 << self.BITS) - 1)
        return out

    def add(self, h: int, count: int) -> None:
        if self.size >= 1 << self.BITS - 1:
            self.clear()
        at = h >> 64 - self.BITS
        while self.keys[at]:
            at = at + 1 & (1 << self.BITS) - 1
        self.keys[at], self.counts[at], self.size = h, count, self.size + 1


class Merges:
    """Byte-pair encoding of one part as a transducer that counts tokens; made from ranked merges."""

    def __init__(self, tokens: dict[bytes, int], merges: dict[tuple[int, int], tuple[int, int]], byte_ids: list[int], state_limit: int = 300_000):
        self.tokens, self.merges, self.byte_ids, self.state_limit = tokens, merges, byte_ids, state_limit
        self.prefixes = {t[:i] for t in tokens for i in range(len(t))}
        self.follows: dict[tuple[bytes, bytes], bool] = {}
        self.whole: dict[bytes, bool] = {}
        self.start()

    def start(self) -> None:
        # a state: (suffix, for each position in it the last token that ends there (None: the part's start) and the count there less the newest count)
        self.states: list[tuple[bytes, tuple]] = [(b"", ((None, 0),))]
        self.number = {self.states[0]: 0}
        self.edges: dict[int, tuple[int, int]] = {}

    def encode(self, raw: bytes) -> list[int]:
        """Plain merging, lowest rank first; only asked about single tokens and pairs of tokens."""
        ids = [self.byte_ids[b] for b in raw]
        while len(ids) > 1:
            rank, i = min((self.merges.get(p, (1 << 60, 0))[0], i) for i, p in enumerate(zip(ids, ids[1:])))
            if rank == 1 << 60:
                break
            pair, made, out, i = (ids[i], ids[i + 1]), self.merges[ids[i], ids[i + 1]][1], [], 0
            while i < len(ids):
                if tuple(ids[i:i + 2]) == pair:
                    out.append(made)
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    def stands(self, raw: bytes) -> bool:
        """Whether a token's own bytes encode as that one token."""
        if raw not in self.whole:
            self.whole[raw] = self.encode(raw) == [self.tokens[raw]]
        return self.whole[raw]

    def may_follow(self, a: bytes, b: bytes) -> bool:
        """Whether two tokens side by side stay as they are."""
        if (a, b) not in self.follows:
            if len(self.follows) >= 500_000:
                self.follows.clear()
            self.follows[a, b] = self.encode(a + b) == [self.tokens[a], self.tokens[b]]
        return self.follows[a, b]

    def step(self, state: int, byte: int) -> tuple[int, int]:
        """(next state, change of the number of tokens)."""
        suffix, lasts = self.states[state]
        text = suffix + bytes([byte])
        for back in range(len(text)):
            token, (last, count) = text[back:], lasts[back]
            if token in self.tokens and self.stands(token) and (last is None or self.may_follow(last, token)):
                delta = count + 1
                break
        else:
            raise AssertionError("a byte that is no token")
        keep = next(k for k in range(len(text), -1, -1) if text[len(text) - k:] in self.prefixes)
        grown = [*lasts, (token, delta)][len(text) - keep:]
        new = (text[len(text) - keep:], tuple((t, n - delta) for t, n in grown))
        number = self.number.get(new)
        if number is None:
            number = self.number[new] = len(self.states)
            self.states.append(new)
        return number, delta

    def count(self, part: bytes) -> int:
        if len(self.states) > self.state_limit:
            self.start()
        state = total = 0
        for b in part:
            edge = self.edges.get(state << 8 | b)
            if edge is None:
                edge = self.edges[state << 8 | b] = self.step(state, b)
            state, delta = edge
            total += delta
        return total


@functools.cache
def counter(path: str) -> Counter:
    return Counter(path)


class Counter:
    """Token counts of whole texts for the vocabulary file of a byte-level tokenizer."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
        rest = [b for b in range(256) if b not in shown]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}
        vocabulary = {t: i for t, i in spec["model"]["vocab"].items() if all(ch in byte_of for ch in t)}
        tokens = {bytes(byte_of[ch] for ch in t): i for t, i in vocabulary.items()}
        special = [x["content"] for x in spec["added_tokens"]]
        for x in special:
            tokens.pop(x.encode(), None)
        merges = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            merges[vocabulary[a], vocabulary[b]] = (rank, vocabulary[a + b])
        self.merges = Merges(tokens, merges, [tokens[bytes([b])] for b in range(256)])
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.table = PartTable()

    def __call__(self, texts: list[str]) -> list[int]:
        counts, segments, owner = [0] * len(texts), [], []
        for i, t in enumerate(texts):
            pieces = self.special.split(t) if self.special else [t]
            counts[i] += len(pieces) - 1
            segments += pieces
            owner += [i] * len(pieces)
        points, sizes = code_points(segments), np.fromiter(map(len, segments), dtype=np.int64, count=len(segments))
        starts = part_starts(segments, points)
        if not len(starts):
            return counts
        h = self.table.hashes(points, starts)
        each = self.table.find(h)
        if (each < 0).any():
            unknown = np.flatnonzero(each < 0)
            new, at, back = np.unique(h[unknown], return_index=True, return_inverse=True)
            begins, ends = starts[unknown[at]].tolist(), np.append(starts[1:], len(points))[unknown[at]].tolist()
            made = [self.merges.count(points[a:b].tobytes().decode("utf-32-le").encode("utf-8", "replace")) for a, b in zip(begins, ends)]
            for key, n in zip(new.tolist(), made):
                self.table.add(key, n)
            each[unknown] = np.array(made, dtype=np.int64)[back]
        sums = np.concatenate([[0], np.cumsum(each)])
        edges = np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)]))
        for i, n in zip(owner, np.diff(sums[edges]).tolist()):
            counts[i] += n
        return counts


def vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of every row."""
    path = path or vocabulary()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = rows.select("doc_id").schema.add("n_bytes", "long").add("n_tokens", "long").add("over_limit", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in texts_in_steps(batches):
            n = counter(path)(texts)
            sizes = [len(t) if t.isascii() else len(t.encode("utf-8", "replace")) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], names=schema.names)

    return rows.mapInArrow(run, schema)
