"""SentencePiece encoding and decoding for merge-type vocabularies.

A text's characters start as symbols. An agenda (a heap ordered by score, ties
to the left) holds the adjacent pairs that are a piece; the best pair is merged
and its new neighbours enter, until the agenda is empty. What is no piece at
the end becomes one piece per UTF-8 byte.

Two neighbouring characters can only be merged if they stand side by side in
some piece. The vocabulary shows where that never happens (before a space mark,
around line ends, between a letter and most marks), so a text falls into units
that are encoded and decoded once each and kept in a bounded memo with their
ids and the bytes these decode to; a text's decoding is made of those bytes.
Every unit that enters the memo is checked against the sentencepiece library,
ids and decoding, all new units of an Arrow batch in one call each; ``whole=True`` also checks every whole text.
Should the library differ on a unit, its answer is taken, the texts of the step are made again and a warning is given.

Defined results: a null text is empty, with no ids and an empty decoding. Rows
are encoded one by one, so repeated rows get equal results; an empty table gives none.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import re
import warnings
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from marketlens.llm.common import Memo, texts_in_steps

MARK = "▁"  # how pieces write a space
LETTER = "[A-Za-zÀ-ÖØ-öø-ɏ]"


class Codec:
    """Ids of texts, and texts of ids, for one model file."""

    def __init__(self, path: str, limit: int = 400_000):
        import sentencepiece
        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        n = lib.get_piece_size()
        self.pieces = [lib.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i))]
        self.id_of = {self.pieces[i]: i for i in plain}
        self.score = {self.pieces[i]: lib.get_score(i) for i in plain}
        self.byte_id = {int(self.pieces[i][3:5], 16): i for i in range(n) if lib.is_byte(i)}
        if len(self.byte_id) != 256:
            raise ValueError("the vocabulary must have a piece for each byte")
        self.raw = [bytes([int(p[3:5], 16)]) if lib.is_byte(i) else b"" if lib.is_control(i) else p.replace(MARK, " ").encode() for i, p in enumerate(self.pieces)]
        self.units = self._unit_pattern()
        self.memo = Memo(self.of_unit, limit)  # units
        self.words = Memo(self.of_word, limit)  # what stands between single spaces
        self.unchecked: list[tuple[str, list[int]]] = []
        self.settled: dict[str, tuple[str, bytes]] = {}  # units on which the library differs, in its way

    def _unit_pattern(self) -> re.Pattern:
        """Cuts texts only between characters that no piece has side by side."""
        pairs = {p[i:i + 2] for p in self.id_of for i in range(len(p) - 1)}
        if any(x[1] == MARK and x[0] != MARK for x in pairs):
            raise ValueError("pieces with a space after another character are not supported")
        alone = "\n" if not any("\n" in x for x in pairs) else ""
        marks = "".join(c for c in ".,;:!?|&*$%#()\"" if not any(x[1] == c and re.fullmatch(LETTER, x[0]) for x in pairs))
        general = f"{MARK}+[^{MARK}{alone}]*|[^{MARK}{alone}]+"
        words = f"{MARK}*{LETTER}+(?=[{re.escape(marks)}])|" if marks else ""
        return re.compile(f"{words}{alone + '|' if alone else ''}{general}")

    def encode_unit(self, unit: str) -> list[int]:
        """Ids of one unit by the agenda."""
        symbols, score = list(unit), self.score.get
        n = len(symbols)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda = [(-s, i, i + 1, made) for i in range(n - 1) if (s := score(made := symbols[i] + symbols[i + 1])) is not None]
        heapq.heapify(agenda)
        while agenda:
            _, i, j, made = heapq.heappop(agenda)
            if right[i] != j or symbols[i] + symbols[j] != made:
                continue  # one of the two has been merged meanwhile
            symbols[i], symbols[j] = made, ""
            before, after = left[i], right[j]
            right[i], right[j] = after, -2
            if after >= 0:
                left[after] = i
                new = made + symbols[after]
                s = score(new)
                if s is not None:
                    heapq.heappush(agenda, (-s, i, after, new))
            if before >= 0:
                new = symbols[before] + made
                s = score(new)
                if s is not None:
                    heapq.heappush(agenda, (-s, before, i, new))
        out: list[int] = []
        for s in filter(None, symbols):
            known = self.id_of.get(s)
            out += [known] if known is not None else [self.byte_id[b] for b in s.encode("utf-8", "replace")]
        return out

    def of_unit(self, unit: str) -> tuple[str, bytes]:
        """The decimal ids of a unit, joined by commas, and the bytes that the ids decode to."""
        if unit in self.settled:
            return self.settled[unit]
        ids = self.encode_unit(unit)
        self.unchecked.append((unit, ids))
        return ",".join(map(str, ids)), b"".join(map(self.raw.__getitem__, ids))

    def of_word(self, word: str) -> tuple[str, bytes]:
        return self.joined(map(self.memo.__getitem__, self.units.findall(MARK + word)))

    @staticmethod
    def joined(parts: Iterable[tuple[str, bytes]]) -> tuple[str, bytes]:
        ids, raw = zip(*parts)
        return ",".join(ids), b"".join(raw)

    def coded(self, text: str) -> tuple[str, bytes]:
        """The decimal ids of a text, joined by commas, and the bytes that the ids decode to."""
        if not text:
            return "", b""
        if MARK in text or "  " in text or text[0] == " " or text[-1] == " ":
            return self.joined(map(self.memo.__getitem__, self.split(text)))
        return self.joined(map(self.words.__getitem__, text.split(" ")))

    def decode_raw(self, ids: list[int]) -> str:
        return b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")

    def decode(self, ids: list[int]) -> str:
        text = self.decode_raw(ids)
        return text[1:] if text.startswith(" ") else text

    def split(self, text: str) -> list[str]:
        return self.units.findall(MARK + text.replace(" ", MARK)) if text else []

    def encode(self, text: str) -> list[int]:
        return [int(i) for i in self.coded(text)[0].split(",")] if text else []

    def digest(self, text: str) -> tuple[int, str, str]:
        """(number of ids, sha256 of the decimal ids joined by commas, sha256 of the text that the ids decode to)."""
        ids, raw = self.coded(text)
        shown = raw.removeprefix(b" ").decode("utf-8", "replace").encode()  # without the space that stands for the mark before each text
        return ids.count(",") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(shown).hexdigest()

    def differing(self) -> Iterator[tuple[str, str, list[int], str]]:
        """(unit, "encodes" or "decodes", the library's ids, their decoding) of units made since the last call on which the library differs."""
        if self.unchecked:
            units, own = zip(*self.unchecked)
            self.unchecked = []
            # the library puts a mark before each text: a unit with one goes in without it, others after a line end
            theirs = self.library.encode([u[1:] if u[0] == MARK else "\n" + u for u in units], num_threads=1)
            lead = self.library.encode("\n")
            for unit, mine, found, shown in zip(units, own, theirs, self.library.decode(list(own))):
                ids = found if unit[0] == MARK and len(unit) > 1 else [self.id_of[MARK]] if unit == MARK else found[len(lead):]
                if mine != ids:
                    yield unit, "encodes", ids, self.library.decode(ids)
                elif shown != self.decode(mine):
                    yield unit, "decodes", ids, shown

    def check_units(self) -> None:
        """Raises if the library differs on a unit made since the last call."""
        for unit, how, _, _ in self.differing():
            raise AssertionError(f"the library {how} {unit!r} in another way")

    def settle_units(self) -> int:
        """Takes the library's answer for units on which it differs; how many there were. What was made with them must be made again."""
        n = 0
        for unit, how, ids, shown in self.differing():
            warnings.warn(f"the library {how} {unit!r} in another way; its answer is used")
            self.settled[unit] = ",".join(map(str, ids)), b" " * unit.startswith(MARK) + shown.encode()
            n += 1
        if n:
            for memo in (self.memo, self.words):
                memo.clear()
                memo.old = {}
        return n

    def in_step(self, make: Callable, texts: list[str]) -> list:
        """``make`` of each text, after all units in them are settled."""
        while True:
            out = [make(t) for t in texts]
            if not self.settle_units():
                return out

    def check_texts(self, texts: list[str]) -> None:
        for text, ids in zip(texts, self.library.encode(texts, num_threads=1)):
            if ids != self.encode(text) or self.library.decode(ids) != self.decode(ids):
                raise AssertionError(f"the library encodes a text in another way: {text[:80]!r}")


@functools.cache
def codec(path: str) -> Codec:
    return Codec(path)


def vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def encode_digests(docs: DataFrame, path: str | None = None, whole: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row."""
    path = path or vocabulary()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = rows.select("doc_id").schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch, texts in texts_in_steps(batches):
            found = own.in_step(own.digest, texts)
            if whole:
                own.check_texts(texts)
            n, ids, decoded = zip(*found)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], names=schema.names)

    return rows.mapInArrow(run, schema)


def encode_ids(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and the ids of every row as an array."""
    path = path or vocabulary()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = rows.select("doc_id").schema.add("ids", ArrayType(IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch, texts in texts_in_steps(batches):
            ids = own.in_step(own.encode, texts)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], names=schema.names)

    return rows.mapInArrow(run, schema)
