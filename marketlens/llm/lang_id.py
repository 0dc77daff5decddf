"""Language identification by rank-order n-gram profiles.

A profile is the list of a text's most frequent letter n-grams (1 to 3 letters,
words padded with _), best first. A document gets the language whose profile
has the smallest out-of-place distance: the sum, over the document's n-grams,
of how far each one's rank is from its rank in the language profile, with the
largest rank difference for n-grams the profile lacks.

Learning counts n-grams of all labelled documents: each task sums its own
documents per language, Spark adds the sums per (language, n-gram), and the
best PROFILE_SIZE of each language come to the driver (a bounded table).

Defined results: a null text, or one without a letter, is ``und`` with score 0;
ties between n-grams go to the smaller n-gram number, ties between languages to the
smaller name; with nothing learned every text is ``und``. Rows are judged one
by one, so repeated rows get equal answers.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketlens.llm.common import texts_in_steps

PROFILE_SIZE = 300
UNKNOWN = "und"
#: A text resembles no learned language if its score is MARGIN below what all but one in a thousand labelled texts
#: reach; below MIN_SCORE it never does.
MIN_SCORE, MARGIN = 0.2, 0.15
#: The edge of a word, and what fills up n-grams of fewer than three letters.
EDGE, FILL, BASE = 0, 0x110000, 0x110001
#: Characters whose n-grams are counted at a time; their arrays take some 90 bytes a character.
GRAM_CHARS = 400_000


@functools.cache
def _letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def code_of(gram: str) -> int:
    """The number of an n-gram of one to three letters (_ is the edge of a word)."""
    a, b, c = [FILL] * (3 - len(gram)) + [EDGE if ch == "_" else ord(ch) for ch in gram]
    return (a * BASE + b) * BASE + c


def gram_counts(texts: list[str], owner: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, n-gram number, count) sorted by owner, where ``owner`` is a rising number per text or group of texts.

    All texts are one array of letters with one 0 between words and texts, so
    all n-grams are a few array operations and one sort.
    """
    low = [t.lower() for t in texts]
    points = np.frombuffer("\0".join([*low, ""]).encode("utf-32-le", "replace"), dtype="<u4")
    whose, of = np.unique(owner, return_inverse=True)
    of = np.repeat(of, [len(t) + 1 for t in low])
    letter = _letters()[points]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    z = np.concatenate([[EDGE], np.where(letter, points, EDGE)[keep]])
    of = np.concatenate([of[:1], of[keep]])
    there = np.zeros(FILL + 1, dtype=bool)
    there[z] = there[EDGE] = there[FILL] = True
    alphabet = np.flatnonzero(there)  # EDGE becomes 0, FILL the last
    k, z = len(alphabet), (np.cumsum(there) - 1)[z]
    if k ** 3 * len(whose) >= 2 ** 62 and len(texts) > 1:
        h = len(texts) // 2
        return tuple(np.concatenate(x) for x in zip(gram_counts(texts[:h], owner[:h]), gram_counts(texts[h:], owner[h:])))
    of = of * k ** 3
    fill, inside = (k - 1) * (k * k + k), z > 0
    # n-grams belong to the text of their last letter, or of the edge after it
    single = (of + fill + z)[inside]
    pair = (of[1:] + (k - 1) * k * k + z[:-1] * k + z[1:])[inside[:-1] | inside[1:]]
    triple = (of[2:] + (z[:-2] * k + z[1:-1]) * k + z[2:])[inside[1:-1]]
    key = np.sort(np.concatenate([single, pair, triple]))
    at = np.flatnonzero(np.concatenate([np.ones(min(len(key), 1), dtype=bool), key[1:] != key[:-1]]))
    who, gram = np.divmod(key[at], k ** 3)
    code = (alphabet[gram // k ** 2] * BASE + alphabet[gram // k % k]) * BASE + alphabet[gram % k]
    return whose[who], code, np.diff(np.append(at, len(key)))


def profile_of(who: np.ndarray, code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, n-gram number, rank from 0) of each owner's PROFILE_SIZE most frequent n-grams, ties to the smaller number."""
    top, size = int(n.max(initial=0)), len(n)
    if len(n) and (int(who.max()) + 1) * (top + 1) * size < 2 ** 62:  # one sort of packed numbers; codes rise within an owner
        order = np.sort((who * (top + 1) + (top - n)) * size + np.arange(size)) % size
    else:
        order = np.lexsort((code, -n, who))
    who, code = who[order], code[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(len(who), 1), dtype=bool), who[1:] != who[:-1]]))
    rank = np.arange(len(who)) - np.repeat(first, np.diff(np.append(first, len(who))))
    best = rank < PROFILE_SIZE
    return who[best], code[best], rank[best]


def learn(docs: DataFrame, label_col: str = "lang") -> dict[str, dict[int, int]]:
    """{language: {code of an n-gram: rank from 0}} from rows with a label and a text."""
    rows = docs.where(F.col(label_col).isNotNull() & F.col("text").isNotNull()).select(
        F.col(label_col).cast("string").alias("lang"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in texts_in_steps(batches, chars=GRAM_CHARS):
            by_lang: dict[str, list[str]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), texts):
                by_lang.setdefault(lang, []).append(text)
            for lang, own in by_lang.items():
                _, code, n = gram_counts(own, [0] * len(own))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(code), pa.string()), pa.array(code, pa.int64()), pa.array(n, pa.int64())], names=["lang", "gram", "n"])

    counts = rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # The rank filter makes Spark keep PROFILE_SIZE rows a language in each task before the shuffle.
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), F.col("gram")))
    best = counts.withColumn("rank", rank).where(F.col("rank") <= PROFILE_SIZE)
    out: dict[str, dict[int, int]] = {}
    for lang, gram, r in best.select("lang", "gram", "rank").collect():
        out.setdefault(lang, {})[gram] = r - 1
    return out


class Judge:
    """Out-of-place distances to all profiles at once: one row of ranks per n-gram, one column per language."""

    def __init__(self, profiles: dict[str, dict[int, int]]):
        self.langs = sorted(profiles)
        self.known = np.array(sorted({g for p in profiles.values() for g in p}), dtype=np.int64)
        self.ranks = np.array([[profiles[x].get(g, -1) for x in self.langs] for g in self.known.tolist()], dtype=np.int32).reshape(len(self.known), len(self.langs))
        self.ranks = np.vstack([self.ranks, np.full((1, len(self.langs)), -1, dtype=np.int32)])  # the last row: unknown n-grams

    def __call__(self, texts: list[str]) -> tuple[list[str], list[float]]:
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.langs or not texts:
            return langs, scores
        who, code, place = profile_of(*gram_counts(texts, list(range(len(texts)))))
        if not len(who):
            return langs, scores
        row = np.searchsorted(self.known, code)
        row[(row == len(self.known)) | (np.append(self.known, -1)[row] != code)] = len(self.known)
        theirs = self.ranks[row]
        apart = np.where(theirs < 0, PROFILE_SIZE, np.abs(theirs - place[:, None]))
        first = np.flatnonzero(place == 0)
        total, size = np.add.reduceat(apart, first, axis=0), np.diff(np.append(first, len(who)))
        for i, best, far, n in zip(who[first].tolist(), total.argmin(axis=1).tolist(), total.min(axis=1).tolist(), size.tolist()):
            langs[i], scores[i] = self.langs[best], 1.0 - far / (PROFILE_SIZE * n)
        return langs, scores


def predicted(docs: DataFrame, profiles: dict[str, dict[int, int]], text_col: str = "text", prefix: str = "") -> DataFrame:
    """All columns of ``docs`` plus ``lang_pred`` and ``score`` (named with ``prefix``). Only the text is looked at.

    The profiles go with the task code: PROFILE_SIZE short strings a language.
    """
    schema = StructType(list(docs.schema.fields)).add(prefix + "lang_pred", "string").add(prefix + "score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(profiles)
        for rows, texts in texts_in_steps(batches, text_col, GRAM_CHARS):
            langs, scores = judge(texts)
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=schema.names)

    return docs.mapInArrow(run, schema)


def identify(docs: DataFrame, train: Column, label_col: str = "lang") -> DataFrame:
    """doc_id, lang_pred, score of every row; learned from the rows where ``train`` holds."""
    profiles = learn(docs.where(train), label_col)
    return predicted(docs.select("doc_id", F.col("text").cast("string").alias("text")), profiles).drop("text")


def score_floor(docs: DataFrame, profiles: dict[str, dict[int, int]], label_col: str = "lang") -> float:
    """The score from which a text counts as written in a learned language, from the scores of all labelled texts.

    The quantile's rank is right to a hundredth of the thousandth; up to 100,000 scores it is exact.
    """
    known = docs.where(F.col(label_col).isNotNull() & F.col("text").isNotNull()).select(F.col(label_col).cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    judged = predicted(known, profiles).where("lang = lang_pred")
    low = judged.agg(F.percentile_approx("score", 0.001, 100_000)).first()[0]
    return MIN_SCORE if low is None else max(MIN_SCORE, low - MARGIN)


def keep_recognised(docs: DataFrame, label_col: str = "lang", min_score: float | None = None) -> DataFrame:
    """The rows of ``docs`` whose text resembles a learned language, with their own columns only.

    Learns from all rows with a label, and from them the score to reach (``score_floor``) if none
    is given; where there is no label, every text with a letter stays.
    """
    profiles = learn(docs, label_col)
    if not profiles:
        return docs.where(F.col("text").rlike("\\p{L}"))
    least = score_floor(docs, profiles, label_col) if min_score is None else min_score
    judged = predicted(docs, profiles, prefix="_llm_l_")
    return judged.where((F.col("_llm_l_lang_pred") != UNKNOWN) & (F.col("_llm_l_score") >= least)).select(*[F.col(f"`{c}`") for c in docs.columns])
