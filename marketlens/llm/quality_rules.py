"""Weak supervision of quality rules.

Each rule votes *bad* (-1), *good* (+1) or abstains (0) on a document. Rules
are not all-must-pass filters: expectation-maximisation over the vote patterns
of all documents estimates, for each rule, how it votes on good and on bad
documents, and the posterior probability of *good* decides. Strict rules have
doubtful companions (fewer than 100 words, any copied line, some capitals): EM
finds that these fire alone on documents that all others like, so a lone vote of theirs is
overruled, while votes that rules cast together count. Documents enter
EM only as counts per vote pattern (at most 3^rules patterns, whatever the
number of documents), aggregated by Spark; the EM itself is a few matrix
products over that bounded table.

Defined results: a null or empty text has no words and fails the base check.
Rows are judged one by one, so repeated rows get equal verdicts. An empty
table gives an empty result. Extra columns are ignored by ``score_quality``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketlens.llm.common import SPACES, Scratch, texts_in_steps

SYMBOLS = b"#*$%&|<>"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_lines", "n_letters", "n_upper", "n_marks", "n_wordlike"]
MIN_WORDS, MAX_REPEAT_PCT = 50, 50
KEEP_AT = 0.5
#: Where EM starts: shares of bad, no and good votes on bad documents, then on good ones; shares of the two classes.
BEFORE = np.array([[0.35, 0.25, 0.40], [0.03, 0.17, 0.80]])
MASS = np.array([0.2, 0.8])


def measure(text: str) -> tuple[int, ...]:
    """The counts of BASE and MORE for one text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n_spaces = len(raw) - len(raw.translate(None, SPACES))
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        found, covered_to = Counter(windows), 0
        for i, w in enumerate(windows):
            if found[w] > 1:
                repeated += i + 3 - max(covered_to, i)
                covered_to = i + 3
    lines = [x for x in raw.split(b"\n") if x.strip()]
    upper = sum(map(str.isupper, text)) if not text.isascii() else len(raw) - len(raw.translate(None, _UPPER))
    letters = sum(map(str.isalpha, text)) if not text.isascii() else len(raw) - len(raw.translate(None, _LETTERS))
    marks = raw.count(b"!") + raw.count(b"?")
    bare = raw.translate(None, SYMBOLS + b"!?.,;:\"'()[]{}-_=+/\\~^`@0123456789").split()
    return (len(words), len(text) - n_spaces, len(raw) - len(raw.translate(None, SYMBOLS)), len(lines) - len(set(lines)),
            repeated, len(lines), letters, upper, marks, len(bare))


_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123))


def with_measures(docs: DataFrame, text_col: str = "text", prefix: str = "") -> DataFrame:
    """All columns of ``docs`` plus the counts (named with ``prefix``), in one Arrow pass."""
    schema = StructType(list(docs.schema.fields))
    for name in BASE + MORE:
        schema = schema.add(prefix + name, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in texts_in_steps(batches, text_col):
            counts = np.array([measure(t) for t in texts], dtype=np.int64).reshape(-1, len(BASE + MORE))
            arrays = [*rows.columns, *(pa.array(np.ascontiguousarray(counts[:, j])) for j in range(counts.shape[1]))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*rows.schema.names, *(prefix + x for x in BASE + MORE)])

    return docs.mapInArrow(run, schema)


def base_failed(prefix: str = "") -> Column:
    words, repeat = F.col(prefix + "n_words"), F.col(prefix + "n_repeat_words")
    return (words < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PCT * words)


def rules(prefix: str = "") -> list[tuple[str, Column]]:
    """(name, vote) of each rule; votes are -1 bad, 0 abstain, 1 good."""
    c = {x: F.col(prefix + x).cast("double") for x in BASE + MORE}
    words, letters, lines = F.greatest(c["n_words"], F.lit(1.0)), F.greatest(c["n_letters"], F.lit(1.0)), F.greatest(c["n_lines"], F.lit(1.0))

    def vote(bad: Column, good: Column) -> Column:
        return F.when(bad, -1).when(good, 1).otherwise(0)

    symbols, upper, marks = c["n_symbols"] / words, c["n_upper"] / letters, c["n_marks"] / words
    repeats, dup, mean = c["n_repeat_words"] / words, c["n_dup_lines"] / lines, c["word_chars"] / words
    wordlike = c["n_wordlike"] / words
    never = F.lit(False)
    return [
        ("length", vote(c["n_words"] < MIN_WORDS, c["n_words"] >= MIN_WORDS)),
        ("brevity", vote(c["n_words"] < 2 * MIN_WORDS, c["n_words"] >= 4 * MIN_WORDS)),
        ("symbols", vote(symbols > 0.15, symbols < 0.02)),
        ("any_symbol", vote(symbols > 0.02, never)),
        ("capitals", vote(upper > 0.35, upper < 0.12)),
        ("some_capitals", vote(upper > 0.05, never)),
        ("shouting", vote(marks > 0.12, marks < 0.02)),
        ("repetition", vote(repeats > 0.5, repeats < 0.1)),
        ("some_repetition", vote(repeats > 0.3, never)),
        ("copied_lines", vote((dup > 0.3) & (c["n_dup_lines"] >= 3), c["n_dup_lines"] == 0)),
        ("any_copy", vote(c["n_dup_lines"] >= 1, never)),
        ("word_size", vote((mean > 6.6) | (mean < 3.6), (mean > 4.2) & (mean < 6))),
        ("word_share", vote(wordlike < 0.7, wordlike > 0.95)),
    ]


def pattern(prefix: str = "") -> Column:
    """The votes as one number, three values a rule."""
    out = F.lit(0)
    for _, v in rules(prefix):
        out = out * 3 + (v + 1)
    return out.cast("long")


def fit(counts: list[tuple[int, int]], n_rules: int, rounds: int = 100, prior: float = 20.0) -> tuple[dict[int, float], np.ndarray]:
    """(posterior of good by pattern, shares of votes [class, rule, vote]) by EM over counts per pattern.

    Every rule starts with the shares of BEFORE, so that no rule decides alone and one bad vote among good
    ones is outvoted; from there on a rule is worth what its agreement with the others says. ``prior``
    pseudo-documents per class with those shares keep the two classes from swapping.
    """
    table = np.repeat(BEFORE[:, None, :], n_rules, axis=1)
    if not counts:
        return {}, table
    codes, weight = np.array([c for c, _ in counts], dtype=np.int64), np.array([n for _, n in counts], dtype=float)
    order = np.argsort(codes)
    codes, weight = codes[order], weight[order]
    onehot = np.eye(3)[(codes[:, None] // 3 ** np.arange(n_rules - 1, -1, -1)) % 3]
    lean, mass, good = table * prior, MASS, None
    for _ in range(rounds):
        loglik = np.einsum("prv,crv->cp", onehot, np.log(table)) + np.log(mass)[:, None]
        updated = 1 / (1 + np.exp(np.clip(loglik[0] - loglik[1], -500, 500)))
        if good is not None and np.abs(updated - good).max() < 1e-9:
            break
        good = updated
        share = np.stack([(1 - good) * weight, good * weight])
        table = np.einsum("cp,prv->crv", share, onehot) + lean
        table /= table.sum(axis=2, keepdims=True)
        mass = (share.sum(axis=1) + 2) / (weight.sum() + 4)
    return dict(zip(codes.tolist(), good.tolist())), table


def judged(docs: DataFrame, text_col: str = "text", prefix: str = "", keep_text: bool = True) -> DataFrame:
    """All columns of ``docs`` plus the counts, ``quality_prob``, ``base_failed`` and ``kept`` (named with ``prefix``).

    Without ``keep_text`` the text is left out, and then only counts are stored between the two passes.
    """
    spark = docs.sparkSession
    seen = with_measures(docs, text_col, prefix).withColumn(prefix + "pattern", pattern(prefix))
    if not keep_text:
        seen = seen.drop(text_col)
    seen = Scratch(spark, "quality").put(seen, "measures")
    histogram = [(r[0], r[1]) for r in seen.groupBy(prefix + "pattern").count().collect()]  # at most 3^rules rows
    posterior, _ = fit(histogram, len(rules()))
    verdicts = spark.createDataFrame([(k, v) for k, v in posterior.items()], f"`{prefix}pattern` long, `{prefix}quality_prob` double")
    failed = base_failed(prefix)
    return (seen.join(F.broadcast(verdicts), prefix + "pattern", "left")  # as small as the histogram
            .withColumn(prefix + "base_failed", failed)
            .withColumn(prefix + "kept", ~failed & (F.col(prefix + "quality_prob") >= KEEP_AT)))


def score_quality(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, base counts, base_failed, quality_prob, kept."""
    return judged(docs.select("doc_id", "text").withColumn("text", F.col("text").cast("string")), keep_text=False).select(
        "doc_id", *BASE, "base_failed", "kept", "quality_prob")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their own columns only."""
    return judged(docs, prefix="_llm_q_").where("_llm_q_kept").select(*[F.col(f"`{c}`") for c in docs.columns])
