"""Small tables for the operators: odd rows, random prose, and readers of the generated data."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, kept int, score string"
WORDS = "the of and river stone house morning light walks slowly over green hills while birds sing about summer rain 12 x's don't Éa über niño".split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ",", ".", "\n"]) for _ in range(n))


def odd_texts() -> list[str | None]:
    rng = random.Random(4)
    long = prose(rng, 30_000)
    return [None, "", " ", "\n\n", "a", "a b c", "日本語 ñ é à", "the the the the the the the", "x" * 5000, long, long, prose(rng, 300),
            "same text twice here now", "same text twice here now", "\x1c\x85 odd\x0bspaces\x0chere　too ", "<|endoftext|> x", "▁ ▁▁ <s> </s>", "1234567890 " * 30]


def documents(spark: SparkSession, texts: list[str | None], langs: list[str | None] | None = None) -> DataFrame:
    """Rows with extra columns whose names clash with what the operators compute."""
    langs = langs or [None] * len(texts)
    rows = [(i, t, lang, "s", None if t is None else len(t), "extra", 7, "z") for i, (t, lang) in enumerate(zip(texts, langs))]
    return spark.createDataFrame(rows, SCHEMA)


def sf_texts() -> dict[int, str]:
    import pyarrow.parquet as pq
    t = pq.read_table(f"{SF}/documents.parquet").to_pydict()
    return dict(zip(t["doc_id"], t["text"]))


def by_id(df: DataFrame) -> dict:
    return {r["doc_id"]: r.asDict() for r in df.collect()}
