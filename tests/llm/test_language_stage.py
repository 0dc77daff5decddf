"""What the language stage rejects: noise and languages that were not learned, and no document of a learned one."""

from __future__ import annotations

import random

import pyarrow as pa
from pyspark.sql import functions as F

from corpus_pipeline import STAGES
from marketlens.llm import lang_id
from marketlens.llm.common import hash_share
from tests.llm.fixtures import SF

HUNGARIAN = ("Magyarország közép-európai ország a Kárpát-medence közepén, ahol hosszú évszázadok óta élnek együtt különböző népek. "
             "A folyók mentén termékeny földek húzódnak, és a hegyek között régi várak őrzik a múlt emlékeit. ") * 3


def test_language_stage_rejects_noise_and_keeps_prose(spark):
    rng = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyz"
    noise = [" ".join("".join(rng.choice(letters) for _ in range(rng.randint(3, 9))) for _ in range(200)) for _ in range(60)]
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("text IS NOT NULL")
    bad = noise + [HUNGARIAN, "", "123 456", None]
    planted = spark.createDataFrame([(10**9 + i, t, None, "planted", len(t or "")) for i, t in enumerate(bad)], docs.schema)
    kept = STAGES[0][1](spark, docs.unionByName(planted), SF)
    assert kept.where("source = 'planted'").count() == 0
    real = docs.where(F.col("text").rlike("\\p{L}"))
    assert kept.count() == real.count() and kept.columns == docs.columns


def test_floor_follows_the_labelled_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    profiles = lang_id.learn(docs)
    floor = lang_id.score_floor(docs, profiles)
    low = lang_id.predicted(docs, profiles).where("lang = lang_pred").agg(F.min("score")).first()[0]
    assert lang_id.MIN_SCORE < floor <= low - lang_id.MARGIN + 0.02
    assert lang_id.score_floor(docs.limit(0), profiles) == lang_id.MIN_SCORE


def test_floor_is_read_from_every_labelled_text(spark):
    profiles = {"en": {lang_id.code_of(g): i for i, g in enumerate(["a", "_a", "a_", "_a_", "b", "_b", "b_", "_b_"])}}
    some = spark.createDataFrame([(f"a b {chr(97 + i)}",) for i in range(2, 26)], "text string")
    lower = some.where(~hash_share("text", 0.5)).orderBy("text").first()[0]  # a half drawn by hash would miss it
    texts = ["a b a"] * 9_975 + [lower] * 25
    docs = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string")
    high, low = lang_id.Judge(profiles)([texts[0], lower])[1]
    assert high - 0.1 > low > lang_id.MIN_SCORE + lang_id.MARGIN
    assert lang_id.score_floor(docs, profiles) == low - lang_id.MARGIN


def test_hash_share_is_never_empty_by_rounding(spark):
    ids = spark.range(200_000)
    assert abs(ids.where(hash_share("id", 0.01)).count() - 2000) < 300
    # 20,000 of 10^12 rows: a share below one millionth still has a threshold above 0
    assert int(2e-8 * (1 << 63)) > 0
    assert ids.where(hash_share("id", 1 - 1e-16)).count() == 200_000


def test_stages_hand_out_texts_in_small_batches(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        docs = spark.createDataFrame([(i, "an ordinary text of some words " * 60, "en") for i in range(4_000)], "doc_id long, text string, lang string").coalesce(1)
        for name, stage in STAGES:
            spark.conf.unset(key)
            stage(spark, docs.limit(3), SF)
            sizes = [r["n"] for r in docs.select("text").mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"]) for b in batches), "n long").collect()]
            assert max(sizes) < 5 << 20 and sum(sizes) > 7 << 20, name
    finally:
        spark.conf.set(key, before)
