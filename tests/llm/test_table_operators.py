"""Packing, neighbours, n-gram model, personal data, near duplicates and the pipeline against plain versions."""

from __future__ import annotations

import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marketlens.llm import elias_fano, jaccard_join, ngram_lm, packing, pii, queries, rp_forest
from tests.llm.fixtures import SF, by_id, documents, odd_texts, prose, sf_texts


@pytest.fixture(scope="module")
def odd(spark):
    return documents(spark, odd_texts()).cache()


# Packing ------------------------------------------------------------------------------------------------
def library_ids(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(packing.vocabulary())
    t.no_truncation()
    t.no_padding()
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def check_packing(rows, texts: dict[int, str], capacity: int) -> int:
    """Every id in one piece, sequences gapless and within the capacity; the number of sequences."""
    ids = {i: x + [1] for i, x in zip(texts, library_ids([t or "" for t in texts.values()]))}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        part = np.array(ids[r["doc_id"]][r["start"]:r["start"] + r["length"]], dtype="<u4").tobytes()
        assert r["ids_crc32"] == zlib.crc32(part) and r["doc_tokens"] == len(ids[r["doc_id"]])
    assert set(pieces) == set(ids)
    for i, own in pieces.items():
        at = 0
        for start, length in sorted(own):
            assert start == at and length > 0
            at += length
        assert at == len(ids[i])
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_packing_of_odd_texts(spark, odd):
    texts = dict(enumerate(odd_texts()))
    check_packing(packing.pack(odd).collect(), texts, packing.CAPACITY)
    check_packing(packing.pack(odd, capacity=64).collect(), texts, 64)


def test_packing_query_has_little_padding(spark):
    texts = sf_texts()
    n = check_packing(queries.op1_pack_min_slack(spark, SF).collect(), texts, 2048)
    total = sum(len(x) + 1 for x in library_ids(list(texts.values())))
    assert n <= -(-total // 2048) + 2


def test_fill_is_the_closest_subset_sum():
    rng = random.Random(3)
    for _ in range(300):
        sizes = sorted(rng.sample(range(1, 30), rng.randint(1, 6)), reverse=True)
        counts = [rng.randint(1, 4) for _ in sizes]
        capacity = rng.randint(1, 60)
        sums = {0}
        for s, c in zip(sizes, counts):
            sums = {a + s * k for a in sums for k in range(c + 1) if a + s * k <= capacity}
        got = packing.fill(capacity, sizes, counts)
        assert sum(s * k for s, k in got) == max(sums)
        assert all(0 < k <= counts[sizes.index(s)] for s, k in got)


def test_plan_uses_every_piece_once():
    rng = random.Random(5)
    histogram = {rng.randint(1, 100): rng.randint(1, 1000) for _ in range(40)}
    used = Counter()
    for repeats, pattern in packing.plan(histogram, 100):
        assert sum(x * n for x, n in pattern) <= 100
        used.update({x: n * repeats for x, n in pattern})
    assert used == histogram
    places = packing.Places(packing.plan(histogram, 100))
    spots = {(places(x, r)[0], o) for x, n in histogram.items() for r in range(n) for o in range(places(x, r)[1], places(x, r)[1] + x)}
    assert len(spots) == sum(x * n for x, n in histogram.items())


# Neighbours ---------------------------------------------------------------------------------------------
def plain_neighbours(vectors: dict[int, list[float]], ask, k: int = 5):
    x = {i: np.array(v, dtype=np.float64) for i, v in vectors.items()}
    out = {}
    for q in x:
        if ask(q):
            far = sorted((-float(x[q] @ x[i] / (np.linalg.norm(x[q]) * np.linalg.norm(x[i]))), i) for i in x if i != q)
            out[q] = far[:k]
    return out


def found_neighbours(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out[r["query_id"]].append((r["vec_id"], r["score"], r["rank"]))
    return out


def test_neighbours_of_copies_ties_and_unusable_vectors(spark):
    rng = np.random.default_rng(1)
    good = {i: rng.normal(size=4).astype(np.float32).tolist() for i in range(60)}
    good |= {i: [1.0, 2.0, 0.0, 0.5] for i in range(60, 100)}  # one vector forty times
    bad = {200: None, 201: [0.0] * 4, 202: [1.0, float("nan"), 0.0, 0.0], 203: [1.0, float("inf"), 0.0, 0.0], 204: [1.0, None, 0.0, 0.0], 205: [], 206: [1.0, 2.0]}
    rows = [(i, v, "x", 1.0) for i, v in (good | bad).items()] + [(None, [1.0, 1.0, 1.0, 1.0], "x", 1.0), (61, good[61], "again", 2.0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string, score double")
    got = found_neighbours(rp_forest.nearest(df, F.col("vec_id") % 10 == 0))
    want = plain_neighbours(good, lambda i: i % 10 == 0)
    assert set(got) == set(want)
    for q, near in want.items():
        assert [r for _, _, r in got[q]] == [1, 2, 3, 4, 5]
        assert np.allclose([s for _, s, _ in got[q]], [-f for f, _ in near], atol=1e-12)
        assert [i for i, _, _ in got[q]] == [i for _, i in near], q
    assert [i for i, _, _ in got[70]] == [60, 61, 62, 63, 64] and [i for i, _, _ in got[60]] == [61, 62, 63, 64, 65]


def test_neighbours_recall_and_small_tables(spark):
    import pyarrow.parquet as pq
    sf = "/root/testdata/sf0.1"
    t = pq.read_table(f"{sf}/embeddings.parquet").to_pydict()
    vectors = dict(zip(t["vec_id"], t["embedding"]))
    want = plain_neighbours(vectors, lambda i: i % 50 == 0)
    got = found_neighbours(queries.op2_neighbours_rp_forest(spark, sf))
    assert set(got) == set(want) and all([i for i, _, _ in got[q]] == [i for _, i in want[q]] for q in want)
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<float>")
    few = found_neighbours(rp_forest.nearest(df, F.col("vec_id") % 50 == 0, candidates=4000, sample_rows=600))
    hits = sum(len({i for i, _, _ in few[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))  # some 4000 of 8 x 2000 leaf members looked at
    three = found_neighbours(rp_forest.nearest(df.where("vec_id < 3"), F.col("vec_id") == 0))
    assert [len(x) for x in three.values()] == [2]
    assert rp_forest.nearest(df.limit(0), F.lit(True)).count() == 0 and rp_forest.nearest(df, F.lit(False)).count() == 0


@pytest.mark.parametrize("n", [50_000, 200_000])
def test_neighbours_recall_does_not_fall_as_the_table_grows(spark, tmp_path, n):
    """Isotropic vectors, where no tree prunes well, with the defaults."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    x = np.random.default_rng(n).standard_normal((n, 64)).astype(np.float32)
    vectors = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), 64).cast(pa.list_(pa.float32()))
    pq.write_table(pa.table({"vec_id": pa.array(np.arange(n)), "embedding": vectors}), tmp_path / "v.parquet", row_group_size=10_000)
    got = found_neighbours(rp_forest.nearest(spark.read.parquet(str(tmp_path / "v.parquet")), F.col("vec_id") % (n // 100) == 0))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in range(0, n, n // 100):
        cosine = unit @ unit[q]
        cosine[q] = -2
        hits += len({i for i, _, _ in got[q]} & set(np.argpartition(-cosine, 5)[:5].tolist()))
    assert len(got) == 100 and hits >= 0.9 * 500


# N-gram model -------------------------------------------------------------------------------------------
def words_of(t: str | None) -> list:
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")) + [None]


class PlainModel:
    """The same interpolation with dictionaries and exact logarithms; ``least`` is the model's own KEEP (all counts)."""

    def __init__(self, texts, least: int = ngram_lm.KEEP):
        self.n: list[Counter] = [Counter(), Counter(), Counter()]
        for t in texts:
            w = words_of(t)
            for k in range(3):
                self.n[k].update(zip(*(w[i:] for i in range(k + 1))))
        self.total, self.size = sum(self.n[0].values()), len(self.n[0])
        self.kept = [None, *({g: n for g, n in c.items() if n >= least} for c in self.n[1:])]
        self.mass = [None, defaultdict(float), defaultdict(float)]
        for k in (1, 2):
            for g, n in self.kept[k].items():
                self.mass[k][g[:-1]] += n - ngram_lm.DISCOUNT

    def p(self, g: tuple) -> float:
        if len(g) == 1:
            return (self.n[0][g] + 1) / (self.total + self.size + 1)
        k = len(g) - 1
        lower = self.p(g[1:])
        if g[:-1] not in self.n[k - 1] or (k == 2 and g[:-1] not in self.kept[1]):
            return lower
        c = self.n[k - 1][g[:-1]]
        return max(self.kept[k].get(g, ngram_lm.DISCOUNT) - ngram_lm.DISCOUNT, 0) / c + max(1 - self.mass[k][g[:-1]] / c, 1e-10) * lower

    def score(self, t) -> float:
        w = words_of(t)
        return sum(np.log10(self.p(tuple(w[max(0, i - 2):i + 1]))) for i in range(len(w)))


def crc7(i) -> int:
    return zlib.crc32(str(i).encode()) % 7


def check_model(got: dict, texts: dict[int, str]):
    model = PlainModel([t for i, t in texts.items() if crc7(i) != 2])
    for i, t in texts.items():
        w = words_of(t)
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (len(w), sum(model.n[0][(x,)] > 0 for x in w), model.total, crc7(i) == 2)
        base = sum(np.log10((model.n[0][(x,)] + 1) / (model.total + model.size + 1)) for x in w)
        assert abs(r["base_score"] - base) <= 1e-9 * abs(base) + 1e-9
        assert abs(r["score"] - model.score(t)) <= (1.5 / ngram_lm.STEPS) * len(w), (i, r["score"], model.score(t))  # a byte a weight


def test_model_on_odd_texts(spark, tmp_path):
    rng = random.Random(8)
    texts = dict(enumerate(odd_texts() + [prose(rng, 80) for _ in range(60)]))
    documents(spark, list(texts.values())).write.parquet(f"{tmp_path}/documents.parquet")
    check_model(by_id(queries.op4_score_ngram_trie(spark, str(tmp_path))), texts)


def test_model_beats_single_words_on_held_out_texts(spark):
    texts = sf_texts()
    got = by_id(queries.op4_score_ngram_trie(spark, SF))
    check_model(got, texts)
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_model_has_pairs_and_triples_seen_once(spark):
    texts = sf_texts()
    got = by_id(queries.op4_score_ngram_trie(spark, SF))
    model = PlainModel([t for i, t in texts.items() if crc7(i) != 2], least=1)
    for i, t in texts.items():
        assert abs(got[i]["score"] - model.score(t)) <= (1.5 / ngram_lm.STEPS) * got[i]["n_tokens"], i


def test_model_is_stored_once(spark, tmp_path):
    docs = documents(spark, [prose(random.Random(i), 60) for i in range(40)])
    trainer = ngram_lm.Trainer(docs, F.lit(True))
    model = trainer.fit()
    names = [f for x in (model.words, model.pairs, model.triples) for f in x.files]
    assert all(f.startswith("/") for f in names)  # read where they are: nothing is copied to the driver or an executor
    docs.mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([len(model.load().triples.keys)])], names=["n"]) for b in batches), "n long").collect()
    assert not any(os.path.exists(f) for f in names)  # unpacked by now
    base = trainer.scratch.base.removeprefix("file:")
    assert not any(f.endswith(".parquet") for _, _, found in os.walk(base) for f in found)  # no table of counts is left either
    model.load()
    assert not sum(len(c) for c in model.triples.counts) and sum(len(c) for c in model.pairs.counts) == len(model.pairs.keys)
    ids = np.arange(len(model.pairs.keys))
    assert (np.diff(model.pairs.key_of(ids)) > 0).all()  # shards in order, none shares keys


def test_model_without_training_rows(spark):
    got = by_id(ngram_lm.score(documents(spark, ["a b", None]), F.lit(False)))
    assert {(r["n_known"], r["train_tokens"], r["score"]) for r in got.values()} == {(0, 0, 0.0)}


def test_elias_fano_search():
    rng = np.random.default_rng(0)
    for n, u in ((1, 5), (3, 3), (10, 1000), (1000, 1001), (5000, 2 ** 40), (20_000, 60_000), (2, 2 ** 50)):
        v = np.unique(rng.integers(0, u, n)) + 7
        v = np.unique(np.concatenate([v, np.arange(v[0] + 729, v[0] + 1700)])) if n > 900 else v
        q = np.concatenate([v, v + 1, v - 1, rng.integers(0, u + 20, 500), [0, u * 3]])
        assert (elias_fano.EliasFano.build(v).values() == v).all()
        for parts in (1, 3):  # one shard and several
            s = elias_fano.Shards([elias_fano.EliasFano.build(x) for x in np.array_split(v, parts)])
            at, found = s.lower_bound(q)
            assert (at == np.searchsorted(v, q)).all() and (found == np.isin(q, v)).all()


# Personal data ------------------------------------------------------------------------------------------
def plain_pii(t: str):
    digits = pii.only_digits
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", m.start(), m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 14 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    return out + [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(digits(m[0])) <= 15]


def test_base_spans_equal_the_patterns():
    rng = random.Random(3)
    for _ in range(5000):
        t = "".join(rng.choice("a1@.@-+0 9(%é_12") for _ in range(rng.randint(0, 60)))
        assert sorted(pii.base_spans(t)) == sorted(plain_pii(t)), t


def test_gradient_of_the_tagger():
    rng = np.random.default_rng(2)
    ids, tags = rng.integers(0, pii.N_CODES, (3, 7)), rng.integers(0, len(pii.TAGS), (3, 7))
    t = pii.Tagger()
    grad = t._gradient(ids, tags)

    def loss():
        e, move = t.scores(ids), t.p["move"]
        total, ahead = 0.0, e[:, 0]
        for k in range(1, 7):
            ahead = pii._logsum(ahead[:, :, None] + move, 1) + e[:, k]
        for r in range(3):
            total -= sum(e[r, k, tags[r, k]] + (move[tags[r, k - 1], tags[r, k]] if k else 0) for k in range(7))
        return (total + pii._logsum(ahead, 1).sum()) / 3

    for name, g in grad.items():
        at = tuple(np.unravel_index(np.abs(g).argmax(), g.shape))
        t.p[name][at] += 1e-5
        up = loss()
        t.p[name][at] -= 2e-5
        down = loss()
        t.p[name][at] += 1e-5
        assert abs((up - down) / 2e-5 - g[at]) < 1e-4 * max(1, abs(g[at])), name


@pytest.fixture(scope="module")
def tagger(spark):
    return pii.learn(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_tagger_finds_held_out_spans_and_new_forms(spark, tagger):
    texts = [t for t in sf_texts().values()]
    base = [pii.base_spans(t) for t in texts]
    decoded = pii.decode(tagger, texts)
    hits = sum(len(set(b) & set(d)) for b, d in zip(base, decoded))
    assert hits >= 0.9 * sum(map(len, base)) > 0
    added = pii.added_spans(tagger, texts, base)
    assert sum(map(len, added)) <= 0.05 * sum(map(len, base))
    new = ["and then call (521) 555-6210 before the end", "the phone 521-555-6210 again"]
    assert all(x and x[0][0] == "phone" for x in pii.added_spans(tagger, new, [[], []]))
    clean = ["in the year 1999 the 2.0. release had 15 parts and 300 pages", "no digits here at all", ""]
    assert pii.added_spans(tagger, clean, [[], [], []]) == [[], [], []]


def test_long_regions_are_decoded_as_a_whole(tagger):
    t = "x 1 " * 400 + "+1 (521) 555-6210" + " y 2" * 400
    assert len(pii.regions(t)) == 1 and len(pii.windows(len(t))) > 50
    assert [x for x in pii.decode(tagger, [t])[0] if x[0] == "phone" and x[1] <= 1602 and x[2] >= 1615]


def test_regions_hold_whole_runs():
    for run in ("é" * 40 + "@example.org", "ab@" + "long-domain." * 6 + "org", "x" * 200 + "7" + "y" * 200 + "@" + "z" * 200):
        for before, after in (("", ""), ("write to ", " now or never " * 5), ("1 " * 30, "\n2")):
            text = before + run + after
            assert any(a <= len(before) and len(before) + len(run) <= b for a, b in pii.regions(text)), text


def test_counter_examples_come_from_the_whole_text():
    text = ("nothing but words for a while here and there " * 3).join(f" no {i} " for i in range(100, 140))
    late = [w for k in range(8) for w, spans in pii.examples(f"{text} {k}" * 2, []) if not any(f"no {i} " in w for i in (100, 101, 102))]
    assert late and all(any(c.isdigit() for c in w) for w in late)


def test_streamed_path_equals_the_whole_one(tagger):
    """Tags given out in parts are those of one pass over all scores, whatever the parts."""
    rng = np.random.default_rng(8)
    e = rng.normal(0, 3, (700, len(pii.TAGS)))
    move = np.where(pii._MOVES, tagger.p["move"], -1e9)
    best, back = np.where(pii._STARTS, e[0], -1e9), []
    for row in e[1:]:
        back.append((best[:, None] + move).argmax(axis=0))
        best = (best[:, None] + move).max(axis=0) + row
    want = [int(best.argmax())]
    for b in reversed(back):
        want.append(int(b[want[-1]]))
    want.reverse()
    assert tagger.viterbi(e).tolist() == want
    for part in (1, 7, 64, 1000):
        path, got, held = pii.Path(tagger), [], 0
        for j in range(0, len(e), part):
            path.add(e[j:j + part])
            got += path.settled().tolist()
            held = max(held, len(path.back))
        assert got + path.rest().tolist() == want and held < part + 100


def test_long_runs_are_streamed(tagger):
    r = random.Random(3)
    run = "".join(r.choice("abcdefXYZ0123456789+/") for _ in range(30_000)) + " call 212-555-0173 now " + "x9" * 3000
    whole, parts = pii.decode(tagger, [run, "no", run], batch=5000), pii.decode(tagger, [run, "no", run], batch=40)
    assert whole == parts and whole[0] == whole[2]
    assert [b - a for a, b in pii.regions(run)] == [len(run)]


def test_pii_query_and_masking(spark, odd, tagger):
    got = by_id(pii.find_pii(odd, tagger))
    for i, t in enumerate(odd_texts()):
        want = sorted(plain_pii(t or ""), key=lambda x: (x[1], pii.KINDS.index(x[0])))
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest()
    full = by_id(queries.op6_pii_bilstm_crf(spark, SF))
    for i, t in sf_texts().items():
        base = pii.joined(plain_pii(t))
        assert full[i]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(full[i]["spans"].split(","))
    assert by_id(pii.find_pii(odd.limit(0))) == {} and pii.learn(odd.limit(0)) is None
    docs = documents(spark, ["write to ann.b@mail.example.org or +1 (521) 555-6210 now", None, "clean"])
    out = by_id(pii.mask_pii(docs))
    assert out[0]["text"] == "write to <EMAIL> or <PHONE> now" and out[0]["n_chars"] == len(out[0]["text"])
    assert out[1]["text"] is None and out[2]["text"] == "clean" and out[2]["n_words"] == "extra"
    assert pii.masked("abcdef", [("ip", 1, 3), ("card", 2, 5)]) == "a<IP>f"


# Near duplicates ----------------------------------------------------------------------------------------
def plain_components(texts: dict) -> dict:
    sets = {}
    for i, t in texts.items():
        w = words_of(t)[:-1]
        sets[i] = {tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    lists, parent = defaultdict(list), {i: i for i in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sorted(sets):
        common = Counter(j for s in sets[i] for j in lists[s])
        for s in sets[i]:
            lists[s].append(i)
        for j, n in common.items():
            if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in texts}


def edited(rng: random.Random, t: str, share: float) -> str:
    return " ".join(w if rng.random() > share else rng.choice("alpha beta gamma delta".split()) for w in t.split(" "))


@pytest.fixture(scope="module")
def families() -> dict[int, str]:
    """Copies, near copies of near copies, a passage that many texts share, short and odd texts."""
    rng = random.Random(12)
    passage = prose(rng, 70)
    texts = odd_texts()
    for _ in range(6):
        t = prose(rng, rng.choice([40, 150, 400]))
        chain = t
        for _ in range(12):
            texts += [edited(rng, t, 0.02), edited(rng, t, 0.05), t]
            chain = edited(rng, chain, 0.015)
            texts.append(chain)
    texts += [f"{prose(rng, 60)} {passage} {prose(rng, 60)}" for _ in range(40)] + [f"{passage} {rng.choice('abcdefgh')}" for _ in range(8)]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randint(1, 8))) for _ in range(60)]
    rng.shuffle(texts)
    return dict(enumerate(texts))


def test_pairs_of_open_lists_equal_all_pairs(spark, tmp_path, monkeypatch):
    """No similar pair is refused, whether a list is one block or dealt over chunks; sketches of 255 and more stay bounds."""
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2 ** 63, 60_000).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[:n], rng.integers(0, 2 ** 63, n // 9).astype(np.uint64)])) for n in (20, 21, 22, 40, 41, 300, 310, 320, 50_000, 51_000, 60_000) for _ in range(2)]
    members = spark.createDataFrame([(7, i, len(s), 0, i, len(sets)) for i, s in enumerate(sets)], "h long, node long, n long, pos long, x long, k long")
    sketches = spark.createDataFrame([(i, jaccard_join.sketch(s)) for i, s in enumerate(sets)], "node long, sketch binary")
    wanted = {(i, j) for j in range(len(sets)) for i in range(j) if jaccard_join.similar(len(np.intersect1d(sets[i], sets[j])), len(sets[i]), len(sets[j]))}
    join = jaccard_join.JaccardJoin(documents(spark, ["a"]))
    for side in (jaccard_join.SIDE, 3):
        monkeypatch.setattr(jaccard_join, "SIDE", side)
        got = [(r["query"], r["node"]) for r in join.pairs_of(members, sketches, best=False).collect()]
        assert wanted and wanted <= set(got) and len(got) == len(set(got))
        assert all(3 * max(len(sets[i]), len(sets[j])) <= 4 * min(len(sets[i]), len(sets[j])) for i, j in got)


@pytest.mark.parametrize("hot", [jaccard_join.HOT, 3])
def test_components_equal_brute_force(spark, families, hot):
    """``hot=3`` deals almost every list over several tasks."""
    got = jaccard_join.JaccardJoin(documents(spark, list(families.values())), hot=hot).components()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == plain_components(families)


def test_join_query_on_the_generated_table(spark):
    got = queries.op10_jaccard_divide_skip(spark, SF)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == plain_components(sf_texts())


def test_divide_skip_equals_counting():
    rng = random.Random(2)
    for _ in range(300):
        lists = [sorted(rng.sample(range(40), rng.randint(0, 30))) for _ in range(rng.randint(1, 30))]
        need, n = rng.randint(1, 20), Counter(i for x in lists for i in x)
        assert jaccard_join.divide_skip(lists, need) == {i: c for i, c in n.items() if c >= need}


def test_one_row_of_each_component_stays(spark, families):
    docs = documents(spark, list(families.values()))
    want = {c for _, c in plain_components(families).values()}
    kept = jaccard_join.keep_one_per_component(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == want
    again = docs.unionByName(docs).unionByName(docs.where("doc_id < 30").withColumn("doc_id", F.lit(None).cast("long")))
    rows = [r["doc_id"] for r in jaccard_join.keep_one_per_component(again).collect()]
    empty = {i for i, (n, _) in plain_components(families).items() if n == 0}
    assert sorted(i for i in rows if i is not None and i not in empty) == sorted(want - empty)
    assert jaccard_join.near_duplicate_components(docs.limit(0)).count() == 0


# Pipeline -----------------------------------------------------------------------------------------------
def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, rows = docs.columns, {r["doc_id"]: r for r in docs.collect()}
    seen = [len(rows)]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        assert docs.columns == columns
        seen.append(docs.count())
    assert seen == sorted(seen, reverse=True) and seen[1] == seen[0] and 0 < seen[3] < seen[2] < seen[1] and seen[4] == seen[3]
    left = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert not any(pii.base_spans(t) for t in left.values())
    near = plain_components({i: rows[i]["text"] for i in left})
    assert all(c == i for i, (_, c) in near.items())
    check_packing(corpus_pipeline.run(spark, SF).collect(), left, packing.CAPACITY)


def test_pipeline_on_odd_and_empty_tables(spark, odd):
    for start in (odd, odd.limit(0)):
        docs = start
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        docs.collect()
