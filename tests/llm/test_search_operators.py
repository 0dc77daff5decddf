"""SimHash near duplicates, spelling variants and ranked search against brute force and SQL."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter
from itertools import combinations

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from marketlens.llm import ranked_search, simhash_index, spelling_trie
from marketlens.llm.common import Scratch
from marketlens.llm.components import labels
from marketlens.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.fixtures import SCHEMA, SF, by_id, documents, odd_texts, prose, sf_texts


def joined(nodes, near) -> dict:
    """node -> smallest node it is connected with."""
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            parent[n] = n = parent[parent[n]]
        return n

    for a, b in near:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# SimHash ------------------------------------------------------------------------------------------------

def plain_fingerprint(text: str | None) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps: dict[int, int]) -> dict[int, int]:
    near = [(a, b) for a, b in combinations(fps, 2) if (fps[a] ^ fps[b]).bit_count() <= 3]
    return joined(fps, near)


def check_simhash(texts: dict[int, str | None], found: dict) -> None:
    fps = {i: plain_fingerprint(t) for i, t in texts.items()}
    assert {i: r["fingerprint"] for i, r in found.items()} == {i: f"{f:016x}" for i, f in fps.items()}
    assert {i: r["component_id"] for i, r in found.items()} == plain_components(fps)


def test_simhash_query_equals_brute_force(spark):
    check_simhash(sf_texts(), by_id(QUERIES["op11_simhash_byte_positions"](spark, SF)))


def test_simhash_odd_texts(spark):
    texts = odd_texts()
    df = documents(spark, texts)
    check_simhash(dict(enumerate(texts)), by_id(simhash_index.near_duplicate_components(df)))
    assert simhash_index.near_duplicate_components(df.limit(0)).collect() == []


def test_simhash_null_and_repeated_ids(spark):
    rows = [(None, "a b c", None, None, None, None, None, None), (5, "a b c", None, None, None, None, None, None), (5, "a b c", None, None, None, None, None, None),
            (None, "other words here entirely", None, None, None, None, None, None)]
    got = simhash_index.near_duplicate_components(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.component_id) for r in got if r.fingerprint == f"{plain_fingerprint('a b c'):016x}") == [(False, 5, 5), (False, 5, 5), (True, None, 5)]
    assert [r.component_id for r in got if r.fingerprint == f"{plain_fingerprint('other words here entirely'):016x}"] == [None]


@pytest.mark.parametrize("s", [2, 3, 4, 5])
def test_position_sets_cover_every_five_positions(s):
    sets = simhash_index.position_sets(s)
    assert all(len(c) == s for c in sets)
    assert all(any(set(c) <= set(five) for c in sets) for five in combinations(range(8), 5))


def test_positions_grow_with_the_table():
    assert [simhash_index.positions_for(n) for n in (0, 1 << 20, (1 << 20) + 1, 1 << 28, 1 << 36, 1 << 40)] == [2, 2, 3, 3, 4, 5]


def near_cloud(rng: random.Random, clusters: int, each: int) -> list[int]:
    out = set()
    for _ in range(clusters):
        base = rng.getrandbits(64)
        for _ in range(each):
            out.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))))
    return sorted(out)


@pytest.mark.parametrize("s", [2, 3, 4, 5])
@pytest.mark.parametrize("chunk", [4, 256])
def test_links_connect_the_same_whatever_the_cells(spark, monkeypatch, s, chunk):
    monkeypatch.setattr(simhash_index, "CHUNK", chunk)  # with 4 most cells are dealt into chunks
    fps = near_cloud(random.Random(s), 12, 25)
    nodes = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    found = simhash_index.links(nodes, Scratch(spark, "test"), len(fps), s=s).collect()
    got = joined(fps, [(r.a % (1 << 64), r.b % (1 << 64)) for r in found])
    assert got == joined(fps, [(a, b) for a, b in combinations(fps, 2) if (a ^ b).bit_count() <= 3])


def test_tally_counts_shared_positions():
    rng = np.random.default_rng(3)
    fps = np.unique(rng.integers(0, 4, (300, 8), dtype=np.uint8).view(np.uint64).ravel())
    group = np.sort(rng.integers(0, 3, len(fps)))
    octets = fps.view(np.uint8).reshape(-1, 8)
    want = {(i, j) for i, j in combinations(range(len(fps)), 2) if group[i] == group[j] and (octets[i] == octets[j]).sum() >= 5}
    assert set(zip(*(x.tolist() for x in simhash_index.tally(fps, group, 5)))) == want


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 50)]
    links = chain + star + [(3000, 3001), (3001, 3000), (3000, 3000)]
    got = labels(Scratch(spark, "test"), spark.createDataFrame(links, "a long, b long"))
    groups = {}
    for r in got.collect():
        groups.setdefault(r.label, set()).add(r.node)
    assert sorted(map(min, groups.values())) == [0, 1000, 3000] and sorted(map(len, groups.values())) == [2, 50, 201]


# spelling -----------------------------------------------------------------------------------------------

def plain_words(rows) -> Counter:
    counts: Counter = Counter()
    for doc, text in rows:
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), word)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % 97 == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            counts[word] += 1
    return counts


def edited(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_forms(counts: Counter) -> dict:
    n = {w: c for w, c in counts.items() if len(w) >= 5 and c >= 3}
    near = {w: [x for x in n if abs(len(x) - len(w)) <= 1 and edited(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return {w: (form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def forms(df) -> dict:
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def variants() -> list[str]:
    """Words with chains of ever more frequent variants, with letters of all kinds, and of great length."""
    rng, out = random.Random(7), []
    for stem in ["stone", "morning", "çañon", "Éclair", "house" * 9, "z" * 39, "z" * 40, "z" * 41, "y" * 3000]:
        word, n = stem, 3
        for _ in range(5):
            out += [word] * n
            at = rng.randrange(len(word))
            word, n = rng.choice([word[:at] + word[at + 1:], word[:at] + "q" + word[at:], word[:at] + "é" + word[at + 1:]]), n * rng.choice([1, 2, 3])
    rng.shuffle(out)
    return [" ".join(out[i:i + 40]) for i in range(0, len(out), 40)]


def test_spelling_query_equals_brute_force(spark):
    found = forms(QUERIES["op12_spelling_frequency_trie"](spark, SF))
    counts = plain_words(sf_texts().items())
    want = {w: c for w, c in counts.items() if len(w) >= 5 and c >= 3}
    assert {w: r[2] for w, r in found.items()} == want
    some = sorted(want, key=lambda w: zlib.crc32(w.encode()))[:400]  # brute force over all words for these
    near = {w: [x for x in want if abs(len(x) - len(w)) <= 1 and edited(w, x)] for w in some}
    assert {w: found[w][3] for w in some} == {w: len(near[w]) for w in some}
    for w in some:
        best = min(near[w], key=lambda x: (-want[x], x), default=None)
        assert found[w][0] == (best if best and want[best] >= 2 * want[w] else None)
    for w, (form, root, _, _, form_n) in found.items():
        assert (root == (found[form][1] if form else w)) and form_n == (want[form] if form else None)


@pytest.mark.parametrize("levels", [1, 3, 12])
def test_spelling_variants_equal_brute_force(spark, levels):
    texts = variants() + odd_texts()
    rows = list(enumerate(texts))
    assert forms(spelling_trie.spelling_forms(documents(spark, texts), levels=levels)) == plain_forms(plain_words(rows))


def test_spelling_shards_dealt_into_chunks(spark):
    texts = variants()
    want = plain_forms(plain_words(enumerate(texts)))
    words = spelling_trie.count_words(documents(spark, texts)).where("char_length(word) >= 5 AND n >= 3").cache()
    near = spelling_trie.near_words(words, Scratch(spark, "test"), spelling_trie.letter_groups(words), 2, most=(3, 2))
    assert {r.word: r.n_near for r in near.collect()} == {w: r[3] for w, r in want.items() if r[3]}


def test_spelling_empty_and_null(spark):
    empty = documents(spark, ["a"]).limit(0)
    assert spelling_trie.spelling_forms(empty).collect() == []
    rows = [(None, "stone " * 4, None, None, None, None, None, None), (1, None, None, None, None, None, None, None)]
    assert forms(spelling_trie.spelling_forms(spark.createDataFrame(rows, SCHEMA))) == plain_forms(plain_words((r[0], r[1]) for r in rows))


def test_one_edit_of_rows_and_words():
    rng = random.Random(1)
    words = ["".join(rng.choice("abé") for _ in range(rng.randint(1, 6))) for _ in range(150)]
    pairs = [(a, b) for a in words for b in words]
    spell = [[w.encode("latin-1") for w in side] for side in zip(*pairs)]
    wide = [np.array(s, dtype="S8").view(np.uint8).reshape(len(s), 8) for s in spell]
    sizes = [np.array([len(w) for w in s]) for s in spell]
    want = [edited(a, b) for a, b in pairs]
    assert spelling_trie.one_edit_rows(*wide, *sizes).tolist() == want
    assert [spelling_trie.one_edit(a, b) for a, b in zip(*spell)] == want


def test_near_words_meet_in_exactly_one_shard():
    rng, group = random.Random(2), np.arange(256) % 5
    words = list({"".join(rng.choice("abcdefgé") for _ in range(rng.randint(5, 7))) for _ in range(400)})
    _, letters, sizes = spelling_trie.spelled(pa.array(words))
    vector = spelling_trie.vectors(letters, sizes, group, 5)
    who, where = spelling_trie.reachable(vector, spelling_trie.shard_numbers(5))
    own = where[:len(words)]
    asks = set(zip(who.tolist(), where.tolist()))
    for i, j in combinations(range(len(words)), 2):
        if edited(words[i], words[j]):
            assert ((i, own[j]) in asks) + ((j, own[i]) in asks) == (2 if own[i] == own[j] else 1)


# ranked search ------------------------------------------------------------------------------------------

def plain_search(docs, items, top=20) -> list[tuple]:
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    low = {c: c + 32 for c in range(65, 91)}
    terms = [Counter(pattern.findall((t or "").translate(low))) for _, t in docs]
    n_docs, length = sum(bool(c) for c in terms), sum(map(Counter.total, terms))
    df = Counter(t for c in terms for t in c)
    out = []
    for item_id, text in items:
        scores = []
        for (doc_id, _), c in zip(docs, terms):
            score = 0
            for t, q in Counter(pattern.findall((text or "").translate(low))).items():
                if t in c:
                    m = 100 - 25 + 25 * c.total() * n_docs // length
                    score += q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
            if score:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, i + 1, d, -s) for i, (s, _, _, d) in enumerate(sorted(scores, key=lambda x: x[:3])[:top])]
    return sorted(out, key=lambda r: (str(r[0]), r[1], str(r[2]), r[3]))


def ranking(df) -> list[tuple]:
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=lambda r: (str(r[0]), r[1], str(r[2]), r[3]))


def test_search_query_equals_its_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    want = con.execute(f"SELECT item_id, rank, doc_id, score FROM ({ORACLE_SQL['op13_ranked_search_term_owners']})").fetchall()
    assert ranking(QUERIES["op13_ranked_search_term_owners"](spark, SF)) == sorted(want, key=lambda r: (str(r[0]), r[1], str(r[2]), r[3]))


@pytest.mark.parametrize("owners,block", [(1, 2048), (4, 7), (6, 1)])
def test_search_equals_brute_force(spark, monkeypatch, owners, block):
    monkeypatch.setattr(ranked_search, "BLOCK_DOCS", block)
    rng = random.Random(9)
    texts = odd_texts() + [prose(rng, rng.randint(1, 60)) for _ in range(120)] + ["tie words here"] * 30
    asked = [(i, t) for i, t in enumerate([None, "", "...", "tie words", "stone House stone niño", prose(rng, 40), "x's don't 12", "日本語", "absent"])] + [(3, "tie words"), (None, "over hills")]
    items = spark.createDataFrame([(i, t, "clash", 1) for i, t in asked], "item_id long, text string, term string, score long")
    want = plain_search(list(enumerate(texts)), asked)
    assert ranking(ranked_search.search(documents(spark, texts), items, owners=owners)) == want


def test_search_null_and_repeated_documents(spark):
    docs = [(None, "stone hill"), (4, "stone hill"), (4, "stone hill"), (2, "stone"), (3, None), (9, "other words of the rest")] + [(20 + i, "filler text") for i in range(9)]
    frame = spark.createDataFrame([(i, t, None, None, None, None, None, None) for i, t in docs], SCHEMA)
    items = spark.createDataFrame([(1, "stone hill")], "item_id int, text string")
    assert ranking(ranked_search.search(frame, items)) == plain_search(docs, [(1, "stone hill")])


def test_search_empty_tables(spark):
    docs, items = documents(spark, ["stone hill", "river"]), spark.createDataFrame([(1, "stone")], "item_id long, text string")
    assert ranked_search.search(docs.limit(0), items).collect() == []
    assert ranked_search.search(docs, items.where(F.lit(False))).collect() == []
    assert ranked_search.search(documents(spark, [None, "..."]), items).collect() == []


def test_search_keeps_what_only_late_owners_find(spark):
    """Items whose terms are all frequent: nothing may be dropped before the last owner."""
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["aa", "bb", "cc", "dd"]) for _ in range(rng.randint(1, 9))) for _ in range(300)] + ["rare aa"]
    asked = [(0, "aa bb cc dd"), (1, "aa rare"), (2, "bb bb bb aa")]
    items = spark.createDataFrame(asked, "item_id long, text string")
    assert ranking(ranked_search.search(documents(spark, texts), items)) == plain_search(list(enumerate(texts)), asked)
