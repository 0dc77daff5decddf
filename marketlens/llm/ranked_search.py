"""Ranked lexical search over pipelined term owners.

1. One Arrow pass over the documents numbers them in *blocks* and makes the
   inverted lists of the items' terms, one row for each (block, term); a list is
   never whole in one place. A bitmap of fixed size (2^20 bits) tells the pass
   which terms the items may have; the join with the items' terms is exact.
2. Document frequencies order the terms from rare to frequent, and OWNERS owners
   get a range of frequencies each, with geometrically growing shares of all
   postings: the first owners' few postings find the likely documents.
3. Items travel in *bundles* of about BUNDLE. For each block, a bundle carries one
   sparse accumulator row (document numbers, scores) an item from owner to owner:
   every stage cogroups the accumulators with the owner's lists of that block,
   adds the integer contributions and hands the sums on.
4. After each stage the block maxima of an item give a score that its 20th
   document reaches at least. A document whose score and the largest possible
   contributions of the owners still to come stay below it can't be among the 20
   and is dropped; so is one that would only now be met. Bounds are exact
   integers, equal scores stay, so the result is that of adding everything up.
5. The last stage's accumulators give the 20 highest by score, then doc_id.

Defined results: a null text has no terms and isn't counted in N; items and
documents without terms find nothing; repeated rows (ids too) are documents or
items of their own; a null doc_id comes after all others of its score; an empty
table gives no rows.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketlens.llm.common import Memo, Scratch, texts_in_steps

TOP, BUNDLE, OWNERS = 20, 256, 4
#: Documents and postings of a block; one document's postings are never parted.
BLOCK_DOCS, BLOCK_POSTINGS = 2048, 1_000_000
#: Best scores an item's accumulators of a block are asked for, to find the score that its 20th document reaches.
KEEP = 4
#: log2 of the bits of the bitmap of the items' terms.
MARKS = 20
#: Each owner's share of all postings is this many times that of the owner before.
GROWTH = 4
#: Frequencies are told apart by classes of which CLASSES double them.
CLASSES = 8
#: Bytes that end a term: ASCII but digits and letters. A-Z are lower-cased; bytes of other letters stay.
TERM_BYTES = bytes(c + 32 if 65 <= c < 91 else c if 48 <= c < 58 or 97 <= c < 123 or c >= 128 else 32 for c in range(256))


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(TERM_BYTES).split()


def item_terms(items: DataFrame, id_col: str) -> DataFrame:
    """item (number of the row), item_id, term, q (occurrences) of every item."""
    numbered = items.select(F.monotonically_increasing_id().alias("item"), F.col(id_col).alias("item_id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in texts_in_steps(batches):
            each = [Counter(terms_of(t)) for t in texts]
            at = pa.array(np.repeat(np.arange(len(each)), [len(c) for c in each]))
            yield pa.RecordBatch.from_arrays([rows.column("item").take(at), rows.column("item_id").take(at), pa.array([t.decode() for c in each for t in c], pa.string()),
                                              pa.array([n for c in each for n in c.values()], pa.int64())], ["item", "item_id", "term", "q"])

    return numbered.mapInArrow(run, f"item long, item_id {numbered.schema['item_id'].dataType.simpleString()}, term string, q long")


def term_bits(terms: DataFrame) -> np.ndarray:
    """The bitmap of all terms: 2^MARKS bits, whatever their number."""
    places = terms.select(F.crc32(F.col("term").cast("binary")).bitwiseAND(F.lit((1 << MARKS) - 1)).alias("place")).distinct().toArrow()
    bits = np.zeros(1 << MARKS, dtype=bool)
    bits[places.column("place").to_numpy()] = True
    return np.packbits(bits)


def block_lists(docs: DataFrame, id_col: str, bits: np.ndarray) -> DataFrame:
    """Rows (block, term, ords, tfs, ns): the list of a term in a block; ns are the documents' lengths.

    A block's documents are numbered in the order of their ids. Its row without a term has the ids
    (null where the list is) and the numbers of documents and terms to count in N and L.
    """
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), "text")
    shipped = docs.sparkSession.sparkContext.broadcast(bits.tobytes())
    id_type = numbered.schema["doc_id"].dataType.simpleString()
    numbers = pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = shipped.value

        def wanted(term: bytes) -> bool:
            place = zlib.crc32(term) & ((1 << MARKS) - 1)
            return bool(bitmap[place >> 3] >> (7 - (place & 7)) & 1)

        known = Memo(wanted, 200_000)

        def lists(block: list[tuple], ids: pa.DataType) -> pa.RecordBatch:
            block.sort(key=lambda d: (d[1] is None, d[1] if d[1] is not None else 0, d[0]))
            postings: dict[bytes, tuple[list, list, list]] = {}
            for ord_, (_, _, n, found) in enumerate(block):
                for term, tf in found:
                    lists = postings.get(term)
                    if lists is None:
                        lists = postings[term] = ([], [], [])
                    lists[0].append(ord_)
                    lists[1].append(tf)
                    lists[2].append(n)
            k = len(postings)
            columns = [pa.array([min(d[0] for d in block)] * (k + 1), pa.int64()), pa.array([t.decode() for t in postings] + [None], pa.string())]
            columns += [pa.array([x[i] for x in postings.values()] + [None], numbers) for i in range(3)]
            columns += [pa.array([None] * k + [x], kind) for x, kind in (([d[1] for d in block], pa.list_(ids)), (sum(d[2] > 0 for d in block), pa.int64()), (sum(d[2] for d in block), pa.int64()))]
            return pa.RecordBatch.from_arrays(columns, ["block", "term", "ords", "tfs", "ns", "ids", "n_docs", "n_terms"])

        block, size = [], 0
        for rows, texts in texts_in_steps(batches):
            for row, doc, text in zip(rows.column("row").to_pylist(), rows.column("doc_id").to_pylist(), texts):
                terms = terms_of(text)
                found = [(t, n) for t, n in Counter(terms).items() if known[t]]
                if block and (len(block) >= BLOCK_DOCS or size + len(found) > BLOCK_POSTINGS):
                    yield lists(block, rows.column("doc_id").type)
                    block, size = [], 0
                block.append((row, doc, len(terms), found))
                size += len(found)
        if block:
            yield lists(block, rows.column("doc_id").type)

    spec = f"block long, term string, ords array<int>, tfs array<int>, ns array<int>, ids array<{id_type}>, n_docs long, n_terms long"
    return numbered.mapInArrow(run, spec)


def owners_of(terms: DataFrame, owners: int) -> Column:
    """Owner of a term by its class of frequencies, rare ones first, from the postings of each class (some 300 rows at most)."""
    classes = terms.groupBy("class").agg(F.sum("df").alias("postings")).orderBy("class").collect()
    total, shares = sum(r["postings"] for r in classes), [GROWTH ** -(owners - 1 - i) for i in range(owners)]
    done, ends = 0, []  # the last class of each owner but the last
    for r in classes:
        done += r["postings"]
        if len(ends) < owners - 1 and done >= total * shares[len(ends)]:
            ends.append(r["class"])
    return sum((F.when(F.col("class") > end, 1).otherwise(0) for end in ends), F.lit(0))


class RankedSearch:
    def __init__(self, docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", top: int = TOP, owners: int = OWNERS):
        self.docs, self.items, self.doc_id, self.item_id, self.top, self.owners = docs, items, doc_id, item_id, top, owners
        self.scratch = Scratch(docs.sparkSession, "search")

    def asked(self, index: DataFrame, item_terms: DataFrame, n: int, length: int) -> tuple[DataFrame, DataFrame]:
        """(terms with weight and owner, per item and owner the most that later owners can add: rest).

        A contribution is largest for the largest tf and the shortest document, whichever documents these are.
        """
        known = index.where("term IS NOT NULL").groupBy("term").agg(F.sum(F.size("ords")).cast("long").alias("df"), F.max(F.array_max("tfs")).cast("long").alias("tf"), F.min(F.array_min("ns")).cast("long").alias("n"))
        known = known.join(item_terms.select("term").distinct(), "term")  # the bitmap lets some others through
        weight = F.floor(1000 * F.log((F.lit(2.0) * n + 2) / (2 * F.col("df") + 1)))
        known = self.scratch.put(known.withColumns({"w": weight.cast("long"), "class": F.floor(CLASSES * F.log2("df")), "most": impact(F.col("tf"), F.col("n"), n, length)}), "known")
        terms = self.scratch.put(known.where("w > 0").withColumn("owner", owners_of(known, self.owners)).select("term", "w", "most", "owner"), "terms")
        by_owner = item_terms.join(terms, "term").groupBy("item", "owner").agg(F.sum(F.col("q") * F.col("w") * F.col("most")).alias("most"))
        every = item_terms.select("item").distinct().select("item", F.explode(F.array(*[F.lit(i) for i in range(self.owners)])).alias("owner"))
        later = Window.partitionBy("item").orderBy(F.desc("owner")).rowsBetween(Window.unboundedPreceding, -1)  # OWNERS rows an item
        rest = every.join(by_owner, ["item", "owner"], "left").select("item", "owner", F.coalesce(F.sum("most").over(later), F.lit(0)).alias("rest"))
        return terms, self.scratch.put(rest, "rest")

    def stage(self, owner: int, carried: DataFrame | None, lists: DataFrame, asked: DataFrame, least: DataFrame, n: int, length: int, keep: int) -> DataFrame:
        """The accumulators (bundle, block, item, ords, scores, best) after this owner.

        ``asked``: term, bundle, items (number, q x w, floor); ``least``: item, floor. A score below an item's floor is dropped.
        """
        own = lists.join(asked, "term").select("bundle", "block", "ords", "tfs", "ns", "items")
        right = own.groupBy("bundle", "block")
        spec = "bundle long, block long, item long, ords array<int>, scores array<long>, best array<long>"
        schema = pa.schema([("bundle", pa.int64()), ("block", pa.int64()), ("item", pa.int64()), ("ords", pa.list_(pa.int32())), ("scores", pa.list_(pa.int64())), ("best", pa.list_(pa.int64()))])

        def add(key: tuple, before: pa.Table, owned: pa.Table) -> pa.Table:
            floors = dict(zip(before.column("item").to_pylist(), before.column("floor").to_pylist()))
            wanted = owned.column("items").to_pylist()
            for x in wanted:
                floors.update((s["item"], s["floor"]) for s in x)
            place = {item: i for i, item in enumerate(floors)}
            ords = [_lists(t, "ords") for t in (before, owned)]
            total = np.zeros((len(floors), 1 + max(max(map(np.max, x), default=0) for x in ords)), dtype=np.int64)
            for item, at, scores in zip(before.column("item").to_pylist(), ords[0], _lists(before, "scores")):
                total[place[item], at] = scores
            for x, at, tfs, ns in zip(wanted, ords[1], _lists(owned, "tfs"), _lists(owned, "ns")):
                gain = np.array([s["gain"] for s in x], dtype=np.int64)
                rows = np.array([place[s["item"]] for s in x])
                total[rows[:, None], at] += gain[:, None] * impact(tfs.astype(np.int64), ns.astype(np.int64), n, length)
            kept = (total > 0) & (total >= np.array(list(floors.values()), dtype=np.int64)[:, None])
            out = [(item, at) for item, row in place.items() if len(at := np.flatnonzero(kept[row]))]
            scores = [total[place[item], at] for item, at in out]
            columns = [[key[0].as_py()] * len(out), [key[1].as_py()] * len(out), [item for item, _ in out], [at for _, at in out], scores, [-np.sort(-x)[:keep] for x in scores]]
            return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        if carried is None:
            carried = self.docs.sparkSession.createDataFrame([], "bundle long, block long, item long, ords array<int>, scores array<long>, floor long")
        else:
            carried = carried.drop("best").join(least, "item").select("bundle", "block", "item", "ords", "scores", "floor")
        return self.scratch.put(carried.groupBy("bundle", "block").cogroup(right).applyInArrow(add, spec), f"owner-{owner}")

    def ranked(self) -> DataFrame:
        """item_id, rank, doc_id, score."""
        item_rows = self.scratch.put(item_terms(self.items, self.item_id), "items")
        index = self.scratch.put(block_lists(self.docs, self.doc_id, term_bits(item_rows)), "index")
        n, length, blocks = index.where("term IS NULL").agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0)), F.count("*")).first()
        terms, rest = self.asked(index, item_rows, n, length)
        items = item_rows.agg(F.count_distinct("item")).first()[0]
        bundle = F.pmod(F.xxhash64("item"), F.lit(max(1, math.ceil(items / BUNDLE)))).alias("bundle")
        # So many scores of each block that all blocks together have ``top`` at least; more make the bound tighter.
        keep = max(KEEP, math.ceil(self.top / max(1, blocks)))
        floor_at = rest.select("item", "owner", F.lit(0).cast("long").alias("least"), "rest")
        acc = None
        for owner in range(self.owners):
            least = floor_at.where(F.col("owner") == owner).select("item", (F.col("least") - F.col("rest")).alias("floor"))
            asked = item_rows.join(terms.where(F.col("owner") == owner), "term").join(least, "item").select("term", bundle, F.struct("item", (F.col("q") * F.col("w")).alias("gain"), "floor").alias("s"))
            asked = asked.groupBy("term", "bundle").agg(F.collect_list("s").alias("items"))  # a bundle's items at most
            acc = self.stage(owner, acc, index.where("term IS NOT NULL").select("block", "term", "ords", "tfs", "ns"), asked, least, n, length, keep)
            if owner:
                self.scratch.drop(f"owner-{owner - 1}")
            reached = acc.select("item", F.explode("best").alias("score"))
            reached = reached.withColumn("at", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score")))).where(F.col("at") <= self.top)
            reached = reached.where(F.col("at") == self.top).select("item", F.col("score").alias("least"))
            reached = self.scratch.put(reached, f"reached-{owner}")
            floor_at = rest.join(reached, "item", "left").select("item", "owner", F.coalesce("least", F.lit(0)).alias("least"), "rest")
        last = acc.join(floor_at.where(F.col("owner") == self.owners - 1).select("item", "least"), "item")
        scored = last.select("item", "block", "least", F.explode(F.arrays_zip("ords", "scores")).alias("d")).where("d.scores >= least").select("item", "block", "d.ords", F.col("d.scores").alias("score"))
        ids = index.where("term IS NULL").select("block", "ids")
        found = scored.join(ids, "block").select("item", F.col("ids")[F.col("ords")].alias("doc_id"), "block", "ords", "score")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "block", "ords")
        found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= self.top)
        names = item_rows.select("item", "item_id").distinct()
        return found.join(names, "item").select("item_id", "rank", "doc_id", "score")


def impact(tf, n, docs: int, length: int):
    """(10^9 tf) div (1000 tf + 12 m) with m = 75 + (25 n N div L), of columns or arrays; all operands are positive."""
    div = _div if isinstance(tf, Column) else np.floor_divide
    return div(tf * 10**9, tf * 1000 + (div(n * (25 * docs), max(1, length)) + 75) * 12)


def _lists(table: pa.Table, column: str) -> list[np.ndarray]:
    """The lists of a column as arrays over one flat array."""
    lists = table.column(column).combine_chunks()
    ends = lists.offsets.to_numpy()
    flat = lists.values.to_numpy()
    return [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]


def _div(a: Column, b: Column | int) -> Column:
    return F.call_function("div", a, F.lit(b) if isinstance(b, int) else b)


def search(docs: DataFrame, items: DataFrame, top: int = TOP, owners: int = OWNERS) -> DataFrame:
    return RankedSearch(docs, items, top=top, owners=owners).ranked()
