"""Splittable reader for CSV files whose quoted fields hold line breaks.

Spark's ``multiLine`` reader makes a file one task, because a line break may or
may not end a record. What decides it is one bit: whether the line begins inside
a quoted field. A split of the file is a function of that bit, from its value at
the first line to its value after the last:

1. one pass computes this function for every split (two bits a split);
2. the functions are combined over the splits before it, which gives the bit
   each split begins with;
3. a second pass puts the lines of each split together to records. The last
   record of a split may go on in the next one: only that one and the lines
   before a split's first record are moved, to be joined by split number;
4. ``from_csv`` parses the records, with the options of the ``multiLine`` reader.

The functions follow the reader's own reading of quotes: a field is quoted if it
begins with a quote, a doubled quote inside stands for one, and a quote within
an unquoted field is text. Both passes cut the file alike, since both are
planned with the same settings.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

QUOTE = '"'
OPTIONS = {"quote": QUOTE, "escape": QUOTE, "multiLine": "true", "mode": "PERMISSIVE"}


def ends_inside(line: str, inside: bool, sep: str = ",") -> bool:
    """Whether a quoted field is open at the end of the line, given whether one is at its start."""
    at = 0
    while True:
        if inside:
            at = line.find(QUOTE, at)
            if at < 0:
                return True
            if line.startswith(QUOTE, at + 1):
                at += 2
                continue
            inside = False
        elif line.startswith(QUOTE, at):
            inside, at = True, at + 1
            continue
        at = line.find(sep, at) + 1
        if not at:
            return False


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, start (of the split the line begins in), line; rows of a split come in file order."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line"))


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], list[str]]]:
    """(split, lines) of each batch, cut where the split changes."""
    for b in batches:
        files, starts, lines = (b.column(c).to_pylist() for c in ("file", "start", "line"))
        low = 0
        for i in range(1, len(lines) + 1):
            if i == len(lines) or (files[i], starts[i]) != (files[low], starts[low]):
                yield (files[low], starts[low]), lines[low:i]
                low = i


def split_functions(lines: DataFrame, sep: str = ",") -> DataFrame:
    """file, start, from_outside, from_inside, crlf: whether a field is open after the split, for both ways to begin it.

    ``crlf`` tells whether the split's first line ends with a carriage return.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], tuple[bool, bool, bool]] = {}  # a task's splits
        for split, texts in _splits(batches):
            outside, inside, crlf = found.get(split, (False, True, texts[0].endswith("\r")))
            for line in texts:
                if QUOTE in line:
                    outside, inside = ends_inside(line, outside, sep), ends_inside(line, inside, sep)
            found[split] = outside, inside, crlf
        if found:
            columns = [[k[0] for k in found], [k[1] for k in found], *map(list, zip(*found.values()))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["file", "start", "from_outside", "from_inside", "crlf"])

    return lines.mapInArrow(run, "file string, start long, from_outside boolean, from_inside boolean, crlf boolean")


def split_starts(functions: DataFrame) -> tuple[set[tuple[str, int]], set[str]]:
    """(splits that begin inside a quoted field, files whose lines end with CR LF).

    The functions of a file's splits are applied one after the other. One row a split
    comes to the driver, that is one for every ``maxPartitionBytes`` of the export.
    """
    opens, crlf, inside, file = set(), set(), False, None
    for r in functions.orderBy("file", "start").collect():
        if r["file"] != file:
            file, inside = r["file"], False
            if r["crlf"]:
                crlf.add(file)
        if inside:
            opens.add((file, r["start"]))
        inside = r["from_inside"] if inside else r["from_outside"]
    return opens, crlf


#: What a piece of a split is: a record; lines that go on from an earlier split; the split's last record; a last record that is the header.
WHOLE, HEAD, LAST, HEADER = 0, 1, 2, 3


def records(lines: DataFrame, opens: set[tuple[str, int]], crlf: set[str], sep: str = ",") -> DataFrame:
    """record: the text of every record but the files' headers and empty lines.

    Line breaks in quotes stay; as the ``multiLine`` reader does, those of a CR LF file become LF.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, inside, held, kind, header = None, False, [], HEAD, False

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[0][0] for r in rows], pa.string()), pa.array([r[0][1] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
                                               pa.array([r[2] for r in rows], pa.string())], ["file", "start", "kind", "record"])

        for key, texts in _splits(batches):
            out = []
            if key != split:
                if held:
                    out.append((split, kind, "\n".join(held)))
                split, inside, held, kind, header = key, key in opens, [], HEAD, key[1] == 0
                strip = key[0] in crlf
            for line in texts:
                if strip:
                    line = line.removesuffix("\r")
                if not inside:  # a record starts here
                    if held and kind != HEADER:
                        out.append((split, WHOLE if kind == LAST else HEAD, "\n".join(held)))
                    held = []
                    if not line:
                        kind = LAST
                        continue
                    kind, header = HEADER if header else LAST, False
                held.append(line)
                if QUOTE in line:
                    inside = ends_inside(line, inside, sep)
            if out:
                yield batch(out)
        if held:
            yield batch([(split, kind, "\n".join(held))])

    found = lines.mapInArrow(run, "file string, start long, kind int, record string")
    # At most a head and a last record a split: a head belongs to the nearest earlier last record.
    order = Window.partitionBy("file").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, 0)
    owner = F.last(F.when(F.col("kind") >= LAST, F.col("start")), ignorenulls=True).over(order)
    edges = found.where(F.col("kind") != WHOLE).withColumn("owner", owner)
    joined = edges.groupBy("file", "owner").agg(F.max("kind").alias("kind"), F.sort_array(F.collect_list(F.struct("start", "record"))).alias("parts"))
    joined = joined.where(F.col("kind") != HEADER).select(F.array_join(F.col("parts.record"), "\n").alias("record"))
    return found.where(F.col("kind") == WHOLE).select("record").unionByName(joined)


def read_quoted_csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Header CSV with line breaks in quoted fields, every column as STRING, cut into as many tasks as its size asks for."""
    names = spark.read.options(**OPTIONS, header=True, inferSchema=False, sep=sep).csv(path).columns
    lines = text_lines(spark, path)
    opens, crlf = split_starts(split_functions(lines, sep))
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    parsed = records(lines, opens, crlf, sep).select(F.from_csv("record", schema, OPTIONS | {"sep": sep}).alias("row"))
    return parsed.select("row.*")
