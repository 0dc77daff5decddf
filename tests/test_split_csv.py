"""Records of split files against the reader that takes a file whole."""

import os
import random

import pytest

from marketlens.sources.split_csv import OPTIONS, ends_inside, read_quoted_csv, split_functions, text_lines

PIECES = ["x", "line one\nline two", 'said ""yes""', '""', "\n", "\n\n", 'a,b', "", 'end""', '""start', "é\n日本", "\r\n", '"",""', " lead"]


def field(rng: random.Random) -> str:
    text = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 3)))
    if any(c in text for c in '",\n\r') or rng.random() < 0.3:
        return f'"{text}"'
    return text


def csv_text(seed: int, end: str = "\n") -> str:
    rng = random.Random(seed)
    rows = ["review_id,title,message"]
    for i in range(60):
        rows.append(",".join([f"r{i}", field(rng), rng.choice([field(rng), '5" pipe', 'in"ch', ""])]))
        if rng.random() < 0.1:
            rows.append("")
    return end.join(rows) + rng.choice(["", end])


def whole(spark, path):
    return spark.read.options(**OPTIONS, header=True).csv(path)


def same(spark, path) -> int:
    """Compares both readers; the number of splits."""
    want = whole(spark, path)
    got = read_quoted_csv(spark, path)
    assert got.columns == want.columns
    key = lambda r: tuple((x is None, x or "") for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
    return split_functions(text_lines(spark, path)).count()


@pytest.fixture()
def split_bytes(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {k: spark.conf.get(k) for k in keys}
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield lambda n: spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
    for k, v in old.items():
        spark.conf.set(k, v)


def written(folder, name, text) -> str:
    path = os.path.join(folder, name)
    with open(path, "w", newline="") as fh:
        fh.write(text)
    return path


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [60, 97, 256, 1 << 20])
def test_equal_to_the_whole_file_reader(spark, tmpdir_path, split_bytes, end, size):
    split_bytes(size)
    n = same(spark, written(tmpdir_path, "r.csv", csv_text(size, end)))
    assert n > 5 or size > 10_000


def test_a_quote_at_every_split_edge(spark, tmpdir_path, split_bytes):
    """The same records, moved byte by byte over the edges of splits of 40 bytes."""
    split_bytes(40)
    for shift in range(0, 40, 3):
        rows = "a,b\n" + "s" * shift + ',"one\ntwo ""x"" \n"\n' + "".join(f'{i},"q""\n""{i}"\n' for i in range(12))
        assert same(spark, written(tmpdir_path, f"{shift}.csv", rows)) > 3


def test_a_record_longer_than_several_splits(spark, tmpdir_path, split_bytes):
    split_bytes(64)
    text = "a,b\nx," + '"' + "\n".join(["many lines"] * 60) + '"\ny,"z"\n' + 'w,"open at the end'
    assert same(spark, written(tmpdir_path, "long.csv", text)) > 8


def test_header_alone_wide_and_empty_files(spark, tmpdir_path, split_bytes):
    split_bytes(24)
    same(spark, written(tmpdir_path, "wide.csv", "a_rather_long_name,another_long_name_here\n1,\"x\ny\"\n"))
    same(spark, written(tmpdir_path, "quoted.csv", '"first ""name""\n of two lines","second"\n1,2\n'))
    same(spark, written(tmpdir_path, "only.csv", "a,b\n"))


def test_several_files_each_with_a_header(spark, tmpdir_path, split_bytes):
    split_bytes(80)
    for i in range(3):
        written(tmpdir_path, f"part{i}.csv", csv_text(i))
    same(spark, tmpdir_path)


def test_the_reader_is_cut_into_tasks(spark, tmpdir_path, split_bytes):
    split_bytes(100)
    path = written(tmpdir_path, "r.csv", csv_text(3))
    assert whole(spark, path).rdd.getNumPartitions() == 1
    assert text_lines(spark, path).rdd.getNumPartitions() > 10


@pytest.mark.parametrize("line,inside,after", [
    ("a,b", False, False), ('a,"b', False, True), ('b"', True, False), ('x""y', True, True), ('x"",', True, True), ('x"",""', True, True), ('"x""', False, True),
    ('""', False, False), ('"""', False, True), ('5" x,b', False, False), ('in"ch,"y', False, True), ('x",5" z', True, False), ("", True, True), ("", False, False)])
def test_open_fields_at_line_ends(line, inside, after):
    assert ends_inside(line, inside) is after
