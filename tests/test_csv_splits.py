"""Quoted CSV read in many splits, against Python's reader over the whole file."""

import csv
import gzip
import random

import pytest

from lakemill.sources import readers
from lakemill.sources.csv_splits import ends_inside


def plain(path, delimiter=","):
    with open(path, newline="") as f:
        return [{k: v or "" for k, v in r.items() if k is not None} for r in csv.DictReader(f, delimiter=delimiter)]


def got(df):
    return [{k: v for k, v in r.asDict().items() if not k.startswith("__")} for r in df.orderBy("__path", "__row").collect()]


@pytest.fixture
def splits(spark):
    """Sets how many bytes a split has."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {k: spark.conf.get(k, None) for k in keys}

    def of(size):
        spark.conf.set(keys[0], str(size))
        spark.conf.set(keys[1], "1")
        spark.conf.set(keys[2], "1")

    yield of
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def made(rng, delimiter, n=120, long=False):
    fields = ["", "a", "two words", 'say "hi"', "line\nfeed", "x\n\ny", '"', '""', f"with{delimiter}in", "é½", "tail\n", '\n"\n', "5", " q "]
    if long:
        fields.append("\n".join(f'row {k}, "quoted" {k}' for k in range(80)))
    out = []
    for _ in range(n):
        row = []
        for _ in range(rng.choice([1, 2, 3, 3, 3, 3, 4])):
            f = rng.choice(fields)
            quoted = any(c in f for c in f'"\n{delimiter}') or rng.random() < 0.2
            row.append('"' + f.replace('"', '""') + '"' if quoted else f)
        if rng.random() < 0.1:
            row[-1] = rng.choice(['5" pipe', 'a"b"', '"closed" then more'])
        out.append(delimiter.join(row))
        if rng.random() < 0.05:
            out.append("")
    return f"id{delimiter}na\"me{delimiter}third\n" + "\n".join(out) + rng.choice(["", "\n"])


@pytest.mark.parametrize("size", [10_000_000, 150])
@pytest.mark.parametrize("delimiter", [",", "\t"])
def test_same_rows_however_a_file_is_split(spark, splits, tmp_path, size, delimiter):
    rng = random.Random(len(delimiter) + size)
    suffix = "csv" if delimiter == "," else "tsv"
    for k in range(2):
        path = tmp_path / f"f{k}.{suffix}"
        path.write_text(made(rng, delimiter, 60 if k else 20, long=k == 1), newline="")
        splits(size)
        df = readers.read_rows(spark, str(path))
        want = plain(path, delimiter)
        rows = got(df)
        assert rows == want and [r["__row"] for r in df.orderBy("__row").collect()] == list(range(1, len(want) + 1))
        if size == 150 and k:
            assert spark.read.text(str(path)).rdd.getNumPartitions() > 10


def test_carriage_returns_gzip_and_folders(spark, splits, tmp_path):
    splits(64)
    text = 'a,b\r\n1,"x\r\ny"\r\n\r\n2,"z"\r\n3\r\n'
    (tmp_path / "one.csv").write_bytes(text.encode())
    want = [{"a": "1", "b": "x\r\ny"}, {"a": "2", "b": "z"}, {"a": "3", "b": ""}]
    assert got(readers.read_rows(spark, str(tmp_path / "one.csv"))) == want
    (tmp_path / "two.csv.gz").write_bytes(gzip.compress(text.encode()))
    assert got(readers.read_rows(spark, str(tmp_path / "two.csv.gz"))) == want
    folder = tmp_path / "folder.csv"
    folder.mkdir()
    for k in range(3):
        (folder / f"{k}.csv").write_bytes(text.encode())
    assert got(readers.read_rows(spark, str(folder))) == want * 3


def test_an_open_quote_takes_the_rest_of_the_file(spark, splits, tmp_path):
    splits(80)
    path = tmp_path / "open.csv"
    path.write_text("a,b\n1,2\n3,\"never closed\n" + "4,5\n" * 100)
    rows = got(readers.read_rows(spark, str(path)))
    assert [{k: v.rstrip("\n") for k, v in r.items()} for r in plain(path)] == rows and len(rows) == 2


def test_ends_inside():
    for line in ["", "a,b", '"a', 'a"', '"a"', '"a""', '"a"",', ',"', '","', 'x,"y"z"', '""', '"",""', '"a" "b', 'a,"b,c', '"x",y"']:
        for inside in (False, True):
            fields = next(csv.reader([('"' if inside else "") + line + "\n", "END\n"]))
            assert ends_inside(line, inside, ",") == bool(fields and "END" in fields[-1] and "\n" in fields[-1]), (line, inside)
