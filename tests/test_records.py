"""Records with line ends in their values, read by many tasks."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from ledgerfold.sources import records, tables

SCHEMA = "a STRING, b STRING, n INT"


@pytest.fixture
def small_blocks(spark):
    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        spark.conf.set("spark.sql.files.minPartitionNum", "1")

    yield use
    for name in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum"):
        spark.conf.unset(f"spark.sql.files.{name}")


def written(path, rows, end="\n", quoting=csv.QUOTE_MINIMAL):
    out = io.StringIO(newline="")
    csv.writer(out, lineterminator=end, quoting=quoting).writerows([("a", "b", "n"), *rows])
    path.write_bytes(out.getvalue().encode())


def rows_of(rng, n):
    bits = ["x", "é", '"', '""', ",", "\n", "\n\n", " ", "\r\n", "word word", "\n\"", "\\"]
    text = lambda: "".join(rng.choice(bits) for _ in range(rng.randrange(8)))
    return [(text(), "y" + text(), at) for at in range(n)]


@pytest.mark.parametrize("block, end", [(9, "\n"), (64, "\r\n"), (64, "\n"), (1 << 27, "\r\n")])
def test_rows_are_those_of_the_csv_module(spark, tmp_path, small_blocks, block, end):
    rows = rows_of(random.Random(block), 20)
    written(tmp_path / "t.csv", rows, end)
    small_blocks(block)
    found = records.parsed(records.read_records(spark, str(tmp_path / "t.csv")), SCHEMA, tables_options())
    got = sorted((r.number, r.a or "", r.b or "", r.n) for r in found.collect())
    assert [(a, b, n) for _, a, b, n in got] == rows
    assert [number for number, *_ in got] == list(range(1, 21))


def tables_options():
    return {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def test_a_record_longer_than_blocks(spark, tmp_path, small_blocks):
    long = "line with \"quotes\"\n" * 60
    rows = [("a", "b", 1), (long, "x", 2), ("c", long, 3), ("", "", 4)]
    written(tmp_path / "t.csv", rows)
    small_blocks(100)
    got = tables.read_csv_table(spark, str(tmp_path / "t.csv"), SCHEMA).orderBy("n").collect()
    assert [tuple(r) for r in got] == rows


def test_empty_lines_are_no_records(spark, tmp_path, small_blocks):
    (tmp_path / "t.csv").write_bytes(b'a,b,n\n\n\r\nx,"\n\n",1\n\n"",y,2\n\nz,"open\n')
    small_blocks(4)
    got = sorted((r.number, r.record) for r in records.read_records(spark, str(tmp_path / "t.csv")).collect())
    assert got == [(0, "a,b,n"), (1, 'x,"\n\n",1'), (2, '"",y,2'), (3, 'z,"open')]
    (tmp_path / "none.csv").write_bytes(b"")
    assert records.read_records(spark, str(tmp_path / "none.csv")).count() == 0


def test_several_files_are_numbered_apart(spark, tmp_path, small_blocks):
    folder = tmp_path / "t"
    folder.mkdir()
    for n in range(3):
        written(folder / f"p{n}.csv", [("x\ny", str(n), at) for at in range(5)])
    small_blocks(16)
    got = tables.read_csv_table(spark, str(folder), SCHEMA).collect()
    assert sorted((r.b, r.n) for r in got) == [(str(n), at) for n in range(3) for at in range(5)]
    with pytest.raises(ValueError, match="several files"):
        tables.read_rules_table(spark, str(folder))


def test_a_large_file_is_read_by_several_tasks(spark, tmp_path, small_blocks):
    path = tmp_path / "large.csv"
    with open(path, "w", newline="") as out:
        writer = csv.writer(out, lineterminator="\n")
        writer.writerow(("a", "b", "n"))
        text = "a value with \"quotes\", commas\nand line ends " * 40
        writer.writerows((f"{n}\n{text}", "y", n) for n in range(11_000))
    assert path.stat().st_size > 20_000_000
    small_blocks(3 << 20)
    assert records._lines(spark, str(path)).rdd.getNumPartitions() > 5
    got = tables.read_csv_table(spark, str(path), SCHEMA)
    found = got.select(F.count("*"), F.sum("n"), F.count_if(F.length("a") == F.length(F.lit(text)) + F.length(F.col("n").cast("string")) + 1)).first()
    assert tuple(found) == (11_000, sum(range(11_000)), 11_000)


def test_rules_keep_their_order_over_blocks(spark, tmp_path, small_blocks):
    path = tmp_path / "rules.csv"
    with open(path, "w", newline="") as out:
        writer = csv.writer(out, lineterminator="\n")
        writer.writerow(("pattern", "custodian", "source_note"))
        writer.writerows((f"p{n}/*", f"c{n}", "a note\nof two lines") for n in range(60))
    small_blocks(300)
    got = tables.read_rules_table(spark, str(path)).orderBy("rule_order").collect()
    assert [tuple(r) for r in got] == [(n, f"p{n}/*", f"c{n}") for n in range(60)]
