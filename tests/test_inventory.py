"""Listing, splitting and filtering a collection; copies in two phases."""

import os
import shutil

import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from ledgerfold.operators import organize
from ledgerfold.sources import collection, copies, inventory
from ledgerfold.sources.staging import new_store_location
from ledgerfold.sources.stores import write_file


def listing_of(spark, sizes):
    rows = [(name, size, None, None) for name, size in sizes]
    return spark.createDataFrame(rows, "inner_path string, size_bytes long, modified timestamp_ntz, created timestamp_ntz")


# --- listing --------------------------------------------------------------------------------------------------


def test_one_flat_folder_is_listed_by_several_tasks(spark, tmp_path, monkeypatch):
    flat = tmp_path / "c" / "flat"
    flat.mkdir(parents=True)
    for n in range(100_000):
        (flat / f"f{n}").touch()
    (flat / "sub").mkdir()
    (flat / "sub" / "inner.txt").write_text("x")
    levels = []
    stored = collection.stage
    monkeypatch.setattr(collection, "stage", lambda df, label: levels.append(stored(df, label)) or levels[-1])
    found = collection.list_files(spark, str(tmp_path / "c"))
    assert found.count() == 100_001 and found.select("inner_path").distinct().count() == 100_001
    tasks = [level.where("shares = 0").select("_metadata.file_path").distinct().count() for level in levels]
    assert max(tasks) > 1
    most = levels[tasks.index(max(tasks))].where("shares = 0").groupBy("_metadata.file_path").count().agg(F.max("count")).first()[0]
    assert most < 60_000


def test_shares_list_what_one_task_lists(spark, tmp_path, monkeypatch):
    for n in range(300):
        folder = tmp_path / "c" / ("" if n % 3 else f"d{n % 2}")
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"é{n}.txt").write_text(str(n))
    (tmp_path / "c" / "link").symlink_to(tmp_path / "c" / "é1.txt")
    whole = sorted(tuple(r) for r in collection.list_files(spark, str(tmp_path / "c")).collect())
    monkeypatch.setattr(collection, "NAMES_PER_TASK", 7)
    assert sorted(tuple(r) for r in collection.list_files(spark, str(tmp_path / "c")).collect()) == whole
    assert len(whole) == 301


# --- splits ---------------------------------------------------------------------------------------------------


def test_splits_hold_about_as_many_bytes(spark):
    sizes = [(f"a/{n:05}", 10) for n in range(2000)] + [("b/big", 50_000)] + [(f"c/{n:05}", 1000) for n in range(50)] + [("d", None)]
    split = inventory.with_splits(listing_of(spark, sizes).repartition(4), split_bytes=5000, open_bytes=0)
    rows = {r.inner_path: r.split for r in split.collect()}
    assert len(rows) == len(sizes)
    ordered = [rows[name] for name, _ in sorted(sizes)]
    assert ordered == sorted(ordered)
    held = {}
    for name, size in sizes:
        held.setdefault(rows[name], []).append(size or 0)
    assert all(sum(h) <= 5000 + max(h) for h in held.values())
    assert inventory.with_splits(listing_of(spark, [])).count() == 0


def test_conditions_keep_files_closed(spark, tmp_path):
    root = tmp_path / "c"
    root.mkdir()
    for n in range(40):
        (root / f"f{n:02}.txt").write_bytes(b"x" * n)
    small = collection.read_inventory(spark, str(root), F.col("size_bytes") > 7)
    named = collection.read_inventory(spark, str(root), F.expr("inner_path LIKE 'f1%' AND size_bytes IN (11, 12, 30)"))
    late = collection.scan_collection(spark, str(root), F.expr("modified > timestamp_ntz'2000-01-01 00:00:00' AND size_bytes = 3"))
    every = collection.read_inventory(spark, str(root))
    (root / "f07.txt").unlink()  # listed, and gone when it is opened
    assert small.count() == 32 and sorted(r.size_bytes for r in named.collect()) == [11, 12]
    assert [(r.path, r.size_bytes) for r in late.collect()] == [("c/f03.txt", 3)]
    with pytest.raises(Exception, match="f07.txt"):
        every.select("sha256").collect()


def test_one_query_leaves_the_next_alone(spark, tmp_path):
    root = tmp_path / "c"
    root.mkdir()
    for n in range(10):
        (root / f"f{n}").write_bytes(b"x" * n)
    read = collection.read_inventory(spark, str(root))
    assert read.where("length(inner_path) = 2 AND size_bytes % 2 = 0 AND author IS NOT NULL").count() == 5
    assert read.where("size_bytes > 7").count() == 2 and len(read.select("sha256").collect()) == 10
    assert read.where("size_bytes = 2 OR inner_path = 'f9'").count() == 2


def test_reader_has_one_partition_a_split(spark, tmp_path):
    listing = listing_of(spark, [(f"f{n}", 100) for n in range(50)])
    location, splits = inventory.store_splits(listing, split_bytes=100 * 10 + inventory.OPEN_BYTES * 10)
    assert splits == 5
    reader = inventory.InventoryReader({"root": "/none", "listing": location, "splits": str(splits)})
    assert len(reader.partitions()) == 5
    names = [name for part in reader.partitions() for b in reader.listed(part.number).to_batches() for name in b.column(0).to_pylist()]
    assert sorted(names) == sorted(f"f{n}" for n in range(50)) and len(names) == 50


# --- copies ---------------------------------------------------------------------------------------------------


@pytest.fixture
def planned(spark, tmp_path):
    root = tmp_path / "c"
    root.mkdir()
    for n in range(12):
        (root / f"f{n}").write_text(f"text {n}")
    manifest = collection.scan_collection(spark, str(root))
    plan = organize.copy_plan(manifest.withColumn("bucket", F.lit("b")), str(tmp_path / "out"))
    return plan.select("dest", "path", "modified", "size_bytes").orderBy("path").collect(), str(root), str(tmp_path / "out")


def writer_for(spark, root, out):
    log = new_store_location(spark, "log")
    return copies.CopyWriter({"collection_root": root, "planned_root": out, "out_root": out, "log": log}), log


def test_a_repeated_task_is_logged_once(spark, planned):
    rows, root, out = planned
    writer, log = writer_for(spark, root, out)
    writer.write(iter(rows[:6]))  # this attempt is lost between its write and the commit
    again = writer.write(iter(rows[:6]))
    other = writer.write(iter(rows[6:]))
    with pytest.raises(copies.NotCommitted):
        copies.read_copies(spark, log)
    writer.commit([again, other])
    logged = copies.read_copies(spark, log).collect()
    assert sorted(r.path for r in logged) == sorted(r.path for r in rows) and len(logged) == 12
    names = sorted(os.listdir(f"{out}/b"))
    assert names == sorted(f"f{n}" for n in range(12))  # no unfinished file, none doubled


def test_a_task_killed_while_it_writes_leaves_nothing_torn(spark, planned):
    rows, root, out = planned
    writer, log = writer_for(spark, root, out)

    class Killed(BaseException):
        pass

    def until_killed():
        yield from rows[:3]
        raise Killed

    with pytest.raises(Killed):
        writer.write(until_killed())
    done = writer.write(iter(rows))
    writer.commit([done])
    assert copies.read_copies(spark, log).count() == 12
    assert all(open(f"{out}/b/f{n}").read() == f"text {n}" for n in range(12))


def test_an_aborted_job_lists_nothing(spark, planned):
    rows, root, out = planned
    writer, log = writer_for(spark, root, out)
    done = writer.write(iter(rows))
    writer.abort([done, None])
    with pytest.raises(copies.NotCommitted):
        copies.read_copies(spark, log)


def test_a_missing_original_stops_the_run(spark, tmp_path):
    root = tmp_path / "c"
    root.mkdir()
    (root / "a").write_text("a")
    (root / "b").write_text("b")
    manifest = collection.scan_collection(spark, str(root))
    plan = organize.copy_plan(manifest.withColumn("bucket", F.lit("x")), str(tmp_path / "out"))
    (root / "b").unlink()
    with pytest.raises(Exception, match="No such file|not found|b"):
        copies.copy_files(plan, str(tmp_path / "out"))
    shutil.rmtree(tmp_path / "out", ignore_errors=True)
    (root / "b").write_text("b")
    log = copies.copy_files(plan, str(tmp_path / "out"))
    assert sorted(r.path for r in log.collect()) == ["c/a", "c/b"]


def test_stores_that_keep_no_times_say_so():
    store = fs._MockFileSystem()
    assert write_file(store, "a/b", [b"one"], 1_000_000_000) is False
    assert [i.path for i in store.get_file_info(fs.FileSelector("a"))] == ["a/b"]
    # A second attempt leaves the equal file of the first.
    write_file(store, "a/b", [b"one"])
    assert [i.path for i in store.get_file_info(fs.FileSelector("a"))] == ["a/b"]

    def broken():
        yield b"half"
        raise OSError("lost")

    with pytest.raises(OSError):
        write_file(store, "a/c", broken())
    assert [i.path for i in store.get_file_info(fs.FileSelector("a"))] == ["a/b"]


def test_log_parts_are_typed(spark, tmp_path):
    writer, log = writer_for(spark, str(tmp_path), str(tmp_path / "out"))
    writer.commit([writer.write(iter([]))])
    found = copies.read_copies(spark, log)
    assert found.count() == 0 and found.columns == ["dest", "path", "sha256", "size_bytes", "time_kept"]
    assert copies._table([]).schema == copies._LOGGED
