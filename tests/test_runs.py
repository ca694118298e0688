"""Answers by content, tables that become visible together, addresses as rows."""

import json
import posixpath

import pytest
from pyspark.sql import functions as F

from ledgerfold.functions.paths import normal_path
from ledgerfold.operators import classify, organize
from ledgerfold.sources import collection, snapshots
from ledgerfold.sources.staging import new_location

LABELS = ("long", "short")


def answering(folder, broken_from=None):
    """A model that notes every text it is asked, and breaks once it has seen some number of them."""

    def predict(texts):
        import os
        import uuid

        if broken_from is not None and len(os.listdir(folder)) >= broken_from:
            raise classify.ModelUnavailable("gone")
        replies = []
        for text in texts:
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as note:
                note.write(text)
            label = "long" if len(text) > 40 else "short"
            replies.append(ValueError("odd") if "odd" in text else json.dumps({"label": label, "confidence": 0.9, "reason": text[:5]}))
        return replies

    return predict


def asked(folder):
    return sorted(note.read_text() for note in folder.iterdir())


def files_of(spark, texts):
    rows = [(f"c/{at}", str(at), text) for at, text in enumerate(texts)]
    return spark.createDataFrame(rows, "path string, name string, text string").repartition(4)


def test_copies_are_asked_once(spark, tmp_path):
    texts = [f"this text is number {n % 7}, in full" for n in range(300)] + [None, "", "short", "an odd text with no answer to it"] * 3
    texts += ["the text of a third of all the files here"] * 150
    folder, store = tmp_path / "asked", new_location(spark, "answers")
    folder.mkdir()
    files = files_of(spark, texts).withColumn("extra", F.lit(1))
    found = classify.classify_batch(files, answering(str(folder)), LABELS, store=store, keep=("extra",))
    plain = tmp_path / "plain"
    plain.mkdir()
    expected = classify.classify_batch(files, answering(str(plain)), LABELS, keep=("extra",))
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
    assert asked(folder) == sorted({t for t in texts if t and len(t) >= 20})
    again = classify.classify_batch(files, answering(str(folder), 0), LABELS, store=store)
    assert again.count() == len(texts) and len(asked(folder)) == 9


def test_a_broken_run_goes_on_where_it_stopped(spark, tmp_path):
    texts = spark.createDataFrame([(f"text number {n} of the collection",) for n in range(60)] * 3, "text string")
    folder, store = tmp_path / "asked", new_location(spark, "answers")
    folder.mkdir()
    with pytest.raises(Exception, match="gone"):
        classify.stored_answers(texts, answering(str(folder), 25), store, round_texts=10)
    kept = classify.read_answers(spark, store).count()
    assert 20 <= kept < 60
    before = asked(folder)
    found = classify.stored_answers(texts, answering(str(folder)), store, round_texts=10)
    assert found.count() == 60
    # What finished rounds hold is not asked again.
    later = len(asked(folder)) - len(before)
    assert later == 60 - kept
    none = texts.where("text = ''")
    assert classify.stored_answers(none, answering(str(folder), 0), new_location(spark, "answers")).count() == 0


# --- snapshots ------------------------------------------------------------------------------------------------


def test_a_broken_run_shows_the_earlier_tables(spark, tmp_path):
    place = str(tmp_path / "run")
    with pytest.raises(snapshots.NoSnapshot):
        snapshots.open_snapshot(spark, place)
    one, two = spark.range(5), spark.range(7).select(F.col("id").alias("odd name"), F.lit(None).cast("timestamp_ntz").alias("t"))
    first = snapshots.write_snapshot(spark, place, {"a": one, "b": two})
    broken = spark.range(3).select(F.raise_error(F.lit("lost")).alias("x"))
    with pytest.raises(Exception, match="lost"):
        snapshots.write_snapshot(spark, place, {"a": spark.range(99), "b": broken})
    now = snapshots.open_snapshot(spark, place)
    assert now == first and now.table("a").count() == 5 and now.table("b").schema.simpleString() == two.schema.simpleString()
    second = snapshots.write_snapshot(spark, place, {"a": spark.range(1)})
    assert now.table("a").count() == 5 and snapshots.open_snapshot(spark, place).table("a").count() == 1
    assert snapshots.open_snapshot(spark, place, first.number).table("b").count() == 7
    with pytest.raises(snapshots.NoSnapshot, match="no table b"):
        second.table("b")
    with pytest.raises(snapshots.NoSnapshot, match="version 9"):
        snapshots.open_snapshot(spark, place, 9)


def test_runs_that_commit_at_once_get_two_numbers(tmp_path, monkeypatch):
    place = str(tmp_path / "run")
    assert snapshots._commit(place, {"version": "a", "schemas": {}}) == 1
    monkeypatch.setattr(snapshots, "_numbers", lambda location: [])  # neither saw the other
    assert snapshots._commit(place, {"version": "b", "schemas": {}}) == 2
    assert sorted(f.name for f in (tmp_path / "run" / "commits").iterdir()) == ["0000000001.json", "0000000002.json"]


# --- addresses ------------------------------------------------------------------------------------------------


def test_paths_are_normal(spark):
    given = ["/a/b", "/a//b/", "/a/./b", "/a/../b", "/../a", "a/../..", "..", "../a/..", "", ".", "/", "/..", "a/b/../../..", "/a/b/../../../c", None]
    rows = spark.createDataFrame([(n, p) for n, p in enumerate(given)], "n int, p string")
    found = [r.x for r in rows.select("n", normal_path(F.col("p")).alias("x")).orderBy("n").collect()]
    assert found == [None if p is None else posixpath.normpath(p) for p in given]


def test_outputs_as_rows_agree_with_the_refusal(spark):
    pairs = [(r, o) for r in ("/data/c", "/data/x/../c", "/", "c") for o in ("/data/c", "/data/c/out", "/data", "/", "/data/c-out", "c/out", "x/../c", "/data/c/..")]
    rows = spark.createDataFrame(pairs + [(None, "/a"), ("/a", None)], "collection_root string, out_root string")
    for r in organize.output_verdicts(rows).collect():
        if r.collection_root is None or r.out_root is None:
            assert r.verdict == "no address"
            continue
        try:
            organize.refuse_unsafe_output(r.collection_root, r.out_root)
            refused = "ok"
        except organize.UnsafeOutput as error:
            refused = "inside the collection" if "inside" in str(error) else "around the collection"
        assert r.verdict == refused, r


def test_addresses_of_collections(spark):
    wanted = {
        "/data/c": "ok", "file:///data/c": "ok", "data": "ok", "/": "the root of a store", "file:///": "the root of a store",
        "s3a://bucket": "the root of a store", "s3a://bucket/": "the root of a store", "S3A://bucket/key": "ok", "hdfs://host/a/b": "ok",
        "http://host/a": "no file system is known for it", "dbfs:/x": "no file system is known for it", " ": "no address", "": "no address", "/data/a:b": "ok",
    }
    rows = spark.createDataFrame([(a,) for a in wanted], "location string")
    assert {r.location: r.verdict for r in collection.intake_verdicts(rows).collect()} == wanted


def test_all_clashes_are_stored(spark):
    plan = spark.createDataFrame([(f"/out/{n % 10}", f"c/{n:02}") for n in range(40)], "dest string, path string")
    with pytest.raises(organize.CollisionError) as refused:
        organize.refuse_collisions(plan)
    place = str(refused.value).split("All are in ")[1].split(", as in")[0]
    assert spark.read.parquet(place).count() == 30 and str(refused.value).startswith("30 file(s)")


def test_listing_gives_the_times_of_a_scan(spark, tmp_path):
    root = tmp_path / "c"
    root.mkdir()
    for n in range(5):
        (root / f"f{n}").write_text("x")
    listed, scanned = collection.list_inventory(spark, str(root)), collection.scan_collection(spark, str(root))
    columns = ["path", "size_bytes", "created", "modified", "collection_root"]
    assert sorted(map(str, listed.select(*columns).collect())) == sorted(map(str, scanned.select(*columns).collect()))
