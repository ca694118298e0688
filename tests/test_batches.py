import pyarrow as pa
from pyspark.sql import functions as F

from ledgerfold.plans import derived
from ledgerfold.sources import batches, collection


def test_parts_are_bounded_by_rows_and_bytes():
    sizes = [1, 3 << 20, 2 << 20, 5 << 20, 0, None, *[10] * 1000]
    values = [None if n is None else b"x" * n for n in sizes]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(sizes))), pa.array(values, pa.binary())], names=["at", "content"])
    parts = list(batches.small_parts(iter([batch, batch.slice(0, 0)]), "content"))
    assert [at for part in parts for at in part["at"].to_pylist()] == list(range(len(sizes)))
    held = [[len(v or b"") for v in part["content"].to_pylist()] for part in parts]
    assert [len(part) for part in held] == [2, 1, 1, 256, 256, 256, 234]
    assert all(sum(part) <= batches.PART_BYTES or len(part) == 1 for part in held)


def test_contents_never_become_whole_frames(spark):
    rows = [(f"c/{n}.txt", ".txt", "", n, "x\n<é>" * n) for n in range(600)]
    files = spark.createDataFrame(rows, "path STRING, extension STRING, author STRING, doc_id LONG, body STRING").coalesce(1)
    packed = derived.office_files(files)
    read = collection.extract_text_from_content(packed)
    authors = collection.extract_author_from_content(packed)
    for df in (packed, read, authors):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "MapInPandas" not in plan and "MapInArrow" in plan
    got = {r.path: r.text for r in read.collect()}
    assert got == {path: body for path, *_, body in rows}
    assert authors.where(F.col("author") == "Unassigned").count() == 600


def test_texts_go_to_the_encoder_once(spark):
    from ledgerfold.llm import bpe
    from ledgerfold.llm.queries import codec

    docs = spark.createDataFrame([(1, "de", "ein Wort, zwei"), (2, "en", None)], "doc_id LONG, lang STRING, text STRING")
    made = codec()
    slim = bpe.round_trip_digests(spark, docs, made, keep=["doc_id"])
    whole = bpe.round_trip_digests(spark, docs, made)
    assert slim.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert whole.columns == ["doc_id", "lang", "text", *slim.columns[1:]]
    assert sorted(slim.collect()) == sorted(whole.drop("lang", "text").collect())
    plan = whole._jdf.queryExecution().optimizedPlan().toString()
    assert "__given" not in plan


def test_texts_go_to_workers_in_small_batches(spark):
    from ledgerfold.llm import bpe, language_id, simhash_dedup

    own = spark.conf.get(batches.SENT_LIMIT)
    docs = spark.range(0, 3000, 1, 1).selectExpr("id AS doc_id", "repeat('word ', 1000) AS text")
    empty = language_id.fit([])

    def sizes(found):
        for batch in found:
            yield pa.RecordBatch.from_arrays([pa.array([len(batch)], pa.int64())], names=["n"])

    try:
        for sent in (
            lambda: bpe._with_columns(docs, "text", [], lambda column: []),
            lambda: language_id.identify(spark, docs, empty),
            lambda: simhash_dedup.fingerprints(docs),
        ):
            spark.conf.set(batches.SENT_LIMIT, "64m")
            sent()
            held = [row.n for row in docs.mapInArrow(sizes, "n LONG").collect()]
            assert sum(held) == 3000 and max(held) * 5000 <= batches.SENT_BYTES * 1.1
        spark.conf.set(batches.SENT_LIMIT, "1m")
        batches.bound_batches(spark)
        assert spark.conf.get(batches.SENT_LIMIT) == "1m"
    finally:
        spark.conf.set(batches.SENT_LIMIT, own)


def test_files_are_written_from_small_batches(spark):
    own = spark.conf.get(batches.SENT_LIMIT)
    files = spark.createDataFrame([("corpus/a.txt", "x")], "path STRING, body STRING").withColumn("modified", F.lit("2026-01-02").cast("timestamp_ntz"))
    try:
        spark.conf.set(batches.SENT_LIMIT, "64m")
        derived.write_collection(files)
        assert spark.conf.get(batches.SENT_LIMIT) == str(batches.SENT_BYTES)
    finally:
        spark.conf.set(batches.SENT_LIMIT, own)
