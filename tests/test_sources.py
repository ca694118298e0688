"""Reading, writing, refusing."""

import json
import os

import pytest
from pyspark.sql import functions as F

from ledgerfold.sources.stores import open_store
from ledgerfold import schemas
from ledgerfold.operators import organize
from ledgerfold.plans.derived import _package
from ledgerfold.sources import answer_key, collection, copies, staging, tables
from ledgerfold.sources.documents import as_file, document_author, document_text
from tests import golden


def manifest_of(spark, rows):
    return spark.createDataFrame(
        [(p, p.rsplit("/", 1)[-1], e, "text", 1, "h", None, None, a, "/data/c") for p, e, a in rows],
        schemas.MANIFEST,
    ).withColumn("modified", F.lit("2026-01-02 03:04:05").cast("timestamp_ntz"))


AWKWARD = [
    ('c/say "hi", they said.txt', ".txt", ""),
    ("c/two\nlines.txt", ".txt", " padded "),
    ("c/comma,and;more.10", ".10", "Ann\tTab"),
    ("c/backslash\\n.txt", ".txt", "\\"),
    ("c/quote\"\"s'.txt", "", '"'),
]


def test_csv_keeps_every_character(spark, tmp_path):
    manifest = manifest_of(spark, AWKWARD)
    tables.write_csv_table(manifest, str(tmp_path / "m"), schemas.MANIFEST)
    back = tables.read_csv_table(spark, str(tmp_path / "m"), schemas.MANIFEST)
    assert back.dtypes == manifest.dtypes
    assert sorted(back.collect()) == sorted(manifest.collect())
    with pytest.raises(Exception, match="(?i)exists"):
        tables.write_csv_table(manifest, str(tmp_path / "m"), schemas.MANIFEST)


def test_tables_keep_their_columns(spark, tmp_path):
    manifest = manifest_of(spark, AWKWARD)
    shuffled = manifest.select(*reversed(manifest.columns))
    stored = tables.write_manifest(shuffled, str(tmp_path / "m"))
    assert stored.columns == schemas.MANIFEST_COLUMNS and stored.count() == 5
    record = spark.read.json(str(tmp_path / "m-collection"))
    assert [r.collection_root for r in record.collect()] == ["/data/c"]


def test_rules_table_keeps_its_order(spark, tmp_path):
    file = tmp_path / "rules.csv"
    lines = [f"p{n}/*,who {n},note" for n in range(50)]
    file.write_text("\n".join(["pattern,custodian,source_note", *lines]) + "\n")
    rows = tables.read_rules_table(spark, str(file)).collect()
    assert [tuple(r) for r in rows] == [(n, f"p{n}/*", f"who {n}") for n in range(50)]


def test_answer_key_of_one_object(spark, tmp_path):
    file = tmp_path / "key.json"
    file.write_text(json.dumps(golden.answer_key(), indent=2))
    key = answer_key.read_answer_key(spark, str(file), one_object=True)
    assert answer_key.seeded_errors(key).count() == sum(map(len, golden.SEEDED.values()))
    authors = {r.path: r.author for r in answer_key.expected_authors(key).collect()}
    assert sum(a == "Unassigned" for a in authors.values()) == 19
    unreadable = answer_key.accepted_labels(key).where("accepted IS NULL")
    assert unreadable.count() == 9


# --- collections -------------------------------------------------------------


def test_unusable_collections(tmp_path):
    with pytest.raises(collection.CollectionError, match="not found"):
        collection.resolve_collection(str(tmp_path / "nowhere"))
    (tmp_path / "file").write_text("x")
    with pytest.raises(collection.CollectionError, match="not found"):
        collection.resolve_collection(str(tmp_path / "file"))
    with pytest.raises(collection.CollectionError, match="root"):
        collection.resolve_collection("/")
    (tmp_path / "real").mkdir()
    (tmp_path / "link").symlink_to(tmp_path / "real")
    assert collection.resolve_collection(f"{tmp_path}/link/../real/") == str(tmp_path / "real")


def test_guard_on_the_collection(spark):
    one = manifest_of(spark, AWKWARD)
    assert collection.require_collection(one) == "/data/c"
    two = one.unionByName(one.withColumn("collection_root", F.lit("/data/d")))
    with pytest.raises(collection.CollectionError, match="found 2"):
        collection.require_collection(two)
    with pytest.raises(collection.CollectionError, match="found none"):
        collection.require_collection(one.where("false"))
    with pytest.raises(collection.CollectionError, match="not recorded"):
        collection.require_collection(one.withColumn("collection_root", F.lit("")))


def test_large_and_linked_files(spark, tmp_path):
    root = tmp_path / "c"
    (root / "sub").mkdir(parents=True)
    big = os.urandom(3 << 20)
    (root / "sub" / "big.bin").write_bytes(big)
    (root / "loop").symlink_to(root)
    rows = collection.scan_collection(spark, str(root)).collect()
    import hashlib

    assert [(r.path, r.size_bytes, r.sha256) for r in rows] == [
        ("c/sub/big.bin", len(big), hashlib.sha256(big).hexdigest())
    ]


def test_listing_takes_as_many_rounds_as_needed(spark, tmp_path, monkeypatch):
    wanted = set()
    for n in range(60):
        file = tmp_path / "c" / "/".join(f"d{n % k}" for k in range(1, 2 + n % 9)) / f"f{n}"
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(str(n))
        wanted.add(str(file.relative_to(tmp_path)))
    for limit in (1, 3, 64):
        monkeypatch.setattr(collection, "FOLDERS_PER_ROUND", limit)
        rows = collection.scan_collection(spark, str(tmp_path / "c")).collect()
        assert len(rows) == 60 and {r.path for r in rows} == wanted


def test_empty_collection(spark, tmp_path):
    (tmp_path / "c").mkdir()
    assert collection.scan_collection(spark, str(tmp_path / "c")).count() == 0


# --- outputs -----------------------------------------------------------------


def test_unsafe_outputs():
    for bad in ("/data/c", "/data/c/out", "/data/x/../c/out", "/data", "/"):
        with pytest.raises(organize.UnsafeOutput):
            organize.refuse_unsafe_output("/data/c", bad)
    organize.refuse_unsafe_output("/data/c", "/data/c-out")


def test_copies_need_a_new_folder(spark, tmp_path):
    root = tmp_path / "c"
    root.mkdir()
    (root / "a.txt").write_text("a")
    manifest = collection.scan_collection(spark, str(root))
    plan = organize.copy_plan(manifest.withColumn("bucket", F.lit("b")), str(tmp_path / "out"))
    log = copies.copy_files(plan, str(tmp_path / "out"), str(root))
    assert (tmp_path / "out" / "b" / "a.txt").read_text() == "a"
    assert os.stat(tmp_path / "out" / "b" / "a.txt").st_mtime == int(os.stat(root / "a.txt").st_mtime)
    (tmp_path / "d").mkdir()
    with pytest.raises(collection.CollectionError, match="another collection"):
        copies.copy_files(plan, str(tmp_path / "out3"), str(tmp_path / "d"))
    assert not (tmp_path / "out3").exists()
    assert [(r.path, r.size_bytes, r.time_kept) for r in log.collect()] == [("c/a.txt", 1, True)]
    with pytest.raises(organize.UnsafeOutput, match="leads outside"):
        copies.copy_files(plan, str(tmp_path / "other"))
    stray = plan.withColumn("dest", F.lit(f"{tmp_path}/out2/../c/a.txt"))
    with pytest.raises(organize.UnsafeOutput, match="leads outside"):
        copies.copy_files(stray, str(tmp_path / "out2"))
    with pytest.raises(organize.UnsafeOutput, match="exists"):
        copies.copy_files(plan, str(tmp_path / "out"), str(root))
    refs = copies.write_crossref(plan, str(tmp_path / "out"))
    assert refs.first().original_folder == ""
    assert (tmp_path / "crossref-out").is_dir()


def test_shared_folder_is_the_one_the_cluster_names(spark):
    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            named = {"spark.checkpoint.dir": "hdfs:///shared/", "spark.sql.warehouse.dir": "hdfs:///warehouse"}

            @classmethod
            def get(cls, key, default=None):
                return cls.named.get(key, default)

    assert staging.shared_folder(Session()) == "hdfs:///shared"
    del Session.conf.named["spark.checkpoint.dir"]
    assert staging.shared_folder(Session()) == "hdfs:///warehouse/checkpoints"


# --- documents ---------------------------------------------------------------


def test_text_by_true_type():
    words = "héllo\n & <tags>\ttab"
    assert document_text(as_file(words.encode()), "text", ".pdf") == words
    assert document_text(as_file(b"\xff\xfe"), "text", ".txt") == ""
    assert document_text(as_file(_package(".docx", words, "A")), "zip", ".DOCX") == words
    assert document_text(as_file(_package(".xlsx", words, "A")), "zip", ".xlsx") == words
    assert document_text(as_file(_package(".docx", words, "A")), "zip", ".zip") == ""
    assert document_text(as_file(b"PK\x03\x04broken"), "zip", ".docx") == ""
    assert document_text(as_file(b"\x89PNG"), "png", ".txt") == ""
    assert document_text(as_file(golden.pdf("One (1)\nTwo", "A")), "pdf", ".pdf", golden.READERS) == "One (1)\nTwo"
    assert document_text(as_file(golden.pdf("One", "A")), "pdf", ".pdf") == ""
    assert document_text(as_file(b"%PDF-1.4 broken"), "pdf", ".pdf", golden.READERS) == ""


def test_texts_of_contents(spark):
    rows = [("c/a", ".txt", "text", "héllo".encode()), ("c/b", ".txt", "text", b"\xff\xfe"), ("c/c", ".pdf", "pdf", golden.pdf("One", "Bo")),
            ("c/d", ".docx", "zip", _package(".docx", "w x", "Ann")), ("c/e", None, None, b"x"), ("c/f", ".png", "png", b"\x89PNG"), ("c/g", ".txt", "text", None)]
    files = spark.createDataFrame(rows, "path string, extension string, true_type string, content binary")
    texts = {r.path: r.text for r in collection.extract_text_from_content(files, golden.READERS).collect()}
    assert texts == {"c/a": "héllo", "c/b": "", "c/c": "One", "c/d": "w x", "c/e": "", "c/f": "", "c/g": ""}
    assert {r.text for r in collection.extract_text_from_content(files).where("path = 'c/c'").collect()} == {""}
    authors = {r.path: r.author for r in collection.extract_author_from_content(files.where("path < 'c/g'"), golden.READERS).collect()}
    assert authors["c/c"] == "Bo" and authors["c/d"] == "Ann" and authors["c/a"] == "Unassigned"


def test_sheet_cells():
    import io
    import zipfile

    package = io.BytesIO(_package(".xlsx", "", ""))
    sheet = (
        '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>'
        '<row r="1"><c r="A1" t="s"><v>1</v></c><c r="C1"><v>42000</v></c></row>'
        '<row r="3"><c r="B3"><v>1.5</v></c><c r="C3" t="b"><v>1</v></c></row></sheetData></worksheet>'
    )
    shared = (
        '<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
        "<si><t>no</t></si><si><r><t>mo</t></r><r><t>nth</t></r></si></sst>"
    )
    out = io.BytesIO()
    with zipfile.ZipFile(package) as old, zipfile.ZipFile(out, "w") as new:
        for name in old.namelist():
            new.writestr(name, sheet if "sheet1" in name else old.read(name))
        new.writestr("xl/sharedStrings.xml", shared)
    out.seek(0)
    assert document_text(out, "zip", ".xlsx") == "month | 42000\n1.5 | True"


def test_author_by_extension():
    assert document_author(as_file(_package(".docx", "x", " Ann ")), ".DOCX") == "Ann"
    assert document_author(as_file(_package(".xlsx", "x", "")), ".xlsx") == "Unassigned"
    assert document_author(as_file(golden.pdf("x", "Bo")), ".pdf", golden.READERS) == "Bo"
    assert document_author(as_file(golden.pdf("x", "Bo")), ".pdf") == "Unassigned"
    assert document_author(as_file(b"plain text"), ".pdf", golden.READERS) == "Unassigned"
    assert document_author(as_file(_package(".docx", "x", "Ann")), ".zip") == "Unassigned"


def test_a_failed_write_leaves_nothing(tmp_path):
    from ledgerfold.sources.stores import open_store, write_file

    def broken():
        yield b"half"
        raise OSError("lost")

    store, path = open_store(str(tmp_path / "a" / "file"))
    with pytest.raises(OSError, match="lost"):
        write_file(store, path, broken())
    assert list((tmp_path / "a").iterdir()) == []
    write_file(store, path, [b"whole"], 1_000_000_000)
    assert [f.read_bytes() for f in (tmp_path / "a").iterdir()] == [b"whole"]


def test_store_addresses():
    assert open_store("/data/a:b")[1] == "/data/a:b" and open_store("file:///data/x")[1] == "/data/x"
    for unknown in ("dbfs:/x", "wasbs://c@a/x", "http://h/x"):
        with pytest.raises(ValueError, match="no file system"):
            open_store(unknown)
    assert open_store("s3a://bucket/key?region=eu-west-1")[0].type_name == "s3"
