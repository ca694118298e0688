"""A file collection derived from a table of documents, and the files themselves.

Gives every operator real work on tables that hold no files: each document
becomes a file whose name, folder, dates and author follow from its row.
"""

from __future__ import annotations

import datetime as dt
import io
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold import schemas
from ledgerfold.constants import UNASSIGNED
from ledgerfold.functions.content import author_or_unassigned, content_hash, true_type
from ledgerfold.functions.paths import manifest_path, suffix
from ledgerfold.operators.classify import classify_keyword
from ledgerfold.sources.batches import bound_batches, small_parts
from ledgerfold.sources.staging import new_store_location, stage
from ledgerfold.sources.stores import canonical, open_store, write_file

AS_OF = dt.date(2026, 7, 21)
COLLECTION = "corpus"
ROOT = "/collections/corpus"
ADDED = 1_000_000_000_000  # identifiers of files that are no documents start here
OUT = "/organized"

# Words that speak for a language; the labels of the derived collection.
LANGUAGE_WORDS = {
    "de": ("der", "die", "und", "von"),
    "en": ("the", "and", "of", "to"),
    "es": ("el", "los", "del", "y"),
    "fr": ("et", "le", "les", "est"),
}
LANGUAGES = (*LANGUAGE_WORDS, "other")

# Ordered custodian rules of the derived collection: the first match wins.
CUSTODIAN_RULES = [
    ("Reports/Archive/*", "Archive Desk"),
    ("*.zip", "Backup Desk"),
    ("Invoices/*", "Accounts"),
    ("Contr?cts/*", "Legal"),
    ("[!x]orrespondence/*", "Mail Room"),
    ("REPORTS/*", "Operations"),
    ("*/doc_[0-4]*_v2.txt", "Author src3"),
    ("Site Photos/[a-c]*", "Field Tablet"),
]

_DERIVED = {
    "body": "coalesce(text, '')",
    "folder": """CASE doc_id % 8
        WHEN 0 THEN 'Invoices/' WHEN 1 THEN 'Contracts/' WHEN 2 THEN 'Correspondence/'
        WHEN 3 THEN 'Reports/' WHEN 4 THEN 'Site Photos/'
        WHEN 5 THEN 'Old Files/2019 archive/deep/nested/' WHEN 6 THEN '' ELSE 'Reports/Archive/' END
        || CASE WHEN doc_id % 17 = 8 THEN concat('b', doc_id, '/') ELSE '' END""",
    "name": """CASE doc_id % 17
        WHEN 0 THEN concat('Copy of doc_', doc_id, '.txt') WHEN 1 THEN concat('doc_', doc_id, ' (1).txt')
        WHEN 2 THEN concat('doc_', doc_id, ' - Copy.txt') WHEN 3 THEN concat('doc_', doc_id - 1, '_v2.txt')
        WHEN 4 THEN concat('doc_', doc_id, ' FINAL.txt') WHEN 5 THEN concat('scan_', doc_id, '.pdf')
        WHEN 6 THEN concat('doc_', doc_id, '.TXT') WHEN 7 THEN concat('~$doc_', doc_id, '.docx')
        WHEN 8 THEN 'Thumbs.db' WHEN 9 THEN concat('doc_', doc_id, '.zip')
        WHEN 10 THEN concat('doc_', doc_id, '!!.txt') ELSE concat('doc_', doc_id, '.txt') END""",
    "day": """CASE WHEN doc_id % 101 = 0 THEN DATE'1980-05-12' WHEN doc_id % 103 = 0 THEN DATE'2031-01-15'
        ELSE date_add(DATE'2026-01-01', CAST(doc_id % 180 AS INT)) END""",
    "raw_author": "CASE WHEN doc_id % 5 = 0 THEN ' ' ELSE concat(' Author ', source) END",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_empty_files(docs: DataFrame) -> DataFrame:
    """The documents, and an empty one beside every 97th of them."""
    names = {"doc_id": F.col("doc_id") + ADDED, "text": F.lit("")}
    added = docs.where("doc_id % 97 = 0").select("lang", "source", *[v.alias(c) for c, v in names.items()])
    return docs.select("doc_id", "lang", "source", "text").unionByName(added)


def derived_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest columns plus doc_id, lang, source and the text in `body`; no shuffle."""
    return (
        with_empty_files(table(spark, sf_dir, "documents"))
        .selectExpr("doc_id", "lang", "source", *[f"{sql} AS {c}" for c, sql in _DERIVED.items()])
        .select(
            "doc_id",
            "lang",
            "source",
            manifest_path(F.lit(COLLECTION), F.concat("folder", "name")).alias("path"),
            "name",
            suffix(F.col("name")).alias("extension"),
            true_type(F.col("body").cast("binary")).alias("true_type"),
            F.octet_length("body").cast("bigint").alias("size_bytes"),
            content_hash(F.col("body")).alias("sha256"),
            F.lit(None).cast("timestamp_ntz").alias("created"),
            F.col("day").cast("timestamp_ntz").alias("modified"),
            author_or_unassigned(F.col("raw_author")).alias("author"),
            F.lit(ROOT).alias("collection_root"),
            "body",
        )
    )


def language_hint() -> Column:
    return F.when(F.col("doc_id") % 29 == 0, "en").otherwise(F.col("lang"))


class Derived:
    """Stored manifest and classifications of the derived collection.

    Both come from one scan of the documents and are stored without the text,
    so that rules which look at the manifest several times never hash again.
    Without labels the documents are only hashed.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, labels: bool = True):
        files = derived_files(spark, sf_dir)
        kept = [c for c in schemas.MANIFEST_COLUMNS if c not in ("path", "name")]
        if labels:
            files = classify_keyword(
                files,
                LANGUAGE_WORDS,
                text="body",
                hint=language_hint(),
                keep=[*kept, "doc_id", "lang"],
            )
        self.rows = stage(files.drop("body"), "derived")
        self.manifest = self.rows.select(*schemas.MANIFEST_COLUMNS)
        self.classifications = self.rows.select(*schemas.CLASSIFICATION_COLUMNS) if labels else None

    @property
    def seeded(self) -> DataFrame:
        """Errors planted by construction, plus a type that no rule owns."""
        doc = F.col("doc_id")
        naming = (doc % 17).isin(0, 1, 2, 4, 5, 6, 10)
        planted = {
            "zero-byte": doc >= ADDED,
            "date-anomaly": (doc % 101 == 0) | (doc % 103 == 0),
            "junk-file": (doc % 17).isin(7, 8),
            "archive": doc % 17 == 9,
            "deep-nesting": doc % 8 == 5,
            # Copies of one document are planted under the wrong type where the
            # language is Spanish, so that some planted errors are missed.
            "exact-duplicate": (F.col("lang") == "es") & naming,
            "lost-page": (F.col("lang") == "es") & (doc % 17 == 7),
            "naming-violation": naming,
        }
        kinds = F.array(*[F.when(holds, F.lit(kind)) for kind, holds in planted.items()])
        return self.rows.select(F.explode(F.array_compact(kinds)).alias("type"), "path")

    @property
    def truth(self) -> DataFrame:
        """Accepted labels by path; NULL where nothing can be read."""
        doc, lang = F.col("doc_id"), F.col("lang")
        accepted = F.when(
            doc < ADDED, F.when(doc % 13 == 0, F.array(lang, F.lit("other"))).otherwise(F.array(lang))
        )
        return self.rows.select("path", accepted.alias("accepted"))


# --- real files --------------------------------------------------------------


def write_collection(files: DataFrame) -> str:
    """Write rows (path, content or body, modified) as files; returns the collection root.

    The files go to a new folder in the shared folder of the session.
    """
    home = canonical(new_store_location(files.sparkSession, "files"))
    content = F.col("content") if "content" in files.columns else F.col("body").cast("binary")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in small_parts(batches, "content"):
            times = rows.column("modified").cast(pa.timestamp("ns")).cast(pa.int64())
            for path, content, modified in zip(rows.column("path"), rows.column("content"), times):
                store, place = open_store(f"{home}/{path.as_py()}")
                write_file(store, place, [content.as_py()], modified.as_py())
            yield pa.RecordBatch.from_arrays([pa.array([len(rows)], pa.int64())], names=["files"])

    rows = files.select("path", content.alias("content"), "modified")
    bound_batches(files.sparkSession)
    stage(rows.mapInArrow(write, "files BIGINT"), "written")
    return f"{home}/{COLLECTION}"


def office_files(files: DataFrame) -> DataFrame:
    """The derived files as text, Word or Excel documents in turn: adds `content`."""
    kinds = F.array(F.lit(".txt"), F.lit(".docx"), F.lit(".xlsx"))
    extension = F.element_at(kinds, (F.col("doc_id") % 3 + 1).cast("int"))
    author = F.when(F.col("author") == UNASSIGNED, "").otherwise(F.col("author"))
    rows = files.select("path", extension.alias("extension"), author.alias("author"), "body")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in small_parts(batches, "body"):
            packed = [_package(e.as_py(), b.as_py(), a.as_py()) for e, b, a in zip(part["extension"], part["body"], part["author"])]
            yield pa.RecordBatch.from_arrays(
                [part["path"], part["extension"], pa.array(packed, pa.binary())], names=["path", "extension", "content"]
            )

    packed = rows.mapInArrow(pack, "path STRING, extension STRING, content BINARY")
    return packed.withColumn("true_type", true_type(F.col("content")))


_WORD_NS = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
_SHEET_NS = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_REL_NS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE_REL_NS = "http://schemas.openxmlformats.org/package/2006/relationships"
_CORE_NS = "http://schemas.openxmlformats.org/package/2006/metadata/core-properties"


def _package(extension: str, text: str, author: str) -> bytes:
    """A minimal file of the given kind holding the text, line by line, and the author."""
    if extension == ".txt":
        return text.encode()
    lines = [escape(line, {"\r": "&#13;"}) for line in text.split("\n")]
    core = (
        f'<c:coreProperties xmlns:c="{_CORE_NS}" xmlns:dc="http://purl.org/dc/elements/1.1/">'
        f"<dc:creator>{escape(author)}</dc:creator></c:coreProperties>"
    )
    if extension == ".docx":
        body = "".join(f'<w:p><w:r><w:t xml:space="preserve">{x}</w:t></w:r></w:p>' for x in lines)
        parts = {"word/document.xml": f'<w:document xmlns:w="{_WORD_NS}"><w:body>{body}</w:body></w:document>'}
    else:
        rows = "".join(
            f'<row r="{n}"><c r="A{n}" t="inlineStr"><is><t xml:space="preserve">{x}</t></is></c></row>'
            for n, x in enumerate(lines, 1)
        )
        parts = {
            "xl/workbook.xml": f'<workbook xmlns="{_SHEET_NS}" xmlns:r="{_REL_NS}"><sheets>'
            '<sheet name="s" sheetId="1" r:id="rId1"/></sheets></workbook>',
            "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{_PACKAGE_REL_NS}">'
            '<Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>',
            "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{_SHEET_NS}"><sheetData>{rows}</sheetData></worksheet>',
        }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, xml in {**parts, "docProps/core.xml": core}.items():
            archive.writestr(name, xml)
    return out.getvalue()
