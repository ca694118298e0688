"""A folder tree as a manifest: listed, hashed and sniffed by tasks, only ever read.

Spark's binaryFile source skips empty files and names that start with `.` or
`_`, and holds a file whole in memory, so the tree is read through Arrow's file
systems instead.
"""

from __future__ import annotations

import os
from collections import deque
from collections.abc import Iterator
from itertools import chain, islice
from zlib import crc32

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerfold import schemas
from ledgerfold.functions.content import true_type
from ledgerfold.functions.paths import address_verdict, file_name, manifest_path, suffix
from ledgerfold.sources import inventory
from ledgerfold.sources.batches import small_parts
from ledgerfold.sources.documents import Readers, as_file, document_author, document_text
from ledgerfold.sources.inventory import AUTHORED
from ledgerfold.sources.staging import stage
from ledgerfold.sources.stores import SCHEMES, birth_time_ns, canonical, is_link, open_store

TASK_FILES = 10_000
FOLDERS_PER_ROUND = 64
FOLDERS_PER_TASK = 256
NAMES_PER_TASK = 20_000
BATCH_CHARS = 4 << 20

# shares is 0 for a file, -1 for a folder not looked at, else the number of shares it is dealt out in.
_LISTED = "inner_path STRING, share INT, shares INT, size_bytes BIGINT, modified TIMESTAMP_NTZ, created TIMESTAMP_NTZ"


class CollectionError(ValueError):
    """The folder cannot be used as a collection, or is not the one expected."""


def resolve_collection(location: str) -> str:
    """Canonical root of a collection; it must be an existing folder, not a root."""
    root = canonical(location)
    store, path = open_store(root)
    if store.get_file_info(path).type != fs.FileType.Directory:
        raise CollectionError(f"collection folder not found: {location}")
    if "/" not in path.strip("/") and store.type_name != "local" or not path.strip("/"):
        raise CollectionError(f"a collection cannot be the root of a store: {location}")
    return root


def intake_verdicts(addresses: DataFrame, column: str = "location") -> DataFrame:
    """Rows with `verdict`: whether each address can be that of a collection, by its text alone."""
    return addresses.withColumn("verdict", address_verdict(F.col(column), SCHEMES))


def list_inventory(spark: SparkSession, location: str) -> DataFrame:
    """(path, size_bytes, created, modified, collection_root) of a folder's files, from listings alone."""
    root = resolve_collection(location)
    name = root.rstrip("/").rsplit("/", 1)[-1]
    return stage(
        list_files(spark, root).select(
            manifest_path(F.lit(name), F.col("inner_path")).alias("path"),
            "size_bytes",
            *[F.date_trunc("second", c).cast("timestamp_ntz").alias(c) for c in ("created", "modified")],
            F.lit(root).alias("collection_root"),
        ),
        "listed",
    )


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """All regular files below a root, hidden and empty ones too, listed in rounds.

    In a round every known folder is listed, and a limited number below it; the
    folders left over are dealt out anew. So small trees take a round or two,
    and no process sees the whole of a large one. A local folder of more than NAMES_PER_TASK
    names is dealt out in shares by a hash of the name: every share reads the names and looks
    at its own files alone. Other stores give a folder's names and sizes in one listing, which
    Arrow cannot begin in the middle, so there a folder stays with one task.
    """
    width = spark.sparkContext.defaultParallelism

    def infos(store: fs.FileSystem, folder: str, share: int, shares: int) -> Iterator[fs.FileInfo]:
        if store.type_name != "local":
            yield from store.get_file_info(fs.FileSelector(folder))
            return
        with os.scandir(folder) as names:
            own = (n.path for n in names if shares == 1 or crc32(os.fsencode(n.name)) % shares == share)
            while paths := list(islice(own, 1000)):
                yield from store.get_file_info(paths)

    def shares_of(store: fs.FileSystem, folder: str) -> int:
        if store.type_name != "local":
            return 1
        with os.scandir(folder) as names:
            return max(1, -(-sum(1 for _ in names) // NAMES_PER_TASK))

    def entries(store: fs.FileSystem, base: str, top: str, share: int, shares: int) -> Iterator[tuple]:
        waiting = deque([(top, share, shares)])
        for _ in range(FOLDERS_PER_ROUND):
            if not waiting:
                return
            inner, share, shares = waiting.popleft()
            folder = f"{base}/{inner}" if inner else base
            if not shares:
                shares = shares_of(store, folder)
                if shares > 1:
                    yield from ((inner, n, shares, 0, None, None) for n in range(shares))
                    continue
            for info in infos(store, folder, share, shares):
                place = f"{inner}/{info.base_name}" if inner else info.base_name
                if info.type == fs.FileType.File:
                    yield place, 0, 0, info.size, info.mtime_ns, birth_time_ns(store, info.path)
                elif info.type == fs.FileType.Directory and not is_link(store, info.path):
                    waiting.append((place, 0, 0))
        yield from ((inner, share, shares or -1, 0, None, None) for inner, share, shares in waiting)

    def below(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = open_store(root)
        for folders in batches:
            found = chain.from_iterable(
                entries(store, base, top, share, max(shares, 0))
                for top, share, shares in zip(folders["inner_path"], folders["share"], folders["shares"])
            )
            while rows := list(islice(found, TASK_FILES)):
                frame = pd.DataFrame(rows, columns=["inner_path", "share", "shares", "size_bytes", "modified", "created"])
                for field in ("modified", "created"):
                    frame[field] = pd.to_datetime(frame[field]).dt.floor("s")
                yield frame

    folders = spark.createDataFrame([("", 0, -1)], "inner_path STRING, share INT, shares INT")
    files, tasks = None, 1
    while True:
        level = stage(folders.repartition(tasks).mapInPandas(below, _LISTED), "listing")
        found = level.where("shares = 0").drop("share", "shares")
        files = found if files is None else files.unionByName(found)
        folders = level.where("shares <> 0").select("inner_path", "share", "shares")
        waiting = folders.count()
        if not waiting:
            return files
        # A share of a large folder is work for a task of its own.
        large = folders.where("shares > 1").count()
        tasks = max(min(width, waiting), -(-waiting // FOLDERS_PER_TASK), large)


def read_inventory(
    spark: SparkSession, location: str, keep: Column | None = None, readers: Readers | None = None
) -> DataFrame:
    """The files of a collection with what their bytes tell, read when the rows are asked for.

    `keep` is a condition on inner_path, size_bytes, modified and created; other files are not opened.
    `readers` read the authors of formats other than Word and Excel; see documents.py.
    """
    root = resolve_collection(location)
    listing = list_files(spark, root)
    return inventory.read_listing(spark, root, listing if keep is None else listing.where(keep), readers=readers)


def scan_collection(
    spark: SparkSession, location: str, keep: Column | None = None, readers: Readers | None = None
) -> DataFrame:
    """The manifest of a folder: one row per file, staged so that bytes are read once; the rest as above."""
    root = resolve_collection(location)
    name = root.rstrip("/").rsplit("/", 1)[-1]
    read = read_inventory(spark, root, keep, readers)
    file = file_name(F.col("inner_path"))
    manifest = read.select(
        manifest_path(F.lit(name), F.col("inner_path")).alias("path"),
        file.alias("name"),
        suffix(file).alias("extension"),
        true_type(F.col("head")).alias("true_type"),
        "size_bytes",
        "sha256",
        F.date_trunc("second", "created").cast("timestamp_ntz").alias("created"),
        F.date_trunc("second", "modified").cast("timestamp_ntz").alias("modified"),
        "author",
        F.lit(root).alias("collection_root"),
    ).select(*schemas.MANIFEST_COLUMNS)
    return stage(manifest, "manifest")


# --- text --------------------------------------------------------------------


def _readable_type(readers: Readers | None) -> Column:
    kind, ext = F.col("true_type"), F.lower("extension")
    return kind.isin("text", *(readers or ())) | ((kind == "zip") & ext.isin(".docx", ".xlsx"))


def _with_text(df: DataFrame, read, given: list[str], readable: Column) -> DataFrame:
    """Add `text` by running `read` on the given columns, over the readable rows only; the first of them tells a row's size."""
    kept = [f for f in df.schema if f.name != "content"]
    names = [f.name for f in kept]

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in small_parts(batches, given[0]):
            start, size, out = 0, 0, []
            for at, row in enumerate(zip(*[rows.column(c) for c in given]), 1):
                out.append(read(*[value.as_py() for value in row]))
                size += len(out[-1])
                # Long texts leave in small batches, so memory stays bounded.
                if size > BATCH_CHARS or at == len(rows):
                    columns = [rows.column(n).slice(start, at - start) for n in names]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(out, pa.string())], names=[*names, "text"])
                    start, size, out = at, 0, []

    readable = F.coalesce(readable, F.lit(False))
    unread = df.where(~readable).drop("content").withColumn("text", F.lit(""))
    schema = T.StructType([*kept, T.StructField("text", T.StringType())])
    return df.where(readable).mapInArrow(texts, schema).unionByName(unread)


def extract_text(manifest: DataFrame, readers: Readers | None = None) -> DataFrame:
    """Manifest rows with the text of their files, read from the collection root.

    `readers` read formats other than plain text, Word and Excel; see documents.py.
    """

    opened = {}  # per task: one file system per root

    def read(path: str, root: str, true_type: str, extension: str) -> str:
        if root not in opened:
            opened[root] = open_store(root)
        store, base = opened[root]
        with store.open_input_file(f"{base}/{path.split('/', 1)[1]}") as data:
            return document_text(data, true_type, extension, readers)

    return _with_text(manifest, read, ["path", "collection_root", "true_type", "extension"], _readable_type(readers))


def extract_text_from_content(files: DataFrame, readers: Readers | None = None) -> DataFrame:
    """As extract_text(), for rows that hold the bytes in a `content` column; plain text stays in the JVM."""
    plain = F.coalesce(F.col("true_type") == "text", F.lit(False))
    told = files.where(plain).withColumn("text", F.when(F.is_valid_utf8(F.col("content").cast("string")), F.col("content").cast("string")))
    rest = _with_text(
        files.where(~plain),
        lambda content, true_type, extension: document_text(as_file(content), true_type, extension, readers),
        ["content", "true_type", "extension"],
        _readable_type(readers),
    )
    return told.withColumn("text", F.coalesce("text", F.lit(""))).drop("content").unionByName(rest)


def extract_author_from_content(files: DataFrame, readers: Readers | None = None) -> DataFrame:
    """Rows (path, extension, content) -> (path, author); other formats never leave the JVM."""
    ext = F.lower("extension")

    def authors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in small_parts(batches, "content"):
            pairs = zip(rows.column("content"), rows.column("extension"))
            found = [document_author(as_file(c.as_py()), e.as_py(), readers) for c, e in pairs]
            yield pa.RecordBatch.from_arrays([rows.column("path"), pa.array(found, pa.string())], names=["path", "author"])

    slim = files.select("path", "extension", "content")
    able = F.coalesce(ext.isin(*AUTHORED, *[f".{kind}" for kind in readers or ()]), F.lit(False))
    rest = slim.where(~able).select("path", F.lit(document_author(None, "")).alias("author"))
    return slim.where(able).mapInArrow(authors, "path STRING, author STRING").unionByName(rest)


# --- which collection a table describes --------------------------------------


def collection_guard(manifest: DataFrame, requested: str | None = None) -> DataFrame:
    """Collection roots a manifest was built from, each with a verdict on the request."""
    roots = manifest.select("collection_root").distinct()
    agreed = F.lit(True) if requested is None else F.col("collection_root") == requested
    return roots.select(
        "collection_root",
        F.when(F.col("collection_root") == "", "not recorded")
        .when(agreed, "ok")
        .otherwise("built from another collection")
        .alias("verdict"),
    )


def require_collection(manifest: DataFrame, requested: str | None = None) -> str:
    """The one root a manifest describes; raises when it is unknown, mixed or another one."""
    wanted = None if requested is None else resolve_collection(requested)
    roots = collection_guard(manifest, wanted).limit(2).collect()
    if len(roots) != 1:
        raise CollectionError(f"expected one collection, found {len(roots) or 'none'}")
    root, verdict = roots[0]
    if verdict != "ok":
        raise CollectionError(f"manifest was built from {root or '?'}; requested {requested}: {verdict}")
    return root
