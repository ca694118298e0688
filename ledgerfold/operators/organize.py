"""Deciding every destination before anything is written."""

from __future__ import annotations

import posixpath

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.functions.paths import inner_path, normal_path, original_folder, safe_bucket
from ledgerfold.operators.axes import axes_of
from ledgerfold.operators.skew import MIN_PIECE_ROWS, attach_groups
from ledgerfold.schemas import CROSSREF_COLUMNS
from ledgerfold.sources.staging import new_location, read_staged


class CollisionError(RuntimeError):
    """Two files would be written to one destination."""


class UnsafeOutput(ValueError):
    """The output would lie inside the collection, or around it."""


def copy_plan(located: DataFrame, out_root: str) -> DataFrame:
    """Manifest rows with a bucket -> the same rows with a destination.

    The file keeps its path inside the collection, nested under its bucket.
    """
    bucket = safe_bucket(F.col("bucket"))
    return located.withColumn("bucket", bucket).withColumn(
        "dest",
        F.concat_ws("/", F.lit(out_root.rstrip("/")), F.col("bucket"), inner_path(F.col("path"))),
    )


def copy_plans(wide: DataFrame, out_root: str) -> DataFrame:
    """The plans of all axes in one pass, each under `<out_root>/by-<axis>`."""
    out_root = out_root.rstrip("/")
    buckets = F.array(
        *[
            F.struct(F.lit(axis).alias("axis"), F.col(f"{axis}_bucket").alias("bucket"))
            for axis in axes_of(wide)
        ]
    )
    dropped = [f"{axis}_bucket" for axis in axes_of(wide)]
    long = wide.select(*[c for c in wide.columns if c not in dropped], F.inline(buckets))
    return long.withColumn("bucket", safe_bucket(F.col("bucket"))).withColumn(
        "dest",
        F.concat(
            F.lit(f"{out_root}/by-"), "axis", F.lit("/"), "bucket", F.lit("/"), inner_path(F.col("path"))
        ),
    )


def crossref(plan: DataFrame) -> DataFrame:
    """Where every file came from and where it went, with its scan-time hash."""
    rows = plan.withColumns(
        {
            "original_path": F.col("path"),
            "original_folder": original_folder(F.col("path")),
            "new_path": F.col("dest"),
        }
    )
    axis = ["axis"] if "axis" in plan.columns else []
    return rows.select(*axis, *CROSSREF_COLUMNS)


def all_crossrefs(by_axis: dict[str, DataFrame]) -> DataFrame:
    """Cross-references of several axes as one table with an `axis` column."""
    result = None
    for axis, rows in by_axis.items():
        tagged = rows.select(F.lit(axis).alias("axis"), *CROSSREF_COLUMNS)
        result = tagged if result is None else result.unionByName(tagged)
    return result


def collisions(
    plan: DataFrame, fold_case: bool = False, min_piece_rows: int = MIN_PIECE_ROWS
) -> DataFrame:
    """Every file whose destination an earlier file already has: (dest, first_path, path).

    `fold_case` finds clashes on stores that do not tell case apart.
    """
    key = F.lower("dest") if fold_case else F.col("dest")
    rows = plan.select(key.alias("dest"), "path")
    groups = (
        rows.groupBy("dest")
        .agg(F.count("*").alias("n"), F.min("path").alias("first_path"))
        .where("n > 1")
    )
    clashing = attach_groups(rows, groups, "dest", "n", "path", min_piece_rows)
    return clashing.where("path <> first_path").select("dest", "first_path", "path")


def refuse_collisions(plan: DataFrame) -> None:
    """Stop before the first byte moves; all clashes are stored, and the message says where."""
    clashes = collisions(plan)
    if clashes.isEmpty():
        return
    location = new_location(plan.sparkSession, "clashes")
    clashes.write.parquet(location)
    stored = read_staged(plan.sparkSession, location, clashes)
    listed = "\n".join(f"  {r.dest} <- {r.first_path} | {r.path}" for r in stored.limit(5).collect())
    raise CollisionError(
        f"{stored.count()} file(s) would overwrite another one; nothing was copied. All are in {location}, as in\n{listed}"
    )


def folder_batches(plan: DataFrame) -> DataFrame:
    """Files per pair of source folder and destination folder."""
    return plan.groupBy(
        original_folder(F.col("path")).alias("source_folder"),
        F.regexp_replace("dest", r"/[^/]*$", "").alias("dest_folder"),
    ).agg(F.count("*").alias("files"))


def output_verdicts(addresses: DataFrame) -> DataFrame:
    """Rows (collection_root, out_root) with `verdict`: ok, or why the output may not go there."""
    source, target = normal_path(F.col("collection_root")), normal_path(F.col("out_root"))

    def below(inner: Column, outer: Column) -> Column:
        return F.startswith(inner, F.concat(F.rtrim(outer, F.lit("/")), F.lit("/")))

    verdict = (
        F.when(source.isNull() | target.isNull(), "no address")
        .when((target == source) | below(target, source), "inside the collection")
        .when(below(source, target), "around the collection")
        .otherwise("ok")
    )
    return addresses.withColumn("verdict", verdict)


def refuse_unsafe_output(collection_root: str, out_root: str) -> None:
    """Output must be neither inside the collection nor around it."""
    source = posixpath.normpath(collection_root)
    target = posixpath.normpath(out_root)
    if target == source or target.startswith(source.rstrip("/") + "/"):
        raise UnsafeOutput(f"refusing to write inside the collection: {out_root}")
    if source.startswith(target.rstrip("/") + "/"):
        raise UnsafeOutput(f"refusing to write around the collection: {out_root}")
