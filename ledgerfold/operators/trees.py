"""Two inventories compared by the digests of their folders.

A folder's digest is a sum over the files below it, so it is built from the files up: files are
combined by folder before any shuffle, and folders are added to those above them. Two trees are
then compared from the root down. Where two folders agree, nothing below them is looked at, and
only files that lie in a folder whose own files differ are compared one by one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.operators.gates import snapshot_diff
from ledgerfold.sources.staging import new_location

TREE = "folder STRING, parent STRING, depth INT, files BIGINT, high DECIMAL(38,0), low DECIMAL(38,0), own_high DECIMAL(38,0), own_low DECIMAL(38,0)"
_DIGESTS = ("files", "high", "low")


def folder_of(path: Column) -> Column:
    """What stands before the last `/`; '' at the top."""
    return F.regexp_extract(path, r"(?s)^(.*)/", 1)


def _number(digest: Column, start: int) -> Column:
    return F.conv(F.substring(digest, start, 15), 16, 10).cast("decimal(38,0)")


def folder_tree(files: DataFrame, path: str = "path", fingerprint: str = "sha256") -> DataFrame:
    """One row a folder: the files below it and two 60-bit sums over them, of all and of its own.

    The sums are of a SHA-256 of path and fingerprint, so they do not depend on any order, and a
    repeated row counts. Rows without a path belong to no folder.
    """
    digest = F.sha2(F.concat(F.col(path), F.lit("\0"), F.coalesce(F.concat(F.lit("="), fingerprint), F.lit("?"))), 256)
    own = (
        files.where(F.col(path).isNotNull())
        .select(folder_of(F.col(path)).alias("folder"), _number(digest, 1).alias("high"), _number(digest, 16).alias("low"))
        .groupBy("folder")
        .agg(F.count("*").alias("files"), F.sum("high").cast("decimal(38,0)").alias("high"), F.sum("low").cast("decimal(38,0)").alias("low"))
    )
    steps = F.split("folder", "/")
    above = F.when(F.col("folder") == "", F.array(F.lit(""))).otherwise(
        F.concat(F.array(F.lit("")), F.transform(steps, lambda _, at: F.array_join(F.slice(steps, 1, at + 1), "/")))
    )
    spread = own.select("files", "high", "low", F.col("folder").alias("_own"), F.explode(F.array_distinct(above)).alias("folder"))
    mine = F.col("_own") == F.col("folder")
    none = F.lit(0).cast("decimal(38,0)")
    return spread.groupBy("folder").agg(
        F.sum("files").alias("files"),
        F.sum("high").cast("decimal(38,0)").alias("high"),
        F.sum("low").cast("decimal(38,0)").alias("low"),
        F.sum(F.when(mine, F.col("high")).otherwise(none)).cast("decimal(38,0)").alias("own_high"),
        F.sum(F.when(mine, F.col("low")).otherwise(none)).cast("decimal(38,0)").alias("own_low"),
    ).select(
        "folder",
        F.when(F.col("folder") != "", folder_of(F.col("folder"))).alias("parent"),
        F.when(F.col("folder") == "", 0).otherwise(F.size(F.split("folder", "/"))).alias("depth"),
        *("files", "high", "low", "own_high", "own_low"),
    )


def store_tree(tree: DataFrame) -> DataFrame:
    """The tree, stored level by level, so that a comparison reads the levels it comes to."""
    spark, location = tree.sparkSession, new_location(tree.sparkSession, "tree")
    tree.write.partitionBy("depth").parquet(location)
    return spark.read.schema(TREE).parquet(location)


def _differ(*columns: str) -> Column:
    return ~reduce(Column.__and__, (F.col(f"b_{c}").eqNullSafe(F.col(f"a_{c}")) for c in columns))


def differing_folders(before: DataFrame, after: DataFrame) -> DataFrame:
    """(folder) whose own files are not the same, found from the root down over stored trees."""
    spark = before.sparkSession
    found = spark.createDataFrame([], "folder STRING")
    open_folders = None
    depth = 0
    while True:
        sides = []
        for tree, name in ((before, "b"), (after, "a")):
            level = tree.where(F.col("depth") == depth)
            if open_folders is not None:
                level = level.join(open_folders.withColumnRenamed("folder", "parent"), "parent", "left_semi")
            sides.append(level.select("folder", *[F.col(c).alias(f"{name}_{c}") for c in (*_DIGESTS, "own_high", "own_low")]))
        joined = sides[0].join(sides[1], "folder", "full_outer")

        location = new_location(spark, "differing")
        own = _differ("own_high", "own_low")
        joined.where(_differ(*_DIGESTS) | own).select("folder", own.alias("own")).write.parquet(location)
        level = spark.read.schema("folder STRING, own BOOLEAN").parquet(location)
        if not level.take(1):
            return found
        found = found.union(level.where("own").select("folder"))
        open_folders = level.select("folder")
        depth += 1


def in_folders(files: DataFrame, folders: DataFrame, path: str = "path") -> DataFrame:
    """The files that lie in some folders, and those without a path."""
    placed = files.withColumn("_folder", folder_of(F.col(path)))
    inside = placed.join(folders.select(F.col("folder").alias("_folder")), "_folder", "left_semi")
    return inside.unionByName(placed.where(F.col(path).isNull())).drop("_folder")


def tree_diff(
    before: DataFrame,
    after: DataFrame,
    path: str = "path",
    fingerprint: str = "sha256",
    trees: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """What changed between two inventories, as snapshot_diff() gives it.

    `trees` are stored trees of the two, where they are at hand; then the inventories are only
    read in the folders that differ.
    """
    old, new = trees or (store_tree(folder_tree(before, path, fingerprint)), store_tree(folder_tree(after, path, fingerprint)))
    folders = differing_folders(old, new)
    return snapshot_diff(in_folders(before, folders, path), in_folders(after, folders, path), path, fingerprint)
