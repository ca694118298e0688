"""Intermediate tables in the shared folder the cluster names.

A staged table is plain Parquet on reliable storage: it cuts lineage, keeps
column pruning and filter pushdown for every later read, and survives the loss
of executors.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; where there is none, a folder in its warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints").rstrip("/")


def new_location(spark: SparkSession, label: str) -> str:
    """A location nothing has been written to yet."""
    return f"{shared_folder(spark)}/ledgerfold/{label}-{uuid.uuid4().hex}"


def new_store_location(spark: SparkSession, label: str) -> str:
    """A new location as Spark itself resolves it, for use outside of Spark's readers.

    A folder named without a scheme is on the cluster's default file system;
    the full address of a table written there tells which one that is.
    """
    marker = new_location(spark, label)
    spark.range(1).write.parquet(marker)
    address = spark.read.parquet(marker).inputFiles()[0].rsplit("/", 1)[0]
    return f"{unquote(address)}-tree"


def read_staged(spark: SparkSession, location: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(location)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a table once and return a reader of it."""
    location = new_location(df.sparkSession, label)
    df.write.parquet(location)
    return read_staged(df.sparkSession, location, df)
