"""The answer key of a collection: one JSON object, or one per line for parts of a large one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold import schemas
from ledgerfold.constants import UNASSIGNED


def read_answer_key(spark: SparkSession, location: str, one_object: bool = False) -> DataFrame:
    """Key rows; set `one_object` for a single object spread over several lines."""
    return spark.read.schema(schemas.ANSWER_KEY).json(location, multiLine=one_object)


def seeded_errors(key: DataFrame) -> DataFrame:
    """(type, path) of every planted error."""
    return key.select(F.inline("seeded_errors")).select("type", F.explode("paths").alias("path"))


def expected_authors(key: DataFrame) -> DataFrame:
    """(path, author); Unassigned where the key has none."""
    pairs = key.select(F.explode("authors").alias("path", "author"))
    return pairs.select("path", F.coalesce("author", F.lit(UNASSIGNED)).alias("author"))


def accepted_labels(key: DataFrame) -> DataFrame:
    """(path, accepted[]); NULL where no label can be right."""
    return key.select(F.explode("classes").alias("path", "accepted"))


def key_files(key: DataFrame) -> DataFrame:
    return key.select(F.explode("files").alias("path"))
