"""Helpers the operators of this folder share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What separates words, as a Java and as an RE2 pattern.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def with_results(doc: str, columns: list[str], results: dict[str, Column]) -> list[Column]:
    """The fields of the packed row, then the results; a result replaces a field of its name."""
    taken = {name.lower() for name in results}
    fields = [F.col(doc).getField(c).alias(c) for c in columns if c.lower() not in taken]
    return fields + [value.alias(name) for name, value in results.items()]
