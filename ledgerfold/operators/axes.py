"""Three independent ways to bucket a collection: class, author, custodian."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.constants import AXES, STATUS_OK, UNASSIGNED
from ledgerfold.functions.content import author_or_unassigned
from ledgerfold.functions.paths import custodian_match
from ledgerfold.operators.rule_tables import first_match_join

# A few rules written in code, which become part of the expression, or a table of any size, which is joined.
Rules = list[tuple[str, str]] | DataFrame


def class_bucket() -> Column:
    """The label where one was given; never a bucket named after its absence."""
    return F.when(F.col("status") == STATUS_OK, F.col("label")).otherwise(UNASSIGNED)


def class_axis(classifications: DataFrame) -> DataFrame:
    return classifications.select("path", class_bucket().alias("bucket"))


def author_axis(manifest: DataFrame) -> DataFrame:
    return manifest.select("path", author_or_unassigned(F.col("author")).alias("bucket"))


def custodian_axis(manifest: DataFrame, rules: Rules) -> DataFrame:
    if isinstance(rules, DataFrame):
        return first_match_join(manifest.select("path"), rules).select("path", F.col("custodian").alias("bucket"))
    return manifest.select("path", custodian_match(F.col("path"), rules).alias("bucket"))


def axis_lookup(manifest: DataFrame, axis: DataFrame) -> DataFrame:
    """Every manifest row with its bucket; Unassigned where the axis has none.

    Both sides have one row per path, so Spark chooses the join by their sizes.
    """
    return manifest.join(axis, "path", "left").withColumn(
        "bucket", F.coalesce("bucket", F.lit(UNASSIGNED))
    )


def assign_axes(
    manifest: DataFrame, rules: Rules, classifications: DataFrame | None = None
) -> DataFrame:
    """Manifest rows with one bucket column per axis.

    The author is a projection, and so is the custodian by rules in code; the class and a rule table need a
    join. The class is left out when nothing was classified.
    """
    wide = manifest
    if classifications is not None:
        labels = class_axis(classifications).withColumnRenamed("bucket", "class_bucket")
        wide = wide.join(labels, "path", "left").withColumn(
            "class_bucket", F.coalesce("class_bucket", F.lit(UNASSIGNED))
        )
    wide = wide.withColumn("author_bucket", author_or_unassigned(F.col("author")))
    if isinstance(rules, DataFrame):
        return first_match_join(wide, rules).drop("rule_order").withColumnRenamed("custodian", "custodian_bucket")
    return wide.withColumn("custodian_bucket", custodian_match(F.col("path"), rules))


def axes_of(wide: DataFrame) -> list[str]:
    return [axis for axis in AXES if f"{axis}_bucket" in wide.columns]


def axis_divergence(wide: DataFrame) -> DataFrame:
    """Files whose buckets differ on all three axes."""
    class_, author, custodian = (F.col(f"{axis}_bucket") for axis in AXES)
    return wide.where((class_ != author) & (author != custodian) & (class_ != custodian)).select(
        "path", *[f"{axis}_bucket" for axis in AXES]
    )


def axis_value_overlap(wide: DataFrame, left: str = "author", right: str = "custodian") -> DataFrame:
    """Named values that occur on two axes; none when the axes are distinguishable."""
    values = [
        wide.select(F.col(f"{axis}_bucket").alias("value")).where(F.col("value") != UNASSIGNED)
        for axis in (left, right)
    ]
    return values[0].intersect(values[1])
