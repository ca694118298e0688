"""Connected components by alternating star contraction, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.sources.staging import stage


def _state(links: DataFrame):
    return links.select(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b").cast("long"))).first()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for the nodes of links (a, b); the root is a component's smallest node.

    In turn, every node passes its larger neighbours and its smaller ones on to the smallest
    node it knows; what is left when nothing changes is one star a component. The number of
    rounds grows with the logarithm of the longest chain. Smallest neighbours are
    aggregates, so a hub is combined before the shuffle, and a join to it can be split.
    """
    stars = stage(
        links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links"
    )
    state = _state(stars)
    while True:
        both = stars.union(stars.select("b", "a"))
        near = both.groupBy("a").agg(F.min("b").alias("low")).select(
            F.col("a").alias("node"), F.least("a", "low").alias("low")
        )
        larger = both.join(near, F.col("a") == F.col("node")).where("b > a")
        large = stage(larger.select(F.col("low").alias("a"), "b").distinct(), "large-stars")
        least = large.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("low"))
        smaller = large.join(least, F.col("b") == F.col("node")).where("a <> low")
        small = (
            least.select(F.col("low").alias("a"), F.col("node").alias("b"))
            .union(smaller.select(F.col("low").alias("a"), F.col("a").alias("b")))
            .distinct()
        )
        stars = stage(small, "small-stars")
        before, state = state, _state(stars)
        if before == state:
            return stars.select(F.col("b").alias("node"), F.col("a").alias("root"))
