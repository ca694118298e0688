"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected target / source size times in the mix. The prefix
sum of these expected copies, plus one random offset a source, crosses a whole
number once for each copy that is emitted. Within a source the documents run from
the longest to the shortest, so the words taken miss the target by less than the
longest document.

The prefix sums come from one range partitioning by source, size and identifier: the position in
its sorted partition, plus the rows of the source in the partitions before. So a
source with a third of all rows spreads over as many partitions as it fills, and nothing but
one row for each source and partition is gathered. The positions are written down
once, which makes them the same for every later read. A source is one row of a
small table that is sorted in one task.

The offset is a digest of the seed and the source, so reruns agree.

Defined results: a null text has size 0; a null source is a source of its own, the last;
a source without words has target 0 and nothing of it is taken; rows that agree in source, size
and identifier are interchangeable; no rows give no rows; a result column replaces an
input column of its name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerfold.llm.common import WORD, or_empty, with_results
from ledgerfold.sources.staging import stage

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_COPIES = 2
SEED = 42
BROADCAST_ROWS = 500_000  # rows of partitions and sources, about 100 bytes each; more are joined by a shuffle


def word_count(text: Column) -> Column:
    return F.regexp_count(or_empty(text), F.lit(WORD)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, seed: int = SEED
) -> DataFrame:
    """Sources with source_size, target, rate (expected copies) and offset, from (source, size) rows.

    A target is the source's weight times one level for all, or its cap. Sorted by cap for each unit of
    weight, a source is capped if the level that is left for it and those after it reaches its cap.
    """
    cycle = F.array(*[F.lit(w) for w in weights])
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    sources = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("at", F.row_number().over(by_name))
        .withColumn("weight", F.element_at(cycle, (F.pmod(F.col("at") - 1, F.lit(len(weights))) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * MOST_COPIES)
        .withColumn("total", F.sum("source_size").over(everything) * F.lit(share))
        .withColumn("all_weight", F.sum("weight").over(everything))
    )
    before = Window.orderBy(F.col("cap") / F.col("weight"), "at").rowsBetween(Window.unboundedPreceding, -1)
    left = sources.withColumn(
        "left_total", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0))
    ).withColumn("left_weight", F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    capped = left.withColumn(
        "capped", F.col("cap") * F.col("left_weight") <= F.col("left_total") * F.col("weight")
    )
    # Behind the first source that is not capped none is; the level is that one's.
    level = Window.orderBy(F.col("cap") / F.col("weight"), "at").rowsBetween(Window.unboundedPreceding, 0)
    return (
        capped.withColumn("level_total", F.first(F.when(~F.col("capped"), F.col("left_total")), True).over(level))
        .withColumn("level_weight", F.first(F.when(~F.col("capped"), F.col("left_weight")), True).over(level))
        .select(
            "source",
            "source_size",
            F.when(F.col("level_total").isNull(), F.col("cap").cast("double"))
            .otherwise(F.col("level_total") * F.col("weight") / F.col("level_weight"))
            .alias("target"),
            (
                F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), or_empty(F.col("source")))), 1, 4), 16, 10).cast(
                    "long"
                )
                / 65536
            ).alias("offset"),
        )
        .withColumn(
            "rate",
            F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(MOST_COPIES)))).otherwise(0.0),
        )
    )


def ranked(packed: DataFrame) -> DataFrame:
    """(doc, id, source, size) rows in the order of the prefix sums, with partition and position, stored."""
    order = [F.col("source").asc_nulls_last(), F.col("size").desc(), F.col("id").asc_nulls_last()]
    placed = (
        packed.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place"))
    )
    return stage(placed, "mix-ranked")


def copies_of(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Ranked rows with their source's figures and the copies the mix takes of each."""
    parts = rows.groupBy("source", "part").agg(F.min("place").alias("first_place"), F.count("*").alias("rows"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.withColumn("start", F.coalesce(F.sum("rows").over(before), F.lit(0))).select(
        F.col("source").alias("part_source"), F.col("part").alias("part_no"), "first_place", "start"
    )
    known = stage(starts.join(targets, F.col("part_source").eqNullSafe(F.col("source"))).drop("source"), "mix-parts")
    if known.count() <= BROADCAST_ROWS:
        known = F.broadcast(known)
    joined = rows.join(
        known, (F.col("part") == F.col("part_no")) & F.col("source").eqNullSafe(F.col("part_source"))
    )
    rank = F.col("start") + F.col("place") - F.col("first_place")
    crossed = F.floor(F.col("offset") + (rank + 1) * F.col("rate")) - F.floor(F.col("offset") + rank * F.col("rate"))
    return joined.withColumn("copies", F.least(crossed, F.lit(MOST_COPIES)))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """The rows of docs with size, source_size, target, copies and taken (words, repeats counted)."""
    packed = docs.select(
        F.struct("*").alias("doc"), F.col("doc_id").alias("id"), "source", word_count(F.col("text")).alias("size")
    )
    return _mixed(docs.columns, packed, weights, share)


def mix_sized(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """mix_sources for rows (doc_id, source, size) whose words have been counted."""
    packed = sized.select(F.struct("*").alias("doc"), F.col("doc_id").alias("id"), "source", "size")
    return _mixed(sized.columns, packed, weights, share)


def _mixed(columns: list[str], packed: DataFrame, weights: tuple[int, ...], share: float) -> DataFrame:
    rows = ranked(packed)
    taken = copies_of(rows, source_targets(rows, weights, share))
    return taken.select(
        *with_results(
            "doc",
            columns,
            {
                "size": F.col("size"),
                "source_size": F.col("source_size"),
                "target": F.col("target"),
                "copies": F.col("copies"),
                "taken": F.col("copies") * F.col("size"),
            },
        )
    )


def emit_mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """The mix: the rows of docs, each as often as it is taken."""
    packed = docs.select(
        F.struct(F.struct("*").alias("row")).alias("doc"),
        F.col("doc_id").alias("id"),
        "source",
        word_count(F.col("text")).alias("size"),
    )
    taken = _mixed(["row"], packed, weights, share)
    return taken.where("copies > 0").select(
        "row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")
    ).select("row.*")
