"""Exact dedup by content sort.

Sampled splitters range-partition the normalised texts, the external sort of each
partition places equal texts next to each other, and a window that compares the
whole texts of neighbours finds the smallest identifier of each group.

The splitters are sampled from short keys: the first characters, the digest, and
the piece of a hot text, so that what the driver sees of a text is bounded. The
texts cross the network once, as they are; they are normalised again after it.

A text of more than `hot_rows` rows (and more than a 10,000th of all rows) is hot.
Its rows are counted before the shuffle, map side, and spread over pieces of about
`hot_rows` rows by a hash of the identifier; every piece is sorted and compared
like any other run, and the counts join the pieces. There are fewer than 10,000
hot texts by definition, which bounds the only broadcast.

Defined results: a null text is an empty one; a null identifier sorts last, so it is
kept only where its group has no other; of rows that agree in identifier and text one is
kept; no rows give no rows; a result column replaces an input column of its name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerfold.llm.common import BLANKS, or_empty, with_results

HOT_ROWS = 500
HOT_SHARE = 10_000
PREFIX_CHARS = 32


def normalised(text: Column) -> Column:
    """Every run of blanks becomes one space."""
    return F.regexp_replace(or_empty(text), BLANKS, " ")


def hot_texts(docs: DataFrame, id_col: str, text_col: str, hot_rows: int) -> DataFrame:
    """Digest, rows and smallest identifier of the texts too frequent for one task."""
    limit = max(hot_rows, docs.count() // HOT_SHARE)
    return (
        docs.select(F.col(id_col).alias("id"), F.sha2(normalised(F.col(text_col)), 256).alias("hot_sha"))
        .groupBy("hot_sha")
        .agg(F.count("*").alias("hot_size"), F.min("id").alias("hot_keep"))
        .where(F.col("hot_size") > limit)
    )


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """The rows of docs with keep_id, group_size, kept and text_sha256."""
    hot = hot_texts(docs, id_col, text_col, hot_rows)
    keyed = docs.select(
        F.struct("*").alias("doc"),
        F.col(id_col).alias("id"),
        F.substring(normalised(F.col(text_col)), 1, PREFIX_CHARS).alias("head"),
        F.sha2(normalised(F.col(text_col)), 256).alias("sha"),
    )
    spread = keyed.join(F.broadcast(hot), F.col("sha") == F.col("hot_sha"), "left").withColumn(
        "piece",
        F.coalesce(F.pmod(F.xxhash64("id"), F.ceil(F.col("hot_size") / hot_rows)), F.lit(0)),
    )
    ranged = spread.repartitionByRange("head", "sha", "piece")
    whole = ranged.withColumn("norm", normalised(F.col("doc").getField(text_col)))
    # The range keys are among the window's, so that no exchange follows.
    run = Window.partitionBy("head", "sha", "piece", "norm").orderBy(F.col("id").asc_nulls_last())
    all_of_it = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = whole.select(
        "doc",
        "id",
        "sha",
        "hot_size",
        "hot_keep",
        F.row_number().over(run).alias("place"),
        F.min("id").over(all_of_it).alias("run_keep"),
        F.count("*").over(all_of_it).alias("run_size"),
    )
    is_hot = F.col("hot_size").isNotNull()
    keep = F.when(is_hot, F.col("hot_keep")).otherwise(F.col("run_keep"))
    return placed.select(
        *with_results(
            "doc",
            docs.columns,
            {
                "keep_id": keep,
                "group_size": F.coalesce("hot_size", "run_size"),
                "kept": (F.col("place") == 1) & (~is_hot | F.col("id").eqNullSafe(F.col("hot_keep"))),
                "text_sha256": F.col("sha"),
            },
        )
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of every group of equal texts, with the columns of docs."""
    clear = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("body"))
    return exact_dedup(clear, "id", "body").where("kept").select("row.*")
