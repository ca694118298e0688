"""Ranked lexical search, term at a time with limited accumulators.

Documents are cut into shards of bounded size; each holds its own inverted lists. For an
item, a shard takes the item's terms rarest first and adds each list to accumulators.
With every term it knows the most that the terms still to come can add (the largest
contribution of their lists) and the k-th best partial score. Once the former is below the
latter, no document without an accumulator can reach the best k: none is created any more,
accumulators that cannot reach it are let go, and the others go on to their exact scores.
The k-th score a task has seen in its earlier shards is a floor for its later ones.

One pass counts the terms of the items in every document and stores them; the document
frequencies are counted from this table, and the search reads it again. A shard gives at
most k rows an item, and rows that tie are cut by the identifier inside the shard, so a
thousand copies of one text give k rows and not a thousand. Items go in blocks of about
BLOCK_TERMS terms; only one block's vocabulary, its frequencies and its items' lists of
numbers are in the driver and the broadcast at a time, which bounds both.

Defined results: a document or item without a term takes no part; repeated document rows
are ranked each by itself, one behind the other; repeated items are answered each by itself;
a null identifier of a document sorts last among equal scores, that of an item is returned
as it is; no documents or no items give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerfold.llm.texts import LOWER, UPPER, as_bytes, pieces
from ledgerfold.sources.staging import stage

# Letters and digits of ASCII and all beyond it make terms; A-Z are lower-cased.
_APART = bytes(range(0x30)) + bytes(range(0x3A, 0x41)) + bytes(range(0x5B, 0x61)) + bytes(range(0x7B, 0x80))
_CLEAN = bytes.maketrans(_APART + UPPER, b" " * len(_APART) + LOWER)
ROW_TYPE = "terms array<int>, tfs array<long>"

SHARD_ROWS = 20_000
SHARD_POSTINGS = 4_000_000
BLOCK_TERMS = 500_000


def term_counts(text: bytes) -> Counter:
    found: Counter = Counter()
    for piece in pieces(text.translate(_CLEAN)):
        found.update(piece.split())
    return found


def weight(rows: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * rows + 2) / (2 * df + 1)))


# --- items ----------------------------------------------------------------------------------------------------


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, id, terms): a number for each row, its identifier and its distinct terms."""
    kind = items.schema[id_col].dataType.simpleString()

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            terms = [sorted(term_counts(text)) for text in as_bytes(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(terms, pa.list_(pa.binary()))], names=["item", "id", "terms"]
            )

    numbered = items.select(
        F.monotonically_increasing_id().alias("item"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("t")
    )
    return numbered.mapInArrow(batches, f"item long, id {kind}, terms array<binary>")


# --- documents ------------------------------------------------------------------------------------------------


def postings(docs: DataFrame, id_col: str, text_col: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """(id, n, terms, tfs) of the documents with a term: all its terms counted, those of the vocabulary listed."""
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in given:
            sizes, terms, tfs = [], [], []
            for text in as_bytes(batch.column(1)):
                counts = term_counts(text)
                sizes.append(counts.total())
                asked = sorted((known[t], n) for t, n in counts.items() if t in known)
                terms.append([t for t, _ in asked])
                tfs.append([n for _, n in asked])
            made = pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))],
                names=["id", "n", "terms", "tfs"],
            )
            yield made.filter(pc.greater(made.column(1), 0))

    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("t")).mapInArrow(
        batches, f"id {kind}, n long, {ROW_TYPE}"
    )


class Shard:
    """Inverted lists of some documents: documents and contributions without the weight, list by list."""

    def __init__(self, rows: pa.Table, total: int, length: int) -> None:
        rows = rows.combine_chunks()
        n = rows.column("n").to_numpy()
        fit = 100 - 90 + (90 * n * total) // length
        terms = rows.column("terms").combine_chunks()
        lists = pc.list_flatten(terms).to_numpy(zero_copy_only=False)
        tfs = pc.list_flatten(rows.column("tfs").combine_chunks()).to_numpy(zero_copy_only=False)
        docs = np.repeat(np.arange(len(n)), pc.list_value_length(terms).to_numpy(zero_copy_only=False))
        order = np.argsort(lists, kind="stable")
        self.rows = len(n)
        self.docs = docs[order]
        self.gains = (1_000_000_000 * tfs[order]) // (1000 * tfs[order] + 8 * fit[self.docs])
        self.terms, starts = np.unique(lists[order], return_index=True)
        self.bounds = np.append(starts, len(lists))
        self.most = np.maximum.reduceat(self.gains, starts) if len(starts) else np.zeros(0, np.int64)
        self.ids = rows.column("id").combine_chunks()
        # Places of the identifiers in ascending order, nulls last: equal scores are cut by them.
        self.places = np.empty(self.rows, np.int64)
        self.places[pc.sort_indices(self.ids, null_placement="at_end").to_numpy()] = np.arange(self.rows)
        self.sums = np.zeros(self.rows, np.int64)

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the best k, none below the floor; the terms are given rarest first."""
        if not len(self.terms):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        here = (self.terms[at] == terms) & (weights > 0)
        at, weights = at[here], weights[here]
        left = np.append(np.cumsum((weights * self.most[at])[::-1])[::-1], 0)
        sums = self.sums
        sums[:] = 0
        survivors = None
        least = floor
        for turn, (slot, w) in enumerate(zip(at.tolist(), weights.tolist())):
            docs = self.docs[self.bounds[slot] : self.bounds[slot + 1]]
            gains = self.gains[self.bounds[slot] : self.bounds[slot + 1]]
            if survivors is None and left[turn] < least:
                survivors = np.flatnonzero(sums + left[turn] >= least)
            if survivors is None:
                sums[docs] += w * gains
                # The k-th best cannot pass the best, so it is only looked up where it may end the creation.
                if self.rows >= k and left[turn + 1] < sums.max():
                    least = max(least, int(np.partition(sums, self.rows - k)[self.rows - k]))
            else:
                found = np.minimum(np.searchsorted(docs, survivors), len(docs) - 1)
                hit = docs[found] == survivors
                sums[survivors[hit]] += w * gains[found[hit]]
        docs = np.flatnonzero(sums) if survivors is None else survivors
        docs = docs[(sums[docs] > 0) & (sums[docs] >= floor)]
        order = np.lexsort((self.places[docs], -sums[docs]))[:k]
        return docs[order], sums[docs[order]]


def search_postings(
    stored: DataFrame, items: list[tuple[int, np.ndarray, np.ndarray]], total: int, length: int, k: int
) -> DataFrame:
    """(item, id, score): for each item (its number, terms rarest first, weights) the best rows of every shard."""
    kind = stored.schema["id"].dataType.simpleString()
    shared = stored.sparkSession.sparkContext.broadcast(items)

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        tops = [np.zeros(0, np.int64) for _ in asked]

        def search(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shard = Shard(pa.Table.from_batches(held), total, length)
            numbers, rows, scores = [], [], []
            for place, (number, terms, weights) in enumerate(asked):
                floor = int(tops[place][-1]) if len(tops[place]) == k else 0
                docs, sums = shard.best(terms, weights, k, floor)
                tops[place] = np.sort(np.append(tops[place], sums))[::-1][:k]
                numbers.append(np.full(len(docs), number))
                rows.append(docs)
                scores.append(sums)
            if numbers:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(numbers)), shard.ids.take(pa.array(np.concatenate(rows))), pa.array(np.concatenate(scores))],
                    names=["item", "id", "score"],
                )

        held: list[pa.RecordBatch] = []
        rows = entries = 0
        for batch in given:
            held.append(batch)
            rows += batch.num_rows
            entries += pc.sum(pc.list_value_length(batch.column(2))).as_py() or 0
            if rows >= SHARD_ROWS or entries >= SHARD_POSTINGS:
                yield from search(held)
                held, rows, entries = [], 0, 0
        if rows:
            yield from search(held)

    return stored.mapInArrow(batches, f"item long, id {kind}, score long")


def search_block(docs: DataFrame, block: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(item, id, score, rank) for a block of items."""
    # Bounded by BLOCK_TERMS: the caller cut the items into blocks by their numbers of terms.
    items = block.collect()
    vocabulary = {term: n for n, term in enumerate(sorted({bytes(t) for row in items for t in row.terms}))}
    stored = stage(postings(docs, id_col, text_col, vocabulary), "postings")
    total, length = stored.agg(F.count("*"), F.sum("n")).first()
    frequencies = np.zeros(len(vocabulary), np.int64)
    for row in stored.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
        frequencies[row["term"]] = row["count"]
    weights = np.array([weight(total, int(df)) for df in frequencies], np.int64)
    asked = []
    for row in items:
        terms = np.array([vocabulary[bytes(t)] for t in row.terms], np.int64)
        order = np.lexsort((terms, frequencies[terms]))
        asked.append((row.item, terms[order], weights[terms[order]]))
    best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    found = search_postings(stored, asked, total, length or 1, k)
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def search_ranked(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """item_id, rank, doc_id and score of the k documents with the highest scores above 0 of every item."""
    asked = stage(item_terms(items, item_id, item_text).where(F.size("terms") > 0), "items")
    all_terms = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = math.ceil(all_terms / block_terms)
    names = [F.col("id").alias(item_id), "rank", F.col("doc").alias(doc_id), "score"]
    found = None
    for at in range(max(1, blocks)):
        block = asked.where(F.pmod(F.xxhash64("item"), F.lit(max(1, blocks))) == at)
        ranked = search_block(docs, block, doc_id, doc_text, k).withColumnRenamed("id", "doc")
        answered = ranked.join(block.select("item", "id"), "item").select(*names)
        found = answered if found is None else found.union(answered)
    return found
