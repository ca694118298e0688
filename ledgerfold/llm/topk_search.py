"""Exact top-k search by columnar branch and bound.

Vectors are whole numbers, floor(scale * x) for each component x; the score is their inner product. Vectors are packed into
blocks in vertical layout, one array for each dimension. A block of queries and a block of candidates
meet in an equi-join on a grid of cells: candidate blocks are dealt over columns and repeated for each row, query blocks
the other way round, so each pair of blocks meets once and neither side is broadcast or gathered.

A query first scores enough of a block to have k candidates, then adds DIMS dimensions at a time for the rest.
What the dimensions ahead can still add is at most the product of the norms of both remainders;
candidates whose bound is below the query's k-th best score are cut and the survivors compacted.
A task goes through many pairs of blocks, so later blocks start with the best scores of the earlier ones; it holds
the state of at most HELD blocks of queries.

Defined results: vectors that are null or empty, or hold null, NaN or infinity, and rows without identifier take no part; only vectors of
one length are compared; a row is its own candidate no more than its repetitions are; repeated candidates are ranked
each; query rows that repeat an identifier with another vector are answered each, equal ones once; ties go to the smaller identifier; a
query without candidates has no rows; other columns are not read. Scores are exact and ranked as such: pairs whose
products may pass 64 bits are summed as unlimited whole numbers, and a score beyond 64 bits is given as the nearest 64-bit one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCALE = 256
K = 5
DIMS = 16
CANDIDATES = 4096  # in a block
QUERIES = 256  # in a block
HELD = 64  # blocks of queries in a row of the grid
COLUMNS = 256  # of the grid at most
SAFE = float(1 << 62)  # sums below are exact in 64 bits, also where the estimate is a little off
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def whole_numbers(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def usable(vector: Column) -> Column:
    """Not null or empty, and all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


_PACKED = "dims int, block long, ids binary, columns binary, n int"


def _pack(rows: pd.DataFrame) -> pd.DataFrame:
    """One block: identifiers, and components dimension by dimension."""
    rows = rows.sort_values("id", kind="stable")
    columns = np.stack(rows["vector"].to_numpy()).T
    columns = np.ascontiguousarray(columns, np.int64)
    # Four bytes a component where all of them fit.
    width = "<i4" if columns.min() >= -(1 << 31) and columns.max() < 1 << 31 else "<i8"
    ids = rows["id"].to_numpy(np.int64)
    return pd.DataFrame(
        {
            "dims": [len(columns)],
            "block": [rows["block"].iloc[0]],
            "ids": [ids.tobytes()],
            "columns": [columns.astype(width).tobytes()],
            "n": [len(ids)],
        }
    )


def blocks(vectors: DataFrame, size: int) -> DataFrame:
    """Packed blocks of about `size` vectors (id, dims, vector), dealt by a hash of the identifier."""
    count = vectors.count() // size + 1
    numbered = vectors.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(count)))
    return numbered.groupBy("dims", "block").applyInPandas(_pack, _PACKED)


class _Best:
    """The best scores of one block of queries so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int) -> None:
        self.ids, self.vectors, self.k = ids, vectors, k
        self.remaining = _remaining(vectors.T)
        self.sizes = np.abs(vectors.astype(np.float64)).max(axis=1)
        self.scores: list[np.ndarray] = [np.zeros(0, np.int64) for _ in ids]
        self.found: list[np.ndarray] = [np.zeros(0, np.int64) for _ in ids]

    def search(self, at: int, ids: np.ndarray, columns: np.ndarray, remaining: np.ndarray, sizes: np.ndarray) -> None:
        query, k = self.vectors[at], self.k
        others, narrow = ids != self.ids[at], sizes * self.sizes[at] * len(query) < SAFE
        wide, left = np.flatnonzero(others & ~narrow), np.flatnonzero(others & narrow)
        if len(wide):
            exact = np.empty(len(wide), object)
            exact[:] = [sum(int(a) * int(b) for a, b in zip(query, columns[:, c])) for c in wide]
            self._take(at, ids[wide], exact)
        known = self.scores[at]
        if len(known) < k and len(left):
            # Enough of the block to have k scores; the bound needs one.
            first, left = left[: 4 * k], left[4 * k :]
            self._take(at, ids[first], query @ columns[:, first])
            known = self.scores[at]
        least = known[-1] if len(known) >= k else None
        partial = np.zeros(len(left), np.int64)
        for low in range(0, len(query), DIMS):
            if not len(left):
                return
            high = min(low + DIMS, len(query))
            partial = partial + query[low:high] @ columns[low:high, left]
            if least is not None:
                ahead = self.remaining[high // DIMS if high < len(query) else -1, at] * remaining[
                    high // DIMS if high < len(query) else -1, left
                ]
                # A little more than the bound, as norms and large sums are rounded.
                rounded = partial.astype(np.float64)
                slack = 1e-3 + 1e-15 * (np.abs(rounded) + abs(float(least)))
                stay = rounded + ahead * (1 + 1e-9) + slack >= float(least)
                partial, left = partial[stay], left[stay]
        if len(left):
            self._take(at, ids[left], partial)

    def _take(self, at: int, ids: np.ndarray, scores: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores[at], scores]), np.concatenate([self.found[at], ids])
        if scores.dtype == object:
            best = np.array(sorted(range(len(ids)), key=lambda n: (-int(scores[n]), ids[n]))[: self.k], np.int64)
        else:
            best = np.lexsort((ids, -scores))[: self.k]
        self.scores[at], self.found[at] = scores[best], ids[best]


def _remaining(columns: np.ndarray) -> np.ndarray:
    """Row i: the norms of the dimensions from i * DIMS on; the last row is zero."""
    squares = columns.astype(np.float64) ** 2
    starts = range(0, len(columns), DIMS)
    return np.sqrt(np.array([squares[s:].sum(axis=0) for s in starts] + [np.zeros(columns.shape[1])]))


def _numbers(data: bytes, dims: int, n: int) -> np.ndarray:
    return np.frombuffer(data, "<i4" if len(data) == 4 * dims * n else "<i8").reshape(dims, -1).astype(np.int64)


def _in_order(score: int) -> bytes:
    """Bytes that sort as the score does, however large it is."""
    return (score + (1 << 199)).to_bytes(25, "big")


def _results(best: dict[tuple[int, int], _Best]) -> Iterator[pa.RecordBatch]:
    for (dims, block), b in best.items():
        sizes = [len(s) for s in b.scores]
        if sum(sizes):
            scores = [int(score) for some in b.scores for score in some]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(b.ids, sizes)),
                    pa.array(np.repeat(np.arange(len(sizes)), sizes)),
                    pa.array(np.full(sum(sizes), block)),
                    pa.array(np.full(sum(sizes), dims)),
                    pa.array(np.concatenate(b.found)),
                    pa.array([min(max(score, LEAST), MOST) for score in scores], pa.int64()),
                    pa.array([_in_order(score) for score in scores], pa.binary()),
                ],
                names=["query_id", "place", "q_block", "dims", "vec_id", "score", "exact"],
            )


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple[int, int], _Best] = {}
        for batch in batches:
            for row in batch.to_pylist():
                dims = row["dims"]
                key = (dims, row["q_block"])
                if key not in best and len(best) == HELD:
                    yield from _results(best)
                    best.clear()
                if key not in best:
                    q_ids = np.frombuffer(row["q_ids"], "<i8")
                    best[key] = _Best(q_ids, _numbers(row["q_columns"], dims, len(q_ids)).T.copy(), k)
                ids = np.frombuffer(row["ids"], "<i8")
                columns = _numbers(row["columns"], dims, len(ids))
                remaining, sizes = _remaining(columns), np.abs(columns.astype(np.float64)).max(axis=0)
                for at in range(len(best[key].ids)):
                    best[key].search(at, ids, columns, remaining, sizes)
        yield from _results(best)

    return run


_FOUND = "query_id long, place long, q_block long, dims long, vec_id long, score long, exact binary"


def search_top_k(
    vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k highest scores of each row for which is_query holds."""
    rows = (
        vectors.where(F.col(id_col).isNotNull() & usable(F.col(vector_col)))
        .select(
            F.col(id_col).cast("long").alias("id"),
            is_query.alias("asks"),
            F.size(vector_col).alias("dims"),
            whole_numbers(F.col(vector_col), scale).alias("vector"),
        )
    )
    candidates = blocks(rows.drop("asks"), CANDIDATES)
    asking = rows.where("asks").drop("asks").distinct()
    columns = min(COLUMNS, rows.count() // CANDIDATES // 2 + 1)
    lines = asking.count() // QUERIES // HELD + 1
    in_columns = candidates.withColumn("column", F.pmod("block", F.lit(columns)).cast("int")).withColumn(
        "line", F.explode(F.sequence(F.lit(0), F.lit(lines - 1)))
    )
    in_lines = blocks(asking, QUERIES).select(
        F.col("dims").alias("q_dims"),
        F.col("block").alias("q_block"),
        F.col("ids").alias("q_ids"),
        F.col("columns").alias("q_columns"),
        F.pmod("block", F.lit(lines)).cast("int").alias("q_line"),
        F.explode(F.sequence(F.lit(0), F.lit(columns - 1))).alias("q_column"),
    )
    met = in_columns.join(
        in_lines,
        (F.col("dims") == F.col("q_dims")) & (F.col("column") == F.col("q_column")) & (F.col("line") == F.col("q_line")),
    )
    pairs = met.select("dims", "q_block", "q_ids", "q_columns", "ids", "columns")
    found = pairs.mapInArrow(_search(k), _FOUND)
    ranks = Window.partitionBy("query_id", "q_block", "dims", "place").orderBy(F.col("exact").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )
