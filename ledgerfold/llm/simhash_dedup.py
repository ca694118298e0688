"""SimHash near-dedup with vantage-point trees.

A text's fingerprint has a bit for each bit that over half of its shingles' hashes have.
Equal fingerprints are one point. A vantage-point tree over a bounded, documented sample of
them (SAMPLE points) cuts the space into shards: a node sorts points by their Hamming distance to its
vantage point into shells, until a shard is expected to hold at most SHARD points. All
points are then routed, whatever their number: each to its own shard, and as a query to every later
shard that the triangle bound leaves open (a shell from lo to hi can hold a partner of a
point at distance d only if lo - 3 <= d <= hi + 3). So each pair meets in exactly one shard.

A late shard is open to most points. Its own points are therefore cut into pieces of about SHARD points
and its queries into pieces of QUERIES by a hash, sized from the routes of the sample, and every piece of
own points meets every later piece of the shard in a cell of its own (the first piece of queries in the
piece's own cell). So a task compares a piece with itself and another, whatever the number of points,
and each pair still meets once.

A cell is searched the same way in memory: blocks of points split by vantage points until a
comparison of all pairs is cheap; what remains is compared exactly. Of the pairs found only links that
join new points are given out, so a dense group of m points gives fewer than m of them a
cell, not m * m. Components are then found by joins, without a list on the driver.

Random fingerprints lie near distance 32 from any vantage point, so a level with shells of one
distance leaves about half of the pairs; the pruning is exact, the search more
than linear (near the power 1.7).

Defined results: a null text and one without words have fingerprint zero and are linked like any other;
repeated rows are answered each; null identifiers are linked but never name a component, which is null if it has no other;
no rows give no rows; `drop_near_copies` keeps all columns whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.components import components
from ledgerfold.sources.batches import bound_batches
from ledgerfold.sources.staging import stage

SHINGLE = 3
SEED = 42
RADIUS = 3
SAMPLE = 20_000
SHARD = 50_000
QUERIES = 200_000
DEPTH = 6  # of the tree of shards
BLOCK = 1 << 18  # pairs compared at once
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


# --- fingerprints ---------------------------------------------------------------------------------------------


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    # bytes.split() separates at exactly the six ASCII blanks.
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    if len(words) < shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), seed)]
    else:
        parts = zip(*(words[i:] for i in range(shingle)))
        hashes = [xxhash.xxh64_intdigest(s, seed) for s in map(b" ".join, parts)]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        some = np.array(hashes[at : at + (1 << 16)], dtype="<u8")
        ones += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.large_binary()) if batch.num_rows else []
        found = np.fromiter((fingerprint(t.as_py() or b"") for t in texts), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(found.view(np.int64)), batch.column(2)], names=["id", "point", "digest"]
        )


def _text_digest(text_col: str) -> Column:
    return F.xxhash64(text_col)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, point, digest): the fingerprint as a signed number, and a digest that tells rows of one id apart."""
    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), _text_digest(text_col).alias("digest")
    )
    bound_batches(docs.sparkSession)
    return narrow.mapInArrow(_fingerprint_batches, f"id {kind}, point long, digest long")


# --- the tree of shards ---------------------------------------------------------------------------------------


def _distance(points: np.ndarray, to) -> np.ndarray:
    return np.bitwise_count(points ^ to)


class Tree:
    """A vantage point with shells, or a leaf: the number of a shard."""

    def __init__(self) -> None:
        self.vantage = np.uint64(0)
        self.shells: list[tuple[int, int, Tree]] = []
        self.shard = -1


def build_tree(sample: np.ndarray, expected: float, shard: int = SHARD, depth: int = DEPTH) -> Tree:
    """The tree that cuts `expected` points, like those of the sample, into shards."""
    count = 0

    def node(points: np.ndarray, share: float, left: int) -> Tree:
        nonlocal count
        tree = Tree()
        far = _distance(points, points[0]) if len(points) else np.zeros(0, np.uint8)
        if share <= shard or left == 0 or len(np.unique(far)) < 3:
            tree.shard, count = count, count + 1
            return tree
        tree.vantage = points[0]
        low = 0
        rows = np.bincount(far, minlength=65)
        for at in range(65):
            inside = rows[low : at + 1].sum()
            # Thin shells are joined to the next; the last one takes all that is left.
            if at == 64 or inside >= max(1, len(points) // 100) and rows[at + 1 :].sum() >= len(points) // 100:
                some = points[(far >= low) & (far <= at)]
                tree.shells.append((low, at, node(some, share * len(some) / len(points), left - 1)))
                low = at + 1
        return tree

    return node(sample, expected, depth)


def route(tree: Tree, points: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the point, shard, whether it is the point's own) for its own shard and all later open ones."""
    found: list[tuple[np.ndarray, int, np.ndarray]] = []

    def visit(tree: Tree, which: np.ndarray, own: np.ndarray) -> None:
        if not tree.shells:
            found.append((which, tree.shard, own))
            return
        far = _distance(points[which], tree.vantage).astype(np.int16)
        for low, high, below in tree.shells:
            open_ = (far >= low - radius) & (far <= high + radius)
            if open_.any():
                visit(below, which[open_], own[open_] & (far[open_] >= low) & (far[open_] <= high))

    visit(tree, np.arange(len(points)), np.ones(len(points), bool))
    which = np.concatenate([w for w, _, _ in found])
    shard = np.concatenate([np.full(len(w), s) for w, s, _ in found])
    own = np.concatenate([o for _, _, o in found])
    home = np.zeros(len(points), np.int64)
    home[which[own]] = shard[own]
    kept = own | (shard > home[which])
    return which[kept], shard[kept], own[kept]


def pieces(
    tree: Tree, sample: np.ndarray, total: int, own_piece: int = SHARD, query_piece: int = QUERIES
) -> tuple[np.ndarray, np.ndarray]:
    """For every shard the numbers of pieces of its own points and of its queries, estimated from the sample."""
    _, shard, own = route(tree, sample)
    share = max(1.0, total / max(1, len(sample)))
    shards = int(shard.max(initial=0)) + 1
    counts = [np.bincount(shard[mask], minlength=shards) * share for mask in (own, ~own)]
    return tuple(
        np.maximum(1, np.ceil(count / piece)).astype(np.int64) for count, piece in zip(counts, (own_piece, query_piece))
    )


def deal(
    tree: Tree, homes: np.ndarray, queries: np.ndarray, points: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(index of the point, shard, left piece, right piece, whether it is the left one's) for every cell a point goes to.

    A shard's pieces are its own ones, then those of its queries; cells are pairs of an own piece and
    itself or a later one, and the first piece of queries joins the cells of own pieces and themselves.
    """
    which, shard, own = route(tree, points)
    # A shard no point of the sample has come to is of one piece.
    known = np.minimum(shard, len(homes) - 1)
    mine = np.where(shard < len(homes), homes[known], 1)
    others = np.where(shard < len(homes), queries[known], 1)
    mixed = (points[which] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
    piece = (mixed % np.where(own, mine, others).astype(np.uint64)).astype(np.int64) + np.where(own, 0, mine)
    cells = np.where(own, mine + others - 1, mine)
    row = np.repeat(np.arange(len(which)), cells)
    here, is_own, first_query = piece[row], own[row], mine[row]
    other = np.arange(len(row)) - np.repeat(np.cumsum(cells) - cells, cells)
    # An own point's cells leave out that of the first piece of queries, which come to it.
    other = other + (is_own & (other >= first_query))
    left, right = np.minimum(here, other), np.maximum(here, other)
    right = np.where(~is_own & (here == first_query), left, right)
    return which[row], shard[row], left, right, is_own & (here <= other)


# --- pairs within a cell --------------------------------------------------------------------------------------


class Links:
    """Joins pairs of positions; keeps for each position the smallest one it is joined to."""

    def __init__(self, size: int) -> None:
        self.root = np.arange(size)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.root[a], self.root[b]
            differ = a != b
            a, b = np.minimum(a[differ], b[differ]), np.maximum(a[differ], b[differ])
            np.minimum.at(self.root, b, a)
            while (self.root != self.root[self.root]).any():
                self.root = self.root[self.root]


def link_close(points: np.ndarray, left: np.ndarray, inside: bool, links: Links, radius: int = RADIUS) -> None:
    """Adds every pair within the radius of a left and another point, and `inside` those of two left ones."""

    def compare(a: np.ndarray, b: np.ndarray) -> None:
        rows = max(1, BLOCK // max(1, len(b)))
        for at in range(0, len(a), rows):
            i, j = np.nonzero(_distance(points[a[at : at + rows], None], points[b][None, :]) <= radius)
            links.add(a[at : at + rows][i], b[j])

    def shells(a: np.ndarray, b: np.ndarray):
        vantage = points[a[len(a) // 2]]
        return _distance(points[a], vantage).astype(np.int16), _distance(points[b], vantage).astype(np.int16)

    def across(a: np.ndarray, b: np.ndarray, left: int) -> None:
        if not len(a) or not len(b):
            return
        if len(a) * len(b) <= BLOCK or left == 0:
            compare(a, b)
            return
        to_a, to_b = shells(a, b)
        for far in np.unique(to_a):
            across(a[to_a == far], b[np.abs(to_b - far) <= radius], left - 1)

    def within(a: np.ndarray, left: int) -> None:
        if len(a) * len(a) <= BLOCK or left == 0:
            compare(a, a)
            return
        far, _ = shells(a, a[:0])
        for at in np.unique(far):
            within(a[far == at], left - 1)
            across(a[far == at], a[(far > at) & (far <= at + radius)], left - 1)

    lefts, rights = np.flatnonzero(left), np.flatnonzero(~left)
    if inside:
        within(lefts, 8)
    across(lefts, rights, 8)


def _cell_links(key: tuple, cell: pd.DataFrame) -> pd.DataFrame:
    points = cell["point"].to_numpy(np.int64).view(np.uint64)
    links = Links(len(points))
    link_close(points, cell["first"].to_numpy(bool), key[1] == key[2], links)
    joined = np.flatnonzero(links.root != np.arange(len(points)))
    signed = points.view(np.int64)
    return pd.DataFrame({"a": signed[links.root[joined]], "b": signed[joined]})


def close_links(points: DataFrame) -> DataFrame:
    """Links (a, b) that join all distinct points within the radius of each other, no pair left out of a component."""
    total = points.count()
    sample = points.orderBy(F.xxhash64("point"), "point").limit(SAMPLE).collect()
    sampled = np.array([row.point for row in sample], np.int64).view(np.uint64)
    tree = build_tree(sampled, total)
    homes, queries = pieces(tree, sampled, total)

    def to_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            signed = batch.column(0).to_numpy()
            which, shard, left, right, first = deal(tree, homes, queries, signed.view(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard.astype(np.int64)), pa.array(left), pa.array(right), pa.array(signed[which]), pa.array(first)],
                names=["shard", "l", "r", "point", "first"],
            )

    dealt = points.select("point").mapInArrow(to_cells, "shard long, l long, r long, point long, first boolean")
    return dealt.groupBy("shard", "l", "r").applyInPandas(_cell_links, "a long, b long")


# --- documents ------------------------------------------------------------------------------------------------


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, point, digest, component) for each row of docs; the component is its smallest identifier."""
    marked = stage(fingerprints(docs, id_col, text_col), "fingerprints")
    firsts = stage(marked.groupBy("point").agg(F.min("id").alias("first")), "points")
    roots = stage(components(close_links(firsts)), "roots")
    rooted = firsts.join(roots, F.col("point") == F.col("node"), "left").select(
        "point", "first", F.coalesce("root", "point").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("first").alias("component"))
    named = rooted.join(names, "root").select(F.col("point").alias("of"), "component")
    return marked.join(named, F.col("point") == F.col("of")).drop("of")


def near_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of each row of docs."""
    return near_groups(docs).select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("point"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs but one document of each group: that of the smallest identifier.

    Rows without an identifier can't be told from each other and stay.
    """
    gone = near_groups(docs, id_col, text_col).where("id <> component").select("id", "digest").distinct()
    rows = docs.select(F.struct("*").alias("doc"), F.col(id_col).alias("id"), _text_digest(text_col).alias("digest"))
    return rows.join(gone, ["id", "digest"], "left_anti").select("doc.*")
