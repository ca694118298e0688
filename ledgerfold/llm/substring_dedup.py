"""Substring dedup by relative Lempel-Ziv parsing against indexed reference blocks.

A document's windows of WINDOW words are dealt to reference blocks by content: every window
names its smallest hashed gram of GRAM words as its anchor, so equal windows name equal
anchors. Neighbouring windows of one anchor form a fragment; each window is in exactly one.
The block of an anchor is indexed from the fragments of all documents that hold it, so a
document meets every block that can hold a factor of WINDOW words, and no other.

Inside a block, fragments go in the order of their documents. Each is factored greedily
against what is indexed of smaller documents: at a word, the WINDOW words from there are looked
up (whole, not by a hash), and a match is extended as far as both texts agree. That is a
factor; words without one are literals. The windows that cross a factor's end are looked up
before the parse goes on, since another reference may hold them. Factors become removed spans.

What makes it work for any corpus:
- Fragments are first compared as wholes, by two 64-bit hashes: one for the anchor, one for
  all their words. An anchor of one document alone is done with. A fragment that a smaller
  document holds as a whole is one factor. Only an anchor whose fragments differ needs a parse,
  once for each distinct fragment, whatever the number of copies; only those texts are fetched.
- A block of more than BLOCK_FRAGMENTS distinct fragments (a passage with that many contexts)
  is cut further: its windows are filed one by one under a hash of all their words, and the
  smallest document of each is an aggregate.
- Keys that hold many rows are counted and spread (operators/skew.py).

A document is known by its identifier and a hash of its text. Defined results: null and empty
texts have no words and lose none; rows of one identifier never remove from each other, and
equal rows get equal results; a row without an identifier counts as later than all others, and
such rows don't remove from each other; words are kept joined by one space; a document of
fewer than WINDOW words is kept whole; an empty table gives no rows; a result column
replaces an input column of its name.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerfold.llm.texts import as_bytes, beside, integer_key, pieces
from ledgerfold.operators.skew import attach_groups
from ledgerfold.sources.staging import stage

WINDOW = 50
GRAM = 8
BLOCK_FRAGMENTS = 1_000
# Lists of wanted fragments are broadcast up to this many; beyond it the texts are shuffled to them.
BROADCAST_FRAGMENTS = 1_000_000

_BASE = 0x9E3779B97F4A7C15
_BYTE_VALUES = np.array([xxhash.xxh3_64_intdigest(bytes([b]), seed=11) | 1 for b in range(256)], np.uint64)


# --- inside tasks ---------------------------------------------------------------------------------------------


class Powers:
    """Powers of an odd base modulo 2^64 and their inverses, as many as have been asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> None:
        if len(self.up) < n:
            size = 1 << n.bit_length()
            inverse = pow(_BASE, -1, 1 << 64)
            for name, base in (("up", _BASE), ("down", inverse)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))


_POWERS = Powers()


def word_runs(text: bytes, window: int) -> Iterator[tuple[int, list[bytes]]]:
    """(place of the first word, words) in runs of bounded size that overlap by window - 1 words."""
    first, held = 0, []
    for piece in pieces(text):
        held += piece.split()
        yield first, held
        kept = min(len(held), window - 1)
        first += len(held) - kept
        held = held[len(held) - kept :]


def anchors(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each run of width grams the place of the smallest, the last of equals."""
    best = np.arange(len(hashes))
    size = 1
    while size < width:
        step = min(size, width - size)
        left, right = best[:-step], best[step:]
        best = np.where(hashes[left] < hashes[right], left, right)
        size += step
    return best


class Fragments:
    """The fragments of a run of words: anchor hash, hash of all words, first word and end."""

    def __init__(self, words: list[bytes], window: int, gram: int) -> None:
        self.text = b" ".join(words) + b" "
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        self.offsets = np.append(0, ends)
        letters = np.frombuffer(self.text, np.uint8)
        _POWERS.upto(len(letters))
        sums = np.append(np.uint64(0), np.cumsum(_BYTE_VALUES[letters] * _POWERS.down[: len(letters)], dtype=np.uint64))
        starts, stops = self.offsets[: len(words) - gram + 1], self.offsets[gram:]
        hashes = (sums[stops] - sums[starts]) * _POWERS.up[starts]
        hashes = (hashes ^ (hashes >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        hashes ^= hashes >> np.uint64(29)
        chosen = anchors(hashes, window - gram + 1)
        cuts = np.flatnonzero(np.diff(chosen)) + 1
        self.starts = np.append(0, cuts).tolist()
        self.ends = np.append(cuts + window - 1, len(words)).tolist()
        self.h = hashes[chosen[self.starts]].view(np.int64).tolist()

    def words_of(self, start: int, end: int) -> bytes:
        return self.text[self.offsets[start] : self.offsets[end] - 1]

    def __iter__(self) -> Iterator[tuple[int, int, int, int]]:
        offsets, text = self.offsets.tolist(), self.text
        for h, start, end in zip(self.h, self.starts, self.ends):
            whole = xxhash.xxh3_64_intdigest(text[offsets[start] : offsets[end] - 1])
            yield h, whole - (whole >> 63 << 64), start, end


def fragments_of(text: bytes, window: int, gram: int) -> Iterator[tuple[int, Fragments]]:
    for first, words in word_runs(text, window):
        if len(words) >= window:
            yield first, Fragments(words, window, gram)


def parse_block(fragments: Iterator[tuple[int, int, bytes]], window: int) -> Iterator[tuple[int, int, list[int]]]:
    """(owner, hash, spans) of (owner, hash, text) in ascending order of the owners, who all share an anchor.

    spans are starts and ends of the factors that owners before this one hold.
    """
    index: dict[bytes, tuple[int, list[bytes], int]] = {}
    for owner, whole, text in fragments:
        words = text.split(b" ")
        ends = np.cumsum([len(w) + 1 for w in words]).tolist()
        starts = [0, *ends]
        spans: list[int] = []
        at, last = 0, len(words) - window
        while at <= last:
            hit = index.get(text[starts[at] : ends[at + window - 1] - 1])
            if hit is None or hit[0] >= owner:
                at += 1
                continue
            _, other, place = hit
            end, there = at + window, place + window
            while end < len(words) and there < len(other) and words[end] == other[there]:
                end, there = end + 1, there + 1
            spans += [at, end]
            # The next windows cross this factor's end.
            at = end - window + 1
        if spans:
            yield owner, whole, spans
        for place in range(last + 1):
            index.setdefault(text[starts[place] : ends[place + window - 1] - 1], (owner, words, place))


# --- DataFrames -----------------------------------------------------------------------------------------------


def _body(text_col: str) -> Column:
    return F.xxhash64(F.col(f"`{text_col}`"))


def _later(row: str, owner: str) -> Column:
    return F.col(row) > F.col(owner)


def fragments(docs: DataFrame, id_col: str, text_col: str, window: int, gram: int) -> DataFrame:
    """(doc, body, h, words), each fragment once a row of docs."""

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            counts, found = [], []
            for text in as_bytes(batch.column(2)):
                here = {(h, whole) for _, run in fragments_of(text, window, gram) for h, whole, _, _ in run}
                counts.append(len(here))
                found += here
            rows = pa.array(np.repeat(np.arange(batch.num_rows), counts))
            pairs = np.array(found, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(pairs[:, 0]), pa.array(pairs[:, 1])],
                names=["doc", "body", "h", "words"],
            )

    return docs.select(integer_key(id_col).alias("doc"), _body(text_col).alias("body"), F.col(f"`{text_col}`").alias("t")).mapInArrow(
        batches, "doc long, body long, h long, words long"
    )


def fetch_texts(docs: DataFrame, kinds: DataFrame, id_col: str, text_col: str, window: int, gram: int) -> DataFrame:
    """(h, words, owner, body, text) of the given (frag, owner, body)."""
    wanted = kinds.groupBy("owner", "body").agg(F.collect_list("frag").alias("frags"))
    if kinds.count() <= BROADCAST_FRAGMENTS:
        wanted = F.broadcast(wanted)
    rows = docs.select(integer_key(id_col).alias("doc"), _body(text_col).alias("own"), F.col(f"`{text_col}`").alias("t"))
    asked = rows.join(wanted, (F.col("doc") == F.col("owner")) & (F.col("own") == F.col("body"))).select("owner", "body", "frags", "t")

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            for row, text in enumerate(as_bytes(batch.column(3))):
                left = {(f["h"], f["words"]) for f in batch.column(2)[row].as_py()}
                found = []
                for _, run in fragments_of(text, window, gram):
                    for h, whole, start, end in run:
                        if (h, whole) in left:
                            left.remove((h, whole))
                            found.append((h, whole, run.words_of(start, end)))
                owner, body = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                columns = list(zip(*found)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(columns[0], pa.int64()),
                        pa.array(columns[1], pa.int64()),
                        pa.array([owner] * len(found), pa.int64()),
                        pa.array([body] * len(found), pa.int64()),
                        pa.array(columns[2], pa.binary()),
                    ],
                    names=["h", "words", "owner", "body", "text"],
                )

    return asked.mapInArrow(batches, "h long, words long, owner long, body long, text binary")


def parse(texts: DataFrame, window: int) -> DataFrame:
    """(h, words, spans) of fragments (h, words, owner, text) with factors; a block is all rows of one h."""

    def rows(given: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, int, bytes]]:
        for batch in given:
            yield from zip(*(column.to_pylist() for column in batch.columns))

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple[int, int, list[int]]] = []

        def packed() -> pa.RecordBatch:
            columns = list(zip(*made)) or [(), (), ()]
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32())]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["h", "words", "spans"])

        for h, block in groupby(rows(given), key=lambda row: row[0]):
            made += [(h, whole, spans) for _, whole, spans in parse_block(((o, w, t) for _, o, w, t in block), window)]
            if len(made) >= 10_000:
                yield packed()
                made.clear()
        yield packed()

    dealt = texts.select("h", "owner", "words", "text").repartition("h").sortWithinPartitions("h", "owner", "words")
    return dealt.mapInArrow(batches, "h long, words long, spans array<int>")


def parse_windows(texts: DataFrame, window: int) -> DataFrame:
    """The same for blocks too large for one index: each window by itself, under a hash of its words."""

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            rows, places, high, low = [], [], [], []
            for row, text in enumerate(as_bytes(batch.column(3))):
                ends = np.cumsum([len(w) + 1 for w in text.split(b" ")]).tolist()
                starts = [0, *ends]
                for place in range(len(ends) - window + 1):
                    whole = xxhash.xxh3_128_digest(text[starts[place] : ends[place + window - 1] - 1])
                    rows.append(row)
                    places.append(place)
                    high.append(int.from_bytes(whole[:8], "big", signed=True))
                    low.append(int.from_bytes(whole[8:], "big", signed=True))
            taken = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(n).take(taken) for n in range(3)],
                    *[pa.array(values, kind) for values, kind in ((places, pa.int32()), (high, pa.int64()), (low, pa.int64()))],
                ],
                names=["h", "words", "owner", "place", "high", "low"],
            )

    narrow = texts.select("h", "words", "owner", "text")
    single = stage(
        narrow.mapInArrow(batches, "h long, words long, owner long, place int, high long, low long").withColumn(
            "window", F.struct("high", "low")
        ),
        "windows",
    )
    first = single.groupBy("window").agg(F.min("owner").alias("first"), F.max("owner").alias("last"), F.count("*").alias("size"))
    held = attach_groups(single, first.where("first < last"), "window", "size", "owner").where(_later("owner", "first"))
    places = held.groupBy("h", "words").agg(F.collect_list("place").alias("places"))
    return places.select("h", "words", F.flatten(F.transform("places", lambda p: F.array(p, p + window))).alias("spans"))


def repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    block_fragments: int = BLOCK_FRAGMENTS,
) -> DataFrame:
    """(doc, body, frags): what to remove from the rows of an identifier and a text's hash.

    frags are (h, words, spans): a fragment's two hashes and the words of it that go, all where spans is null.
    """
    found = stage(fragments(docs, id_col, text_col, window, gram), "fragments")
    shared = found.groupBy("h").agg(
        F.min("doc").alias("first"),
        F.max("doc").alias("last"),
        F.count("*").alias("size"),
        (F.min("words") != F.max("words")).alias("mixed"),
    ).where("first < last")
    hits = stage(attach_groups(found, shared, "h", "size", "doc").drop("last", "size"), "shared-fragments")
    none = F.lit(None).cast("array<int>").alias("spans")
    alike = hits.where(~F.col("mixed") & _later("doc", "first")).select("doc", "body", "h", "words", none)

    mixed = hits.where("mixed").select("doc", "body", F.struct("h", "words").alias("frag"))
    kinds = mixed.groupBy("frag").agg(F.min(F.struct("doc", "body")).alias("least"), F.count("*").alias("size"))
    kinds = stage(kinds.select("frag", "size", F.col("least.doc").alias("owner"), F.col("least.body").alias("owner_body")), "kinds")
    whole = attach_groups(mixed, kinds.select("frag", "size", "owner"), "frag", "size", "doc").where(_later("doc", "owner"))
    copies = whole.select("doc", "body", "frag.h", "frag.words", none)

    wanted = kinds.select("frag", "owner", F.col("owner_body").alias("body"))
    texts = stage(fetch_texts(docs, wanted, id_col, text_col, window, gram).dropDuplicates(["h", "words"]), "fragment-texts")
    # Fewer than one in block_fragments of all kinds can be the anchor of so many.
    large = texts.groupBy("h").agg(F.count("*").alias("kinds")).where(F.col("kinds") > block_fragments).select("h")
    large = stage(large, "large-blocks")
    small = parse(texts.join(large, "h", "left_anti"), window)
    factored = small.unionByName(parse_windows(texts.join(large, "h", "left_semi"), window))
    # The owner's rows are all rows of its identifier that hold the fragment.
    owned = factored.select(F.struct("h", "words").alias("frag"), "spans").join(kinds.select("frag", "owner"), "frag")
    own = mixed.join(owned, [mixed["frag"] == owned["frag"], mixed["doc"] == owned["owner"]]).select(
        mixed["doc"], mixed["body"], mixed["frag"]["h"].alias("h"), mixed["frag"]["words"].alias("words"), "spans"
    )
    every = alike.unionByName(copies).unionByName(own)
    return every.groupBy("doc", "body").agg(F.collect_set(F.struct("h", "words", "spans")).alias("frags"))


def cut_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    block_fragments: int = BLOCK_FRAGMENTS,
) -> DataFrame:
    """docs with n_words, n_removed and kept, the words left, joined by one space."""
    gone = stage(repeats(docs, id_col, text_col, window, gram, block_fragments), "repeats")
    results = ["n_words", "n_removed", "kept"]
    fields = beside(docs, results)
    names = [field.name for field in fields]
    keyed = docs.select(
        *[F.col(f"`{n}`").alias(f"field_{at}") for at, n in enumerate(names)],
        F.col(f"`{text_col}`").alias("__text"),
        integer_key(id_col).alias("__doc"),
        _body(text_col).alias("__body"),
    )
    joined = keyed.join(gone, (F.col("__doc") == F.col("doc")) & (F.col("__body") == F.col("body")), "left").select(
        *[f"field_{at}" for at in range(len(names))], "__text", "frags"
    )

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            sizes, lost, kept = [], [], []
            frags = batch.column(len(names) + 1)
            for row, text in enumerate(as_bytes(batch.column(len(names)))):
                size, left = cut(text, frags[row].as_py(), window, gram)
                sizes.append(size)
                lost.append(size - len(left))
                kept.append(b" ".join(left))
            made = [pa.array(sizes, pa.int64()), pa.array(lost, pa.int64()), pa.array(kept, pa.binary()).view(pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *made], names=[*names, *results])

    made = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())]
    return joined.mapInArrow(batches, T.StructType([*fields, *made]))


def cut(text: bytes, frags: list[dict] | None, window: int, gram: int) -> tuple[int, list[bytes]]:
    """The number of words, and the words that stay."""
    if not frags:
        words = text.split()
        return len(words), words
    spans = {(f["h"], f["words"]): f["spans"] for f in frags}
    marked: list[tuple[int, np.ndarray]] = []
    words: list[bytes] = []
    for first, run in word_runs(text, window):
        words += run[len(words) - first :]
        here = np.zeros(len(run), bool)
        if len(run) >= window:
            for h, whole, start, end in Fragments(run, window, gram):
                if (h, whole) in spans:
                    cuts = spans[h, whole]
                    for a, b in [(0, end - start)] if cuts is None else zip(cuts[::2], cuts[1::2]):
                        here[start + a : start + b] = True
        marked.append((first, here))
    marks = np.zeros(len(words), bool)
    for first, here in marked:
        marks[first : first + len(here)] |= here
    return len(words), [word for word, gone in zip(words, marks.tolist()) if not gone]
