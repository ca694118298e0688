"""Phrase collocation mining in Toivonen's way: a sample proposes, whole passes decide.

A sample of the documents (by a hash of the identifier) proposes phrases that are frequent in
it at a lowered threshold, level by level: a phrase is only counted where the phrase without
its last word and the one without its first word are frequent there. A pass over all documents
then counts the proposals and their negative border exactly: every phrase whose two shorter
parts are proposed, which for single words is every word. Where a border phrase turns out
frequent, phrases that grow from it have not been counted yet; another pass counts those
whose parts are both known to be frequent and which no earlier pass has counted, and so on
until a pass finds no such phrase: then every frequent phrase has been counted.

What tasks look up is a bit field of the hashes of the known phrases, of at most MAX_BITS
bits however many there are. A wrong bit makes a phrase counted in vain and never
makes one lost; a phrase is counted wholly in one pass or not at all, because every pass uses
the fields of those before it. Counts are of the words themselves: positions of equal hash are
compared word by word before they are counted as one, and the shuffle groups by the phrase. Most
of the border are pairs: where the proposed words are at most PAIRED_WORDS, they are numbered and a
pair is shuffled as one number, by the same rule and with the same counts.
Counts are combined in batches of BATCH_BYTES, then map side, so a phrase that fills a
third of the text is a row a batch. Scores are decimals of 38 digits.

Defined results: a null language is `und`; a null or empty text has no words; repeated rows
count each; a language without frequent phrases has no rows; an empty table gives none; columns
of other names play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerfold.llm.texts import LOWER, UPPER, as_bytes, pieces
from ledgerfold.operators.numbering import number_rows
from ledgerfold.operators.skew import attach_groups
from ledgerfold.sources.staging import stage

# What ends a piece, and the least count of a phrase.
_BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
_CLEAN = bytes.maketrans(UPPER + b"\t" + _BREAKS, LOWER + b" " + b"." * len(_BREAKS))
MIN_COUNT = 100
MAX_WORDS = 5
BEST = 2000

SAMPLE_PARTS = 8
# The sample's threshold is this share of what MIN_COUNT comes to in it.
LOWERED = 0.4
BATCH_BYTES = 6_000_000
ROWS_OUT = 50_000
# A pass looks ahead where the border's failures have at most this part of all words: its candidates hold one of them each.
AHEAD = 16
# Up to this many proposed words are numbered, and their pairs counted by numbers instead of by words.
PAIRED_WORDS = 1_000_000
MIN_BITS, MAX_BITS, BITS_A_PHRASE = 16, 27, 64
COUNTS = "lang string, phrase string, size int, n long"
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


# --- inside tasks ---------------------------------------------------------------------------------------------


def _grown(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The hashes of phrases with one more word."""
    mixed = (hashes * _STEP + words) * _MIX
    return mixed ^ (mixed >> np.uint64(32))


def _seed(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(lang.encode(), seed=1))


def phrase_hashes(langs: list[str], phrases: list[str]) -> np.ndarray:
    """The hashes of phrases, as the batches compute them from place to place."""
    seeds = {lang: _seed(lang) for lang in set(langs)}
    found = np.fromiter((seeds[lang] for lang in langs), np.uint64, len(langs))
    words = [phrase.encode().split(b" ") for phrase in phrases]
    for k in range(MAX_WORDS):
        longer = np.array([at for at, some in enumerate(words) if len(some) > k], np.int64)
        own = np.fromiter((xxhash.xxh64_intdigest(words[at][k]) for at in longer), np.uint64, len(longer))
        found[longer] = _grown(found[longer], own)
    return found


class Field:
    """A set of hashes as bits: holds all that were put in, and some others."""

    def __init__(self, bits: int, words: np.ndarray) -> None:
        self.mask = np.uint64((1 << bits) - 1)
        self.words = words

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        slots = hashes & self.mask
        return (self.words[(slots >> np.uint64(6)).astype(np.int64)] >> (slots & np.uint64(63)) & np.uint64(1)).astype(bool)


class Batch:
    """The words of some documents of one language."""

    def __init__(self, lang: str) -> None:
        self.lang = lang
        self.texts: list[bytes] = []
        self.size = 0

    def add(self, text: bytes) -> None:
        for piece in pieces(text.translate(_CLEAN)):
            self.texts.append(piece.replace(b".", b" . "))
            self.size += len(piece)
        self.texts.append(b".")

    def numbered(self) -> tuple[np.ndarray, pa.Array]:
        """The words one after the other as numbers, 0 between pieces, and how they are spelt; a last 0 ends them."""
        texts = pa.array(self.texts, pa.large_binary()).view(pa.large_string())
        coded = pc.ascii_split_whitespace(texts).flatten().dictionary_encode()
        spelt = coded.dictionary.view(pa.large_binary())
        words = coded.indices.to_numpy().astype(np.int32) + 1
        # Blanks at an end of a text leave an empty word there.
        words = words[words != spelt.index(b"").as_py() + 1] if spelt.index(b"").as_py() >= 0 else words
        words[words == spelt.index(b".").as_py() + 1] = 0
        return np.append(words, np.int32(0)), pa.concat_arrays([pa.array([b"."], pa.large_binary()), spelt])

    def pairs(self, first: int, known: pa.Array) -> pa.RecordBatch:
        """(pair, n) of neighbours that are both known words; `first` is the number of the first of these."""
        words, spelt = self.numbered()
        own = pc.index_in(spelt, value_set=known).fill_null(-1).to_numpy()[words]
        own[words == 0] = -1
        held = (own[:-1] >= 0) & (own[1:] >= 0)
        left, right = own[:-1][held].astype(np.int64) + first, own[1:][held].astype(np.int64) + first
        pairs, counts = np.unique((left << 32) | right, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts.astype(np.int64))], names=["pair", "n"])

    def phrases(
        self, sizes: range, member: Field | None, done: list[Field], paired: pa.Array | None = None, ahead: bool = False
    ) -> Iterator[pa.RecordBatch]:
        """(lang, phrase, size, n): words, and longer phrases whose parts of every size are members.

        Left out is what a pass with one of the earlier fields has counted by the same rule. A first
        pass also gives the number of all words, as size 0. Pairs of the `paired` words are counted elsewhere.
        A pass that looks ahead takes phrases it counts itself as members too.
        """
        words, spelt = self.numbered()
        own = np.fromiter(map(xxhash.xxh64_intdigest, spelt.to_pylist()), np.uint64, len(spelt))
        single = _grown(np.full(len(own), _seed(self.lang)), own)
        inside = words != 0
        if 1 in sizes and not done:
            counts = np.bincount(words, minlength=len(spelt))
            yield self._rows(pa.array([b""], pa.large_binary()), 0, np.array([int(inside.sum())]))
            yield self._rows(spelt.slice(1), 1, counts[1:])
        # For each field, whether it lets a phrase be counted from a place; words always are.
        fields = [*([member] if member else []), *done]
        pairs = np.append(inside[:-1] & inside[1:], False)
        lets = []
        for field in fields:
            # Asked once for each word that occurs, not for each place.
            known = field.holds(single)[words]
            lets.append(pairs & known & np.append(known[1:], False))
        at = np.flatnonzero(lets[0] if member else pairs)
        hashes = np.zeros(len(words), np.uint64)
        own_count = np.zeros(len(words), bool)  # the places of the last size that this pass counts
        for size in range(2, sizes.stop):
            if size == 2:
                grown = _grown(single[words[at]], own[words[at + 1]])
            else:
                # The parts without the last and without the first word.
                at = at[words[at + size - 1] != 0]
                short, rest = hashes[at], hashes[at + 1]
                for n, field in enumerate(fields):
                    first, last = field.holds(short), field.holds(rest)
                    if ahead and n == 0:
                        first, last = first | own_count[at], last | own_count[at + 1]
                    held = lets[n][at] & lets[n][at + 1] & first & last
                    lets[n] = np.zeros(len(words), bool)
                    lets[n][at] = held
                if member:
                    at = at[lets[0][at]]
                grown = _grown(hashes[at], own[words[at + size - 1]])
                hashes[:] = 0
            hashes[at] = grown
            counted = np.zeros(len(at), bool)
            for let in lets[1 if member else 0 :]:
                counted |= let[at]
            if size == 2 and paired is not None:
                known = pc.is_in(spelt, value_set=paired).to_numpy(zero_copy_only=False)
                counted |= known[words[at]] & known[words[at + 1]]
            wanted = at[~counted]
            if ahead:
                own_count[:] = False
                own_count[wanted] = True
            if size in sizes and len(wanted):
                first, counts = self._groups(words, wanted, hashes[wanted], size)
                parts = [spelt.take(pa.array(words[first + k])) for k in range(size)]
                yield self._rows(pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary())), size, counts)

    @staticmethod
    def _groups(words: np.ndarray, at: np.ndarray, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """A place and the number of places of every phrase."""
        order = np.argsort(hashes, kind="stable")
        placed, sorted_hashes = at[order], hashes[order]
        new = np.append(True, sorted_hashes[1:] != sorted_hashes[:-1])
        differ = np.zeros(len(at), bool)
        for k in range(size):
            spelt = words[placed + k]
            differ[1:] |= spelt[1:] != spelt[:-1]
        if (differ & ~new).any():
            # Two phrases of one hash: sort by the words themselves.
            placed = at[np.lexsort([words[at + k] for k in reversed(range(size))])]
            new = np.zeros(len(at), bool)
            new[0] = True
            for k in range(size):
                spelt = words[placed + k]
                new[1:] |= spelt[1:] != spelt[:-1]
        else:
            new |= differ
        starts = np.flatnonzero(new)
        return placed[starts], np.diff(np.append(starts, len(placed)))

    def _rows(self, phrases: pa.Array, size: int, counts: np.ndarray) -> pa.RecordBatch:
        n = len(phrases)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([self.lang]).take(pa.array(np.zeros(n, np.int32))),
                phrases.cast(pa.binary()).view(pa.string()),
                pa.array(np.full(n, size, np.int32)),
                pa.array(counts.astype(np.int64)),
            ],
            names=["lang", "phrase", "size", "n"],
        )


# --- DataFrames -----------------------------------------------------------------------------------------------


def _batches(given: Iterator[pa.RecordBatch]) -> Iterator[Batch]:
    """Documents (lang, text) of a task as batches of one language each."""
    held: dict[str, Batch] = {}
    for batch in given:
        for lang, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
            if lang not in held:
                held[lang] = Batch(lang)
            held[lang].add(text)
            if sum(b.size for b in held.values()) >= BATCH_BYTES:
                while held:
                    yield held.popitem()[1]
    while held:
        yield held.popitem()[1]


def count_phrases(
    docs: DataFrame,
    sizes: range,
    member: Field | None,
    done: list[Field],
    paired: dict[str, pa.Array] | None = None,
    ahead: bool = False,
) -> DataFrame:
    """(lang, phrase, size, n) over docs (lang, text); `paired` are words whose pairs are left out."""
    shared = docs.sparkSession.sparkContext.broadcast((member, done, paired or {}))

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        member, done, paired = shared.value
        for full in _batches(given):
            for rows in full.phrases(sizes, member, done, paired.get(full.lang), ahead):
                for at in range(0, rows.num_rows, ROWS_OUT):
                    yield rows.slice(at, ROWS_OUT)

    counted = docs.select("lang", "text").mapInArrow(batches, COUNTS)
    return counted.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n"))


def word_numbers(proposed: DataFrame) -> DataFrame | None:
    """(lang, phrase, number) of the proposed words, in order; None where they are too many to send to every task."""
    words = proposed.where("size = 1")
    if words.limit(PAIRED_WORDS + 1).count() > PAIRED_WORDS:
        return None
    numbered = number_rows(words.select("lang", "phrase"), [F.col("lang"), F.col("phrase")], "number")
    return stage(numbered.withColumn("number", F.col("number") - 1), "word-numbers")


def count_pairs(docs: DataFrame, numbers: DataFrame, known: dict[str, pa.Array], min_count: int) -> DataFrame:
    """(lang, phrase, size, n) of the frequent pairs of numbered words; a pair is one number until it is counted."""
    starts = {r.lang: r.first for r in numbers.groupBy("lang").agg(F.min("number").alias("first")).collect()}
    shared = docs.sparkSession.sparkContext.broadcast((starts, known))

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, known = shared.value
        for full in _batches(given):
            if full.lang in known:
                rows = full.pairs(starts[full.lang], known[full.lang])
                for at in range(0, rows.num_rows, ROWS_OUT):
                    yield rows.slice(at, ROWS_OUT)

    counted = docs.select("lang", "text").mapInArrow(batches, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    frequent = counted.where(F.col("n") >= min_count)
    sides = frequent.select(F.expr("shiftright(pair, 32)").alias("left"), F.expr("pair & 4294967295").alias("right"), "n")
    first = numbers.select(F.col("number").cast("long").alias("left"), "lang", F.col("phrase").alias("one"))
    second = numbers.select(F.col("number").cast("long").alias("right"), F.col("phrase").alias("two"))
    return sides.join(first, "left").join(second, "right").select(
        "lang", F.concat_ws(" ", "one", "two").alias("phrase"), F.lit(2).alias("size"), "n"
    )


def field_of(phrases: DataFrame) -> Field:
    """The field of the given (lang, phrase); its size follows their number up to MAX_BITS."""
    bits = min(MAX_BITS, max(MIN_BITS, (phrases.count() * BITS_A_PHRASE).bit_length()))

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            slots = phrase_hashes(batch.column(0).to_pylist(), batch.column(1).to_pylist()) & np.uint64((1 << bits) - 1)
            yield pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int64))], names=["slot"])

    slots = phrases.select("lang", "phrase").mapInArrow(batches, "slot long")
    # One row for each word of the field that isn't zero: at most 2^(MAX_BITS - 6).
    packed = slots.groupBy(F.expr("shiftright(slot, 6)").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 AS int))")).alias("bits")
    )
    words = np.zeros(1 << (bits - 6), np.uint64)
    found = packed.toArrow()
    words[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return Field(bits, words)


def propose(sample: DataFrame, least: float) -> DataFrame:
    """(lang, phrase, size) frequent in the sample, level by level."""
    levels: list[DataFrame] = []
    member = None
    for size in range(1, MAX_WORDS + 1):
        frequent = count_phrases(sample, range(size, size + 1), member, []).where((F.col("n") >= least) & (F.col("size") > 0))
        levels.append(stage(frequent.select("lang", "phrase", "size"), "proposed"))
        if not levels[-1].take(1):
            break
        member = field_of(reduce(DataFrame.union, levels))
    return reduce(DataFrame.union, levels)


def frequent_phrases(
    docs: DataFrame, id_col: str = "doc_id", min_count: int = MIN_COUNT, sample_parts: int = SAMPLE_PARTS, lowered: float = LOWERED
) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, size, n) of all phrases of 1 to MAX_WORDS words counted min_count times, (lang, n) of all words)."""
    picked = F.pmod(F.xxhash64(F.col(id_col)), F.lit(sample_parts)) == 0
    narrow = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text", F.col(id_col))
    sample = stage(narrow.where(picked).select("lang", "text"), "sample")
    proposed = propose(sample, max(1.0, min_count / sample_parts * lowered))
    fields = [field_of(proposed)]
    numbers, known = word_numbers(proposed), {}
    if numbers is not None:
        # At most PAIRED_WORDS words.
        table = numbers.orderBy("number").select("lang", "phrase").toArrow()
        for lang in pc.unique(table.column("lang")).to_pylist():
            words = table.filter(pc.equal(table.column("lang"), lang)).column("phrase")
            known[lang] = pa.array(words.to_pylist(), pa.large_string()).view(pa.large_binary())
    first = count_phrases(narrow, range(1, MAX_WORDS + 1), fields[0], [], known)
    first = first.where((F.col("n") >= min_count) | (F.col("size") == 0))
    if numbers is not None:
        first = first.unionByName(count_pairs(narrow, numbers, known, min_count))
    counted = stage(first, "counted")
    totals = counted.where("size = 0").select("lang", F.col("n").alias("total"))
    frequent = counted.where("size > 0")
    # Phrases of the longest size have no longer ones.
    failures = frequent.where(F.col("size") < MAX_WORDS).join(proposed, ["lang", "phrase"], "left_anti")
    words = totals.agg(F.sum("total")).first()[0] or 0
    while uses := failures.agg(F.sum("n")).first()[0]:
        # Phrases counted before have both parts in one of the earlier fields.
        known, ahead = field_of(frequent), uses * AHEAD <= words
        more = stage(
            count_phrases(narrow, range(2, MAX_WORDS + 1), known, fields, None, ahead).where(F.col("n") >= min_count), "expanded"
        )
        fields.append(known)
        frequent = frequent.union(more)
        if ahead:
            break
        failures = more.where(F.col("size") < MAX_WORDS)
    return stage(frequent, "frequent"), totals


def _part(start: Column, length: Column) -> Column:
    return F.array_join(F.slice("words", start, length), " ")


def scored(frequent: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the lowest cut of every phrase of two words and more."""
    counts = frequent.select("lang", "phrase", F.col("n").alias("times"))
    cuts = (
        frequent.where("size >= 2")
        .select("lang", "phrase", F.col("n").alias("a"), "size", F.split("phrase", " ").alias("words"))
        .withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
        .select(
            "lang",
            "phrase",
            "a",
            "k",
            F.struct("lang", _part(F.lit(1), F.col("k")).alias("phrase")).alias("first"),
            F.struct("lang", _part(F.col("k") + 1, F.col("size") - F.col("k")).alias("phrase")).alias("rest"),
        )
    )
    found = cuts
    for side, name in (("first", "l"), ("rest", "r")):
        found = stage(found, "cuts")
        # A common word begins many phrases: its uses are counted, and spread where they are many.
        uses = found.groupBy(side).agg(F.count("*").alias("uses"))
        known = uses.join(
            counts.select(F.struct("lang", "phrase").alias(side), F.col("times").alias(name)), side
        )
        found = attach_groups(found, known, side, "uses", "phrase").drop("uses")
    exact = [F.col(c).cast("decimal(19,0)") for c in ("a", "total", "l", "r")]
    up = (exact[0] * exact[1]).cast("decimal(34,0)") * F.lit(1000).cast("decimal(4,0)")
    down = (exact[2] * exact[3]).cast("decimal(38,0)")
    found = found.join(F.broadcast(totals), "lang") if _few(totals) else found.join(totals, "lang")
    # div of decimals is whole-numbered and exact.
    valued = found.withColumn("up", up).withColumn("down", down).withColumn("score", F.expr("up div down"))
    lowest = valued.groupBy("lang", "phrase", "a", F.col("total").alias("n")).agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )
    return lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def _few(totals: DataFrame) -> bool:
    """Whether there are few enough languages to send them to every task."""
    return totals.limit(10_001).count() <= 10_000


def collocations(
    docs: DataFrame,
    id_col: str = "doc_id",
    min_count: int = MIN_COUNT,
    best: int = BEST,
    sample_parts: int = SAMPLE_PARTS,
    lowered: float = LOWERED,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the best phrases of every language of docs (id, lang, text)."""
    frequent, totals = frequent_phrases(docs, id_col, min_count, sample_parts, lowered)
    # A phrase inside a longer one that occurs as often also lies in one of a single word more.
    longer = frequent.where("size >= 3").select("lang", F.col("n").alias("times"), "size", F.split("phrase", " ").alias("words"))
    parts = longer.select(
        "lang",
        "times",
        F.explode(F.array(_part(F.lit(1), F.col("size") - 1), _part(F.lit(2), F.col("size") - 1))).alias("phrase"),
    )
    inside = parts.groupBy("lang", "phrase").agg(F.max("times").alias("times"))
    kept = (
        scored(frequent, totals)
        .join(inside, ["lang", "phrase"], "left")
        .where(F.col("times").isNull() | (100 * F.col("times") < 100 * F.col("a")))
    )
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return (
        kept.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= best)
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )
