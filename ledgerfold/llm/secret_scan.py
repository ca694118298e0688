"""Secret scans: fixed patterns, and a battery of randomness tests for what they miss.

Patterns find assignments, access keys and hexadecimal runs. Other long tokens of letters and digits
are candidates if no pattern's span overlaps them. The encoding of a candidate is inferred from the kinds of characters
it has; three tests then ask how well it looks like uniform random symbols of that alphabet: chi-squared of the symbol
counts, runs above and below the middle, and correlation of neighbours. Fisher's method
combines their p-values into one figure from 0 to 1; random tokens spread over it evenly, prose is near 0.

What prose gives is measured on all of the corpus: every text, without its separators, is cut into
pieces of the shortest length of each class, and their figures are counted by length class and bin. Against these counts a
candidate has a p-value of its own, and the Benjamini-Hochberg procedure in each length class
keeps the expected share of false discoveries below FALSE_SHARE. Counts of bins are all that the driver sees: classes times BINS rows.

Texts are read once; what is stored between the two steps are spans.

Defined results: a null text is an empty one and has no spans; texts are read whole; rows that repeat are answered
each; no rows give no rows; a null identifier stays null; columns but identifier and text are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.sources.staging import stage

# The patterns, as the contract states them.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ASSIGN_VALUE, ACCESS_LENGTH, HEX_LENGTH = 12, 18, 16
# A run is matched whole, so asking for its length at once finds the same spans.
ACCESS = re.compile(r"AKIA[A-Z0-9]{%d,}" % (ACCESS_LENGTH - 4))
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{%d,}" % HEX_LENGTH)
KINDS = ("assign", "access", "hex", "random")

CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}")
LENGTHS = (20, 32, 48)  # where the length classes begin
BINS = 200
FALSE_SHARE = 0.05
PIECES = 1 << 15  # compared at once
# Digits, upper case, lower case, others: a symbol's kind and its place in it.
_KIND = np.full(256, 3, np.int8)
_PLACE = np.zeros(256, np.int16)
for _k, _chars in enumerate(("0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "+/-_")):
    for _i, _c in enumerate(_chars):
        _KIND[ord(_c)], _PLACE[ord(_c)] = _k, _i
_SIZES = np.array([10, 26, 26, 2])
_ALNUM = _KIND < 3
_HEX_LETTERS = 6


# --- the battery ----------------------------------------------------------------------------------------------


def _upper_tail(z: np.ndarray) -> np.ndarray:
    """Of the normal distribution (a rational approximation, exact to 1e-7)."""
    t = 1 / (1 + 0.2316419 * np.abs(z))
    series = t * (0.31938153 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = np.exp(-z * z / 2) / np.sqrt(2 * np.pi) * series
    return np.where(z >= 0, tail, 1 - tail)


def alphabet(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of each row of bytes as numbers in its inferred alphabet, and the alphabet's size."""
    kinds, places = _KIND[codes], _PLACE[codes]
    has = np.stack([(kinds == k).any(axis=1) for k in range(4)], axis=1)
    letters = np.where(kinds > 0, places, 0).max(axis=1)
    one_case = has[:, 0] & (has[:, 1] ^ has[:, 2]) & ~has[:, 3]
    hexadecimal = one_case & (letters < _HEX_LETTERS)
    base32 = one_case & has[:, 1] & ~hexadecimal & (np.where(kinds == 0, (places < 2) | (places > 7), False).sum(axis=1) == 0)
    sizes = has * _SIZES
    starts = np.cumsum(sizes, axis=1) - sizes
    symbols = np.take_along_axis(starts, kinds.astype(np.int64), axis=1) + np.minimum(places, np.where(kinds == 3, 1, 99))
    size = sizes.sum(axis=1)
    size = np.where(hexadecimal, 16, size)
    # Digits 2 to 7 and 26 letters.
    symbols = np.where(base32[:, None], symbols - np.where(kinds == 0, 2, 4), symbols)
    return symbols, np.where(base32, 32, size)


def randomness(codes: np.ndarray) -> np.ndarray:
    """The combined p-value of uniform randomness for rows of one length (bytes of letters, digits and +/-_)."""
    rows, n = codes.shape
    symbols, size = alphabet(codes)
    counts = np.bincount((np.arange(rows)[:, None] * 66 + symbols).ravel(), minlength=rows * 66).reshape(rows, 66)
    squares = (counts.astype(np.float64) ** 2).sum(axis=1)
    chi = squares * size / n - n
    # Mean and variance of the statistic are exact for uniform symbols, whatever the length.
    p_uniform = _upper_tail((chi - (size - 1)) / np.sqrt(np.maximum(2.0 * (size - 1) * (n - 1) / n, 1e-9)))

    above = symbols * 2 >= size[:, None]
    ones = above.sum(axis=1)
    mean = 2.0 * ones * (n - ones) / n + 1
    spread = np.sqrt(np.maximum((mean - 1) * (mean - 2) / (n - 1), 1e-9))
    runs = 1 + (above[:, 1:] != above[:, :-1]).sum(axis=1)
    p_runs = np.where((ones == 0) | (ones == n), 1e-6, 2 * _upper_tail(np.abs(runs - mean) / spread))

    around = symbols - symbols.mean(axis=1, keepdims=True)
    power = (around**2).sum(axis=1)
    serial = (around[:, 1:] * around[:, :-1]).sum(axis=1) / np.where(power > 0, power, 1)
    p_serial = np.where(power > 0, 2 * _upper_tail(np.abs(serial + 1 / n) * np.sqrt(n)), 1e-6)

    half = -np.log(np.clip(p_uniform, 1e-12, 1) * np.clip(p_runs, 1e-12, 1) * np.clip(p_serial, 1e-12, 1))
    return np.exp(-half) * (1 + half + half * half / 2)


def _bin(figure: np.ndarray) -> np.ndarray:
    return np.minimum((figure * BINS).astype(np.int64), BINS - 1)


def length_class(n: int) -> int:
    return sum(n >= at for at in LENGTHS) - 1


# --- one text -------------------------------------------------------------------------------------------------


def pattern_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in that order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_VALUE]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    """(start, end, length class, bin) of long tokens outside the spans with two kinds of characters at least."""
    found = []
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        token = m[0].rstrip("=")
        kinds = any(c.isdigit() for c in token) + any(c.isupper() for c in token) + any(c.islower() for c in token)
        if kinds < 2 or any(s < end and start < e for s, _, e in spans):
            continue
        figure = randomness(np.frombuffer(token.encode(), np.uint8)[None, :])
        found.append((start, end, length_class(len(token)), int(_bin(figure)[0])))
    return found


def prose_counts(texts: list[bytes]) -> Counter:
    """(length class, bin) counts of the pieces of texts without their separators."""
    counts: Counter = Counter()
    letters = [np.frombuffer(text, np.uint8) for text in texts]
    letters = [codes[_ALNUM[codes]] for codes in letters]
    for at, n in enumerate(LENGTHS):
        whole = [codes[: len(codes) // n * n] for codes in letters if len(codes) >= n]
        if not whole:
            continue
        pieces = np.concatenate(whole).reshape(-1, n)
        for first in range(0, len(pieces), PIECES):
            bins = np.bincount(_bin(randomness(pieces[first : first + PIECES])), minlength=BINS)
            counts.update({(at, int(b)): int(bins[b]) for b in np.flatnonzero(bins)})
    return counts


# --- DataFrames -----------------------------------------------------------------------------------------------

_SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
_TOKEN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("class", pa.int32()), ("bin", pa.int32())])
TEXTS_AT_ONCE = 500


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each text, and rows of counts (without spans) for all."""
    for whole in batches:
        for first in range(0, whole.num_rows, TEXTS_AT_ONCE):
            batch = whole.slice(first, TEXTS_AT_ONCE)
            texts = [text.as_py() or "" for text in batch.column(1)]
            spans = [pattern_spans(text) for text in texts]
            tokens = [candidates(text, found) for text, found in zip(texts, spans)]
            counts = sorted(prose_counts([text.encode("ascii", "ignore") for text in texts]).items())
            blank = [None] * len(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([batch.column(0), pa.nulls(len(counts), batch.column(0).type)]),
                    pa.array([[dict(zip(("start", "kind", "end"), s)) for s in found] for found in spans] + blank, pa.list_(_SPAN)),
                    pa.array(
                        [[dict(zip(("start", "end", "class", "bin"), t)) for t in found] for found in tokens] + blank,
                        pa.list_(_TOKEN),
                    ),
                    pa.array([None] * len(texts) + [c for (c, _), _ in counts], pa.int32()),
                    pa.array([None] * len(texts) + [b for (_, b), _ in counts], pa.int32()),
                    pa.array([None] * len(texts) + [n for _, n in counts], pa.int64()),
                ],
                names=["id", "spans", "tokens", "class", "bin", "n"],
            )


def least_bins(prose: dict[tuple[int, int], int], found: dict[tuple[int, int], int]) -> list[int]:
    """For each length class the lowest bin whose candidates are discoveries; BINS if there are none."""
    least = []
    for at in range(len(LENGTHS)):
        pieces = sum(n for (c, _), n in prose.items() if c == at)
        total = sum(n for (c, _), n in found.items() if c == at)
        lowest, above, as_random = BINS, 0, 0
        for b in reversed(range(BINS)):
            above += found.get((at, b), 0)
            as_random += prose.get((at, b), 0)
            if found.get((at, b)) and (1 + as_random) / (1 + pieces) <= FALSE_SHARE * above / total:
                lowest = b
        least.append(lowest)
    return least


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans): array of (start, kind, end) in that order; kind counts in KINDS, code points, end exclusive."""
    kind = docs.schema[id_col].dataType.simpleString()
    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = (
        f"id {kind}, spans array<struct<start:bigint,kind:int,end:bigint>>,"
        " tokens array<struct<start:bigint,end:bigint,class:int,bin:int>>, class int, bin int, n bigint"
    )
    rows = stage(given.mapInArrow(_scan, schema), "secrets")
    prose = rows.where("n IS NOT NULL").groupBy("class", "bin").agg(F.sum("n").alias("n")).collect()
    tokens = rows.select(F.explode("tokens").alias("t")).groupBy("t.class", "t.bin").agg(F.count("*").alias("n")).collect()
    least = least_bins({(r["class"], r["bin"]): r["n"] for r in prose}, {(r["class"], r["bin"]): r["n"] for r in tokens})
    limits = F.array(*[F.lit(b) for b in least])
    random = F.transform(
        F.filter("tokens", lambda t: t["bin"] >= F.get(limits, t["class"])),
        lambda t: F.struct(t["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"), t["end"].alias("end")),
    )
    return rows.where("n IS NULL").select("id", F.array_sort(F.concat("spans", random)).alias("spans"))


def span_list(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )
