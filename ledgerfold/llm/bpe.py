"""Byte-level BPE encoding and decoding with a sentencepiece model made from a rank file.

The model is written out directly from the vocabulary: each byte of a token is mapped to the character
of its number, its score is its negative rank, and normalisation is the identity; so the merge of best
score is the merge of lowest rank. A text is cut into pre-tokens by the tokenizer's pattern; a pre-token that is a
token is that token, any other is encoded by the model. Decoding maps the pieces back to bytes.

The rank file is a parameter and is read on the driver; the model, a few MB however much text there is, is broadcast.
A worker remembers the ids of at most two times CACHE pre-tokens, beside those of the text at hand.

Defined results: a null text is an empty one and has no tokens; decoding null or no ids gives no bytes; texts are
encoded whole, whatever their length; rows that repeat are encoded each; no rows give no rows; a
result column replaces an input column of its name.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerfold.sources.batches import bound_batches

CACHE = 1 << 17
ZERO = "\u0100"  # stands for the byte 0, which a piece must not hold
UNKNOWN = "\u0101"  # no byte's character, so no text needs it


# --- the model ------------------------------------------------------------------------------------------------


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank from lines of base64 and rank; the ranks must be 0, 1, 2, ..."""
    with open(path, "rb") as file:
        pairs = [(int(rank), base64.b64decode(token)) for token, rank in (line.split() for line in file if line.strip())]
    tokens = [token for _, token in sorted(pairs)]
    if sorted(rank for rank, _ in pairs) != list(range(len(pairs))) or len(set(tokens)) != len(tokens):
        raise ValueError("ranks must count from 0 without gaps, and tokens must differ")
    if {bytes([b]) for b in range(256)} - set(tokens):
        raise ValueError("every byte must be a token")
    return tokens


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | int) -> bytes:
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def as_chars(token: bytes) -> str:
    return token.decode("latin-1").replace("\0", ZERO)


def model_bytes(tokens: list[bytes]) -> bytes:
    """A sentencepiece model whose ids are the ranks; the unknown piece, which no text needs, comes last.

    Field numbers are those of sentencepiece's public model format.
    """
    pieces = [
        _field(1, _field(1, as_chars(token).encode()) + _varint(2 << 3 | 5) + struct.pack("<f", -rank))
        for rank, token in enumerate(tokens)
    ]
    unknown = _field(1, _field(1, UNKNOWN.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", 0) + _field(3, 2))
    no_id = (1 << 64) - 1  # -1
    trainer = (
        _field(3, 2)  # model type BPE
        + _field(4, len(tokens) + 1)
        + _field(40, len(tokens))  # unknown, begin, end, pad
        + _field(41, no_id)
        + _field(42, no_id)
        + _field(43, no_id)
    )
    # No dummy prefix, no blanks removed or escaped.
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + unknown + _field(2, trainer) + _field(3, normaliser)


# --- one worker's codec ---------------------------------------------------------------------------------------


def characters(kind: str) -> list[int]:
    """The code points of a property, by the Unicode tables of the tokenizer's own pattern engine."""
    engine = tiktoken.Encoding(
        "characters", pat_str=kind, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={}
    )
    everything = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    # What the pattern does not match is left out.
    return [ord(c) for c in engine.decode_bytes(engine.encode_ordinary(everything)).decode()]


def _class(points: list[int], top: int) -> str:
    """The inside of a character class of the code points below top."""
    found = {c for c in points if c < top}
    starts = sorted(c for c in found if c - 1 not in found)
    ends = sorted(c for c in found if c + 1 not in found)
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(starts, ends))


def written_out(pattern: str) -> tuple[str, str]:
    """The pattern with its classes written out: for texts of the basic plane, which is faster, and for any."""
    names = (r"\s", r"\p{L}", r"\p{N}")
    points = {name: characters(name) for name in names}
    done = []
    for top in (0x10000, 0x110000):
        inner = {name: _class(points[name], top) for name in names}
        out = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{''.join(inner.values())}]").replace(r"\S", f"[^{inner[r'\s']}]")
        for name in names:
            out = out.replace(name, f"[{inner[name]}]")
        done.append(out)
    return done[0], done[1]


class Codec:
    """Encodes and decodes single texts; cheap to ship, builds its tables when first used."""

    def __init__(self, tokens: list[bytes], pattern: str) -> None:
        self.__setstate__((tokens, written_out(pattern), model_bytes(tokens)))

    def __getstate__(self):
        return self.tokens, self.patterns, self.model

    def __setstate__(self, state) -> None:
        self.tokens, self.patterns, self.model = state
        self.back: list[bytes] = []

    def _build(self) -> None:
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=self.model)
        self.whole = {token: rank for rank, token in enumerate(self.tokens)}
        self.cut_basic, self.cut_any = (re.compile(pattern).findall for pattern in self.patterns)
        # Pre-tokens and their ids, in two generations: the older one goes when the younger is full.
        self.young: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}
        # One number object an id, however many pre-tokens hold it.
        self.numbers = list(range(len(self.tokens) + 1))
        self.decimals = [str(i) for i in range(len(self.tokens))]
        self.back = [self._bytes_of(self.processor.id_to_piece(i)) for i in range(len(self.tokens))]

    def _learn(self, parts: set[str]) -> None:
        if len(self.young) + len(parts) > CACHE:
            self.old, self.young = self.young, {}
        unknown = []
        for part in parts.difference(self.young):
            ids = self.old.get(part)
            if ids is None:
                rank = self.whole.get(part.encode())
                if rank is None:
                    unknown.append(part)
                    continue
                ids = (self.numbers[rank],)
            self.young[part] = ids
        if unknown:
            # One call for all: the separator is unknown to the model, so nothing merges across it.
            joined = UNKNOWN.join([as_chars(part.encode()) for part in unknown])
            ids = self.processor.encode(joined, num_threads=1)
            ids.append(len(self.tokens))
            at = 0
            for part in unknown:
                end = ids.index(len(self.tokens), at)
                self.young[part] = tuple(map(self.numbers.__getitem__, ids[at:end]))
                at = end + 1

    @staticmethod
    def _bytes_of(piece: str) -> bytes:
        return piece.replace(ZERO, "\0").encode("latin-1")

    def encode(self, text: str) -> list[int]:
        if not self.back:
            self._build()
        basic = len(text.encode("utf-16-le")) == 2 * len(text)
        parts = self.cut_basic(text) if basic else self.cut_any(text)
        missing = set(parts).difference(self.young)
        if missing:
            self._learn(set(parts) if len(self.young) + len(missing) > CACHE else missing)
        return list(chain.from_iterable(map(self.young.__getitem__, parts)))

    def in_decimal(self, ids: list[int]) -> str:
        """The ids joined by commas."""
        if not self.back:
            self._build()
        return ",".join(map(self.decimals.__getitem__, ids))

    def decode(self, ids: list[int]) -> bytes:
        if not self.back:
            self._build()
        return b"".join(map(self.back.__getitem__, ids))


def make_codec(path: str, pattern: str) -> Codec:
    return Codec(read_ranks(path), pattern)


# --- DataFrames -----------------------------------------------------------------------------------------------


def _with_columns(
    df: DataFrame,
    name: str,
    wanted: list[T.StructField],
    work: Callable[[pa.Array], list[pa.Array]],
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """df, or its columns in `keep`, with columns made from one of its columns, batch by batch; they replace columns of their name.

    The column goes to Python once, and comes back only where it is kept.
    """
    taken = {field.name.lower() for field in wanted}
    kept = [df.schema[n] for n in df.columns if n.lower() not in taken] if keep is None else [df.schema[n] for n in keep]
    names = [field.name for field in kept]
    at = names.index(name) if name in names else len(names)

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            made = work(batch.column(at))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(names)], *made], names=[*names, *(field.name for field in wanted)]
            )

    apart = [F.col(name).alias("__given")] if at == len(names) else []
    given = df.select(*[F.col(f"`{n}`") for n in names], *apart)
    bound_batches(df.sparkSession)
    return given.mapInArrow(batches, T.StructType([*kept, *wanted]))


def _texts(column: pa.Array) -> Iterator[str]:
    return (value.as_py() or "" for value in column)


def encode(spark: SparkSession, df: DataFrame, codec: Codec, text_col: str = "text") -> DataFrame:
    """df with `ids`, the tokens of a text."""
    shared = spark.sparkContext.broadcast(codec)
    return _with_columns(
        df,
        text_col,
        [T.StructField("ids", T.ArrayType(T.IntegerType(), False))],
        lambda column: [pa.array([shared.value.encode(t) for t in _texts(column)], pa.list_(pa.int32()))],
    )


def decode(spark: SparkSession, df: DataFrame, codec: Codec, ids_col: str = "ids") -> DataFrame:
    """df with `decoded`, the bytes of the tokens."""
    shared = spark.sparkContext.broadcast(codec)
    return _with_columns(
        df,
        ids_col,
        [T.StructField("decoded", T.BinaryType())],
        lambda column: [pa.array([shared.value.decode(ids.as_py() or []) for ids in column], pa.binary())],
    )


def round_trip_digests(
    spark: SparkSession, df: DataFrame, codec: Codec, text_col: str = "text", keep: Sequence[str] | None = None
) -> DataFrame:
    """df, or its columns in `keep`, with n_tokens, ids_sha256 and decoded_sha256: each text is encoded, and its ids decoded."""
    shared = spark.sparkContext.broadcast(codec)

    def work(column: pa.Array) -> list[pa.Array]:
        counts, ids_hex, decoded_hex = [], [], []
        for text in _texts(column):
            ids = shared.value.encode(text)
            counts.append(len(ids))
            ids_hex.append(hashlib.sha256(shared.value.in_decimal(ids).encode()).hexdigest())
            decoded_hex.append(hashlib.sha256(shared.value.decode(ids)).hexdigest())
        return [pa.array(counts, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(decoded_hex, pa.string())]

    return _with_columns(
        df,
        text_col,
        [
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ],
        work,
        keep,
    )
