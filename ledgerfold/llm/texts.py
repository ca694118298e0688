"""Words of whole texts inside tasks, a bounded number at a time."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK_BYTES = 1 << 21
UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))


def pieces(text: bytes, size: int = CHUNK_BYTES) -> Iterator[bytes]:
    """The text cut at spaces into pieces of about size bytes, so that no word is cut."""
    at = 0
    while len(text) - at > size:
        end = text.find(b" ", at + size)
        if end < 0:
            break
        yield text[at:end]
        at = end + 1
    yield text[at:] if at else text


def as_bytes(column: pa.Array) -> Iterator[bytes]:
    """The texts of an Arrow column as bytes, null as empty."""
    large = column.cast(pa.large_binary())
    return (value.as_py() or b"" for value in large)


def as_strings(column: pa.Array) -> pa.Array:
    """Binary values that are known to be text."""
    return column.view(pa.string())


def integer_key(name: str) -> Column:
    """An identifier as a number; a row without one comes after all others."""
    return F.coalesce(F.col(f"`{name}`").cast("long"), F.lit((1 << 63) - 1))


def beside(df: DataFrame, results: list[str]) -> list[T.StructField]:
    """The fields of df that no result replaces."""
    taken = {name.lower() for name in results}
    return [field for field in df.schema.fields if field.name.lower() not in taken]
