"""What the bytes say: hash and true type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerfold.constants import EXPECTED_TYPES, HEAD_BYTES, SIGNATURES, UNASSIGNED
from ledgerfold.functions.text import lookup, value_or


def content_hash(content: Column) -> Column:
    return F.sha2(content, 256)


def _whole_characters(head: Column) -> Column:
    """Drop a character cut in two by the end of a full head (at most 3 bytes)."""
    size = F.length(head)
    last = F.hex(F.substring(head, size - 2, F.lit(3)))
    cut = (
        F.when(last.rlike("^....(C[2-9A-F]|D.|E.|F[0-4])$"), 1)
        .when(last.rlike("^..(E.|F[0-4])[89AB].$"), 2)
        .when(last.rlike("^F[0-4][89AB].[89AB].$"), 3)
        .otherwise(0)
    )
    return F.when(size >= HEAD_BYTES, F.substring(head, F.lit(1), size - cut)).otherwise(head)


def true_type(content: Column) -> Column:
    """Type by leading bytes: a signature, `text` for UTF-8, `empty` or `unknown`."""
    head = F.substring(content, 1, HEAD_BYTES)
    marks = "|".join(f"({signature})" for signature, _ in SIGNATURES)
    # The first bytes in hex, reduced to the signature they begin with, if any.
    mark = F.regexp_extract(F.hex(F.substring(content, 1, 8)), f"^(?:{marks})", 0)
    readable = F.is_valid_utf8(_whole_characters(head).cast("string"))
    return (
        F.when(F.length(head) == 0, "empty")
        .when(mark != "", lookup(mark, dict(SIGNATURES)))
        .when(readable, "text")
        .otherwise("unknown")
    )


def expected_types(extension: Column) -> Column:
    """Content types an extension may hold, joined by a comma; NULL if unmodelled."""
    return lookup(F.lower(extension), {ext: ",".join(kinds) for ext, kinds in EXPECTED_TYPES.items()})


def type_disagrees(extension: Column, kind: Column) -> Column:
    """True where a modelled extension does not allow the content type."""
    return F.coalesce(F.find_in_set(kind, expected_types(extension)) == 0, F.lit(False))


def author_or_unassigned(author: Column) -> Column:
    return value_or(author, UNASSIGNED)
