"""Small text helpers shared by the scalar functions."""

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerfold.constants import WHITESPACE

# One character class for Unicode white space; Java's \s alone is ASCII-only.
SPACE_CLASS = "[" + WHITESPACE + "]"


def strip(text: Column) -> Column:
    """Trim every kind of Unicode white space; Spark's trim() drops spaces only."""
    return F.btrim(text, F.lit(WHITESPACE))


def rstrip(text: Column, chars: str) -> Column:
    return F.rtrim(text, F.lit(chars))


def value_or(text: Column, fallback: str) -> Column:
    """The trimmed text, or the fallback where it is missing or blank."""
    return F.coalesce(F.nullif(strip(text), F.lit("")), F.lit(fallback))


def sql_text(value: str) -> str:
    """A SQL string literal; raw, so that a backslash stands for itself."""
    quote = "'" if "'" not in value else '"'
    if quote in value:
        raise ValueError(f"both kinds of quotes in {value!r}")
    return f"r{quote}{value}{quote}"


def lookup(key: Column, table: Mapping[str, str]) -> Column:
    """Value of a small fixed table, NULL for other keys; the map is one literal."""
    entries = ", ".join(f"{sql_text(k)}, {sql_text(v)}" for k, v in table.items())
    return F.try_element_at(F.expr(f"map({entries})"), key)


def iso_seconds(ts: Column) -> Column:
    """A timestamp cut to whole seconds, as ISO-8601 text without a zone."""
    return F.date_format(F.date_trunc("second", ts), "yyyy-MM-dd'T'HH:mm:ss")
