"""From a document's text and a model's raw answer to a classification."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerfold.constants import (
    LABELS,
    MIN_CHARS,
    STATUS_MODEL_ERROR,
    STATUS_NO_TEXT,
    STATUS_OK,
    TEXT_WINDOW,
    UNCLASSIFIED,
)
from ledgerfold.functions.text import strip


def text_window(text: Column, size: int | None = TEXT_WINDOW) -> Column:
    """The first `size` characters; the whole text where size is None."""
    return text if size is None else F.substring(text, 1, size)


def readable(text: Column) -> Column:
    return F.length(strip(text)) >= MIN_CHARS


def no_text_reason(text: Column) -> Column:
    chars = F.length(strip(text)).cast("string")
    return F.concat(F.lit("no extractable text ("), chars, F.lit(" chars)"))


def classification(label: Column, confidence: Column, status: Column, reason: Column) -> Column:
    names = ("label", "confidence", "status", "reason")
    fields = zip(names, (label, confidence.cast("double"), status, reason))
    return F.named_struct(*[part for name, value in fields for part in (F.lit(name), value)])


def _failure(status: str, reason: Column) -> Column:
    return classification(F.lit(UNCLASSIFIED), F.lit(0.0), F.lit(status), reason)


def no_text(text: Column) -> Column:
    return _failure(STATUS_NO_TEXT, no_text_reason(text))


def _field(fields: Column, name: str, when_null: str) -> Column:
    """A field as text: '' when absent, a given word when it is JSON null."""
    value = F.element_at(fields, F.lit(name))
    return F.when(~F.map_contains_key(fields, name), F.lit("")).otherwise(
        F.coalesce(value, F.lit(when_null))
    )


def _in_quotes(text: Column) -> Column:
    """Text in single quotes, or in double ones when only single ones occur in it."""
    for char, shown in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(char), F.lit(shown))
    has_single = F.contains(text, F.lit("'"))
    has_double = F.contains(text, F.lit('"'))
    escaped = F.replace(text, F.lit("'"), F.lit("\\'"))
    return (
        F.when(has_single & ~has_double, F.concat(F.lit('"'), text, F.lit('"')))
        .when(has_single, F.concat(F.lit("'"), escaped, F.lit("'")))
        .otherwise(F.concat(F.lit("'"), text, F.lit("'")))
    )


def round_to_cents(number: Column) -> Column:
    """To two places by the exact binary value; exact ties go to the even cent.

    The printed form of a double may be a tie that its value is not, so the value
    is compared with the middle between two cents without a rounding step: 200 times
    its upper and lower half are exact.
    """
    size = F.abs(number)
    cents = F.floor(size * 100).cast("double")
    split = size * 134217729.0
    upper = split - (split - size)
    beyond = (upper * 200 - (cents * 2 + 1)) + (size - upper) * 200
    up = (beyond > 0) | (beyond == 0) & (cents % 2 == 1)
    rounded = F.signum(number) * F.when(up, cents + 1).otherwise(cents) / 100
    # From 2^45 on a double has no cents; infinity and NaN stay what they are.
    return F.when(size < float(1 << 45), rounded).otherwise(number)


# How a number is written.
NUMBER = r"(?i)^[+-]?(([0-9]+([.][0-9]*)?|[.][0-9]+)(e[+-]?[0-9]+)?|inf|infinity|nan)$"


def parse_answer(
    raw: Column,
    error: Column | None = None,
    labels: Sequence[str] = LABELS,
    reason_chars: int | None = None,
) -> Column:
    """Raw JSON answer -> struct(label, confidence, status, reason).

    `error` names the exception of a call that failed for this document; `reason_chars`
    cuts the reason, which is kept whole without it.
    """
    fields = F.from_json(raw, "map<string,string>")
    is_json = F.coalesce(F.rtrim(raw).endswith("}"), F.lit(False)) & fields.isNotNull()
    label = strip(F.lower(_field(fields, "label", "None")))
    given = strip(F.element_at(fields, F.lit("confidence")))
    # A number too large for a double comes out of the JSON reader in quotes.
    given = F.regexp_replace(given, '^"(-?Infinity|NaN)"$', "$1")
    number = F.when(given == "true", F.lit(1.0)).when(given.rlike(NUMBER), given.try_cast("double"))
    confidence = F.coalesce(round_to_cents(number), F.lit(0.0))
    reason = text_window(strip(_field(fields, "reason", "None")), reason_chars)
    error = F.lit(None).cast("string") if error is None else error
    failed = F.concat(F.lit("model call failed: "), F.coalesce(error, F.lit("JSONDecodeError")))
    return (
        F.when(error.isNotNull() | ~is_json, _failure(STATUS_MODEL_ERROR, failed))
        .when(
            ~label.isin(*labels),
            _failure(
                STATUS_MODEL_ERROR,
                F.concat(F.lit("model returned invalid label "), _in_quotes(label)),
            ),
        )
        .otherwise(classification(label, confidence, F.lit(STATUS_OK), reason))
    )
