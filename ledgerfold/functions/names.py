"""What a file name gives away."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerfold.constants import JUNK_NAMES, JUNK_PREFIX, STATUS_WORDS
from ledgerfold.functions.paths import stem, suffix
from ledgerfold.functions.text import SPACE_CLASS, strip

# --- fixed values: copy and version marks ------------------------------------
# `copy of ` in front; at the end a version, a copy mark and a copy number, each
# at most once and only in this order.
STEM_MARKS = (
    r"^copy of |"
    r"(?:_v\p{Nd}+)?"
    f"(?:{SPACE_CLASS}*-{SPACE_CLASS}*copy)?"
    f"(?:{SPACE_CLASS}*" r"\(\p{Nd}+\))?$"
)
SCANNER_NAME = r"(?s)^scan_\p{Nd}+\z"


def normalized_stem(name: Column) -> Column:
    """The stem without copy and version marks, so twins share one key."""
    return strip(F.regexp_replace(F.lower(stem(name)), STEM_MARKS, ""))


def is_junk(name: Column) -> Column:
    return name.startswith(JUNK_PREFIX) | F.lower(name).isin(*JUNK_NAMES)


def naming_reasons(name: Column) -> Column:
    """Why a name breaks the convention, joined by '; '; '' for a clean name."""
    low = F.lower(name)
    ext = suffix(name)
    words = F.concat_ws(", ", *[F.when(F.contains(low, F.lit(w)), F.lit(w)) for w in STATUS_WORDS])
    return F.concat_ws(
        "; ",
        F.when(name.rlike(SPACE_CLASS), F.lit("contains spaces")),
        F.when(ext != F.lower(ext), F.concat(F.lit("non-lowercase extension '"), ext, F.lit("'"))),
        F.when(words != "", F.concat(F.lit("ad-hoc status word(s): "), words)),
        F.when(
            F.lower(stem(name)).rlike(SCANNER_NAME),
            F.lit("scanner-default name (no document identity)"),
        ),
    )
