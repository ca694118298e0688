"""Paths inside a collection: `<collection>/<folders>/<name>`, POSIX separators."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerfold.constants import (
    FOLDER_HINTS,
    ILLEGAL_BUCKET_CHARS,
    INTAKE_ROOT_LABEL,
    UNASSIGNED,
)
from ledgerfold.functions.text import lookup, strip


def manifest_path(collection: Column, inner_path: Column) -> Column:
    return F.concat_ws("/", collection, inner_path)


def inner_path(path: Column) -> Column:
    """Everything after the first component; '' when there is no separator."""
    cut = F.instr(path, "/")
    return F.when(cut > 0, F.substring(path, cut + 1, F.length(path))).otherwise("")


def collection_name(path: Column) -> Column:
    return F.substring_index(path, "/", 1)


def source_path(collection_root: Column, path: Column) -> Column:
    """The exact inverse of manifest_path: the file's place in the store."""
    return F.concat(collection_root, F.lit("/"), inner_path(path))


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def _last_part(name: Column) -> tuple[Column, Column]:
    """What follows the last dot, and whether it is a suffix: not in `.name` or `name.`."""
    part = F.substring_index(name, ".", -1)
    return part, (part != "") & (F.length(part) < F.length(name) - 1)


def suffix(name: Column) -> Column:
    """Last dot part with its case kept."""
    part, is_suffix = _last_part(name)
    return F.when(is_suffix, F.concat(F.lit("."), part)).otherwise("")


def stem(name: Column) -> Column:
    part, is_suffix = _last_part(name)
    return F.when(is_suffix, F.left(name, F.length(name) - F.length(part) - 1)).otherwise(name)


def folder_depth(path: Column) -> Column:
    """Number of folders between the collection root and the file."""
    separators = F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))
    return F.greatest(F.lit(0), separators - 1).cast("bigint")


def original_folder(path: Column) -> Column:
    """The folder inside the collection; '' for files at the top level."""
    inner = inner_path(path)
    return F.when(F.contains(inner, F.lit("/")), F.regexp_replace(inner, r"/[^/]*$", "")).otherwise("")


def folder_label(path: Column) -> Column:
    label = F.btrim(original_folder(path), F.lit("/."))
    return F.when(label == "", INTAKE_ROOT_LABEL).otherwise(label)


def folder_hint(path: Column, hints: Mapping[str, str] = FOLDER_HINTS) -> Column:
    """Label the first folder stands for; '' when there is none (case-sensitive)."""
    inner = inner_path(path)
    # A file at the top level is looked up as '', which stands for no folder.
    first = F.substring_index(F.when(F.contains(inner, F.lit("/")), inner).otherwise(""), "/", 1)
    return F.coalesce(lookup(first, hints), F.lit(""))


def safe_bucket(value: Column) -> Column:
    """A bucket value made fit to be a folder name."""
    illegal = "[" + re.escape(ILLEGAL_BUCKET_CHARS) + r"\x00-\x1f]"
    cleaned = strip(F.rtrim(F.regexp_replace(value, illegal, "_"), F.lit(". ")))
    return F.coalesce(F.nullif(cleaned, F.lit("")), F.lit(UNASSIGNED))


# --- glob patterns -----------------------------------------------------------

_MAGIC = re.compile(r"[*?\[]")


def _set_to_regex(body: str) -> str:
    negated = body.startswith("!")
    members = body[1:] if negated else body
    parts = []
    at = 0
    while at < len(members):
        low = members[at]
        if at + 2 < len(members) and members[at + 1] == "-":
            high = members[at + 2]
            if low <= high:
                parts.append(f"{_quoted(low)}-{_quoted(high)}")
            at += 3
        else:
            parts.append(_quoted(low))
            at += 1
    if not parts:
        return "." if negated else r"(?!)"
    return f"[{'^' if negated else ''}{''.join(parts)}]"


def _quoted(char: str) -> str:
    return char if char.isalnum() or char.isspace() or ord(char) > 127 else "\\" + char


def glob_to_regex(pattern: str) -> str:
    """An anchored regular expression for a shell pattern; `*` also crosses `/`."""
    out = []
    at = 0
    while at < len(pattern):
        char = pattern[at]
        at += 1
        if char == "*":
            out.append(".*")
        elif char == "?":
            out.append(".")
        elif char == "[":
            # A `]` right after the opening (or after `!`) is a member.
            start = at + 1 if pattern[at : at + 1] == "!" else at
            end = pattern.find("]", start + 1)
            if end < 0:
                out.append(r"\[")
            else:
                out.append(_set_to_regex(pattern[at:end]))
                at = end + 1
        else:
            out.append(_quoted(char))
    return "(?s)^" + "".join(out) + r"\z"


def glob_matches(text: Column, pattern: str) -> Column:
    """Match with the cheapest test the pattern allows; a regex only if it must."""
    if not _MAGIC.search(pattern):
        return text == pattern
    if pattern == "*":
        return text.isNotNull()
    if pattern.endswith("*") and not _MAGIC.search(pattern[:-1]):
        return text.startswith(pattern[:-1])
    if pattern.startswith("*") and not _MAGIC.search(pattern[1:]):
        return text.endswith(pattern[1:])
    return text.rlike(glob_to_regex(pattern))


def first_match(text: Column, rules: Iterable[tuple[str, object]]) -> Column:
    """Value of the first rule whose pattern fits, ignoring case; NULL if none."""
    low = F.lower(text)
    tests = [F.when(glob_matches(low, pattern.lower()), F.lit(value)) for pattern, value in rules]
    return F.coalesce(*tests, F.lit(None)) if tests else F.lit(None)


def custodian_match(path: Column, rules: Iterable[tuple[str, str]]) -> Column:
    """Custodian of a manifest path: the inner path decides, first match wins."""
    return F.coalesce(first_match(inner_path(path), rules), F.lit(UNASSIGNED))


# --- addresses ---------------------------------------------------------------


def normal_path(path: Column) -> Column:
    """A path without empty and `.` steps, each `..` taking the step before it away; `/` above the top is `/`."""
    steps = F.filter(F.split(path, "/"), lambda step: (step != "") & (step != "."))
    top = F.startswith(path, F.lit("/"))

    def walk(done: Column, step: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        goes_up = (step == "..") & F.coalesce(last != "..", F.lit(False))
        lost = (step == "..") & (F.size(done) == 0) & top
        return F.when(goes_up, F.slice(done, F.lit(1), F.size(done) - 1)).when(lost, done).otherwise(F.array_append(done, step))

    kept = F.array_join(F.reduce(steps, F.array().cast("array<string>"), walk), "/")
    return F.when(top, F.concat(F.lit("/"), kept)).when(kept == "", F.lit(".")).otherwise(kept)


def address_verdict(location: Column, schemes: list[str]) -> Column:
    """Whether an address can name a collection: `ok`, or why not. Only what the text tells, nothing is opened."""
    scheme = F.lower(F.regexp_extract(location, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    rest = F.regexp_replace(location, r"^[A-Za-z][A-Za-z0-9+.-]*:", "")
    steps = F.size(F.filter(F.split(rest, "/"), lambda step: step != ""))
    remote = scheme.isin(*schemes)
    return (
        F.when(F.coalesce(F.trim(location), F.lit("")) == "", "no address")
        .when((scheme != "") & (scheme != "file") & ~remote, "no file system is known for it")
        .when(steps < F.when(remote, 2).otherwise(1), "the root of a store")
        .otherwise("ok")
    )
