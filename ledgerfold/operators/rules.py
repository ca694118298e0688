"""The twelve rules: one finding per file and rule, never collapsed to the worst."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.constants import (
    ARCHIVE_DETAIL,
    ARCHIVE_EXTENSIONS,
    CLASS_CONFLICT_DETAIL,
    CLASSIFIER_RULES,
    CONFIDENCE_FLOOR,
    DATE_ANOMALY_DETAIL,
    DEEP_NESTING_DETAIL,
    EARLIEST_YEAR,
    EXACT_DUP_INTRO,
    EXT_MISMATCH_DETAIL,
    JUNK_DETAIL,
    LOW_CONFIDENCE_DETAIL,
    MAX_FOLDER_DEPTH,
    NEAR_DUP_INTRO,
    RULE_DOCS,
    RULE_SEVERITY,
    SEVERITIES,
    SEVERITY_DOCS,
    STATUS_OK,
    UNCLASSIFIED_DETAIL,
    ZERO_BYTE_DETAIL,
)
from ledgerfold.functions.content import type_disagrees
from ledgerfold.functions.names import is_junk, naming_reasons, normalized_stem
from ledgerfold.functions.paths import folder_depth
from ledgerfold.functions.text import lookup, sql_text, strip
from ledgerfold.operators.skew import MIN_PIECE_ROWS, attach_groups

FILE_RULES = (
    "ZERO_BYTE",
    "JUNK_FILE",
    "ARCHIVE",
    "EXT_MISMATCH",
    "DATE_ANOMALY",
    "DEEP_NESTING",
    "NAMING",
)


def severity_order(severity: Column) -> Column:
    """0 for the worst severity, counting up; NULL for an unknown one."""
    return F.nullif(F.array_position(F.expr(f"array{SEVERITIES}"), severity) - 1, F.lit(-1)).cast("int")


def severity_of(rule_id: Column) -> Column:
    return lookup(rule_id, RULE_SEVERITY)


# --- rules on one row --------------------------------------------------------


def out_of_range(day: Column, as_of: dt.date) -> Column:
    """True for a date before 2000 or after the given day."""
    return (F.year(day) < EARLIEST_YEAR) | (day > F.lit(as_of))


def _filled(template: str, *values: str) -> str:
    """SQL that puts values in the places of a text."""
    parts = [sql_text(part) for part in template.split("{}")]
    filled = [piece for pair in zip(parts, [*values, None]) for piece in pair if piece not in (None, "r''")]
    return f"concat({', '.join(filled)})"


def _file_rules(as_of: dt.date) -> dict[str, tuple[str, str]]:
    """(condition, detail) of every rule that looks at one manifest row, in SQL."""
    archives = ", ".join(map(sql_text, ARCHIVE_EXTENSIONS))
    return {
        "ZERO_BYTE": ("size_bytes = 0 OR true_type = 'empty'", sql_text(ZERO_BYTE_DETAIL)),
        "JUNK_FILE": ("_junk", sql_text(JUNK_DETAIL)),
        "ARCHIVE": (f"lower(extension) IN ({archives})", sql_text(ARCHIVE_DETAIL)),
        "EXT_MISMATCH": (
            "NOT _junk AND true_type NOT IN ('empty', 'unknown') AND _disagrees",
            _filled(EXT_MISMATCH_DETAIL, "lower(extension)", "true_type"),
        ),
        "DATE_ANOMALY": (
            "_out_of_range",
            _filled(DATE_ANOMALY_DETAIL, "date_format(modified, 'yyyy-MM-dd')", sql_text(as_of.isoformat())),
        ),
        "DEEP_NESTING": (
            f"_depth > {MAX_FOLDER_DEPTH}",
            _filled(DEEP_NESTING_DETAIL, "_depth"),
        ),
        "NAMING": ("NOT _junk AND _reasons <> ''", "_reasons"),
    }


def _explode_findings(df: DataFrame, rules: dict[str, tuple[str, str]]) -> DataFrame:
    """Every rule that applies to a row becomes a finding, in a single pass."""
    found = ", ".join(
        f"CASE WHEN {applies} THEN struct('{rule}' AS rule_id, "
        f"'{RULE_SEVERITY[rule]}' AS severity, {detail} AS detail) END"
        for rule, (applies, detail) in rules.items()
    )
    return df.selectExpr("path", "name", f"inline(filter(array({found}), f -> f IS NOT NULL))")


def file_findings(
    manifest: DataFrame, as_of: dt.date, rules: tuple[str, ...] = FILE_RULES
) -> DataFrame:
    """Findings of the rules that need only the row itself; no shuffle."""
    name = F.col("name")
    facts = manifest.withColumns(
        {
            "_junk": is_junk(name),
            "_reasons": naming_reasons(name),
            "_depth": folder_depth(F.col("path")),
            "_disagrees": type_disagrees(F.col("extension"), F.col("true_type")),
            "_out_of_range": out_of_range(F.to_date("modified"), as_of),
        }
    )
    known = _file_rules(as_of)
    return _explode_findings(facts, {rule: known[rule] for rule in rules})


# --- rules on groups of files ------------------------------------------------


def _all_alike(column: str) -> str:
    """SQL aggregate: do all values of a group have one 128-bit hash?

    Smallest and largest hashes are numbers, which hash aggregation can keep in
    place; smallest and largest texts would force a sort, and a distinct count
    another shuffle.
    """
    first, second = f"xxhash64({column})", f"xxhash64({column}, 'second')"
    return f"min({first}) = max({first}) AND min({second}) = max({second})"


def dup_groups(manifest: DataFrame) -> DataFrame:
    """Content shared by several non-empty files: (sha256, n, one_name)."""
    return (
        manifest.where("size_bytes > 0")
        .groupBy("sha256")
        .agg(F.count("*").alias("n"), F.expr(f"{_all_alike('name')} AS one_name"))
        .where("n > 1")
    )


def stem_groups(manifest: DataFrame) -> DataFrame:
    """Stems shared by several files of differing content: (stem, n, one_name)."""
    return (
        manifest.select(normalized_stem(F.col("name")).alias("stem"), "name", "sha256")
        .groupBy("stem")
        .agg(
            F.count("*").alias("n"),
            F.expr(f"{_all_alike('name')} AS one_name"),
            F.expr(f"{_all_alike('sha256')} AS one_content"),
        )
        .where("n > 1 AND NOT one_content")
        .drop("one_content")
    )


def _group_findings(
    rows: DataFrame, groups: DataFrame, key: str, rule: str, intro: str, min_piece_rows: int
) -> DataFrame:
    """One finding for each member: how many others its group has, and the group's key."""
    members = attach_groups(rows, groups, key, "n", "path", min_piece_rows)
    return members.selectExpr(
        "path",
        "name",
        f"'{rule}' AS rule_id",
        f"'{RULE_SEVERITY[rule]}' AS severity",
        f"concat('{intro}', n - 1, ' other file(s) of group ', `{key}`) AS detail",
    )


def exact_duplicates(manifest: DataFrame, min_piece_rows: int = MIN_PIECE_ROWS) -> DataFrame:
    """EXACT_DUP: another non-empty file has the same bytes.

    Naming the others in each finding would grow with the square of a group, so
    duplicate_members() lists them, whatever the size of the group.
    """
    rows = manifest.where("size_bytes > 0").select("path", "name", "sha256")
    groups = dup_groups(manifest)
    return _group_findings(rows, groups, "sha256", "EXACT_DUP", EXACT_DUP_INTRO, min_piece_rows)


def near_duplicate_names(manifest: DataFrame, min_piece_rows: int = MIN_PIECE_ROWS) -> DataFrame:
    """NEAR_DUP_NAME: files share a normalised stem but not all have the same bytes."""
    rows = manifest.select("path", "name", normalized_stem(F.col("name")).alias("stem"))
    groups = stem_groups(manifest)
    return _group_findings(rows, groups, "stem", "NEAR_DUP_NAME", NEAR_DUP_INTRO, min_piece_rows)


def duplicate_members(manifest: DataFrame, min_piece_rows: int = MIN_PIECE_ROWS) -> DataFrame:
    """Every member of every duplicate group, one row each, however large the group."""
    by_hash = attach_groups(
        manifest.where("size_bytes > 0").select("path", "name", "sha256"),
        dup_groups(manifest),
        "sha256",
        "n",
        "path",
        min_piece_rows,
    )
    by_stem = attach_groups(
        manifest.select("path", "name", normalized_stem(F.col("name")).alias("stem")),
        stem_groups(manifest),
        "stem",
        "n",
        "path",
        min_piece_rows,
    )
    columns = ["path", "name", "n"]
    return by_hash.select(
        F.lit("EXACT_DUP").alias("rule_id"), F.col("sha256").alias("group_key"), *columns
    ).unionByName(
        by_stem.select(
            F.lit("NEAR_DUP_NAME").alias("rule_id"), F.col("stem").alias("group_key"), *columns
        )
    )


# --- rules on classifier output ----------------------------------------------


def classification_findings(
    classifications: DataFrame,
    floor: float = CONFIDENCE_FLOOR,
    rules: tuple[str, ...] = CLASSIFIER_RULES,
) -> DataFrame:
    """Findings on what the classifier said; nothing else is asked of a file without a label."""
    facts = classifications.withColumns(
        {"_ok": F.col("status") == STATUS_OK, "_hint": strip(F.col("folder_hint"))}
    )
    known = {
        "UNCLASSIFIED": ("NOT _ok", _filled(UNCLASSIFIED_DETAIL, "reason")),
        "CLASS_CONFLICT": (
            "_ok AND _hint <> '' AND label <> _hint",
            _filled(CLASS_CONFLICT_DETAIL, "label", "_hint"),
        ),
        "LOW_CONFIDENCE": (
            f"_ok AND confidence < {floor}D",
            _filled(LOW_CONFIDENCE_DETAIL, "confidence", sql_text(str(floor))),
        ),
    }
    return _explode_findings(facts, {rule: known[rule] for rule in rules})


# --- all of them -------------------------------------------------------------


def all_findings(
    manifest: DataFrame,
    as_of: dt.date,
    classifications: DataFrame | None = None,
    floor: float = CONFIDENCE_FLOOR,
) -> DataFrame:
    """All findings; the classifier's rules only where it has run.

    The manifest is read several times here, so pass a stored table.
    """
    found = (
        exact_duplicates(manifest)
        .unionByName(near_duplicate_names(manifest))
        .unionByName(file_findings(manifest, as_of))
    )
    if classifications is None:
        return found
    return found.unionByName(classification_findings(classifications, floor))


def exceptions_sorted(findings: DataFrame) -> DataFrame:
    """Export order: by file, then rule."""
    return findings.orderBy("path", "rule_id")


# --- what the rules mean -----------------------------------------------------


def rule_docs(spark: SparkSession) -> DataFrame:
    rows = [(rule, RULE_SEVERITY[rule], text) for rule, text in RULE_DOCS.items()]
    return spark.createDataFrame(rows, "rule_id STRING, severity STRING, description STRING")


def severity_docs(spark: SparkSession) -> DataFrame:
    rows = [(name, at, SEVERITY_DOCS[name]) for at, name in enumerate(SEVERITIES)]
    return spark.createDataFrame(rows, "severity STRING, ord INT, meaning STRING")


def rule_to_doc(findings: DataFrame) -> DataFrame:
    """Findings with the text that explains the rule and the severity (fixed, 12 + 3 rows)."""
    spark = findings.sparkSession
    rules = rule_docs(spark).select("rule_id", "description")
    meanings = severity_docs(spark).select("severity", "meaning")
    return findings.join(F.broadcast(rules), "rule_id", "left").join(
        F.broadcast(meanings), "severity", "left"
    )


def undocumented_rules(findings: DataFrame) -> DataFrame:
    """Rules that occur among the findings but have no description; none is right."""
    return (
        findings.select("rule_id")
        .distinct()
        .join(F.broadcast(rule_docs(findings.sparkSession)), "rule_id", "left_anti")
    )
