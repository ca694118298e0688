"""Counts, charts and queues of a report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerfold.constants import (
    AXES,
    SEVERITIES,
    STATUS_MODEL_ERROR,
    UNASSIGNED,
    UNCLASSIFIED,
)
from ledgerfold.functions.paths import folder_label
from ledgerfold.operators.numbering import number_rows
from ledgerfold.operators.rules import severity_docs, severity_of, severity_order


def findings_by_severity(findings: DataFrame) -> DataFrame:
    """Findings per severity; a severity without findings is kept at zero."""
    counts = findings.groupBy("severity").agg(F.count("*").alias("findings"))
    known = severity_docs(findings.sparkSession).select("severity", "ord")
    return known.join(counts, "severity", "left").select(
        "severity",
        F.col("ord").cast("bigint").alias("ord"),
        F.coalesce("findings", F.lit(0)).alias("findings"),
    )


def findings_by_rule(findings: DataFrame) -> DataFrame:
    return findings.groupBy("rule_id").agg(F.count("*").alias("findings"))


def label_counts(classifications: DataFrame) -> DataFrame:
    return classifications.groupBy("label").agg(F.count("*").alias("files"))


def status_error_count(classifications: DataFrame) -> DataFrame:
    return classifications.agg(
        F.count_if(F.col("status") == STATUS_MODEL_ERROR).alias("model_errors"),
        F.count("*").alias("files"),
    )


def clean_files(manifest: DataFrame, findings: DataFrame) -> DataFrame:
    return manifest.join(findings.select("path"), "path", "left_anti")


def flagged_clean(manifest: DataFrame, findings: DataFrame) -> DataFrame:
    """One row (total, flagged, clean): clean is counted on its own, not subtracted."""
    flagged = findings.agg(F.countDistinct("path").alias("n"))
    clean = clean_files(manifest, findings).agg(F.count("*").alias("n"))
    return manifest.agg(F.count("*").alias("total")).select(
        "total", flagged.scalar().alias("flagged"), clean.scalar().alias("clean")
    )


def hash_multiplicity(manifest: DataFrame, allowed: DataFrame | None = None) -> DataFrame:
    """Content that occurs more than once and is not on the allowed list (sha256)."""
    repeated = (
        manifest.where("size_bytes > 0")
        .groupBy("sha256")
        .agg(F.count("*").alias("files"))
        .where("files > 1")
    )
    return repeated if allowed is None else repeated.join(allowed, "sha256", "left_anti")


def bucket_counts(crossrefs: DataFrame) -> DataFrame:
    return crossrefs.groupBy("axis", "bucket").agg(F.count("*").alias("files"))


def bucket_summary(crossrefs: DataFrame) -> DataFrame:
    """Per axis: files, buckets, unassigned files and the largest named bucket.

    Of equally large buckets the one that comes first by name is reported.
    """
    named = F.col("bucket") != UNASSIGNED
    largest = F.struct((-F.col("files")).alias("n"), F.col("bucket").alias("b"))
    top = F.min(F.when(named, largest))
    return (
        bucket_counts(crossrefs)
        .groupBy("axis")
        .agg(
            F.sum("files").alias("files"),
            F.count("*").alias("buckets"),
            F.sum(F.when(named, 0).otherwise(F.col("files"))).alias("unassigned"),
            top.alias("_top"),
        )
        .select(
            "axis",
            "files",
            "buckets",
            "unassigned",
            F.coalesce("_top.b", F.lit("-")).alias("top_bucket"),
            F.coalesce(-F.col("_top.n"), F.lit(0)).alias("top_files"),
        )
    )


def bucket_list_order(crossrefs: DataFrame) -> DataFrame:
    """Buckets per axis in listing order: Unassigned last, then by folded name."""
    counts = bucket_counts(crossrefs).withColumns(
        {
            "_last": F.col("bucket") == UNASSIGNED,
            "_folded": F.lower("bucket"),
        }
    )
    order = [F.col("axis"), F.col("_last"), F.col("_folded"), F.col("bucket")]
    return number_rows(counts, order).drop("_last", "_folded")


def review_queue(findings: DataFrame) -> DataFrame:
    """All findings, worst first, numbered, with a readable folder."""
    rows = findings.withColumns(
        {"ord": severity_order(F.col("severity")), "folder": folder_label(F.col("path"))}
    )
    return number_rows(rows, [F.col("ord"), F.col("rule_id"), F.col("path")]).drop("ord")


def rule_chart_order(findings: DataFrame) -> DataFrame:
    """At most one row per rule: worst severity first, then the most findings."""
    counts = findings_by_rule(findings).withColumn("severity", severity_of(F.col("rule_id")))
    order = Window.orderBy(
        severity_order(F.col("severity")), F.col("findings").desc(), F.col("rule_id")
    )
    return counts.withColumn("position", F.row_number().over(order).cast("bigint"))


def label_chart_order(classifications: DataFrame) -> DataFrame:
    """At most one row per label: the most files first."""
    order = Window.orderBy(F.col("files").desc(), F.col("label"))
    return label_counts(classifications).withColumn(
        "position", F.row_number().over(order).cast("bigint")
    )


def top_n_messages(findings: DataFrame, n: int = 5) -> DataFrame:
    """The first n offenders of every rule; tasks keep only n rows before the shuffle."""
    order = Window.partitionBy("rule_id").orderBy("path")
    return (
        findings.withColumn("position", F.row_number().over(order).cast("bigint"))
        .where(F.col("position") <= n)
        .select("rule_id", "position", "path", "detail")
    )


# --- figures -----------------------------------------------------------------


def as_figures(one_row: DataFrame) -> DataFrame:
    """A row of named numbers -> (figure, value) rows."""
    names = one_row.columns
    pairs = F.array(
        *[
            F.struct(F.lit(n).alias("figure"), F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias("value"))
            for n in names
        ]
    )
    return one_row.select(F.inline(pairs))


def file_totals(manifest: DataFrame, findings: DataFrame) -> DataFrame:
    """One row of totals over files and findings; each table is read and shuffled once, by path."""
    severity, rule = F.col("severity"), F.col("rule_id")
    counted = {
        "total_exceptions": F.count("*"),
        **{f"sev_{s}": F.count_if(severity == s) for s in SEVERITIES},
        "naming_findings": F.count_if(rule == "NAMING"),
        "unclassified_findings": F.count_if(rule == "UNCLASSIFIED"),
    }
    found = findings.groupBy("path").agg(*[value.alias(name) for name, value in counted.items()])
    files = manifest.groupBy("path").agg(F.count("*").alias("_files"))
    flagged = F.col("total_exceptions").isNotNull()
    return files.join(found, "path", "full_outer").agg(
        F.sum("_files").alias("total_files"),
        F.count_if(flagged).alias("files_flagged"),
        F.sum(F.when(~flagged, F.col("_files"))).alias("files_clean"),
        *[F.sum(name).alias(name) for name in counted],
    )


def label_totals(classifications: DataFrame) -> DataFrame:
    unclassified = F.col("label") == UNCLASSIFIED
    return classifications.agg(
        F.count_if(~unclassified).alias("class_labeled"),
        F.count_if(unclassified).alias("class_unclassified"),
    )


def date_totals(dates: DataFrame) -> DataFrame:
    return dates.agg(F.sum("compared").alias("datefid_total"), F.sum("matching").alias("datefid_ok"))


def union_figures(parts: list[DataFrame]) -> DataFrame:
    """Rows of named numbers as one table of figures."""
    figures = as_figures(parts[0])
    for part in parts[1:]:
        figures = figures.unionByName(as_figures(part))
    return figures


def summary_figures(
    manifest: DataFrame,
    findings: DataFrame,
    classifications: DataFrame,
    crossrefs: DataFrame,
    dates: DataFrame | None = None,
) -> DataFrame:
    """Every published figure as (figure, value); each table is aggregated once.

    `dates` is the result of date_fidelity(); its two figures are left out without it.
    """
    parts = []
    for axis in AXES:
        mine = F.col("axis") == axis
        none = mine & (F.col("bucket") == UNASSIGNED)
        parts += [
            F.sum(F.when(mine, F.col("files"))).alias(f"files_{axis}"),
            F.sum(F.when(none, F.col("files"))).alias(f"unassigned_{axis}"),
            F.count_if(mine).alias(f"buckets_{axis}"),
        ]
    tables = [
        file_totals(manifest, findings).drop("unclassified_findings"),
        label_totals(classifications),
        bucket_counts(crossrefs).agg(*parts),
    ]
    return union_figures(tables if dates is None else [*tables, date_totals(dates)])
