"""Checks a user runs on results: nothing missed, nothing invented, nothing changed."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.constants import (
    CONFIDENCE_FLOOR,
    ERROR_TYPE_RULES,
    LABELS,
    MIN_CHARS,
    RULE_SEVERITY,
    SAMPLE_SIZE,
    SEVERITIES,
    STATUS_OK,
    STATUSES,
    UNCLASSIFIED,
)
from ledgerfold.functions.paths import inner_path, original_folder, safe_bucket
from ledgerfold.functions.text import lookup, strip
from ledgerfold.operators.selection import rows_at
from ledgerfold.operators.recon import located
from ledgerfold.operators.rules import out_of_range


def rule_for_error(error_type: Column) -> Column:
    """The rule that must catch a planted error; NULL for a type no rule owns."""
    return lookup(error_type, ERROR_TYPE_RULES)


# --- planted errors against findings -----------------------------------------


def seeded_semi_anti(seeded: DataFrame, findings: DataFrame) -> DataFrame:
    """Planted (type, path) pairs with their rule, each `caught` or `missed`."""
    pairs = seeded.select("type", "path", rule_for_error(F.col("type")).alias("rule_id"))
    keys = ["path", "rule_id"]
    found = findings.select(*keys).distinct().withColumn("_found", F.lit(True))
    verdict = F.when(F.col("_found"), "caught").otherwise("missed")
    return pairs.join(found, keys, "left").select(*keys, "type", verdict.alias("verdict"))


def absence_check(seeded: DataFrame, findings: DataFrame) -> DataFrame:
    """Planted errors no finding accounts for, and types no rule owns; none is right."""
    expected = seeded.select("type", "path", rule_for_error(F.col("type")).alias("rule_id"))
    missed = expected.join(findings.select("path", "rule_id"), ["path", "rule_id"], "left_anti")
    return missed.select(
        "type",
        "path",
        F.coalesce("rule_id", F.lit("")).alias("rule_id"),
        F.when(F.col("rule_id").isNull(), "no rule owns this type").otherwise("missed").alias("problem"),
    )


def false_positive_check(seeded: DataFrame, findings: DataFrame) -> DataFrame:
    """Flagged files nothing was planted in, with the rules that flagged them."""
    return (
        findings.join(seeded.select("path"), "path", "left_anti")
        .groupBy("path")
        # One finding per file and rule: a list is never longer than the catalogue.
        .agg(F.array_join(F.array_sort(F.collect_set("rule_id")), ", ").alias("rules"))
    )


def clean_and_flagged(manifest: DataFrame, seeded: DataFrame, findings: DataFrame) -> DataFrame:
    """Paths that should be clean and are flagged all the same."""
    clean = manifest.select("path").join(seeded.select("path"), "path", "left_anti")
    return clean.intersect(findings.select("path"))


# --- two lists of keys -------------------------------------------------------


def path_set_difference(left: DataFrame, right: DataFrame, key: str = "path") -> DataFrame:
    """Keys on one side only: (key, side)."""
    lefts, rights = left.select(key).distinct(), right.select(key).distinct()
    only_left = lefts.join(rights, key, "left_anti").withColumn("side", F.lit("left only"))
    only_right = rights.join(lefts, key, "left_anti").withColumn("side", F.lit("right only"))
    return only_left.unionByName(only_right)


def coverage_check(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """One row: rows on both sides, missing, phantom and repeated keys.

    Both sides are reduced to counts per key first, so a single shuffle on the
    key answers everything and a frequent key is one row.
    """
    counts = (
        expected.groupBy(key)
        .agg(F.count("*").alias("expected"))
        .join(actual.groupBy(key).agg(F.count("*").alias("actual")), key, "full_outer")
    )
    return counts.agg(
        F.coalesce(F.sum("expected"), F.lit(0)).alias("expected_rows"),
        F.coalesce(F.sum("actual"), F.lit(0)).alias("actual_rows"),
        F.count_if(F.col("actual").isNull()).alias("missing"),
        F.count_if(F.col("expected").isNull()).alias("phantom"),
        F.count_if(F.col("actual") > 1).alias("repeated"),
    )


def key_uniqueness(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def snapshot_diff(
    before: DataFrame, after: DataFrame, key: str = "path", fingerprint: str = "sha256"
) -> DataFrame:
    """What changed between two inventories; no rows prove nothing was touched."""
    old = before.select(key, F.col(fingerprint).alias("_before"))
    new = after.select(key, F.col(fingerprint).alias("_after"))
    change = (
        F.when(F.col("_before").isNull(), "added")
        .when(F.col("_after").isNull(), "removed")
        .when(F.col("_before") != F.col("_after"), "changed")
    )
    return (
        old.join(new, key, "full_outer").select(key, change.alias("change")).where("change IS NOT NULL")
    )


# --- classifier quality ------------------------------------------------------


def label_vs_accepted(truth: DataFrame, classifications: DataFrame) -> DataFrame:
    """Files with a known class (path, accepted[]) and whether the label is accepted."""
    scored = truth.where(F.size("accepted") > 0)
    labels = classifications.select("path", "label")
    return scored.join(labels, "path", "left").select(
        "path",
        F.coalesce("label", F.lit("")).alias("label"),
        F.array_join("accepted", ", ").alias("accepted"),
        F.when(F.array_contains("accepted", F.col("label")), "hit").otherwise("miss").alias("verdict"),
    )


def accuracy_check(truth: DataFrame, classifications: DataFrame) -> DataFrame:
    """One row: hits among the files that have a known class."""
    return label_vs_accepted(truth, classifications).agg(
        F.count_if(F.col("verdict") == "hit").alias("hits"), F.count("*").alias("scored")
    )


def no_guess_check(truth: DataFrame, classifications: DataFrame) -> DataFrame:
    """Labels given where none can be right, and labels withheld where one is due."""
    judged = truth.join(classifications.select("path", "label"), "path")
    knowable = F.coalesce(F.size("accepted") > 0, F.lit(False))
    unlabelled = F.col("label") == UNCLASSIFIED
    problem = F.when(~knowable & ~unlabelled, "guessed").when(knowable & unlabelled, "dropped")
    return judged.select("path", "label", problem.alias("problem")).where("problem IS NOT NULL")


def rule_recompute_check(
    classifications: DataFrame, findings: DataFrame, floor: float = CONFIDENCE_FLOOR
) -> DataFrame:
    """Classifier findings derived again by plain filters; every difference, both ways."""
    ok = classifications.where(F.col("status") == STATUS_OK)
    hint = strip(F.col("folder_hint"))
    again = {
        "UNCLASSIFIED": classifications.where(F.col("status") != STATUS_OK),
        "CLASS_CONFLICT": ok.where((hint != "") & (F.col("label") != hint)),
        "LOW_CONFIDENCE": ok.where(F.col("confidence") < floor),
    }
    expected = None
    for rule, rows in again.items():
        keys = rows.select("path", F.lit(rule).alias("rule_id"))
        expected = keys if expected is None else expected.unionByName(keys)
    actual = findings.where(F.col("rule_id").isin(*again)).select("path", "rule_id")
    keys = ["path", "rule_id"]
    difference = (
        expected.withColumn("_expected", F.lit(True))
        .join(actual.withColumn("_actual", F.lit(True)), keys, "full_outer")
        .where("_expected IS NULL OR _actual IS NULL")
    )
    return difference.select(
        *keys, F.when(F.col("_actual").isNull(), "missing").otherwise("unexpected").alias("problem")
    )


def _violations(df: DataFrame, constraints: dict[str, Column]) -> DataFrame:
    """(constraint, violations) for row constraints, all counted in one pass."""
    counted = df.agg(
        *[F.count_if(F.coalesce(broken, F.lit(True))).alias(name) for name, broken in constraints.items()]
    )
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("constraint"), F.col(f"`{name}`").alias("violations"))
            for name in constraints
        ]
    )
    return counted.select(F.inline(pairs))


def domain_check(
    manifest: DataFrame,
    findings: DataFrame,
    classifications: DataFrame,
    labels: tuple[str, ...] = LABELS,
) -> DataFrame:
    """Values outside their allowed domain, counted per constraint; all zero is right."""

    def blank(column: str) -> Column:
        return strip(F.col(column)) == ""

    ok = F.col("status") == STATUS_OK
    parts = (
        _violations(
            manifest,
            {
                "manifest: blank sha256": blank("sha256"),
                "manifest: blank true_type": blank("true_type"),
                "manifest: blank author": blank("author"),
            },
        ),
        _violations(
            findings,
            {
                "findings: unknown rule": ~F.col("rule_id").isin(*RULE_SEVERITY),
                "findings: unknown severity": ~F.col("severity").isin(*SEVERITIES),
                "findings: blank detail": blank("detail"),
            },
        ),
        _violations(
            classifications,
            {
                "classifications: unknown label": ~F.col("label").isin(*labels, UNCLASSIFIED),
                "classifications: unknown status": ~F.col("status").isin(*STATUSES),
                "classifications: confidence out of range": ~F.col("confidence").between(0.0, 1.0),
                "classifications: label without text": ok & (F.col("chars") < MIN_CHARS),
                "classifications: no reason given": ~ok & blank("reason"),
            },
        ),
    )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def systematic_sample(
    files: DataFrame, classifications: DataFrame, size: int = SAMPLE_SIZE
) -> DataFrame:
    """Every n-th labelled file in path order, at most `size`, with position and label.

    The step is the number of labelled files divided by the size, rounded down. Only the ranges of
    paths that hold a wanted place are sorted.
    """
    ok = classifications.where(F.col("status") == STATUS_OK).select("path", "label")
    total = ok.count()
    step = max(1, total // size)
    chosen = rows_at(ok, "path", [1 + at * step for at in range(size)], total)
    return files.join(F.broadcast(chosen), "path")  # at most `size` rows


def determinism_check(sample: DataFrame, again: DataFrame) -> DataFrame:
    """Sampled labels against those of a second run: (path, label, again, verdict)."""
    return sample.join(again.select("path", F.col("label").alias("again")), "path", "left").select(
        "path",
        "position",
        "label",
        "again",
        F.when(F.col("label") == F.col("again"), "same").otherwise("drifted").alias("verdict"),
    )


# --- copies ------------------------------------------------------------------


def copy_verify(plan: DataFrame, copies: DataFrame, log: DataFrame | None = None) -> DataFrame:
    """Every planned or present copy with the first thing wrong with it, or `ok`.

    `copies` is an inventory of the output tree. A copy anywhere but at its
    exact planned place counts twice: missing there and phantom here. With the `log` of the
    copying, times that the store could not keep are told from times that were lost.
    """
    want = plan.select(
        "dest",
        "path",
        "bucket",
        F.col("sha256").alias("want_hash"),
        F.col("size_bytes").alias("want_size"),
        F.date_trunc("second", "modified").alias("want_modified"),
    )
    got = copies.select(
        located(copies).alias("dest"),
        F.col("sha256").alias("got_hash"),
        F.col("size_bytes").alias("got_size"),
        F.date_trunc("second", "modified").alias("got_modified"),
    )
    told = F.lit(True)
    if log is not None:
        want = want.join(log.select("dest", F.col("time_kept").alias("_told")), "dest", "left")
        told = F.coalesce("_told", F.lit(True))
    kept = F.endswith(F.col("dest"), F.concat(F.lit("/"), F.col("bucket"), F.lit("/"), inner_path(F.col("path"))))
    verdict = (
        F.when(F.col("want_hash").isNull(), "phantom")
        .when(F.col("got_hash").isNull(), "missing")
        .when(F.col("want_hash") != F.col("got_hash"), "bytes differ")
        .when(F.col("want_size") != F.col("got_size"), "size differs")
        .when(told & (F.col("want_modified") != F.col("got_modified")), "modified time not kept")
        .when(~kept, "path not reconstructable")
        .when(~told, "ok, the store keeps no times")
        .otherwise("ok")
    )
    return want.join(got, "dest", "full_outer").select(
        "dest", F.coalesce("path", F.lit("")).alias("path"), verdict.alias("verdict")
    )


def crossref_verify(
    crossrefs: DataFrame, manifest: DataFrame, copies: DataFrame, axes: DataFrame
) -> DataFrame:
    """Every cross-reference row with its first failing reason, or `ok`.

    `axes` holds (axis, original_path, bucket) derived from each axis's own source.
    """
    originals = manifest.select(
        F.col("path").alias("original_path"), F.col("sha256").alias("_original_hash")
    )
    found = copies.select(located(copies).alias("new_path"), F.col("sha256").alias("_copy_hash"))
    due = axes.select(
        "axis", "original_path", safe_bucket(F.col("bucket")).alias("_due_bucket")
    )
    verdict = (
        F.when(F.col("_original_hash").isNull(), "original was never listed")
        .when(F.col("sha256") != F.col("_original_hash"), "recorded hash is not the original's")
        .when(F.col("_copy_hash").isNull(), "copy does not exist")
        .when(F.col("_copy_hash") != F.col("_original_hash"), "copy is not the original")
        .when(~F.col("bucket").eqNullSafe(F.col("_due_bucket")), "bucket disagrees with the axis")
        .when(
            F.col("original_folder") != original_folder(F.col("original_path")),
            "recorded folder is not the parent",
        )
        .otherwise("ok")
    )
    return (
        crossrefs.join(originals, "original_path", "left")
        .join(due, ["axis", "original_path"], "left")
        .join(found, "new_path", "left")
        .select("axis", "original_path", verdict.alias("verdict"))
    )


def figure_check(published: DataFrame, recomputed: DataFrame) -> DataFrame:
    """Published figures against figures derived again, all of them on both sides."""
    return (
        published.select("figure", F.col("value").alias("published"))
        .join(recomputed.select("figure", F.col("value").alias("recomputed")), "figure", "full_outer")
        .withColumn(
            "verdict",
            F.when(F.col("published").eqNullSafe(F.col("recomputed")), "match").otherwise("MISMATCH"),
        )
    )


def planted_date_check(seeded: DataFrame, manifest: DataFrame, as_of: dt.date) -> DataFrame:
    """Files planted with an impossible date: `intact`, or `lost` where a normal date took its place."""
    planted = seeded.where(F.col("type") == "date-anomaly").select("path")
    day = F.to_date("modified")
    return planted.join(manifest.select("path", "modified"), "path").select(
        "path",
        F.date_format("modified", "yyyy-MM-dd").alias("modified"),
        F.when(out_of_range(day, as_of), "intact").otherwise("lost").alias("verdict"),
    )

# --- all gates at once -------------------------------------------------------


def run_gates(
    manifest: DataFrame,
    findings: DataFrame,
    classifications: DataFrame,
    seeded: DataFrame,
    truth: DataFrame,
    as_of: dt.date,
    labels: tuple[str, ...] = LABELS,
    floor: float = CONFIDENCE_FLOOR,
    accuracy: float = 0.9,
) -> DataFrame:
    """(gate, problems, verdict) of every gate that needs the tables of a run and its answer key.

    A gate is `passed` where it finds no problem. `labels`, `floor` and `accuracy` are what the
    classifier was asked to keep to; accuracy is the share of accepted labels.
    """
    n = F.count("*")
    lost = F.col("verdict") != "intact"
    problems = {
        "planted errors caught": absence_check(seeded, findings).agg(n),
        "nothing flagged by mistake": false_positive_check(seeded, findings).agg(n),
        "every file classified once": coverage_check(manifest, classifications, "path").select(
            F.col("missing") + F.col("phantom") + F.col("repeated")
        ),
        "labels accepted": accuracy_check(truth, classifications).select(
            F.when(F.col("hits") >= F.col("scored") * accuracy, 0).otherwise(F.col("scored") - F.col("hits"))
        ),
        "nothing guessed or dropped": no_guess_check(truth, classifications).agg(n),
        "classifier findings derived again": rule_recompute_check(classifications, findings, floor).agg(n),
        "values inside their domains": domain_check(manifest, findings, classifications, labels).agg(
            F.coalesce(F.sum("violations"), F.lit(0))
        ),
        "paths unique": key_uniqueness(manifest, ["path"]).agg(n),
        "planted dates intact": planted_date_check(seeded, manifest, as_of).where(lost).agg(n),
    }
    rows = [
        counted.toDF("problems").select(F.lit(gate).alias("gate"), F.col("problems").cast("bigint").alias("problems"))
        for gate, counted in problems.items()
    ]
    verdict = F.when(F.col("problems") == 0, "passed").otherwise("FAILED")
    return reduce(DataFrame.unionByName, rows).withColumn("verdict", verdict)
