"""Gates must fire on what is wrong and stay silent on what is right."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerfold import schemas
from ledgerfold.operators import gates, recon, rules, summaries


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def labels(spark):
    data = [
        ("c/a", "a", 50, "invoice", 0.9, "invoice", "ok", "r"),
        ("c/b", "b", 50, "invoice", 0.75, "report", "ok", "r"),
        ("c/c", "c", 50, "report", 0.74, " report ", "ok", "r"),
        ("c/d", "d", 0, "unclassified", 0.0, "report", "no_text", "none"),
        ("c/e", "e", 50, "unclassified", 0.0, "", "model_error", "bad"),
        ("c/f", "f", 10, "letter", 1.5, "", "ok", ""),
    ]
    return spark.createDataFrame(data, schemas.CLASSIFICATIONS).cache()


def test_classifier_rules(labels):
    found = rules.classification_findings(labels)
    assert [(r[0], r[2], r[4]) for r in rows(found)] == [
        ("c/b", "CLASS_CONFLICT", "content reads as 'invoice' but the file sits in a 'report' folder"),
        ("c/c", "LOW_CONFIDENCE", "model confidence 0.74 is below 0.75 — verify by hand"),
        ("c/d", "UNCLASSIFIED", "no classification assigned — none"),
        ("c/e", "UNCLASSIFIED", "no classification assigned — bad"),
    ]
    assert rules.classification_findings(labels, floor=0.8).count() == 5


def test_recomputed_rules(labels):
    found = rules.classification_findings(labels)
    assert gates.rule_recompute_check(labels, found).count() == 0
    fewer = found.where("rule_id <> 'CLASS_CONFLICT'")
    assert rows(gates.rule_recompute_check(labels, fewer)) == [("c/b", "CLASS_CONFLICT", "missing")]
    assert rows(gates.rule_recompute_check(labels, found, floor=0.7)) == [
        ("c/c", "LOW_CONFIDENCE", "unexpected")
    ]


def test_domains(spark, labels):
    manifest = spark.createDataFrame(
        [("c/a", "a", "", "text", 1, " ", None, None, "x", "r"), ("c/b", "b", "", "", 1, "h", None, None, "", "r")],
        schemas.MANIFEST,
    )
    found = spark.createDataFrame(
        [("c/a", "a", "NAMING", "low", ""), ("c/a", "a", "NEW_RULE", "fatal", "x"), ("c/b", "b", None, "low", "x")],
        schemas.FINDINGS,
    )
    broken = {r[0]: r[1] for r in gates.domain_check(manifest, found, labels).collect()}
    assert broken == {
        "manifest: blank sha256": 1,
        "manifest: blank true_type": 1,
        "manifest: blank author": 1,
        "findings: unknown rule": 2,
        "findings: unknown severity": 1,
        "findings: blank detail": 1,
        "classifications: unknown label": 1,
        "classifications: unknown status": 0,
        "classifications: confidence out of range": 1,
        "classifications: label without text": 1,
        "classifications: no reason given": 0,
    }
    assert rows(rules.undocumented_rules(found.where("rule_id IS NOT NULL"))) == [("NEW_RULE",)]


def test_truth(spark, labels):
    truth = spark.createDataFrame(
        [("c/a", ["invoice"]), ("c/b", ["report", "other"]), ("c/d", ["report"]), ("c/f", None), ("c/zz", ["report"])],
        "path STRING, accepted ARRAY<STRING>",
    )
    assert gates.accuracy_check(truth, labels).first() == (1, 4)
    assert rows(gates.no_guess_check(truth, labels)) == [
        ("c/d", "unclassified", "dropped"),
        ("c/f", "letter", "guessed"),
    ]


def test_seeded(spark):
    seeded = spark.createDataFrame(
        [("zero-byte", "p"), ("archive", "q"), ("unheard-of", "q")], "type STRING, path STRING"
    )
    found = spark.createDataFrame(
        [("p", "p", "ZERO_BYTE", "high", "d"), ("x", "x", "NAMING", "low", "d"), ("x", "x", "ARCHIVE", "low", "d")],
        schemas.FINDINGS,
    )
    assert rows(gates.absence_check(seeded, found)) == [
        ("archive", "q", "ARCHIVE", "missed"),
        ("unheard-of", "q", "", "no rule owns this type"),
    ]
    assert rows(gates.false_positive_check(seeded, found)) == [("x", "ARCHIVE, NAMING")]
    manifest = spark.createDataFrame([("p",), ("q",), ("x",), ("y",)], "path STRING")
    assert rows(gates.clean_and_flagged(manifest, seeded, found)) == [("x",)]


def test_keys(spark):
    left = spark.createDataFrame([("a",), ("b",), ("b",)], "path STRING")
    right = spark.createDataFrame([("b",), ("c",), ("c",)], "path STRING")
    assert rows(gates.path_set_difference(left, right)) == [("a", "left only"), ("c", "right only")]
    assert gates.coverage_check(left, right, "path").first() == (3, 3, 1, 1, 1)
    assert gates.coverage_check(left.where("false"), right, "path").first() == (0, 3, 0, 2, 1)
    assert rows(gates.key_uniqueness(left, ["path"])) == [("b", 2)]


def test_snapshots(spark):
    before = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1")], "path STRING, sha256 STRING")
    after = spark.createDataFrame([("a", "1"), ("b", "2"), ("d", "1")], "path STRING, sha256 STRING")
    assert rows(gates.snapshot_diff(before, after)) == [("b", "changed"), ("c", "removed"), ("d", "added")]
    assert gates.snapshot_diff(before, before).count() == 0


def test_figures(spark):
    one = spark.createDataFrame([("x", 1), ("y", 2)], "figure STRING, value BIGINT")
    two = spark.createDataFrame([("x", 1), ("z", 2)], "figure STRING, value BIGINT")
    assert rows(gates.figure_check(one, two).na.fill(-1)) == [
        ("x", 1, 1, "match"),
        ("y", 2, -1, "MISMATCH"),
        ("z", -1, 2, "MISMATCH"),
    ]


def test_lost_dates(spark):
    seeded = spark.createDataFrame([("date-anomaly", "p"), ("date-anomaly", "q")], "type STRING, path STRING")
    manifest = spark.createDataFrame(
        [("p", dt.datetime(1980, 5, 12)), ("q", dt.datetime(2026, 1, 1))], "path STRING, modified TIMESTAMP_NTZ"
    )
    got = gates.planted_date_check(seeded, manifest, dt.date(2026, 7, 21))
    assert rows(got) == [("p", "1980-05-12", "intact"), ("q", "2026-01-01", "lost")]


def test_crossref_reasons(spark):
    crossrefs = spark.createDataFrame(
        [(axis, f"c/{n}/x", folder, bucket, f"/o/{n}", digest, 1, None, None)
         for axis, n, folder, bucket, digest in [
             ("author", "gone", "gone", "b", "h"), ("author", "hash", "hash", "b", "other"),
             ("author", "nocopy", "nocopy", "b", "h"), ("author", "bad", "bad", "b", "h"),
             ("author", "bucket", "bucket", "z", "h"), ("author", "folder", "up", "b", "h"),
             ("author", "fine", "fine", "b", "h")]],
        "axis STRING, " + schemas.CROSSREF,
    )
    manifest = spark.createDataFrame(
        [(f"c/{n}/x", "h") for n in ("hash", "nocopy", "bad", "bucket", "folder", "fine")], "path STRING, sha256 STRING"
    )
    copies = spark.createDataFrame(
        [("/o", f"o/{n}", "broken" if n == "bad" else "h") for n in ("gone", "hash", "bad", "bucket", "folder", "fine")],
        "collection_root STRING, path STRING, sha256 STRING",
    )
    axes = crossrefs.selectExpr("axis", "original_path", "'b' AS bucket")
    got = {r.original_path.split("/")[1]: r.verdict for r in gates.crossref_verify(crossrefs, manifest, copies, axes).collect()}
    assert got == {
        "gone": "original was never listed",
        "hash": "recorded hash is not the original's",
        "nocopy": "copy does not exist",
        "bad": "copy is not the original",
        "bucket": "bucket disagrees with the axis",
        "folder": "recorded folder is not the parent",
        "fine": "ok",
    }


def test_gate_on_totals(spark, labels):
    manifest = labels.select("path", "name")
    found = rules.classification_findings(labels)
    refs = spark.createDataFrame([], "axis STRING, " + schemas.CROSSREF)
    for axis in ("class", "author", "custodian"):
        copies = manifest.selectExpr(
            f"'{axis}' AS axis", "path AS original_path", "'' AS original_folder", "'b' AS bucket", "path AS new_path",
            "'h' AS sha256", "1L AS size_bytes", "CAST(NULL AS TIMESTAMP_NTZ) AS created", "CAST(NULL AS TIMESTAMP_NTZ) AS modified",
        )
        refs = refs.unionByName(copies)
    checks = recon.recon_checks(manifest, found, labels, refs)
    recon.recon_gate(checks, found)
    with pytest.raises(recon.ReconciliationError, match="classified files = files: 5 != 6"):
        recon.recon_gate(recon.recon_checks(manifest, found, labels.where("name <> 'a'"), refs))
    with pytest.raises(recon.ReconciliationError, match="copies by author"):
        recon.recon_gate(recon.recon_checks(manifest, found, labels, refs.where("axis <> 'author' OR original_path <> 'c/a'")))
    unknown = found.withColumn("rule_id", F.lit("MYSTERY")).limit(1)
    with pytest.raises(recon.ReconciliationError, match="without a description"):
        recon.recon_gate(checks.where("false"), unknown)
    dates = spark.createDataFrame([(1,)], "missing BIGINT")
    with pytest.raises(recon.ReconciliationError, match="1 copies"):
        recon.recon_gate(checks.where("false"), None, dates)


def test_largest_bucket(spark):
    def refs(buckets):
        return spark.createDataFrame([("author", b) for b in buckets], "axis STRING, bucket STRING")

    assert summaries.bucket_summary(refs(["b", "a", "Unassigned", "Unassigned"])).first() == ("author", 4, 3, 2, "a", 1)
    assert summaries.bucket_summary(refs(["Unassigned"])).first() == ("author", 1, 1, 1, "-", 0)


def test_bucket_order(spark):
    refs = spark.createDataFrame([("author", b) for b in ("b", "Unassigned", "A", "z", "C")], "axis STRING, bucket STRING")
    order = sorted(summaries.bucket_list_order(refs).collect(), key=lambda r: r.position)
    assert [r.bucket for r in order] == ["A", "b", "C", "z", "Unassigned"]


def test_severities_without_findings(spark):
    none = spark.createDataFrame([], schemas.FINDINGS)
    assert rows(summaries.findings_by_severity(none)) == [("high", 0, 0), ("low", 2, 0), ("medium", 1, 0)]
