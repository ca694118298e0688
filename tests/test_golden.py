"""The whole chain on a collection whose errors are known."""

import re
import datetime as dt
import json
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerfold.constants import RULE_SEVERITY
from ledgerfold.operators import axes, gates, organize, recon, rules, summaries
from ledgerfold.operators.classify import ModelUnavailable, classify_batch
from ledgerfold.plans.full_run import full_run
from ledgerfold.sources import answer_key, collection
from tests import golden

AS_OF = dt.date(2026, 7, 21)


def model(texts):
    """Reads the kind of a document off its first words."""
    return [
        json.dumps({"label": t.split("kind ")[1].split(";")[0], "confidence": 0.95, "reason": "says so"})
        for t in texts
    ]


def hashes(root):
    found = {}
    for folder, _, names in os.walk(root):
        for name in names:
            file = os.path.join(folder, name)
            with open(file, "rb") as data:
                found[file] = (data.read(), os.stat(file).st_mtime)
    return found


@pytest.fixture(scope="module")
def golden_run(spark, tmp_path_factory):
    home = tmp_path_factory.mktemp("golden")
    root = golden.build(home)
    before = hashes(root)
    run = full_run(
        spark, root, golden.RULES, str(home / "organized"), AS_OF, lambda t: classify_batch(t, model), readers=golden.READERS
    )
    assert hashes(root) == before, "originals were touched"
    return run, root, str(home / "organized")


@pytest.fixture(scope="module")
def key(spark, tmp_path_factory):
    file = tmp_path_factory.mktemp("key") / "key.json"
    file.write_text(json.dumps(golden.answer_key(), indent=2))
    return answer_key.read_answer_key(spark, str(file), one_object=True).cache()


def test_findings_per_rule(golden_run):
    run, *_ = golden_run
    found = Counter(r.rule_id for r in run.findings.collect())
    assert found == {
        "EXACT_DUP": 6,
        "NEAR_DUP_NAME": 2,
        "NAMING": 9,
        "EXT_MISMATCH": 3,
        "ZERO_BYTE": 2,
        "DATE_ANOMALY": 2,
        "JUNK_FILE": 2,
        "ARCHIVE": 1,
        "DEEP_NESTING": 3,
        "UNCLASSIFIED": 9,
    }


def test_published_figures(golden_run):
    run, *_ = golden_run
    figures = {r.figure: r.value for r in run.figures.collect()}
    assert figures == {
        "total_files": 41,
        "files_flagged": 25,
        "files_clean": 16,
        "total_exceptions": 39,
        "sev_high": 11,
        "sev_medium": 16,
        "sev_low": 12,
        "class_labeled": 32,
        "class_unclassified": 9,
        "naming_findings": 9,
        # Creation times cannot be read here, so only modified times compare.
        "datefid_total": 123,
        "datefid_ok": 123,
        **{f"files_{axis}": 41 for axis in ("class", "author", "custodian")},
        "unassigned_class": 9,
        "unassigned_author": 19,
        "unassigned_custodian": 9,
        "buckets_class": 6,
        "buckets_author": 6,
        "buckets_custodian": 8,
    }
    assert all(r.ok == "match" for r in run.checks.collect())


def test_bucket_sizes(golden_run):
    run, *_ = golden_run
    counts = {(r.axis, r.bucket): r.files for r in summaries.bucket_counts(run.crossrefs).collect()}
    assert {b: n for (a, b), n in counts.items() if a == "author"} == {
        "Dana Cruz": 6,
        "Jorge Reyes": 5,
        "M. Villanueva": 5,
        "Alia Tan": 4,
        "Sam Ocampo": 2,
        "Unassigned": 19,
    }
    assert {b: n for (a, b), n in counts.items() if a == "custodian"} == {
        "M. Santos (Accounts Payable)": 11,
        "K. Aguilar (Legal)": 6,
        "R. Dimalanta (Project Management)": 5,
        "Field Tablet 02 (Site Ops)": 5,
        "L. Ferrer (Operations)": 3,
        "P. Bautista (Finance)": 1,
        "ERP Export (non-custodial source)": 1,
        "Unassigned": 9,
    }


def test_details(golden_run):
    run, *_ = golden_run
    details = {(r.path.split("/", 1)[1], r.rule_id): r.detail for r in run.findings.collect()}
    assert re.fullmatch(
        r"identical bytes to: 1 other file\(s\) of group [0-9a-f]{64}",
        details["Invoices/INV-2026-005_AcmeSupply.pdf", "EXACT_DUP"],
    )
    assert details["report_final.pdf", "EXT_MISMATCH"] == "extension '.pdf' but content is 'text'"
    assert details["Contracts/Contract FINAL FINAL (use this one).docx", "NAMING"] == (
        "contains spaces; ad-hoc status word(s): final, use this one"
    )
    assert details["Invoices/INV-2026-006_DeltaFreight.PDF", "NAMING"] == "non-lowercase extension '.PDF'"
    assert details["Contracts/scan_001.pdf", "NAMING"] == "scanner-default name (no document identity)"
    assert details[f"{golden.DEEP}/legacy_notes.doc", "DATE_ANOMALY"] == (
        "modified date 1980-05-12 is out of range (before 2000 or after 2026-07-21)"
    )
    assert details["Thumbs.db", "UNCLASSIFIED"] == (
        "no classification assigned — no extractable text (0 chars)"
    )


def test_answer_key_both_ways(golden_run, key):
    run, *_ = golden_run
    seeded = answer_key.seeded_errors(key)
    assert seeded.count() == sum(map(len, golden.SEEDED.values()))
    assert gates.absence_check(seeded, run.findings).count() == 0
    own = run.findings.where(~F.col("rule_id").isin("UNCLASSIFIED"))
    assert gates.false_positive_check(seeded, own).count() == 0
    authors = answer_key.expected_authors(key)
    assert gates.snapshot_diff(authors, run.manifest, "path", "author").count() == 0
    truth = answer_key.accepted_labels(key)
    assert gates.accuracy_check(truth, run.classifications).first() == (32, 32)
    assert gates.no_guess_check(truth, run.classifications).count() == 0
    assert gates.planted_date_check(seeded, run.manifest, AS_OF).where("verdict = 'lost'").count() == 0
    assert {r.path for r in answer_key.key_files(key).collect()} == {
        r.path for r in run.manifest.collect()
    }


@pytest.mark.parametrize("rule", sorted(set(RULE_SEVERITY) - set(rules.CLASSIFIER_RULES)))
def test_every_rule_is_needed(golden_run, key, rule):
    run, *_ = golden_run
    without = run.findings.where(F.col("rule_id") != rule)
    assert gates.absence_check(answer_key.seeded_errors(key), without).count() > 0


def test_without_a_model(spark, golden_run, tmp_path):
    _, root, _ = golden_run
    run = full_run(spark, root, golden.RULES, str(tmp_path / "out"), AS_OF)
    assert run.findings.count() == 30
    assert run.findings.select("path").distinct().count() == 23
    assert run.classifications is None and run.checks is None
    assert {r.axis for r in run.crossrefs.select("axis").distinct().collect()} == {"author", "custodian"}


def test_copies_are_faithful(spark, golden_run):
    run, root, out = golden_run
    copies = collection.scan_collection(spark, out)
    wide = axes.assign_axes(run.manifest, golden.RULES, run.classifications)
    plan = organize.copy_plans(wide, out)
    verdicts = Counter(r.verdict for r in gates.copy_verify(plan, copies).collect())
    assert verdicts == {"ok": 123}
    due = plan.selectExpr("axis", "path AS original_path", "bucket")
    reasons = gates.crossref_verify(run.crossrefs, run.manifest, copies, due)
    assert Counter(r.verdict for r in reasons.collect()) == {"ok": 123}
    assert recon.crossref_to_manifest(run.crossrefs, run.manifest).where("verdict <> 'known'").count() == 0


def test_broken_copies_are_noticed(spark, golden_run, tmp_path):
    run, root, _ = golden_run
    out = str(tmp_path / "organized")
    wide = axes.assign_axes(run.manifest, golden.RULES).drop("custodian_bucket")
    plan = organize.copy_plans(wide, out)
    from ledgerfold.sources.copies import copy_files

    copy_files(plan, out, root)
    base = f"{out}/by-author/Unassigned"
    when = os.stat(f"{base}/notes.txt").st_mtime
    with open(f"{base}/notes.txt", "r+b") as file:
        file.write(b"X")
    os.utime(f"{base}/notes.txt", (when, when))
    os.utime(f"{base}/data_export.csv", (0, 0))
    os.rename(f"{base}/Thumbs.db", f"{base}/elsewhere.db")
    found = gates.copy_verify(plan, collection.scan_collection(spark, out)).where("verdict <> 'ok'")
    assert Counter(r.verdict for r in found.collect()) == {
        "bytes differ": 1,
        "modified time not kept": 1,
        "missing": 1,
        "phantom": 1,
    }


def test_unreachable_model_stops_the_run(spark, golden_run):
    run, *_ = golden_run

    def down(texts):
        raise ModelUnavailable("no model")

    texts = collection.extract_text(run.manifest, golden.READERS)
    with pytest.raises(Exception, match="no model"):
        classify_batch(texts, down).collect()


def test_a_single_failure_is_a_row(spark, golden_run):
    run, *_ = golden_run
    texts = collection.extract_text(run.manifest, golden.READERS)
    labels = classify_batch(texts, lambda batch: [KeyError("x") for _ in batch])
    statuses = Counter((r.status, r.reason) for r in labels.collect())
    assert statuses["model_error", "model call failed: KeyError"] == 32


def test_model_sees_text_only(spark, golden_run):
    run, *_ = golden_run
    plan = classify_batch(collection.extract_text(run.manifest, golden.READERS), model)
    python = [
        line for line in plan._jdf.queryExecution().executedPlan().toString().splitlines()
        if "ArrowEvalPython" in line
    ]
    assert len(python) == 1 and all("ask(" in line for line in python)
    assert not any("name" in line.split("ask(")[1].split(")")[0] for line in python)


def test_another_collection(spark, tmp_path):
    root = tmp_path / "AcmeCollection"
    for name in ("Invoices/AcmeCollection/a.txt", "b.txt", ".hidden", "_under.txt", "deep/er/than/two/c.txt"):
        file = root / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(f"content of {name}")
    (root / "zero.txt").touch()
    manifest = collection.scan_collection(spark, str(root))
    rows = {r.path: r for r in manifest.collect()}
    assert set(rows) == {
        f"AcmeCollection/{p}"
        for p in ("Invoices/AcmeCollection/a.txt", "b.txt", ".hidden", "_under.txt", "deep/er/than/two/c.txt", "zero.txt")
    }
    assert rows["AcmeCollection/zero.txt"].true_type == "empty"
    buckets = axes.custodian_axis(manifest, [("invoices/*", "AP"), ("*.TXT", "Loose")])
    assert {r.path.split("/", 1)[1]: r.bucket for r in buckets.collect()} == {
        "Invoices/AcmeCollection/a.txt": "AP",
        "b.txt": "Loose",
        ".hidden": "Unassigned",
        "_under.txt": "Loose",
        "deep/er/than/two/c.txt": "Loose",
        "zero.txt": "Loose",
    }
    assert collection.require_collection(manifest, str(root)) == str(root)
    with pytest.raises(collection.CollectionError, match="manifest was built from"):
        collection.require_collection(manifest, str(tmp_path))
