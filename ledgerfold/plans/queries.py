"""One query per operator, over the driver's whole tables."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold import schemas
from ledgerfold.constants import SEVERITIES, STATUS_OK, UNASSIGNED, UNCLASSIFIED
from ledgerfold.functions import answers, content, names, paths
from ledgerfold.functions.text import iso_seconds
from ledgerfold.operators import axes, classify, gates, organize, recon, rule_tables, rules, summaries, trained, trees
from ledgerfold.plans import derived, full_run
from ledgerfold.plans.derived import (
    AS_OF,
    CUSTODIAN_RULES,
    LANGUAGE_WORDS,
    LANGUAGES,
    OUT,
    Derived,
    derived_files,
    table,
)
from ledgerfold.sources import answer_key, collection, copies, snapshots, tables
from ledgerfold.sources.staging import new_location, new_store_location, stage

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    _QUERIES[run.__name__] = run
    return run


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _text_times(df: DataFrame) -> DataFrame:
    """Times as ISO text, '' where unknown, so that every engine prints them alike."""
    shown = {
        c: F.coalesce(iso_seconds(F.col(c)), F.lit("")) for c in ("created", "modified") if c in df.columns
    }
    return df.withColumns(shown)


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classifications straight from the documents; no table is stored."""
    return classify.classify_keyword(
        derived_files(spark, sf_dir), LANGUAGE_WORDS, text="body", hint=derived.language_hint()
    )


def _findings(d: Derived) -> DataFrame:
    return stage(rules.all_findings(d.manifest, AS_OF, d.classifications), "findings")


def _wide(d: Derived) -> DataFrame:
    return axes.assign_axes(d.manifest, CUSTODIAN_RULES, d.classifications)


def _crossrefs(d: Derived) -> DataFrame:
    return organize.crossref(organize.copy_plans(_wide(d), OUT))


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names without contents, stored, since conditions on a derived path would repeat all it is made of."""
    return stage(derived_files(spark, sf_dir).select("doc_id", "path", "name", "source", "author"), "names")


def _page_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths of files that are not in the derived collection."""
    return table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("corpus/pages/"), "page_id").alias("path"))


# --- scalar projections ------------------------------------------------------


@query
def path_parts(spark, sf_dir):
    path = F.col("path")
    return derived_files(spark, sf_dir).select(
        "path",
        paths.inner_path(path).alias("inner_path"),
        paths.collection_name(path).alias("collection"),
        paths.manifest_path(paths.collection_name(path), paths.inner_path(path)).alias("rebuilt"),
        paths.source_path(F.col("collection_root"), path).alias("source_path"),
        paths.inner_path(F.col("name")).alias("inner_of_name"),
    )


@query
def url_parts(spark, sf_dir):
    """The same path functions on the paths of web pages."""
    path = F.regexp_replace(F.regexp_replace("url", "^[a-z]+://", ""), "[?#].*$", "")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        paths.collection_name(path).alias("host"),
        paths.inner_path(path).alias("inner_path"),
        paths.folder_depth(path).alias("depth"),
        paths.folder_label(path).alias("folder"),
        content.true_type(F.col("html").cast("binary")).alias("true_type"),
        content.content_hash(F.col("html")).alias("sha256"),
    )


@query
def name_parts(spark, sf_dir):
    name = F.col("name")
    return derived_files(spark, sf_dir).select(
        "path",
        paths.file_name(F.col("path")).alias("name"),
        paths.stem(name).alias("stem"),
        paths.suffix(name).alias("suffix"),
    )


def _scalar(key: str, column: Callable[[], Column]) -> None:
    """Register a query that shows one scalar function next to the path."""

    def run(spark, sf_dir):
        return derived_files(spark, sf_dir).select("path", column().alias(key))

    run.__name__ = key
    query(run)


_scalar("folder_depth", lambda: paths.folder_depth(F.col("path")))
_scalar("folder_label", lambda: paths.folder_label(F.col("path")))
_scalar("original_folder", lambda: paths.original_folder(F.col("path")))
_scalar("folder_hint", lambda: paths.folder_hint(F.col("path")))
_scalar("content_hash", lambda: content.content_hash(F.col("body")))
_scalar("true_type", lambda: content.true_type(F.col("body").cast("binary")))
_scalar("normalized_stem", lambda: names.normalized_stem(F.col("name")))
_scalar("is_junk", lambda: names.is_junk(F.col("name")).cast("string"))
_scalar("naming_reasons", lambda: names.naming_reasons(F.col("name")))
_scalar("expected_type", lambda: F.coalesce(content.expected_types(F.col("extension")), F.lit("")))
_scalar("custodian_match", lambda: paths.custodian_match(F.col("path"), CUSTODIAN_RULES))


@query
def author_or_unassigned(spark, sf_dir):
    """Sources between blanks, and blanks alone."""
    named = table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit(" "), "source", F.lit(" \n")).alias("raw")
    )
    blank = table(spark, sf_dir, "benchmark").select((-1 - F.col("item_id")).alias("doc_id"), F.lit(" \t  ").alias("raw"))
    return named.unionByName(blank).select("doc_id", content.author_or_unassigned(F.col("raw")).alias("author"))


@query
def safe_bucket(spark, sf_dir):
    """Bucket names out of whole URLs, and out of values with nothing to keep."""
    urls = table(spark, sf_dir, "pages").select("page_id", F.concat("url", F.lit(" . ")).alias("raw"))
    dots = table(spark, sf_dir, "benchmark").select((-1 - F.col("item_id")).alias("page_id"), F.lit("... .").alias("raw"))
    return urls.unionByName(dots).select("page_id", paths.safe_bucket(F.col("raw")).alias("bucket"))


@query
def second_precision_time(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", iso_seconds(F.col("ts")).alias("time"))


@query
def text_window(spark, sf_dir):
    window = answers.text_window(F.col("text"))
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.length(window).cast("bigint").alias("chars"),
        F.sha2(window, 256).alias("window_hash"),
    )


@query
def readable_text_gate(spark, sf_dir):
    text = F.col("body")
    gated = F.when(~answers.readable(text), answers.no_text(text))
    return (
        derived_files(spark, sf_dir)
        .select("path", gated.alias("g"))
        .select(
            "path",
            F.coalesce("g.status", F.lit("readable")).alias("status"),
            F.coalesce("g.reason", F.lit("")).alias("reason"),
            F.coalesce("g.label", F.lit("")).alias("label"),
        )
    )


# A raw model answer per document: good, sloppy, off the list or broken in turn.
_RAW_ANSWER = """CASE doc_id % 9
    WHEN 0 THEN concat('{"label": "', lang, '", "confidence": 0.', doc_id % 90 + 10, ', "reason": "reads as ', lang, '"}')
    WHEN 1 THEN concat('{"label": " ', upper(lang), ' ", "confidence": "0.5", "reason": "  shouting  "}')
    WHEN 2 THEN concat('{"label": "', source, '", "confidence": 0.9}')
    WHEN 3 THEN concat('{"label": "', lang)
    WHEN 4 THEN concat('{"label": "', lang, '", "confidence": "', CASE doc_id % 7 WHEN 0 THEN '0.745' WHEN 1 THEN '0.125'
        WHEN 2 THEN '0.845' WHEN 3 THEN '0.285' WHEN 4 THEN '0.615' WHEN 5 THEN '0.9d' ELSE 'high' END, '"}')
    WHEN 5 THEN concat('{"confidence": 0.4, "reason": "', source, '"}')
    WHEN 6 THEN concat('["', lang, '"]')
    WHEN 7 THEN concat('{"label": "', lang, "'s", '", "confidence": 1}')
    ELSE concat('{"label": "other", "confidence": 0.987, "reason": "', repeat(source, 60), '"}') END"""


@query
def parse_model_answer(spark, sf_dir):
    parsed = answers.parse_answer(F.expr(_RAW_ANSWER), None, LANGUAGES)
    return table(spark, sf_dir, "documents").select("doc_id", parsed.alias("p")).select("doc_id", "p.*")


@query
def severity_order(spark, sf_dir):
    found = _findings(Derived(spark, sf_dir))
    order = rules.severity_order(F.col("severity")).cast("bigint")
    return found.select("path", "rule_id", order.alias("ord"))


# --- the rule catalogue ------------------------------------------------------


def _file_rule(key: str, rule: str) -> None:
    def run(spark, sf_dir):
        return rules.file_findings(derived_files(spark, sf_dir), AS_OF, (rule,))

    run.__name__ = key
    query(run)


_file_rule("rule_naming", "NAMING")
_file_rule("rule_ext_mismatch", "EXT_MISMATCH")
_file_rule("rule_zero_byte", "ZERO_BYTE")
_file_rule("rule_date_anomaly", "DATE_ANOMALY")
_file_rule("rule_junk_file", "JUNK_FILE")
_file_rule("rule_archive", "ARCHIVE")
_file_rule("rule_deep_nesting", "DEEP_NESTING")


@query
def rule_exact_dup(spark, sf_dir):
    return rules.exact_duplicates(Derived(spark, sf_dir, labels=False).manifest)


@query
def rule_near_dup_name(spark, sf_dir):
    return rules.near_duplicate_names(Derived(spark, sf_dir, labels=False).manifest)


@query
def duplicate_members(spark, sf_dir):
    return rules.duplicate_members(Derived(spark, sf_dir, labels=False).manifest)


def _class_rule(key: str, rule: str) -> None:
    def run(spark, sf_dir):
        return rules.classification_findings(_labelled(spark, sf_dir), rules=(rule,))

    run.__name__ = key
    query(run)


_class_rule("rule_unclassified", "UNCLASSIFIED")
_class_rule("rule_class_conflict", "CLASS_CONFLICT")
_class_rule("rule_low_confidence", "LOW_CONFIDENCE")


@query
def date_range_check(spark, sf_dir):
    """The date rule on any date column: values before 2000 or after a given day."""
    columns = (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"))
    result = None
    for name, column in columns:
        outside = rules.out_of_range(F.to_date(column), dt.date(2001, 1, 1))
        counted = table(spark, sf_dir, name).agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("rows"),
            F.count_if(outside).alias("out_of_range"),
        )
        result = counted if result is None else result.unionByName(counted)
    return result


@query
def rule_docs(spark, sf_dir):
    """How many findings every rule has, with what the rule means."""
    counts = summaries.findings_by_rule(_findings(Derived(spark, sf_dir)))
    return rules.rule_docs(spark).join(counts, "rule_id", "left").select(
        "rule_id", "severity", "description", F.coalesce("findings", F.lit(0)).alias("findings")
    )


# --- joins -------------------------------------------------------------------


@query
def axis_lookup(spark, sf_dir):
    """Author buckets looked up for all files, and for pages that no axis knows."""
    files = derived_files(spark, sf_dir)
    others = _page_paths(spark, sf_dir).select("path")
    return axes.axis_lookup(files.select("path").unionByName(others), axes.author_axis(files))


@query
def class_axis(spark, sf_dir):
    return axes.class_axis(_labelled(spark, sf_dir))


@query
def author_axis(spark, sf_dir):
    return axes.author_axis(derived_files(spark, sf_dir))


@query
def custodian_axis(spark, sf_dir):
    return axes.custodian_axis(derived_files(spark, sf_dir), CUSTODIAN_RULES)


@query
def crossref_to_manifest(spark, sf_dir):
    """Cross-references of all files, and of pages that are not in the manifest."""
    d = Derived(spark, sf_dir)
    others = _page_paths(spark, sf_dir).select(
        F.lit("class").alias("axis"), F.col("path").alias("original_path"), F.concat(F.lit(f"{OUT}/pages/"), "page_id").alias("new_path")
    )
    refs = _crossrefs(d).select("axis", "original_path", "new_path").unionByName(others)
    return recon.crossref_to_manifest(refs, d.manifest)


@query
def rule_to_doc(spark, sf_dir):
    return rules.rule_to_doc(_findings(Derived(spark, sf_dir))).select(
        "path", "rule_id", "severity", "description", "meaning"
    )


@query
def first_match_join(spark, sf_dir):
    """A rule table with a rule for every file, and the custodian rules behind them."""
    files = _names(spark, sf_dir)
    doc, inner = F.col("doc_id"), paths.inner_path(F.col("path"))
    pattern = (
        F.when(doc % 3 == 0, inner)
        .when(doc % 3 == 1, F.concat(F.lit("*/scan_"), doc, F.lit(".pdf")))
        .otherwise(F.concat(F.lit("?*/"), "name"))
    )
    own = files.select(doc.alias("rule_order"), pattern.alias("pattern"), F.concat(F.lit("Keeper "), "source").alias("custodian"))
    shared = tables.rules_frame(spark, CUSTODIAN_RULES).withColumn("rule_order", F.col("rule_order") + 2 * derived.ADDED)
    return rule_tables.first_match_join(files.select("path"), own.unionByName(shared))


@query
def first_match_inside(spark, sf_dir):
    """Patterns with nothing fixed at an end, one for each benchmark item, and one for what is left."""
    item = F.col("item_id")
    inside = table(spark, sf_dir, "benchmark").select(
        item.alias("rule_order"),
        F.concat(F.lit("*c_"), item, F.lit("*")).alias("pattern"),
        F.concat(F.lit("Desk "), item % 7).alias("custodian"),
    )
    rest = spark.sql("SELECT * FROM VALUES (1000000L, '?n*', 'Second letter'), (1000001L, '*', 'All others') AS r(rule_order, pattern, custodian)")
    return rule_tables.first_match_join(_names(spark, sf_dir).select("path"), inside.unionByName(rest))


@query
def seeded_semi_anti(spark, sf_dir):
    d = Derived(spark, sf_dir)
    return gates.seeded_semi_anti(d.seeded, _findings(d)).select(
        "type", "path", F.coalesce("rule_id", F.lit("")).alias("rule_id"), "verdict"
    )


@query
def label_vs_accepted(spark, sf_dir):
    d = Derived(spark, sf_dir)
    return gates.label_vs_accepted(d.truth, d.classifications)


# --- aggregations ------------------------------------------------------------


@query
def dup_groups(spark, sf_dir):
    return rules.dup_groups(derived_files(spark, sf_dir)).withColumn(
        "one_name", F.col("one_name").cast("string")
    )


@query
def stem_groups(spark, sf_dir):
    return rules.stem_groups(derived_files(spark, sf_dir)).withColumn(
        "one_name", F.col("one_name").cast("string")
    )


@query
def findings_by_severity(spark, sf_dir):
    return summaries.findings_by_severity(_findings(Derived(spark, sf_dir)))


@query
def findings_by_rule(spark, sf_dir):
    return summaries.findings_by_rule(_findings(Derived(spark, sf_dir)))


@query
def label_counts(spark, sf_dir):
    return summaries.label_counts(_labelled(spark, sf_dir))


@query
def flagged_clean(spark, sf_dir):
    d = Derived(spark, sf_dir)
    return summaries.flagged_clean(d.manifest, _findings(d))


@query
def bucket_counts(spark, sf_dir):
    return summaries.bucket_counts(_crossrefs(Derived(spark, sf_dir)))


@query
def bucket_summary(spark, sf_dir):
    return summaries.bucket_summary(_crossrefs(Derived(spark, sf_dir)))


@query
def status_error_count(spark, sf_dir):
    return summaries.status_error_count(_asked(spark, sf_dir))


@query
def hash_multiplicity(spark, sf_dir):
    """Repeated content, apart from that of files without an author."""
    d = Derived(spark, sf_dir, labels=False)
    allowed = d.manifest.where("author = 'Unassigned'").select("sha256").distinct()
    return summaries.hash_multiplicity(d.manifest, allowed)


# --- orders and limits -------------------------------------------------------


@query
def exceptions_sorted(spark, sf_dir):
    return rules.exceptions_sorted(_findings(Derived(spark, sf_dir)))


@query
def review_queue(spark, sf_dir):
    return summaries.review_queue(_findings(Derived(spark, sf_dir)))


@query
def rule_chart_order(spark, sf_dir):
    return summaries.rule_chart_order(_findings(Derived(spark, sf_dir)))


@query
def label_chart_order(spark, sf_dir):
    return summaries.label_chart_order(_labelled(spark, sf_dir))


@query
def bucket_list_order(spark, sf_dir):
    return summaries.bucket_list_order(_crossrefs(Derived(spark, sf_dir)))


@query
def top_n_messages(spark, sf_dir):
    return summaries.top_n_messages(_findings(Derived(spark, sf_dir)))


# --- set operations ----------------------------------------------------------


@query
def all_findings(spark, sf_dir):
    d = Derived(spark, sf_dir)
    return rules.all_findings(d.manifest, AS_OF, d.classifications)


@query
def all_crossrefs(spark, sf_dir):
    """The three cross-references, made one by one and read together."""
    d = Derived(spark, sf_dir)
    by_axis = {
        "class": axes.class_axis(d.classifications),
        "author": axes.author_axis(d.manifest),
        "custodian": axes.custodian_axis(d.manifest, CUSTODIAN_RULES),
    }
    refs = {
        axis: organize.crossref(
            organize.copy_plan(axes.axis_lookup(d.manifest, buckets), f"{OUT}/by-{axis}")
        )
        for axis, buckets in by_axis.items()
    }
    return _text_times(organize.all_crossrefs(refs))


@query
def path_set_difference(spark, sf_dir):
    """Documents without labels, and labels without documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return gates.path_set_difference(docs, table(spark, sf_dir, "labels"), "doc_id")


@query
def path_set_intersection(spark, sf_dir):
    d = Derived(spark, sf_dir)
    return gates.clean_and_flagged(d.manifest, d.seeded, _findings(d))


@query
def axis_value_overlap(spark, sf_dir):
    return axes.axis_value_overlap(axes.assign_axes(_names(spark, sf_dir), CUSTODIAN_RULES))


# --- organising --------------------------------------------------------------


@query
def copy_plan(spark, sf_dir):
    plan = organize.copy_plans(_wide(Derived(spark, sf_dir)), OUT)
    return plan.select("axis", "path", "bucket", "dest")


@query
def collisions(spark, sf_dir):
    """Clashes if the files of one author were put into one flat folder."""
    files = Derived(spark, sf_dir, labels=False).manifest
    flat = files.select("path", F.concat_ws("/", F.lit(OUT), "author", "name").alias("dest"))
    return organize.collisions(flat)


@query
def collisions_folded(spark, sf_dir):
    """Clashes by extension on a store that does not tell case apart."""
    files = Derived(spark, sf_dir, labels=False).manifest
    flat = files.select(
        "path", F.concat_ws("/", F.lit(OUT), "author", paths.stem(F.col("name")), "extension").alias("dest")
    )
    return organize.collisions(flat, fold_case=True)


@query
def dry_run_counts(spark, sf_dir):
    """Bucket counts of a plan that is checked but not carried out."""
    plan = organize.copy_plans(_wide(Derived(spark, sf_dir)), OUT)
    clashes = organize.collisions(plan).agg(F.count("*").alias("n"))
    counts = plan.groupBy("axis", "bucket").agg(F.count("*").alias("files"))
    return counts.withColumn("collisions", clashes.scalar())


@query
def crossref(spark, sf_dir):
    return _text_times(_crossrefs(Derived(spark, sf_dir)))


@query
def folder_batches(spark, sf_dir):
    plan = organize.copy_plans(_wide(Derived(spark, sf_dir)), OUT)
    return organize.folder_batches(plan)


@query
def axis_divergence(spark, sf_dir):
    return axes.axis_divergence(_wide(Derived(spark, sf_dir)))


# --- reconciliation ----------------------------------------------------------


@query
def recon_checks(spark, sf_dir):
    d = Derived(spark, sf_dir)
    return recon.recon_checks(d.manifest, _findings(d), d.classifications, _crossrefs(d), _dates(spark, sf_dir, d.classifications))


@query
def recon_gate(spark, sf_dir):
    """The checks again with classifications of files that nobody sent: some must fail."""
    d = Derived(spark, sf_dir)
    labels = d.classifications.select("path", "label")
    unknown = table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("corpus/benchmark/"), "item_id").alias("path"), F.lit(UNCLASSIFIED).alias("label")
    )
    more, dates = labels.unionByName(unknown), _dates(spark, sf_dir, d.classifications)
    checks = stage(recon.recon_checks(d.manifest, _findings(d), more, _crossrefs(d), dates), "checks")
    try:
        recon.recon_gate(checks)
    except recon.ReconciliationError:
        return checks.where("ok <> 'match'")
    return checks.where("false")


@query
def summary_figures(spark, sf_dir):
    d = Derived(spark, sf_dir)
    dates = _dates(spark, sf_dir, d.classifications)
    return summaries.summary_figures(d.manifest, _findings(d), d.classifications, _crossrefs(d), dates)


@query
def report_figures(spark, sf_dir):
    """Published figures, stored and read back."""
    figures = summary_figures(spark, sf_dir)
    return tables.write_table(figures, new_location(spark, "figures"), ["figure", "value"])


@query
def axis_summary(spark, sf_dir):
    d = Derived(spark, sf_dir)
    wide = axes.assign_axes(d.manifest, CUSTODIAN_RULES, d.classifications)
    return summaries.bucket_summary(organize.crossref(organize.copy_plans(wide, OUT)))


# --- gates -------------------------------------------------------------------


@query
def absence_check(spark, sf_dir):
    d = Derived(spark, sf_dir)
    return gates.absence_check(d.seeded, _findings(d))


@query
def false_positive_check(spark, sf_dir):
    d = Derived(spark, sf_dir)
    return gates.false_positive_check(d.seeded, _findings(d))


@query
def coverage_check(spark, sf_dir):
    return gates.coverage_check(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id"
    )


@query
def accuracy_check(spark, sf_dir):
    d = Derived(spark, sf_dir)
    return gates.accuracy_check(d.truth, d.classifications)


@query
def no_guess_check(spark, sf_dir):
    d = Derived(spark, sf_dir)
    return gates.no_guess_check(d.truth, d.classifications)


@query
def rule_recompute_check(spark, sf_dir):
    """Findings made at the usual floor, recomputed at 0.9: the difference is what lies between."""
    d = Derived(spark, sf_dir)
    found = rules.classification_findings(d.classifications)
    return gates.rule_recompute_check(d.classifications, found, floor=0.9)


@query
def domain_check(spark, sf_dir):
    """Languages checked against a list without Spanish, so that one constraint is broken."""
    d = Derived(spark, sf_dir)
    return gates.domain_check(d.manifest, _findings(d), d.classifications, ("de", "en", "fr", "other"))


@query
def key_uniqueness(spark, sf_dir):
    return gates.key_uniqueness(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def snapshot_diff(spark, sf_dir):
    """Documents and benchmark items before, files after a rewrite; empty files are new."""
    before = table(spark, sf_dir, "documents").select("doc_id", "text").unionByName(
        table(spark, sf_dir, "benchmark").select((-1 - F.col("item_id")).alias("doc_id"), "text")
    )
    rewritten = F.replace(F.col("body"), F.lit(" 1"), F.lit(" one"))
    after = derived_files(spark, sf_dir).select("doc_id", content.content_hash(rewritten).alias("sha256"))
    hashed = before.select("doc_id", content.content_hash(F.coalesce("text", F.lit(""))).alias("sha256"))
    return gates.snapshot_diff(hashed, after, "doc_id")


@query
def snapshot_tree_diff(spark, sf_dir):
    """The files before and after a rewrite of the invoices, with the pages added; compared by folders."""
    before = derived_files(spark, sf_dir).select("path", "sha256", "body")
    rewritten = F.replace(F.col("body"), F.lit(" 1"), F.lit(" one"))
    invoice = F.startswith(F.col("path"), F.lit("corpus/Invoices/"))
    after = before.select("path", F.when(invoice, content.content_hash(rewritten)).otherwise(F.col("sha256")).alias("sha256"))
    pages = _page_paths(spark, sf_dir).select("path", F.col("path").alias("sha256"))
    return trees.tree_diff(before.select("path", "sha256"), after.unionByName(pages))


@query
def figure_check(spark, sf_dir):
    """Every published figure against one derived from other tables, or by other means."""
    d = Derived(spark, sf_dir)
    manifest, plan, out, _ = _copied(spark, sf_dir, d.classifications)
    found = collection.scan_collection(spark, out)
    findings, dates = _findings(d), recon.date_fidelity(organize.crossref(plan), manifest, found)
    published = summaries.summary_figures(d.manifest, findings, d.classifications, _crossrefs(d), dates)
    n = F.count("*")
    kept = F.count_if(F.col("verdict") == "ok").alias("datefid_ok")
    parts = [
        d.classifications.agg(n.alias("total_files"), F.count_if(F.col("status") == STATUS_OK).alias("class_labeled")),
        findings.agg(n.alias("total_exceptions"), F.countDistinct("path").alias("files_flagged")),
        summaries.clean_files(d.manifest, findings).agg(n.alias("files_clean")),
        summaries.findings_by_severity(findings).agg(
            *[F.sum(F.when(F.col("severity") == s, F.col("findings"))).alias(f"sev_{s}") for s in SEVERITIES]
        ),
        findings.where("rule_id = 'UNCLASSIFIED'").agg(n.alias("class_unclassified")),
        rules.file_findings(d.manifest, AS_OF, ("NAMING",)).agg(n.alias("naming_findings")),
        plan.where("modified IS NOT NULL").agg(n.alias("datefid_total")),
        gates.copy_verify(plan, found).agg(kept),
    ]
    for axis, buckets in (
        ("class", axes.class_axis(d.classifications)),
        ("author", axes.author_axis(d.manifest)),
        ("custodian", axes.custodian_axis(d.manifest, tables.rules_frame(spark, CUSTODIAN_RULES))),
    ):
        unassigned = F.count_if(F.col("bucket") == UNASSIGNED)
        parts.append(
            buckets.agg(
                n.alias(f"files_{axis}"), unassigned.alias(f"unassigned_{axis}"), F.countDistinct("bucket").alias(f"buckets_{axis}")
            )
        )
    return gates.figure_check(published, summaries.union_figures(parts)).select(
        "figure",
        F.coalesce("published", F.lit(-1)).alias("published"),
        F.coalesce("recomputed", F.lit(-1)).alias("recomputed"),
        "verdict",
    )


@query
def determinism_sample(spark, sf_dir):
    """Eight labelled documents, spread evenly, classified a second time."""
    d = Derived(spark, sf_dir)
    files = derived_files(spark, sf_dir).select("path", "name", "doc_id", "lang", "body")
    sample = stage(gates.systematic_sample(files, d.classifications), "sample")
    again = classify.classify_keyword(sample, LANGUAGE_WORDS, text="body", hint=F.lit(""))
    return gates.determinism_check(sample, again)


@query
def run_gates(spark, sf_dir):
    """All gates of a run in one table; the classifier is judged without Spanish among its labels."""
    d = Derived(spark, sf_dir)
    return gates.run_gates(
        d.manifest, _findings(d), d.classifications, d.seeded, d.truth, AS_OF, ("de", "en", "fr", "other"), accuracy=1.0
    )


@query
def planted_date_check(spark, sf_dir):
    d = Derived(spark, sf_dir, labels=False)
    return gates.planted_date_check(d.seeded, d.manifest, AS_OF)


# --- binary heads and odd names ----------------------------------------------

# Beginnings in hex: signatures, broken text, a signature cut short, none, and a character the head's end cuts; null: an empty file.
_HEADS = (
    "255044462D312E34", "89504E470D0A1A0A", "FFD8FF", "504B0304", "D0CF11E0", "474946383761", "474946383961", "C328", "89504E47",
    "", "61" * 2047 + "C3A9", None,
)
_ODD_NAMES = (".hidden", "a\u00a0b.PDF", "x.docx", "Scan_12.png", ".DS_Store", "name.", "c\u3000d.jpg")


def _binary_files(spark, sf_dir) -> DataFrame:
    """Every document as a file whose first bytes and whose name follow from its number."""
    head = F.element_at(F.array(*[F.lit(h) for h in _HEADS]), (F.col("doc_id") % 12 + 1).cast("int"))
    name = F.element_at(F.array(*[F.lit(n) for n in _ODD_NAMES]), (F.col("doc_id") % 7 + 1).cast("int"))
    text = F.when(head.isNull(), "").otherwise(F.concat(F.lit(" t"), F.coalesce("text", F.lit(""))))
    body = F.concat(F.unhex(F.coalesce(head, F.lit(""))), text.cast("binary"))
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("corpus/"), "doc_id", F.lit("/"), name).alias("path"),
        name.alias("name"),
        paths.suffix(name).alias("extension"),
        content.true_type(body).alias("true_type"),
        F.octet_length(body).cast("bigint").alias("size_bytes"),
        F.lit(None).cast("timestamp_ntz").alias("modified"),
    )


@query
def binary_types(spark, sf_dir):
    files = _binary_files(spark, sf_dir)
    return files.select("path", "extension", "true_type", "size_bytes", names.normalized_stem(F.col("name")).alias("stem"))


@query
def binary_findings(spark, sf_dir):
    """What the row rules find in binary files with odd names."""
    return rules.file_findings(_binary_files(spark, sf_dir), AS_OF, ("EXT_MISMATCH", "ZERO_BYTE", "NAMING"))


# --- sources and sinks -------------------------------------------------------


@query
def file_inventory(spark, sf_dir):
    """The documents written as files, then found, hashed and sniffed again."""
    root = derived.write_collection(derived_files(spark, sf_dir))
    return _text_times(
        collection.scan_collection(spark, root).drop("collection_root", "created")
    )


@query
def collection_guard(spark, sf_dir):
    """Manifests of one collection per language; the request names the English one."""
    files = derived_files(spark, sf_dir).select(
        F.concat(F.lit("/collections/"), "lang").alias("collection_root")
    )
    return collection.collection_guard(files, "/collections/en")


@query
def manifest_read(spark, sf_dir):
    """The manifest as CSV and back; awkward names keep every character."""
    odd = F.concat("name", F.lit(' "x", '), "lang", F.lit("\ny "))
    files = derived_files(spark, sf_dir).withColumn(
        "author", F.when(F.col("author") == UNASSIGNED, "").otherwise(F.col("author"))
    )
    location = new_location(spark, "csv")
    tables.write_csv_table(files.withColumn("name", odd), location, schemas.MANIFEST)
    read = tables.read_csv_table(spark, location, schemas.MANIFEST)
    return _text_times(read)


@query
def manifest_write(spark, sf_dir):
    stored = tables.write_manifest(derived_files(spark, sf_dir), new_location(spark, "manifest"))
    return _text_times(stored)


@query
def classifications_write(spark, sf_dir):
    return tables.write_classifications(_labelled(spark, sf_dir), new_location(spark, "labels"))


@query
def exceptions_write(spark, sf_dir):
    d = Derived(spark, sf_dir)
    found = rules.all_findings(d.manifest, AS_OF, d.classifications)
    return tables.write_exceptions(found, new_location(spark, "exceptions"))


@query
def run_snapshot(spark, sf_dir):
    """The tables of a run, committed together and read back under their version."""
    d = Derived(spark, sf_dir)
    found = {"manifest": d.manifest, "classifications": d.classifications}
    found["exceptions"] = rules.all_findings(d.manifest, AS_OF, d.classifications)
    location = new_store_location(spark, "run")
    snapshots.write_snapshot(spark, location, found)
    read = snapshots.open_snapshot(spark, location)
    parts = [
        read.table(name).agg(F.count("*").alias("rows"), F.countDistinct("path").alias("paths")).select(F.lit(name).alias("name"), "rows", "paths")
        for name in found
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def intake_param(spark, sf_dir):
    """Page addresses as collections: as they are, on a store, as a store's root, as a local path, and blank."""
    host = F.regexp_extract("url", "^[a-z]*://([^/]*)", 1)
    turn = F.col("page_id") % 5
    location = (
        F.when(turn == 0, F.col("url"))
        .when(turn == 1, F.regexp_replace("url", "^[a-z]*://", "S3A://"))
        .when(turn == 2, F.concat(F.lit("hdfs://"), host, F.lit("/")))
        .when(turn == 3, F.concat(F.lit("/data/"), host))
        .otherwise(F.lit(" "))
    )
    pages = table(spark, sf_dir, "pages").select("page_id", location.alias("location"))
    return collection.intake_verdicts(pages).select("page_id", "verdict")


@query
def output_guard(spark, sf_dir):
    """An output for each page's host: beside it, the same by a detour, inside, around, and elsewhere."""
    host = F.regexp_extract("url", "^[a-z]*://([^/]*)", 1)
    root = F.concat(F.lit("/data/"), host)
    outs = [
        F.concat(root, F.lit("-out")),
        F.concat(F.lit("/data/./x//../"), host, F.lit("/")),
        F.concat(root, F.lit("/sub/../out")),
        F.lit("/data/"),
        F.concat(root, F.lit("/../../out")),
    ]
    out = F.element_at(F.array(*outs), (F.col("page_id") % 5 + 1).cast("int"))
    pages = table(spark, sf_dir, "pages").where(host != "").select("page_id", root.alias("collection_root"), out.alias("out_root"))
    return organize.output_verdicts(pages).select("page_id", "verdict")


@query
def rules_table_read(spark, sf_dir):
    """Rules from a stored table, with the files each one claims."""
    location = new_location(spark, "rules")
    stored = tables.rules_frame(spark, CUSTODIAN_RULES).coalesce(1)
    tables.write_csv_table(
        stored.withColumn("source_note", F.lit("")), location, "pattern STRING, custodian STRING, source_note STRING"
    )
    read = tables.read_rules_table(spark, location)
    claimed = rule_tables.first_match_join(derived_files(spark, sf_dir).select("path"), read)
    return claimed.groupBy("rule_order", "custodian").agg(F.count("*").alias("files"))


@query
def answer_key_read(spark, sf_dir):
    """A key with one object per file, written, read and taken apart."""
    d = Derived(spark, sf_dir)
    seeded = d.seeded.select(
        F.array("path").alias("files"),
        F.array(F.struct("type", F.array("path").alias("paths"), F.lit("").alias("note"))).alias(
            "seeded_errors"
        ),
    )
    author = F.when(F.col("author") != UNASSIGNED, F.col("author"))
    facts = d.rows.join(d.truth, "path").select(
        F.array("path").alias("files"),
        F.create_map("path", author).alias("authors"),
        F.create_map("path", "accepted").alias("classes"),
    )
    location = new_location(spark, "key")
    keys = seeded.unionByName(facts, allowMissingColumns=True)
    keys.write.option("ignoreNullFields", False).json(location)
    key = answer_key.read_answer_key(spark, location)
    planted = answer_key.seeded_errors(key).select("path", F.lit("error").alias("kind"), F.col("type").alias("value"))
    authors = answer_key.expected_authors(key).select("path", F.lit("author").alias("kind"), F.col("author").alias("value"))
    labels = answer_key.accepted_labels(key).select(
        "path",
        F.lit("label").alias("kind"),
        F.coalesce(F.array_join("accepted", ", "), F.lit("none")).alias("value"),
    )
    return planted.unionByName(authors).unionByName(labels)


@query
def crossref_write(spark, sf_dir):
    d = Derived(spark, sf_dir)
    wide = axes.assign_axes(d.manifest, CUSTODIAN_RULES, d.classifications)
    plan = organize.copy_plans(wide, OUT)
    return _text_times(copies.write_crossref(plan, new_location(spark, "tree")))


def _copied(spark, sf_dir, labels: DataFrame | None = None):
    """Write the documents as files, scan them and copy them by all three axes; `labels` are their classifications, where they are stored."""
    root = derived.write_collection(derived_files(spark, sf_dir))
    manifest = collection.scan_collection(spark, root)
    out = f"{root.rsplit('/', 1)[0]}-copies"
    labels = _labelled(spark, sf_dir) if labels is None else labels
    plan = stage(organize.copy_plans(axes.assign_axes(manifest, CUSTODIAN_RULES, labels), out), "plan")
    log = copies.copy_files(plan, out, root)
    return manifest, plan, out, log


def _dates(spark, sf_dir, labels: DataFrame | None = None) -> DataFrame:
    """Times of the copies on disk, as their folders list them, against those of the files they were made from."""
    manifest, plan, out, _ = _copied(spark, sf_dir, labels)
    found = collection.list_inventory(spark, out)
    return stage(recon.date_fidelity(organize.crossref(plan), manifest, found), "dates")


@query
def copy_sink(spark, sf_dir):
    """Files copied by every axis, with the hash of the bytes that were written."""
    *_, out, log = _copied(spark, sf_dir)
    return log.select(
        F.substring(F.col("dest"), F.lit(len(out) + 2), F.length("dest")).alias("copy"),
        "path",
        "sha256",
        "size_bytes",
    )


@query
def copy_verify(spark, sf_dir):
    """Copies of every axis, found again on disk and compared with the plan."""
    _, plan, out, _ = _copied(spark, sf_dir)
    found = collection.scan_collection(spark, out)
    return gates.copy_verify(plan, found).select("path", "verdict")


@query
def crossref_verify(spark, sf_dir):
    labels = stage(_labelled(spark, sf_dir), "labels")
    manifest, plan, out, _ = _copied(spark, sf_dir, labels)
    refs = copies.write_crossref(plan, out)
    found = collection.scan_collection(spark, out)
    due = None
    for axis, buckets in (
        ("class", axes.class_axis(labels)),
        ("author", axes.author_axis(manifest)),
        ("custodian", axes.custodian_axis(manifest, CUSTODIAN_RULES)),
    ):
        rows = buckets.select(F.lit(axis).alias("axis"), F.col("path").alias("original_path"), "bucket")
        due = rows if due is None else due.unionByName(rows)
    return gates.crossref_verify(refs, manifest, found, due)


@query
def date_fidelity(spark, sf_dir):
    return _dates(spark, sf_dir)


# --- extraction and inference ------------------------------------------------


@query
def extract_text(spark, sf_dir):
    """Every document as a text, Word or Excel file, read back by its true type."""
    files = derived.office_files(derived_files(spark, sf_dir))
    return collection.extract_text_from_content(files).select(
        "path",
        "true_type",
        F.length("text").cast("bigint").alias("chars"),
        F.sha2("text", 256).alias("text_hash"),
    )


@query
def extract_author(spark, sf_dir):
    files = derived.office_files(derived_files(spark, sf_dir))
    return collection.extract_author_from_content(files)


def _language_model(texts: list[str]) -> list:
    """A stand-in for a model: counts words, answers in JSON, fails on some texts."""
    import re

    replies = []
    for text in texts:
        if len(text) % 50 == 7:
            replies.append(ValueError("unreadable"))
            continue
        if len(text) % 50 == 9:
            replies.append('{"label": "Klingon", "confidence": 1}')
            continue
        tokens = re.findall("[a-zà-ÿ]+", text.lower())
        hits = {label: sum(map(tokens.count, words)) for label, words in sorted(LANGUAGE_WORDS.items())}
        total, top = sum(hits.values()), max(hits.values())
        label = "other" if top == 0 else max(hits, key=hits.get)
        share = (top * 200 + total) // (2 * total) / 100 if total else 0.0
        replies.append(json.dumps({"label": label, "confidence": share, "reason": f"{top} of {total}"}))
    return replies


def _asked(spark, sf_dir) -> DataFrame:
    return classify.classify_batch(
        derived_files(spark, sf_dir),
        _language_model,
        LANGUAGES,
        text="body",
        hint=derived.language_hint(),
    )


@query
def classify_batch(spark, sf_dir):
    return _asked(spark, sf_dir)


@query
def classify_stored(spark, sf_dir):
    """Answers kept by content: half of the files, then all of them, of which the model sees what is new."""
    files, store = derived_files(spark, sf_dir), new_location(spark, "answers")
    for some in (files.where("doc_id % 2 = 0"), files):
        found = classify.classify_batch(
            some, _language_model, LANGUAGES, text="body", hint=derived.language_hint(), store=store
        )
    return found


@query
def classify_keyword(spark, sf_dir):
    return _labelled(spark, sf_dir)


def _is_held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0


def _quality_labels(spark, sf_dir) -> DataFrame:
    """The derived files of labelled documents, with a label and whether they are kept from the fit."""
    quality = table(spark, sf_dir, "labels").where("quality IS NOT NULL").select(
        "doc_id", F.when(F.col("quality") == 1, "good").otherwise("poor").alias("truth")
    )
    return derived_files(spark, sf_dir).join(quality, "doc_id").withColumn("held_out", _is_held_out(F.col("doc_id")))


@query
def classify_trained(spark, sf_dir):
    """Quality learnt from four fifths of the labelled documents, predicted for all documents."""
    labelled = _quality_labels(spark, sf_dir).where("NOT held_out").select("body", "truth")
    model = trained.train(labelled, "body", "truth")
    location = new_location(spark, "model")
    model.save(location)
    again = trained.Trained.load(spark, location)
    return trained.classify_trained(derived_files(spark, sf_dir), again, text="body", keep=("doc_id",))


# --- whole runs --------------------------------------------------------------


@query
def full_run_figures(spark, sf_dir):
    """Everything from stored tables to the figures of the report."""
    d = Derived(spark, sf_dir)
    dates = _dates(spark, sf_dir)
    return full_run.judge(d.manifest, CUSTODIAN_RULES, OUT, AS_OF, d.classifications, dates=dates).figures


@query
def full_run_collection(spark, sf_dir):
    """The whole run on files: listed, hashed, read, classified, judged, copied three ways and reconciled."""
    files = derived_files(spark, sf_dir)
    hints = files.select("path", derived.language_hint().alias("hint"))
    root = derived.write_collection(files)

    def classifier(texts: DataFrame) -> DataFrame:
        hinted = texts.join(hints, "path", "left")
        return classify.classify_keyword(hinted, LANGUAGE_WORDS, hint=F.coalesce("hint", F.lit("")))

    out = f"{root.rsplit('/', 1)[0]}-organized"
    return full_run.full_run(spark, root, CUSTODIAN_RULES, out, AS_OF, classifier).figures


@query
def no_model_run(spark, sf_dir):
    """Without a classifier: rules, author and custodian axes only."""
    manifest = Derived(spark, sf_dir, labels=False).manifest
    run = full_run.judge(manifest, CUSTODIAN_RULES, OUT, AS_OF)
    found = summaries.findings_by_rule(run.findings).select(
        F.lit("rule").alias("kind"), F.col("rule_id").alias("item"), F.col("findings").alias("n")
    )
    buckets = summaries.bucket_counts(run.crossrefs).select(
        F.col("axis").alias("kind"), F.col("bucket").alias("item"), F.col("files").alias("n")
    )
    return found.unionByName(buckets)
