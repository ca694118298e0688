"""Edges of the scalar functions."""

import fnmatch
import re
from pathlib import PurePosixPath

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerfold.functions import answers, content, names, paths
from ledgerfold.functions.text import iso_seconds, strip
from ledgerfold.operators import rule_tables


def apply(spark, values, column, kind="STRING"):
    rows = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r[0] for r in rows.select(column(F.col("x"))).collect()]


def test_paths(spark):
    given_paths = ["c/a/b/x.txt", "c/x.txt", "x.txt", "c/.hid/./x", "c/c/x.txt", ""]
    assert apply(spark, given_paths, paths.inner_path) == ["a/b/x.txt", "x.txt", "", ".hid/./x", "c/x.txt", ""]
    assert apply(spark, given_paths, paths.folder_depth) == [2, 0, 0, 2, 1, 0]
    assert apply(spark, given_paths, paths.original_folder) == ["a/b", "", "", ".hid/.", "c", ""]
    assert apply(spark, given_paths, paths.folder_label) == [
        "a/b", "(intake root)", "(intake root)", "hid", "c", "(intake root)",
    ]
    hints = ["c/Invoices/x", "c/invoices/x", "c/Invoices", "c/Reports/a/b", "Invoices/x"]
    assert apply(spark, hints, paths.folder_hint) == ["invoice", "", "", "report", ""]
    rebuilt = paths.source_path(F.lit("/data/c"), F.lit("c/a/x"))
    assert spark.range(1).select(rebuilt).first()[0] == "/data/c/a/x"


def test_names(spark):
    given_names = ["a.tar.gz", ".DS_Store", "foo.", "..b", "a..b", "A.PDF", "noext", "a b.c d"]
    assert apply(spark, given_names, paths.suffix) == [".gz", "", "", ".b", ".b", ".PDF", "", ".c d"]
    assert apply(spark, given_names, paths.stem) == ["a.tar", ".DS_Store", "foo.", ".", "a.", "A", "noext", "a b"]


def test_normalized_stem(spark):
    pairs = {
        "Copy of A.pdf": "a",
        "A (1).pdf": "a",
        "A - Copy.pdf": "a",
        "A_v2.docx": "a",
        "A (1) - Copy.pdf": "a (1)",
        "Copy of Copy of A.pdf": "copy of a",
        "A_v2 (3).docx": "a",
        "A (1).pdf": "a",
        "Thumbs.db": "thumbs",
        "  x  .txt": "x",
    }
    assert apply(spark, pairs, names.normalized_stem) == list(pairs.values())


@settings(max_examples=15, deadline=None)
@given(
    st.lists(
        st.lists(
            st.sampled_from(["copy of ", " - copy", "-Copy", " (1)", "(22)", "_v2", "_v", "a", " ", ".", "Copy"]), max_size=6
        ).map("".join),
        min_size=30,
        max_size=30,
    )
)
def test_stem_marks_come_off_one_after_the_other(spark, stems):
    marks = [r"^copy of ", r"\s*\(\d+\)$", r"\s*-\s*copy$", r"_v\d+$"]
    given_names = [s + ".txt" for s in stems]
    wanted = []
    for name in given_names:
        left = PurePosixPath(name).stem.lower()
        for mark in marks:
            left = re.sub(mark, "", left)
        wanted.append(left.strip())
    assert apply(spark, given_names, names.normalized_stem) == wanted


def test_junk_and_naming(spark):
    assert apply(spark, ["~$a.docx", "THUMBS.DB", ".DS_Store", "desktop.ini", "a.ini"], names.is_junk) == [
        True, True, True, True, False,
    ]
    reasons = {
        "clean.txt": "",
        "a b.txt": "contains spaces",
        "a\x1cb.txt": "contains spaces",
        "x.Txt": "non-lowercase extension '.Txt'",
        "Finally!!.txt": "ad-hoc status word(s): final, !!",
        "scan_12.pdf": "scanner-default name (no document identity)",
        "Scan_7.PDF": "non-lowercase extension '.PDF'; scanner-default name (no document identity)",
        "scan_7b.pdf": "",
    }
    assert apply(spark, reasons, names.naming_reasons) == list(reasons.values())


def test_true_type(spark):
    heads = {
        b"": "empty",
        b"%PDF-1.7": "pdf",
        b"%PD": "text",
        b"\x89PNG\r\n\x1a\n1": "png",
        b"\x89PNG": "unknown",
        b"\xff\xd8\xff\xe0": "jpg",
        b"PK\x03\x04": "zip",
        b"\xd0\xcf\x11\xe0\x00": "ole",
        b"GIF87a": "gif",
        b"GIF89a...": "gif",
        b"xGIF89a": "text",
        "naïve".encode(): "text",
        b"\xc3": "unknown",
        b"a" * 2047 + "é".encode(): "text",
        b"a" * 2046 + "€".encode(): "text",
        b"a" * 2045 + "\U0001f600".encode(): "text",
        b"a" * 2047 + b"\xff": "unknown",
        b"a" * 2040 + b"\xff" + b"a" * 100: "unknown",
        b"a" * 3000 + b"\xff": "text",
    }
    assert apply(spark, heads, content.true_type, "BINARY") == list(heads.values())


def test_types_by_extension(spark):
    rows = spark.createDataFrame(
        [(".PDF", "text"), (".docx", "zip"), (".xyz", "text"), (".jpeg", "png"), ("", "ole")],
        "e STRING, k STRING",
    )
    got = rows.select(content.type_disagrees(F.col("e"), F.col("k"))).collect()
    assert [r[0] for r in got] == [True, False, False, True, False]


def test_authors_and_space(spark):
    assert apply(spark, ["  Ann ", "", " \t", None], content.author_or_unassigned) == [
        "Ann", "Unassigned", "Unassigned", "Unassigned",
    ]
    assert apply(spark, ["　x\x1f"], strip) == ["x"]


def test_safe_bucket(spark):
    values = {
        'a<b>:"/\\|?*c': "a_b________c",
        "x. . ": "x",
        "...": "Unassigned",
        "": "Unassigned",
        " lead": "lead",
        "tab\there": "tab_here",
        "é ok": "é ok",
    }
    assert apply(spark, values, paths.safe_bucket) == list(values.values())


def test_iso_seconds(spark):
    row = spark.sql("SELECT TIMESTAMP_NTZ'2024-02-03 04:05:06.999' AS t").select(iso_seconds(F.col("t")))
    assert row.first()[0] == "2024-02-03T04:05:06"


# --- globs -------------------------------------------------------------------

GLOBS = [
    "invoices/*", "*.pdf", "*", "a?c", "[ab]x", "[!ab]x", "[a-c]*", "[]x]y", "[!]]y", "[", "[z-a]q", "a[b",
    "x[.]y", "x^y", "[^a]b", "a\\b", "a+b(c)", "{a}", "[&&]", "[a&&b]", "**x", "a.b", "$", "[[]x", "[a-]b",
]
TEXTS = [
    "invoices/a/b.pdf", "invoices", "abc", "ax", "cx", "bx", "]y", "xy", "[", "zq", "a[b", "x.y", "x^y", "^b",
    "ab", "a\\b", "a+b(c)", "{a}", "&", "a.b", "axb", "$", "[x", "-b", "line\nbreak.pdf", "",
]


def test_globs_match_like_the_shell(spark):
    texts = spark.createDataFrame([(t,) for t in TEXTS], "x STRING")
    tests = [paths.glob_matches(F.col("x"), glob).alias(f"g{i}") for i, glob in enumerate(GLOBS)]
    for row in texts.select("x", *tests).collect():
        for i, glob in enumerate(GLOBS):
            assert row[f"g{i}"] == fnmatch.fnmatchcase(row.x, glob), (glob, row.x)


@settings(max_examples=25, deadline=None)
@given(
    glob=st.text(alphabet="ab*?[]!-.", max_size=7),
    texts=st.lists(st.text(alphabet="ab].-!", max_size=5), min_size=20, max_size=20),
)
def test_random_globs(spark, glob, texts):
    frame = spark.createDataFrame([(t,) for t in texts], "x STRING")
    got = [r[0] for r in frame.select(paths.glob_matches(F.col("x"), glob)).collect()]
    assert got == [fnmatch.fnmatchcase(t, glob) for t in texts]


def test_first_match_wins(spark):
    rules = [("Reports/special.xlsx", "one"), ("REPORTS/*", "two"), ("*.txt", "three")]
    given_paths = ["c/reports/SPECIAL.xlsx", "c/Reports/a/b.txt", "c/x.TXT", "c/none", "x.txt"]
    got = apply(spark, given_paths, lambda p: paths.custodian_match(p, rules))
    assert got == ["one", "two", "three", "Unassigned", "Unassigned"]
    assert apply(spark, ["c/x"], lambda p: paths.custodian_match(p, [])) == ["Unassigned"]


def test_rule_tables_find_what_plain_globs_find(spark):
    """12,000 rules of all shapes, shuffled by order, against fnmatch."""
    shapes = ["D{0}/*", "d{0}/f{1}.txt", "*/f{0}.TXT", "*.e{0}", "d{0}/f?{1}*", "?[!x]{0}/*.e{1}", "*q{0}*", "a]{0}*[", ""]
    patterns = [shapes[n % len(shapes)].format(n % 1000, n % 7) for n in range(12_000)]
    inner = [f"d{n % 40}/F{n % 130}.{'txt' if n % 3 else f'e{n % 50}'}" for n in range(200)]
    inner += ["", "f5.txt", "x/y/f7.txt", "zq12z", "a]3b[", "d1/", "d3/f17z", "dé2/a.e3", "nothing"]
    table = spark.createDataFrame([(n, p, f"who {n}") for n, p in enumerate(patterns)], "rule_order INT, pattern STRING, custodian STRING")
    table = table.unionByName(spark.createDataFrame([(-5, None, "nobody")], table.schema))
    files = spark.createDataFrame([(f"c/{p}", "kept") for p in inner] + [(None, "kept")], "path STRING, custodian STRING")
    found = {r.path: (r.rule_order, r.custodian) for r in rule_tables.first_match_join(files, table).collect()}
    lowered = [p.lower() for p in patterns]
    for path in inner:
        want = next((n for n, p in enumerate(lowered) if fnmatch.fnmatchcase(path.lower(), p)), -1)
        assert found[f"c/{path}"] == (want, f"who {want}" if want >= 0 else "Unassigned"), path
    assert found[None] == (-1, "Unassigned")
    assert rule_tables.first_match_join(files, table.limit(0)).where("rule_order = -1").count() == len(inner) + 1


# --- answers -----------------------------------------------------------------


def test_window_and_gate(spark):
    assert apply(spark, ["é" * 4000], lambda t: F.length(answers.text_window(t))) == [3000]
    assert apply(spark, ["é" * 4000], lambda t: F.length(answers.text_window(t, None))) == [4000]
    texts = ["a" * 20, "a" * 19, " " * 30 + "a" * 19 + "\n", ""]
    assert apply(spark, texts, answers.readable) == [True, False, False, False]
    assert apply(spark, texts[2:3], lambda t: answers.no_text(t).reason) == ["no extractable text (19 chars)"]


ANSWERS = [
    ('{"label": " Invoice ", "confidence": "0.876", "reason": " r "}', ("invoice", 0.88, "ok", "r")),
    ('{"label": "report"}', ("report", 0.0, "ok", "")),
    ('{"label": "report", "confidence": null, "reason": null}', ("report", 0.0, "ok", "None")),
    ('{"label": "report", "confidence": "high"}', ("report", 0.0, "ok", "")),
    ('{"label": "report", "confidence": 7}', ("report", 7.0, "ok", "")),
    ('{"label": "report", "confidence": true}', ("report", 1.0, "ok", "")),
    ('{"label": "memo"}', ("unclassified", 0.0, "model_error", "model returned invalid label 'memo'")),
    ('{"label": null}', ("unclassified", 0.0, "model_error", "model returned invalid label 'none'")),
    ("{}", ("unclassified", 0.0, "model_error", "model returned invalid label ''")),
    ('{"label": "it\'s"}', ("unclassified", 0.0, "model_error", 'model returned invalid label "it\'s"')),
    ('{"label": 5}', ("unclassified", 0.0, "model_error", "model returned invalid label '5'")),
    ('{"label": "rep', ("unclassified", 0.0, "model_error", "model call failed: JSONDecodeError")),
    ('{"label": "report"} etc', ("unclassified", 0.0, "model_error", "model call failed: JSONDecodeError")),
    ("", ("unclassified", 0.0, "model_error", "model call failed: JSONDecodeError")),
    ('{"label": "other", "reason": "%s"}' % ("x" * 200), ("other", 0.0, "ok", "x" * 200)),
]


@pytest.mark.parametrize("raw, wanted", ANSWERS)
def test_parse_answer(spark, raw, wanted):
    got = apply(spark, [raw], lambda r: answers.parse_answer(r))[0]
    assert tuple(got) == wanted


def test_confidences_round_like_doubles(spark):
    values = [0.745, 0.125, 0.845, 0.285, 0.615, 0.135, 0.375, 0.995, 1.005, -0.125, 0.0, 1.0, 2.675, 1e300]
    values += [n / 1000 for n in range(0, 1000, 5)]
    raw = [('{"label": "other", "confidence": %r}' % v, round(v, 2)) for v in values]
    raw += [('{"label": "other", "confidence": %s}' % v, w) for v, w in (("1e400", float("inf")), ('"0.9d"', 0.0), ('"0x1p3"', 0.0), ('".5"', 0.5))]
    frame = spark.createDataFrame(raw, "raw STRING, want DOUBLE")
    got = frame.select("raw", "want", answers.parse_answer(F.col("raw"))["confidence"].alias("got")).collect()
    assert [r.raw for r in got if r.got != r.want] == []
