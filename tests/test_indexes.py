"""Patterns by their rarest run, folder digests, rows by rank."""

import fnmatch
import random

import pytest
from pyspark.sql import functions as F

from ledgerfold.operators import gates, rule_tables, selection, skew, trees


# --- patterns with nothing fixed at an end --------------------------------------------------------------------


def first_fits(inner, patterns):
    lowered = [p.lower() for p in patterns]
    return {p: next((n for n, g in enumerate(lowered) if fnmatch.fnmatchcase(p.lower(), g)), -1) for p in inner}


@pytest.mark.parametrize("min_piece_rows", [1, 100_000])
def test_patterns_by_their_rarest_run(spark, min_piece_rows):
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("abcdé_") for _ in range(n))
    shapes = ["*{0}*", "*{0}*{1}*", "?{0}*", "[!a]*{0}?", "*{0}[ab]{1}*", "*[x{0}]*", "*a]{0}[*", "*{1}?{1}*"]
    patterns = [rng.choice(shapes).format(word(rng.randrange(3, 6)), word(2)) for _ in range(10_000)]
    patterns += ["*ab*", "?a*", "*", "*a?b*", "*[c]*"]
    inner = [f"{word(rng.randrange(9))}/{word(rng.randrange(12))}" for _ in range(150)] + ["", "x", "a]abc[", "ABC/éa_"]
    table = spark.createDataFrame([(n, p, f"who {n}") for n, p in enumerate(patterns)], "rule_order INT, pattern STRING, custodian STRING")
    files = spark.createDataFrame([(f"c/{p}",) for p in inner], "path STRING")
    for rules, own in ((table, patterns), (table.where("rule_order < 10000"), patterns[:10_000])):
        found = {r.path[2:]: r.rule_order for r in rule_tables.first_matches(files, rules, min_piece_rows).collect()}
        assert found == {p: n for p, n in first_fits(inner, own).items() if n >= 0}


def test_no_pattern_is_filed_under_a_constant(spark):
    table = spark.createDataFrame([(0, "*draft*", "x"), (1, "*dr?ft*", "y"), (2, "*a*", "z"), (3, "b*c*", "w")], "rule_order INT, pattern STRING, custodian STRING")
    filed = {r.key or r.kind: r.kind for r in rule_tables.filed_rules(table).collect()}
    assert filed == {"*draft*": "gram", "*dr?ft*": "none", "none": "none"} or set(filed.values()) == {"gram", "none"}
    paths = spark.createDataFrame([("c/a/draft.txt",), ("c/xx",)], "path STRING").select("path", F.col("path").alias("_low"))
    grams = rule_tables._by_grams(paths, rule_tables.filed_rules(table).where("kind = 'gram'").drop("kind"), 1)
    assert [(r.path, r.rule_order) for r in grams.collect()] == [("c/a/draft.txt", 0)]


def test_heavy_keys_of_both_sides(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    others = spark.createDataFrame([("hot", n) for n in range(5)] + [("1", 9), ("none", 1)], "k string, v int")
    counts = rows.groupBy("k").agg(F.count("*").alias("n"))
    joined = skew.join_spread(rows, others, "k", counts, "id", min_piece_rows=10)
    assert joined.count() == rows.join(others, "k").count() == 5 * 1667 + 1
    assert joined.select("k", "id", "v").distinct().count() == joined.count()


# --- folder digests -------------------------------------------------------------------------------------------


def files_of(spark, rows):
    return spark.createDataFrame(rows, "path string, sha256 string").repartition(3)


def some_files(folders=40, files=25):
    return [(f"c/d{n % 4}/e{n}/f{at}.txt", f"h{n}-{at}") for n in range(folders) for at in range(files)]


def test_equal_folders_are_not_looked_into(spark, monkeypatch):
    rows = some_files()
    changed = dict(rows)
    changed["c/d1/e1/f3.txt"] = "other"
    del changed["c/d2/e6/f0.txt"]
    changed["c/d3/new/deep/x"] = "new"
    changed["top"] = "new"
    before, after = files_of(spark, rows), files_of(spark, list(changed.items()))
    compared = []
    diff = trees.snapshot_diff
    monkeypatch.setattr(trees, "snapshot_diff", lambda b, a, *k: compared.append((b.count(), a.count())) or diff(b, a, *k))
    found = trees.tree_diff(before, after)
    want = {("c/d1/e1/f3.txt", "changed"), ("c/d2/e6/f0.txt", "removed"), ("c/d3/new/deep/x", "added"), ("top", "added")}
    assert {tuple(r) for r in found.collect()} == want
    assert {tuple(r) for r in gates.snapshot_diff(before, after).collect()} == want
    assert compared == [(50, 51)]  # 2 folders of 25 files of the 40, one file fewer, and two new ones


def test_trees_of_hard_inventories(spark):
    rows = [("a", "1"), ("a/b", "2"), ("a/b/c", None), ("/x", "3"), ("a//y", "4"), ("é/ü\n/z", "5"), (None, "6"), ("r", "7"), ("r", "7")]
    before = files_of(spark, rows)
    assert trees.tree_diff(before, before.where("path IS NOT NULL OR true").where("path IS NOT NULL")).count() == 1
    other = files_of(spark, [("a", "1"), ("a/b", "2"), ("a/b/c", "9"), ("/x", "3"), ("a//y", "4!"), ("é/ü\n/z", "5"), ("r", "7")])
    got = sorted(map(str, trees.tree_diff(before.where("path <> 'r'"), other).collect()))
    assert got == sorted(map(str, gates.snapshot_diff(before.where("path <> 'r'"), other).collect())) and len(got) >= 2
    none = before.where("path = 'none'")
    assert trees.tree_diff(none, none).count() == 0
    assert {r.change for r in trees.tree_diff(none, other).collect()} == {"added"}
    root = trees.folder_tree(before).where("depth = 0").first()
    assert (root.folder, root.files) == ("", 8)


def test_stored_trees_save_reading(spark):
    before = files_of(spark, some_files(8, 5))
    tree = trees.store_tree(trees.folder_tree(before))
    same = trees.differing_folders(tree, trees.store_tree(trees.folder_tree(before.repartition(7))))
    assert same.count() == 0
    scanned = tree.where("depth = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(depth" in scanned


# --- rows by rank ---------------------------------------------------------------------------------------------


@pytest.mark.parametrize("few", [1, 7, 10_000])
def test_rows_at_their_places(spark, few):
    rng = random.Random(few)
    keys = [f"k{rng.randrange(400):03}" if n % 4 else "same" for n in range(600)] + [None, None, "", "é", "\U0001f600"]
    df = spark.createDataFrame([(k, n) for n, k in enumerate(keys)], "k string, n int").repartition(4)
    order = sorted(range(len(keys)), key=lambda n: ((keys[n] or "").encode(), n))
    places = [1, 2, 3, 4, 77, 300, 301, 449, 604, 605, 606, 0, -3]
    got = {r.position: (r.k, r.n) for r in selection.rows_at(df, "k", places, len(keys), few).collect()}
    assert set(got) == {p for p in places if 1 <= p <= 605}
    for place, (key, n) in got.items():
        assert (keys[order[place - 1]] or "") == (key or "")
        if key not in (None, ""):
            assert n == order[place - 1]


def test_selection_sorts_and_stores_little(spark):
    df = spark.range(200_000).select(F.format_string("%09d", F.col("id") * 7919 % 200_000).alias("k"))
    found = selection.rows_at(df, "k", [1, 100_000, 200_000], 200_000)
    assert sorted((r.position, int(r.k)) for r in found.collect()) == [(1, 0), (100_000, 99_999), (200_000, 199_999)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # Only the ranges' rows reach the window.
    assert "Window" in plan and plan.count("Filter") >= 2
    assert selection.rows_at(df, "k", [], 200_000).count() == 0
