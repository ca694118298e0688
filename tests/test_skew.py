"""Groups that hold a third of all rows, checked against brute force."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerfold.operators import gates, organize, rules
from ledgerfold.operators.numbering import number_rows
from ledgerfold.operators.skew import attach_groups


@pytest.fixture(scope="module")
def lopsided(spark):
    """3,000 files: a third share one name and one hash, others pair up."""
    rows = []
    for n in range(3000):
        if n % 3 == 0:
            name, digest = ("Thumbs.db" if n % 2 else "thumbs.DB"), "hot" if n % 4 else f"h{n}"
        else:
            name, digest = f"doc_{n // 4}{' (1)' if n % 2 else ''}.txt", f"h{n // 5}"
        rows.append((f"c/{n % 7}/{n}/{name}", name, digest, 0 if n % 50 == 1 else 10))
    return spark.createDataFrame(rows, "path STRING, name STRING, sha256 STRING, size_bytes BIGINT").cache()


def brute(rows, key, keep, intro, differ=False):
    groups = defaultdict(list)
    for r in rows:
        if keep(r):
            groups[key(r)].append(r)
    out = set()
    for k, group in groups.items():
        if len(group) < 2 or differ and len({r.sha256 for r in group}) < 2:
            continue
        out |= {(r.path, f"{intro}{len(group) - 1} other file(s) of group {k}") for r in group}
    return out


@pytest.mark.parametrize("min_piece_rows", [1, 40, 100_000])
def test_duplicates_against_brute_force(lopsided, min_piece_rows):
    rows = lopsided.collect()
    got = rules.exact_duplicates(lopsided, min_piece_rows).collect()
    want = brute(rows, lambda r: r.sha256, lambda r: r.size_bytes > 0, "identical bytes to: ")
    assert len(got) == len(want) and {(r.path, r.detail) for r in got} == want

    def stem(r):
        return r.name.rsplit(".", 1)[0].lower().replace(" (1)", "")

    got = rules.near_duplicate_names(lopsided, min_piece_rows).collect()
    want = brute(rows, stem, lambda r: True, "same base name, different content vs: ", differ=True)
    assert len(got) == len(want) and {(r.path, r.detail) for r in got} == want


def test_a_group_of_thousands_has_short_details(spark):
    files = spark.range(5000).selectExpr("concat('c/', id) AS path", "concat(id, '.txt') AS name", "'h' AS sha256", "1L AS size_bytes")
    got = rules.exact_duplicates(files)
    assert got.count() == 5000
    assert got.select("detail").distinct().collect() == [("identical bytes to: 4999 other file(s) of group h",)]


def test_large_groups_are_listed_in_full_elsewhere(lopsided):
    members = rules.duplicate_members(lopsided, min_piece_rows=40)
    hot = members.where("rule_id = 'EXACT_DUP' AND group_key = 'hot'")
    rows = [r for r in lopsided.collect() if r.sha256 == "hot" and r.size_bytes > 0]
    assert hot.count() == len(rows) == hot.first().n


def test_heavy_keys_are_spread(spark, lopsided):
    groups = lopsided.groupBy("sha256").agg(F.count("*").alias("n"))
    joined = attach_groups(lopsided, groups, "sha256", "n", "path", min_piece_rows=50)
    assert joined.count() == lopsided.count()
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_pieces" in plan and "strategy=broadcast" in plan


def test_no_part_of_a_group_is_gathered_whole(lopsided):
    plan = rules.exact_duplicates(lopsided)._jdf.queryExecution().executedPlan().toString()
    assert "Window [" not in plan and "collect_list" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_collisions_against_brute_force(spark, lopsided):
    plan = lopsided.select("path", F.concat(F.lit("out/"), "name").alias("dest"))
    first, want = {}, set()
    for path, dest in sorted((r.path, r.dest) for r in plan.collect()):
        if dest in first:
            want.add((dest, first[dest], path))
        first.setdefault(dest, path)
    for rows in (1, 100_000):
        got = organize.collisions(plan, min_piece_rows=rows)
        assert {tuple(r) for r in got.collect()} == want and got.count() == len(want)
    assert organize.collisions(plan, fold_case=True).count() > len(want)
    with pytest.raises(organize.CollisionError, match="would overwrite"):
        organize.refuse_collisions(plan)
    organize.refuse_collisions(plan.withColumn("dest", F.col("path")))


def test_row_numbers(spark, lopsided):
    got = number_rows(lopsided.select("path", "name"), [F.col("name"), F.col("path")]).collect()
    order = sorted(got, key=lambda r: (r.name.encode(), r.path.encode()))
    assert [r.position for r in order] == list(range(1, len(order) + 1))


def test_systematic_sample(spark, lopsided):
    labels = lopsided.select(
        "path", F.lit("x").alias("label"), F.when(F.col("size_bytes") > 0, "ok").otherwise("no_text").alias("status")
    )
    got = {r.path: r.position for r in gates.systematic_sample(lopsided.select("path"), labels).collect()}
    ok = sorted(r.path for r in labels.where("status = 'ok'").collect())
    step = len(ok) // 8
    assert got == {p: at * step + 1 for at, p in enumerate(ok[::step][:8])}
