from pyspark.sql import functions as F

from ledgerfold.operators import rule_tables


def test_a_large_rule_table_is_never_broadcast(spark):
    """Its stored size is far below Spark's limit for broadcasts, its rows are not."""
    files = spark.range(20_000).select(F.concat(F.lit("c/a/f"), "id", F.lit(".txt")).alias("path"))
    rules = spark.range(rule_tables.SMALL_TABLE + 1).select(
        F.col("id").alias("rule_order"), F.concat(F.lit("a/f"), "id", F.lit(".txt")).alias("pattern"), F.lit("x").alias("custodian")
    )
    rest = spark.createDataFrame([(10**6, "*.txt", "y"), (10**6 + 1, "a/*", "z")], rules.schema)
    for min_piece_rows in (100_000, 1000):
        found = rule_tables.first_matches(files, rules.unionByName(rest), min_piece_rows)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [part" in plan
        counts = {r.custodian: r.n for r in found.groupBy("custodian").agg(F.count("*").alias("n")).collect()}
        assert counts == {"x": rule_tables.SMALL_TABLE + 1, "y": 20_000 - rule_tables.SMALL_TABLE - 1}
