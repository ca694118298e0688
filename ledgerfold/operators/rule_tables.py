"""First match in a rule table of any size, by equi-joins.

Every pattern is filed under the most telling part of it that holds no wildcard, and every path
looks under each of its own parts:

    path   a pattern without wildcards          invoices/a.txt
    name   a fixed end with a whole file name   */scan_5.pdf
    dir    a fixed start with whole folders     invoices/*, invoices/2019-?.txt
    ext    a fixed end with an extension        *.zip
    gram   three fixed characters inside        *draft*
    none   none of these                        *, ?a*

Parts that many paths share are counted and split by their counts, so no task holds one alone. Above
SMALL_TABLE rules none is sent whole to every task: Spark would go by their size on disk. A `gram` pattern
is filed under the rarest of its runs of GRAM fixed characters, counted over the paths; one that holds a run
no path has fits nothing. Runs that many paths share are split by their counts. `none` patterns name
nothing to look them up by: they go over the paths in blocks, as conditions. Only tables
with such patterns pay for either.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerfold.constants import UNASSIGNED
from ledgerfold.functions.paths import glob_to_regex, inner_path
from ledgerfold.operators.numbering import number_rows
from ledgerfold.operators.skew import MIN_PIECE_ROWS, join_spread
from ledgerfold.sources.staging import stage

SMALL_TABLE = 10_000
GRAM = 3
BLOCK_PATTERNS = 100


@F.pandas_udf(StringType())
def _regex(patterns: pd.Series) -> pd.Series:
    return patterns.map(glob_to_regex)


def _entry(kind: str, key: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), key.alias("key"))


def _name(text: Column) -> Column:
    return F.regexp_extract(text, r"(?s)([^/]*)\z", 1)


def _extension(text: Column) -> Column:
    """From the last dot on; '' without one."""
    return F.regexp_extract(text, r"(?s)(\.[^.]*)\z", 1)


def _grams(text: Column) -> Column:
    """The distinct runs of GRAM characters of a text."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(text) - (GRAM - 1), F.lit(1)))
    runs = F.transform(starts, lambda at: F.substring(text, at, F.lit(GRAM)))
    return F.array_distinct(F.filter(runs, lambda run: F.length(run) == GRAM))


def _fixed_grams(pattern: Column) -> Column:
    """Runs that every path a pattern fits must hold; what stands between brackets may be a choice."""
    outer = F.regexp_replace(pattern, r"(?s)\[.*\]", "*")
    return F.array_distinct(F.flatten(F.transform(F.split(outer, r"[*?\[\]]"), _grams)))


def filed_rules(rules: DataFrame) -> DataFrame:
    """Rules (rule_order, pattern, custodian) with the part they are filed under; of equal patterns the first.

    A pattern without wildcards, `folder/*` or `*.ext` fits all that its part is found by; `regex` confirms the others.
    """
    low = F.lower("pattern")
    head = F.regexp_extract(low, r"(?s)^([^*?\[]*)", 1)
    tail = F.regexp_extract(low, r"(?s)([^*?\[\]]*)\z", 1)
    folders = F.regexp_extract(head, r"(?s)^(.*/)", 1)
    plain = ~low.rlike(r"[*?\[]")
    filed = (
        F.when(plain, _entry("path", low))
        .when(F.contains(tail, F.lit("/")), _entry("name", _name(tail)))
        .when(folders != "", _entry("dir", folders))
        .when(F.contains(tail, F.lit(".")), _entry("ext", _extension(tail)))
        .when(F.size(_fixed_grams(low)) > 0, _entry("gram", low))
        .otherwise(_entry("none", F.lit("")))
    )
    sure = plain | low.rlike(r"(?s)^([^*?\[]*/\*|\*\.[^.*?\[\]/]*)\z")
    order = F.col("rule_order").cast("bigint").alias("rule_order")
    return (
        rules.where("pattern IS NOT NULL")
        .groupBy(low.alias("pattern"))
        .agg(F.min(F.struct(order, "custodian")).alias("_rule"))
        .select(
            "_rule.*",
            filed.alias("_filed"),
            F.when(~sure, _regex(F.col("pattern"))).alias("regex"),
        )
        .select("rule_order", "custodian", "_filed.*", "regex")
    )



def _parts(path: Column) -> Column:
    """All parts a path can be found by; as many as it has folders, and three."""
    steps = F.split(path, "/")
    folders = F.transform(
        F.slice(steps, 1, F.size(steps) - 1),
        lambda _, at: _entry("dir", F.concat(F.array_join(F.slice(steps, 1, at + 1), "/"), F.lit("/"))),
    )
    return F.concat(
        folders,
        F.array(
            _entry("path", path), _entry("name", _name(path)), _entry("ext", _extension(path))
        ),
    )


def _part() -> Column:
    return F.concat("kind", F.lit(" "), "key")


def _by_grams(paths: DataFrame, patterns: DataFrame, min_piece_rows: int) -> DataFrame:
    """Pairs of paths (path, _low) and patterns (rule_order, custodian, key, regex) that share the pattern's rarest run."""
    runs = patterns.select("*", F.explode(_fixed_grams(F.col("key"))).alias("gram"))
    held = paths.select("path", "_low", F.explode(_grams(F.col("_low"))).alias("gram"))
    asked = stage(runs.select("gram").distinct(), "pattern-runs")
    counts = stage(held.select("gram").join(asked, "gram", "left_semi").groupBy("gram").agg(F.count("*").alias("n")), "run-counts")
    # A run without paths has no count, and then no path has all the pattern asks for.
    rated = runs.join(counts, "gram", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rarest = stage(
        rated.groupBy("rule_order", "custodian", "key", "regex").agg(F.min(F.struct("n", "gram")).alias("_least"))
        .where("_least.n > 0")
        .select("rule_order", "custodian", "regex", F.col("_least.gram").alias("gram")),
        "rarest-runs",
    )
    used = counts.join(rarest.select("gram").distinct(), "gram", "left_semi")
    return join_spread(held, rarest, "gram", used, "path", min_piece_rows).drop("gram")


def _by_blocks(paths: DataFrame, patterns: DataFrame) -> list[DataFrame]:
    """(path, rule_order, custodian) of the first of some patterns, for BLOCK_PATTERNS of them at a time."""
    numbered = number_rows(patterns, [F.col("rule_order"), F.col("custodian"), F.col("regex")])
    blocks = stage(numbered.withColumn("_block", F.floor((F.col("position") - 1) / BLOCK_PATTERNS)), "pattern-blocks")
    found = []
    for at in range((blocks.agg(F.max("_block")).first()[0] or 0) + 1):
        # At most BLOCK_PATTERNS rows.
        rows = blocks.where(F.col("_block") == at).orderBy("rule_order", "custodian").collect()
        firsts = [
            F.when(
                F.col("_low").rlike(row.regex),
                F.struct(F.lit(row.rule_order).cast("bigint").alias("rule_order"), F.lit(row.custodian).alias("custodian")),
            )
            for row in rows
        ]
        fits = paths.select("path", F.coalesce(*firsts).alias("_first"))
        found.append(fits.where("_first IS NOT NULL").select("path", "_first.*"))
    return found


def first_matches(paths: DataFrame, rules: DataFrame, min_piece_rows: int = MIN_PIECE_ROWS) -> DataFrame:
    """(path, rule_order, custodian) of the first rule that fits, for the paths that have one.

    The smallest rule_order wins; of rules that share it, the custodian that comes first.
    """
    lowered = paths.select("path", F.lower(inner_path(F.col("path"))).alias("_low"))
    wanted = lowered.select("path", "_low", F.inline(_parts(F.col("_low")))).select("path", "_low", _part().alias("part"))
    filed = stage(filed_rules(rules), "filed-rules")
    kinds = {row.kind: row.n for row in filed.groupBy("kind").agg(F.count("*").alias("n")).collect()}  # at most six
    sure = filed.where("kind NOT IN ('gram', 'none')").select("rule_order", "custodian", "regex", _part().alias("part"))
    large = sum(n for kind, n in kinds.items() if kind not in ("gram", "none")) > SMALL_TABLE
    asked = wanted.select("part")
    if not large:
        asked = asked.join(F.broadcast(sure.select("part").distinct()), "part", "left_semi")
    heavy = asked.groupBy("part").agg(F.count("*").alias("n")).where(F.col("n") > min_piece_rows)
    pairs = join_spread(
        wanted, sure, "part", stage(heavy, "shared-parts"), "path", min_piece_rows, "merge" if large else None
    ).select("path", "_low", "rule_order", "custodian", "regex")
    if "gram" in kinds:
        inside = filed.where("kind = 'gram'").drop("kind")
        pairs = pairs.unionByName(_by_grams(lowered, inside, min_piece_rows))
    fits = pairs.where(F.col("regex").isNull() | F.expr("_low RLIKE regex")).select("path", "rule_order", "custodian")
    if "none" in kinds:
        for block in _by_blocks(lowered, filed.where("kind = 'none'")):
            fits = fits.unionByName(block)
    return (
        fits.groupBy("path")
        .agg(F.min(F.struct("rule_order", "custodian")).alias("_first"))
        .select("path", "_first.*")
    )


def first_match_join(manifest: DataFrame, rules: DataFrame) -> DataFrame:
    """Which rule claims a file, and for whom; -1 and Unassigned where none does.

    Rows keep their other columns; repeated paths get the same rule, a null path none.
    """
    found = first_matches(manifest, rules)
    kept = [c for c in manifest.columns if c.lower() not in ("rule_order", "custodian")]
    return manifest.select(*kept).join(found, "path", "left").withColumns(
        {
            "rule_order": F.coalesce("rule_order", F.lit(-1)).cast("bigint"),
            "custodian": F.coalesce("custodian", F.lit(UNASSIGNED)),
        }
    )
