"""URL filters: rules for a host, its subdomains and the paths that start with a prefix.

A URL is expanded twice. First into the suffixes of its host, which meet the rules' hosts in an
equi-join on a short prefix of their digests; a host brings the set of path lengths its rules have.
Then each suffix that is some rule's host is expanded into the path prefixes of these lengths, which
meet the rules in the same way. The full digests confirm a pair, and of the rules that fit a URL
the longest decides. So a URL costs a digest for each of its host labels, and one for each
length of a path that a rule of its own hosts has, whatever the number of rules and of their shapes.

One number of the rules is read to the driver, the most labels a host has; whether they are broadcast is left to Spark, which knows
their size. A host's set holds at most as many lengths as the longest path of a rule has characters.
Expanded rows of one URL are next to each other, so they are combined before the one shuffle.

Defined results: a null URL and one without `://` have an empty host and path; the longest
rule is the one with most characters of host and path, then of host; between equal ones block
goes first, then the smallest text; a URL without a rule gets `default`; rows that repeat are judged each;
no rows give no rows, and no rules fit nothing; a result column replaces an input column of its name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.common import with_results

SHORT = 8  # hexadecimal digits of a digest that the join uses
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(found, F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _labels(host: str) -> Column:
    return F.expr(f"length({host}) - length(replace({host}, '.', '')) + 1")


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def url_rules(rules: DataFrame) -> DataFrame:
    """(host, path, verdict) rows with their digests and precedence; rules with nulls fit nothing."""
    return rules.where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL").select(
        F.sha2("host", 256).alias("rule_host"),
        _labels("host").alias("rule_labels"),
        F.length("path").alias("rule_length"),
        _digest(F.col("host"), F.col("path")).alias("rule_digest"),
        F.substring(_digest(F.col("host"), F.col("path")), 1, SHORT).alias("rule_short"),
        F.struct(
            (F.length("host") + F.length("path")).alias("length"),
            F.length("host").alias("host_length"),
            (F.col("verdict") == "block").alias("blocks"),
            F.concat("host", "path").alias("rule"),
            F.col("verdict").alias("verdict"),
        ).alias("precedence"),
    )


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """The rows of pages with host, path, rule (null: none fits) and verdict."""
    known = url_rules(rules)
    hosts = known.groupBy("rule_host").agg(F.collect_set("rule_length").alias("lengths"))
    hosts = hosts.withColumn("host_short", F.substring("rule_host", 1, SHORT))
    # No more labels than the longest host of a rule has.
    most = max(1, known.agg(F.max("rule_labels")).first()[0] or 1)
    suffixes = F.expr(f"transform(sequence(1, least(labels, {most})), n -> substring_index(host, '.', -n))")
    rows = (
        pages.select(
            F.struct("*").alias("page"),
            # Known again when a lost task is repeated: a scan's rows keep their order.
            F.monotonically_increasing_id().alias("row"),
            url_host(F.col(url_col)).alias("host"),
            url_path(F.col(url_col)).alias("path"),
        )
        .withColumn("labels", _labels("host"))
        .withColumn("suffix", F.explode(F.array_distinct(suffixes)))
        .withColumn("digest", F.sha2("suffix", 256))
        .withColumn("short", F.substring("digest", 1, SHORT))
    )
    found = rows.join(
        hosts, (F.col("short") == F.col("host_short")) & (F.col("digest") == F.col("rule_host")), "left"
    ).select("page", "row", "host", "path", "suffix", "lengths")
    fitting = F.filter("lengths", lambda m: m <= F.length("path"))
    expanded = (
        found.withColumn("length", F.explode_outer(fitting))
        .withColumn("digest", _digest(F.col("suffix"), F.substring(F.col("path"), F.lit(1), F.col("length"))))
        .withColumn("short", F.substring("digest", 1, SHORT))
        .select("page", "row", "host", "path", "digest", "short")
    )
    met = expanded.join(
        known.select("rule_digest", "rule_short", "precedence"),
        (F.col("short") == F.col("rule_short")) & (F.col("digest") == F.col("rule_digest")),
        "left",
    )
    judged = met.groupBy("row").agg(
        F.first("page").alias("page"),
        F.first("host").alias("host"),
        F.first("path").alias("path"),
        F.max("precedence").alias("best"),
    )
    return judged.select(
        *with_results(
            "page",
            pages.columns,
            {
                "host": F.col("host"),
                "path": F.col("path"),
                "rule": F.col("best.rule"),
                "verdict": F.coalesce(F.col("best.verdict"), F.lit(default)),
            },
        )
    )
