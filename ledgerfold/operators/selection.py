"""Rows at given places of an order, without sorting or storing all rows.

Boundaries from a bounded sample cut the keys into ranges; one count for each tells which ranges
hold a wanted place. Only those are cut again, and their conditions reach the scan, until each
holds few enough rows to be sorted.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CUTS = 64
FEW_ROWS = 10_000


@dataclass
class Span:
    """Keys above `low` and up to `high` (None: no limit), the rows before them and in them, and wanted places."""

    low: str | None
    high: str | None
    before: int
    rows: int
    places: list[int]

    def holds(self, key: Column) -> Column:
        above = F.lit(True) if self.low is None else key > self.low
        return above if self.high is None else above & (key <= self.high)


def _cut(df: DataFrame, key: Column, span: Span) -> list[Span]:
    """The parts of a span that hold its places; the span itself where its keys are all alike."""
    inside = df.where(span.holds(key)).select(key.alias("key"))
    # At most CUTS distinct keys, the same for the same rows.
    sample = inside.select("key", F.xxhash64("key").alias("h")).distinct().orderBy("h", "key").limit(CUTS).collect()
    cuts = sorted({row["key"] for row in sample} - {span.high})
    if not cuts:
        return [span]
    below = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda cut: cut < F.col("key")))
    counts = {r["at"]: r["n"] for r in inside.groupBy(below.alias("at")).agg(F.count("*").alias("n")).collect()}
    found, before = [], span.before
    for at in range(len(cuts) + 1):
        rows = counts.get(at, 0)
        places = [place for place in span.places if before < place <= before + rows]
        if places:
            low = cuts[at - 1] if at else span.low
            found.append(Span(low, cuts[at] if at < len(cuts) else span.high, before, rows, places))
        before += rows
    return found


def rows_at(df: DataFrame, key: str, places: list[int], rows: int, few: int = FEW_ROWS) -> DataFrame:
    """The rows of df at some places (from 1) of its `rows` rows in the order of a text key, with `position`.

    Rows of one key are told apart by their other columns. A null key sorts as an empty one.
    """
    by = F.coalesce(F.col(key), F.lit(""))
    done, waiting = [], [Span(None, None, 0, rows, sorted({p for p in places if 1 <= p <= rows}))]
    while waiting:
        span = waiting.pop()
        if not span.places:
            continue
        parts = [span] if span.rows <= few else _cut(df, by, span)
        if parts == [span]:
            done.append(span)
        else:
            waiting += parts
    if not done:
        return df.limit(0).withColumn("position", F.lit(0).cast("bigint"))
    which = reduce(lambda rest, at: F.when(done[at].holds(by), at).otherwise(rest), range(len(done)), F.lit(None).cast("int"))
    held = df.where(reduce(Column.__or__, (span.holds(by) for span in done))).withColumn("_span", which)
    order = Window.partitionBy("_span").orderBy(by, *[F.col(f"`{c}`") for c in df.columns if c != key])
    before = F.element_at(F.array(*[F.lit(span.before) for span in done]), F.col("_span") + 1)
    numbered = held.withColumn("position", (F.row_number().over(order) + before).cast("bigint"))
    wanted = sorted({place for span in done for place in span.places})
    return numbered.where(F.col("position").isin(wanted)).drop("_span")
