"""Joining group results back to rows when one group may hold a third of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.sources.staging import stage

# A key is heavy when it holds more than 1 in HEAVY_SHARE of all rows, so there
# are fewer than HEAVY_SHARE heavy keys whatever the size of the table.
HEAVY_SHARE = 10_000
# Below this many rows a group is no burden for one task.
MIN_PIECE_ROWS = 100_000


def attach_groups(
    rows: DataFrame,
    groups: DataFrame,
    key: str,
    size: str,
    spread_by: str,
    min_piece_rows: int = MIN_PIECE_ROWS,
) -> DataFrame:
    """Inner join of `rows` with one row per key of `groups`, safe for heavy keys.

    The groups are stored first: they are needed twice but aggregated once, and
    their stored size lets Spark broadcast them whole where they are few.
    `groups.size` is the number of rows of the key. Rows of a heavy key are
    spread over pieces by a hash of `spread_by`, and the key's group row is
    repeated once per piece; all other keys join as they are. The list of heavy
    keys is broadcast: it has fewer than HEAVY_SHARE rows, and its pieces add up
    to less than twice that, because sizes cannot add up to more than all rows.
    """
    groups = stage(groups, "groups")
    total = rows.agg(F.count("*").alias("total"))
    # Groups too large for one task, in pieces of at least piece_rows rows each.
    pieces = f"IF({size} > _piece_rows, ceil({size} / _piece_rows), 1)"
    sized = groups.withColumn(
        "_piece_rows", F.greatest(total.scalar() / HEAVY_SHARE, F.lit(min_piece_rows))
    ).withColumn("_pieces", F.expr(pieces))
    heavy = sized.where("_pieces > 1").selectExpr(f"`{key}` AS _heavy_key", "_pieces")
    spread = rows.join(F.broadcast(heavy), rows[key] == heavy["_heavy_key"], "left").selectExpr(
        *[f"`{c}`" for c in rows.columns],
        f"coalesce(pmod(xxhash64(`{spread_by}`), _pieces), 0) AS _piece",
    )
    repeated = sized.selectExpr(
        *[f"`{c}`" for c in groups.columns], "explode(sequence(0L, _pieces - 1)) AS _piece"
    )
    return spread.join(repeated, [key, "_piece"]).drop("_piece")


def join_spread(
    rows: DataFrame,
    others: DataFrame,
    key: str,
    counts: DataFrame,
    spread_by: str,
    min_piece_rows: int = MIN_PIECE_ROWS,
    strategy: str | None = None,
) -> DataFrame:
    """Inner join on `key` where many rows of both sides may share one; `counts` holds (key, n) of `rows`.

    Rows of a heavy key are spread over pieces by a hash of `spread_by`, and the others of that
    key repeated once a piece. As above there are fewer than HEAVY_SHARE heavy keys. `counts` may leave
    out keys of no more than min_piece_rows rows. `strategy` is a join hint for `others`.
    """
    limit = F.greatest(counts.agg(F.sum("n").alias("t")).scalar() / HEAVY_SHARE, F.lit(min_piece_rows))
    pieces = F.ceil(F.col("n") / limit).cast("bigint").alias("_pieces")
    heavy = F.broadcast(counts.where(F.col("n") > limit).select(F.col(key).alias("_heavy_key"), pieces))
    spread = rows.join(heavy, rows[key] == F.col("_heavy_key"), "left").selectExpr(
        *[f"`{c}`" for c in rows.columns], f"coalesce(pmod(xxhash64(`{spread_by}`), _pieces), 0) AS _piece"
    )
    repeated = others.join(heavy, others[key] == F.col("_heavy_key"), "left").selectExpr(
        *[f"`{c}`" for c in others.columns], "explode(sequence(0L, coalesce(_pieces, 1) - 1)) AS _piece"
    )
    return spread.join(repeated.hint(strategy) if strategy else repeated, [key, "_piece"]).drop("_piece")
