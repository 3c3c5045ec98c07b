"""Joins with a side that has one row per key, safe for hot keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 0.001
BROADCAST_ROWS = 100_000


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(
        lambda a, b: a & b, [left[k].eqNullSafe(right[f"__{k}"]) for k in keys]
    )


def _prefixed(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.withColumnsRenamed({k: f"__{k}" for k in keys})


def join_unique(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "left",
    counts: DataFrame | None = None,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """Join ``left`` with ``right``, which holds at most one row per key.

    A key is hot when it holds at least ``hot_share`` of the left rows, so there
    are at most ``1 / hot_share`` hot keys whatever the data: these few keys come
    to the driver, their right rows are broadcast and the hot left rows never
    move.  All other rows meet in an ordinary shuffle join in which no key is
    large.  Null keys match null keys.

    ``counts`` (the keys plus ``n``, rows per key in ``left``) saves one
    aggregation when the caller has it.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be left or inner")
    if counts is None:
        total = left.count()
        counts = left.groupBy(*on).agg(F.count("*").alias("n"))
    else:
        total = counts.agg(F.sum("n")).first()[0] or 0
    hot = counts.filter(F.col("n") >= F.lit(max(1.0, total * hot_share))).select(*on, "n").collect()

    def matched(rows: DataFrame, table: DataFrame, broadcast: bool) -> DataFrame:
        table = _prefixed(table, on)
        if broadcast:
            table = F.broadcast(table)
        out = rows.join(table, _same(rows, table, on), how)
        return out.drop(*[f"__{k}" for k in on])

    if not hot:
        return matched(left, right, False)
    schema = counts.select(*on).schema
    keys = left.sparkSession.createDataFrame([tuple(r)[:-1] for r in hot], schema)
    keys = F.broadcast(_prefixed(keys, on))
    hot_right = right.join(keys, _same(right, keys, on), "left_semi")
    if sum(r["n"] for r in hot) == total:
        return matched(left, hot_right, True)
    hot_left = left.join(keys, _same(left, keys, on), "left_semi")
    cold_left = left.join(keys, _same(left, keys, on), "left_anti")
    return matched(hot_left, hot_right, True).unionByName(matched(cold_left, right, False))


def join_small(
    left: DataFrame, right: DataFrame, on: list[str], how: str = "inner",
    max_rows: int = BROADCAST_ROWS, rows: int | None = None,
) -> DataFrame:
    """Broadcast ``right`` when it provably has at most ``max_rows`` rows, else shuffle.

    ``right`` holds one row per key.  ``rows`` is an upper bound of its size where
    the caller knows one; otherwise it is counted up to the limit.
    """
    if rows is None:
        rows = right.limit(max_rows + 1).count()
    if rows <= max_rows:
        return left.join(F.broadcast(right), on, how)
    return join_unique(left, right, on, how)
