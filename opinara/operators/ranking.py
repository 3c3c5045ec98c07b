"""RANK() over large row sets without one big window partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .keyed_join import join_unique

BUCKETS = 64
ONE_WINDOW_ROWS = 100_000


def _bucket(value: Column, cuts: list[float]) -> Column:
    """Number of cuts at or below the value; null sorts above all."""
    if not cuts:
        return F.when(value.isNull(), F.lit(1)).otherwise(F.lit(0))
    below = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= value))
    return F.when(value.isNull(), F.lit(len(cuts) + 1)).otherwise(below)


def rank_by(
    df: DataFrame, value: str, rank_col: str, partition: list[str] | None = None,
    buckets: int = BUCKETS, one_window_rows: int = ONE_WINDOW_ROWS,
) -> DataFrame:
    """Add ``RANK() OVER (PARTITION BY partition ORDER BY value DESC)``.

    ``df`` is a written table: its size is checked first, and a small one is
    ranked in a plain window.  A larger one is ranked range by range.  Distinct values are counted first (ties collapse in the map-side combine),
    then cut into value ranges.  The rank of a value is one plus the rows in
    higher ranges plus the rows above it in its own range, so no task sees more
    than one range of distinct values of one group.
    """
    part = list(partition or [])
    if df.limit(one_window_rows + 1).count() <= one_window_rows:
        window = W.partitionBy(*part).orderBy(F.col(value).desc_nulls_first())
        return df.withColumn(rank_col, F.rank().over(window))
    values = df.groupBy(*part, value).agg(F.count("*").alias("n"))
    probes = [i / buckets for i in range(1, buckets)]
    cuts = values.agg(F.percentile_approx(value, probes, 10_000)).first()[0] or []
    counts = values
    values = values.withColumn("__bucket", _bucket(F.col(value), sorted(set(cuts))))

    before = (W.unboundedPreceding, -1)
    inside = (
        W.partitionBy(*part, "__bucket").orderBy(F.col(value).desc_nulls_first()).rowsBetween(*before)
    )
    # One row per group and range: at most ``buckets + 1`` rows per group.
    ranges = values.groupBy(*part, "__bucket").agg(F.sum("n").alias("__rows"))
    above = W.partitionBy(*part).orderBy(F.col("__bucket").desc()).rowsBetween(*before)
    ranges = ranges.select(
        *part, "__bucket", F.coalesce(F.sum("__rows").over(above), F.lit(0)).alias("__above")
    )
    inner = values.withColumn("__inner", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    left, right = inner.alias("l"), ranges.alias("r")
    same = F.col("l.__bucket") == F.col("r.__bucket")
    for p in part:
        same = same & F.col(f"l.{p}").eqNullSafe(F.col(f"r.{p}"))
    ranks = left.join(right, same).select(
        *[F.col(f"l.{c}").alias(c) for c in part + [value]],
        (F.col("__above") + F.col("__inner") + 1).cast("int").alias(rank_col),
    )
    return join_unique(df, ranks, part + [value], "left", counts=counts)
