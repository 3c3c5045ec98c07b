"""Alerts on many negative reviews, for tables and streams alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def negative_spike_alert(
    df: DataFrame, ts: str, negative: Column, group: list[str] | None = None,
    window: str = "1 day", slide: str | None = None, min_share: float = 0.3, min_count: int = 10,
) -> DataFrame:
    """Windows whose share of negative rows reaches ``min_share``.

    Windows with fewer than ``min_count`` rows never alert.  On a stream, set a
    watermark first and write in update mode: append mode holds a window back
    until the watermark has passed it.
    """
    span = F.window(ts, window, slide) if slide else F.window(ts, window)
    counts = df.groupBy(span.alias("__window"), *(group or [])).agg(
        F.count("*").alias("review_count"), F.count_if(negative).alias("negative_count")
    )
    share = F.col("negative_count") / F.col("review_count")
    return (
        counts.withColumn("negative_share", share)
        .filter((F.col("review_count") >= min_count) & (F.col("negative_share") >= min_share))
        .select(
            F.col("__window.start").alias("window_start"), F.col("__window.end").alias("window_end"),
            *(group or []), "review_count", "negative_count", "negative_share",
        )
    )
