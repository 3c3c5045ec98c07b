"""Session settings for large runs."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution sizes the reducers at run time: many small shuffle blocks
# first, merged to the advisory size, skewed partitions of joins split.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def shuffle_partitions(input_bytes: int, cores: int, target_bytes: int = 128 << 20) -> int:
    """Initial shuffle partitions: target-sized pieces, at least two per core."""
    return max(2 * cores, -(-input_bytes // target_bytes))


def configure(
    builder: SparkSession.Builder, shared_folder: str | None = None, initial_partitions: int | None = None
) -> SparkSession.Builder:
    """Apply the settings; ``shared_folder`` is where intermediate tables are written."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if shared_folder:
        builder = builder.config("spark.checkpoint.dir", shared_folder)
    if initial_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(initial_partitions))
    return builder
