"""Shared-folder tables that cut lineage between expensive steps."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session (tests) may run without the setting; it gets a folder
    of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="opinara-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{checkpoint_dir(spark)}/opinara/{label}-{uuid.uuid4().hex}"


def write_once(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Readers get column pruning, filter push-down and real size statistics, and
    a lost executor costs a re-read instead of a recomputation.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete results of ``write_once`` that nothing reads any more; what was made from them must be written already."""
    for table in tables:
        spark = table.sparkSession
        own = f"{checkpoint_dir(spark)}/opinara/".split(":", 1)[-1].lstrip("/")
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            if own not in folder:
                raise ValueError(f"not a table of write_once: {folder}")
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give a source with fewer splits than cores one partition per core.

    Large inputs already have more splits than cores and pass through.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, key)
