"""Readers and writers of review tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import date_text
from ..schemas import ENRICHED, REVIEW


BAD = "_corrupt_record"


def _is_array(spark: SparkSession, path: str) -> bool:
    """Whether the first file begins like an array that goes over several lines."""
    first = spark.read.text(path).filter(F.trim("value") != "").limit(1).collect()
    return bool(first) and first[0]["value"].strip() == "["


def read_json(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool | None = None, rejected: str | None = None
) -> DataFrame:
    """Records of JSON Lines (a line may hold an array), or of files that hold one array each.

    Records that cannot be read whole, or hold a value of another type, are left out; with
    ``rejected`` they are written to that folder, as text (``record``) with their ``file``.
    ``multi_line=None`` looks at the first line; only JSON Lines can be split.
    """
    if multi_line is None:
        multi_line = _is_array(spark, path)
    with_bad = T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])
    rows = spark.read.schema(with_bad).option("mode", "PERMISSIVE").option("multiLine", multi_line).option(
        "columnNameOfCorruptRecord", BAD).json(path)
    if rejected:
        bad = rows.filter(F.col(BAD).isNotNull()).select(
            F.col(BAD).alias("record"), F.input_file_name().alias("file"), F.to_json(F.struct(*schema.names)).alias("read"))
        bad.write.mode("overwrite").parquet(rejected)
    # A column that nobody reads is not parsed, and so would not show that it is broken: the
    # condition reads them all, whatever columns a query goes on with.
    parsed = F.concat_ws("", *[F.col(c).cast("string") for c in schema.names]) == F.col(BAD)
    return rows.filter(F.col(BAD).isNull() | parsed).drop(BAD)


def read_rejected(spark: SparkSession, folder: str) -> DataFrame:
    """Records that ``read_json`` left out: ``record``, ``file`` and what could be ``read`` of them."""
    return spark.read.schema("record string, file string, read string").parquet(folder)


def read_reviews(
    spark: SparkSession, path: str, with_id: bool = False, multi_line: bool | None = None, rejected: str | None = None
) -> DataFrame:
    """Raw reviews from JSON, as ``read_json`` reads them.

    ``with_id`` adds a unique, not consecutive, row id.
    """
    df = read_json(spark, path, REVIEW, multi_line, rejected)
    return df.withColumn("id", F.monotonically_increasing_id()) if with_id else df


def read_enriched(
    spark: SparkSession, path: str, text_column: str = "final_text",
    multi_line: bool | None = None, schema: T.StructType = ENRICHED, rejected: str | None = None,
) -> DataFrame:
    """Enriched reviews from JSON; a missing text column is an error."""
    if text_column not in schema.fieldNames():
        raise ValueError(f"column {text_column!r} not found, columns are {schema.fieldNames()}")
    return read_json(spark, path, schema, multi_line, rejected)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def _laid_out(df: DataFrame, partition_by: list[str] | None, sort_by: list[str] | None):
    if "review_date" in df.columns and df.schema["review_date"].dataType != T.DateType():
        df = normalise_date_text(df)
    if partition_by:
        df = df.repartition(*partition_by, F.pmod(F.monotonically_increasing_id(), F.lit(FILES_PER_PARTITION)))
    if sort_by:
        df = df.sortWithinPartitions(*(partition_by or []), *sort_by)
    writer = df.write.mode("overwrite").format("parquet")
    return writer.partitionBy(*partition_by) if partition_by else writer


#: Tasks that write one partition value at most: a value of a third of the rows is not one task's.
FILES_PER_PARTITION = 16


def write_replace(
    df: DataFrame, name: str, partition_by: list[str] | None = None,
    sort_by: list[str] | None = None,
) -> None:
    """Full refresh of a table.

    ``sort_by`` clusters rows inside every file, so that Parquet min-max
    statistics skip row groups on those columns; ``partition_by`` is for columns
    of few values.
    """
    _laid_out(df, partition_by, sort_by).saveAsTable(name)


def write_folder(
    df: DataFrame, path: str, partition_by: list[str] | None = None, sort_by: list[str] | None = None,
    only_these: bool = False,
) -> None:
    """The same for a folder of files.

    With ``only_these`` the partitions that ``df`` has rows of are replaced and all others
    stay (dynamic partition overwrite).
    """
    if only_these and not partition_by:
        raise ValueError("only_these needs partition_by")
    writer = _laid_out(df, partition_by, sort_by)
    writer.option("partitionOverwriteMode", "dynamic" if only_these else "static").parquet(path)


def files_scanned(df: DataFrame) -> int:
    """Files that the scans of a plan without shuffles read, after partitions were pruned; runs the plan."""
    executed = df._jdf.queryExecution()
    executed.toRdd().count()
    leaves, total = executed.executedPlan().collectLeaves(), 0
    for i in range(leaves.size()):
        metric = leaves.apply(i).metrics().get("numFiles")
        total += metric.get().value() if metric.isDefined() else 0
    return total


def write_sorted(df: DataFrame, path: str, order: list) -> None:
    """Totally ordered files: ranges of the order, each sorted, in the order of the file names."""
    df.orderBy(*order).write.mode("overwrite").parquet(path)


def file_order(spark: SparkSession, path: str, key) -> DataFrame:
    """A row per file of a sorted folder: ``rows``, first and last ``key``, and neighbours out of order.

    ``inversions`` counts rows whose key is smaller than the one before in their file, and
    whether the file begins below the end of the file before.  Files are bounded by the
    writer's ranges, and their list is short.
    """
    rows = spark.read.parquet(path).select(
        key.alias("key"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"))
    before = F.lag("key").over(Window.partitionBy("file").orderBy("at"))
    files = rows.withColumn("before", before).groupBy("file").agg(
        F.count("*").alias("rows"), F.min_by("key", "at").alias("first_key"), F.max_by("key", "at").alias("last_key"),
        F.count_if(F.col("key") < F.col("before")).alias("inside"))
    end = F.lag("last_key").over(Window.orderBy("file"))
    across = F.coalesce((F.col("first_key") < end).cast("bigint"), F.lit(0))
    return files.select("file", "rows", "first_key", "last_key", (F.col("inside") + across).alias("inversions"))


def write_staging(df: DataFrame, name: str) -> None:
    """Cleaned reviews laid out for filters on bank, date and rating source."""
    write_replace(df, name, ["rating_source"], ["bank_name", "review_date"])


def write_json_records(df: DataFrame, path: str) -> None:
    """JSON Lines in UTF-8, nulls kept, one file per partition."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def normalise_date_text(df: DataFrame, column: str = "review_date") -> DataFrame:
    return df.withColumn(column, date_text(column))


def materialise(df: DataFrame, name: str, kind: str = "table") -> None:
    """Publish a result under a name: a Parquet ``table`` or a session ``view``."""
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif kind == "table":
        write_replace(df, name)
    else:
        raise ValueError("kind must be table or view")


def append_batches(*batches: DataFrame) -> DataFrame:
    """Review batches one after another, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)


def append_to(df: DataFrame, name: str) -> None:
    df.write.mode("append").format("parquet").saveAsTable(name)
