"""Streaming versions of review intake and alerts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.alerts import negative_spike_alert
from ..operators.dedup import dedup_reviews, preference, review_key
from ..sources.scratch import write_once


def read_review_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json",
    files_per_batch: int | None = None, glob: str | None = None,
) -> DataFrame:
    """New files of a folder as a stream."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


# --- the review store: rows and, beside them, their keys, both in folders by batch and key bucket ---

BUCKETS = 64
KEY = "key_hash string, rank struct<rated: int, bank_rated: int, stars: int>, digest string"


def _bucket(buckets: int) -> Column:
    return F.pmod(F.conv(F.substring("key_hash", 1, 8), 16, 10).cast("bigint"), F.lit(buckets)).cast("int")


def _keyed(reviews: DataFrame, buckets: int) -> DataFrame:
    """Reviews with what the store knows of a row besides its columns, all of fixed size.

    ``rank`` is the beginning of the rule's preference, ``digest`` stands for the rest.
    """
    rest = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in (
        "bank_rating", "bank_location", "bank_name", "branch_name", "review_text")]
    first = preference()
    rank = F.struct(first["p0"].alias("rated"), first["p1"].alias("bank_rated"), F.col("review_rating").cast("int").alias("stars"))
    return reviews.withColumns({
        "key_hash": review_key(), "rank": rank, "digest": F.sha2(F.concat_ws("\u0001", *rest), 256),
    }).withColumn("bucket", _bucket(buckets))


def held_keys(spark: SparkSession, store: str, facts: T.StructType, buckets: list[int], before: int) -> DataFrame:
    """``key_hash, rank, digest, facts`` of the rows that hold their key, in some buckets.

    Only key files of these buckets are read, no texts.  Of a key the last batch holds it,
    because a row is stored only if the rule prefers it to the one before.
    """
    keys = _read(spark, f"{store}-keys", _key_schema(facts)).filter(
        F.col("bucket").isin(buckets) & (F.col("batch_id") < before))
    return keys.groupBy("key_hash").agg(F.max_by(F.struct("rank", "digest", "facts"), "batch_id").alias("h")).select(
        "key_hash", "h.rank", "h.digest", "h.facts")


def _key_schema(facts: T.StructType) -> T.StructType:
    fields = T.StructType.fromDDL(KEY).fields
    return T.StructType([*fields, T.StructField("facts", facts)])


def _preferred(new: DataFrame, held: DataFrame, store: str, batch_id: int) -> DataFrame:
    """The keys of ``new`` whose row the rule prefers, with ``old``: the facts of the row that held the key.

    Ranks and digests decide nearly always; the texts of stored rows are read only for keys
    whose two rows have one rank and different digests.
    """
    narrow = new.select("key_hash", "bucket", F.col("rank").alias("new_rank"), F.col("digest").alias("new_digest"))
    met = write_once(narrow.join(held, "key_hash", "left"), "met_keys")
    clear = met.filter(F.col("digest").isNull() | (F.col("new_rank") < F.col("rank")))
    ties = met.filter((F.col("new_rank") == F.col("rank")) & (F.col("new_digest") != F.col("digest")))
    where = [r["bucket"] for r in ties.select("bucket").distinct().collect()]  # at most the number of buckets
    keys = clear.select("key_hash", F.col("facts").alias("old"))
    if where:
        columns = T.StructType([f for f in new.schema if f.name not in ("bucket",)])
        rows = _read(new.sparkSession, store, columns).filter(F.col("bucket").isin(where) & (F.col("batch_id") < batch_id))
        stored = rows.join(ties.select("key_hash", "digest", "facts"), ["key_hash", "digest"]).select(
            "key_hash", preference().alias("held"), F.col("facts").alias("old"))
        wins = new.select("key_hash", preference().alias("mine")).join(stored, "key_hash").filter(F.col("mine") < F.col("held"))
        keys = keys.unionByName(wins.select("key_hash", "old").dropDuplicates(["key_hash"]))
    return keys


def incremental_reviews(
    reviews: DataFrame, store: str, checkpoint: str, buckets: int = BUCKETS,
    describe: Callable[[DataFrame], DataFrame] | None = None, after: Callable[[SparkSession, int], None] | None = None,
) -> StreamingQuery:
    """Take in new reviews, whatever their dates; ``stored_reviews(store)`` is then the batch result.

    Every micro-batch is de-duplicated by the batch rule, and of the rest those rows are
    stored that the rule prefers to what holds their key.  Keys are hashed to ``buckets``
    folders, and a batch reads the keys of its own buckets only.  A replayed batch writes its
    own folders again.

    ``describe`` turns accepted reviews (their columns and ``key_hash``) into at most one
    row of facts per ``key_hash``.  Facts are stored with the keys, and the change of every
    batch is written as counts per combination of facts: what is new adds, what it replaces
    is taken off.  ``combinations(store)`` adds them up.  ``after(spark, batch_id)`` runs at
    the end of every batch.
    """

    shape: list[T.StructType] = []  # of the facts, once for the stream

    def take_in(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        new = write_once(_keyed(dedup_reviews(batch), buckets), "new_reviews")
        own = [r["bucket"] for r in new.select("bucket").distinct().collect()]  # at most ``buckets``
        if not shape:
            shape.append(_facts_of(describe, new).schema)
        held = held_keys(spark, store, shape[0], own, batch_id)
        keys = write_once(_preferred(new, held, store, batch_id), "accepted_keys")
        _write_batch(new.join(keys.select("key_hash"), "key_hash").select(*new.columns), store, batch_id)
        # texts have moved to their buckets; everything else reads them there
        accepted = _read(spark, store, new.schema).filter(F.col("batch_id") == batch_id).select(*new.columns)
        facts = write_once(_facts_of(describe, accepted, keyed=True), "facts")
        _write_batch(accepted.select("key_hash", "rank", "digest", "bucket").join(facts, "key_hash", "left").select(
            "key_hash", "rank", "digest", "facts", "bucket"), f"{store}-keys", batch_id)
        if describe is not None:
            change = facts.select("facts", F.lit(1).alias("n")).unionByName(
                keys.filter("old IS NOT NULL").select(F.col("old").alias("facts"), F.lit(-1).alias("n")))
            change = change.filter("facts IS NOT NULL").groupBy("facts").agg(F.sum("n").alias("n"))
            change.filter("n <> 0").select("facts.*", "n").write.mode("overwrite").parquet(f"{store}-changes/batch_id={batch_id}")
        if after is not None:
            after(spark, batch_id)

    return refresh_stream(reviews, take_in, checkpoint)


def _facts_of(describe: Callable[[DataFrame], DataFrame] | None, rows: DataFrame, keyed: bool = False) -> DataFrame:
    """``key_hash, facts`` of rows, or only the columns of the facts."""
    found = rows.select("key_hash", F.lit(0).alias("none")) if describe is None else describe(rows.drop("rank", "digest", "bucket"))
    names = [c for c in found.columns if c != "key_hash"]
    return found.select("key_hash", F.struct(*names).alias("facts")) if keyed else found.select(*names)


def _write_batch(rows: DataFrame, folder: str, batch_id: int) -> None:
    """One file per bucket; buckets are of one size, because keys are hashes."""
    rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/batch_id={batch_id}")


def _read(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    parts = T.StructType([T.StructField("batch_id", T.LongType()), T.StructField("bucket", T.IntegerType())])
    schema = T.StructType([f for f in schema if f.name not in parts.names] + parts.fields)
    return spark.read.schema(schema).option("basePath", folder).option("ignoreMissingFiles", True).parquet(folder) if _exists(
        spark, folder) else spark.createDataFrame([], schema)


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    except AnalysisException:
        return False
    return True


def stored_reviews(spark: SparkSession, store: str, schema: T.StructType) -> DataFrame:
    """One row per review of a store, with the columns of ``schema``: the same as ``dedup_reviews`` over all files."""
    return dedup_reviews(_read(spark, store, schema).drop("batch_id", "bucket"))


def combinations(spark: SparkSession, store: str) -> DataFrame:
    """Facts of all stored reviews with ``n``, the number of reviews that have them."""
    changes = spark.read.option("basePath", f"{store}-changes").parquet(f"{store}-changes")
    names = [c for c in changes.columns if c not in ("n", "batch_id")]
    return changes.groupBy(*names).agg(F.sum("n").alias("n")).filter("n <> 0")


def alert_stream(
    reviews: DataFrame, ts: str, negative: Column, delay: str = "1 day", **options
) -> DataFrame:
    """``negative_spike_alert`` over a stream; write it in update mode."""
    return negative_spike_alert(reviews.withWatermark(ts, delay), ts, negative, **options)


def write_stream(
    df: DataFrame, path: str, checkpoint: str, mode: str = "append", available_now: bool = True
) -> StreamingQuery:
    """Append a stream to Parquet files, exactly once."""
    writer = df.writeStream.format("parquet").outputMode(mode).option("path", path)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def refresh_stream(
    df: DataFrame, refresh: Callable[[DataFrame, int], None], checkpoint: str,
    mode: str = "append", available_now: bool = True,
) -> StreamingQuery:
    """Hand every micro-batch to ``refresh(batch, batch_id)``.

    A batch may be replayed after a failure: write by ``batch_id``.
    """
    writer = df.writeStream.outputMode(mode).foreachBatch(refresh)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
