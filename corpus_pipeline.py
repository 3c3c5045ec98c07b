"""Corpus pipeline over ``documents``: each stage works on all that the one before kept.

Stages return the columns of their input; the last returns the packed pieces.  ids are taken as
those of documents: rows of one doc_id are kept or dropped together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.llm import jaccard_join, language_id, line_dedup, packing, tokens, winnowing, wordcache
from opinara.sources.scratch import new_folder

#: The model of the first stage cannot be expressed in SQL.
ORACLE_SQL = None


def _whole(docs: DataFrame) -> Column:
    """All columns as one, so that none clashes with what an operator adds."""
    return F.struct(*(docs[c] for c in docs.columns)).alias("row")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter go, and those of no learnt language (a posterior under one half)."""
    model = language_id.learn(docs.filter(wordcache.remainder("doc_id", 4) != 2), tokens.path())
    # names that clash with nothing; the text goes through Python once
    names = {c: "text" if c == "text" else f"column_{i}" for i, c in enumerate(docs.columns)}
    found = language_id.predict(docs.select(*(docs[c].alias(n) for c, n in names.items())), model, tokens.path(), keep_text=True)
    kept = found.filter((F.col("lang_pred") != "und") & (F.col("score") >= 0.5))
    return kept.select(*(kept[n].alias(c) for c, n in names.items()))


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that an earlier document has are deleted; texts that lose all their lines go."""
    out = line_dedup.remove_repeated(docs.select("doc_id", "text", _whole(docs)), min_words=50)
    out = out.filter((F.col("lines_removed") == 0) | (F.col("lines_removed") < F.col("lines")))
    columns = {c: F.col("row")[c] for c in docs.columns} | {"text": F.col("text")}
    if "n_chars" in columns:
        changed = F.when(F.col("lines_removed") > 0, F.length("text")).otherwise(columns["n_chars"])
        columns["n_chars"] = changed.cast(docs.schema["n_chars"].dataType)
    return out.select(*(x.alias(c) for c, x in columns.items()))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a Jaccard similarity of 0.8, the one of the smallest doc_id stays."""
    groups = jaccard_join.similar_groups(docs, size=5, percent=80)
    gone = groups.filter(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("gone"))
    gone = gone.distinct()
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["gone"]), "left_anti")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth of their words in passages of the benchmark go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = winnowing.contamination(docs, benchmark).filter(winnowing.contaminated()).select(F.col("doc_id").alias("gone")).distinct()
    return docs.join(found, docs["doc_id"].eqNullSafe(found["gone"]), "left_anti")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.best_fit(docs, tokens.path(), end_id=0, capacity=2048)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", remove_repeated_passages),
    ("ngram_jaccard", one_of_each_group),
    ("decontamination", decontaminate),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = new_folder(spark, f"pipeline_{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
