import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

from . import test_jaccard_join, test_winnowing


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents in two languages with copies, passages, benchmark text and junk, and extra columns."""
    rng = random.Random(7)
    vocabulary = {"en": ["the", "thing", "weather", "other", "with", "there"], "de": ["der", "schule", "nicht", "über", "zwischen", "auch"]}
    sentence = lambda lang: " ".join(rng.choice(vocabulary[lang]) + rng.choice(["", "a", "er", "en"]) for _ in range(14)) + "."
    items = [(i, " ".join(sentence("en") for _ in range(3))) for i in range(4)]
    passage = "\n".join(sentence("de") for _ in range(6))
    rows = []
    for i in range(80):
        lang = rng.choice(["en", "de"])
        text = "\n".join(sentence(lang) for _ in range(rng.randint(4, 9)))
        if i % 10 == 3:
            text += "\n" + passage
        if i % 10 == 4:
            text += "\n" + items[i % 4][1]
        if i % 10 == 5 and i > 20:
            text = rows[i - 13][1].replace("there", "here", 1)
        if i % 20 == 6:
            text = rng.choice(["12 34 !!", "", None])
        rows.append((i, text, lang, "src0", len(text or ""), "x", 1))
    path = tmp_path_factory.mktemp("tables")
    ddl = "doc_id long, text string, lang string, source string, n_chars long, gone string, score int"
    spark.createDataFrame(rows, ddl).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_every_stage(spark, folder, tmp_path):
    docs, texts = spark.read.parquet(f"{folder}/documents.parquet"), {}
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        out = stage(spark, docs, folder)
        if name != "packing":
            assert out.schema.simpleString() == docs.schema.simpleString()
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = {r["doc_id"]: r["text"] for r in docs.collect()} if name != "packing" else {}
        if name == "language_id":
            assert set(before) - set(after) == {d for d, t in before.items() if not any(c.isalpha() for c in t or "")}
        if name == "line_dedup":
            assert any(len(after[d]) < len(before[d]) for d in after) and set(after) < set(before)
            first = min(d for d in before if d % 10 == 3)
            assert after[first] == before[first]
            assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
        if name == "ngram_jaccard":
            want = {c for _, _, c in test_jaccard_join.brute_force(list(before.items()))}
            assert set(after) == want
        if name == "decontamination":
            found = {d: test_winnowing.brute_force(t, items) for d, t in before.items()}
            assert set(before) - set(after) == {d for d, (n, hit, _) in found.items() if hit and 20 * hit >= n} != set()
        texts = after or texts
    assert {r["doc_id"] for r in docs.collect()} == set(texts)
    assert docs.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).filter("n <> end or n > 2048").isEmpty()


def test_run_is_the_stages(spark, folder):
    ids = {r["doc_id"] for r in corpus_pipeline.run(spark, folder).collect()}
    assert 30 < len(ids) < 80


def test_no_documents(spark, folder, tmp_path):
    for table in ("documents", "benchmark"):
        spark.read.parquet(f"{folder}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
