from pyspark.sql import functions as F

from helpers import plan, values
from opinara.operators.dedup import dedup_reviews
from opinara.plans.staging import early_filter
from opinara.schemas import REVIEW
from opinara.sources.reviews import reviews_from_documents
from opinara.streaming import incremental


def rows(spark, spec):
    data = [("cih", "a", None, "x, Rabat", day, text, 3) for day, text in spec]
    return spark.createDataFrame(data, REVIEW)


def take_in(spark, inbox, store, state):
    stream = incremental.read_review_stream(spark, f"{inbox}/*.json", REVIEW, files_per_batch=1)
    incremental.incremental_reviews(stream, store, state).awaitTermination()
    return incremental.stored_reviews(spark, store, REVIEW)


def test_old_undated_and_rated_reviews_are_kept(spark, tmp_path):
    inbox, store, state = (str(tmp_path / x) for x in ("in", "store", "state"))
    files = [
        [("2024-06-05", "Bon service", None), ("2024-06-06", "lent", 2)],
        [("2021-03-01", "vieux", 3), (None, "sans date", 4)],
        [("2024-06-05", " BON service", 5), ("2023-01-01", "parfait", 5), (None, "sans date", None)],
        [("2024-06-05", "bon service", None), ("2024-06-06", "lent", 2)],
    ]
    every = None
    for i, spec in enumerate(files):
        data = [("cih", "a", None, "x, Rabat", day, text, stars) for day, text, stars in spec]
        new = spark.createDataFrame(data, REVIEW).coalesce(1)
        new.write.mode("append").json(inbox)
        every = new if every is None else every.union(new)
        got = take_in(spark, inbox, store, state)
        assert values(got) == values(dedup_reviews(every))
    assert got.count() == 5
    assert got.filter("review_rating = 5 AND review_date = '2024-06-05'").count() == 1
    stored = spark.read.option("basePath", store).parquet(store)
    assert stored.filter("batch_id = 3").count() == 0  # nothing in the last file is preferred


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    inbox, store = str(tmp_path / "in"), str(tmp_path / "store")
    rows(spark, [("2024-01-05", "Bon service"), ("2024-01-06", "lent")]).write.json(inbox)
    first = values(take_in(spark, inbox, store, str(tmp_path / "state")))
    assert values(take_in(spark, inbox, store, str(tmp_path / "lost_state"))) == first


def test_facts_come_from_the_stored_rows(spark, tmp_path):
    """Accepted texts are joined and moved once; what describes them reads the store."""
    inbox, store, state = (str(tmp_path / x) for x in ("in", "store", "state"))
    plans = []

    def describe(reviews):
        plans.append(plan(reviews))
        return reviews.select("key_hash", F.length("review_text").alias("size"))

    for spec in ([("2024-01-05", "Bon service"), ("2024-01-06", "lent")], [("2024-01-05", "Bon service"), ("2024-01-07", "vite")]):
        rows(spark, spec).coalesce(1).write.mode("append").json(inbox)
        stream = incremental.read_review_stream(spark, f"{inbox}/*.json", REVIEW, files_per_batch=1)
        incremental.incremental_reviews(stream, store, state, describe=describe).awaitTermination()
    assert plans and not any("Join" in p or "Exchange" in p for p in plans)
    assert values(incremental.combinations(spark, store), "size", "n") == [(11, 1), (4, 2)]


def test_stream_equals_the_batch(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stream = incremental.read_review_stream(spark, sf_dir, docs.schema, "parquet", glob="documents.parquet")
    live, store = early_filter(reviews_from_documents(stream)), str(tmp_path / "store")
    incremental.incremental_reviews(live, store, str(tmp_path / "state")).awaitTermination()
    got = incremental.stored_reviews(spark, store, live.schema)
    assert values(got) == values(dedup_reviews(early_filter(reviews_from_documents(docs))))


def test_alert_stream_updates_windows(spark, tmp_path):
    inbox = str(tmp_path / "in")
    schema = "ts timestamp, s string"
    spark.sql("SELECT timestamp'2024-01-01 08:00:00' ts, 'n' s").write.mode("append").json(inbox)
    stream = spark.readStream.schema(schema).json(inbox)
    alerts = incremental.alert_stream(stream, "ts", F.col("s") == "n", min_share=0.5, min_count=2)
    seen = []

    def refresh(batch, batch_id):
        seen.extend((r["review_count"], r["negative_share"]) for r in batch.collect())

    state = str(tmp_path / "state")
    incremental.refresh_stream(alerts, refresh, state, mode="update").awaitTermination()
    assert seen == []
    spark.sql("SELECT timestamp'2024-01-01 09:00:00' ts, 'p' s").write.mode("append").json(inbox)
    incremental.refresh_stream(alerts, refresh, state, mode="update").awaitTermination()
    assert seen == [(2, 0.5)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_batch_reads_its_own_buckets_and_no_text(spark, tmp_path):
    inbox, store, state = (str(tmp_path / x) for x in ("in", "store", "state"))
    stream = incremental.read_review_stream(spark, f"{inbox}/*.json", REVIEW)
    for day in range(2):
        rows(spark, [(f"2024-01-{day + 1:02d}", f"text {i}") for i in range(40)]).write.mode("append").json(inbox)
        incremental.incremental_reviews(stream, store, state, buckets=8).awaitTermination()
    facts = incremental._facts_of(None, incremental._keyed(rows(spark, [("2024-01-01", "x")]), 8)).schema
    held = incremental.held_keys(spark, store, facts, [3], 9)
    want = [f for f in spark.read.parquet(f"{store}-keys").inputFiles() if "bucket=3/" in f]
    plan = plan_of(held)
    assert "PartitionFilters: [bucket" in plan.replace("isnotnull(bucket#", "[bucket") or "bucket" in plan.split("PartitionFilters")[1][:200]
    assert "review_text" not in plan and "bank_location" not in plan
    assert 0 < held.count() < 80 and 0 < len(want)
    from opinara.sources.tables import files_scanned
    keys = incremental._read(spark, f"{store}-keys", incremental._key_schema(facts))
    assert files_scanned(keys.filter("bucket = 3").select("key_hash")) == len(want) < files_scanned(keys.select("key_hash"))


def test_counts_follow_replaced_rows(spark, tmp_path):
    """Facts of a replaced row are taken off; equal ranks are settled by the rule, texts and all."""
    inbox, store, state = (str(tmp_path / x) for x in ("in", "store", "state"))
    stream = incremental.read_review_stream(spark, f"{inbox}/*.json", REVIEW)
    files = [
        [("4,0", "x, Rabat", "Bon service", None), (None, "x, Rabat", "lent", 2), ("1,0", "z, Fes", "egal", 3)],
        [("3,0", "x, Rabat", "bon service ", 4), (None, "a, Rabat", "LENT", 2), ("1,0", "b, Fes", "egal", 3)],
        [(None, "x, Rabat", "bon SERVICE", 4), ("5,0", "q, Rabat", "lent", 2), ("1,0", "b, Fes", "Egal", 3)],
        [("4,0", "x, Rabat", "Bon service", None), ("5,0", "q, Rabat", "lent", 2)],
    ]
    describe = lambda df: df.select("key_hash", "bank_location", "review_rating", "review_text")
    every = None
    for spec in files:
        new = spark.createDataFrame([("cih", "a", b, place, "2024-01-01", t, s) for b, place, t, s in spec], REVIEW).coalesce(1)
        new.write.mode("append").json(inbox)
        every = new if every is None else every.union(new)
        incremental.incremental_reviews(stream, store, state, buckets=4, describe=describe).awaitTermination()
        want = dedup_reviews(every)
        assert values(incremental.stored_reviews(spark, store, REVIEW)) == values(want)
        counted = incremental.combinations(spark, store)
        assert values(counted, "bank_location", "review_rating", "review_text", "n") == values(
            want.select("bank_location", "review_rating", "review_text", F.lit(1).alias("n")))


def test_live_reports_are_tables_after_every_batch(spark, tmp_path):
    from opinara.plans import live, reports, staging
    from opinara.plans.enrichment import enrich
    from opinara.plans.marts import build_star

    inbox, store, state = (str(tmp_path / x) for x in ("in", "store", "state"))
    classify = lambda df: df.withColumns({
        "topic_name": F.when(F.length("final_text") > 12, "long").otherwise("short"), "topic_confidence": F.lit(0.5)})
    stream = incremental.read_review_stream(spark, f"{inbox}/*.json", REVIEW)
    spark.sql("CREATE DATABASE IF NOT EXISTS opinara_live")
    every = None
    try:
        for day in ("2024-01-01", "2024-01-02"):
            data = [(f"bank{i % 3}", f"b{i % 5}", None, f"{i % 2}, Rabat", day if i % 4 else "2024-01-01", f"très bon service {i % 9}",
                     None if i % 3 == 0 and day.endswith("1") else i % 6) for i in range(40)]
            new = spark.createDataFrame(data, REVIEW)
            new.write.mode("append").json(inbox)
            every = new if every is None else every.union(new)
            live.live_reports(stream, store, state, "opinara_live", classify=classify).awaitTermination()
            star = build_star(classify(enrich(staging.staging(every, processed_at=False))))
            for name in ("branch_performance", "customer_experience", "topic_share"):
                spark.catalog.refreshTable(f"opinara_live.{name}")  # another session wrote it
            for name in ("branch_performance", "customer_experience"):
                want = getattr(reports, name)(star)
                assert values(spark.table(f"opinara_live.{name}")) == values(want)
            assert values(spark.table("opinara_live.topic_share")) == values(reports.topic_share(star))
    finally:
        spark.sql("DROP DATABASE opinara_live CASCADE")
