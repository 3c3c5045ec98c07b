import itertools
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from helpers import plan, values
from opinara.plans import marts, reports, staging
from opinara.plans.catalog import QUERIES, enriched
from opinara.plans.enrichment import enrich
from opinara.schemas import CLEANED, REVIEW


def raw(spark, rows):
    return spark.createDataFrame(rows, REVIEW)


@pytest.fixture(scope="module")
def small(spark):
    text = "accueil agréable rapide conseiller aimable {}"
    rows = [("A", "A - x, Rabat", "4,0", "x, Rabat", "2024-01-0%d" % (i + 1), text.format("abcd"[i]), r)
            for i, r in enumerate([5, 4, 9, None])]
    rows += [("B", "B - y, Casa", "9,9", "y, Casa", "2024-02-01", text.format("e"), None),
             ("B", "B - y, Casa", "bad", "y, Casa", "2024-02-02", text.format("f"), 0),
             (None, "C", None, None, "2024-02-02", text.format("g"), 3),
             ("A", "A - x, Rabat", None, "x, Rabat", None, text.format("h"), 1),
             ("A", "A - x, Rabat", None, "x, Rabat", "2024-01-09", "pas non jamais mais", 3),
             ("A", "A - x, Rabat", None, "x, Rabat", "2024-01-09", "!!", 3),
             ("A", "A - x, Rabat", None, "x, Rabat", "2024-01-09", "مرحبا بكم", 3),
             (" A ", "A - x, Rabat", None, "x, Rabat", "2024-01-01", text.format("a").upper(), None)]
    return raw(spark, rows)


class TestStaging:
    def test_schema(self, spark, small):
        assert [(f.name, f.dataType) for f in staging.staging(small).schema] == [
            (f.name, f.dataType) for f in CLEANED]

    def test_rows_and_provenance(self, spark, small):
        out = staging.staging(small)
        got = values(out, "bank_name", "review_date", "review_rating", "rating_source", "bank_rating")
        got = [(b, str(d), r, s, br) for b, d, r, s, br in got]
        # A is rated 5, 4, 5 (clamped), 1 (undated), and 3 on the row of stop words.
        # B has one rating, so its own average does not count and the global one does:
        # 5 4 5 1 3 of A, 1 of B, and 3 of the nameless bank.
        overall = round((5 + 4 + 5 + 1 + 3 + 1 + 3) / 7, 1)
        assert got == [
            ("A", "2024-01-01", 5.0, "ORIGINAL", 4.0), ("A", "2024-01-02", 4.0, "ORIGINAL", 4.0),
            ("A", "2024-01-03", 5.0, "ORIGINAL", 4.0), ("A", "2024-01-04", 3.6, "BANK_AVERAGE", 4.0),
            ("B", "2024-02-01", overall, "GLOBAL_AVERAGE", 4.0), ("B", "2024-02-02", 1.0, "ORIGINAL", 4.0),
        ]

    def test_arabic_reviews_stay_when_asked_for(self, spark, small):
        out = staging.staging(small, scripts=("latin", "arabic"))
        assert out.filter(F.col("final_text") == "مرحبا بكم").count() == 1

    def test_rating_stays_in_range_on_test_data(self, spark, sf_dir):
        out = QUERIES["staging_reviews_cleaned"](spark, sf_dir)
        assert out.filter("review_rating < 1 OR review_rating > 5 OR review_rating IS NULL").isEmpty()
        assert out.filter("bank_rating < 0 OR bank_rating IS NULL").isEmpty()

    def test_no_cartesian_product(self, spark, small):
        assert "CartesianProduct" not in plan(staging.staging(small))

    def test_keep_informative(self, spark):
        df = raw(spark, [("a", "b", None, "l", None, t, r) for t, r in
                         [("x", None), (None, 3), (None, 0), ("", None), ("", 2), ("y", 0)]])
        assert values(staging.keep_informative(df), "review_text", "review_rating") == [
            ("", 2), ("x", None), ("y", None), (None, 3)]

    def test_presentation_order(self, spark):
        rows = [(None, 90.0, "2024-01-01", "a"), (3, 80.0, "2024-01-01", "b"), (3, 95.0, "2024-01-01", "c"),
                (3, 95.0, "2024-01-02", "d")]
        df = spark.createDataFrame(rows, "review_rating_clean int, retention_percentage double, review_date string, bank_name string")
        got = [r["bank_name"] for r in df.orderBy(*staging.presentation_order(df)).collect()]
        assert got == ["d", "c", "b", "a"]


@pytest.fixture(scope="module")
def reviews(spark):
    """Enriched reviews whose dimension keys are coarser than the dimension rows."""
    rows = []
    banks, places = ["A", "B"], ["1, Rabat", "2, Rabat", "3, Fès"]
    for i, (bank, place, k) in enumerate(itertools.product(banks, places, range(4))):
        label, score = [("positive", 0.5), ("negative", -0.4), ("neutral", 0.0), ("positive", 0.9)][k]
        branch = "Shared" if k == 0 else f"{bank} - {place}"
        rows.append((f"id{i}", bank, branch, place, f"20{20 + k % 2}-0{1 + i % 3}-1{k % 2}", "texte", "fr",
                     float(1 + (i * 7) % 5), label, score, ["T1", "T2"][i % 2], round(0.5 + (i % 3) / 10, 4)))
    rows.append(("nowhere", "A", "A - ?", None, "2020-01-10", "texte", "fr", 3.0, "neutral", 0.0, "T1", 0.5))
    schema = ("id string, bank_name string, branch_name string, bank_location string, review_date string, "
              "final_text string, language string, review_rating double, sentiment string, "
              "sentiment_score double, topic_name string, topic_confidence double")
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def star(reviews):
    return marts.build_star(reviews)


def joined(star, names, grain_safe):
    """The reports' joins done row by row in Python."""
    attributes = {
        "bank": ["bank_name"], "branch": ["branch_name"], "location": ["city", "region"],
        "sentiment": ["sentiment", "sentiment_score"], "topic": ["topic_name"],
        "date": ["full_date", "day", "month", "year"],
    }
    rows = [r.asDict() for r in star.fact.collect()]
    for name in names:
        table = defaultdict(list)
        for r in getattr(star, name).collect():
            table[r[f"{name}_id"]].append({a: r[a] for a in attributes[name]})
        if grain_safe:
            table = {k: v[:1] for k, v in table.items()}
        rows = [{**r, **d} for r in rows for d in table.get(r[f"{name}_id"], [])]
    return rows


class TestMarts:
    def test_dimension_grains(self, star):
        assert star.bank.count() == 2
        assert star.location.count() == 4 and star.location.select("location_id").distinct().count() == 3
        assert star.branch.count() == 9 and star.branch.select("branch_id").distinct().count() == 8
        assert star.topic.count() == 6 and star.topic.select("topic_id").distinct().count() == 2

    def test_fact_drops_reviews_without_address(self, star, reviews):
        assert star.fact.count() == reviews.count() - 1

    def test_fact_equals_the_lookup_join(self, reviews):
        dim = marts.dim_location(reviews).select("bank_location", "location_id")
        want = reviews.join(dim, "bank_location").select(F.col("id"), "location_id")
        assert values(marts.fact_reviews(reviews), "review_id", "location_id") == values(want)

    def test_fact_needs_no_shuffle(self, reviews):
        assert "Exchange" not in plan(marts.fact_reviews(reviews))

    def test_keys_meet(self, star):
        for name in ("bank", "branch", "location", "sentiment", "topic", "date"):
            keys = getattr(star, name).select(f"{name}_id").distinct()
            assert star.fact.join(keys, f"{name}_id", "left_anti").isEmpty(), name

    def test_date_parts(self, star):
        assert star.date.filter("day <> day(full_date) OR month <> month(full_date) OR year <> year(full_date)").isEmpty()


@pytest.mark.parametrize("safe", [True, False])
class TestReports:
    def test_branch_performance(self, star, safe):
        groups = defaultdict(list)
        for r in joined(star, ["bank", "branch", "location", "sentiment"], safe):
            groups[r["bank_name"], r["branch_name"], r["city"], r["region"]].append(r)
        want = {}
        for key, rows in groups.items():
            n = len(rows)
            avg = sum(r["review_rating"] for r in rows) / n
            pos = sum(r["sentiment"] == "positive" for r in rows) / n * 100
            want[key] = (n, avg, sum(r["sentiment_score"] for r in rows) / n, pos,
                         sum(r["review_rating"] >= 4 for r in rows) / n * 100, avg * 0.6 + pos * 0.4)
        got = reports.branch_performance(star, safe).collect()
        assert len(got) == len(want)
        for r in got:
            key = tuple(r[c] for c in ("bank_name", "branch_name", "city", "region"))
            mine = [r[c] for c in ("total_reviews", "avg_rating", "avg_sentiment", "positive_percentage",
                                   "promoter_percentage", "performance_score")]
            assert mine == pytest.approx(want[key])
            assert r["overall_rank"] == 1 + sum(w[5] > want[key][5] + 1e-9 for w in want.values())
            assert r["regional_rank"] == 1 + sum(
                w[1] > want[key][1] + 1e-9 for k, w in want.items() if k[3] == key[3])

    def test_sentiment_trends(self, star, safe):
        want = Counter(
            (r["bank_name"], r["branch_name"], r["full_date"], r["month"], r["year"], r["sentiment"])
            for r in joined(star, ["bank", "branch", "sentiment", "date"], safe))
        got = reports.sentiment_trends(star, safe)
        assert {tuple(r)[:6]: r["review_count"] for r in got.collect()} == dict(want)
        assert got.filter("positive_percentage NOT IN (0, 100)").isEmpty()

    def test_topic_analysis(self, star, safe):
        want = Counter((r["topic_name"], r["sentiment"]) for r in joined(star, ["topic", "sentiment"], safe))
        got = reports.topic_analysis(star, safe).collect()
        assert {(r["topic_name"], r["sentiment"]): r["occurrence_count"] for r in got} == dict(want)
        shares = defaultdict(float)
        for r in got:
            shares[r["topic_name"]] += r["sentiment_distribution"]
            rank = 1 + sum(n > r["occurrence_count"] for n in want.values())
            assert r["positive_rank"] == (rank if r["sentiment"] == "positive" else None)
            assert r["negative_rank"] == (rank if r["sentiment"] == "negative" else None)
        assert all(s == pytest.approx(100) for s in shares.values())

    def test_customer_experience(self, star, safe):
        groups = defaultdict(list)
        for r in joined(star, ["date", "topic", "sentiment"], safe):
            groups[r["day"], r["month"]].append(r)
        got = reports.customer_experience(star, safe).collect()
        assert len(got) == len(groups)
        for r in got:
            rows = groups[r["day"], r["month"]]
            x, y = [q["review_rating"] for q in rows], [q["sentiment_score"] for q in rows]
            n = len(rows)
            assert r["avg_rating"] == pytest.approx(sum(x) / n)
            mx, my = sum(x) / n, sum(y) / n
            sxy = sum((a - mx) * (b - my) for a, b in zip(x, y))
            sx, sy = sum((a - mx) ** 2 for a in x), sum((b - my) ** 2 for b in y)
            if min(sx, sy) < 1e-12:
                assert r["rating_sentiment_correlation"] is None
            else:
                assert r["rating_sentiment_correlation"] == pytest.approx(sxy / (sx * sy) ** 0.5)
            for label, col in (("negative", "critical_topics"), ("positive", "positive_topics")):
                names = sorted({q["topic_name"] for q in rows if q["sentiment"] == label})
                assert r[col] == (", ".join(names) or None)


class TestSimpleReports:
    def test_counts_add_up(self, star):
        n = star.fact.count()
        for report in (reports.reviews_by_sentiment_over_time, reports.sentiment_by_topic,
                       reports.sentiment_by_bank, reports.topic_share, reports.branch_ranking_in_bank):
            assert report(star).agg(F.sum("review_count")).first()[0] == n, report.__name__

    def test_as_of(self, star):
        early = reports.sentiment_by_bank(star, "2020-12-31").agg(F.sum("review_count")).first()[0]
        assert 0 < early < star.fact.count()

    def test_pivot(self, star):
        got = reports.volume_by_topic_sentiment(star)
        assert got.columns == ["topic_name", "positive", "neutral", "negative", "unknown"]
        assert got.select(F.sum(F.expr("positive + neutral + negative + unknown"))).first()[0] == star.fact.count()

    def test_shares(self, star):
        assert reports.topic_share(star).agg(F.sum("share_pct")).first()[0] == pytest.approx(100)


def test_enrichment_is_one_stage(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.col("text").alias("final_text"))
    out = enrich(docs)
    assert {"language", "sentiment", "sentiment_score"} <= set(out.columns)
    assert "Exchange" not in plan(out)


def test_literal_reports_count_more_than_grain_safe_ones(spark, sf_dir):
    star = marts.build_star(enriched(spark, sf_dir))
    safe = reports.branch_metrics(star, True).agg(F.sum("total_reviews")).first()[0]
    literal = reports.branch_metrics(star, False).agg(F.sum("total_reviews")).first()[0]
    assert safe == star.fact.count() < literal
