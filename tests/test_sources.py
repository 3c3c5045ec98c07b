import json

import pytest
from pyspark.sql import functions as F

from helpers import values
from opinara.schemas import ENRICHED
from opinara.sources import pages, scratch, tables
from opinara.sources.search import search_grid

RECORDS = [
    {"bank_name": "CIH", "branch_name": "CIH - 1, Rabat", "bank_rating": "4,5", "bank_location": "1, Rabat",
     "review_date": "2024-01-05", "review_text": "très bien", "review_rating": 5},
    {"bank_name": "BOA", "branch_name": "BOA - 2, Fès", "bank_rating": None, "bank_location": "2, Fès",
     "review_date": None, "review_text": None, "review_rating": 2},
]


def test_reads_a_json_array_and_writes_records(spark, tmp_path):
    source = tmp_path / "in.json"
    source.write_text(json.dumps(RECORDS, ensure_ascii=False, indent=2), encoding="utf-8")
    df = tables.read_reviews(spark, str(source), with_id=True)
    assert df.columns[-1] == "id" and df.select("id").distinct().count() == 2
    tables.write_json_records(df.drop("id"), str(tmp_path / "out"))
    text = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "out").glob("part-*"))
    assert "très bien" in text and '"review_text":null' in text
    again = tables.read_reviews(spark, str(tmp_path / "out"), multi_line=False)
    assert values(again) == values(df.drop("id"))


def test_enriched_needs_its_text_column(spark, tmp_path):
    row = {"id": "1", "final_text": "bon", "language": "fr", "sentiment": "positive", "sentiment_score": 0.5}
    (tmp_path / "e.json").write_text(json.dumps(row), encoding="utf-8")
    df = tables.read_enriched(spark, str(tmp_path / "e.json"))
    assert df.schema == ENRICHED and df.first()["final_text"] == "bon"
    with pytest.raises(ValueError, match="not found"):
        tables.read_enriched(spark, str(tmp_path / "e.json"), text_column="body")


@pytest.fixture
def warehouse(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS opinara_test")
    yield "opinara_test"
    spark.sql("DROP DATABASE opinara_test CASCADE")


def test_tables_and_views(spark, warehouse):
    name = f"{warehouse}.reviews"
    df = spark.createDataFrame([("2024-1-5", "b", "ORIGINAL"), ("bad", "a", "DEFAULT")],
                               "review_date string, bank_name string, rating_source string")
    tables.write_staging(df, name)
    assert values(tables.read_table(spark, name), "review_date", "bank_name") == [("2024-01-05", "b"), (None, "a")]
    tables.write_replace(df.limit(1), name)
    assert tables.read_table(spark, name).count() == 1
    tables.append_to(tables.normalise_date_text(df), name)
    assert tables.read_table(spark, name).count() == 3
    tables.materialise(df, "review_view", "view")
    assert spark.table("review_view").count() == 2
    tables.materialise(df, f"{warehouse}.again")
    assert spark.table(f"{warehouse}.again").count() == 2
    with pytest.raises(ValueError):
        tables.materialise(df, "x", "index")


def test_batches_match_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "n int, t string")
    b = spark.createDataFrame([("y", 2)], "t string, n int")
    assert values(tables.append_batches(a, b)) == [(1, "x"), (2, "y")]


def test_search_grid(spark):
    got = search_grid(spark.createDataFrame([("Rabat",), ("Tata",)], "city string"), ["CIH BANK"])
    assert values(got, "search_query", "search_url")[0] == (
        "CIH BANK agence Rabat Maroc", "https://www.google.com/maps/search/CIH+BANK+agence+Rabat+Maroc")
    assert search_grid(spark.createDataFrame([("Rabat",)], "city string")).count() == 6


PAGE = """<html><body><h1 class="DUwDvf lfPIob"> CIH &amp; Co </h1>
<div class="F7nice"><span><span>4,5</span></span><span>(12)</span></div>
<div class="Io6YTe fontBodyMedium kR99db fdkmkc">12 rue X, Rabat</div>
<div class="jftiEf fontBodyMedium"><span class="rsqaWe">il y a 2 mois</span>
  <span class="elGi1d">*</span><span class="elGi1d">*</span><br>
  <span class="wiI7pd">Bon <b>accueil</b></span></div>
<div data-review-id="r2"><span class="DU9Pgb">hier</span><p class="MyEned">Trop lent</div>
<div data-review-id="r3"><span class="rsqaWe">il y a un an</span></div>
</body></html>"""


def test_pages(spark):
    df = spark.createDataFrame(
        [(1, "u1", PAGE), (2, "u2", "<div data-review-id=x><span class=elGi1d></span></div>"), (3, "u3", None)],
        "page_id bigint, url string, html string")
    found = pages.pages_to_reviews(df)
    assert values(found) == [
        (1, "u1", 0, "CIH & Co", "12 rue X, Rabat", "4,5", "il y a 2 mois", "Bon accueil", 2),
        (1, "u1", 1, "CIH & Co", "12 rue X, Rabat", "4,5", "hier", "Trop lent", None),
        (1, "u1", 2, "CIH & Co", "12 rue X, Rabat", "4,5", "il y a un an", None, None),
        (2, "u2", 0, None, None, None, None, None, 1),
    ]
    raw = pages.page_reviews_to_raw(found, "CIH BANK", "Tata", "2024-03-31")
    assert values(raw, "branch_name", "bank_rating", "review_date", "review_text", "review_rating") == [
        ("CIH & Co - 12 rue X, Rabat", "4,5", "2024-01-31", "Bon accueil", 2),
        ("CIH & Co - 12 rue X, Rabat", "4,5", "2024-03-30", "Trop lent", None),
        ("CIH BANK - Tata - Localisation inconnue", None, None, None, 1),
    ]
    assert pages.page_reviews_to_raw(found, "b", "c", "2024-03-31", per_branch=1).count() == 2


def test_selectors_are_checked(spark):
    with pytest.raises(ValueError):
        pages.pages_to_reviews(spark.createDataFrame([(1, "u", "")], "page_id bigint, url string, html string"),
                               pages.Selectors(name=("a > b",)))


def test_written_tables_keep_schema_and_prune(spark):
    df = spark.range(100).withColumn("t", F.lit("x"))
    back = scratch.write_once(df, "test")
    assert back.schema.simpleString() == df.schema.simpleString() and back.count() == 100
    assert "ReadSchema: struct<id:bigint>" in back.select("id")._jdf.queryExecution().executedPlan().toString()


def test_spread_leaves_wide_inputs_alone(spark):
    wide = spark.range(0, 100, 1, 16)
    assert scratch.spread(wide, "id") is wide
    assert scratch.spread(spark.range(0, 100, 1, 1), "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_many_unclosed_tags_take_linear_time(spark):
    import time

    from opinara.sources.pages import _PageReader, _compile

    selectors = {p: [_compile(x)] for p, x in (
        ("name", "h1"), ("address", "h2"), ("rating", "h3"), ("review", "article"), ("date", "b"), ("text", "p"), ("star", "i"))}
    reader = _PageReader(selectors)
    start = time.perf_counter()
    reader.feed("<div>x</em>" * 60_000 + "<article><p>good</p></article>")
    reader.close()
    assert time.perf_counter() - start < 20
    assert [r["text"] for r in reader.reviews] == ["good"]


def test_bank_and_city_of_the_search_are_columns(spark):
    found = pages.pages_to_reviews(
        spark.createDataFrame([(1, "u", "<x>")], "page_id long, url string, html string").limit(0))
    searched = found.withColumns({"bank": F.lit("CIH"), "town": F.lit("Rabat")})
    assert pages.page_reviews_to_raw(searched, F.col("bank"), F.col("town"), "2024-03-31").count() == 0


def test_broken_records_are_kept_aside(spark, tmp_path):
    lines = [json.dumps(RECORDS[0]), "{broken", json.dumps([RECORDS[1], RECORDS[1]]), json.dumps(RECORDS[0] | {"review_rating": "many"}), ""]
    (tmp_path / "in.json").write_text("\n".join(lines), encoding="utf-8")
    good = tables.read_reviews(spark, str(tmp_path / "in.json"), rejected=str(tmp_path / "bad"))
    assert good.count() == 3
    assert values(good, "bank_name", "review_rating") == [("BOA", 2), ("BOA", 2), ("CIH", 5)]
    bad = tables.read_rejected(spark, str(tmp_path / "bad"))
    assert sorted(r["record"] for r in bad.collect()) == sorted([lines[1], lines[3]])
    assert all(r["file"].endswith("in.json") for r in bad.collect())
    array = tmp_path / "array.json"
    array.write_text(json.dumps(RECORDS, indent=1), encoding="utf-8")
    assert tables.read_reviews(spark, str(array)).count() == 2
    array.write_text(json.dumps(RECORDS, indent=1)[:-20], encoding="utf-8")
    tables.read_reviews(spark, str(array), rejected=str(tmp_path / "bad2"))
    assert tables.read_rejected(spark, str(tmp_path / "bad2")).count() >= 1


def test_partitions_are_replaced_alone_and_pruned(spark, tmp_path):
    df = spark.range(300).selectExpr("id", "CASE WHEN id < 200 THEN 'hot' ELSE concat('p', id % 3) END AS part", "0 AS v")
    folder = str(tmp_path / "t")
    tables.write_folder(df, folder, ["part"], ["id"])
    tables.write_folder(df.filter("part = 'p1'").selectExpr("id", "part", "1 AS v"), folder, ["part"], only_these=True)
    back = spark.read.parquet(folder)
    assert back.count() == 300 and back.filter("v = 1").select("part").distinct().collect()[0]["part"] == "p1"
    assert tables.files_scanned(back.filter("part = 'p1'")) < tables.files_scanned(back)
    with pytest.raises(ValueError):
        tables.write_folder(df, folder, only_these=True)
    tables.write_folder(df.limit(1), folder, ["part"])
    assert spark.read.parquet(folder).count() == 1


def test_sorted_files_ascend(spark, tmp_path):
    df = spark.range(0, 20_000, 1, 7).selectExpr("id", "crc32(cast(id AS string)) % 1000 AS n")
    tables.write_sorted(df, str(tmp_path / "good"), [F.col("n").desc(), "id"])
    files = tables.file_order(spark, str(tmp_path / "good"), F.struct(-F.col("n"), "id"))
    assert files.agg(F.sum("rows"), F.sum("inversions")).first()[:] == (20_000, 0)
    df.write.parquet(str(tmp_path / "bad"))
    assert tables.file_order(spark, str(tmp_path / "bad"), F.struct(-F.col("n"), "id")).agg(F.sum("inversions")).first()[0] > 100


def test_nested_unclosed_reviews_take_linear_time(spark):
    import time

    from opinara.sources.pages import _compile, _page_rows

    selectors = {p: [_compile(x)] for p, x in (
        ("name", "h1"), ("address", "h2"), ("rating", "h3"), ("review", "div.r"), ("date", "b"), ("text", "div p"), ("star", "li i"))}
    start = time.perf_counter()
    rows = _page_rows(1, "u", "<div class=r><li><i></i>" * 25_000 + "<p>said</p>", selectors)
    assert time.perf_counter() - start < 5
    assert len(rows) == 25_000 and {r[7] for r in rows} == {"said"}
    assert [r[8] for r in rows[:2]] == [25_000, 24_999] and rows[-1][8] == 1
