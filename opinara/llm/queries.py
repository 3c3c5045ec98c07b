"""One query per operator over the whole of its table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import new_folder
from . import (
    alignment, circulant_minhash, jaccard_join, kneser_ney, language_id, lexical_search, licenses, line_dedup, packing, simple8b, spotsigs,
    tokens, toxicity, winnowing, wordcache,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op1_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.fingerprint_edits(documents(spark, sf_dir))



@query
def op2_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "token_ids")
    simple8b.write(documents(spark, sf_dir), folder, tokens.path(), end_id=1)
    return simple8b.read(spark, folder).drop("file")


@query
def op3_token_group_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_groups(documents(spark, sf_dir))


ORACLE_SQL["op3_token_group_join"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, hash(list_aggregate(w[i:i + least(5, len(w)) - 1], 'string_agg', ' ')) AS g
  FROM d, LATERAL (SELECT unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i) WHERE len(w) > 0
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 80 * (na.n + nb.n - count(*))
), r AS (
  SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(min(r.b), d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN r ON r.a = d.doc_id GROUP BY d.doc_id, n.n
"""


@query
def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return winnowing.contamination(documents(spark, sf_dir), benchmark).select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        winnowing.contaminated().alias("contaminated"),
    )


ORACLE_SQL["op4_winnowing"] = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, list_aggregate(w[i:i + least(13, len(w)) - 1], 'string_agg', ' ') AS g, least(13, len(w)) AS n
  FROM b, LATERAL (SELECT unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i) WHERE len(w) > 0
), ns AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT r, i, n, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') AS g
  FROM d, ns, LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS i)
), h AS (SELECT r, i, n, item_id FROM dw JOIN bw USING (g, n)),
p AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS j FROM h) GROUP BY r),
t AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS s
  FROM (SELECT DISTINCT r, item_id FROM h) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN p USING (r) LEFT JOIN t USING (r)
"""


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return line_dedup.remove_repeated(docs).select("doc_id", "lines", "lines_removed", "words_removed", "text")



@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = (wordcache.remainder("doc_id", 4) == 2).alias("held_out")
    model = language_id.learn(docs.filter(wordcache.remainder("doc_id", 4) != 2), tokens.path())
    return language_id.predict(docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "text"), model, tokens.path())


@query
def op7_noisy_channel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(wordcache.remainder("doc_id", 4) != 2)
    model = toxicity.learn(docs, labels)
    held_out = F.coalesce(wordcache.remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    return toxicity.score(docs.select("doc_id", held_out, "text"), model).withColumn(
        "predicted", F.when(F.col("score") >= 0.3, 1).otherwise(0))



@query
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit(documents(spark, sf_dir), tokens.path(), end_id=0, capacity=2048)


@query
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


ORACLE_SQL["op9_license_scan"] = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), f AS (SELECT * FROM (VALUES @PHRASES@) AS f(phrase, label, n)),
h AS (
  SELECT r, i, label FROM (
    SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d
  ), f WHERE list_aggregate(w[i:i + n - 1], 'string_agg', ' ') = phrase
), b AS (
  SELECT r, count(*) AS n_base, min(i) - 1 AS first_word, max(i) - 1 AS last_word, list(DISTINCT label) AS labels FROM h GROUP BY r
), t AS (SELECT label, string_split(words, ' ') AS words FROM (VALUES @TEMPLATES@) AS t(label, words)),
l AS (
  SELECT r, list_distinct(w[i + 1 : i + @WINDOW@]) AS w FROM (SELECT r, w, unnest(range(0, len(w), @STRIDE@)) AS i FROM d)
), m AS (
  SELECT r, list(DISTINCT label) AS labels, max(share) AS share FROM (
    SELECT r, label, len(list_intersect(w, words)) / len(list_distinct(words)) AS share,
      100 * len(list_intersect(w, words)) >= @PERCENT@ * len(list_distinct(words)) AS ok FROM l, t
  ) WHERE ok GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(m.labels, [])))), ','), '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(m.share, 0.0)::DOUBLE END AS score
FROM d LEFT JOIN b USING (r) LEFT JOIN m USING (r)
""".replace("@PHRASES@", ", ".join(f"('{p}', '{x}', {len(p.split())})" for p, x in licenses.PHRASES.items())
).replace("@TEMPLATES@", ", ".join(f"('{x}', '{t}')" for x, t in licenses.TEMPLATES)).replace("@PERCENT@", str(licenses.PERCENT)
).replace("@WINDOW@", str(licenses.WINDOW)).replace("@STRIDE@", str(licenses.STRIDE))


@query
def op10_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(wordcache.remainder("doc_id", 7) == 2, F.lit(False))
    scores = kneser_ney.perplexity_table(documents(spark, sf_dir), ~held_out)
    return scores.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(documents(spark, sf_dir))


@query
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return lexical_search.ranked(documents(spark, sf_dir), benchmark, k=10)


ORACLE_SQL["op12_lexical_search"] = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), s AS (SELECT count(*) AS nd, CAST(sum(len(w)) AS BIGINT) AS nt FROM d WHERE len(w) > 0),
i AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), t AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM i) GROUP BY r, term
), f AS (SELECT term, count(*) AS df FROM t GROUP BY term),
p AS (
  SELECT t.r, t.term, CAST(floor(1000 * ln((2 * nd + 2) / (2 * df + 1))) AS BIGINT)
    * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * len(w) * nd) // nt)))) AS part
  FROM t JOIN f USING (term) JOIN d USING (r), s
), c AS (
  SELECT item_id, r, CAST(sum(part) AS BIGINT) AS score FROM i JOIN p USING (term) GROUP BY item_id, r
), k AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM c JOIN d USING (r) WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10
"""


@query
def op13_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return circulant_minhash.near_duplicates(documents(spark, sf_dir))


ORACLE_SQL["op13_circulant_minhash"] = (
    "SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM ("
    + ORACLE_SQL["op3_token_group_join"].replace("least(5,", "least(3,").replace("80 *", "85 *") + ")")
