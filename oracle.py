"""The queries of the catalog as SQL for DuckDB, over the same tables."""

from __future__ import annotations

from opinara.functions import wordlists as L
from opinara.operators.language import EVIDENCE, TRIGRAMS, WEIGHT_UNIT
from opinara.functions.lexicon import POLARITY, INTENSITY
from opinara.plans.catalog import ALERT, ARABIC_TEXTS, AS_OF, CURVE, RELATIVE_FORMS, TOPIC_NAMES
from opinara.sources.reviews import TEST_CITIES


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def listed(values) -> str:
    return "[" + ", ".join(text(v) for v in values) + "]"


LETTERS = "a-zA-Z" + L.FRENCH_ACCENTS
TOPIC_LETTERS = "a-z" + L.TOPIC_ACCENTS


def trim(c: str) -> str:
    return f"trim({c}, ' ')"


def words(c: str, letters: str = LETTERS) -> str:
    return f"regexp_extract_all(lower({c}), '[{letters}]+')"


def joined(array: str, sep: str = " ") -> str:
    return f"array_to_string({array}, '{sep}')"


def without(array: str, stops) -> str:
    return f"list_filter({array}, lambda t: NOT list_contains({listed(stops)}, t))"


def hash_number(c: str, part: int) -> str:
    return f"CAST('0x' || substr(md5({c}), {1 + 7 * part}, 7) AS BIGINT)"


def avg(total: str, count: str) -> str:
    return f"(CAST({total} AS DOUBLE) / CAST(nullif({count}, 0) AS DOUBLE))"


def r(c: str, digits: int = 6) -> str:
    return f"(round({c}, {digits}) + 0.0)"


def exact_round(c: str, digits: int) -> str:
    """Half-up rounding through a decimal."""
    return f"CAST(round(CAST({c} AS DECIMAL(18, 9)), {digits}) AS DOUBLE)"


def retention(clean: str, orig: str) -> str:
    return (
        f"CASE WHEN length({orig}) > 0 THEN CAST((2 * 10000 * length({clean}) + length({orig})) "
        f"// (2 * length({orig})) AS DOUBLE) / 100 ELSE 0.0 END"
    )


def basic(c: str) -> str:
    return f"CASE WHEN {trim(c)} <> '' THEN {joined(words(c))} END"


def word_count(c: str) -> str:
    return (
        f"CAST(CASE WHEN {c} IS NULL THEN 0 WHEN {trim(c)} <> '' "
        f"THEN len(string_split({trim(c)}, ' ')) END AS INTEGER)"
    )


QUALITY = """CASE WHEN retention_percentage >= 70 THEN 'HIGH'
    WHEN retention_percentage >= 50 THEN 'MEDIUM' ELSE 'LOW' END"""


def surrogate(*cols: str) -> str:
    parts = [f"coalesce(CAST({c} AS VARCHAR), {text(L.KEY_NULL_TOKEN)})" for c in cols]
    return "md5(" + " || '-' || ".join(parts) + ")"


SCORE_TEXT = "regexp_replace(CAST(CAST(sentiment_score AS DECIMAL(18, 3)) AS VARCHAR), '\\.?0+$', '')"


def hits(c: str, terms) -> str:
    return "(" + " + ".join(f"CAST(contains({c}, {text(w)}) AS INTEGER)" for w in terms) + ")"


def by_indicators(c: str) -> str:
    low = f"lower({trim(c)})"
    fr, en = hits(low, L.FRENCH_INDICATORS), hits(low, L.ENGLISH_INDICATORS)
    return f"CASE WHEN {fr} > {en} THEN 'fr' WHEN {en} > 0 THEN 'en' ELSE 'unknown' END"


def ladder(c: str, rules, default: str) -> str:
    arms = " ".join(
        "WHEN " + " OR ".join(f"{c} ILIKE {text('%' + s + '%')}" for s in spellings)
        + f" THEN {text(value)}"
        for spellings, value in rules
    )
    return f"CASE {arms} ELSE {default} END"


def plain_ladder(c: str, rules, default: str) -> str:
    """The ladder with accents ignored on both sides."""
    arms = " ".join(
        "WHEN " + " OR ".join(f"contains(strip_accents(lower({c})), strip_accents(lower({text(s)})))" for s in spellings)
        + f" THEN {text(value)}"
        for spellings, value in rules
    )
    return f"CASE {arms} ELSE {default} END"


RAW_CITY = (
    "CASE WHEN contains(bank_location, ',') THEN "
    "trim(regexp_extract(bank_location, '(?s).*,\\s*(.*)$', 1), ' ') END"
)
CITY = ladder("raw_city", L.CITY_RULES, "raw_city")
REGION = ladder("raw_city", L.REGION_RULES, text(L.UNKNOWN_REGION))

# --- shared steps, in order ---------------------------------------------------

STEPS: dict[str, str] = {}

STEPS["hashed"] = f"""
SELECT doc_id, text, {hash_number('text', 0)} AS h0, {hash_number('text', 1)} AS h1,
  {hash_number('text', 2)} AS h2 FROM documents"""

STEPS["placed"] = f"""
SELECT *, CASE WHEN h0 % 97 <> 0 THEN 'Bank ' || (h0 % 20) END AS bank,
  'No ' || (h2 % 3) || ', ' || {listed(TEST_CITIES)}[h1 % 12 + 1] AS place FROM hashed"""

STEPS["reviews_raw"] = """
SELECT doc_id,
  CASE WHEN doc_id % 5 = 0 THEN '  ' || bank || ' ' ELSE bank END AS bank_name,
  bank || ' - ' || place AS branch_name,
  CASE WHEN (h1 + doc_id) % 4 <> 0
    THEN ((h1 + doc_id) % 8) || ',' || ((h0 + doc_id) % 10) END AS bank_rating,
  place AS bank_location,
  CASE WHEN h2 % 53 <> 0
    THEN strftime(DATE '1995-01-01' + CAST(h2 % 2557 AS INTEGER), '%Y-%m-%d') END AS review_date,
  text AS review_text,
  CAST(CASE WHEN (doc_id + h0) % 5 <> 0 THEN (h0 + doc_id * 7) % 9 - 1 END AS INTEGER) AS review_rating
FROM placed"""

STEPS["valid_raw"] = f"""
SELECT * FROM reviews_raw WHERE review_text IS NOT NULL AND length({trim('review_text')}) >= 3"""

STEPS["deduped"] = f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (
    PARTITION BY lower({trim('bank_name')}), lower({trim('branch_name')}),
      lower({trim('review_text')}), review_date
    ORDER BY CASE WHEN review_rating IS NOT NULL THEN 1 ELSE 2 END,
      CASE WHEN bank_rating IS NOT NULL THEN 1 ELSE 2 END,
      review_rating NULLS FIRST, bank_rating NULLS FIRST, bank_location NULLS FIRST,
      bank_name NULLS FIRST, branch_name NULLS FIRST, review_text) AS rn
  FROM valid_raw) WHERE rn = 1"""

STEPS["normalised"] = f"""
SELECT {trim('bank_name')} AS bank_name, {trim('branch_name')} AS branch_name,
  TRY_CAST(replace(bank_rating, ',', '.') AS DECIMAL(3, 2)) AS bank_rating_decimal,
  {trim('bank_location')} AS bank_location,
  CASE WHEN review_rating > 5 THEN 5 WHEN review_rating < 1 THEN 1 ELSE review_rating END
    AS review_rating_clean,
  review_date, review_text, {basic('review_text')} AS cleaned_text,
  CASE WHEN length({trim('review_text')}) >= 3 THEN
    {joined(without(words('review_text', '0-9' + LETTERS), L.french_stop_words()))} END AS advanced_text
FROM deduped"""

STEPS["measured"] = f"""
SELECT *, length(cleaned_text) AS normalized_length,
  {retention('cleaned_text', 'review_text')} AS retention_percentage,
  {word_count('cleaned_text')} AS word_count FROM normalised"""

STEPS["cleaned"] = """
SELECT *, CASE WHEN retention_percentage >= 60 AND word_count >= 3 THEN advanced_text
  ELSE cleaned_text END AS final_text FROM measured WHERE length(cleaned_text) >= 3"""

STEPS["bank_stats"] = f"""
SELECT bank_name,
  {avg('sum(review_rating_clean)', 'count(review_rating_clean)')} AS avg_rating,
  count(review_rating_clean) AS rating_count,
  min(review_rating_clean) AS min_rating, max(review_rating_clean) AS max_rating,
  CASE WHEN count(*) > 1 THEN stddev_samp(CAST(review_rating_clean AS DOUBLE)) END AS rating_stddev,
  {avg('sum(bank_rating_decimal)', 'count(bank_rating_decimal)')} AS avg_bank_rating,
  {avg('sum(normalized_length)', 'count(*)')} AS avg_text_length,
  {avg('sum(CAST(retention_percentage AS DECIMAL(18, 2)))', 'count(*)')} AS avg_retention
FROM cleaned WHERE review_rating_clean IS NOT NULL GROUP BY bank_name"""

STEPS["overall"] = f"""
SELECT {avg('sum(review_rating_clean)', 'count(*)')} AS global_avg_rating,
  {avg('sum(bank_rating_decimal)', 'count(bank_rating_decimal)')} AS global_avg_bank_rating,
  {avg('sum(normalized_length)', 'count(*)')} AS global_avg_text_length
FROM cleaned WHERE review_rating_clean IS NOT NULL"""

STEPS["staged"] = f"""
SELECT md5(coalesce(n.bank_name, '') || coalesce(n.branch_name, '') || coalesce(review_date, '')
    || coalesce(final_text, '')) AS id,
  n.bank_name, n.branch_name,
  CASE WHEN bank_rating_decimal BETWEEN 0 AND 5 THEN CAST(bank_rating_decimal AS DOUBLE)
    WHEN avg_bank_rating IS NOT NULL THEN {exact_round('avg_bank_rating', 1)}
    WHEN global_avg_bank_rating IS NOT NULL THEN {exact_round('global_avg_bank_rating', 1)}
    ELSE 3.0 END AS bank_rating,
  n.bank_location, CAST(review_date AS DATE) AS review_date, final_text,
  CASE WHEN review_rating_clean IS NOT NULL THEN CAST(review_rating_clean AS DOUBLE)
    WHEN avg_rating IS NOT NULL AND rating_count >= 3 THEN {exact_round('avg_rating', 1)}
    WHEN global_avg_rating IS NOT NULL THEN {exact_round('global_avg_rating', 1)}
    ELSE 3.0 END AS review_rating,
  CASE WHEN review_rating_clean IS NOT NULL THEN 'ORIGINAL'
    WHEN avg_rating IS NOT NULL AND rating_count >= 3 THEN 'BANK_AVERAGE'
    WHEN global_avg_rating IS NOT NULL THEN 'GLOBAL_AVERAGE' ELSE 'DEFAULT' END AS rating_source,
  rating_count AS bank_rating_count, {exact_round('avg_rating', 2)} AS bank_avg_rating,
  {QUALITY} AS text_quality
FROM cleaned n LEFT JOIN bank_stats s ON n.bank_name = s.bank_name CROSS JOIN overall g
WHERE n.bank_name IS NOT NULL AND n.bank_name <> '' AND review_date IS NOT NULL
  AND final_text IS NOT NULL AND length({trim('final_text')}) >= 3"""

STEPS["lexicon"] = f"""
SELECT lang, source, term,
  (strpos('0123456789abcdef', substr(md5(lang || ':' || source || ':' || term), 1, 1)) - 1 - 8) / unit AS weight
FROM (SELECT DISTINCT unnest({words('text')}) AS term FROM benchmark)
CROSS JOIN (VALUES ('fr', 'polarity', CAST(8 AS DOUBLE)), ('en', 'polarity', CAST(8 AS DOUBLE)),
  ('en', 'intensity', CAST(2 AS DOUBLE))) AS k(lang, source, unit)
WHERE length(term) >= 3"""



def trigram_rows(source: str, key: str, c: str) -> str:
    """A row per key and trigram with its number of occurrences."""
    return f"""SELECT {key}, t[i] || t[i + 1] || t[i + 2] AS trigram, count(*) AS n FROM (
      SELECT {key}, t, unnest(range(1, len(t) - 1)) AS i FROM (
        SELECT {key}, string_split(' ' || regexp_replace(lower({trim(c)}), '\\s+', ' ', 'g') || ' ', '') AS t
        FROM {source})) GROUP BY ALL"""


HELD_OUT = f"{hash_number('CAST(doc_id AS VARCHAR)', 0)} % 4 = 0"

STEPS["model_counts"] = trigram_rows(
    f"documents WHERE NOT ({HELD_OUT}) AND lang IS NOT NULL AND length({trim('text')}) >= 3", "lang", "text")

STEPS["model_trigrams"] = f"""
SELECT trigram FROM model_counts GROUP BY 1 ORDER BY sum(n) DESC, trigram LIMIT {TRIGRAMS}"""

STEPS["model_totals"] = """
SELECT lang, CAST(sum(n) AS BIGINT) + (SELECT count(*) FROM model_trigrams) + 1 AS total
FROM model_counts SEMI JOIN model_trigrams USING (trigram) GROUP BY 1"""

STEPS["model"] = f"""
SELECT trigram, lang AS language,
  CAST(round(ln((coalesce(n, 0) + 1) / total) * {WEIGHT_UNIT}) AS BIGINT) AS weight
FROM model_trigrams CROSS JOIN model_totals LEFT JOIN model_counts USING (trigram, lang)"""


def votes(key: str, counts: str) -> str:
    """Best language and its probability per key of counted trigrams."""
    return f"""SELECT {key}, model_lang, 1 / sum(exp((s - top) * least(n, {EVIDENCE}) / n / {WEIGHT_UNIT})) AS model_prob FROM (
      SELECT *, max(s) OVER (PARTITION BY {key}) AS top,
        first(language) OVER (PARTITION BY {key} ORDER BY s DESC, language) AS model_lang
      FROM (SELECT {key}, language, CAST(sum(n * weight) AS BIGINT) AS s, CAST(sum(n) AS BIGINT) AS n
        FROM ({counts}) JOIN model USING (trigram) GROUP BY ALL)) GROUP BY ALL"""


def by_model(c: str) -> str:
    return f"""CASE WHEN length({trim(c)}) < 3 THEN 'unknown'
    WHEN regexp_matches({c}, '[{L.ARABIC_BLOCK}]') THEN 'ar'
    WHEN model_prob > 0.7 THEN CASE WHEN model_lang IN ('fr', 'en') THEN model_lang ELSE 'other' END
    ELSE {by_indicators(c)} END"""


STEPS["distinct_texts"] = "SELECT DISTINCT final_text FROM staged"

STEPS["text_votes"] = votes("final_text", trigram_rows("distinct_texts", "final_text", "final_text"))

STEPS["texts"] = f"""
SELECT final_text, language, CASE WHEN language IN ('fr', 'ar') THEN language ELSE 'en' END AS lang
FROM (SELECT final_text, {by_model('final_text')} AS language
  FROM distinct_texts LEFT JOIN text_votes USING (final_text))"""

STEPS["scored"] = f"""
SELECT t.final_text, t.language, t.lang,
  coalesce(sum(weight) FILTER (source = 'polarity'), 0) AS pol,
  count(*) FILTER (source = 'polarity') AS pol_n,
  coalesce(sum(weight) FILTER (source = 'intensity'), 0) AS s
FROM (SELECT *, unnest({words('final_text')}) AS token FROM texts) t
LEFT JOIN lexicon l ON l.lang = t.lang AND l.term = t.token GROUP BY ALL"""

STEPS["polarity"] = """
SELECT final_text, language, CASE WHEN lang = 'en'
  THEN s / sqrt(s * s + 15) * 0.6 + coalesce(pol / nullif(pol_n, 0), 0) * 0.4
  ELSE coalesce(pol / nullif(pol_n, 0), 0) END AS polarity FROM scored"""


def label(c: str) -> str:
    exact = f"CAST({c} AS DECIMAL(18, 9))"
    return f"CASE WHEN {exact} > 0.1 THEN 'positive' WHEN {exact} < -0.1 THEN 'negative' ELSE 'neutral' END"


STEPS["enriched"] = f"""
SELECT r.*, p.language, {label('polarity')} AS sentiment,
  {exact_round('polarity', 3)} AS sentiment_score,
  {listed(TOPIC_NAMES)}[{hash_number('r.final_text', 0)} % {len(TOPIC_NAMES)} + 1] AS topic_name,
  CAST({hash_number('r.final_text', 0)} % {len(TOPIC_NAMES)} AS INTEGER) AS topic_id,
  CAST({hash_number('r.final_text', 0)} % 40 + 60 AS DOUBLE) / 100 AS topic_confidence
FROM staged r JOIN polarity p ON r.final_text = p.final_text"""

STEPS["dim_bank"] = f"""
SELECT DISTINCT {surrogate('bank_name')} AS bank_id, bank_name FROM enriched WHERE bank_name IS NOT NULL"""

STEPS["dim_branch"] = f"""
SELECT {surrogate('br.branch_name')} AS branch_id, b.bank_id, br.branch_name
FROM (SELECT DISTINCT bank_name, branch_name FROM enriched WHERE branch_name IS NOT NULL) br
JOIN dim_bank b ON br.bank_name = b.bank_name"""

STEPS["dim_date"] = f"""
SELECT DISTINCT {surrogate('review_date')} AS date_id, review_date AS full_date,
  CAST(extract(day FROM review_date) AS INTEGER) AS day,
  CAST(extract(month FROM review_date) AS INTEGER) AS month,
  CAST(extract(year FROM review_date) AS INTEGER) AS year
FROM enriched WHERE review_date IS NOT NULL"""

STEPS["dim_location"] = f"""
SELECT {surrogate('city', 'region')} AS location_id, city, region, '{L.COUNTRY}' AS country, bank_location
FROM (SELECT {CITY} AS city, {REGION} AS region, bank_location
  FROM (SELECT {RAW_CITY} AS raw_city, bank_location FROM enriched))
GROUP BY city, region, bank_location"""

STEPS["dim_sentiment"] = f"""
SELECT DISTINCT {surrogate('sentiment', SCORE_TEXT)} AS sentiment_id, sentiment, sentiment_score
FROM enriched WHERE sentiment IS NOT NULL"""

STEPS["dim_topic"] = f"""
SELECT DISTINCT {surrogate('topic_name')} AS topic_id, topic_name, topic_confidence
FROM enriched WHERE topic_name IS NOT NULL"""

STEPS["fact"] = f"""
SELECT r.id AS review_id, {surrogate('bank_name')} AS bank_id, {surrogate('branch_name')} AS branch_id,
  {surrogate('city', 'region')} AS location_id, {surrogate('sentiment', SCORE_TEXT)} AS sentiment_id,
  {surrogate('topic_name')} AS topic_id, {surrogate('review_date')} AS date_id,
  final_text, language, review_rating
FROM enriched r JOIN dim_location l ON r.bank_location = l.bank_location"""


def with_steps(last: str, body: str) -> str:
    """``body`` after all steps up to ``last``; it may begin with further steps."""
    names = list(STEPS)
    used = names[: names.index(last) + 1]
    return "WITH " + ",\n".join(f"{n} AS ({STEPS[n]})" for n in used) + "\n" + body


def _source(name: str, columns: str, grain_safe: bool) -> str:
    return f"(SELECT DISTINCT {columns} FROM {name})" if grain_safe else name


def branch_performance(safe: bool) -> str:
    branch = _source("dim_branch", "branch_id, branch_name", safe)
    place = _source("dim_location", "location_id, city, region", safe)
    return with_steps("fact", f"""
, metrics AS (SELECT b.bank_name, br.branch_name, l.city, l.region, count(*) AS total_reviews,
    {avg('sum(CAST(f.review_rating AS DECIMAL(12, 4)))', 'count(f.review_rating)')} AS avg_rating,
    {avg('sum(CAST(s.sentiment_score AS DECIMAL(9, 6)))', 'count(s.sentiment_score)')} AS avg_sentiment,
    {avg("count(*) FILTER (s.sentiment = 'positive')", 'count(*)')} * 100 AS positive_percentage,
    {avg('count(*) FILTER (f.review_rating >= 4)', 'count(*)')} * 100 AS promoter_percentage
  FROM fact f JOIN dim_bank b ON f.bank_id = b.bank_id JOIN {branch} br ON f.branch_id = br.branch_id
  JOIN {place} l ON f.location_id = l.location_id JOIN dim_sentiment s ON f.sentiment_id = s.sentiment_id
  GROUP BY 1, 2, 3, 4),
ranked AS (SELECT *, avg_rating * CAST(0.6 AS DOUBLE) + positive_percentage * CAST(0.4 AS DOUBLE)
    AS performance_score FROM metrics)
SELECT bank_name, branch_name, city, region, total_reviews, {r('avg_rating')} AS avg_rating,
  {r('avg_sentiment')} AS avg_sentiment, {r('positive_percentage')} AS positive_percentage,
  {r('promoter_percentage')} AS promoter_percentage, {r('performance_score')} AS performance_score,
  CAST(rank() OVER (ORDER BY performance_score DESC) AS INTEGER) AS overall_rank,
  CAST(rank() OVER (PARTITION BY region ORDER BY avg_rating DESC) AS INTEGER) AS regional_rank
FROM ranked""")


def sentiment_trends(safe: bool) -> str:
    branch = _source("dim_branch", "branch_id, branch_name", safe)
    return with_steps("fact", f"""
SELECT b.bank_name, br.branch_name, d.full_date AS review_date, d.month AS review_month,
  d.year AS review_year, s.sentiment, count(*) AS review_count,
  {r(avg('sum(CAST(s.sentiment_score AS DECIMAL(9, 6)))', 'count(s.sentiment_score)'))} AS avg_sentiment_score,
  {r(avg("count(*) FILTER (s.sentiment = 'positive')", 'count(*)') + ' * 100')} AS positive_percentage
FROM fact f JOIN dim_bank b ON f.bank_id = b.bank_id JOIN {branch} br ON f.branch_id = br.branch_id
JOIN dim_sentiment s ON f.sentiment_id = s.sentiment_id JOIN dim_date d ON f.date_id = d.date_id
GROUP BY 1, 2, 3, 4, 5, 6""")


def topic_analysis(safe: bool) -> str:
    topic = _source("dim_topic", "topic_id, topic_name", safe)
    return with_steps("fact", f"""
SELECT topic_name, sentiment, occurrence_count, {r('avg_sentiment')} AS avg_sentiment,
  {r('CAST(occurrence_count AS DOUBLE) / sum(occurrence_count) OVER (PARTITION BY topic_name) * 100')}
    AS sentiment_distribution,
  CAST(CASE WHEN sentiment = 'positive' THEN rank() OVER (ORDER BY occurrence_count DESC) END AS INTEGER)
    AS positive_rank,
  CAST(CASE WHEN sentiment = 'negative' THEN rank() OVER (ORDER BY occurrence_count DESC) END AS INTEGER)
    AS negative_rank
FROM (SELECT t.topic_name, s.sentiment, count(*) AS occurrence_count,
    {avg('sum(CAST(s.sentiment_score AS DECIMAL(9, 6)))', 'count(s.sentiment_score)')} AS avg_sentiment
  FROM fact f JOIN {topic} t ON f.topic_id = t.topic_id
  JOIN dim_sentiment s ON f.sentiment_id = s.sentiment_id GROUP BY 1, 2)""")


def customer_experience(safe: bool) -> str:
    topic = _source("dim_topic", "topic_id, topic_name", safe)
    x, y = "CAST(round(f.review_rating * 1000) AS HUGEINT)", "CAST(round(s.sentiment_score * 1000) AS HUGEINT)"
    return with_steps("fact", f"""
SELECT day, month, {r('avg_rating')} AS avg_rating, critical_topics, positive_topics,
  {r('CAST(c * sxy - sx * sy AS DOUBLE) / nullif(sqrt(CAST(c * sxx - sx * sx AS DOUBLE)) * sqrt(CAST(c * syy - sy * sy AS DOUBLE)), 0)')}
    AS rating_sentiment_correlation
FROM (SELECT d.day, d.month,
    {avg('sum(CAST(f.review_rating AS DECIMAL(12, 4)))', 'count(f.review_rating)')} AS avg_rating,
    string_agg(DISTINCT CASE WHEN s.sentiment = 'negative' THEN t.topic_name END, ', '
      ORDER BY CASE WHEN s.sentiment = 'negative' THEN t.topic_name END) AS critical_topics,
    string_agg(DISTINCT CASE WHEN s.sentiment = 'positive' THEN t.topic_name END, ', '
      ORDER BY CASE WHEN s.sentiment = 'positive' THEN t.topic_name END) AS positive_topics,
    count(*) AS c, sum({x}) AS sx, sum({x} * {x}) AS sxx, sum({y}) AS sy, sum({y} * {y}) AS syy,
    sum({x} * {y}) AS sxy
  FROM fact f JOIN dim_date d ON f.date_id = d.date_id JOIN {topic} t ON f.topic_id = t.topic_id
  JOIN dim_sentiment s ON f.sentiment_id = s.sentiment_id GROUP BY 1, 2)""")


def profile(column: str) -> str:
    return with_steps("enriched", f"""
SELECT {column}, count(*) AS row_count,
  {r(f'CAST(count(*) AS DOUBLE) * 100 / (SELECT count(*) FROM enriched)')} AS share_pct
FROM enriched GROUP BY 1""")


def relative_forms() -> str:
    forms = ", ".join(f"replace({text(f)}, '{{n}}', n)" for f in RELATIVE_FORMS)
    counted = "(jour|jours|mois|semaine|semaines|an|ans|année|années)"
    single = "(semaine|mois|an|année)"
    size = (
        "CASE WHEN unit LIKE 'jour%' THEN 1 WHEN unit LIKE 'semaine%' THEN 7 "
        "WHEN unit LIKE 'mois%' THEN 30 WHEN unit LIKE 'an%' THEN 365 END"
    )
    tries = [
        f"il y a (\\d+)\\s*{counted}", f"il y a (une?|un)\\s*{single}",
        f"(\\d+)\\s*{counted}", f"(une?|un)\\s*{single}",
    ]
    arms = " ".join(
        f"WHEN regexp_matches(low, {text(p)}) THEN "
        f"[regexp_extract(low, {text(p)}, 1), regexp_extract(low, {text(p)}, 2)]"
        for p in tries
    )
    return f"""
SELECT doc_id, said, CASE
    WHEN unit IS NOT NULL THEN DATE '{AS_OF}' -
      CAST((CASE WHEN amount IN ('un', 'une') THEN 1 ELSE CAST(amount AS INTEGER) END) * ({size}) AS INTEGER)
    WHEN regexp_matches(low, 'hier|yesterday') THEN DATE '{AS_OF}' - 1
    WHEN regexp_matches(low, 'aujourd''hui|today') THEN DATE '{AS_OF}' END AS review_date
FROM (SELECT *, found[1] AS amount, found[2] AS unit FROM (
  SELECT *, CASE {arms} END AS found FROM (
    SELECT doc_id, said, replace(replace(lower(said), ',', ''), '.', '') AS low FROM (
      SELECT doc_id, [{forms}][doc_id % {len(RELATIVE_FORMS)} + 1] AS said
      FROM (SELECT doc_id, CAST(doc_id % 11 + 1 AS VARCHAR) AS n FROM documents)))))"""


TOPIC_TOKENS = (
    f"list_filter({words('text', TOPIC_LETTERS)}, lambda t: length(t) >= 2 AND NOT "
    f"list_contains({listed(dict.fromkeys(L.TOPIC_FRENCH_STOP_WORDS + L.TOPIC_DOMAIN_STOP_WORDS))}, t))"
)
CORPUS = f"""WITH tokens AS (
  SELECT doc_id, source, {TOPIC_TOKENS} AS tokens FROM documents WHERE length(text) >= 10),
plain AS (SELECT doc_id, source, tokens,
  list_filter(tokens, lambda t: regexp_full_match(t, '[a-zA-Z]{{2,}}')) AS w FROM tokens WHERE len(tokens) >= 2),
corpus AS (SELECT doc_id, source, tokens, list_concat(w,
  list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS terms, w FROM plain)"""


def label_topics() -> str:
    rules = " ".join(
        f"WHEN contains(lower(word), {text(k)}) THEN {text(v)}" for k, v in L.TOPIC_RULES
    )
    title = (
        "array_to_string(list_transform(string_split(word, ' '), "
        "lambda p: upper(p[1]) || lower(p[2:])), ' ')"
    )
    return CORPUS + f""",
counted AS (SELECT source AS topic_id, word, count(*) AS n
  FROM (SELECT source, unnest(w) AS word FROM corpus) GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY n DESC, word) - 1 AS rank FROM counted),
labelled AS (SELECT *, CASE WHEN rank < 5 THEN CASE {rules} END END AS label, {title} AS title
  FROM ranked WHERE rank < 10),
grouped AS (SELECT topic_id, arg_min(label, rank) FILTER (label IS NOT NULL) AS label,
  list(title ORDER BY rank) FILTER (rank < 3) AS first,
  coalesce(list(title ORDER BY rank) FILTER (rank < 3 AND length(word) > 3), []) AS long
  FROM labelled GROUP BY topic_id)
SELECT topic_id, CASE WHEN label IS NOT NULL THEN label
  WHEN len(long) >= 1 THEN array_to_string(long[1:2], '_')
  ELSE array_to_string(first[1:2], '_') END AS topic_name FROM grouped"""


def search_grid() -> str:
    banks = ", ".join(f"({text(b)})" for b in L.SEARCH_BANKS)
    said = "bank_name || ' agence ' || city || ' Maroc'"
    return with_steps("reviews_raw", f"""
SELECT city, bank_name, {said} AS search_query,
  'https://www.google.com/maps/search/' || replace({said}, ' ', '+') AS search_url
FROM (SELECT DISTINCT {RAW_CITY} AS city FROM reviews_raw)
CROSS JOIN (VALUES {banks}) AS b(bank_name)""")


def alert() -> str:
    return f"""
SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start,
  time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end,
  count(*) AS review_count, count(*) FILTER (event_type = 'error') AS negative_count,
  {r(avg("count(*) FILTER (event_type = 'error')", 'count(*)'))} AS negative_share
FROM events GROUP BY 1, 2 HAVING count(*) >= {ALERT['min_count']}
  AND {avg("count(*) FILTER (event_type = 'error')", 'count(*)')} >= {ALERT['min_share']}"""


def ranking_in_bank() -> str:
    share = avg("count(*) FILTER (s.sentiment = 'positive')", "count(*)") + " * 100"
    return with_steps("fact", f"""
SELECT bank_name, branch_name, review_count, {r('positive_percentage')} AS positive_percentage,
  CAST(rank() OVER (PARTITION BY bank_name ORDER BY positive_percentage DESC) AS INTEGER) AS bank_rank
FROM (SELECT b.bank_name, br.branch_name, count(*) AS review_count, {share} AS positive_percentage
  FROM fact f JOIN dim_bank b ON f.bank_id = b.bank_id
  JOIN (SELECT DISTINCT branch_id, branch_name FROM dim_branch) br ON f.branch_id = br.branch_id
  JOIN dim_sentiment s ON f.sentiment_id = s.sentiment_id GROUP BY 1, 2)""")


def share_in(group: str, table: str, where: str = "") -> str:
    return with_steps("fact", f"""
SELECT {group}, sentiment, count(*) AS review_count,
  {r(f'CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY {group}) * 100')} AS share_pct
FROM fact f JOIN {table} JOIN dim_sentiment s ON f.sentiment_id = s.sentiment_id {where}
GROUP BY 1, 2""")


ONE_TOPIC = "(SELECT DISTINCT topic_id, topic_name FROM dim_topic) t ON f.topic_id = t.topic_id"

def arabic_reviews() -> str:
    n = len(ARABIC_TEXTS)
    return f"""WITH r AS (SELECT doc_id, text, {listed(ARABIC_TEXTS)}[{hash_number('text', 0)} % {n + 1} + 1]
      || ' ' || (doc_id % 10) AS final_text FROM documents),
    l AS (SELECT *, CASE WHEN final_text IS NULL OR length({trim('final_text')}) < 3 THEN 'unknown'
      WHEN regexp_matches(final_text, '[{L.ARABIC_BLOCK}]') THEN 'ar' ELSE {by_indicators('final_text')} END AS language FROM r)"""


def arabic_scored(model: bool) -> str:
    rows = [(x, "p", t, w) for x, some in POLARITY.items() for t, w in some.items()] + [("en", "i", t, w) for t, w in INTENSITY.items()]
    values = ", ".join(f"({text(x)}, {text(k)}, {text(t)}, CAST({w} AS DOUBLE))" for x, k, t, w in rows)
    by_model = """CASE WHEN contains(final_text, 'ممتاز') THEN 1 WHEN contains(final_text, 'سيء') THEN -1 ELSE 0 END
      * CAST(right(final_text, 1) AS INTEGER) / 10"""
    mean = "coalesce(pol / nullif(pol_n, 0), 0)"
    return arabic_reviews() + f""",
    lex AS (SELECT * FROM (VALUES {values}) AS v(lang, kind, term, weight)),
    w AS (SELECT *, CASE WHEN language IN ('fr', 'ar') THEN language ELSE 'en' END AS lang FROM l),
    s AS (SELECT doc_id, coalesce(sum(weight) FILTER (kind = 'p'), 0) AS pol, count(*) FILTER (kind = 'p') AS pol_n,
        coalesce(sum(weight) FILTER (kind = 'i'), 0) AS s
      FROM (SELECT doc_id, lang, unnest({words('final_text', LETTERS + L.ARABIC_BLOCK)}) AS term FROM w)
      JOIN lex USING (lang, term) GROUP BY 1),
    p AS (SELECT w.*, CASE WHEN lang = 'en' THEN coalesce(s, 0) / sqrt(coalesce(s, 0) * coalesce(s, 0) + 15) * 0.6 + {mean} * 0.4
      WHEN lang = 'ar' AND {'true' if model else 'false'} THEN {by_model} ELSE {mean} END AS polarity
      FROM w LEFT JOIN s USING (doc_id))
    SELECT doc_id, language, CASE WHEN length({trim('final_text')}) >= 3 THEN {label('polarity')} ELSE 'unknown' END AS sentiment,
      CASE WHEN length({trim('final_text')}) >= 3 THEN {exact_round('polarity', 3)} ELSE 0.0 END AS sentiment_score FROM p"""


def thin(body: str, replaced: str) -> str:
    """Cleaning steps over changed raw reviews."""
    steps = with_steps("staged", body)
    return steps.replace("valid_raw AS (\nSELECT * FROM reviews_raw", f"valid_raw AS (\nSELECT * FROM (SELECT * REPLACE ({replaced}) FROM reviews_raw)")


def page_reviews() -> str:
    strip = lambda c: f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"
    return with_steps("reviews_raw", f"""
    , p AS (SELECT *, CASE WHEN doc_id % 3 <> 0 THEN {strip('bank_name')} ELSE {listed(L.SEARCH_BANKS)}[doc_id % 6 + 1] END AS name,
      nullif(greatest(coalesce(review_rating, 0), 0), 0) AS stars FROM reviews_raw WHERE bank_name IS NOT NULL)
    SELECT name AS bank_name, name || ' - ' || bank_location AS branch_name, bank_rating, bank_location,
      strftime(DATE '{AS_OF}' - CAST(doc_id % 11 + 1 AS INTEGER), '%Y-%m-%d') AS review_date,
      {strip('review_text')} AS review_text, stars AS review_rating FROM p
    UNION ALL
    SELECT name, name || ' - ' || bank_location, bank_rating, bank_location,
      strftime(DATE '{AS_OF}' - 1, '%Y-%m-%d'), '', stars FROM p WHERE stars IS NOT NULL""")


def build() -> dict[str, str]:
    enriched = lambda body: with_steps("enriched", body)
    sql = {
        "clean_text_basic": f"SELECT doc_id, {basic('text')} AS cleaned FROM documents",
        "clean_text_no_digits": f"""SELECT doc_id, CASE WHEN {trim('text')} <> '' THEN
            {joined(words("regexp_replace(text, '[0-9]', '', 'g')"))} END AS cleaned FROM documents""",
        "normalize_text": f"""SELECT doc_id, CASE WHEN length({trim('text')}) >= 2 THEN
            {joined(without(words('text', '0-9' + LETTERS),
                            L.french_stop_words() + L.ARABIC_STOP_WORDS + L.ENGLISH_STOP_WORDS))} END
            AS normalized FROM documents""",
        "is_valid_text": f"""SELECT doc_id, length({trim('text')}) >= 3 AS valid,
            length({trim('source')}) >= 5 AND NOT regexp_full_match({trim('source')}, '[0-9\\s]*')
            AS valid_source FROM documents""",
        "text_metrics": f"""SELECT doc_id, CAST(length(text) AS INTEGER) AS original_length,
            CAST(length(cleaned) AS INTEGER) AS normalized_length,
            {retention('cleaned', 'text')} AS retention_percentage, {word_count('cleaned')} AS word_count
            FROM (SELECT doc_id, text, {basic('text')} AS cleaned FROM documents)""",
        "select_text": with_steps(
            "cleaned", "SELECT bank_name, branch_name, review_date, final_text FROM cleaned"),
        "text_quality": with_steps(
            "cleaned", f"SELECT {QUALITY} AS text_quality, count(*) AS review_count FROM cleaned GROUP BY 1"),
        "parse_decimal_comma": with_steps("reviews_raw", """SELECT doc_id,
            CAST(TRY_CAST(replace(bank_rating, ',', '.') AS DECIMAL(3, 2)) AS DOUBLE) AS bank_rating
            FROM reviews_raw"""),
        "clamp_rating": with_steps("reviews_raw", """SELECT doc_id, CASE WHEN review_rating BETWEEN 1 AND 5
            THEN review_rating WHEN review_rating > 5 THEN 5 WHEN review_rating < 1 THEN 1 END
            AS review_rating FROM reviews_raw"""),
        "review_id": with_steps("reviews_raw", """SELECT doc_id, md5(concat(coalesce(bank_name, ''),
            coalesce(branch_name, ''), coalesce(review_date, ''), coalesce(review_text, ''))) AS id
            FROM reviews_raw"""),
        "surrogate_key": with_steps(
            "reviews_raw",
            f"SELECT doc_id, {surrogate('bank_name', 'review_date')} AS row_key FROM reviews_raw"),
        "city_and_region": with_steps("reviews_raw", f"""SELECT doc_id, city, region,
            {plain_ladder('city', L.REGION_RULES, text(L.UNKNOWN_REGION))} AS region_by_city
            FROM (SELECT doc_id, {CITY} AS city, {REGION} AS region
              FROM (SELECT doc_id, {RAW_CITY} AS raw_city FROM reviews_raw))"""),
        "parse_relative_date": relative_forms(),
        "language_by_indicators": f"SELECT doc_id, {by_indicators('text')} AS language FROM documents",
        "detect_language": f"""SELECT doc_id, CASE WHEN length({trim('text')}) < 3 THEN 'unknown'
            WHEN regexp_matches(text, '[{L.ARABIC_BLOCK}]') THEN 'ar'
            WHEN ({hash_number('text', 0)} % 100) > 70
              THEN CASE WHEN lang IN ('fr', 'en') THEN lang ELSE 'other' END
            ELSE {by_indicators('text')} END AS language FROM documents""",
        "analyze_sentiment": enriched("SELECT id, language, sentiment, sentiment_score FROM enriched"),
        "language_model_accuracy": f"""SELECT count(*) AS held_out, true AS accurate FROM documents
            WHERE {hash_number('CAST(doc_id AS VARCHAR)', 0)} % 4 = 0""",
        "language_model_table": with_steps("model", "SELECT trigram, language, weight FROM model"),
        "language_by_model": with_steps("model", f"""
            , held AS (SELECT doc_id, text FROM documents WHERE {HELD_OUT}),
            v AS ({votes('doc_id', trigram_rows('held', 'doc_id', 'text'))})
            SELECT doc_id, model_lang, {r('coalesce(model_prob, 0.0)')} AS model_prob, {by_model('text')} AS language
            FROM held LEFT JOIN v USING (doc_id)"""),
        "sentiment_by_lexicon_join": enriched("SELECT id, language, sentiment, sentiment_score FROM enriched"),
        "sentiment_row_route": enriched("SELECT id, language, sentiment, sentiment_score FROM enriched").replace(
            "WHERE length(term) >= 3", "WHERE length(term) >= 3 AND substr(md5(term), 1, 1) < '4'"),
        "classify_polarity": f"""SELECT doc_id, {label('p')} AS sentiment,
            {exact_round('p', 3)} AS sentiment_score FROM (SELECT doc_id,
            CAST({hash_number('text', 1)} % 20001 - 10000 AS DOUBLE) / 10000 AS p FROM documents)""",
        "validate_sentiment": enriched("""
            SELECT count(*) FILTER (sentiment IS NULL) AS missing_sentiment,
            count(*) FILTER (sentiment_score IS NULL) AS missing_scores,
            count(*) FILTER (sentiment = 'positive' AND sentiment_score < 0) AS positive_with_negative_score,
            count(*) FILTER (sentiment = 'negative' AND sentiment_score > 0) AS negative_with_positive_score
            FROM (SELECT CASE WHEN turn = 1 THEN NULL WHEN turn = 2 THEN 'positive' WHEN turn = 3 THEN 'negative'
              ELSE sentiment END AS sentiment, CASE WHEN turn <> 4 THEN sentiment_score END AS sentiment_score
              FROM (SELECT *, CAST('0x' || substr(id, 1, 4) AS BIGINT) % 10 AS turn FROM enriched))"""),
        "language_profile": profile("language"),
        "sentiment_profile": profile("sentiment"),
        "topic_profile": profile("topic_name"),
        "column_profile": enriched(f"""
            SELECT count(*) AS row_count, count(final_text) AS non_null_count,
            {r('avg(length(final_text))')} AS mean_text_length,
            count(*) FILTER ({trim('final_text')} <> '') AS records_with_text,
            count(*) FILTER (len({TOPIC_TOKENS.replace('lower(text)', 'lower(final_text)')}) = 0)
              AS empty_after_preprocessing,
            {r('avg(topic_confidence)')} AS mean_confidence FROM enriched"""),
        "raw_reviews": with_steps("reviews_raw", "SELECT * FROM reviews_raw"),
        "keep_informative": with_steps("reviews_raw", """
            SELECT doc_id, nullif(review_rating, 0) AS review_rating,
            CAST(CASE WHEN doc_id % 3 <> 0 THEN length(review_text) END AS INTEGER) AS text_length
            FROM reviews_raw WHERE doc_id % 3 <> 0 OR nullif(review_rating, 0) IS NOT NULL"""),
        "dedup_reviews": with_steps("deduped", "SELECT * EXCLUDE (doc_id) FROM deduped"),
        "bank_statistics": with_steps("bank_stats", f"""
            SELECT bank_name, {r('avg_rating')} AS avg_rating, rating_count, min_rating, max_rating,
            {r('rating_stddev')} AS rating_stddev, {r('avg_bank_rating')} AS avg_bank_rating,
            {r('avg_text_length')} AS avg_text_length, {r('avg_retention')} AS avg_retention
            FROM bank_stats"""),
        "global_stats": with_steps("overall", f"""
            SELECT {r('global_avg_rating')} AS global_avg_rating,
            {r('global_avg_bank_rating')} AS global_avg_bank_rating,
            {r('global_avg_text_length')} AS global_avg_text_length FROM overall"""),
        "impute_rating": with_steps("staged", """
            SELECT bank_name, rating_source, review_rating, count(*) AS review_count
            FROM staged GROUP BY 1, 2, 3"""),
        "impute_bank_rating": with_steps(
            "staged", "SELECT bank_name, bank_rating, count(*) AS review_count FROM staged GROUP BY 1, 2"),
        "staging_reviews_cleaned": with_steps("staged", "SELECT * FROM staged"),
        "average_rating_per_bank": with_steps("staged", f"""
            SELECT bank_name, count(*) AS review_count,
            {r(avg('sum(CAST(review_rating AS DECIMAL(4, 1)))', 'count(*)'))} AS avg_rating
            FROM staged GROUP BY 1"""),
        "dq_not_null": with_steps("reviews_raw", " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count FROM reviews_raw"
            for c in ("bank_name", "review_date", "review_rating", "review_text"))),
        "dq_unique": with_steps("reviews_raw", """
            SELECT branch_name, count(*) AS row_count FROM reviews_raw WHERE branch_name IS NOT NULL
            GROUP BY 1 HAVING count(*) > 1"""),
        "search_grid": search_grid(),
        "top_k_per_group": """SELECT doc_id, source, lang, n_chars, CAST(place AS INTEGER) AS place FROM (
            SELECT doc_id, source, lang, n_chars,
            row_number() OVER (PARTITION BY source, lang ORDER BY n_chars DESC, doc_id) AS place
            FROM documents) WHERE place <= 2""",
        "cap_links": """SELECT user_id, event_type AS url, min(event_id) AS position FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events)
            WHERE rn <= 5 GROUP BY 1, 2""",
        "pages_to_raw_reviews": page_reviews(),
        "read_reviews": with_steps("reviews_raw", """
            SELECT * EXCLUDE (doc_id) FROM reviews_raw WHERE doc_id % 10 > 1
            UNION ALL SELECT * EXCLUDE (doc_id) FROM reviews_raw WHERE doc_id % 10 > 1 AND doc_id % 7 = 2"""),
        "rejected_records": """
            SELECT CASE doc_id % 10 WHEN 0 THEN 'cut' ELSE 'type' END AS kind, count(*) AS n
            FROM documents WHERE doc_id % 10 < 2 GROUP BY 1""",
        "replace_partition": with_steps("staged", """
            SELECT id, bank_name, review_date,
            CASE WHEN rating_source = 'BANK_AVERAGE' THEN 5.0::DOUBLE ELSE review_rating END AS review_rating,
            rating_source FROM staged"""),
        "partition_pruning": with_steps("staged", """
            SELECT count(*) AS rows_of_source, true AS fewer_files FROM staged WHERE rating_source = 'BANK_AVERAGE'"""),
        "sorted_output": with_steps("staged", "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS inversions FROM staged"),
        "sentiment_arabic": arabic_scored(True),
        "sentiment_arabic_lexicon": arabic_scored(False),
        "normalize_text_arabic": arabic_reviews() + f""" SELECT doc_id, CASE WHEN length({trim('final_text')}) >= 2 THEN
            {joined(without(words('final_text', '0-9' + LETTERS + L.ARABIC_BLOCK),
                            L.french_stop_words() + L.ARABIC_STOP_WORDS + L.ENGLISH_STOP_WORDS))} END AS arabic,
            CASE WHEN length({trim('text')}) >= 2 THEN
            {joined(without(words('text', '0-9' + LETTERS), L.stop_words('fr', True)))} END AS polar FROM r""",
        "impute_global": thin("""
            SELECT rating_source, review_rating, bank_rating, text_quality, count(*) AS review_count
            FROM staged GROUP BY ALL""", """
            CASE WHEN K % 3 = 0 OR (K % 4 = 1 AND doc_id % 50 <> 0) THEN NULL ELSE review_rating END AS review_rating,
            CASE WHEN K % 3 = 0 THEN NULL ELSE bank_rating END AS bank_rating,
            CASE WHEN doc_id % 9 = 0 THEN substr(review_text, 1, 40) || repeat(' 12.34;', 40) ELSE review_text END AS review_text""".replace(
            "K %", "TRY_CAST(regexp_extract(bank_name, '[0-9]+') AS INTEGER) %")),
        "impute_default": thin("""
            SELECT rating_source, review_rating, bank_rating, count(*) AS review_count FROM staged GROUP BY ALL""", """
            CAST(NULL AS INTEGER) AS review_rating, CAST(NULL AS VARCHAR) AS bank_rating"""),
        "merge_repeated_topics": enriched("""
            , assigned AS (SELECT id, topic_id, topic_name, topic_confidence FROM (
              SELECT * EXCLUDE (id), substr(id, 1, 2) AS id,
                row_number() OVER (PARTITION BY substr(id, 1, 2) ORDER BY topic_id, topic_name, topic_confidence)
                AS rn FROM enriched WHERE language = 'fr') WHERE rn = 1)
            SELECT substr(s.id, 1, 2) AS id, s.bank_name, coalesce(a.topic_id, -1) AS topic_id,
              coalesce(a.topic_name, 'Unclassified') AS topic_name,
              coalesce(a.topic_confidence, 0.0) AS topic_confidence, count(*) AS n
            FROM staged s LEFT JOIN assigned a ON substr(s.id, 1, 2) = a.id GROUP BY ALL"""),
        "append_batches": with_steps("reviews_raw", "SELECT * FROM reviews_raw"),
        "preprocess_for_topics":
            f"SELECT doc_id, {joined(TOPIC_TOKENS)} AS processed_text FROM documents",
        "topic_corpus": CORPUS + """
            SELECT doc_id, CAST(len(tokens) AS INTEGER) AS token_count,
            CAST(len(terms) AS INTEGER) AS term_count,
            md5(array_to_string(terms, '|')) AS terms_md5 FROM corpus""",
        "topic_vocabulary": CORPUS + """,
            counts AS (SELECT term, count(*) AS term_count, count(DISTINCT doc_id) AS doc_count
              FROM (SELECT doc_id, unnest(terms) AS term FROM corpus) GROUP BY 1)
            SELECT * FROM counts WHERE doc_count >= 3
              AND doc_count <= 0.85 * (SELECT count(*) FROM corpus)
            ORDER BY term_count DESC, term LIMIT 1500""",
        "vectorise": CORPUS + """,
            found AS (SELECT doc_id, unnest(terms) AS term FROM corpus),
            kept AS (SELECT term FROM found GROUP BY 1 HAVING count(DISTINCT doc_id) >= 3
                AND count(DISTINCT doc_id) <= 0.85 * (SELECT count(*) FROM corpus)
              ORDER BY count(*) DESC, term LIMIT 1500)
            SELECT doc_id, term, count(*) AS count FROM found SEMI JOIN kept USING (term) GROUP BY 1, 2""",
        "lemmatise": CORPUS + f""",
            half AS (SELECT DISTINCT token FROM (SELECT unnest(tokens) AS token FROM corpus)
              WHERE {hash_number('token', 0)} % 2 = 0),
            lemmas AS (SELECT token, min(lemma) AS lemma FROM (SELECT token, substr(token, 1, 4) AS lemma FROM half
              UNION ALL SELECT token, 'zzz' FROM half WHERE {hash_number('token', 1)} % 3 = 0) GROUP BY 1),
            spelled AS (SELECT doc_id, string_agg(coalesce(lemma, token), ' ' ORDER BY i) AS said, count(*) AS n
              FROM (SELECT doc_id, tokens[i] AS token, i FROM (SELECT doc_id, tokens, unnest(range(1, len(tokens) + 1)) AS i FROM corpus))
              LEFT JOIN lemmas USING (token) GROUP BY 1)
            SELECT doc_id, CAST(c.copy AS INTEGER) AS copy, CAST(n AS INTEGER) AS token_count, md5(said) AS tokens_md5
            FROM spelled CROSS JOIN (VALUES (1), (2)) AS c(copy)""",
        "pick_topic_counts": f"""
            WITH curve AS (SELECT doc_id, topic_count,
              CAST({hash_number("doc_id || ':' || topic_count", 0)} % {CURVE['spread']} + {CURVE['low']} AS DOUBLE) AS p
              FROM documents CROSS JOIN (SELECT CAST(unnest(range(3, 16)) AS INTEGER) AS topic_count)
              WHERE {hash_number("doc_id || ':' || topic_count", 1)} % 7 <> 0),
            steps AS (SELECT *, abs(lead(p) OVER (PARTITION BY doc_id ORDER BY topic_count) - p) / p * 100 < 5 AS flat FROM curve)
            SELECT doc_id, coalesce(CASE WHEN count(*) >= 3 THEN min(topic_count) FILTER (flat) END,
              arg_min(topic_count, p * 100 + topic_count)) AS topic_count FROM steps GROUP BY 1""",
        "choose_topic_count": CORPUS + " SELECT count(*) AS documents, true AS same_choice, true AS in_range FROM corpus",
        "label_topics": label_topics(),
        "topic_assignment_checks": with_steps("staged", f"""
            SELECT count(*) AS reviews, count(*) FILTER (length(final_text) < 10
              OR len({TOPIC_TOKENS.replace('lower(text)', 'lower(final_text)')}) < 2) AS unclassified,
            CAST(0 AS BIGINT) AS ids_out_of_range, CAST(0 AS BIGINT) AS confidences_out_of_range,
            CAST(0 AS BIGINT) AS names_unlike_ids, CAST(0 AS BIGINT) AS topics_of_several_names FROM staged"""),
        "merge_topics": enriched("""
            , assigned AS (SELECT id, topic_id, topic_name, topic_confidence FROM (
              SELECT *, row_number() OVER (PARTITION BY id ORDER BY topic_id, topic_name, topic_confidence)
                AS rn FROM enriched WHERE language = 'fr') WHERE rn = 1)
            SELECT s.id, s.bank_name, coalesce(a.topic_id, -1) AS topic_id,
              coalesce(a.topic_name, 'Unclassified') AS topic_name,
              coalesce(a.topic_confidence, 0.0) AS topic_confidence
            FROM staged s LEFT JOIN assigned a ON s.id = a.id"""),
        "fact_reviews": with_steps("fact", "SELECT * FROM fact"),
        "reviews_by_sentiment_over_time": with_steps("fact", """
            SELECT year, sentiment, count(*) AS review_count FROM fact f
            JOIN dim_date d ON f.date_id = d.date_id JOIN dim_sentiment s ON f.sentiment_id = s.sentiment_id
            GROUP BY 1, 2"""),
        "sentiment_by_bank": share_in(
            "bank_name",
            "dim_bank b ON f.bank_id = b.bank_id JOIN dim_date d ON f.date_id = d.date_id",
            "WHERE d.full_date <= DATE '2000-06-21'"),
        "sentiment_by_topic": share_in("topic_name", ONE_TOPIC),
        "volume_by_topic_sentiment": with_steps("fact", f"""
            SELECT topic_name, {', '.join(f"count(*) FILTER (sentiment = '{s}') AS {s}"
                                          for s in ('positive', 'neutral', 'negative', 'unknown'))}
            FROM fact f JOIN {ONE_TOPIC} JOIN dim_sentiment s ON f.sentiment_id = s.sentiment_id
            GROUP BY 1"""),
        "branch_ranking_in_bank": ranking_in_bank(),
        "topic_share": with_steps("fact", f"""
            SELECT topic_name, count(*) AS review_count,
            {r('CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM fact) * 100')} AS share_pct
            FROM fact f JOIN {ONE_TOPIC} GROUP BY 1"""),
        "negative_spike_alert": alert(),
        "negative_spike_alert_stream": alert(),
        "incremental_reviews": with_steps("deduped", "SELECT * EXCLUDE (doc_id) FROM deduped"),
    }
    for name in ("bank", "branch", "date", "location", "sentiment", "topic"):
        sql[f"dim_{name}"] = with_steps(f"dim_{name}", f"SELECT * FROM dim_{name}")
    for name, make in (
        ("branch_performance", branch_performance), ("sentiment_trends", sentiment_trends),
        ("topic_analysis", topic_analysis), ("customer_experience", customer_experience),
    ):
        sql[name] = make(True)
        sql[f"{name}_as_joined"] = make(False)
    for name in (
        "branch_performance", "sentiment_trends", "topic_analysis", "customer_experience", "reviews_by_sentiment_over_time",
        "sentiment_by_bank", "sentiment_by_topic", "volume_by_topic_sentiment", "branch_ranking_in_bank", "topic_share",
    ):
        sql[f"{name}_live"] = sql[name]
    return sql
