"""Lexicon sentiment per review, routed by language.

A lexicon is a table (lang, source, term, weight) with source ``polarity`` for
every language and, for English, also ``intensity``.  French and Arabic use the
mean polarity of the matched words.  English blends 0.6 of the damped intensity
sum with 0.4 of the mean polarity.  Other and unknown languages are read as
English.  Weights count with four decimals, so sums are exact integers and do
not depend on the order of rows or words.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.language import detect_language
from ..functions.text import _col, words
from ..functions.wordlists import ARABIC_BLOCK, FRENCH_ACCENTS
from ..sources.scratch import write_once
from .dedup import text_key
from .keyed_join import BROADCAST_ROWS, join_unique

ArabicModel = Callable[[Column], Column]

# --- fixed values -----------------------------------------------------------
POSITIVE_ABOVE = 0.1
NEGATIVE_BELOW = -0.1
INTENSITY_SHARE = 0.6
POLARITY_SHARE = 0.4
DAMPING = 15
MIN_LENGTH = 3

WEIGHT_UNIT = 10_000
# Only the plan depends on these two: both routes give the same scores.
MAX_TERMS = 5_000
MAX_WEIGHTS = 64


def classify_polarity(polarity: Column | str) -> tuple[Column, Column]:
    """(label, score): label from the value with nine decimals, score from the same rounded to three.

    A double like -0.057499999999999996 stands for a half and is read as one.
    """
    p = _col(polarity).cast("decimal(18,9)")
    above, below = F.lit(str(POSITIVE_ABOVE)).cast("decimal(18,9)"), F.lit(str(NEGATIVE_BELOW)).cast("decimal(18,9)")
    label = F.when(p > above, "positive").when(p < below, "negative").otherwise("neutral")
    return label, F.round(p, 3).cast("double")


def effective_language(language: Column | None, text: Column, lowered: bool = False) -> Column:
    """Language whose lexicon scores a text: fr, ar or en.

    A missing or unknown language is detected from the text first.
    """
    found = detect_language(text, lowered=lowered)
    if language is not None:
        found = F.when(language.isNull() | (language == "unknown"), found).otherwise(language)
    return F.when(found.isin("fr", "ar"), found).otherwise("en")


def _tokens(text: Column, lowered: bool) -> Column:
    return words(text, scripts=("latin", "arabic"), lowered=lowered)


def score_sentiment_fr(total: Column, hits: Column) -> Column:
    """Mean polarity of the matched words; 0 without a match."""
    return F.when(hits > 0, total / WEIGHT_UNIT / hits).otherwise(F.lit(0.0))


def score_sentiment_en(total: Column, hits: Column, intensity: Column) -> Column:
    """Damped intensity sum and mean polarity, blended."""
    s = intensity / WEIGHT_UNIT
    damped = s / F.sqrt(s * s + DAMPING)
    return damped * INTENSITY_SHARE + score_sentiment_fr(total, hits) * POLARITY_SHARE


def score_sentiment_ar(total: Column, hits: Column, model: Column | None = None) -> Column:
    """Score of a classifier where there is one (0 if it fails), else mean polarity."""
    return score_sentiment_fr(total, hits) if model is None else F.coalesce(model, F.lit(0.0))


def _score(lang: Column, total: Column, hits: Column, intensity: Column, arabic: Column | None) -> Column:
    return (
        F.when(lang == "fr", score_sentiment_fr(total, hits))
        .when(lang == "ar", score_sentiment_ar(total, hits, arabic))
        .otherwise(score_sentiment_en(total, hits, intensity))
    )


def lexicon_terms(lexicon: DataFrame) -> DataFrame:
    """One row per (lang, term) with its weights in units of 1/10,000: what both routes read.

    Rows without a language, source, term or weight are left out; of repeated rows the
    largest weight counts; halves are rounded away from zero.
    """
    weight = F.round(F.col("weight") * WEIGHT_UNIT).cast("bigint")
    found = lexicon.filter(" AND ".join(f"{c} IS NOT NULL" for c in ("lang", "source", "term", "weight")))
    return found.groupBy(F.col("lang").alias("__lang"), F.col("term").alias("__term")).agg(
        F.max(F.when(F.col("source") == "polarity", weight)).alias("__w_pol"),
        F.max(F.when(F.col("source") == "intensity", weight)).alias("__w_int"),
    )


def _short_lexicon(terms: DataFrame):
    """{(lang, source): {weight: [terms]}} when the lexicon is small, else None."""
    rows = terms.limit(MAX_TERMS + 1).collect()
    if len(rows) > MAX_TERMS:
        return None
    groups: dict = defaultdict(lambda: defaultdict(list))
    for row in rows:
        for source, weight in (("polarity", row["__w_pol"]), ("intensity", row["__w_int"])):
            if weight is not None:
                groups[row["__lang"], source][weight].append(row["__term"])
    if any(len(g) > MAX_WEIGHTS for g in groups.values()):
        return None
    return groups


def _weights(tokens: Column, classes: dict | None) -> Column:
    """Weights of the tokens found in the lexicon, in text order."""
    if not classes:
        return F.array().cast("array<bigint>")
    every = [t for terms in classes.values() for t in terms]

    def weight(t: Column) -> Column:
        out = None
        for w, terms in classes.items():
            hit = t.isin(terms)
            out = F.when(hit, F.lit(w).cast("bigint")) if out is None else out.when(hit, F.lit(w).cast("bigint"))
        return out

    return F.transform(F.filter(tokens, lambda t: t.isin(every)), weight)


def _total(weights: Column) -> Column:
    return F.aggregate(weights, F.lit(0).cast("bigint"), lambda a, w: a + w)


def _score_in_row(
    df: DataFrame, groups: dict, text: str, arabic: Column | None, lowered: bool
) -> DataFrame:
    """Score with the lexicon inside the expression: no join, no shuffle."""
    lang, tokens = F.col("__lang"), F.col("__tokens")
    pol = (
        F.when(lang == "fr", _weights(tokens, groups.get(("fr", "polarity"))))
        .when(lang == "ar", _weights(tokens, groups.get(("ar", "polarity"))))
        .otherwise(_weights(tokens, groups.get(("en", "polarity"))))
    )
    intensity = F.when(lang == "en", _weights(tokens, groups.get(("en", "intensity"))))
    found = df.withColumn("__tokens", _tokens(F.col(text), lowered)).select(
        *df.columns, pol.alias("__pol"), intensity.alias("__int")
    )
    score = _score(
        lang, _total(F.col("__pol")), F.size("__pol"), _total(F.col("__int")), arabic
    )
    return found.withColumn("__polarity", score).drop("__pol", "__int")


def _score_by_lookup(df: DataFrame, terms: DataFrame, text: str, arabic: Column | None, lowered: bool) -> DataFrame:
    """Score with the lexicon in the workers' memory: no shuffle, and one pass over the texts.

    ``terms`` has at most ``broadcast_rows`` rows.
    """
    weights: dict = defaultdict(lambda: ({}, {}))
    for lang, term, pol, intensity in terms.select("__lang", "__term", "__w_pol", "__w_int").collect():
        for table, weight in zip(weights[lang], (pol, intensity)):
            if weight is not None:
                table[term] = weight
    shared = df.sparkSession.sparkContext.broadcast(dict(weights))
    word = f"[a-zA-Z{FRENCH_ACCENTS}{ARABIC_BLOCK}]+"  # as ``_tokens`` finds them

    @F.pandas_udf("total long, hits long, intensity long")
    def sums(texts: pd.Series, langs: pd.Series) -> pd.DataFrame:
        split, tables, rows = re.compile(word).findall, shared.value, []
        for said, lang in zip(texts, langs):
            pol, intensity = tables.get(lang, ({}, {}))
            found = split(said) if said is not None and (pol or intensity) else []
            hits = [w for w in map(pol.get, found) if w is not None]
            rows.append((sum(hits), len(hits), sum(filter(None, map(intensity.get, found))) if intensity else 0))
        return pd.DataFrame(rows, columns=["total", "hits", "intensity"], dtype="int64")

    said = F.col(text) if lowered else F.lower(F.col(text))
    found = df.withColumn("__sums", sums(said, F.col("__lang")))
    score = _score(F.col("__lang"), F.col("__sums.total"), F.col("__sums.hits"), F.col("__sums.intensity"), arabic)
    return found.withColumn("__polarity", score).drop("__sums")


def _word_sums(words_found: DataFrame, weight: Column) -> DataFrame:
    """Sums over the matched words of every text, and how often the text occurs.

    ``weight`` is how often a row of ``words_found`` stands for its word.
    """
    pol, intensity = F.col("__w_pol"), F.col("__w_int")
    return words_found.groupBy("__key").agg(
        F.sum(weight * pol).alias("__pol_sum"),
        F.sum(F.when(pol.isNotNull(), weight)).alias("__pol_hits"),
        F.sum(weight * intensity).alias("__int_sum"),
        F.sum("__first").alias("n"),
    )


def _score_by_join(
    df: DataFrame, terms: DataFrame, text: str, arabic: Column | None, lowered: bool,
    broadcast_rows: int,
) -> DataFrame:
    """Score with the lexicon as a table.

    The words of a text leave the scan in one task.  With a broadcast lexicon
    they are matched and summed there, and one small row per text is shuffled.
    With a longer one the words are first counted per text and matched in a
    shuffle join; frequent words are hot keys, which ``join_unique`` handles.
    Sums are kept per distinct text and divided by its copies; a text moves only
    if a later step reads it.
    """
    keyed = df.withColumn("__key", F.unhex(text_key(F.concat_ws(" ", F.col("__lang"), F.col(text)))))
    found = keyed.select(
        "__key", "__lang", F.posexplode(_tokens(F.col(text), lowered)).alias("__pos", "__term")
    ).select("__key", "__lang", "__term", (F.col("__pos") == 0).cast("bigint").alias("__first"))
    on = ["__lang", "__term"]
    if terms.count() <= broadcast_rows:
        sums = _word_sums(found.join(F.broadcast(terms), on, "left"), F.lit(1).cast("bigint"))
    else:
        counted = found.groupBy("__key", *on).agg(
            F.count("*").alias("__tf"), F.sum("__first").alias("__first")
        )
        sums = _word_sums(join_unique(write_once(counted, "word_counts"), terms, on), F.col("__tf"))
    sums = write_once(sums, "text_sums")
    # the model's score is made before, so that the text itself moves only if it is asked for
    if arabic is not None:
        keyed, arabic = keyed.withColumn("__arabic", arabic), F.col("__arabic")
    joined = join_unique(keyed, sums, ["__key"], counts=sums.select("__key", "n"))

    def per_copy(name: str) -> Column:
        return F.coalesce(F.col(name) / F.col("n"), F.lit(0.0))

    score = _score(
        F.col("__lang"), per_copy("__pol_sum"), per_copy("__pol_hits"), per_copy("__int_sum"), arabic
    )
    return joined.withColumn("__polarity", score).drop("__key", "n", "__pol_sum", "__pol_hits", "__int_sum")


def analyze_sentiment(
    df: DataFrame, lexicon: DataFrame, text: str = "final_text", language: str = "language",
    arabic_score: ArabicModel | None = None, method: str = "auto", lowered: bool = False,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Add ``sentiment`` and ``sentiment_score``.

    A lexicon of at most ``MAX_TERMS`` terms is compiled into the expression and
    scored in the scan's own stage; one of at most ``broadcast_rows`` is looked up there
    by Python workers; a longer one is joined as a table.  All read
    ``lexicon_terms`` and give the same scores; ``method`` ("row" or "join") forces one
    of these two.  ``arabic_score`` turns a column of texts into scores, as ``model_score``
    does; it gets the Arabic texts and null for all others.
    ``lowered=True`` tells that the text is lower-case already, as cleaned text is.
    """
    terms = write_once(lexicon_terms(lexicon), "lexicon_terms")
    groups = None if method == "join" else _short_lexicon(terms)
    if method == "row" and groups is None:
        raise ValueError("the lexicon is too long to compile into a row expression")
    columns = df.columns
    known = F.col(language) if language in columns else None
    routed = df.withColumns({
        "__lang": effective_language(known, F.col(text), lowered), "__long": F.length(F.trim(text)) >= MIN_LENGTH})
    arabic = None if arabic_score is None else arabic_score(F.when(F.col("__lang") == "ar", F.col(text)))
    if groups is not None:
        scored = _score_in_row(routed, groups, text, arabic, lowered)
    elif method == "auto" and terms.count() <= broadcast_rows:
        scored = _score_by_lookup(routed, terms, text, arabic, lowered)
    else:
        scored = _score_by_join(routed, terms, text, arabic, lowered, broadcast_rows)
    label, score = classify_polarity("__polarity")
    return scored.select(
        *columns,
        F.when(F.col("__long"), label).otherwise("unknown").alias("sentiment"),
        F.when(F.col("__long"), score).otherwise(F.lit(0.0)).alias("sentiment_score"),
    )


def model_score(
    load: Callable[[], Callable[[list[str]], list[tuple[str, float]]]], on_missing: str = "raise"
) -> ArabicModel:
    """A pandas UDF around a user's classifier, loaded once per Python worker.

    ``load()`` returns a function from texts to (label, confidence).  Positive
    labels give the confidence, negative labels its opposite, others 0.  The classifier
    gets whole texts, and no nulls; those stay null.  A classifier that cannot be loaded stops the
    job; with ``on_missing="zero"`` it scores everything 0.
    """
    if on_missing not in ("raise", "zero"):
        raise ValueError("on_missing is 'raise' or 'zero'")

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        classify = None
        for texts in batches:
            out = pd.Series([None] * len(texts), dtype="float64")
            some = texts.notna().to_numpy().nonzero()[0]
            if len(some) and classify is None:
                try:
                    classify = load()
                except Exception:
                    if on_missing == "raise":
                        raise
                    classify = lambda rows: [("", 0.0)] * len(rows)
            if len(some):
                for i, (label, conf) in zip(some, classify(texts.iloc[some].tolist())):
                    name = label.lower()
                    out.iloc[i] = conf if "pos" in name else -conf if "neg" in name else 0.0
            yield out

    return score
