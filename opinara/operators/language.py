"""Statistical language model: letter trigrams with integer weights, kept as a table.

A model is a table (trigram, language, weight): the logarithm of a trigram's smoothed share
in a language, in thousandths.  Sums over a text are whole numbers, so any engine that reads
the table gives the same scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.language import detect_language
from ..functions.samples import SAMPLES
from ..sources.scratch import write_once

# Overlapping trigrams count as about this many independent ones.
EVIDENCE = 40
WEIGHT_UNIT = 1000
#: Trigrams in a model, and so its rows per language, whatever the table it is fitted on.
TRIGRAMS = 20_000
MAX_LANGUAGES = 200

MODEL = "trigram string, language string, weight bigint"


def spaced_text(text: Column) -> Column:
    """Lower-cased text with single spaces, one before and one after it; empty for null."""
    plain = F.lower(F.trim(F.coalesce(text, F.lit(""))))
    return F.concat(F.lit(" "), F.regexp_replace(plain, r"\s+", " "), F.lit(" "))


def trigrams(text: Column) -> Column:
    """Overlapping three-letter windows of the spaced text, in linear time."""
    return F.regexp_extract_all(spaced_text(text), F.lit("(?=(...))"), F.lit(1))


def fit_language_model(
    labelled: DataFrame, text: str = "text", label: str = "lang", size: int = TRIGRAMS
) -> DataFrame:
    """The model of a table of texts of known language, written once.

    Occurrences are counted map-side per language; the ``size`` trigrams most frequent in all
    languages together (ties to the smaller one) make the model.  Null labels and texts of
    fewer than three letters are left out.
    """
    known = labelled.filter((F.length(F.trim(text)) >= 3) & F.col(label).isNotNull())
    counts = write_once(
        known.select(F.col(label).alias("language"), F.explode(trigrams(F.col(text))).alias("trigram"))
        .groupBy("language", "trigram").agg(F.count("*").alias("n")), "trigram_counts")
    languages = [r["language"] for r in counts.select("language").distinct().limit(MAX_LANGUAGES + 1).collect()]
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"{label} has more than {MAX_LANGUAGES} values")
    kept = counts.groupBy("trigram").agg(F.sum("n").alias("total")).orderBy(F.col("total").desc(), "trigram").limit(size)
    kept = write_once(kept.select("trigram"), "trigrams")
    sums = write_once(counts.join(F.broadcast(kept), "trigram"), "trigram_counts")  # at most ``size`` rows
    total = sums.groupBy("language").agg(F.sum("n").alias("total"))
    totals = {r["language"]: r["total"] for r in total.collect()}
    smooth = kept.count() + 1
    each = F.explode(F.array(*[
        F.struct(F.lit(x).alias("language"), F.lit(totals.get(x, 0) + smooth).alias("of")) for x in sorted(languages)
    ] or [F.struct(F.lit(None).cast("string").alias("language"), F.lit(1).alias("of"))])).alias("l")
    weight = F.round(F.log((F.coalesce("n", F.lit(0)) + 1) / F.col("of")) * WEIGHT_UNIT).cast("bigint").alias("weight")
    dense = kept.select("trigram", each).select("trigram", "l.*").join(sums, ["trigram", "language"], "left")
    return write_once(dense.filter("language IS NOT NULL").select("trigram", "language", weight), "language_model")


def default_language_model(spark: SparkSession) -> DataFrame:
    """The model of the built-in sample sentences."""
    rows = [(text, lang) for lang, text in SAMPLES.items()]
    return fit_language_model(spark.createDataFrame(rows, "text string, lang string"))


def _windows(points: np.ndarray) -> np.ndarray:
    """A number for each three consecutive code points."""
    p = points.astype(np.int64)
    return p[:-2] << 42 | p[1:-1] << 21 | p[2:]


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def model_vote(text: Column, model: DataFrame) -> Column:
    """(model_lang, model_prob) of a text, computed where the text is.

    The model has at most ``TRIGRAMS`` rows per language and reaches the workers as
    arrays.  Of languages with equal sums the first by name is taken.  Posteriors saturate
    because overlapping trigrams are not independent, so the sum counts as that of at most
    ``EVIDENCE`` trigrams before it becomes a probability.  A text without any trigram of the
    model has no language and probability 0.
    """
    table = model.toArrow().to_pandas()
    languages = sorted(table["language"].unique())
    grams = {g: _windows(_points(g))[0] for g in table["trigram"].unique() if len(g) == 3}
    keys = np.array(sorted(grams.values()), np.int64)
    weights = np.zeros((len(keys), len(languages)), np.int64)
    row = np.searchsorted(keys, table["trigram"].map(grams).to_numpy(np.int64)) if len(table) else np.empty(0, np.int64)
    column = np.searchsorted(languages, table["language"].to_numpy(str)) if len(table) else np.empty(0, np.int64)
    weights[row, column] = table["weight"].to_numpy()
    shared = model.sparkSession.sparkContext.broadcast((keys, weights, languages))

    def vote(one: str) -> tuple[str | None, float]:
        keys, weights, languages = shared.value
        points = _points(one)
        if len(points) < 3 or not len(keys):
            return None, 0.0
        found = _windows(points)
        at = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
        at = at[keys[at] == found]
        if not len(at):
            return None, 0.0
        sums = np.bincount(at, minlength=len(keys)) @ weights
        best = int(sums.argmax())
        scale = min(len(at), EVIDENCE) / len(at) / WEIGHT_UNIT
        return languages[best], float(1.0 / np.exp((sums - sums[best]) * scale).sum())

    @F.pandas_udf("model_lang string, model_prob double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([vote(t) for t in texts], columns=["model_lang", "model_prob"])

    return score(spaced_text(text))


def apply_language_model(df: DataFrame, model: DataFrame, text: str = "final_text") -> DataFrame:
    """Add ``model_lang`` and a calibrated ``model_prob``; nothing is shuffled."""
    scored = df.withColumn("__vote", model_vote(F.col(text), model))
    return scored.select(*df.columns, F.col("__vote.model_lang").alias("model_lang"), F.col("__vote.model_prob").alias("model_prob"))


def add_language(
    df: DataFrame, text: str = "final_text", model: DataFrame | None = None, lowered: bool = False
) -> DataFrame:
    """Add ``language``; without a model the indicator words decide."""
    scored = df if model is None else apply_language_model(df, model, text)
    votes = () if model is None else (F.col("model_lang"), F.col("model_prob"))
    return scored.select(*df.columns, detect_language(text, *votes, lowered=lowered).alias("language"))
