"""Cleaned reviews to enriched reviews: language, then sentiment."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.lexicon import default_lexicon
from ..operators.language import add_language, default_language_model
from ..operators.sentiment import ArabicModel, analyze_sentiment


def enrich(
    cleaned: DataFrame, lexicon: DataFrame | None = None, model: DataFrame | None = None,
    arabic_score: ArabicModel | None = None, text: str = "final_text", lowered: bool = True,
) -> DataFrame:
    """Both steps run in the stage that reads the reviews when the lexicon is short.

    ``model`` is a table of ``fit_language_model``; the built-in one is used without.
    Cleaned text is lower-case; pass ``lowered=False`` for other text.
    """
    lexicon = default_lexicon(cleaned.sparkSession) if lexicon is None else lexicon
    model = default_language_model(cleaned.sparkSession) if model is None else model
    with_language = add_language(cleaned, text, model, lowered)
    return analyze_sentiment(with_language, lexicon, text, arabic_score=arabic_score, lowered=lowered)
