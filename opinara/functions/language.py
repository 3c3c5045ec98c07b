"""Language rules: script test, model decision, indicator-word fallback."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col
from .wordlists import ARABIC_BLOCK, ENGLISH_INDICATORS, FRENCH_INDICATORS


def _hits(text: Column, words: list[str]) -> Column:
    """How many of the words occur in the text, as substrings."""
    listed = F.array(*[F.lit(w) for w in words])
    return F.size(F.filter(listed, lambda w: F.contains(text, w)))


def language_by_indicators(c: Column | str, lowered: bool = False) -> Column:
    """``fr`` when French words lead, ``en`` when any English one occurs, else unknown.

    The one-element array binds the lower-cased text, so it is made once for all
    words.  The words stay data: a chain of twenty tests would compile into a
    method too large for the JIT.  ``lowered=True`` tells that the text is
    lower-case already.
    """

    def counts(text: Column) -> Column:
        return F.struct(
            _hits(text, FRENCH_INDICATORS).alias("fr"), _hits(text, ENGLISH_INDICATORS).alias("en")
        )

    def vote(n: Column) -> Column:
        return F.when(n["fr"] > n["en"], "fr").when(n["en"] > 0, "en").otherwise("unknown")

    text = F.coalesce(_col(c), F.lit(""))
    votes = F.transform(F.array(text if lowered else F.lower(text)), counts)
    return F.element_at(F.transform(votes, vote), 1)


def detect_language(
    c: Column | str,
    model_lang: Column | None = None,
    model_prob: Column | None = None,
    threshold: float = 0.7,
    lowered: bool = False,
) -> Column:
    """Language of a text: unknown, ar, fr, en or other.

    ``model_lang`` and ``model_prob`` come from a statistical model (see
    ``operators.language``); without them, or when the probability does not
    exceed ``threshold``, the indicator words decide.
    """
    text = F.trim(_col(c))
    out = (
        F.when(text.isNull() | (F.length(text) < 3), "unknown")
        .when(text.rlike(f"[{ARABIC_BLOCK}]"), "ar")
    )
    if model_lang is not None and model_prob is not None:
        out = out.when(
            model_prob > threshold,
            F.when(model_lang.isin("fr", "en"), model_lang).otherwise("other"),
        )
    return out.otherwise(language_by_indicators(c, lowered))
