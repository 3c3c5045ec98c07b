"""Text cleaning, validation and quality metrics as Column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .wordlists import ARABIC_BLOCK, FRENCH_ACCENTS, stop_words


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def words(
    c: Column | str, keep_numbers: bool = False, scripts: Iterable[str] = ("latin",), lowered: bool = False
) -> Column:
    """Maximal runs of kept letters (and digits) of the lower-cased text, as an array.

    Extracting the words is about five times faster than replacing everything
    else: Java matches the positive character class far better than its negation.
    Lower-casing accented text is slow too; ``lowered=True`` tells that the text
    is lower-case already.
    """
    text = _col(c) if lowered else F.lower(_col(c))
    kept = "a-zA-Z" + ("0-9" if keep_numbers else "") + FRENCH_ACCENTS
    if "arabic" in scripts:
        kept += ARABIC_BLOCK
    return F.regexp_extract_all(text, F.lit(f"[{kept}]+"), F.lit(0))


def is_valid_text(c: Column | str, min_length: int = 3, allow_numbers: bool = True) -> Column:
    """True for non-null text of at least ``min_length`` characters after trimming."""
    c = F.trim(_col(c))
    ok = c.isNotNull() & (c != "") & (F.length(c) >= min_length)
    if not allow_numbers:
        ok = ok & ~c.rlike(r"^[0-9\s]*$")
    return ok


def clean_text_basic(
    c: Column | str, keep_numbers: bool = False, scripts: Iterable[str] = ("latin",), lowered: bool = False
) -> Column:
    """Lower-cased letters separated by single spaces; null for null or blank text.

    ``scripts=("latin", "arabic")`` also keeps Arabic letters, which the default
    turns into spaces.
    """
    c = _col(c)
    return F.when(F.trim(c) != "", F.array_join(words(c, keep_numbers, scripts, lowered), " "))


def clean_text_no_digits(c: Column | str) -> Column:
    """Like ``clean_text_basic`` but digits vanish without leaving a gap."""
    c = _col(c)
    undigited = F.translate(c, "0123456789", "")
    return F.when(F.trim(c) != "", F.array_join(words(undigited), " "))


def normalize_text(
    c: Column | str,
    remove_stopwords: bool = True,
    min_length: int = 2,
    keep_numbers: bool = True,
    languages: Iterable[str] = ("fr", "ar", "en"),
    scripts: Iterable[str] = ("latin",),
    keep_negation: bool = False,
    extra_stop_words: Iterable[str] = (),
    lowered: bool = False,
) -> Column:
    """Clean text and drop the stop words of ``languages``.

    Text is null when blank or shorter than ``min_length``.  After cleaning only
    word characters and spaces are left, so word-boundary matching of a stop list
    is the same as dropping whole tokens; the ``isin`` becomes one hash probe per
    token.
    """
    c = _col(c)
    tokens = words(c, keep_numbers, scripts, lowered)
    if remove_stopwords:
        stops = list(dict.fromkeys(
            [w for lang in languages for w in stop_words(lang, keep_negation)]
            + list(extra_stop_words)
        ))
        tokens = F.filter(tokens, lambda t: ~t.isin(stops))
    size = F.length(F.trim(c))
    return F.when((size > 0) & (size >= min_length), F.array_join(tokens, " "))


def word_count(cleaned: Column | str) -> Column:
    """Number of space-separated words; 0 for null, null for an empty string."""
    c = F.trim(_col(cleaned))
    return F.when(c.isNull(), F.lit(0)).when(c != "", F.size(F.split(c, " ")))


def retention_percentage(cleaned: Column | str, original: Column | str) -> Column:
    """Share of characters kept by cleaning, in percent with two decimals."""
    kept, size = F.length(_col(cleaned)), F.length(_col(original))
    ratio = F.round(
        (kept * 100).cast("decimal(20,0)") / size.cast("decimal(20,0)"), 2
    ).cast("double")
    return F.when(size > 0, ratio).otherwise(F.lit(0.0))


def text_metrics(df: DataFrame, original: str, cleaned: str) -> DataFrame:
    """Add lengths before and after cleaning, retention and word count."""
    return df.select(
        "*",
        F.length(original).alias("original_length"),
        F.length(cleaned).alias("normalized_length"),
        retention_percentage(cleaned, original).alias("retention_percentage"),
        word_count(cleaned).alias("word_count"),
    )


def select_text(
    cleaned: Column | str, advanced: Column | str, retention: Column | str, words: Column | str
) -> Column:
    """Stop-word-free text for rich reviews, basic text for the others."""
    rich = (_col(retention) >= 60) & (_col(words) >= 3)
    return F.when(rich, _col(advanced)).otherwise(_col(cleaned))


def text_quality(retention: Column | str) -> Column:
    r = _col(retention)
    return F.when(r >= 70, "HIGH").when(r >= 50, "MEDIUM").otherwise("LOW")
