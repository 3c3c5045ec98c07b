"""Relative French dates and date text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col

# --- fixed values: units in days, and the five patterns in matching order ---
UNIT_DAYS = [("jour", 1), ("semaine", 7), ("mois", 30), ("an", 365)]
RELATIVE_PATTERNS = [
    r"il y a (\d+)\s*(jour|jours|mois|semaine|semaines|an|ans|année|années)",
    r"il y a (une?|un)\s*(semaine|mois|an|année)",
    r"(\d+)\s*(jour|jours|mois|semaine|semaines|an|ans|année|années)",
    r"(une?|un)\s*(semaine|mois|an|année)",
]
DAY_WORDS = r"(hier|aujourd'hui|today|yesterday)"
# The patterns of ``extended=True``.
EXTENDED_PATTERNS = [
    r"(\d+)\s*(jour|jours|mois|semaine|semaines|an|ans|année|années|heures?|minutes?|secondes?)",
    r"(une?|un)\s*(jour|semaine|mois|an|année|heures?|minutes?|secondes?)",
]


def relative_days(c: Column | str, extended: bool = False) -> Column:
    """Age in days told by a relative date such as ``il y a 3 mois``; else null.

    ``extended=True`` also reads "un jour" and hours or minutes (0 days).
    """
    text = F.translate(F.trim(F.lower(_col(c))), ",.", "")
    units = UNIT_DAYS
    patterns = RELATIVE_PATTERNS
    if extended:
        units = units + [("heure", 0), ("minute", 0), ("seconde", 0)]
        patterns = EXTENDED_PATTERNS

    def days(pattern: str) -> Column:
        count = F.regexp_extract(text, pattern, 1)
        unit = F.regexp_extract(text, pattern, 2)
        number = F.when(count.isin("un", "une"), F.lit(1)).otherwise(count.try_cast("int"))
        size = None
        for prefix, n in units:
            hit = unit.startswith(prefix)
            size = F.when(hit, F.lit(n)) if size is None else size.when(hit, F.lit(n))
        return number.cast("bigint") * size

    word = F.regexp_extract(text, DAY_WORDS, 1)
    named = F.when(word.isin("hier", "yesterday"), F.lit(1)).when(word != "", F.lit(0))
    return F.coalesce(*[days(p) for p in patterns], named.cast("bigint"))


def parse_relative_date(c: Column | str, as_of: Column | str, extended: bool = False) -> Column:
    """The date a relative text points at, seen from ``as_of``; null if unreadable."""
    n = relative_days(c, extended)
    as_of = F.lit(as_of) if isinstance(as_of, str) else as_of
    day = as_of.cast("date")
    # Ages that reach before year 1 have no date.
    oldest = F.datediff(day, F.lit("0001-01-01").cast("date"))
    return F.when(n <= oldest, F.date_sub(day, n.cast("int")))


def date_text(c: Column | str) -> Column:
    """A date or date-like text as ``yyyy-MM-dd``."""
    return F.date_format(_col(c).try_cast("date"), "yyyy-MM-dd")
