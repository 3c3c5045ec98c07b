"""Hash keys of reviews and dimension rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col
from .wordlists import KEY_NULL_TOKEN


def review_id(bank: Column | str, branch: Column | str, date: Column | str, text: Column | str) -> Column:
    """md5 of bank, branch, date and cleaned text written one after another."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit("")) for c in (bank, branch, date, text)]
    return F.md5(F.concat(*parts))


def surrogate_key(*cols: Column | str) -> Column:
    """md5 of the columns as text joined by ``-``; null has its own token."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(KEY_NULL_TOKEN)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def score_text(c: Column | str) -> Column:
    """A three-decimal score as its shortest plain text (0.5, -0.125, 0)."""
    fixed = _col(c).cast("decimal(18,3)").cast("string")
    return F.regexp_replace(fixed, r"\.?0+$", "")
