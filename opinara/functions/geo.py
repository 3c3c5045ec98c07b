"""City and region from free-text addresses."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import _col
from .wordlists import CITY_RULES, REGION_RULES, UNKNOWN_REGION


def raw_city(address: Column | str) -> Column:
    """Text after the last comma; null when the address has no comma."""
    a = _col(address)
    tail = F.regexp_replace(F.substring_index(a, ",", -1), r"^\s+", "")
    return F.when(F.instr(a, ",") > 0, F.trim(tail))


def _ladder(lowered: Column, rules, default: Column) -> Column:
    """First rule whose spelling occurs in ``lowered``."""
    out = None
    for spellings, value in rules:
        hit = reduce(lambda x, y: x | y, [F.contains(lowered, F.lit(s.lower())) for s in spellings])
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out.otherwise(default)


ACCENTS, PLAIN = "àâäçéèêëîïôöùûü", "aaaceeeeiioouuu"


def fold_accents(text: Column) -> Column:
    return F.translate(text, ACCENTS, PLAIN)


def _folded(rules) -> list:
    plain = str.maketrans(ACCENTS, PLAIN)
    return [([s.lower().translate(plain) for s in spellings], value) for spellings, value in rules]


def city(raw: Column | str, rules=CITY_RULES) -> Column:
    """Canonical city of a city name, ignoring case; unknown names pass through."""
    raw = _col(raw)
    return _ladder(F.lower(raw), rules, raw)


def region(name: Column | str, rules=REGION_RULES) -> Column:
    """Region of a city name."""
    return _ladder(F.lower(_col(name)), rules, F.lit(UNKNOWN_REGION))


def with_place(df: DataFrame, address: str, region_from_city: bool = False) -> DataFrame:
    """Add ``city`` and ``region`` of an address.

    The region rules know fewer spellings than the city rules; by default they
    read the city as written, with ``region_from_city=True`` the canonical city without
    its accents, as the rules spell a city with or without them.  The rules run on a column of their own, so the city text is cut out once per
    row and not once per rule.
    """
    raw, low = F.col("__raw_city"), F.col("__low_city")
    named = df.withColumn("__raw_city", raw_city(address)).withColumn("__low_city", F.lower(raw))
    named = named.withColumn("city", _ladder(low, CITY_RULES, raw))
    rules = REGION_RULES
    if region_from_city:
        named, rules = named.withColumn("__low_city", fold_accents(F.lower("city"))), _folded(REGION_RULES)
    placed = named.withColumn("region", _ladder(low, rules, F.lit(UNKNOWN_REGION)))
    return placed.drop("__raw_city", "__low_city")
