"""Rating parsing and repair as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col


def parse_decimal_comma(c: Column | str, precision: int = 3, scale: int = 2) -> Column:
    """``"4,5"`` -> 4.50.  Text that does not fit the decimal type becomes null."""
    text = F.replace(_col(c).cast("string"), F.lit(","), F.lit("."))
    return text.try_cast(f"decimal({precision},{scale})")


def clamp_rating(c: Column | str) -> Column:
    """Pull ratings into 1..5; null stays null."""
    c = _col(c)
    return F.when(c > 5, F.lit(5)).when(c < 1, F.lit(1)).otherwise(c)


def impute_rating(
    own: Column, bank_avg: Column, bank_count: Column, global_avg: Column, min_count: int = 3
) -> tuple[Column, Column]:
    """(rating, source): own value, else bank average, else global average, else 3.

    A bank average counts only when at least ``min_count`` ratings stand behind it.
    """
    from_bank = bank_avg.isNotNull() & (bank_count >= min_count)
    rating = (
        F.when(own.isNotNull(), own.cast("double"))
        .when(from_bank, F.round(bank_avg, 1))
        .when(global_avg.isNotNull(), F.round(global_avg, 1))
        .otherwise(F.lit(3.0))
    )
    source = (
        F.when(own.isNotNull(), "ORIGINAL")
        .when(from_bank, "BANK_AVERAGE")
        .when(global_avg.isNotNull(), "GLOBAL_AVERAGE")
        .otherwise("DEFAULT")
    )
    return rating, source


def impute_bank_rating(own: Column, bank_avg: Column, global_avg: Column) -> Column:
    """Own value inside 0..5, else bank average, else global average, else 3."""
    return (
        F.when(own.between(0, 5), own.cast("double"))
        .when(bank_avg.isNotNull(), F.round(bank_avg, 1))
        .when(global_avg.isNotNull(), F.round(global_avg, 1))
        .otherwise(F.lit(3.0))
    )
