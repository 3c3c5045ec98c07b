"""Review de-duplication and top-k rows per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def top_k_per_group(
    df: DataFrame, keys: list[str | Column], order: list[Column], k: int, rank_col: str | None = None
) -> DataFrame:
    """The first ``k`` rows of every group in the given order.

    The row-number filter lets Spark cut every group to ``k`` rows inside each map
    task before the shuffle, so a hot group costs no more than any other.
    """
    name = rank_col or "__rank"
    out = (
        df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
        .filter(F.col(name) <= k)
    )
    return out if rank_col else out.drop(name)


def text_key(c: Column | str) -> Column:
    """Fixed-size stand-in for a long text in partition keys."""
    return F.sha2(c, 256)


def _key_parts() -> list[Column]:
    norm = lambda name: F.lower(F.trim(F.col(name)))
    return [text_key(norm("review_text")), norm("branch_name"), norm("bank_name"), F.col("review_date")]


def review_key() -> Column:
    """Hash of bank, branch, text (case and padding ignored) and date; nulls differ from all texts."""
    part = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-"))
    return text_key(F.concat_ws("\u0001", *map(part, _key_parts())))


def preference() -> Column:
    """What ``dedup_reviews`` orders by: of two rows with one key the smaller stays."""
    first = [F.when(F.col(c).isNotNull(), 1).otherwise(2) for c in ("review_rating", "bank_rating")]
    rest = ["review_rating", "bank_rating", "bank_location", "bank_name", "branch_name", "review_text"]
    return F.struct(*[c.alias(f"p{i}") for i, c in enumerate([*first, *map(F.col, rest)])])


def dedup_reviews(df: DataFrame) -> DataFrame:
    """Keep one review per bank, branch, text (case and padding ignored) and date.

    Rated rows win over unrated ones, then rows with a bank rating; remaining
    ties are settled by the other columns, so the result does not depend on row
    order.  Text enters the shuffle key as a hash, first, because it is the most
    selective part of the sort key.
    """
    return top_k_per_group(df, _key_parts(), [preference()], 1)


def cap_links(links: DataFrame, keys: list[str], position: str, url: str, k: int = 5) -> DataFrame:
    """First ``k`` links of every search by position, then without repeats."""
    first = top_k_per_group(links, keys, [F.col(position)], k)
    return (
        first.groupBy(*keys, url).agg(F.min(position).alias(position))
    )
