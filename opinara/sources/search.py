"""Search requests for collecting reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.wordlists import SEARCH_BANKS

# --- fixed value: where search requests go -----------------------------------
SEARCH_URL = "https://www.google.com/maps/search/"


def search_grid(
    cities: DataFrame, banks: list[str] = SEARCH_BANKS,
    base_url: str = SEARCH_URL,
) -> DataFrame:
    """One search request per (city, bank), with its query text and URL.

    ``cities`` has a ``city`` column.  Banks are a short list, so every city row
    simply expands in place.
    """
    query = F.concat_ws(" ", "bank_name", F.lit("agence"), "city", F.lit("Maroc"))
    return (
        cities.select("city", F.explode(F.array(*[F.lit(b) for b in banks])).alias("bank_name"))
        .withColumn("search_query", query)
        .withColumn(
            "search_url",
            F.concat(F.lit(base_url), F.replace("search_query", F.lit(" "), F.lit("+"))),
        )
    )
