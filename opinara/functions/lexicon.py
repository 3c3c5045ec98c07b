"""A small built-in polarity lexicon.  Real deployments pass their own table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import LEXICON

# Polarity per term in [-1, 1]; English terms also carry an intensity.
POLARITY = {
    "fr": {
        "excellent": 1.0, "excellente": 1.0, "parfait": 1.0, "formidable": 0.9, "super": 0.7,
        "bon": 0.5, "bonne": 0.5, "agréable": 0.6, "aimable": 0.6, "accueillant": 0.6,
        "professionnel": 0.6, "efficace": 0.6, "rapide": 0.4, "recommande": 0.5, "satisfait": 0.6,
        "merci": 0.3, "mauvais": -0.6, "mauvaise": -0.6, "nul": -0.9, "nulle": -0.9,
        "horrible": -1.0, "catastrophique": -1.0, "lent": -0.4, "lente": -0.4, "incompétent": -0.8,
        "arnaque": -0.9, "déçu": -0.6, "déçue": -0.6, "honte": -0.8, "pire": -0.8,
    },
    "en": {
        "excellent": 1.0, "perfect": 1.0, "great": 0.8, "good": 0.7, "nice": 0.6, "friendly": 0.4,
        "helpful": 0.5, "best": 1.0, "love": 0.5, "happy": 0.8, "bad": -0.7, "terrible": -1.0,
        "awful": -1.0, "horrible": -1.0, "worst": -1.0, "hate": -0.8, "slow": -0.3, "rude": -0.3,
        "poor": -0.4, "worthless": -0.8,
    },
    "ar": {
        "ممتاز": 1.0, "ممتازة": 1.0, "رائع": 0.9, "رائعة": 0.9, "جيد": 0.6, "جيدة": 0.6,
        "أنصح": 0.5, "شكرا": 0.3, "سيء": -0.7, "سيئة": -0.7, "أسوأ": -1.0, "بطيء": -0.4,
    },
}
INTENSITY = {
    "excellent": 2.7, "perfect": 2.7, "great": 3.1, "good": 1.9, "nice": 1.8, "friendly": 2.2,
    "helpful": 1.8, "best": 3.2, "love": 3.2, "happy": 2.7, "bad": -2.5, "terrible": -2.1,
    "awful": -2.0, "horrible": -2.5, "worst": -3.1, "hate": -2.7, "slow": -0.8, "rude": -2.0,
    "poor": -2.1, "worthless": -1.9,
}


def default_lexicon(spark: SparkSession) -> DataFrame:
    """The built-in terms as rows of (lang, source, term, weight)."""
    rows = [(lang, "polarity", t, w) for lang, terms in POLARITY.items() for t, w in terms.items()]
    rows += [("en", "intensity", t, w) for t, w in INTENSITY.items()]
    structs = [
        F.struct(*[F.lit(v).alias(n) for v, n in zip(row, LEXICON.fieldNames())]) for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))
