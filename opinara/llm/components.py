"""Connected components of a table of links by repeated contraction; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import write_once


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links(a, b)``; equal labels: connected.

    Each round every node moves to its neighbour first in a hashed order (or stays), and
    then on to where that one moves; links between different places remain.  The hashed
    order makes the number of rounds logarithmic for any shape, chains included.  Minima
    are combined before the shuffle, so a node with very many links is no burden.
    """
    first = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("at"))
    edges = write_once(links.filter("a <> b").select("a", "b").distinct(), "links")
    labels = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().withColumn("label", F.col("node"))
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
        moves = (
            both.groupBy("a").agg(F.min(first("b")).alias("near"))
            .select("a", F.least(first("a"), "near")["at"].alias("to"))
        )
        moves = write_once(moves, "moves")
        onward = moves.select(F.col("a").alias("to"), F.col("to").alias("then"))
        moves = moves.join(onward, "to").select("a", F.col("then").alias("to"))
        moves = write_once(moves, "moves")
        labels = write_once(
            labels.join(moves.withColumnRenamed("a", "label"), "label", "left")
            .select("node", F.coalesce("to", "label").alias("label")), "labels")
        edges = write_once(
            edges.join(moves, "a").select(F.col("to").alias("a"), "b")
            .join(moves.select(F.col("a").alias("b"), F.col("to").alias("c")), "b").select("a", F.col("c").alias("b"))
            .filter("a <> b").distinct(), "links")
    return labels
