"""Connected components of a graph given as links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.session import materialize


def _stars(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step. Each node's smallest neighbour comes from a partial
    aggregate and is joined back, so a node with very many links is split like any skewed join."""
    ends = F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))
    both = links.select(F.inline(ends))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    large = both.join(least, "u").filter("v > u and v <> m").select("v", "m")
    down = large.toDF("u", "v")
    lowest = down.groupBy("u").agg(F.min("v").alias("m"))
    each = F.array(F.struct(F.col("v").alias("a"), F.col("m").alias("b")), F.struct(F.col("u").alias("a"), F.col("m").alias("b")))
    return down.join(lowest, "u").select(F.inline(each)).filter("a <> b").distinct()


def _is_star(links: DataFrame) -> bool:
    """Whether every node that is no centre has one centre."""
    again = links.groupBy("a").count().filter("count > 1")
    centres = links.select(F.col("b").alias("a")).distinct()
    return again.isEmpty() and links.join(centres, "a", "left_semi").isEmpty()


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(id, component) of every linked id but the components' own; the component is its smallest id.

    ``links`` are pairs (a, b). Every step is written to the shared folder. It ends when the links form
    stars, after a number of steps that grows with the logarithm of the longest chain.
    """
    now = materialize(_stars(links.filter("a <> b").select("a", "b")), name)
    while not _is_star(now):
        now = materialize(_stars(now), name)
    return now.toDF("id", "component")
