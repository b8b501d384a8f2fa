"""Connected components of a graph given by its links, by alternating large and small stars.

Each round attaches every node's larger neighbours, and then all its smaller ones, to the
smallest node it sees (Kiveris and others, 2014); the number of rounds grows with the square of
the logarithm of the largest component at most. Every step is a grouped minimum, combined before
the shuffle, and a join of two written tables, which Spark splits where one node has most links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of every node that has a link to another; ``links`` has the ends as
    (a, b), of any orderable type, in any order and with repeats. The component is its smallest
    node, which is listed too. Loops and null ends are no links."""
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = written(links, "links")
    state = _state(links)
    while state[0]:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("n")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
        least = written(least, "large-star")
        # Large star: larger neighbours go to the smallest node around.
        large = both.where("b > a").join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.distinct(), "large-star-links")
        # Small star: the node and its smaller neighbours go to the smallest of these.
        least = written(large.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m")), "small-star")
        joined = large.join(least, F.col("a") == F.col("n"))
        small = joined.select("a", F.col("m").alias("b")).unionByName(
            joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        links = written(small.distinct(), "links")
        before, state = state, _state(links)
        if state == before:
            break
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
