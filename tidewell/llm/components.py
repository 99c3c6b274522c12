"""Connected components of a link table, by alternating large and small stars.

Each round is two partial-aggregated groupings and two joins; the link table
is written to the shared folder after every round, so a lost executor repeats
one round at most. Nothing is collected but counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import materialise


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.join(low, "a").where("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    low = links.groupBy("a").agg(F.min("b").alias("m"))
    inner = (links.join(low, "a").where("b <> m")
             .select(F.col("b").alias("a"), F.col("m").alias("b")))
    return inner.union(low.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``links`` (a, b: longs) -> (node, root): every linked node but the roots
    themselves, with the smallest node that it can reach.

    Loops and repeated links are ignored; an empty table gives an empty table.
    """
    links = materialise(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a <> b").distinct(), f"{name}-links")
    while not links.isEmpty():
        after = materialise(_small_star(_large_star(links)), f"{name}-links")
        # A star forest: every node hangs on one root, and no root hangs on another.
        chained = after.join(after.select(F.col("a").alias("b")), "b", "left_semi").limit(1).count()
        forked = after.groupBy("a").count().where("count > 1").limit(1).count()
        links = after
        if not chained and not forked:
            break
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
