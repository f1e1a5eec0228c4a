"""Connected components of a link table, by alternating star contractions.

Every round groups with a map-side minimum and joins back, so a node with
very many links is never gathered anywhere.  Each round's links are written
to the shared folder; rounds end when the link table no longer changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martflow.llm.frames import written


def _signature(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def _downhill(links: DataFrame) -> DataFrame:
    return (links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            .where("a <> b").distinct())


def components(links: DataFrame) -> DataFrame:
    """``links`` (a long, b long) -> (node, root) for every node that has a
    link to another one; root is the smallest node that it reaches.

    Rows with a null or with a = b are no links; repeated and reversed rows
    count once; an empty table gives an empty result.
    """
    links = written(_downhill(links.where("a is not null and b is not null")), "links")
    before = None
    now = _signature(links)
    while now != before:
        links = written(_downhill(_small_star(_downhill(_large_star(links)))), "links")
        before, now = now, _signature(links)
    # stars only: every node points at its root
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
