"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrometry.llm.staging import staged


def _smallest(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("m"))


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """Rows (node, root) of all linked nodes but the roots; a root is the smallest node of its component.

    Large-star and small-star steps alternate until nothing changes.  Each step sends one row per link to the smallest
    neighbour of its end, which partial aggregates find, so a node with many links is no task of its own.
    """
    now = staged(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "links"
    )
    mark = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark or not seen[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = seen
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _smallest(both).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        nearest = _smallest(large)
        small = large.join(nearest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        now = staged(small.union(nearest.select("u", F.col("m").alias("v"))).distinct(), "links")
