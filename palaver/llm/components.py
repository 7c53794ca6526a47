"""Connected components of a graph whose edges are a DataFrame."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.workspace import write_once


def connected_components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (the smallest node reached) of every node of ``edges`` (bigint columns ``a``, ``b``).

    Each round links every larger neighbour of a node, and then every smaller one, to the smallest; the number of rounds
    is logarithmic in practice. A node's neighbours are never gathered: a minimum per node is what is shuffled, so a
    node with a third of all links is reduced on the map side. Nulls and loops are ignored; no edges give no rows.
    """
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    links, before = write_once(links, "links"), None
    while True:
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(smallest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        links = write_once(small.where("u <> v").distinct(), "links")
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    stars = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionAll(stars.select(F.col("component").alias("node"), "component").distinct())
