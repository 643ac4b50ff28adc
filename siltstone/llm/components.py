"""Connected components of a links table, by alternating large-star and small-star rounds (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import gathered, stored


def _stars(edges: DataFrame, large: bool, rows: int) -> DataFrame:
    """Each node's neighbours beyond it (large) or up to it (small) move to the least node of the star."""
    e = edges if not large else edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = e.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    if large:  # a node with very many neighbours is the lesser end of its edges, so only here it is one key
        least = stored(gathered(least, rows), "least")
    if large:
        moved = e.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = e.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return moved.where("u > v").distinct()


def components(edges: DataFrame, at_most: int | None = None) -> DataFrame:
    """(node, component) for nodes of edges (u, v); component is the least node that can be reached, itself excluded from the rows.
    at_most: how many edges there are at most, if known, so that few are written to few files.

    Each round writes its edges and the least neighbours of large stars to the shared folder. Skew: the aggregate is combined
    on the map side and a large star's rows meet by node in a join of written tables, which adaptive execution can split; it
    doesn't split one that shares its stage with an aggregate. Rounds grow with the logarithm of a component.
    """
    hi, lo = F.greatest("u", "v"), F.least("u", "v")
    now = edges.where("u <> v").select(hi.alias("u"), lo.alias("v")).distinct()
    now = stored(now if at_most is None else gathered(now, at_most), "links")
    mark, rows = None, now.count()
    while True:
        now = stored(gathered(_stars(_stars(now, True, rows), False, rows), rows), "stars")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        mark = tuple(seen)
