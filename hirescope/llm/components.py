"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirescope.llm.common import materialise


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Label every vertex of ``edges(u, v)`` with its component's least vertex.

    Alternates the two star contractions (each vertex hooks its larger, then
    its smaller neighbours to the least vertex it sees), which needs
    O(log n) rounds in practice.  Neighbourhoods are only ever reduced to
    their minimum (combined before the shuffle) and joined back, so a vertex
    with very many links is never gathered in one row.  Every round's links
    are written to the shared folder; nothing but one count per round comes
    to the driver.  Self links and nulls are ignored; an empty table gives an
    empty result.  Returns ``vertex, component``.
    """
    e = (edges.where("u <> v")
         .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    e = materialise(e)
    for _ in range(max_rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("n")).select("u", F.least("u", "n").alias("m"))
        large = (both.where("v > u").join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        new = materialise(small)
        # Stable when every vertex has one link and no parent has a parent.
        deep = new.groupBy("u").count().where("count > 1").select("u").union(
            new.select(F.col("v").alias("u")).join(new.select("u"), "u", "left_semi"))
        e = new
        if deep.isEmpty():
            break
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("v").alias("vertex")).distinct().select("vertex", F.col("vertex").alias("component"))
    return e.select(F.col("u").alias("vertex"), F.col("v").alias("component")).union(roots)
