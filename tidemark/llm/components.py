"""Connected components of a graph that is too large for one machine.

Each round maps every node to the neighbour (or itself) that is first in a random order of that round, and replaces the
edges by the edges between images.  Images of neighbours are neighbours or equal, so components stay whole, and a
random order shrinks long chains by a constant share in each round.  Sums and minima combine before their shuffle;
lookups read stored tables, so that a hub's rows are a skewed join, which Spark splits while it runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import forget, stored


def components(edges: DataFrame) -> DataFrame:
    """Of edges (a, b) of non-null longs: (node, root), one row for each node, the same root in one component."""
    e = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    maps: list[DataFrame] = []
    while not e.isEmpty():
        turn = F.lit(len(maps))
        ends = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = F.min(F.struct(F.xxhash64("b", turn).alias("h"), "b"))
        # a node stays where it is if it comes before its neighbours
        near = ends.groupBy("a").agg(first.alias("f")).withColumn("own", F.xxhash64("a", turn))
        to = F.when((F.col("own") < F.col("f.h")) | ((F.col("own") == F.col("f.h")) & (F.col("a") < F.col("f.b"))), F.col("a")).otherwise(F.col("f.b"))
        maps.append(stored(near.select(F.col("a").alias("node"), to.alias("root")), "map"))
        at = maps[-1]
        left = e.join(at.select(F.col("node").alias("a"), F.col("root").alias("x")), "a").select("x", "b")
        both = left.join(at.select(F.col("node").alias("b"), F.col("root").alias("y")), "b").where("x <> y")
        after = stored(both.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        forget(e)
        e = after
    if not maps:
        return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = maps.pop()
    while maps:
        earlier = maps.pop()
        more = out.select(F.col("node").alias("root"), F.col("root").alias("top"))
        # an image without edges in the next round has no row there: it is a root
        joined = stored(earlier.join(more, "root", "left").select("node", F.coalesce("top", "root").alias("root")), "map")
        forget(earlier, out)
        out = joined
    return out
