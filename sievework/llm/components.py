"""Connected components by alternating large-star and small-star steps.

After Kiveris, Lattanzi, Mirrokni, Rastogi and Vassilvitskii, "Connected Components in
MapReduce and Beyond" (SoCC 2014). Every step costs two shuffles of the edges; a node with
many edges is only ever aggregated, or joined through a broadcast of the few such nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.session import cut

#: A node with this many edges or more, and at least a two-thousandth of all, is joined by broadcast.
HUB_EDGES = 10_000


def _with_least(edges: DataFrame, least: DataFrame, n_edges: int) -> DataFrame:
    """Join ``least`` (u, m, degree) to ``edges`` (u, v) on u; hubs, at most 2,000, by broadcast."""
    limit = max(HUB_EDGES, n_edges // 2000)
    hubs = cut(least.filter(F.col("degree") >= limit).select("u", "m"))
    rest = least.filter(F.col("degree") < limit).select("u", "m")
    if hubs.isEmpty():
        return edges.join(rest, "u")
    few = F.broadcast(hubs)
    return edges.join(few, "u").unionByName(edges.join(few.select("u"), "u", "left_anti").join(rest, "u"))


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, component`` for every node of ``edges``; component is the least node in it.

    Edges with a null end are left out, loops only name their node. Least means the order of
    the column's type, for strings by code point. Empty edges give an empty result.
    """
    ends = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u is not null and v is not null")
    loops = ends.filter("u = v").select(F.col("u").alias("node")).distinct()
    pairs = cut(ends.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while True:
        n = pairs.count()
        # large star: of every node, link the larger neighbours to the least of all around it
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        around = cut(both.groupBy("u").agg(F.min("v").alias("low"), F.count("*").alias("degree")).select("u", F.least("u", "low").alias("m"), "degree"))
        large = cut(_with_least(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")), around, n).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())
        # small star: of every node, link itself and its smaller neighbours to the least of them
        below = cut(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("degree")))
        linked = _with_least(large, below, n).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(below.select("u", F.col("m").alias("v")))
        small = cut(linked.filter("u <> v").distinct())
        moved = small.join(pairs, ["u", "v"], "left_anti").isEmpty() and pairs.join(small, ["u", "v"], "left_anti").isEmpty()
        pairs = small
        if moved:
            break
    # now each edge leads from a node to its component's least node
    members = pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
    return cut(members.unionByName(loops.join(members, "node", "left_anti").select("node", F.col("node").alias("component"))))
