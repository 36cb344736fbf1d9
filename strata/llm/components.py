"""Connected components of a large graph by repeated contraction.

Each round every node points to its neighbour (or itself) of least rank, a
rank being the hash of the node's id; edges are rewritten to the nodes pointed
to, loops and repeats go, and the round's mapping is written to the shared
folder.  Random ranks make the graph shrink by a constant factor whatever its
shape, chains included.  A hot node costs nothing extra: neighbours are only
folded with ``min``, and joins can split its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import cut


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: bigint); nodes of one component share a root."""
    def rank(c):
        return F.struct(F.xxhash64(c).alias("r"), F.col(c).alias("id"))

    def tidy(e):
        return e.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    edges = cut(tidy(edges), "edges")
    mapping = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = both.groupBy("a").agg(F.min(rank("b")).alias("m"))
        to = cut(nearest.select(F.col("a").alias("node"), F.least(rank("a"), "m")["id"].alias("root")), "contraction")
        if mapping is None:
            mapping = to
        else:
            nxt = to.select(F.col("node").alias("root"), F.col("root").alias("further"))
            mapping = cut(mapping.join(nxt, "root", "left").select("node", F.coalesce("further", "root").alias("root")), "mapping")
        ends = to.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        moved = edges.join(ends, "a").join(ends.select(F.col("a").alias("b"), F.col("ra").alias("rb")), "b")
        edges = cut(tidy(moved.select(F.col("ra").alias("a"), F.col("rb").alias("b"))), "edges")
    if mapping is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return mapping
