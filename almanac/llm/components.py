"""Connected components of an edge table, by hooking and pointer jumping.

Each round points every node at its smallest neighbour if that is smaller, follows
the pointers to their ends, and replaces the nodes of every edge by those ends;
edges inside one tree vanish.  What is left is a smaller graph; the number of
rounds is logarithmic.  Every table is written before it is joined, so both sides of a join are
plain scans and a node with very many neighbours can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.staging import stage


def _ends(parents: DataFrame) -> DataFrame:
    """(node, parent) with every pointer followed to its end."""
    while True:
        above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        jumped = stage(
            parents.join(above, "parent", "left").select(
                "node", F.coalesce("above", "parent").alias("parent"),
                (F.col("above") < F.col("parent")).alias("moved"),
            ),
            "jumped",
        )
        parents = jumped.select("node", "parent")
        if jumped.where("moved").limit(1).count() == 0:
            return parents


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the component's smallest node.

    Self loops, repeated edges and either direction are allowed; an edge with a null end is left out.
    """
    left = stage(edges.where("a <> b").select("a", "b").distinct(), "edges")
    roots = None
    while left.limit(1).count():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = both.groupBy("a").agg(F.min("b").alias("b")).select(
            F.col("a").alias("node"), F.least("a", "b").alias("parent")
        )
        ends = _ends(stage(parents, "parents"))
        a, b = (ends.select(F.col("node").alias(x), F.col("parent").alias(f"{x}_end")) for x in ("a", "b"))
        half = stage(left.join(a, "a").select(F.col("a_end").alias("a"), "b"), "edges")
        left = stage(
            half.join(b, "b").select("a", F.col("b_end").alias("b")).where("a <> b").distinct(), "edges"
        )
        if roots is None:
            roots = ends.select("node", F.col("parent").alias("root"))
        else:
            moved = ends.select(F.col("node").alias("root"), F.col("parent").alias("new"))
            roots = stage(
                roots.join(moved, "root", "left").select("node", F.coalesce("new", "root").alias("root")), "roots"
            )
    if roots is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots
