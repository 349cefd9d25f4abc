"""Connected components by hooking, pointer jumping and contraction, on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldlog.staging import stage


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links`` (a, b): the smallest id that links lead to.

    Each round hooks every node to its smallest neighbour, shortens the chains that this makes and
    contracts the links; a star is one node after one round, a chain shrinks to a quarter. A node
    with many links is pre-aggregated for hooking and split by adaptive execution in joins.
    """
    edges = stage(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )
    found: DataFrame | None = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        parent = stage(
            both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("p")), "parents"
        )
        for _ in range(2):
            above = parent.select(F.col("u").alias("p"), F.col("p").alias("pp"))
            parent = parent.join(above, "p").select("u", F.col("pp").alias("p"))
        parent = stage(parent, "parents")
        first, second = parent.toDF("u", "pu"), parent.toDF("v", "pv")
        edges = stage(
            edges.join(first, "u")
            .join(second, "v")
            .where("pu <> pv")
            .select(F.greatest("pu", "pv").alias("u"), F.least("pu", "pv").alias("v"))
            .distinct(),
            "edges",
        )
        if found is None:
            found = parent.toDF("id", "component")
        else:
            root = parent.toDF("component", "p")
            found = stage(
                found.join(root, "component", "left").select("id", F.coalesce("p", "component").alias("component")),
                "components",
            )
    if found is None:
        return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return found
