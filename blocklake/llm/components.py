"""Connected components of an edge table by random-mate contraction, all in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blocklake.llm.common import materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of `edges`; component is the smallest node reachable.

    Each round maps a node to the member of its closed neighbourhood with the smallest per-round hash and
    relabels the edges, so about two thirds of the nodes go per round whatever the graph's shape (long chains
    as well as hubs); rounds grow with the logarithm of the nodes. Hubs collapse map-side in the min. The map
    of each round is written to the shared folder. Nulls and self loops are ignored; an empty table gives none.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL AND u != v")
    e = materialize(e.distinct(), "edges")
    maps: list[DataFrame] = []
    while not e.isEmpty():
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        salt = F.lit(len(maps))
        rank = lambda c: F.struct(F.xxhash64(F.col(c), salt).alias("h"), F.col(c).alias("id"))
        m = both.groupBy("u").agg(F.least(F.min(rank("v")), F.min(rank("u")))["id"].alias("to"))
        m = materialize(m.select(F.col("u").alias("node"), "to"), "mates")
        maps.append(m)
        left = m.select(F.col("node").alias("u"), F.col("to").alias("u2"))
        right = m.select(F.col("node").alias("v"), F.col("to").alias("v2"))
        e = e.join(left, "u").join(right, "v").where("u2 != v2").select(
            F.least("u2", "v2").alias("u"), F.greatest("u2", "v2").alias("v")).distinct()
        e = materialize(e, "edges")
    if not maps:
        return edges.select(F.col(a).alias("node"), F.col(a).alias("component")).limit(0)
    labels = maps[0].select("node", F.col("to").alias("at"))
    for m in maps[1:]:
        labels = labels.join(m.select(F.col("node").alias("at"), "to"), "at", "left").select(
            "node", F.coalesce("to", "at").alias("at"))
    labels = materialize(labels, "labels")
    least = labels.groupBy("at").agg(F.min("node").alias("component"))
    return labels.join(least, "at").select("node", "component")
