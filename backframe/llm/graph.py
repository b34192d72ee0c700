"""Connected components of a graph of pairs, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backframe.session import stored


def star(edges: DataFrame, large: bool) -> DataFrame:
    """Links each node's larger (or smaller) neighbours to the least of them and itself.

    ``edges`` has a > b. The least neighbour of a node is a partial aggregate; no task gathers
    the neighbours of a node.
    """
    if large:
        around = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = around.groupBy("a").agg(F.min("b").alias("least")).select(
            "a", F.least("a", "least").alias("least")
        )
        linked = around.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("b"))
        others = edges.join(least.withColumnRenamed("b", "least"), "a")
        linked = others.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(least)
    return linked.where("a > b").distinct()


def components(pairs: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) of every node of the pairs (a, b), root being the least node it reaches.

    Large and small stars by turns: every round at least halves long paths, and ends with each
    node linked to its root. Each round is written to the shared folder, which cuts the lineage
    and survives lost executors. Pairs of equal nodes and repeated ones count for nothing; nulls
    are dropped; no pairs give no rows.
    """
    edges = stored(
        pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "components",
    )
    mark = F.struct(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("digest"))
    before = edges.agg(mark).first()
    if before[0]["n"]:
        for _ in range(rounds):
            edges = stored(star(star(edges, large=True), large=False), "components")
            now = edges.agg(mark).first()
            if now == before:
                break
            before = now
        else:
            raise RuntimeError("the components did not settle")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
