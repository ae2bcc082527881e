"""Connected components by repeated contraction, with joins and minima only.

Each round every node takes the smallest neighbour (or itself), the edges are
rewritten to those heads and duplicates go, until no edge is left; a star, which
is what near copies form, takes one round.  Nothing is gathered per node, so a
hub may have any number of edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careledger.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root): every node of ``links`` (a, b) with the smallest node of its component."""
    edges = stored(links.select("a", "b").where("a <> b").distinct(), "component-edges")
    roots = None
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        heads = stored(both.groupBy("a").agg(F.min("b").alias("low"))
                       .select(F.col("a").alias("node"), F.least("a", "low").alias("head")), "component-heads")
        # A head may have a smaller head of its own: one jump halves such chains.
        jump = heads.select(F.col("node").alias("head"), F.col("head").alias("next"))
        heads = stored(heads.join(jump, "head").select("node", F.col("next").alias("head")), "component-heads")
        move = lambda df, col: (df.join(heads.withColumnRenamed("node", col), col, "left")
                                .withColumn(col, F.coalesce("head", col)).drop("head"))
        roots = heads.withColumnRenamed("head", "root") if roots is None else \
            move(roots, "root").select("node", "root")
        roots = stored(roots, "component-roots")
        edges = stored(move(move(edges, "a"), "b").where("a <> b").select("a", "b").distinct(), "component-edges")
    if roots is None:
        return links.select(F.col("a").alias("node"), F.col("a").alias("root")).limit(0)
    return roots
