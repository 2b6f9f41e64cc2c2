"""Connected components by large-star and small-star rounds of joins and map-side minima.

Each round is a few shuffles of the edges; no node's neighbours are ever gathered in one row or task: a node with
very many edges is a skewed key of a plain join, and its minimum is taken map-side. The minima are written before
they are joined: Spark splits a skewed key only if both sides of the join are shuffled for it alone. Rounds grow with the logarithm
of the number of nodes. Edges are written to the shared folder after each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockyard.llm.shared import discard, stored


def _large_star(edges: DataFrame, made: list[DataFrame]) -> DataFrame:
    """Links every larger neighbour of a node to the least of the node and its neighbours."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")).withColumnRenamed("a", "u")
    least = stored(least, "components-least")
    made.append(least)
    up = both.where(F.col("b") > F.col("a"))
    return up.join(least.hint("merge"), F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame, made: list[DataFrame]) -> DataFrame:
    """Links a node and its smaller neighbours to the least of them; edges are (larger, smaller)."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
    least = stored(least, "components-least")
    made.append(least)
    down = edges.join(least.hint("merge"), F.col("a") == F.col("u")).where(F.col("b") > F.col("m"))
    return down.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u"), F.col("m")))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """node, root: the least node of its component, for every node with an edge in `edges` (a, b; both bigint).

    Edges from a node to itself and repeated edges change nothing. No edges: no rows.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    edges, last = stored(edges, name), None
    while True:
        made = [edges]
        edges = stored(_small_star(_large_star(edges, made).distinct(), made).distinct(), name)
        discard(*made)  # a round's tables are not read after it
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == last:
            break
        last = state
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
