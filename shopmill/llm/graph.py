"""Connected components of an edge list, by contraction in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shopmill.llm import store


def components(edges: DataFrame) -> DataFrame:
    """``id, root`` for every end of an edge ``a, b``; ends have one root if a path joins them.

    In each round every node moves to the least of itself and its neighbours,
    in an order drawn anew, so that the number of nodes that still have edges
    falls by a constant factor whatever the shape; the edges are written to
    the shared folder after each round. Repeated edges and loops do no harm.
    """
    spark = edges.sparkSession
    edges = store.settle(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).distinct(), "edges")
    label, turn = None, 0
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        both = both.unionByName(both.select("a", F.col("a").alias("b")))
        rank = F.struct(F.xxhash64("b", F.lit(turn)).alias("rank"), F.col("b").alias("id"))
        move = store.settle(both.groupBy(F.col("a").alias("id")).agg(F.min(rank)["id"].alias("root")), "moves")
        if label is None:
            label = move
        else:
            after = move.select(F.col("id").alias("root"), F.col("root").alias("next"))
            label = store.settle(
                label.join(after, "root", "left").select("id", F.coalesce("next", "root").alias("root")), "labels"
            )
        to_a = move.select(F.col("id").alias("a"), F.col("root").alias("left"))
        to_b = move.select(F.col("id").alias("b"), F.col("root").alias("right"))
        moved = edges.join(to_a, "a").join(to_b, "b").where("left <> right")
        pair = F.least("left", "right").alias("a"), F.greatest("left", "right").alias("b")
        edges, turn = store.settle(moved.select(*pair).distinct(), "edges"), turn + 1
        if edges.isEmpty():
            return label
