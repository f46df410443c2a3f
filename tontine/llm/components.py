"""Connected components of an edge table, by contraction in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tontine.llm.common import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``(a, b)`` edges of long ids -> ``(id, comp)``: every id of an edge with the smallest id
    that it reaches. Self-loops, repeated edges and either direction are allowed; no edges give
    no rows.

    Each round points every node to its smallest neighbour, follows two further pointers, and
    contracts the edges; the pointers of the rounds are then composed. Every round is a written
    table, so lineage stays short, and per-node work is a partially aggregated minimum, so a node
    with very many edges does not gather them in one task.
    """
    spark = edges.sparkSession
    edges = materialize(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                        .where("a < b").distinct(), "edges")
    label = None
    while True:
        if edges.isEmpty():
            break
        both = edges.union(edges.select("b", "a"))
        point = materialize(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m"))
                            .select("id", F.least("id", "m").alias("to")), "pointers")
        for _ in range(2):
            nxt = point.select(F.col("id").alias("__id"), F.col("to").alias("__to"))
            point = point.join(nxt, F.col("to") == F.col("__id")).select("id", F.col("__to").alias("to"))
        point = materialize(point, "jumped")
        if label is None:
            label = point.select("id", F.col("to").alias("comp"))
        else:
            p = point.select(F.col("id").alias("__id"), F.col("to").alias("__to"))
            label = label.join(p, F.col("comp") == F.col("__id"), "left").select(
                "id", F.coalesce("__to", "comp").alias("comp"))
        label = materialize(label, "labels")
        pa = point.select(F.col("id").alias("a"), F.col("to").alias("__a"))
        pb = point.select(F.col("id").alias("b"), F.col("to").alias("__b"))
        edges = materialize(edges.join(pa, "a").join(pb, "b")
                            .select(F.least("__a", "__b").alias("a"), F.greatest("__a", "__b").alias("b"))
                            .where("a < b").distinct(), "edges")
    if label is None:
        return spark.createDataFrame([], "id long, comp long")
    return label
