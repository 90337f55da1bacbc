"""Connected components by repeated contraction: in every round each vertex joins the neighbour (or itself) that a
keyed hash of the round puts first, the edges are renamed and thinned out, and rounds go on until no edge is left. The
hash makes the expected number of rounds logarithmic, whatever the order of the ids. Nothing is collected; every round
is written to the shared folder, so lineage stays short and lost executors cost one round at most."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """`edges`: a, b (bigint). Returns v, label for every vertex of an edge; vertices of a component share a label,
    which is one of them."""
    edges = materialize(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                        .where("a < b").distinct(), "edges")
    labels = materialize(edges.select(F.explode(F.array("a", "b")).alias("v")).distinct()
                         .select("v", F.col("v").alias("label")), "labels")
    number = 0
    while not edges.isEmpty():
        number += 1
        near = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = near.unionByName(near.select("a", F.col("a").alias("b")))
        first = F.min_by("b", F.xxhash64(F.lit(str(number)), F.col("b")))     # a text, so rounds share their code
        joins = materialize(near.groupBy("a").agg(first.alias("to")).where("to != a"), "joins")
        to = lambda c: joins.select(F.col("a").alias(c), F.col("to").alias(f"{c}_to"))
        renamed = edges.join(to("a"), "a", "left").join(to("b"), "b", "left").select(
            F.coalesce("a_to", "a").alias("x"), F.coalesce("b_to", "b").alias("y"))
        edges = materialize(renamed.where("x != y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
                            .distinct(), "edges")
        labels = materialize(labels.join(to("label"), "label", "left")
                             .select("v", F.coalesce("label_to", "label").alias("label")), "labels")
    return labels
