"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.util import shared_folder, stored


def _hooked(pairs: DataFrame, keep: str) -> DataFrame:
    """Every ``v`` of a node ``u`` linked to the smallest id among ``u`` and its ``v``.

    The minimum is a partial aggregate and comes back by a join, so the
    neighbours of one node are never gathered in one place.
    """
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return (
        pairs.join(least, "u")
        .withColumn("m", F.least("u", "m"))
        .where(keep)
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
    )


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` (u, v) of longs -> (node, root): the smallest node that each one reaches.

    Nodes without a link to another node are not returned.  Each round is
    stored in the shared folder, so lineage stays short; rounds end when a
    round changes nothing, about log2 of the longest path.
    """
    spark = links.sparkSession
    folder = shared_folder(spark, "components")
    edges = stored(
        links.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        folder,
        "links",
    )
    state = _summary(edges)
    number = 0
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _hooked(both, "v > u and v <> m")
        down = large.where("u > v")
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u")
        small = (
            small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .where("u > v")
            .distinct()
        )
        edges = stored(small, folder, f"round-{number}")
        number += 1
        before, state = state, _summary(edges)
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _summary(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
    ).first()
    return tuple(row)
