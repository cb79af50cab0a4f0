"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from alertloom.llm.shared import stored


def components(links: DataFrame) -> DataFrame:
    """id and component (its smallest id) of every id in ``links`` (u, v: long).

    In each round every vertex points to its least neighbour or itself, pointers are followed on, and links between vertices that
    now point to the same are gone. Vertices go by a hash of their id, one to one for 64-bit numbers, so that long chains halve
    on the average whatever the order of the ids. Every round is written to the shared folder.
    """
    of = stored(links.select(F.explode(F.array("u", "v")).alias("id")).distinct().withColumn("at", F.xxhash64("id")), "labels")
    left = stored(links.select(F.xxhash64("u").alias("a"), F.xxhash64("v").alias("b")).filter("a != b").distinct(), "links")
    while not left.isEmpty():
        ends = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = stored(ends.groupBy("a").agg(F.min("b").alias("to")).select("a", F.least("a", "to").alias("to")), "pointers")
        on = to.select(F.col("a").alias("to"), F.col("to").alias("on"))
        to = stored(to.join(on, "to").select("a", F.col("on").alias("to")), "pointers")
        of = stored(of.join(to.withColumnRenamed("a", "at"), "at", "left").select("id", F.coalesce("to", "at").alias("at")), "labels")
        other = to.select(F.col("a").alias("b"), F.col("to").alias("to_b"))
        left = stored(left.join(to, "a").join(other, "b").filter("to != to_b").select(
            F.least("to", "to_b").alias("a"), F.greatest("to", "to_b").alias("b")).distinct(), "links")
    least = of.groupBy("at").agg(F.min("id").alias("component"))
    return stored(of.join(least, "at").select("id", "component"), "components")
