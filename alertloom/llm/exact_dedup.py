"""Exact deduplication: a tree merge of sorted digest runs.

Each partition sorts the digests of its texts into runs. Runs are merged ``FAN_IN`` at a time, in rounds that pair
partners as a binomial tree does (the low bits of the run number fall away, ``log2(FAN_IN)`` tree levels a round),
until one run is left. Each merge keeps, for a digest, the smallest doc_id and the number of rows. A merge takes two
entries as one only if SHA-256, a second 64-bit hash and the length all agree. A run is never held in one task: the
digests of a run are themselves dealt over the tasks, so a merge of the last runs is as wide as the first.
The way back goes along the same tree: a row meets its group's result in its own leaf run, so that the rows of one
group, however many, are spread over all leaf runs.

Defined cases: null text counts as empty. An empty table gives an empty result. A null doc_id is never the smallest unless
a group has no other. Repeated rows (same doc_id and text) are counted each and marked alike; ``drop_copies`` returns one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from alertloom.llm.shared import SPACE, partitions, stored, text_of

#: Runs that one merge takes in.
FAN_IN = 8
#: Least number of leaf runs.
LEAST_RUNS = 64
KEY = ["digest", "second", "n_chars"]


def normalised(name: str = "text") -> Column:
    return F.regexp_replace(text_of(name), SPACE + "+", " ")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id and the merge key of every row."""
    text = docs.select("doc_id", normalised().alias("text"))
    return text.select("doc_id", F.unhex(F.sha2("text", 256)).alias("digest"), F.xxhash64("text").alias("second"),
                       F.length("text").alias("n_chars"))


def leaf_runs(docs: DataFrame, runs: int) -> DataFrame:
    """Sorted runs of the digests, ``runs`` at most: a partition's rows go to a few runs of its own."""
    own = F.spark_partition_id() * FAN_IN + F.pmod(F.xxhash64("doc_id"), F.lit(FAN_IN))
    return digests(docs).withColumn("run", F.pmod(own, F.lit(runs)).cast("int")).sortWithinPartitions("run", *KEY)


def merge(entries: DataFrame, fan_in: int) -> DataFrame:
    """One round: ``fan_in`` neighbouring runs become one, equal entries one with the smallest id."""
    up = entries.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
    return up.groupBy("run", *KEY).agg(F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, n_chars of the normalised text."""
    runs = FAN_IN
    while runs < max(LEAST_RUNS, partitions(docs.sparkSession)):
        runs *= FAN_IN
    rows = stored(leaf_runs(docs, runs), "runs")
    leaves = stored(
        rows.groupBy("run", *KEY).agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")), "leaves")
    root = leaves
    while runs > 1:
        root = merge(root, FAN_IN)
        runs //= FAN_IN
    down = leaves.select("run", *KEY).join(root.drop("run"), KEY)
    return rows.join(down, ["run", *KEY]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "n_chars")


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns; of repeated rows one."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    kept = exact_dedup(docs).filter("kept").select(name.alias("_id"), F.col("text_sha256").alias("_digest")).distinct()
    rows = docs.select(name.alias("_id"), F.sha2(normalised(), 256).alias("_digest"), F.struct("*").alias("_row"))
    rows = rows.join(kept.hint("merge"), ["_id", "_digest"], "left_semi")
    return rows.dropDuplicates(["_id", "_digest"]).select("_row.*")
