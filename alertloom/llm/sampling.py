"""A bounded sample of labelled rows to fit a model on."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: Parts into which the hash of an id falls.
PARTS = 1_000_000_000


def per_class(rows: DataFrame, label: str, each: int, classes: int | None = None) -> DataFrame:
    """About ``each`` rows of every class of ``label``, all if it has fewer, chosen by the hash of doc_id; the ``classes`` largest classes, or
    of every class if None. The rows and the sizes they stand for: ``rows`` with a column ``_of``, the rows of the class."""
    sizes = rows.groupBy(label).agg(F.count("*").alias("_of")).orderBy(F.desc("_of"), label)
    sizes = sizes if classes is None else sizes.limit(classes)
    chosen = rows.join(F.broadcast(sizes), label)  # one row a class
    return chosen.filter(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(PARTS)) / F.lit(float(PARTS)) < F.lit(float(each)) / F.col("_of"))
