"""What the operators of this package have in common: stored steps, salted joins, file systems."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from alertloom.session import work_path

#: The white space of the contracts, as a Java, Python and RE2 character class.
SPACE = r"[\x20\x09-\x0D]"
#: A key is hot if it holds at least one row in so many; so there are at most as many hot keys.
HOT_SHARE = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """A text column in which null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return work_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df``, written to the shared folder and read back: what follows reads files that every
    executor sees, and a lost executor costs one task, not the lineage."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def salted_join(left: DataFrame, right: DataFrame, key: str, spread: Column, how: str = "left", salts: int = 64,
                counts: DataFrame | None = None) -> DataFrame:
    """``left`` joined to ``right``, which has one row a ``key``, however often a key is in ``left``.

    A key with a thousandth of the rows of ``left`` or more is hot; there are at most a thousand, so their
    list may be broadcast. Rows of a hot key are dealt by ``spread`` over ``salts`` copies of its row on the right.
    ``counts`` has the keys' numbers of rows as ``_n``, if they are known; keys that it leaves out aren't hot.
    """
    if counts is None:
        counts = left.groupBy(key).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n").alias("_all"))
    hot = counts.join(F.broadcast(total), F.col("_n") * HOT_SHARE >= F.col("_all")).filter(F.col("_n") >= salts)
    hot = stored(hot.filter(F.col(key).isNotNull()).select(key, F.lit(salts).alias("_salts")), "hot")
    one = F.coalesce(F.col("_salts"), F.lit(1)).cast("long")
    left = left.join(F.broadcast(hot), key, "left").withColumn("_salt", F.pmod(F.xxhash64(spread), one)).drop("_salts")
    right = right.join(F.broadcast(hot), key, "left")
    right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), one - 1))).drop("_salts")
    return left.join(right, [key, "_salt"], how).drop("_salt")


def file_system(uri: str):
    """The file system and the path in it of a URI or a plain path, for tasks that read and write whole files."""
    from pyarrow import fs

    if "://" in uri or uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri)
    return fs.LocalFileSystem(), uri


def once(key: str, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, made once in a Python process. The functions of this library travel to the workers by value, each task
    with its own copy, so that a cache of the module would not outlive the task."""
    kept = vars(sys.modules.setdefault("_alertloom_once", types.ModuleType("_alertloom_once")))
    if key not in kept:
        kept[key] = make()
    return kept[key]
