"""Text search of stored incidents by postings of trigrams, kept by day beside the table.

A posting (day, gram, block) says that the record, the category or a host of an incident in a block holds these three characters in lower case.
A block is up to ``BLOCK_ROWS`` incidents of a day that follow each other in a file of the table, named by its smallest and largest id; as most
of a record is the same in all of them, a block has not many more grams than a record, so postings stay far smaller than the table. They are
made where the table is read, without a shuffle. A search asks for postings of the grams of its text, keeps the blocks that have them all, and
reads only their days and ids; what it finds is confirmed by the condition of the scan, so both give the same rows. Files are sorted by gram and
have a bloom filter on it, so a search reads the row groups of its grams. A text without three characters in a row between wildcards has no
gram, and the table is scanned.

``path`` is the table's; an id stands once in a table and is not null.
"""

import re
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from alertloom.functions.sizing import BROADCAST_BYTES, estimated_bytes
from alertloom.operators.analytics import Filters, search_patterns
from alertloom.operators.store import on_days
from alertloom.session import work_path
from alertloom.sources import files

#: Grams that a text asks for; with fewer of them more blocks are left to be confirmed, none is lost.
ASKED = 8
BLOCK_ROWS = 1024
_BLOCK_CHARS = 16 << 20
_POSTING = "created_date date, gram string, from_id string, to_id string"


def postings_path(path: str) -> str:
    return f"{path}_grams"


def has_postings(spark: SparkSession, path: str) -> bool:
    return files.exists(spark, postings_path(path))


def _grams(text: str) -> list[str]:
    """The distinct runs of three characters."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    if len(points) < 3:
        return []
    runs = np.unique(points[:-2] << 42 | points[1:-1] << 21 | points[2:])
    parts = np.stack([runs >> 42, runs >> 21 & 0x1FFFFF, runs & 0x1FFFFF], 1).astype(np.uint32)
    joined = parts.tobytes().decode("utf-32-le", "surrogatepass")
    return [joined[i : i + 3] for i in range(0, len(joined), 3)]


def _blocks(rows: int, chars: int):
    """Kernel: rows (created_date, id, text) to the postings of their blocks. A block ends with its day, or when it is full."""
    schema = pa.schema([("created_date", pa.date32()), ("gram", pa.string()), ("from_id", pa.string()), ("to_id", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        day, ids, texts, size = None, [], [], 0

        def block() -> pa.RecordBatch:
            grams = _grams("\n".join(texts))
            n = len(grams)
            return pa.RecordBatch.from_arrays(
                [pa.array([day] * n, pa.date32()), pa.array(grams, pa.string()), pa.array([min(ids)] * n), pa.array([max(ids)] * n)], schema=schema)

        for batch in batches:
            for at, name, text in zip(*(batch.column(c).to_pylist() for c in ("created_date", "id", "text"))):
                if ids and (at != day or len(ids) >= rows or size >= chars):
                    yield block()
                    ids, texts, size = [], [], 0
                day = at
                ids.append(name)
                texts.append(text)
                size += len(text)
        if ids:
            yield block()

    return run


def postings(rows: DataFrame) -> DataFrame:
    text = F.make_valid_utf8(F.lower(F.concat_ws("\n", F.to_json("raw_incident"), "category", "target_hosts")))
    return rows.select("created_date", "id", text.alias("text")).mapInArrow(_blocks(BLOCK_ROWS, _BLOCK_CHARS), _POSTING)


def write_postings(rows: DataFrame, path: str, replace_days: bool = False) -> None:
    """Postings of rows with ``created_date``, as they lie in the table: of a whole table, or of all rows of some of its days."""
    (postings(rows).sortWithinPartitions("created_date", "gram", "from_id")
     .write.mode("overwrite").partitionBy("created_date")
     .option("partitionOverwriteMode", "dynamic" if replace_days else "static")
     .option("compression", "zstd")  # the reader failed on postings written with lz4_raw
     .option("parquet.bloom.filter.enabled#gram", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
     .parquet(postings_path(path)))


def asked_grams(pattern: str) -> list[str]:
    """Some grams that a text has if it is like ``pattern`` (in lower case, backslashes doubled)."""
    parts = [part.replace("\\\\", "\\") for part in re.split("[%_]", pattern)]
    grams = sorted({part[i : i + 3] for part in parts for i in range(len(part) - 2)})
    return grams[:: -(-len(grams) // ASKED)] if grams else []


def search(rows: DataFrame, path: str, filters: Filters) -> DataFrame:
    """The rows of the table at ``path`` that meet the filters, found by its postings."""
    spark = rows.sparkSession
    patterns = search_patterns(filters.search) if filters.search else []
    lowered = spark.range(1).select(*[F.lower(F.lit(p)) for p in patterns]).first() if patterns else []
    asked = [asked_grams(p) for p in lowered]
    if not asked or not all(asked):
        return rows.filter(filters.condition())
    found = spark.read.schema("gram string, from_id string, to_id string, created_date date").parquet(postings_path(path))
    counts = [F.count_if(F.col("gram").isin(grams)).alias(f"n{i}") for i, grams in enumerate(asked)]
    whole = reduce(lambda a, b: a | b, [F.col(f"n{i}") >= len(grams) for i, grams in enumerate(asked)])
    found = found.filter(F.col("gram").isin(sorted({g for grams in asked for g in grams}))).groupBy(
        "created_date", "from_id", "to_id").agg(*counts).filter(whole)
    kept = work_path(spark, "found", uuid.uuid4().hex)  # read twice, and its size decides about a broadcast
    found.select("created_date", "from_id", "to_id").write.parquet(kept)
    found = spark.read.schema("created_date date, from_id string, to_id string").parquet(kept)
    some = on_days(rows, found)
    if estimated_bytes(found) <= BROADCAST_BYTES:
        own = found.withColumnRenamed("created_date", "_day")
        some = some.join(F.broadcast(own), F.col("created_date").eqNullSafe(F.col("_day")) & F.col("id").between(
            F.col("from_id"), F.col("to_id")), "left_semi")
    return some.filter(filters.condition())
