"""Cutting hot keys into time slices so that no task has to hold a whole key."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from alertloom.functions.sizing import BROADCAST_BYTES
from alertloom.session import shared_dir

TARGET_ROWS = 1_000_000
_MINUTE_US, _SECOND_US = 60_000_000, 1_000_000
# Bytes of a slice table's row in memory, beside its keys.
_ROW_BYTES = 100


def _cell(width: int) -> Column:
    return F.expr(f"ts_us div {width} * {width}")


def _before(by: list[str], order: str) -> Column:
    """Rows of the earlier cells of the same group."""
    earlier = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("_n").over(earlier), F.lit(0))


def slices(hits: DataFrame, keys: list[str], target_rows: int) -> DataFrame | None:
    """Where the slices of hot keys begin: (keys, _minute, _starts), the latter an array of (from_us, chunk) by time; None if no key
    has more than ``target_rows`` rows.

    A row's slice is the number of its key's earlier rows over ``target_rows``, counted by the minute, within a minute of more than
    ``target_rows`` rows by the second, and within such a second by the microsecond. So a key has at most its rows / ``target_rows`` + 1
    slices, and a slice less than 2 * ``target_rows`` rows unless they share a microsecond. Each sum runs over the minutes of a key,
    60 seconds, or a million microseconds, never over the rows. Only minutes and seconds that are too full are counted again.
    """
    shared_dir(hits.sparkSession)
    minutes = hits.groupBy(*keys, _cell(_MINUTE_US).alias("_minute")).agg(F.count("*").alias("_n"))
    hot = minutes.groupBy(*keys).agg(F.sum("_n").alias("_total")).filter(F.col("_total") > target_rows).select(*keys)
    minutes = minutes.join(hot, keys).withColumn("_base", _before(keys, "_minute")).checkpoint()
    if minutes.isEmpty():
        return None
    chunk = F.expr(f"1 + _base div {target_rows}").alias("chunk")
    full = F.col("_n") > target_rows
    parts = [minutes.filter(~full).select(*keys, "_minute", F.col("_minute").alias("from_us"), chunk)]
    heavy = minutes.filter(full).select(*keys, "_minute", F.col("_base").alias("_outer"))
    if not heavy.isEmpty():
        inside = hits.select(*keys, "ts_us", _cell(_MINUTE_US).alias("_minute")).join(heavy, [*keys, "_minute"])
        seconds = inside.groupBy(*keys, "_minute", "_outer", _cell(_SECOND_US).alias("_second")).agg(F.count("*").alias("_n"))
        seconds = seconds.withColumn("_base", F.col("_outer") + _before([*keys, "_minute"], "_second")).drop("_outer").checkpoint()
        parts.append(seconds.filter(~full).select(*keys, "_minute", F.col("_second").alias("from_us"), chunk))
        heavy = seconds.filter(full).select(*keys, "_minute", "_second", F.col("_base").alias("_outer"))
        inside = hits.select(*keys, "ts_us", _cell(_SECOND_US).alias("_second")).join(heavy, [*keys, "_second"])
        moments = inside.groupBy(*keys, "_minute", "_second", "_outer", "ts_us").agg(F.count("*").alias("_n"))
        moments = moments.withColumn("_base", F.col("_outer") + _before([*keys, "_second"], "ts_us"))
        parts.append(moments.select(*keys, "_minute", F.col("ts_us").alias("from_us"), chunk))
    starts = reduce(DataFrame.unionByName, parts).groupBy(*keys, "_minute", "chunk").agg(F.min("from_us").alias("from_us"))
    return starts.groupBy(*keys, "_minute").agg(F.sort_array(F.collect_list(F.struct("from_us", "chunk"))).alias("_starts")).checkpoint()


def with_chunks(hits: DataFrame, keys: list[str], split: str = "auto",
                target_rows: int = TARGET_ROWS) -> tuple[DataFrame, bool]:
    """Add ``chunk``: 0 for an ordinary key, the number of a time slice for one with more than ``target_rows`` rows. Slices follow
    time order. Also returned: whether slices may occur.

    ``split`` is ``auto`` (count the rows first: with ``target_rows`` in all, no key can have more), ``always`` (count by key at once) or
    ``never``. The table of slices is broadcast if its counted size allows, else joined on key and minute, which deals a hot key's rows out.
    """
    plain = hits.withColumn("chunk", F.lit(0).cast("long"))
    if split == "never" or (split == "auto" and hits.count() <= target_rows):
        return plain, False
    found = slices(hits, keys, target_rows)
    if found is None:
        return plain, False
    size = found.agg(F.sum(F.size("_starts") * 24 + _ROW_BYTES + reduce(lambda a, b: a + b, [F.length(F.col(k).cast("string")) for k in keys]))).first()[0]
    begun = F.filter("_starts", lambda s: s["from_us"] <= F.col("ts_us"))
    sliced = (
        hits.withColumn("_minute", _cell(_MINUTE_US))
        .join(F.broadcast(found) if size <= BROADCAST_BYTES else found, [*keys, "_minute"], "left")
        .withColumn("chunk", F.coalesce(F.element_at(begun, -1)["chunk"], F.lit(0)).cast("long"))
        .drop("_minute", "_starts")
    )
    return sliced, True
