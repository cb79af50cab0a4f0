"""Port scans: many distinct ports of one source within seconds, then silence for a while.

Both steps need the order of a source's events. Distinct ports are counted by windows alone; for the silence Spark partitions and sorts
and Python sees a stream. A hot source is cut into time slices; what a slice needs from the ones before it is small (the number of open
ports, the latest firing) and is worked out from summaries of the slices, so no task reads a whole source.
"""

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from alertloom.operators.detect import detected
from alertloom.operators.skew import TARGET_ROWS, with_chunks
from alertloom.session import shared_dir

CHUNK = ["srcip", "chunk"]


def _sorted(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy(*CHUNK).orderBy("kind", "ts_us", "event_id")
    return rows.withColumn("_start", F.lag("kind").over(order).isNull())


def _port_ghosts(rows: DataFrame) -> DataFrame:
    """For each port of a slice, the port's last hit before the slice and its first after it, as ``kind`` 0 rows of the slice."""
    ends = rows.groupBy(*CHUNK, "dstport").agg(F.min("ts_us").alias("first"), F.max("ts_us").alias("last"))
    slices = Window.partitionBy("srcip", "dstport").orderBy("chunk")
    near = F.array_compact(F.array(F.lag("last").over(slices), F.lead("first").over(slices)))
    return ends.withColumn("ts_us", near).select(*CHUNK, "dstport", F.explode("ts_us").alias("ts_us"), F.lit(0).alias("kind"))


def _open_ports(steps: DataFrame) -> DataFrame:
    """Per slice, a row before all others with the number of ports that are open when it begins."""
    sums = steps.groupBy(*CHUNK).agg(F.sum("change").alias("change"))
    earlier = Window.partitionBy("srcip").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    return sums.withColumn("change", F.sum("change").over(earlier)).filter("change is not null").withColumn("kind", F.lit(-1))


def distinct_ports(events: DataFrame, seconds: int, ports: int, split: str = "auto",
                   target_rows: int = TARGET_ROWS) -> DataFrame:
    """Events at which their source has hit ``ports`` distinct ports within ``seconds``.

    A port opens at a hit with none of the same port in the ``seconds`` before it, and closes that long after a hit with none to follow
    in time; so it is open just while the trailing window holds it, and the running sum of openings less closings is the number of
    distinct ports. Windows over one shuffle by source, or by slice of a hot source, whose sums are carried over slices.
    """
    span_us = seconds * 1_000_000
    chunked, sliced = with_chunks(events, ["srcip"], split, target_rows)
    rows = chunked.withColumn("kind", F.lit(1))
    if sliced:
        rows = rows.unionByName(_port_ghosts(rows.filter(F.col("chunk") > 0)), allowMissingColumns=True)
    port = Window.partitionBy(*CHUNK, "dstport").orderBy("ts_us", "event_id")
    opens = F.coalesce(F.col("ts_us") - F.lag("ts_us").over(port) > span_us, F.lit(True))
    closes = F.coalesce(F.lead("ts_us").over(port) - F.col("ts_us") > span_us, F.lit(True))
    hits = rows.repartition(*(CHUNK if sliced else ["srcip"])).withColumn("_opens", opens).withColumn("_closes", closes).filter("kind = 1")
    hit = F.struct(F.lit(1).alias("kind"), F.col("ts_us"), F.col("_opens").cast("int").alias("change"))
    close = F.struct(F.lit(0).alias("kind"), (F.col("ts_us") + span_us + 1).alias("ts_us"), F.lit(-1).alias("change"))
    kept = [c for c in events.columns if c != "ts_us"]
    steps = hits.select(*kept, "chunk", F.inline(F.array_compact(F.array(hit, F.when(F.col("_closes"), close)))))
    if sliced:
        shared_dir(events.sparkSession)
        steps, _ = with_chunks(steps.drop("chunk").checkpoint(), ["srcip"], "always", target_rows)
        steps = steps.unionByName(_open_ports(steps.filter(F.col("chunk") > 0)), allowMissingColumns=True)
    source = Window.partitionBy(*CHUNK).orderBy(F.col("ts_us").asc_nulls_first(), "kind", "event_id")
    count = F.sum("change").over(source.rowsBetween(Window.unboundedPreceding, 0))
    return steps.withColumn("_count", count).filter((F.col("kind") == 1) & (F.col("_count") >= ports)).select(*events.columns)


def _first_of_quiet(ignore_us: int):
    """Kernel: rows more than ``ignore_us`` after the last row kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            kept = []
            columns = (batch.column(c).to_pylist() for c in ("_start", "kind", "ts_us"))
            for i, (start, kind, ts) in enumerate(zip(*columns)):
                if start:
                    last = None
                if kind == 0:
                    last = ts
                elif last is None or ts - last > ignore_us:
                    last = ts
                    kept.append(i)
            if kept:
                yield batch.take(pa.array(kept, pa.int64()))

    return run


_PASSAGE = "srcip string, chunk bigint, until array<bigint>, leaves array<bigint>"


def _passages(ignore_us: int):
    """Kernel: per slice, the last firing that leaves it for each first firing it may have.

    Only rows within ``ignore_us`` of the slice's first row, and the next one, can be the first
    to fire. Neighbours that leave the same last firing share one entry, named by its latest row.
    """
    schema = pa.schema([("srcip", pa.string()), ("chunk", pa.int64()),
                        ("until", pa.list_(pa.int64())), ("leaves", pa.list_(pa.int64()))])

    def summary(srcip, chunk, times):
        last = list(times)
        for i in range(len(times) - 1, -1, -1):
            following = bisect_right(times, times[i] + ignore_us)
            if following < len(times):
                last[i] = last[following]
        entries = min(len(times), bisect_right(times, times[0] + ignore_us) + 1)
        shared = [i for i in range(entries) if i + 1 == entries or last[i] != last[i + 1]]
        return {"srcip": srcip, "chunk": chunk,
                "until": [times[i] for i in shared], "leaves": [last[i] for i in shared]}

    def run(batches):
        key, times = None, []
        for batch in batches:
            out = []
            for start, srcip, chunk, ts in zip(
                    *(batch.column(c).to_pylist() for c in ("_start", "srcip", "chunk", "ts_us"))):
                if start:
                    if key:
                        out.append(summary(*key, times))
                    key, times = (srcip, chunk), []
                times.append(ts)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
        if key:
            yield pa.RecordBatch.from_pylist([summary(*key, times)], schema=schema)

    return run


def _firing_carries(rows: DataFrame, ignore_us: int) -> DataFrame:
    """One ``kind`` 0 row per slice after a source's first: the time of the last firing before it."""
    passages = _sorted(rows.select(*CHUNK, "kind", "ts_us", "event_id")).mapInArrow(_passages(ignore_us), _PASSAGE)
    order = Window.partitionBy("srcip").orderBy("chunk")
    flagged = passages.withColumn("_start", F.lag("chunk").over(order).isNull())

    def run(batches):
        schema = pa.schema([("srcip", pa.string()), ("chunk", pa.int64()), ("kind", pa.int32()), ("ts_us", pa.int64())])
        last = None
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["_start"]:
                    last = None
                else:
                    out.append({"srcip": r["srcip"], "chunk": r["chunk"], "kind": 0, "ts_us": last})
                entry = 0 if last is None else bisect_right(r["until"], last + ignore_us)
                if entry < len(r["leaves"]):
                    last = r["leaves"][entry]
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    return flagged.mapInArrow(run, "srcip string, chunk bigint, kind int, ts_us bigint")


def first_of_quiet(rows: DataFrame, ignore_seconds: int, split: str = "auto",
                   target_rows: int = TARGET_ROWS) -> DataFrame:
    """Rows of a source that come more than ``ignore_seconds`` after the last row kept."""
    chunked, sliced = with_chunks(rows, ["srcip"], split, target_rows)
    marked = chunked.withColumn("kind", F.lit(1))
    ignore_us = ignore_seconds * 1_000_000
    if sliced:
        carries = _firing_carries(marked.filter(F.col("chunk") > 0), ignore_us)
        marked = marked.unionByName(carries, allowMissingColumns=True)
    ordered = _sorted(marked)
    return ordered.mapInArrow(_first_of_quiet(ignore_us), ordered.schema).select(*rows.columns)


def port_scans(events: DataFrame, seconds: int = 30, ports: int = 10, ignore_seconds: int = 60,
               split: str = "auto", target_rows: int = TARGET_ROWS) -> DataFrame:
    """Port scans among firewall events: blocked traffic of one source to ``ports`` distinct
    destination ports within ``seconds``, reported once per ``ignore_seconds``.

    ``events`` has srcip, dstport, action, ts_us and event_id.
    """
    blocked = events.filter(F.col("action") == "block")
    dense = distinct_ports(blocked, seconds, ports, split, target_rows)
    found = first_of_quiet(dense, ignore_seconds, split, target_rows)
    return detected(found, "100201", "srcip", count=ports, seconds=seconds)
