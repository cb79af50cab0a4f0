"""Distinct-member rules over event time.

A key's set gains the member of every match, expires when the key is quiet for longer than
the window, fires when it holds ``threshold`` members and then starts empty. Where it fires
depends on everything since the last firing, so the matches of a key are replayed in order.
Spark partitions and sorts them; Python sees a stream of (start, break, member) and returns
the firing rows. A hot key is replayed slice by slice: a slice is summed up by how it changes
any set it may be entered with, the summaries of a key are chained, and each slice then
starts from its exact set.
"""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from alertloom.operators.skew import TARGET_ROWS, with_chunks

KEYS = ["rule_id", "key"]
CHUNK = [*KEYS, "chunk"]


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows sorted by time within their chunk, with chunk starts and session breaks marked.

    From the third match in a row of one member on, a set of two or more members cannot
    change any more, so those rows are left out; the last row of a chunk stays for its time.
    """
    order = Window.partitionBy(*CHUNK).orderBy("kind", "ts_us", "event_id")
    repeated = (
        (F.col("threshold") > 1)
        & (F.col("member") == F.lag("member", 1).over(order))
        & (F.col("member") == F.lag("member", 2).over(order))
        & ~F.col("_break") & ~F.lag("_break").over(order)
        & F.lead("ts_us").over(order).isNotNull()
    )
    return (
        rows.withColumn("_start", F.lag("ts_us").over(order).isNull())
        .withColumn("_break", F.coalesce(
            F.col("ts_us") - F.lag("ts_us").over(order) > F.col("window_us"), F.lit(False)))
        .withColumn("_repeated", F.coalesce(repeated, F.lit(False)))
        .filter(~F.col("_repeated"))
        .drop("_repeated")
    )


def _replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows at which a set fills up."""
    members: set = set()
    for batch in batches:
        fired = []
        columns = [batch.column(c).to_pylist() for c in ("_start", "_break", "kind", "seed", "member", "threshold")]
        for i, (start, broke, kind, seed, member, threshold) in enumerate(zip(*columns)):
            if start or broke:
                members = set()
            if kind == 0:
                members = set(seed)
                continue
            members.add(member)
            if len(members) >= threshold:
                fired.append(i)
                members = set()
        if fired:
            yield batch.take(pa.array(fired, pa.int64()))


_SUMMARY = (
    "rule_id string, key string, chunk bigint, threshold int, window_us bigint, first_ts bigint, "
    "last_ts bigint, broke boolean, heads array<string>, exits array<array<string>>"
)


def _summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per chunk: what leaves it, for any set that may enter.

    ``heads`` are the first ``threshold`` distinct members. A set that enters fires at the
    first head that fills it, and ``exits`` holds the set at the end of the chunk for each
    such head; if none fills it, it leaves with all heads added. After a break nothing that
    entered matters and ``exits`` has the one set that leaves.
    """
    names = ("_start", "_break", "member", "ts_us", "rule_id", "key", "chunk", "threshold", "window_us")
    current = None

    def row(c):
        exits = [c["after"]] if c["broke"] else c["exits"]
        return {**{k: c[k] for k in ("rule_id", "key", "chunk", "threshold", "window_us",
                                     "first_ts", "last_ts", "broke", "heads")},
                "exits": [sorted(e) for e in exits]}

    def step(members: set, member: str, threshold: int) -> None:
        members.add(member)
        if len(members) >= threshold:
            members.clear()

    for batch in batches:
        out = []
        for start, broke, member, ts, rule, key, chunk, threshold, window in zip(
                *(batch.column(n).to_pylist() for n in names)):
            if start:
                if current:
                    out.append(row(current))
                current = {"rule_id": rule, "key": key, "chunk": chunk, "threshold": threshold,
                           "window_us": window, "first_ts": ts, "broke": False, "heads": [],
                           "exits": [], "after": set()}
            current["last_ts"] = ts
            if broke:
                current["broke"], current["after"] = True, set()
            if current["broke"]:
                step(current["after"], member, threshold)
                continue
            for members in current["exits"]:
                step(members, member, threshold)
            if member not in current["heads"] and len(current["heads"]) < threshold:
                current["heads"].append(member)
                current["exits"].append(set())
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_summary_schema())
    if current:
        yield pa.RecordBatch.from_pylist([row(current)], schema=_summary_schema())


def _summary_schema() -> pa.Schema:
    text = pa.string()
    return pa.schema([
        ("rule_id", text), ("key", text), ("chunk", pa.int64()), ("threshold", pa.int32()),
        ("window_us", pa.int64()), ("first_ts", pa.int64()), ("last_ts", pa.int64()),
        ("broke", pa.bool_()), ("heads", pa.list_(text)), ("exits", pa.list_(pa.list_(text)))])


_CARRY = "rule_id string, key string, chunk bigint, kind int, ts_us bigint, seed array<string>"


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each chunk after a key's first, the set it starts from, as a ``kind`` 0 row."""
    schema = pa.schema([("rule_id", pa.string()), ("key", pa.string()), ("chunk", pa.int64()),
                        ("kind", pa.int32()), ("ts_us", pa.int64()), ("seed", pa.list_(pa.string()))])
    members, last_ts = set(), None
    for batch in batches:
        out = []
        for c in batch.to_pylist():
            if c["_start"]:
                members, last_ts = set(), None
            else:
                if c["first_ts"] - last_ts > c["window_us"]:
                    members = set()
                out.append({"rule_id": c["rule_id"], "key": c["key"], "chunk": c["chunk"],
                            "kind": 0, "ts_us": last_ts, "seed": sorted(members)})
            if c["broke"]:
                members = set(c["exits"][0])
            else:
                for head, leaving in zip(c["heads"], c["exits"]):
                    members.add(head)
                    if len(members) >= c["threshold"]:
                        members = set(leaving)
                        break
            last_ts = c["last_ts"]
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)


def _carries(rows: DataFrame) -> DataFrame:
    narrow = rows.select(*CHUNK, "kind", "ts_us", "event_id", "member", "window_us", "threshold")
    chunks = _ordered(narrow).mapInArrow(_summarise, _SUMMARY)
    order = Window.partitionBy(*KEYS).orderBy("chunk")
    return (
        chunks.withColumn("_start", F.lag("chunk").over(order).isNull())
        .mapInArrow(_chain, _CARRY)
    )


def fire_distinct(hits: DataFrame, split: str = "auto", target_rows: int = TARGET_ROWS) -> DataFrame:
    """The matches at which a distinct rule fires; same columns as ``hits``."""
    chunked, sliced = with_chunks(hits, KEYS, split, target_rows)
    rows = chunked.withColumn("kind", F.lit(1)).withColumn("seed", F.lit(None).cast("array<string>"))
    if sliced:
        carries = _carries(rows.filter(F.col("chunk") > 0).drop("seed"))
        rows = rows.unionByName(carries, allowMissingColumns=True)
    ordered = _ordered(rows)
    return ordered.mapInArrow(_replay, ordered.schema).select(*hits.columns)
