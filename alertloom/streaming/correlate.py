"""Correlation of a stream of enriched alerts with the same rules as in batch.

State is kept per (rule, key): the last match time, the count or member set, and the matches
the watermark has not passed yet. Matches are counted in (time, event id) order once the
watermark guarantees that nothing earlier can still come, so the result does not depend on
how the stream was cut into micro-batches. A key's waiting matches lie in the state store as
sorted pieces, of which a step reads those that the watermark has reached, merging the ones
that overlap in time; the others are neither read nor written again. So a task holds one Arrow
batch, or one piece for each of those a key's matches came in. A counter that has expired
by the watermark, or has just fired, leaves no state.
"""

from bisect import bisect_left
from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from alertloom.functions.columns import lookup
from alertloom.operators.correlate import build_incidents, correlate
from alertloom.operators.rules import Rule, fan_out
from alertloom.schemas import TRIGGERING_ALERT

_FIRED = "rule_id string, key string, event_id string, ts_us bigint, alert string"


# Rows of a piece of waiting matches, and rows that are read before they are merged.
PIECE, MERGE = 512, 8_192
_WAITING = pa.schema([("ts_us", pa.int64()), ("event_id", pa.string()), ("member", pa.string()), ("alert", pa.string())])


def _packed(rows: Sequence[tuple]) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _WAITING, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(pa.record_batch([list(column) for column in zip(*rows)], schema=_WAITING))
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> list[tuple]:
    with pa.ipc.open_stream(data) as reader:
        return list(zip(*(column.to_pylist() for column in reader.read_all().columns)))


class _Counter(StatefulProcessor):
    """One expiring counter or member set."""

    def __init__(self, rules: dict[str, tuple[int, int, bool]]):
        self.rules = rules

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counter = handle.getValueState("counter", "last_us bigint, n int, members array<string>")
        # Waiting matches: sorted pieces by number, and apart from them the time at which each begins.
        self.pieces = handle.getMapState("pieces", "piece bigint", "matches binary")
        self.begins = handle.getMapState("begins", "low_us bigint, piece bigint", "size int")
        self.last_piece = handle.getValueState("last_piece", "piece bigint")

    def _wait(self, rows: list[tuple]) -> list[int]:
        """Put sorted matches into the state; when each piece of them begins."""
        last = self.last_piece.get()[0] if self.last_piece.exists() else 0
        lows = []
        for at in range(0, len(rows), PIECE):
            part, last = rows[at:at + PIECE], last + 1
            self.pieces.updateValue((last,), (_packed(part),))
            self.begins.updateValue((part[0][0], last), (len(part),))
            lows.append(part[0][0])
        self.last_piece.update((last,))
        return lows

    def _take(self, low: int, piece: int) -> list[tuple]:
        rows = _unpacked(self.pieces.getValue((piece,))[0])
        self.pieces.removeKey((piece,))
        self.begins.removeKey((low, piece))
        return rows

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for batch in rows:
            if len(batch):
                low = min(self._wait(sorted(batch[_WAITING.names].itertuples(index=False, name=None))))
                first = low if first is None else min(first, low)
        if first is not None:
            self.handle.registerTimer(first // 1000 + 1)
        return iter(())

    def _due(self, begun: list[tuple[int, int]], passed: int) -> Iterator[list[tuple]]:
        """The matches up to ``passed`` of the pieces that have ``begun``, in order; later ones of these pieces wait on.

        What is read before the next piece begins is complete. Rows are sorted when as many were read as were left, so each takes part
        in few sorts however many pieces overlap.
        """
        held, left = [], 0
        for i, (low, piece) in enumerate(begun):
            held += self._take(low, piece)
            if i + 1 < len(begun) and len(held) - left < max(MERGE, left):
                continue
            held.sort()
            ready = bisect_left(held, (begun[i + 1][0] if i + 1 < len(begun) else passed + 1,))
            yield held[:ready]
            held = held[ready:]
            left = len(held)
        if held:
            self._wait(held)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        window_us, threshold, distinct = self.rules[key[0]]
        waiting = sorted(tuple(k) for k in self.begins.keys())
        begun = [k for k in waiting if k[0] <= passed]
        if not begun:
            if not waiting and self.counter.exists() and self.counter.get()[0] + window_us < passed:
                self.counter.clear()
            return

        last, n, members = self.counter.get() if self.counter.exists() else (None, 0, [])
        members = set(members or [])
        for rows in self._due(begun, passed):
            fired = []
            for ts, event_id, member, alert in rows:
                if last is not None and ts - last > window_us:
                    n, members = 0, set()
                last = ts
                if distinct:
                    members.add(member)
                    n = len(members)
                else:
                    n += 1
                if n == threshold:
                    fired.append((key[0], key[1], event_id, ts, alert))
                    n, members = 0, set()
            if fired:
                yield pd.DataFrame(fired, columns=["rule_id", "key", "event_id", "ts_us", "alert"])
        if n:
            self.counter.update((last, n, sorted(members)))
            self.handle.registerTimer((last + window_us) // 1000 + 2)
        else:
            self.counter.clear()
        later = min((low for low, _ in self.begins.keys()), default=None)
        if later is None:
            self.last_piece.clear()
        else:
            self.handle.registerTimer(later // 1000 + 1)

    def close(self) -> None:
        pass


def fire_stream(alerts: DataFrame, rules: Sequence[Rule], lateness: str) -> DataFrame:
    """Firings of a stream of enriched alerts.

    ``lateness`` is how far alerts may be out of order over micro-batches. Later ones can't be counted in their place any more; Spark
    counts them (``numRowsDroppedByWatermark`` in the query progress), they are still in the landed feed, and
    ``reconcile`` puts the incidents right from there. Rules with threshold 1 need no state and fire as alerts pass.
    """
    instant = [r for r in rules if r.threshold == 1]
    counted = [r for r in rules if r.threshold > 1]
    parts = [fan_out(alerts, instant).drop("member")] if instant else []
    if counted:
        settings = {r.id: (r.window_sec * 1_000_000, r.threshold, r.member is not None) for r in counted}
        hits = (
            fan_out(alerts, counted)
            .withColumn("alert", F.to_json("alert"))
            .withColumn("hit_ts", F.timestamp_micros("ts_us"))
            .withWatermark("hit_ts", lateness)
        )
        fired = hits.select("rule_id", "key", "ts_us", "event_id", "member", "alert", "hit_ts").groupBy(
            "rule_id", "key").transformWithStateInPandas(
            statefulProcessor=_Counter(settings), outputStructType=_FIRED, outputMode="Append", timeMode="EventTime")
        rule_id = F.col("rule_id")
        parts.append(
            fired.withColumn("alert", F.from_json("alert", TRIGGERING_ALERT))
            .withColumn("threshold", lookup({r.id: r.threshold for r in counted}, rule_id))
            .withColumn("window_us", lookup({r.id: r.window_sec * 1_000_000 for r in counted}, rule_id).cast("long")))
    columns = ["rule_id", "key", "event_id", "ts_us", "threshold", "window_us", F.col("alert").cast(TRIGGERING_ALERT).alias("alert")]
    return reduce(DataFrame.unionByName, [p.select(*columns) for p in parts])


def correlate_stream(alerts: DataFrame, rules: Sequence[Rule], lateness: str) -> DataFrame:
    """Incidents of a stream of enriched alerts."""
    return build_incidents(fire_stream(alerts, rules, lateness), rules)


def reconcile(found: DataFrame, alerts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The incidents of all landed ``alerts`` beside those a stream has ``found``, with ``state``: ``kept``, ``added`` (a late alert was
    missing) or ``withdrawn`` (found only because one was missing). Ids depend on the alerts alone, so a second run adds nothing."""
    right = correlate(alerts, rules)
    known = found.select(F.col("incident_id").alias("_found")).distinct()
    state = F.when(F.col("_found").isNull(), "added").otherwise("kept")
    kept = right.join(known, F.col("incident_id") == F.col("_found"), "left").withColumn("state", state).drop("_found")
    gone = found.join(right.select("incident_id"), "incident_id", "left_anti").withColumn("state", F.lit("withdrawn"))
    return kept.unionByName(gone)
