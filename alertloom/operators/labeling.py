"""Ground-truth labels: alerts joined to the attack runs whose padded window holds them."""

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from alertloom.functions.columns import micros
from alertloom.functions.sizing import BROADCAST_BYTES
from alertloom.session import shared_dir
from alertloom.sources.alerts import alert_time

BUCKET_SECONDS = 600
# Pieces of some 100 bytes each that may be broadcast.
PIECES_BROADCAST = BROADCAST_BYTES // 400


def _iso(ts: Column) -> Column:
    """ISO-8601 text in UTC, with a fraction only when there is one."""
    whole = micros(ts) % 1_000_000 == 0
    return F.when(whole, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")).otherwise(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"))


_PIECE = "bucket bigint, source string, from_us bigint, until_us bigint, run_idx bigint"


def _sweep(width: int):
    """Kernel: opening and closing marks of runs, sorted by (bucket, source) and time, to pieces of the time line with the first of
    the runs active there. A mark gives one piece at most."""
    schema = pa.schema([("bucket", pa.int64()), ("source", pa.string()), ("from_us", pa.int64()), ("until_us", pa.int64()), ("run_idx", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, since = None, None
        active: list[int] = []  # heap of runs
        closed: Counter[int] = Counter()  # closings of runs still inside the heap
        out: list[tuple] = []

        def piece(until: int) -> None:
            while active and closed[active[0]]:
                closed[heappop(active)] -= 1
            if not active:
                return
            if out and out[-1][3:] == (since - 1, active[0]) and out[-1][:2] == group:
                out[-1] = (*out[-1][:3], until, active[0])
            else:
                out.append((*group, since, until, active[0]))

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        for batch in batches:
            names = ("bucket", "source", "at_us", "opens", "run_idx")
            for bucket, source, at, opens, idx in zip(*(batch.column(n).to_pylist() for n in names)):
                if group != (bucket, source):
                    if group:
                        piece((group[0] + 1) * width - 1)
                    group, since = (bucket, source), at
                    active.clear()
                    closed.clear()
                elif at > since:
                    piece(at - 1)
                    since = at
                if opens:
                    heappush(active, idx)
                else:
                    closed[idx] += 1
            if out:
                yield batch_of(out)
                out.clear()
        if group:
            piece((group[0] + 1) * width - 1)
        if out:
            yield batch_of(out)

    return run


def targets_in(sources: DataFrame, windows: DataFrame) -> DataFrame:
    """(source, target) for every non-empty target that is part of a source: an equi-join of the sources' substrings, of the lengths
    that targets have, with the targets."""
    targets = windows.select("target").filter("target != ''").distinct()
    lengths = targets.select(F.length("target").alias("_n")).distinct().agg(F.array_sort(F.collect_set("_n")).alias("_lengths"))
    size = F.length("source")
    parts = F.array_distinct(F.flatten(F.transform("_lengths", lambda n: F.when(n <= size, F.transform(
        F.sequence(F.lit(1), size - n + 1), lambda i: F.substr(F.col("source"), i, n))).otherwise(F.array().cast("array<string>")))))
    # One value: the distinct lengths of targets, as many as the longest target has characters at most.
    cut = sources.withColumn("_lengths", F.coalesce(lengths.scalar(), F.array().cast("array<int>")))
    return cut.select("source", F.explode(parts).alias("target")).join(targets, "target").select("source", "target")


def _swept(marks: DataFrame, width: int) -> DataFrame:
    dealt = marks.repartition("bucket", "source").sortWithinPartitions("bucket", "source", "at_us", F.desc("opens"), "run_idx")
    return dealt.select("bucket", "source", "at_us", "opens", "run_idx").mapInArrow(_sweep(width), _PIECE)


def _opened(rows: DataFrame, width: int, opens_us: Column, closes_us: Column) -> DataFrame:
    """The marks of rows (bucket, source, run_idx) that lie in their bucket."""
    return rows.select("bucket", "source", "run_idx", F.inline(F.array(
        F.struct(opens_us.alias("at_us"), F.lit(True).alias("opens")),
        F.struct(closes_us.alias("at_us"), F.lit(False).alias("opens"))))).filter(F.expr(f"at_us div {width}") == F.col("bucket"))


def _covers(runs: DataFrame) -> DataFrame:
    """(source, bucket, run_idx): the first of the runs that hold whole buckets, from ``_a`` to ``_b``.

    A run is cut into cells of powers of two buckets, two of a size at most, and only the first run of every cell is spread over its buckets.
    """
    cell = F.transform(F.sequence(F.lit(0), F.floor(F.log2(F.col("_b") - F.col("_a") + 1)).cast("int")), lambda k: F.struct(
        k.alias("level"), F.call_function("shiftright", F.col("_a") + F.call_function("shiftleft", F.lit(1).cast("long"), k) - 1, k).alias("low"),
        (F.call_function("shiftright", F.col("_b") + 1, k) - 1).alias("high")))
    cells = runs.filter("_a <= _b").select("source", "run_idx", F.inline(cell)).filter("low <= high").select(
        "source", "run_idx", "level", F.explode(F.array_compact(F.array(
            F.when(F.col("low") % 2 != 0, F.col("low")), F.when(F.col("high") % 2 == 0, F.col("high"))))).alias("node"))
    first = cells.groupBy("source", "level", "node").agg(F.min("run_idx").alias("run_idx"))
    size = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("level"))
    spread = first.select("source", "run_idx", F.explode(F.sequence(F.col("node") * size, (F.col("node") + 1) * size - 1)).alias("bucket"))
    return spread.groupBy("source", "bucket").agg(F.min("run_idx").alias("run_idx"))


def segments(windows: DataFrame, pairs: DataFrame, bounds: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """The time line cut wherever another run becomes the first: (bucket, source, from_us, until_us, run_idx).

    Pieces without a source have the first, in file order, of all runs active; those of a source, the first of the runs whose target
    is part of it (``pairs``). Pieces lie within one time bucket, windows include both their ends, and only buckets within ``bounds`` (one row: first
    and last bucket of the alerts) are made, however long a window is. Runs are swept by target first, in the buckets where they start or
    end; of those that hold a bucket whole only the first counts. What is left of a target, however many runs it has, is then swept
    by the sources it is part of. Every bucket is swept once in time order, so there are at most as many pieces as marks.
    """
    shared_dir(windows.sparkSession)
    width = bucket_seconds * 1_000_000
    opening, closing = F.col("bucket") * width, F.col("bucket") * width + (width - 1)
    low = F.greatest(F.expr(f"start_us div {width}"), bounds.select("_low").scalar())
    high = F.least(F.expr(f"end_us div {width}"), bounds.select("_high").scalar())
    runs = windows.select(
        F.coalesce("target", F.lit("")).alias("source"), F.col("run_idx").cast("long").alias("run_idx"),
        micros(F.col("start_ts")).alias("start_us"), micros(F.col("end_ts")).alias("end_us")).filter(F.col("start_us") <= F.col("end_us"))
    runs = (
        runs.withColumn("_first", low).withColumn("_last", high).filter("_first <= _last")
        .withColumn("_a", F.col("_first") + (F.col("start_us") > F.col("_first") * width).cast("long"))
        .withColumn("_b", F.col("_last") - (F.col("end_us") < F.col("_last") * width + (width - 1)).cast("long")))
    targets = pairs.select(F.col("target").alias("source")).distinct()
    every = runs.withColumn("source", F.lit(None).cast("string")).unionByName(runs.join(targets, "source", "left_semi"))
    ends = F.array_distinct(F.array_compact(F.array(
        F.when(F.col("_first") < F.col("_a"), F.col("_first")), F.when(F.col("_last") > F.col("_b"), F.col("_last")))))
    ending = every.withColumn("bucket", F.explode(ends))
    marks = _opened(ending, width, F.greatest("start_us", opening), F.col("end_us") + 1).unionByName(
        _opened(_covers(every), width, opening, closing + 1))
    first = _swept(marks, width).checkpoint()
    of_target = first.filter("source is not null").withColumnRenamed("source", "target").join(pairs, "target")
    of_source = _swept(_opened(of_target.select("bucket", "source", "run_idx", "from_us", "until_us"), width, F.col("from_us"), F.col("until_us") + 1), width)
    return first.filter("source is null").unionByName(of_source)


def label_alerts(alerts: DataFrame, windows: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Alerts within a run window with the label of one run; others are dropped.

    Of several candidate runs, the first in file order whose target is part of the alert's
    source address wins, else the first in file order. The choice is prepared on the side of
    the runs, so an alert meets one piece of all runs and one of its source at most: alerts are neither
    multiplied nor grouped. The pieces are stored with what a label needs of their runs and counted; if those of all runs, or of sources, are few
    they are broadcast and the alerts not shuffled, else both are joined on the time bucket, where adaptive execution splits full buckets.
    """
    shared_dir(alerts.sparkSession)
    timed = alerts.withColumn("alert_ts", alert_time()).withColumn("_us", micros(F.col("alert_ts"))).withColumn(
        "_bucket", F.expr(f"_us div {bucket_seconds * 1_000_000}")).withColumn("_source", F.coalesce("data.srcip", F.lit("")))
    bounds = timed.agg(F.min("_bucket").alias("_low"), F.max("_bucket").alias("_high")).checkpoint()
    pairs = targets_in(timed.select(F.col("_source").alias("source")).filter("source != ''").distinct(), windows).checkpoint()
    # Rows of one run_idx stay together, so a run given twice counts once for a piece and twice for an alert.
    runs = windows.groupBy("run_idx").agg(F.collect_list(F.struct("attack_class", "scenario_id", "run_id")).alias("_runs"))
    pieces = segments(windows, pairs, bounds, bucket_seconds).join(runs, "run_idx").drop("run_idx").checkpoint()
    every, own = pieces.filter("source is null").drop("source"), pieces.filter("source is not null")

    def met(left: DataFrame, pieces: DataFrame, out: str, how: str, *same: Column) -> DataFrame:
        few = pieces.count() <= PIECES_BROADCAST
        pieces = pieces.withColumnsRenamed({"_runs": out, "from_us": "_from", "until_us": "_until"})
        on = reduce(lambda a, b: a & b, same, (F.col("_bucket") == F.col("bucket")) & F.col("_us").between(F.col("_from"), F.col("_until")))
        return left.join(F.broadcast(pieces) if few else pieces, on, how).drop("bucket", "source", "_from", "_until")

    found = met(timed, every, "_any", "inner")
    found = met(found, own, "_own", "left", F.col("_source") == F.col("source"))

    def text(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit(""))

    return found.withColumn("_run", F.explode(F.coalesce("_own", "_any"))).select(
        F.col("_run.attack_class").alias("label"), "_run.scenario_id", "_run.run_id",
        text("rule.id").alias("rule_id"), text("rule.level").alias("rule_level"),
        text("rule.description").alias("rule_description"),
        F.coalesce(F.array_join("rule.groups", "|"), F.lit("")).alias("rule_groups"),
        text("agent.id").alias("agent_id"), text("agent.name").alias("agent_name"),
        text("data.srcip").alias("srcip"), text("data.dstuser").alias("dstuser"),
        _iso(F.col("alert_ts")).alias("timestamp"),
        F.col("_event_id").alias("event_id"),
    )


def label_stats(alerts: DataFrame, labelled: DataFrame) -> DataFrame:
    """Alerts matched to a run and alerts skipped."""
    total = alerts.agg(F.count("*").alias("total"))
    return labelled.agg(F.count("*").alias("matched")).select(
        "matched", (total.scalar() - F.col("matched")).alias("skipped"))
