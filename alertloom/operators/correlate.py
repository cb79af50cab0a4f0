"""Counter rules over event time: gaps, sessions, firings, open counts.

A counter grows with every match of a key, expires when the key is quiet for longer than the
window, fires when it reaches the threshold and then starts again. So with matches in
(time, event id) order, a session ends where the gap exceeds the window, and every
threshold-th match of a session fires.
"""

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from alertloom.constants import CORRELATION_SOURCE_TAG
from alertloom.functions.columns import lookup
from alertloom.operators.distinct import fire_distinct
from alertloom.operators.rules import Rule, each_hit, match_counts, matches
from alertloom.operators.skew import TARGET_ROWS, with_chunks
from alertloom.session import work_path

KEYS = ["rule_id", "key"]
CHUNK = [*KEYS, "chunk"]


def _positions(rows: DataFrame) -> DataFrame:
    """Position ``n`` of each row in its session, in one sort per (rule, key, chunk).

    A row of ``kind`` 0 stands for all earlier chunks: the time of the key's last match and,
    as ``weight``, how many matches its open session has.
    """
    order = Window.partitionBy(*CHUNK).orderBy("kind", "ts_us", "event_id")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        rows.withColumn("_break", F.col("ts_us") - F.lag("ts_us").over(order) > F.col("window_us"))
        .withColumn("_seen", F.sum("weight").over(so_far))
        .withColumn("_base", F.max(F.when(F.col("_break"), F.col("_seen") - F.col("weight"))).over(so_far))
        .withColumn("n", F.col("_seen") - F.coalesce("_base", F.lit(0)))
    )


def _carries(rows: DataFrame) -> DataFrame:
    """For each chunk of a hot key, the ``kind`` 0 row that sums up the chunks before it.

    One summary row per chunk is scanned here, never the matches themselves.
    """
    chunks = _positions(rows.select(*CHUNK, "ts_us", "event_id", "window_us", "kind", "weight")).groupBy(*CHUNK).agg(
        F.min("ts_us").alias("first_ts"), F.max("ts_us").alias("last_ts"),
        F.count("*").alias("rows"), F.max("_base").alias("base"), F.max("window_us").alias("window_us"))
    order = Window.partitionBy(*KEYS).orderBy("chunk")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    return (
        chunks.withColumn("prev_ts", F.lag("last_ts").over(order))
        .withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
        .withColumn("session_start", F.col("before") + F.when(F.col("base").isNotNull(), F.col("base")).when(
            F.col("prev_ts").isNull() | (F.col("first_ts") - F.col("prev_ts") > F.col("window_us")), 0))
        .withColumn("open_from", F.max("session_start").over(earlier))
        .filter(F.col("prev_ts").isNotNull())
        .select(*CHUNK, F.lit(0).alias("kind"), F.col("prev_ts").alias("ts_us"),
                (F.col("before") - F.col("open_from")).alias("weight"))
    )


def number_hits(hits: DataFrame, split: str = "auto", target_rows: int = TARGET_ROWS) -> DataFrame:
    """Every match with ``n``, its position in the session of its (rule, key)."""
    chunked, sliced = with_chunks(hits, KEYS, split, target_rows)
    rows = chunked.withColumn("kind", F.lit(1)).withColumn("weight", F.lit(1).cast("long"))
    if sliced:
        rows = rows.unionByName(_carries(rows.filter(F.col("chunk") > 0)), allowMissingColumns=True)
    return (
        _positions(rows).filter(F.col("kind") == 1)
        .drop("kind", "weight", "_break", "_seen", "_base", "chunk")
    )


def fire_counter(hits: DataFrame, split: str = "auto", target_rows: int = TARGET_ROWS) -> DataFrame:
    """The matches at which a counter rule fires."""
    return number_hits(hits, split, target_rows).filter(F.col("n") % F.col("threshold") == 0).drop("n")


def fire(alerts: DataFrame, rules: Sequence[Rule], split: str = "auto",
         target_rows: int = TARGET_ROWS) -> DataFrame:
    """Firings of all rules. Counter rules share one shuffle, so do the distinct rules, and
    rules with threshold 1 fire on every match without any.

    The alerts are read and matched once: each is landed with its hits in the shared folder, and every later pass
    (counting, slicing, the branches) reads from there the columns it needs. Counting shuffles and sorts hits without
    their alerts, which are joined to the firings by their place (``_row``); the firings are hashed, so no alert is sorted.
    """
    matched = landed(alerts, rules)
    hits = each_hit(matched, "ts_us", "event_id", "_row")
    instant = [r.id for r in rules if r.threshold == 1]
    counters = [r.id for r in rules if r.threshold > 1 and r.member is None]
    distinct = [r.id for r in rules if r.threshold > 1 and r.member is not None]
    parts, counted = [], []
    if instant:
        parts.append(each_hit(matched, "ts_us", "event_id", "alert").filter(F.col("rule_id").isin(instant)).drop("member"))
    if counters:
        counted.append(fire_counter(hits.filter(F.col("rule_id").isin(counters)).drop("member"), split, target_rows))
    if distinct:
        counted.append(fire_distinct(hits.filter(F.col("rule_id").isin(distinct)), split, target_rows).drop("member"))
    if counted:
        fired = reduce(DataFrame.unionByName, counted).hint("shuffle_hash")
        parts.append(matched.select("_row", "alert").join(fired, "_row").drop("_row"))
    return reduce(DataFrame.unionByName, parts)


def landed(alerts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The alerts that match a rule, with their hits, in files; ``_row`` numbers them, with gaps."""
    spark = alerts.sparkSession
    found = matches(alerts, rules).withColumn("_row", F.monotonically_increasing_id())
    path = work_path(spark, "hits", uuid.uuid4().hex)
    found.write.parquet(path)
    return spark.read.schema(found.schema).parquet(path)


def build_incidents(fired: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Incident records of firings.

    The id is a hash of rule, key and triggering event, so a replay produces the same
    incident; the time is the triggering event's.
    """
    rule_id = F.col("rule_id")
    return fired.select(
        F.md5(F.concat_ws("|", "rule_id", "key", "event_id")).alias("incident_id"),
        F.timestamp_micros("ts_us").alias("@timestamp"),
        F.struct(
            rule_id.alias("id"),
            lookup({r.id: r.name for r in rules}, rule_id).alias("name"),
            lookup({r.id: r.description for r in rules}, rule_id).alias("description"),
            F.col("threshold"),
            F.expr("cast(window_us div 1000000 as int)").alias("window_sec"),
        ).alias("correlation_rule"),
        lookup({r.id: r.severity for r in rules}, rule_id).alias("severity"),
        F.lit("open").alias("status"),
        F.col("key").alias("correlation_key"),
        F.col("threshold").alias("event_count"),
        F.col("alert").alias("triggering_alert"),
        F.lit(CORRELATION_SOURCE_TAG).alias("_source"),
    )


def correlate(alerts: DataFrame, rules: Sequence[Rule], split: str = "auto",
              target_rows: int = TARGET_ROWS) -> DataFrame:
    """Incidents of enriched alerts."""
    return build_incidents(fire(alerts, rules, split, target_rows), rules)


def open_counts(hits: DataFrame, as_of_us, split: str = "auto", target_rows: int = TARGET_ROWS) -> DataFrame:
    """The count each counter holds at ``as_of_us``: 0 after a firing or once expired."""
    last = number_hits(hits, split, target_rows).groupBy(*KEYS).agg(
        F.max_by(F.struct("ts_us", "n", "window_us", "threshold"), F.struct("ts_us", "event_id")).alias("l"))
    expired = F.lit(as_of_us) - F.col("l.ts_us") > F.col("l.window_us")
    return last.select(
        *KEYS, F.when(expired, 0).otherwise(F.col("l.n") % F.col("l.threshold")).cast("long").alias("open_count"))


def counters(alerts: DataFrame, rules: Sequence[Rule], fired: DataFrame) -> DataFrame:
    """Alerts matched and incidents fired per rule, zeros included."""
    per_rule = fired.groupBy("rule_id").agg(F.count("*").alias("fired"))
    return (
        match_counts(alerts, rules).join(per_rule, "rule_id", "left")
        .select("rule_id", "matched", F.coalesce("fired", F.lit(0)).cast("long").alias("fired"))
    )
