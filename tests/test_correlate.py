"""Counter and distinct rules against event-by-event simulations, whole keys and sliced ones."""

import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from alertloom.operators.correlate import fire_counter, open_counts
from alertloom.operators.distinct import fire_distinct

S = 1_000_000


def simulate_counter(events, window, threshold):
    """(fired event ids, count held after the last event) of one key."""
    n, last, fired = 0, None, []
    for ts, eid, _ in sorted(events):
        if last is not None and ts - last > window:
            n = 0
        n, last = n + 1, ts
        if n == threshold:
            fired.append(eid)
            n = 0
    return fired, n


def simulate_distinct(events, window, threshold):
    seen, last, fired = set(), None, []
    for ts, eid, member in sorted(events):
        if last is not None and ts - last > window:
            seen = set()
        seen.add(member)
        last = ts
        if len(seen) == threshold:
            fired.append(eid)
            seen = set()
    return fired


SCHEMA = "rule_id string, key string, member string, window_us bigint, threshold int, ts_us bigint, event_id string"


def frame(spark, streams):
    """streams: key -> (window s, threshold, [(ts µs, event id, member)])"""
    rows = [("R", key, m, w * S, k, ts, eid) for key, (w, k, events) in streams.items() for ts, eid, m in events]
    return spark.createDataFrame(rows, SCHEMA)


def fired_of(df):
    out = {}
    for r in df.orderBy("key", "ts_us", "event_id").collect():
        out.setdefault(r["key"], []).append(r["event_id"])
    return out


MODES = [("never", 10), ("always", 1), ("always", 3), ("always", 17)]


def random_streams(seed, keys=40, members=4):
    rnd = random.Random(seed)
    streams = {}
    for k in range(keys):
        window, threshold = rnd.choice([30, 60, 300]), rnd.choice([1, 2, 3, 5])
        ts, events = 1_704_067_200 * S, []
        for i in range(rnd.randint(1, 60)):
            ts += rnd.choice([0, 1, 5 * S, 20 * S, window * S, window * S, window * S + 1, 3 * window * S])
            events.append((ts, f"{rnd.randint(0, 99):02d}-{i:03d}", f"h{rnd.randint(0, members)}"))
        streams[f"k{k}"] = (window, threshold, events)
    return streams


@pytest.mark.parametrize("split,target", MODES)
def test_counter_matches_simulation(spark, split, target):
    streams = random_streams(1)
    expected = {k: f for k, (w, t, e) in streams.items() if (f := simulate_counter(e, w * S, t)[0])}
    assert fired_of(fire_counter(frame(spark, streams), split, target)) == expected


@pytest.mark.parametrize("split,target", MODES)
def test_distinct_matches_simulation(spark, split, target):
    streams = random_streams(2)
    expected = {k: f for k, (w, t, e) in streams.items() if (f := simulate_distinct(e, w * S, t))}
    assert fired_of(fire_distinct(frame(spark, streams), split, target)) == expected


@settings(max_examples=8, deadline=None)
@given(data=st.lists(
    st.tuples(st.integers(2, 4), st.lists(st.tuples(st.sampled_from([0, 1, 59, 60, 61, 200]), st.integers(0, 3)),
                                          min_size=1, max_size=25)),
    min_size=1, max_size=12))
def test_generated_streams(spark, data):
    streams = {}
    for i, (threshold, steps) in enumerate(data):
        ts, events = 0, []
        for j, (gap, member) in enumerate(steps):
            ts += gap * S
            events.append((ts, f"{j:03d}", f"h{member}"))
        streams[f"k{i}"] = (60, threshold, events)
    df = frame(spark, streams).cache()
    assert fired_of(fire_counter(df, "always", 2)) == {
        k: f for k, (w, t, e) in streams.items() if (f := simulate_counter(e, w * S, t)[0])}
    assert fired_of(fire_distinct(df, "always", 2)) == {
        k: f for k, (w, t, e) in streams.items() if (f := simulate_distinct(e, w * S, t))}
    df.unpersist()


def test_hand_made_counter_cases(spark):
    cases = {
        "a": [0, 50, 100], "b": [0, 60, 121], "c": [0, 60, 120], "d": [0, 10, 20, 30, 40, 50],
        "e": [0, 10, 20, 85, 95, 105], "f": [0, 0, 0],
    }
    streams = {k: (60, 3, [(t * S, f"{i}", None) for i, t in enumerate(ts)]) for k, ts in cases.items()}
    assert fired_of(fire_counter(frame(spark, streams))) == {
        "a": ["2"], "c": ["2"], "d": ["2", "5"], "e": ["2", "5"], "f": ["2"]}


def test_hand_made_distinct_cases(spark):
    cases = {
        "a": [(0, "h1"), (100, "h2"), (350, "h1"), (600, "h3")],
        "b": [(0, "h1"), (100, "h2"), (600, "h3")],
        "c": [(0, "h1"), (1, "h2"), (2, "h3"), (3, "h3"), (4, "h1"), (5, "h2")],
        "d": [(i, "h1") for i in range(10)],
    }
    streams = {k: (300, 3, [(t * S, f"{i}", m) for i, (t, m) in enumerate(ev)]) for k, ev in cases.items()}
    for split in ("never", "always"):
        assert fired_of(fire_distinct(frame(spark, streams), split, 1)) == {"a": ["3"], "c": ["2", "5"]}


def test_one_key_with_most_rows(spark):
    """A key with most rows in a burst is cut into many slices, and nothing is lost."""
    rnd = random.Random(5)
    burst = [(rnd.randint(0, 120) * S + rnd.randint(0, S - 1), f"{i:05d}", f"h{rnd.randint(0, 30)}") for i in range(4000)]
    streams = {"hot": (60, 5, burst), **random_streams(6, keys=10)}
    df = frame(spark, streams)
    from alertloom.operators.skew import with_chunks

    chunks, _ = with_chunks(df, ["rule_id", "key"], "always", 100)
    sizes = [r["count"] for r in chunks.filter("key = 'hot'").groupBy("chunk").count().collect()]
    assert sum(sizes) == 4000 and len(sizes) > 20 and max(sizes) < 400
    assert fired_of(fire_counter(df, "always", 100))["hot"] == simulate_counter(burst, 60 * S, 5)[0]
    assert fired_of(fire_distinct(df, "always", 100))["hot"] == simulate_distinct(burst, 60 * S, 5)


@pytest.mark.parametrize("split", ["never", "always"])
def test_open_counts(spark, split):
    streams = random_streams(3)
    as_of = max(ts for _, _, e in streams.values() for ts, _, _ in e)
    held = {}
    for k, (w, t, e) in streams.items():
        held[k] = 0 if as_of - max(x[0] for x in e) > w * S else simulate_counter(e, w * S, t)[1]
    rows = open_counts(frame(spark, streams), as_of, split, 5).collect()
    assert {r["key"]: r["open_count"] for r in rows} == held


MATCHER_CASES = [
    # rule id, severity, category, source, matching rules
    ("5710", "high", "sshd", "203.0.113.9", {1, 3, 4, 5}),
    ("1", "low", "authentication_failures", "unknown", {4}),
    ("1", "low", "brute_force, authentication_failures", "unknown", {1, 4}),
    ("1", "critical", "privilege_escalation", "unknown", {2, 4, 5}),
    ("1", "critical", "windows_security", "unknown", {4, 5}),
    ("100201", "critical", "recon, port_scan", "203.0.113.9", {3, 4, 5, 6}),
    ("1", "medium", "recon, port_scan", "unknown", {4}),
]


def test_rule_matchers(spark):
    from alertloom.operators.rules import RULES, fan_out

    rows = [(str(i), r, s, c, ip) for i, (r, s, c, ip, _) in enumerate(MATCHER_CASES)]
    alerts = spark.createDataFrame(rows, "id string, r string, s string, c string, ip string").select(
        F.struct("id", F.col("s").alias("severity")).alias("event"),
        F.struct(F.col("r").alias("id"), F.col("c").alias("category")).alias("rule"),
        F.struct(F.col("ip").alias("ip")).alias("source"), F.struct(F.lit("h").alias("name")).alias("host"),
        F.current_timestamp().alias("event_ts"))
    got = {}
    for r in fan_out(alerts, RULES).select("event_id", "rule_id").collect():
        got.setdefault(int(r["event_id"]), set()).add(int(r["rule_id"][-1]))
    assert got == {i: case[-1] for i, case in enumerate(MATCHER_CASES)}


def test_a_burst_and_a_sparse_time_are_cut_alike(spark):
    from alertloom.operators.skew import with_chunks

    burst = "SELECT 'R' AS rule_id, 'hot' AS key, 1000000000 + id * 97 AS ts_us, id FROM range(10000)"
    sparse = "SELECT 'R', 'hot', 3000000000 + id * 60000000, id FROM range(10000)"
    moment = "SELECT 'R', 'moment', 5000000000, id FROM range(500)"
    cold = "SELECT 'R', 'cold', id * 1000, id FROM range(100)"
    df = spark.sql(f"{burst} UNION ALL {sparse} UNION ALL {moment} UNION ALL {cold}")
    chunks, sliced = with_chunks(df, ["rule_id", "key"], "auto", 100)
    rows = chunks.groupBy("key", "chunk").agg(
        F.count("*").alias("n"), F.min("ts_us").alias("a"), F.max("ts_us").alias("b")).orderBy("key", "chunk").collect()
    hot = [r for r in rows if r["key"] == "hot"]
    assert sliced and len(hot) <= 2 * 20_000 // 100 and max(r["n"] for r in hot) <= 200 and sum(r["n"] for r in hot) == 20_000
    assert all(x["b"] < y["a"] for x, y in zip(hot, hot[1:]))
    assert [(r["key"], r["n"]) for r in rows if r["key"] != "hot"] == [("cold", 100), ("moment", 500)]
    assert with_chunks(df, ["rule_id", "key"], "auto", 30_000)[1] is False and with_chunks(df, ["rule_id", "key"], "always", 20_000)[1] is False


def test_hits_are_sorted_without_their_alerts(spark):
    from alertloom.operators.correlate import fire
    from alertloom.operators.rules import RULES

    rows = [(str(i % 50), f"note {i % 50}") for i in range(100)]  # every alert comes twice, with the same id
    alerts = spark.createDataFrame(rows, "id string, note string").select(
        F.struct("id", F.lit("low").alias("severity"), F.col("note").alias("reason")).alias("event"),
        F.struct(F.lit("1").alias("id"), F.lit("x").alias("category")).alias("rule"),
        F.struct(F.lit("10.0.0.1").alias("ip")).alias("source"), F.struct(F.lit("h").alias("name")).alias("host"),
        F.timestamp_seconds(F.col("id").cast("long")).alias("event_ts"))
    fired = fire(alerts, RULES)
    plan = fired._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and not any("alert#" in line.partition("Window")[2] for line in windows)
    found = sorted((r["event_id"], r["alert"]["event"]["reason"]) for r in fired.collect())
    assert found == sorted((str(i), f"note {i}") for i in (9, 19, 29, 39, 49))
