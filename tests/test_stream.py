"""Streams give the batch result however the input is cut, across restarts, and count late rows."""

import itertools
import os
import random
import time
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from alertloom.functions.normalize import enrich, normalize
from alertloom.operators.correlate import correlate
from alertloom.operators.rules import RULES, scaled
from alertloom.sources import alerts as feed, tables
from alertloom.streaming import jobs
from alertloom.streaming.correlate import correlate_stream, reconcile

STARTED = int(time.time()) - 86_400
FLUSH = '{"id":"flush","timestamp":"2026-08-16T00:00:00+00:00","agent":{"name":"flush"}}'


def alert_line(i, second):
    level = i % 16
    rule = ["5710", "100201", "530"][i % 3]
    return (f'{{"id":"{i:05d}","timestamp":"2026-07-16T{10 + second // 3600:02d}:{second // 60 % 60:02d}:{second % 60:02d}.{i % 1000:03d}+00:00",'
            f'"rule":{{"id":"{rule}","level":{level},"groups":["sudo"]}},'
            f'"agent":{{"name":"h{i % 5}","ip":"192.168.10.21"}},"data":{{"srcip":"10.0.0.{i % 4}"}}}}')


def lines():
    rnd = random.Random(9)
    seconds = sorted(rnd.randint(0, 9000) for _ in range(600))
    return [alert_line(i, s) for i, s in enumerate(seconds)]


landed = itertools.count()


def land(folder, name, rows):
    """A whole file moved into the landing folder, a second younger than the one before: a stream takes files by their times."""
    folder.mkdir(exist_ok=True)
    part = folder / f".{name}.part"
    part.write_text("\n".join(rows) + "\n")
    at = STARTED + next(landed)
    os.utime(part, (at, at))
    part.rename(folder / name)


def run_correlation(spark, base, lateness="0 seconds"):
    alerts = jobs.enriched_stream(feed.follow_lines(spark, str(base / "landing"), max_files=1), tables.seed_assets(spark))
    found = correlate_stream(alerts, RULES, lateness)
    return jobs.run_available(jobs.to_table(found, str(base / "out"), str(base / "checkpoint")), 300)


def batch_ids(spark, rows, rules=RULES):
    df = spark.createDataFrame([(r,) for r in rows], "value string")
    alerts = enrich(normalize(feed.ingest(df)), tables.seed_assets(spark))
    return sorted((r["incident_id"], r["triggering_alert"]["host"]["name"]) for r in correlate(alerts, rules).collect())


def stream_ids(spark, base):
    return sorted((r["incident_id"], r["triggering_alert"]["host"]["name"]) for r in spark.read.parquet(str(base / "out")).collect())


def test_correlation_across_batches_and_restart(spark, tmp_path):
    rows = lines()
    landing = tmp_path / "landing"
    shuffled = rows[:250]
    random.Random(1).shuffle(shuffled)
    land(landing, "a.json", shuffled)
    run_correlation(spark, tmp_path)
    land(landing, "b.json", rows[250:400])
    run_correlation(spark, tmp_path)
    land(landing, "c.json", rows[400:])
    land(landing, "d.json", [FLUSH])
    run_correlation(spark, tmp_path)
    expected = batch_ids(spark, rows)
    assert expected and stream_ids(spark, tmp_path) == expected


def test_late_alerts_within_the_allowance_count(spark, tmp_path):
    rows = lines()
    swapped = rows[:300] + rows[310:320] + rows[300:310] + rows[320:]
    land(tmp_path / "landing", "a.json", swapped[:305])
    run_correlation(spark, tmp_path, "20 minutes")
    land(tmp_path / "landing", "b.json", swapped[305:])
    land(tmp_path / "landing", "c.json", [FLUSH])
    run_correlation(spark, tmp_path, "20 minutes")
    assert stream_ids(spark, tmp_path) == batch_ids(spark, rows)


def test_alerts_behind_the_watermark_are_dropped_and_counted(spark, tmp_path):
    rows = lines()
    land(tmp_path / "landing", "a.json", rows[100:])
    land(tmp_path / "landing", "b.json", [FLUSH])
    run_correlation(spark, tmp_path)
    land(tmp_path / "landing", "c.json", rows[:1])
    query = run_correlation(spark, tmp_path)
    assert jobs.counters(query)["late"] > 0
    assert stream_ids(spark, tmp_path) == batch_ids(spark, rows[100:])


def test_alerts_without_a_usable_time_do_no_harm(spark, tmp_path):
    rows = lines()
    for k in range(4):
        bad = ['{"id":"u"}', '{"id":"f","timestamp":"2099-01-01T00:00:00Z"}', '{"id":"x","timestamp":"yesterday"}'] if k == 0 else []
        land(tmp_path / "landing", f"{k}.json", rows[k * 150 : (k + 1) * 150] + bad)
    land(tmp_path / "landing", "z.json", [FLUSH])
    query = run_correlation(spark, tmp_path)
    assert jobs.counters(query)["late"] == 0 and stream_ids(spark, tmp_path) == batch_ids(spark, rows)
    parsed = feed.parse(feed.read_lines(spark, str(tmp_path / "landing")), timed=True)
    assert [r["n"] for r in feed.dead_letters(parsed).groupBy("_error").agg(F.count("*").alias("n")).collect()] == [3]


def test_reconciling_adds_and_withdraws(spark, tmp_path):
    rows = lines()
    land(tmp_path / "landing", "a.json", rows[100:])
    land(tmp_path / "landing", "b.json", [FLUSH])
    land(tmp_path / "landing", "c.json", rows[:100])
    run_correlation(spark, tmp_path)
    found = spark.read.parquet(str(tmp_path / "out"))
    landed = feed.ingest(feed.read_lines(spark, str(tmp_path / "landing")))
    alerts = enrich(normalize(landed), tables.seed_assets(spark))
    got = reconcile(found, alerts, RULES).select("incident_id", "state").collect()
    expected = {i for i, _ in batch_ids(spark, rows)}
    assert {r["incident_id"] for r in got if r["state"] != "withdrawn"} == expected
    assert {r["state"] for r in got} >= {"kept", "added"} and found.count() == sum(r["state"] != "added" for r in got)
    right = reconcile(found, alerts, RULES).filter("state != 'withdrawn'").drop("state")
    assert {r["state"] for r in reconcile(right, alerts, RULES).select("state").collect()} == {"kept"}


def test_state_is_empty_after_the_windows(spark, tmp_path):
    land(tmp_path / "landing", "a.json", lines())
    land(tmp_path / "landing", "b.json", [FLUSH])
    land(tmp_path / "landing", "c.json", [FLUSH.replace("2026-08-16", "2026-08-18")])
    run_correlation(spark, tmp_path)
    kept = spark.read.format("statestore").option("stateVarName", "counter").load(str(tmp_path / "checkpoint")).collect()
    assert [r for r in kept if not r["key"]["key"].endswith(("flush", "unknown"))] == []


def test_ingest_resumes_where_it_stopped(spark, tmp_path):
    rows = lines()
    landing = tmp_path / "landing"

    def run():
        alerts = feed.ingest(feed.follow_lines(spark, str(landing)))
        jobs.run_available(jobs.to_table(alerts, str(tmp_path / "out"), str(tmp_path / "checkpoint")))
        return spark.read.parquet(str(tmp_path / "out"))

    land(landing, "a.json", rows[:10] + ["", "{broken"])
    assert run().count() == 10
    land(landing, "b.json", rows[10:30])
    out = run()
    assert out.count() == 30 and out.select("_event_id").distinct().count() == 30


def test_store_batch_tries_every_sink_and_fails(spark, tmp_path):
    from alertloom.plans.derive import score_by_rule

    df = spark.createDataFrame([(r,) for r in lines()], "value string")
    alerts = enrich(normalize(feed.ingest(df)), tables.seed_assets(spark))
    scored = score_by_rule(correlate(alerts, scaled(RULES, 4)))
    blocked = tmp_path / "file"
    blocked.write_text("not a folder")
    try:
        jobs.store_batch(scored, 0, str(blocked), str(tmp_path / "docs"), str(tmp_path / "rejects"))
        raise AssertionError("the batch must fail")
    except RuntimeError as e:
        assert "table" in str(e)
    n = scored.count()
    assert jobs.current_documents(spark, str(tmp_path / "docs")).count() == n
    jobs.store_batch(scored, 0, str(tmp_path / "table"), str(tmp_path / "docs"), str(tmp_path / "rejects"))
    assert jobs.current_documents(spark, str(tmp_path / "docs")).count() == n
    from alertloom.operators.table import read_table

    jobs.store_batch(scored, 0, str(tmp_path / "table"), str(tmp_path / "docs"), str(tmp_path / "rejects"))
    assert read_table(spark, str(tmp_path / "table")).count() == n


def test_ingest_job_keeps_dead_letters_and_counts(spark, tmp_path):
    land(tmp_path / "landing", "a.json", lines()[:20] + ["", "{broken", '{"rule":{"level":"high"}}'])
    writer = jobs.ingest_stream(
        feed.follow_lines(spark, str(tmp_path / "landing")), str(tmp_path / "checkpoint"),
        str(tmp_path / "alerts"), str(tmp_path / "dead"))
    query = jobs.run_available(writer)
    assert spark.read.parquet(str(tmp_path / "alerts")).count() == 20
    assert sorted(r["_error"] for r in spark.read.parquet(str(tmp_path / "dead")).collect()) == ["level", "malformed"]
    counted = jobs.counters(query)
    assert (counted["input"], counted["lines"], counted["errors"]) == (23, 22, 2)


def test_counters_are_those_of_all_batches_and_restarts(spark, tmp_path):
    """More micro-batches than Spark keeps reports of."""
    rows = lines()

    def run():
        parsed = jobs.observed(feed.parse(feed.follow_lines(spark, str(tmp_path / "landing"), max_files=1)))
        return jobs.counters(jobs.run_available(parsed.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "checkpoint"))))

    for k in range(104):
        land(tmp_path / "landing", f"{k:03d}.json", [rows[k], "{broken"])
    first = run()
    assert first["batches"] >= 104 and (first["input"], first["lines"], first["errors"], first["late"]) == (208, 208, 104, 0)
    land(tmp_path / "landing", "more.json", rows[200:207])
    again = run()
    assert again["batches"] > first["batches"] and (again["input"], again["lines"], again["errors"], again["late"]) == (215, 215, 104, 0)


class _Cell(dict):
    """A map or value state in memory that counts what is written."""

    def __init__(self, written):
        super().__init__()
        self.written = written

    def updateValue(self, key, value):
        self.written.append(value)
        self[key] = value

    def getValue(self, key):
        return self[key]

    def removeKey(self, key):
        del self[key]

    def keys(self):
        return iter(list(super().keys()))

    def exists(self):
        return () in self

    def get(self):
        return self[()]

    def update(self, value):
        self[()] = value


class _Handle:
    """The state of one key."""

    def __init__(self):
        self.states, self.written, self.timers = {}, [], set()

    def getMapState(self, name, *_):
        return self.states.setdefault(name, _Cell(self.written if name == "pieces" else []))

    def getValueState(self, name, *_):
        return self.states.setdefault(name, _Cell([]))

    def registerTimer(self, at):
        self.timers.add(at)


def _step(processor, handle, key, rows, passed_us):
    """One micro-batch of a key, in Arrow batches of 100 rows, and its timers; the ids of the events that fire."""
    names = ["ts_us", "event_id", "member", "alert"]
    batches = (pd.DataFrame(rows[i:i + 100], columns=names) for i in range(0, len(rows), 100))
    times = SimpleNamespace(getCurrentWatermarkInMs=lambda: passed_us // 1000)
    if rows:
        assert list(processor.handleInputRows(key, batches, times)) == []
    fired = []
    for at in sorted(t for t in handle.timers if t <= passed_us // 1000):
        for out in processor.handleExpiredTimer(key, times, None):
            fired += out["event_id"].tolist()
        handle.timers.discard(at)
    return fired


def _counted(rows, window_us, threshold, distinct):
    last, seen, fired = None, [], []
    for ts, event_id, member, _ in sorted(rows):
        seen = [] if last is not None and ts - last > window_us else seen
        last = ts
        if not (distinct and member in seen):
            seen.append(member)
            if len(seen) == threshold:
                fired.append(event_id)
                seen = []
    return fired


def test_waiting_matches_in_small_pieces_fire_as_counted_whole(monkeypatch):
    from alertloom.streaming import correlate as c

    monkeypatch.setattr(c, "PIECE", 7)
    monkeypatch.setattr(c, "MERGE", 11)
    rnd = random.Random(5)
    for distinct in (False, True):
        rows = [(rnd.randrange(0, 4000) * 1000, f"{i:05d}", f"m{rnd.randrange(4)}", "{}") for i in range(3000)]
        rows += rows[:50]
        rows = [r for r in rows if r[0] // 100_000 % 3]
        arrival = lambda r: r[0] // 1_000_000 + r[0] // 1000 % 2
        processor, handle = c._Counter({"R": (20_000, 3, distinct)}), _Handle()
        processor.init(handle)
        fired = []
        for k in range(5):
            late = [r for r in rows if arrival(r) == k]
            rnd.shuffle(late)
            fired += _step(processor, handle, ("R", "h"), late, (k - 1) * 1_000_000 if k else 0)
        fired += _step(processor, handle, ("R", "h"), [], 60_000_000)
        assert fired == _counted(rows, 20_000, 3, distinct) and len(fired) > 100
        _step(processor, handle, ("R", "h"), [], 120_000_000)
        assert not any(handle.states.values()) and not handle.timers


def test_a_step_leaves_matches_that_wait_on_where_they_are():
    """A watermark that passes a few of 50 000 waiting matches reads and writes a few pieces, not the key."""
    from alertloom.streaming import correlate as c

    rows = [(i * 1_000_000, f"{i:06d}", "m", "{}") for i in range(50_000)]
    processor, handle = c._Counter({"R": (2_000_000, 3, False)}), _Handle()
    processor.init(handle)
    assert _step(processor, handle, ("R", "h"), rows, 0) == []
    handle.written.clear()
    assert _step(processor, handle, ("R", "h"), [], 30_500_000) == [f"{i:06d}" for i in range(2, 31, 3)]
    assert len(handle.written) == 1 and len(c._unpacked(handle.written[0][0])) < 100
    assert sum(size for (size,) in handle.states["begins"].values()) == 50_000 - 31


def test_a_run_without_a_bound_is_not_ended(spark):
    """A query that needs longer than ten minutes."""
    asked = []
    query = SimpleNamespace(awaitTermination=lambda *bound: asked.append(bound) or (None if not bound else False), stop=lambda: None)
    writer = SimpleNamespace(trigger=lambda **_: SimpleNamespace(start=lambda: query))
    assert jobs.run_available(writer) is query and asked == [()]
    with pytest.raises(TimeoutError):
        jobs.run_available(writer, 1)
