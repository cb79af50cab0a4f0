"""Parsing, normalisation and enrichment on hand-made lines."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from alertloom.functions import normalize as n
from alertloom.sources import alerts as feed, tables
from alertloom.sources.connectors import Topics

LINES = [
    '{"id":"1.1","timestamp":"2026-07-16T11:47:50.000+0000","rule":{"id":"5710","level":5,"description":"sshd failure",'
    '"groups":["syslog","sshd","authentication_failed"]},"agent":{"id":"004","name":"web-srv-01","ip":"192.168.10.21"},'
    '"full_log":"Failed password for root","data":{"srcip":"203.0.113.9","srcport":"51000"}}',
    '  {"id":"1.2","timestamp":"2026-07-16T11:47:51Z","rule":{"id":"100201","level":10,"groups":["recon"]},'
    '"agent":{"name":"Ubuntu-edge"},"data":{"source_ip":"203.0.113.9"}}\t',
    '{"id":"1.3"}', "", " \t", "{bad json", '{"id":"1.4","rule":{"level":"high"}}', '{"id":"1.5","data":null}',
    '{"rule":{"level":"7"}}', "17", '[{"id":"x"}]', '{"id":"1.6","data":"text"}',
]


@pytest.fixture(scope="module")
def parsed(spark):
    return feed.parse(spark.createDataFrame([(x,) for x in LINES], "value string"))


def test_dead_letters(parsed):
    got = {r["payload"]: r["_error"] for r in feed.dead_letters(parsed).collect()}
    assert got == {"{bad json": "malformed", LINES[6]: "level", "17": "malformed", LINES[10]: "malformed",
                   LINES[11]: "malformed"}


def test_normalised_fields(spark, parsed):
    alerts = n.enrich(n.normalize(feed.stamp(feed.good(parsed))), tables.seed_assets(spark))
    rows = {r["event"]["id"]: r for r in alerts.collect()}
    assert len(rows) == 5
    a, b, c = rows["1.1"], rows["1.2"], rows["1.3"]
    assert (a["event"]["severity"], a["event"]["category"], a["host"]["os"]["type"]) == ("high", "security", "unknown")
    assert a["rule"]["category"] == "syslog, sshd, authentication_failed"
    assert tuple(a["asset"]) == ("web-srv-01", 2, "web-server")
    assert tuple(a["source"]) == ("203.0.113.9", "51000") and a["destination"]["ip"] == "unknown"
    assert (b["event"]["severity"], b["host"]["os"]["type"], b["source"]["ip"]) == ("critical", "linux", "203.0.113.9")
    assert tuple(b["asset"]) == ("unknown", 1, "unknown")
    assert (c["event"]["severity"], c["event"]["category"], c["rule"]["category"], c["event"]["reason"]) == (
        "info", "process", "unknown", "Unknown")
    assert rows["1.5"]["source"]["ip"] == "unknown"
    hashed = [r for k, r in rows.items() if len(k) == 64]
    assert len(hashed) == 1 and hashed[0]["event"]["severity"] == "critical"


def test_level_and_name_boundaries(spark):
    levels = {-1: "info", 0: "info", 1: "low", 2: "low", 3: "medium", 4: "medium", 5: "high", 6: "high", 7: "critical", 15: "critical"}
    df = spark.createDataFrame([(k,) for k in levels], "l int")
    assert {r[0]: r[1] for r in df.select("l", n.severity_of_level(F.col("l"))).collect()} == levels
    names = {"Ubuntu-x": "linux", "WIN-1": "windows", "darwin-1": "windows", "x": "unknown", "ubuntu-win": "linux"}
    df = spark.createDataFrame([(k,) for k in names], "n string")
    assert {r[0]: r[1] for r in df.select("n", n.os_of_name(F.col("n"))).collect()} == names
    df = spark.createDataFrame([(k,) for k in (0, 99, 100, 101)], "k int")
    text = F.expr("repeat('é', k)")
    assert {r[0]: r[1] for r in df.select("k", F.length(n.log_template(text))).collect()} == {0: 0, 99: 99, 100: 100, 101: 100}


def test_invalid_utf8_is_replaced(spark, tmp_path):
    (tmp_path / "a.json").write_bytes(b'{"id":"u","full_log":"a\xffb"}\n')
    row = feed.ingest(feed.read_lines(spark, str(tmp_path))).first()
    assert row["full_log"] == "a�b"


def test_loading_assets_twice_adds_nothing(spark):
    seed = tables.seed_assets(spark)
    assert tables.insert_missing(seed, seed, "hostname").count() == 5


def test_duplicate_addresses_do_not_multiply_alerts(spark, parsed):
    seed = tables.seed_assets(spark)
    twice = seed.unionByName(seed.withColumn("hostname", F.concat(F.lit("z-"), "hostname")))
    alerts = n.enrich(n.normalize(feed.stamp(feed.good(parsed))), twice)
    assert alerts.count() == 5
    assert {r[0] for r in alerts.select("asset.hostname").collect()} == {"unknown", "web-srv-01"}


def test_file_topics_are_packed_and_plain_files_read(spark, tmp_path):
    topics = Topics("files", str(tmp_path))
    topics.write(spark.range(3).select(F.col("id").alias("v")), "t")
    assert [f for f in (tmp_path / "t").glob("part-*")] == [f for f in (tmp_path / "t").glob("part-*.gz")] != []
    (tmp_path / "t" / "plain.txt").write_text('{"v":9}\n')
    assert sorted(r[0] for r in topics.read(spark, "t").collect()) == ['{"v":0}', '{"v":1}', '{"v":2}', '{"v":9}']


def test_file_topics_round_trip(spark, tmp_path):
    topics = Topics("files", str(tmp_path))
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    topics.write(df, "t", key="k")
    assert sorted(r[0] for r in topics.read(spark, "t").collect()) == ['{"k":"a","v":1}', '{"k":"b","v":2}']
    with pytest.raises(ValueError):
        Topics("carrier-pigeon", "x")


def test_retention_and_dated_table(spark, tmp_path):
    df = spark.sql("SELECT timestamp'2026-01-01' + make_dt_interval(i) AS ts, i FROM (SELECT explode(sequence(0, 39)) AS i)")
    path = str(tmp_path / "dated")
    tables.write_dated(df, path, "ts")
    as_of = F.lit("2026-02-09").cast("timestamp")
    kept = tables.retain(spark.read.parquet(path), "incidents", F.col("ts"), as_of)
    assert kept.agg(F.min("i"), F.count("*")).first() == (9, 31)
    assert tables.retain(df, "alerts_raw", F.col("ts"), as_of).count() == 2


def test_days_beyond_retention_are_deleted(spark, tmp_path):
    df = spark.sql("SELECT timestamp'2026-01-01' + make_dt_interval(i) AS ts, i FROM (SELECT explode(sequence(0, 9)) AS i)")
    path = str(tmp_path / "dated")
    tables.write_dated(df, path, "ts")
    gone = tables.expire(spark, path, "alerts_normalized", datetime.date(2026, 1, 10))
    assert gone == [datetime.date(2026, 1, 1), datetime.date(2026, 1, 2)]
    assert spark.read.parquet(path).agg(F.min("i")).first()[0] == 2 and tables.expire(spark, path, "alerts_normalized", datetime.date(2026, 1, 10)) == []


def test_retention_prunes_days(spark, tmp_path):
    path = str(tmp_path / "dated")
    tables.write_dated(spark.sql("SELECT timestamp'2026-01-01' + make_dt_interval(i) AS ts, i FROM (SELECT explode(sequence(0, 39)) AS i)"), path, "ts")
    kept = tables.retain(spark.read.parquet(path), "alerts_raw", F.col("ts"), F.lit("2026-02-09").cast("timestamp"))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and kept.count() == 2


def test_run_logs_are_in_order_of_names_and_lines(spark, tmp_path):
    head = "scenario_id,attack_class,tool_cmd,target,start_time_utc,end_time_utc,run_note\n"
    line = '{0},brute_force,x,t,2026-07-16T11:47:43+00:00,2026-07-16T11:48:10+00:00,"a\nb"\n'
    (tmp_path / "b.csv").write_text(head + "".join(line.format(f"b{i}") for i in range(50)))
    (tmp_path / "a.csv").write_text(head + line.format("a0") + line.format("a1"))
    rows = tables.read_run_log(spark, str(tmp_path)).orderBy("run_idx").collect()
    assert [r["run_idx"] for r in rows] == list(range(52))
    assert [r["scenario_id"] for r in rows] == ["a0", "a1", *[f"b{i}" for i in range(50)]] and rows[0]["run_note"] == "a\nb"


def test_run_log_and_matrix(spark, tmp_path):
    (tmp_path / "runs.csv").write_text(
        "scenario_id,attack_class,tool_cmd,target,start_time_utc,end_time_utc,run_note\n"
        'BRUTE-01,brute_force,tool -l root,10.0.0.1,2026-07-16T11:47:43.040621+00:00,2026-07-16T11:48:10.860210+00:00,"rep 1/15, threads=8"\n')
    row = tables.run_windows(tables.read_run_log(spark, str(tmp_path / "runs.csv"))).withColumn(
        "s", F.date_format("start_ts", "HH:mm:ss.SSSSSS")).withColumn("e", F.date_format("end_ts", "HH:mm:ss.SSSSSS")).first()
    assert row["run_id"] == "BRUTE-01__2026-07-16T11:47:43.040621+00:00"
    assert (row["s"], row["e"]) == ("11:47:38.040621", "11:48:15.860210")
    (tmp_path / "m.csv").write_text(
        "scenario_id,attack_class,tool,command_template,target,repetitions,expected_wazuh_rule_id,notes\n"
        'DOS-01,alert_storm,nmap,x {t},multiple hosts,10,100201+CORR-004,"a, b"\n')
    m = tables.read_attack_matrix(spark, str(tmp_path / "m.csv")).first()
    assert (m["repetitions"], m["notes"]) == (10, "a, b")


def test_timed_ingest_leaves_undated_alerts_out(spark):
    dated = {"id": "1", "timestamp": "2024-01-01T00:00:00.000+0000", "rule": {"level": 3, "id": "5710"}}
    lines = [json.dumps(r) for r in (dated, {**dated, "id": "2", "timestamp": None}, {**dated, "id": "3", "timestamp": "soon"},
                                     {**dated, "id": "4", "timestamp": "2999-01-01T00:00:00.000+0000"})]
    df = spark.createDataFrame([(r,) for r in lines], "value string")
    assert {r["_event_id"] for r in feed.ingest(df, timed=True).collect()} == {"1"}
    assert feed.ingest(df).count() == 4


def test_streams_write_packed_topics(spark, tmp_path):
    from alertloom.streaming import jobs

    topics = Topics("files", str(tmp_path))
    topics.write(spark.range(3).select(F.col("id").alias("v")), "t")
    found = topics.read_stream(spark, "t").select(F.length("value").alias("n"))
    jobs.run_available(topics.write_stream(found, "out", str(tmp_path / "checkpoint")))
    assert [f for f in (tmp_path / "out").glob("part-*")] == [f for f in (tmp_path / "out").glob("part-*.gz")] != []
    assert [r[0] for r in topics.read(spark, "out").collect()] == ['{"n":7}'] * 3
