"""Detection rules on hand-made lines and against event-by-event simulations."""

import random

import pytest
from pyspark.sql import functions as F

from alertloom.operators import detect, portscan

S = 1_000_000
LINES = [
    "filterlog: 5,,,1000000103,em0,match,block,in,4,0x0,,64,12345,0,DF,6,tcp,60,203.0.113.9,192.168.10.104,51000,22,0",
    "filterlog: 5,,,1000000103,em0,match,pass,in,4,0x0,,64,12346,0,DF,6,tcp,60,203.0.113.9,192.168.10.104,51001,443,0",
    "filterlog: 5,,,1000000103,em0,match,block,in,4,0x0,,64,12347,0,none,1,icmp,84,203.0.113.9,192.168.10.104,request",
    "sshd: Failed password for root",
]


def test_firewall_lines(spark):
    df = spark.createDataFrame([(x,) for x in LINES], "value string")
    rows = detect.firewall_alerts(detect.parse_firewall(df)).collect()
    assert len(rows) == 2
    r = next(x for x in rows if x["action"] == "block")
    assert (r["interface"], r["reason"], r["protocol_id"], r["protocol"], r["srcip"], r["dstip"], r["srcport"], r["dstport"]) == (
        "em0", "match", "6", "tcp", "203.0.113.9", "192.168.10.104", "51000", "22")
    assert r["level"] == 3 and r["description"] == (
        "pfSense: firewall filter log event (block tcp 203.0.113.9:51000 -> 192.168.10.104:22)")


def test_firewall_lines_behind_syslog_headers(spark):
    rest = LINES[0].removeprefix("filterlog: ")
    heads = ["filterlog[42]: ", "<134>Jul  6 11:47:50 filterlog[42]: ", "Jul 16 11:47:50 fw-1 filterlog: ", "<134>1 2026-07-16T11:47:50Z fw-1 filterlog 42 - - ",
             '<134>1 2026-07-16T11:47:50Z fw-1 filterlog 42 - [x@1 a="b"] ', "2026-07-16T11:47:50.123+00:00 fw-1 filterlog[42]: "]
    others = ["Jul 16 11:47:50 fw-1 sshd: filterlog: " + rest, "xfilterlog: " + rest, "filterlog: 5,,,", "filterlog"]
    df = spark.createDataFrame([(h + rest,) for h in heads] + [(x,) for x in others], "value string")
    rows = detect.parse_firewall(df).collect()
    assert len(rows) == len(heads) and {(r["interface"], r["srcip"], r["dstport"]) for r in rows} == {("em0", "203.0.113.9", "22")}


def simulate_scans(events, seconds, ports, ignore):
    """(event id) of reported scans of one source."""
    events = sorted(events)
    out, last = [], None
    for i, (ts, eid, _) in enumerate(events):
        seen = {p for t, _, p in events[: i + 1] if ts - t <= seconds * S}
        if len(seen) >= ports and (last is None or ts - last > ignore * S):
            out.append(eid)
            last = ts
    return out


def sources(seed, n=25):
    rnd = random.Random(seed)
    out = {}
    for k in range(n):
        ts, rows = 1_704_067_200 * S, []
        for i in range(rnd.randint(1, 120)):
            ts += rnd.choice([1, S, 2 * S, 5 * S, 30 * S, 30 * S + 1, 61 * S]) if rnd.random() < 0.5 else rnd.randint(1, 3 * S)
            rows.append((ts, f"{i:04d}", str(rnd.randint(1, 8))))
        out[f"s{k}"] = rows
    return out


SPLITS = [("never", 1), ("always", 2), ("always", 9), ("always", 40)]


@pytest.mark.parametrize("split,target", SPLITS)
def test_port_scans_match_simulation(spark, split, target):
    data = sources(11)
    df = spark.createDataFrame(
        [(s, "block", p, ts, eid) for s, ev in data.items() for ts, eid, p in ev],
        "srcip string, action string, dstport string, ts_us bigint, event_id string")
    got = {}
    for r in portscan.port_scans(df, 30, 4, 60, split, target).orderBy("srcip", "ts_us").collect():
        got.setdefault(r["srcip"], []).append(r["event_id"])
    assert got == {s: f for s, ev in data.items() if (f := simulate_scans(ev, 30, 4, 60))}


def test_port_scan_cases(spark):
    def scan(ports, action="block", gap=S):
        return [("a", action, str(p), i * gap, f"{i:03d}") for i, p in enumerate(ports)]

    def fired(rows):
        df = spark.createDataFrame(rows, "srcip string, action string, dstport string, ts_us bigint, event_id string")
        return [r["event_id"] for r in portscan.port_scans(df).collect()]

    assert fired(scan(range(10))) == ["009"]
    assert fired(scan(range(9))) == []
    assert fired(scan([22] * 10)) == []
    assert fired(scan(range(60))) == ["009"]
    assert fired(scan(range(75))) == ["009", "070"]
    assert fired(scan(range(20), action="pass")) == []


@pytest.mark.parametrize("split,target", [("never", 1), ("always", 3)])
def test_distinct_ports_edges(spark, split, target):
    """A port closes just after ``seconds``, a missing port is a port, hits of one microsecond follow by id, nothing is lost of a null source."""
    rows = [("a", "1", 0, "0"), ("a", None, 10 * S, "1"), ("a", "2", 30 * S, "2"), ("a", "3", 30 * S + 1, "3"), ("a", "3", 30 * S + 1, "4"),
            ("a", "1", 60 * S, "5"), ("a", "2", 60 * S, "6"), ("a", "9", 60 * S + 1, "7"), ("a", "9", 200 * S, "8"),
            (None, "1", 0, "9"), (None, "2", 0, "10"), (None, "3", 1, "11")]
    df = spark.createDataFrame(rows, "srcip string, dstport string, ts_us bigint, event_id string")
    found = {r["event_id"] for r in portscan.distinct_ports(df, 30, 3, split, target).collect()}
    assert found == {"2", "3", "4", "5", "6", "7", "11"}
    assert portscan.distinct_ports(df.limit(0), 30, 3, split, target).count() == 0


def test_distinct_ports_need_one_shuffle(spark):
    df = spark.range(10).selectExpr("'a' srcip", "string(id) dstport", "id ts_us", "string(id) event_id")
    plan = portscan.distinct_ports(df, 30, 3, "never")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("split,target", SPLITS)
def test_ssh_brute_force_matches_simulation(spark, split, target):
    data = sources(12)
    expected = {}
    for s, ev in data.items():
        ev = sorted(ev)
        hits = [e for i, (ts, e, _) in enumerate(ev) if i >= 5 and ts - ev[i - 5][0] <= 60 * S]
        if hits:
            expected[s] = hits
    rows = [("5710", s, ts, e) for s, ev in data.items() for ts, e, _ in ev] + [("1", "s0", 0, "x"), ("5710", None, 0, "y")]
    df = spark.createDataFrame(rows, "rule_id string, srcip string, ts_us bigint, event_id string")
    got = {}
    for r in detect.ssh_brute_force(df, split, target).orderBy("srcip", "ts_us").collect():
        got.setdefault(r["srcip"], []).append(r["event_id"])
        assert (r["rule_id"], r["level"], r["mitre"]) == ("100210", 10, "T1110")
    assert got == expected


def test_windows_logon_and_rule_class(spark):
    logs = spark.createDataFrame([("60001", "4672"), ("60001", "46720"), ("60002", "4672")], "parent_id string, win_event_id string")
    assert [r["groups"] for r in detect.windows_privilege_logon(logs).collect()] == [["privilege_escalation", "windows_security"]]
    ids = spark.createDataFrame([("100201",), ("5710",), ("100210",), ("1",)], "r string")
    assert [r[0] for r in ids.select(detect.rule_attack_class(F.col("r"))).collect()] == [
        "reconnaissance", "brute_force", "brute_force", None]
