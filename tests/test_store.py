"""Store rows, upsert, constraints, documents and analyst queries on hand-made incidents."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from alertloom.operators import analytics as g, store
from alertloom.operators.features import features
from alertloom.operators.model import is_true_positive
from alertloom.schemas import SCORED_INCIDENT
from alertloom.operators.store import incident_row_schema

T0 = dt.datetime(2026, 7, 16, 12, 0)


def scored(spark, *records):
    return spark.createDataFrame([{**r} for r in records], SCORED_INCIDENT)


def row(i, **over):
    base = dict(
        id=f"{i:032d}", created_at=T0, updated_at=T0, first_seen=T0, last_seen=T0, severity=2, category="brute_force",
        confidence=0.7, source_ips=["10.0.0.1"], target_hosts=["web"], event_count=3, event_ids=None,
        feature_vector=None, ai_summary=None, status="open", assigned_to=None, analyst_notes=None, label=None,
        raw_incident={"incident_id": f"{i}", "correlation_rule": {"id": "CORR-001", "name": "Brute Force Detection"},
                      "ai_inference": {"attack_class": "brute_force", "is_true_positive": True}})
    return {**base, **over}


def table(spark, *rows):
    return spark.createDataFrame(list(rows), incident_row_schema())


def test_store_row_defaults(spark):
    rows = store.store_rows(scored(
        spark,
        {"incident_id": "a", "@timestamp": T0, "severity": "low", "ai_inference": {"attack_class": "x", "confidence": 0.5},
         "triggering_alert": {"source": {"ip": "1.2.3.4"}, "host": {"name": "unknown"}}, "event_count": 4},
        {"incident_id": "b", "correlation_rule": {"name": "Rule"}, "severity": "odd"},
        {"incident_id": "c"},
    ), as_of=F.lit(T0))
    got = {r["id"]: r for r in rows.collect()}
    a, b, c = got["a"], got["b"], got["c"]
    assert (a["severity"], a["category"], a["confidence"], a["source_ips"], a["target_hosts"]) == (0, "x", 0.5, ["1.2.3.4"], None)
    assert (b["severity"], b["category"], b["confidence"], b["event_count"], b["status"]) == (1, "Rule", 0.0, 0, "open")
    assert (c["severity"], c["category"], c["created_at"]) == (1, "unknown", T0)


LATER = T0 + dt.timedelta(hours=1)
SECOND = dict(updated_at=LATER, last_seen=LATER, created_at=LATER, first_seen=LATER, severity=3, confidence=0.9,
              event_count=5, status="closed", category="other", source_ips=["9.9.9.9"])


def check_merged(r):
    assert (r["event_count"], r["confidence"], r["last_seen"], r["updated_at"]) == (5, 0.9, LATER, LATER)
    assert (r["severity"], r["status"], r["category"], r["created_at"], r["first_seen"]) == (2, "open", "brute_force", T0, T0)
    assert r["source_ips"] is None


def test_upsert_by_fold(spark):
    rows = table(spark, row(1, source_ips=None), row(1, **SECOND), row(2)).withColumn("_order", F.col("created_at"))
    got = {r["id"]: r for r in store.fold_upserts(rows, F.col("_order")).collect()}
    assert len(got) == 2
    check_merged(got[f"{1:032d}"])


def test_upsert_into_existing(spark):
    got = store.upsert(table(spark, row(1, source_ips=None), row(3)), table(spark, row(1, **SECOND), row(2)))
    got = {r["id"]: r for r in got.collect()}
    assert len(got) == 3
    check_merged(got[f"{1:032d}"])


def test_constraints(spark):
    rows = table(spark, row(1), row(2, severity=4), row(3, confidence=1.2), row(4, first_seen=None),
                 row(5, source_ips=["not-an-ip"]), row(6, label=7, category="c" * 65), row(7, source_ips=["::1"]),
                 row(8, confidence=None))
    assert {int(r["id"]): r["reasons"] for r in store.rejected(rows).collect()} == {
        2: ["severity out of range"], 3: ["confidence out of range"], 4: ["first_seen is null"],
        5: ["source_ips not addresses"], 6: ["label out of range", "category too long"]}
    assert {int(r["id"]) for r in store.accepted(rows).collect()} == {1, 7, 8}


def test_addresses(spark):
    good = ["1.2.3.4", "255.255.255.255", "10.0.0.0/8", "0.0.0.0/32", "::", "::1", "fe80::1/64", "1:2:3:4:5:6:7:8", "1::8", "::ffff:1.2.3.4", "1:2:3:4:5:6:7::"]
    bad = ["999.1.1.1/999", "1.2.3", "256.1.1.1", "1.2.3.4/33", "1:2:3", "1::2::3", "::1/129", "12345::", "1:2:3:4:5:6:7:8:9", ":", "1.2.3.4.5", ""]
    df = spark.createDataFrame([(a,) for a in good + bad], "a string")
    assert {r["a"] for r in df.filter(F.col("a").rlike(store._ADDRESS)).collect()} == set(good)


def test_documents_keep_last_write(spark):
    rows = scored(spark, {"incident_id": "a", "severity": "low", "_source": "s"}, {"incident_id": "a", "severity": "high"},
                  {"incident_id": "b", "severity": "info"})
    docs = store.documents(rows.withColumn("_o", F.length("severity")), F.col("_o"))
    assert "_source" not in docs.columns
    assert {r["incident_id"]: r["severity"] for r in docs.collect()} == {"a": "high", "b": "info"}


def test_upserts_into_days_are_idempotent(spark, tmp_path):
    from alertloom.operators.table import read_table, upsert_rows

    path = str(tmp_path / "t")
    first = table(spark, row(1, source_ips=None), row(2)).withColumn("_seq", F.lit(0))
    second = table(spark, row(1, **SECOND), row(3)).withColumn("_seq", F.lit(0))
    upsert_rows(path, first)
    for _ in range(2):
        upsert_rows(path, second)
        got = {r["id"]: r for r in read_table(spark, path).collect()}
        assert len(got) == 3
        check_merged(got[f"{1:032d}"])
    upsert_rows(path, second.limit(0))
    assert read_table(spark, path).count() == 3


def test_features(spark):
    rows = features(scored(
        spark,
        {"incident_id": "a", "@timestamp": dt.datetime(2026, 7, 16, 13, 30), "severity": "critical", "event_count": 3,
         "correlation_rule": {"id": "CORR-003", "window_sec": 300, "threshold": 3},
         "triggering_alert": {"asset": {"criticality": 2, "role": "web-server"}, "source": {"ip": "192.168.20.5"}}},
        {"incident_id": "b"},
        {"incident_id": "c", "severity": "odd", "triggering_alert": {"asset": {"criticality": 0, "role": "toaster"}}},
    ))
    cols = [c for c in rows.columns if c.startswith("f_")]
    got = {r["incident_id"]: [r[c] for c in cols] for r in rows.collect()}
    assert got["a"] == [3, 4, 3, 300, 3, 2, 2, 1, 13]
    assert got["b"] == [0, 2, 1, 60, 5, 1, 0, 0, 12]
    assert got["c"] == [0, 2, 1, 60, 5, 1, 0, 0, 12]


def test_true_positive_gate(spark):
    df = spark.createDataFrame([(0.6, "brute_force"), (0.59996, "brute_force"), (0.99, "normal_activity")], "c double, k string")
    assert [r[0] for r in df.select(is_true_positive(F.col("c"), F.col("k"))).collect()] == [True, False, False]


def test_empty_table(spark):
    empty = table(spark)
    assert g.summary(empty).first().asDict() == dict.fromkeys(
        ["total", "open", "critical", "high", "medium", "info", "true_positives"], 0)
    assert [r["value"] for r in g.by_severity(empty).collect()] == [0, 0, 0, 0]
    assert g.by_category(empty).count() == 0
    assert g.page_meta(empty).first()["pages"] == 0
    assert g.timeline(empty, "24h", F.lit(T0)).count() == 0


def test_histogram_edges_and_nulls(spark):
    rows = table(spark, *[row(i, confidence=c) for i, c in enumerate([0.5, 0.7, 0.9, 0.49999, None])])
    assert {r["range"]: r["count"] for r in g.confidence_histogram(rows).collect()} == {
        "90-100%": 1, "70-90%": 1, "50-70%": 1, "<50%": 1}


def test_timeline_boundary(spark):
    rows = table(spark, row(1, created_at=T0), row(2, created_at=T0 - dt.timedelta(hours=24)),
                 row(3, created_at=T0 - dt.timedelta(hours=24, microseconds=1)))
    assert sum(r["total"] for r in g.timeline(rows, "24h", F.lit(T0)).collect()) == 2
    with pytest.raises(ValueError):
        g.timeline(rows, "1y", F.lit(T0))


def test_list_filters_sort_and_pages(spark):
    rows = table(spark, row(1, confidence=None, severity=0), row(2, confidence=0.2), row(3, confidence=0.9, target_hosts=["db%1", "web"]),
                 row(4, confidence=0.5, target_hosts=None, category="lateral_movement"))

    def ids(df):
        return [int(r["id"]) for r in df.collect()]

    assert ids(g.list_incidents(rows, sort="confidence")) == [1, 3, 4, 2]
    assert ids(g.list_incidents(rows, sort="confidence", order="asc")) == [2, 4, 3, 1]
    assert ids(g.list_incidents(rows, sort="id; drop", order="x")) == [1, 2, 3, 4]
    assert ids(g.list_incidents(rows, g.Filters(severity=0))) == [1]
    assert ids(g.list_incidents(rows, g.Filters(status="", category="LATERAL"))) == [4]
    assert ids(g.list_incidents(rows, g.Filters(search="db%1"))) == [3]
    assert ids(g.list_incidents(rows, g.Filters(search="db_1"))) == [3]
    assert ids(g.list_incidents(rows, g.Filters(search="brute force det"))) == [1, 2, 3, 4]
    assert ids(g.list_incidents(rows, page=2, per_page=3)) == [4]
    assert ids(g.list_incidents(rows, page=9)) == []
    first = g.list_incidents(rows, per_page=2).collect()
    assert ids(g.next_page(rows, first[-1]["created_at"], first[-1]["id"], per_page=2)) == [3, 4]
    assert g.page_meta(rows, per_page=3).first().asDict() == {"total": 4, "page": 1, "per_page": 3, "pages": 2}
    with pytest.raises(ValueError):
        g.list_incidents(rows, per_page=101)


@pytest.mark.parametrize("order", ["asc", "desc"])
@pytest.mark.parametrize("sort", sorted(g.SORTS))
def test_deep_pages_are_the_pages_of_the_list(spark, sort, order):
    """Ties, nulls and values far apart; with few rows allowed into the sort every level is used."""
    from alertloom.operators import paging

    n = F.col("n")
    base = table(spark, row(1))
    own = {
        "id": F.concat(F.lit("x"), F.md5(n.cast("string"))),
        "created_at": F.when(n % 7 > 0, F.lit(T0) + F.make_dt_interval((n % 5).cast("int"), F.lit(0), F.lit(0), (n % 3).cast("decimal(18,6)") / 1000)),
        "confidence": F.when(n % 11 > 0, (n % 13) / 12000.0), "event_count": F.when(n % 10 > 0, (n % 4 * 5000).cast("int")),
        "severity": F.when(n % 9 > 0, (n % 4).cast("int"))}
    rows = base.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(230)))).select(*[own.get(c, F.col(c)).alias(c) for c in base.columns])
    rows = spark.createDataFrame(rows.collect(), rows.schema)
    for page in (3, 12):
        got = [r["id"] for r in paging.deep_page(rows, page=page, sort=sort, order=order, most_rows=25).collect()]
        assert got == [r["id"] for r in g.list_incidents(rows, page=page, sort=sort, order=order).collect()], page
    assert len(got) == 10
    assert paging.deep_page(rows, page=13, sort=sort, order=order).count() == 0


def test_deep_page_sorts_few_rows(spark):
    from alertloom.operators import paging

    rows = spark.range(3000).select(F.md5(F.col("id").cast("string")).alias("id"), F.lit(2).alias("severity"))
    held, skip = paging._narrowed(rows, "severity", "desc", 2990, 20, 100)
    assert held.count() <= 100 and held.orderBy("id").offset(skip).count() == 10
    assert paging._narrowed(rows.limit(0), "severity", "asc", 0, 20, 100) is None


def test_edits(spark):
    rows = table(spark, row(1), row(2))
    edits = spark.createDataFrame(
        [(f"{1:032d}", "closed", None), (f"{2:032d}", None, None), ("missing", "closed", None)],
        "id string, status string, analyst_notes string")
    got = {int(r["id"]): r for r in g.apply_edits(rows, edits, F.lit(LATER)).collect()}
    assert (got[1]["status"], got[1]["updated_at"], got[2]["status"], got[2]["updated_at"]) == ("closed", LATER, "open", T0)
    twice = spark.createDataFrame(
        [(f"{1:032d}", "closed", None, 1), (f"{1:032d}", None, "note", 2), (f"{1:032d}", "open", None, 0)],
        "id string, status string, analyst_notes string, n int")
    merged = g.apply_edits(rows, twice, F.lit(LATER), F.col("n")).filter(f"id = '{1:032d}'").collect()
    assert [(m["status"], m["analyst_notes"]) for m in merged] == [("closed", "note")]
    assert {r["reason"] for r in g.refused_edits(rows, edits).collect()} == {"no field to update", "incident not found"}


def test_labels_hosts_and_probabilities(spark):
    raw = {**row(1)["raw_incident"], "ai_inference": {
        "attack_class": "alert_storm", "all_probabilities": {c: p for c, p in zip("abcdefg", [.1, .3, .3, .05, .05, .1, .1])}}}
    rows = table(spark, row(1, raw_incident=raw, target_hosts=["a", "b", "c", "d"], confidence=None, status="odd"),
                 row(2, target_hosts=None, severity=9, status="closed", confidence=0.4567))
    r = {int(x["id"]): x for x in g.labelled(rows).collect()}
    assert (r[1]["attack_text"], r[1]["status_text"], r[1]["confidence_text"]) == ("Tempête d'Alertes", "odd", "—")
    assert (r[2]["severity_label"], r[2]["severity_fr"], r[2]["status_text"], r[2]["confidence_text"]) == (
        "unknown", "Inconnu", "Fermé", "45.7%")
    assert {int(x["id"]): (x["shown"], x["more"]) for x in g.host_overflow(rows).collect()} == {1: (["a", "b"], 2), 2: ([], 0)}
    assert [x["attack_class"] for x in g.top_probabilities(rows.filter(f"id = '{1:032d}'")).orderBy("rank").collect()] == list("bcafg")
    assert g.get(rows, "nope").count() == 0
    hosts = g.host_share(g.top_hosts(rows)).collect()
    assert [h["share"] for h in hosts] == [100.0] * 4


def test_table_rewrites_touched_days_only(spark, tmp_path):
    from alertloom.operators.table import edit_rows, read_table, upsert_rows

    def edit(**values):
        return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))

    def state():
        return {r["id"]: (r["status"], r["assigned_to"], r["analyst_notes"], r["event_count"]) for r in read_table(spark, path).collect()}

    def stamps():
        return {p.parent.name: p.name for p in (tmp_path / "t").glob("*/*.parquet")}

    one, two, three = (f"{i:032d}" for i in (1, 2, 3))
    path, later = str(tmp_path / "t"), T0 + dt.timedelta(days=3)
    assert state() == {}
    upsert_rows(path, table(spark, row(1), row(2, created_at=later)))
    first, files = state(), stamps()
    assert len(files) == 2
    edit_rows(path, edit(id=one, status="closed"), F.to_timestamp(F.lit("2027-01-01")))
    edit_rows(path, edit(id=one, assigned_to="a", analyst_notes="n"), F.to_timestamp(F.lit("2027-01-02")))
    edit_rows(path, edit(id=one, assigned_to="b"), F.to_timestamp(F.lit("2027-01-03")))
    edit_rows(path, edit(id="missing", assigned_to="c"), F.to_timestamp(F.lit("2027-01-04")))
    assert state() == {one: ("closed", "b", "n", first[one][3]), two: first[two]}
    day, other = f"created_date={T0:%Y-%m-%d}", f"created_date={later:%Y-%m-%d}"
    assert stamps()[other] == files[other] and stamps()[day] != files[day]
    # a known id stays on its day, wherever its new row would fall; a new id opens its own
    upsert_rows(path, table(spark, row(1, **{**SECOND, "created_at": later + dt.timedelta(days=9)}), row(3)))
    got = state()
    assert got[one] == ("closed", "b", "n", SECOND["event_count"]) and got[two] == first[two] and three in got
    assert stamps()[other] == files[other] and set(stamps()) == {day, other}


def test_interrupted_change_is_finished(spark, tmp_path):
    import shutil

    from alertloom.operators.table import read_table, upsert_rows

    path = str(tmp_path / "t")
    upsert_rows(path, table(spark, row(1), row(2)))
    read_table(spark, path).write.parquet(f"{path}_staged")
    shutil.rmtree(next((tmp_path / "t").glob("created_date=*")))  # as if ended between the removal of a day and its return
    upsert_rows(path, table(spark, row(3)))  # finishes it first
    assert read_table(spark, path).count() == 3 and not (tmp_path / "t_staged").exists()


def _rows_scanned(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_look_up_skips_row_groups_without_the_id(spark, tmp_path):
    """Random ids: every day's range of ids covers the one sought, so only sorted row groups and bloom filters can tell days apart."""
    spark.conf.set("parquet.block.size", 1 << 14)
    spark.conf.set("parquet.page.size.row.check.min", 10)
    try:
        base = table(spark, row(1))
        n = F.col("n")
        rows = base.drop("id", "created_at").withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(3999)))).select(
            F.md5(n.cast("string")).alias("id"), (F.lit(T0) + F.make_dt_interval((n % 4).cast("int"))).alias("created_at"), "*").drop("n")
        path = str(tmp_path / "t")
        store.write_incidents(rows.select(*base.columns), path)
    finally:
        spark.conf.unset("parquet.block.size")
        spark.conf.unset("parquet.page.size.row.check.min")
    found = store.read_incidents(spark, path)
    for number in (0, 1234, 3999):
        got = g.get(found, hashlib.md5(str(number).encode()).hexdigest())
        assert got.count() == 1 and _rows_scanned(got) < 1000  # of 4 000, 1 000 a day
    assert _rows_scanned(g.get(found, "8" * 32)) == 0


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_only_repeated_keys_are_folded(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(store, "BROADCAST_BYTES", limit)
    rows = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2), (None, 1), (None, 3), ("c", 5)], "id string, n int")
    folded = []

    def fold(some):
        folded.extend(r["id"] for r in some.collect())
        return some.groupBy("id").agg(F.max("n").alias("n"))

    got = store.by_repeats(rows, "id", str(tmp_path / "again"), lambda one: one, fold)
    assert {tuple(r) for r in got.collect()} == {("a", 1), ("b", 2), (None, 3), ("c", 5)} and got.count() == 4
    assert len(folded) == (4 if limit else 6)


def test_a_batch_with_repeated_ids_leaves_no_scratch(spark, tmp_path):
    from alertloom.operators.table import read_table
    from alertloom.streaming import jobs

    def record(i, severity):
        return {"incident_id": f"{i:032d}", "@timestamp": T0, "severity": severity, "event_count": severity == "high" and 9 or 1}

    batch = scored(spark, record(1, "low"), record(2, "low"), record(1, "high"), {"severity": "low"}).coalesce(1).withColumn(
        "_position", F.struct(F.lit(T0).alias("time"), F.lit("f").alias("name"), F.lit(None).cast("long").alias("offset")))
    paths = [str(tmp_path / name) for name in ("table", "docs", "rejects")]
    for _ in range(2):
        jobs.store_batch(batch, 0, *paths)
        got = {r["id"][-1]: (r["severity"], r["event_count"]) for r in read_table(spark, paths[0]).collect()}
        assert got == {"1": (0, 9), "2": (0, 1)}  # the first row's severity, the last one's count
        docs = jobs.current_documents(spark, paths[1]).select("incident_id", "severity").collect()
        assert {(r[0] or "")[-1:]: r[1] for r in docs} == {"1": "high", "2": "low", "": "low"}
        assert spark.read.parquet(paths[2]).count() == 1
        assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["docs", "rejects", "table"]


def test_days_are_replaced_in_groups(spark, tmp_path, monkeypatch):
    from alertloom.operators import table as t

    days = [row(i, created_at=T0 + dt.timedelta(days=d)) for i, d in enumerate([0, 0, 0, 1, 2, 3])]
    saved = []
    save = t.save_days
    monkeypatch.setattr(t, "save_days", lambda rows, *a, **k: (saved.append(rows.count()), save(rows, *a, **k))[1])
    for most, sizes in ((2, [3, 2, 1]), (100, [6])):
        monkeypatch.setattr(t, "TOGETHER", most)
        path = str(tmp_path / str(most))
        t.upsert_rows(path, table(spark, *days))
        assert saved == sizes and t.read_table(spark, path).count() == 6
        saved.clear()


def test_first_rows_of_a_table_are_not_joined(spark, tmp_path):
    from alertloom.operators.table import read_table

    batch = table(spark, row(1))
    plan = store.upsert(read_table(spark, str(tmp_path / "none")).drop("created_date"), batch)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_shuffles_go_with_their_query(spark, tmp_path):
    from alertloom.session import shuffles_dropped

    def held():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size())}

    rows = spark.range(1000).withColumn("k", F.col("id") % 7)
    before, deadline = held(), dt.datetime.now() + dt.timedelta(seconds=20)
    with shuffles_dropped(spark):
        rows.repartition(3, "k").write.parquet(str(tmp_path / "a"))
        sums = rows.groupBy("k").agg(F.sum("id").alias("s"))
        assert sums.count() == 7 and len(sums.collect()) == 7
    while [f for f in held() - before if f.startswith("shuffle_")] and dt.datetime.now() < deadline:
        pass
    assert not [f for f in held() - before if f.startswith("shuffle_")]
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
