"""The registered queries: name to (spark, sf_dir) -> DataFrame. Nested values are flattened to
text and times to UTC text, so results compare across engines."""

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from alertloom.constants import RETENTION_DAYS
from alertloom.functions.columns import micros
from alertloom.functions.normalize import enrich, normalize
from alertloom.operators import analytics as g, correlate, detect, evaluate, labeling, paging, portscan, postings, store
from alertloom.operators import model as classifier
from alertloom.operators.features import features
from alertloom.operators.rules import fan_out, match_counts
from alertloom.operators.table import edit_rows, read_table, upsert_rows
from alertloom.plans import derive as d
from alertloom.session import shuffles_dropped, work_path
from alertloom.sources import alerts as feed, events as ev, tables
from alertloom.sources.connectors import Topics
from alertloom.streaming import jobs
from alertloom.streaming.correlate import correlate_stream, reconcile

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Detection windows are stretched by this factor on the sparse test events.
DETECTION_STRETCH = 28_800


def query(f: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return f(spark, sf_dir)

    run.__name__, run.__doc__ = f.__name__, f.__doc__
    QUERIES[f.__name__] = run
    return run


def at(column) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.untidy_lines(ev.table(spark, sf_dir, "events"), ev.table(spark, sf_dir, "documents"))


# --- feed and normalisation -----------------------------------------------------------------


@query
def q_ingest(spark, sf_dir):
    """Good alerts of a feed with every kind of bad line, stamped."""
    return feed.ingest(_lines(spark, sf_dir)).select(
        "_event_id", "_source", "timestamp", F.col("rule.id").alias("rule_id"), F.col("rule.level").alias("level"),
        F.col("agent.name").alias("agent_name"), F.col("data.srcip").alias("srcip"))


@query
def q_deadletter(spark, sf_dir):
    """Dead letters of the same feed by reason, with their text."""
    return feed.dead_letters(feed.parse(_lines(spark, sf_dir))).select(
        F.col("_error").alias("reason"), F.md5("payload").alias("digest"), F.length("payload").alias("chars"))


@query
def q_retention(spark, sf_dir):
    """Rows each dataset keeps at the time of the newest event, of a table dated by day."""
    path = work_path(spark, "dated", uuid.uuid4().hex)
    tables.write_dated(ev.table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts")), path, "ts")
    dated = spark.read.parquet(path)
    as_of = F.lit(dated.agg(F.max("ts")).first()[0])
    parts = [tables.retain(dated, name, F.col("ts"), as_of).agg(F.count("*").alias("kept")).select(F.lit(name).alias("dataset"), "kept")
             for name in RETENTION_DAYS]
    return reduce(DataFrame.unionByName, parts)


@query
def q_seed(spark, sf_dir):
    """Host dimension seen in the alerts added to the seeded assets; known hosts are skipped."""
    agents = d.raw_alerts(spark, sf_dir).groupBy(F.col("agent.name").alias("hostname")).agg(
        F.min("agent.ip").alias("ip_address"))
    seen = agents.select(
        "hostname", "ip_address", F.lit(None).cast("string").alias("os"), F.lit(None).cast("string").alias("role"),
        F.lit("lab").alias("site"), F.lit(None).cast("int").alias("criticality"), F.lit(None).cast("string").alias("owner"))
    return tables.insert_missing(seen, tables.seed_assets(spark), "hostname")


def _flat(a: DataFrame) -> DataFrame:
    return a.select(
        F.col("`@timestamp`").alias("ts_text"), at("event_ts").alias("event_ts"),
        F.col("event.id").alias("event_id"), F.col("event.module").alias("module"),
        F.col("event.category").alias("event_category"), F.col("event.severity").alias("severity"),
        F.col("event.reason").alias("reason"), F.col("host.name").alias("host_name"),
        F.col("host.ip").alias("host_ip"), F.col("host.os.type").alias("os"),
        F.col("log.level").alias("level"), F.col("rule.id").alias("rule_id"),
        F.col("rule.category").alias("rule_category"), F.col("source.ip").alias("source_ip"),
        F.col("source.port").alias("source_port"), F.col("destination.ip").alias("destination_ip"),
        F.col("destination.port").alias("destination_port"))


@query
def q_normalize(spark, sf_dir):
    """Every alert line parsed and normalised, from JSON text to flat columns."""
    from alertloom.functions.normalize import normalize

    lines = ev.alert_lines(ev.table(spark, sf_dir, "events"))
    return _flat(normalize(feed.ingest(lines)))


@query
def q_template(spark, sf_dir):
    """Log templates and how often each occurs."""
    return d.alerts(spark, sf_dir).groupBy("log_template").agg(F.count("*").alias("n"))


@query
def q_enrich(spark, sf_dir):
    """Asset found for every alert."""
    return d.alerts(spark, sf_dir).select(
        F.col("event.id").alias("event_id"), F.col("host.ip").alias("host_ip"),
        F.col("asset.hostname").alias("asset_host"), F.col("asset.criticality").alias("criticality"),
        F.col("asset.role").alias("role"))


# --- correlation ----------------------------------------------------------------------------


@query
def q_match_matrix(spark, sf_dir):
    """Matches per rule."""
    return match_counts(d.alerts(spark, sf_dir), d.TEST_RULES)


def _rule_query(number: int) -> None:
    rule = d.TEST_RULES[number - 1]

    def run(spark, sf_dir):
        fired = correlate.fire(d.alerts(spark, sf_dir), [rule])
        return fired.select("rule_id", "key", "event_id", "ts_us")

    run.__name__ = f"q_corr_{number:03d}"
    run.__doc__ = f"Firings of {rule.id}."
    query(run)


for _number in range(1, 7):
    _rule_query(_number)


@query
def q_incidents(spark, sf_dir):
    """Incidents of all rules."""
    return _flat_incidents(d.incidents(spark, sf_dir))


@query
def q_incidents_split(spark, sf_dir):
    """The same incidents with every key above 40 matches cut into time slices."""
    return _flat_incidents(d.incidents(spark, sf_dir, split="always", target_rows=40))


def _flat_incidents(found: DataFrame) -> DataFrame:
    alert = F.col("triggering_alert")
    return found.select(
        "incident_id", at("`@timestamp`").alias("ts"), F.col("correlation_rule.id").alias("rule_id"),
        F.col("correlation_rule.name").alias("rule_name"), F.col("correlation_rule.threshold").alias("threshold"),
        F.col("correlation_rule.window_sec").alias("window_sec"), "severity", "status", "correlation_key",
        "event_count", alert["host"]["name"].alias("host"), alert["source"]["ip"].alias("source_ip"),
        alert["rule"]["id"].alias("alert_rule"), alert["event"]["severity"].alias("alert_severity"),
        alert["asset"]["role"].alias("role"))


@query
def q_open_counts(spark, sf_dir):
    """Counts the counters hold at the time of the newest event."""
    counting = [r for r in d.TEST_RULES if r.member is None]
    hits = fan_out(d.alerts(spark, sf_dir), counting).drop("alert", "member")
    newest = ev.table(spark, sf_dir, "events").agg(F.max(micros(F.col("ts")))).scalar()
    return correlate.open_counts(hits, newest)


@query
def q_counters(spark, sf_dir):
    """Alerts matched and incidents fired per rule."""
    alerts = d.alerts(spark, sf_dir)
    return correlate.counters(alerts, d.TEST_RULES, correlate.fire(alerts, d.TEST_RULES))


# --- features, gate, store ------------------------------------------------------------------


@query
def q_features(spark, sf_dir):
    """Model features of every incident."""
    found = features(d.incidents(spark, sf_dir))
    return found.select("incident_id", *[c for c in found.columns if c.startswith("f_")])


@query
def q_tp_gate(spark, sf_dir):
    """Class, confidence and verdict of every incident."""
    return d.score_by_rule(d.incidents(spark, sf_dir)).select(
        "incident_id", "ai_inference.attack_class", "ai_inference.confidence", "ai_inference.is_true_positive")


@query
def q_store_row(spark, sf_dir):
    """Table row of every incident."""
    return d.store_rows(spark, sf_dir).select(
        "id", at("created_at").alias("created_at"), at("last_seen").alias("last_seen"), "severity", "category",
        "confidence", F.array_join("source_ips", ",").alias("source_ips"),
        F.array_join("target_hosts", ",").alias("target_hosts"), "event_count", "status")


def _repeated_rows(rows: DataFrame) -> DataFrame:
    """Store rows in which the incidents of one rule and key on one day share an id."""
    day = F.date_format("created_at", "yyyy-MM-dd")
    shared = F.md5(F.concat_ws("|", "raw_incident.correlation_rule.id", "raw_incident.correlation_key", day))
    return rows.withColumn("_order", F.struct("created_at", "id")).withColumn("id", shared)


@query
def q_upsert(spark, sf_dir):
    """Table after upserting a stream of rows with repeated ids."""
    return store.fold_upserts(_repeated_rows(d.store_rows(spark, sf_dir)), F.col("_order")).select(
        "id", at("created_at").alias("created_at"), at("updated_at").alias("updated_at"),
        at("first_seen").alias("first_seen"), at("last_seen").alias("last_seen"), "severity", "category",
        "confidence", F.array_join("source_ips", ",").alias("source_ips"),
        F.array_join("target_hosts", ",").alias("target_hosts"), "event_count", "status",
        F.col("raw_incident.triggering_alert.event.id").alias("last_event"))


@query
def q_edit_persist(spark, sf_dir):
    """The stored table after two upserts with repeated ids, an edit between them and one afterwards."""
    rows = _repeated_rows(d.stored_incidents(spark, sf_dir).drop("created_date")).withColumnRenamed("_order", "_seq")
    path = work_path(spark, "table", uuid.uuid4().hex)
    early = F.hour("created_at") < 12
    upsert_rows(path, rows.filter(early))
    severe = read_table(spark, path).filter("severity = 3")
    edit_rows(path, severe.select("id", F.lit("investigating").alias("status"), F.lit("analyst1").alias("assigned_to")),
              F.to_timestamp(F.lit("2024-03-01")))
    upsert_rows(path, rows.filter(~early))
    sure = read_table(spark, path).filter("confidence >= 0.8")
    edit_rows(path, sure.select("id", F.lit("closed").alias("status")), F.to_timestamp(F.lit("2024-03-02")))
    return read_table(spark, path).select(
        "id", at("created_at").alias("created_at"), at("updated_at").alias("updated_at"), "severity", "confidence", "status", "assigned_to",
        F.col("raw_incident.triggering_alert.event.id").alias("last_event"))


@query
def q_constraints(spark, sf_dir):
    """Rows that break a constraint, with the reasons, when scores and severities go wrong."""
    rows = d.store_rows(spark, sf_dir)
    number = F.col("raw_incident.triggering_alert.event.id").cast("long")
    broken = (
        rows.withColumn("severity", F.when(number % 17 == 0, 4).otherwise(F.col("severity")))
        .withColumn("confidence", F.when(number % 19 == 0, 1.2).otherwise(F.col("confidence")))
        .withColumn("first_seen", F.when(number % 23 == 0, None).otherwise(F.col("first_seen")))
        .withColumn("label", (number % 5).cast("int")))
    return store.rejected(broken).select("id", F.array_join("reasons", "; ").alias("reasons"))


@query
def q_docs(spark, sf_dir):
    """Document store: last write per id, without internal fields."""
    scored = d.score_by_rule(d.incidents(spark, sf_dir))
    day = F.date_format("`@timestamp`", "yyyy-MM-dd")
    order = F.struct("`@timestamp`", "incident_id")
    shared = F.md5(F.concat_ws("|", "correlation_rule.id", "correlation_key", day))
    repeated = scored.withColumn("_order", order).withColumn("incident_id", shared)
    docs = store.documents(repeated, F.col("_order"))
    return docs.select(
        "incident_id", at("`@timestamp`").alias("ts"), "severity", "status", "event_count", "correlation_key",
        F.col("ai_inference.attack_class").alias("attack_class"),
        F.col("triggering_alert.host.name").alias("host"), F.lit(len(docs.columns)).alias("fields"))


# --- analyst queries ------------------------------------------------------------------------


@query
def q_summary(spark, sf_dir):
    """Headline counts."""
    return g.summary(d.stored_incidents(spark, sf_dir))


@query
def q_health(spark, sf_dir):
    """Health report with the incident count."""
    return g.health(d.stored_incidents(spark, sf_dir))


@query
def q_by_severity(spark, sf_dir):
    """Severity series."""
    return g.by_severity(d.stored_incidents(spark, sf_dir))


@query
def q_by_category(spark, sf_dir):
    """Most frequent categories."""
    return g.by_category(d.stored_incidents(spark, sf_dir))


@query
def q_by_status(spark, sf_dir):
    """Incidents per status."""
    return g.by_status(d.stored_incidents(spark, sf_dir))


def _timeline_query(period: str) -> None:
    def run(spark, sf_dir):
        rows = d.stored_incidents(spark, sf_dir)
        return g.timeline(rows, period, d.newest(rows))

    run.__name__ = f"q_timeline_{period}"
    run.__doc__ = f"Incidents over the last {period}."
    query(run)


for _period in g.PERIODS:
    _timeline_query(_period)


@query
def q_top_hosts(spark, sf_dir):
    """Most targeted hosts."""
    return g.top_hosts(d.stored_incidents(spark, sf_dir))


@query
def q_host_share(spark, sf_dir):
    """Most targeted hosts relative to the first."""
    hosts = g.host_share(g.top_hosts(d.stored_incidents(spark, sf_dir)))
    return hosts.select("host", "incident_count", F.round("share", 6).alias("share"))


@query
def q_top_rules(spark, sf_dir):
    """Most active rules."""
    return g.top_rules(d.stored_incidents(spark, sf_dir))


@query
def q_conf_hist(spark, sf_dir):
    """Confidence histogram."""
    return g.confidence_histogram(d.stored_incidents(spark, sf_dir))


def _listed(rows: DataFrame) -> DataFrame:
    out = rows.withColumn("created_at", at("created_at"))
    for c in ("first_seen", "last_seen"):
        if c in rows.columns:
            out = out.withColumn(c, at(c))
    for c in ("source_ips", "target_hosts"):
        if c in rows.columns:
            out = out.withColumn(c, F.array_join(c, ","))
    return out


LIST_FILTERS = g.Filters(severity=3, status="open", category="movement")


@query
def q_list(spark, sf_dir):
    """First page of a filtered list sorted by confidence."""
    return _listed(g.list_incidents(d.stored_incidents(spark, sf_dir), LIST_FILTERS, 1, 20, "confidence", "desc"))


@query
def q_list_page2(spark, sf_dir):
    """Second page of the unfiltered list, newest first."""
    return _listed(g.list_incidents(d.stored_incidents(spark, sf_dir), page=2))


@query
def q_page_deep(spark, sf_dir):
    """Last page of the unfiltered list, newest first, its range found by counts."""
    rows = d.stored_incidents(spark, sf_dir)
    return _listed(paging.deep_page(rows, page=g.page_meta(rows).first()["pages"], most_rows=50))


@query
def q_page_meta(spark, sf_dir):
    """Total and number of pages of the filtered list."""
    return g.page_meta(d.stored_incidents(spark, sf_dir), LIST_FILTERS)


@query
def q_search(spark, sf_dir):
    """Incidents that mention a text anywhere, found by postings."""
    found = postings.search(*d.searchable_incidents(spark, sf_dir), g.Filters(search="WEB-srv"))
    return found.groupBy("category").agg(F.count("*").alias("n"), F.min("id").alias("first_id"))


@query
def q_search_escape(spark, sf_dir):
    """Incidents that mention a text with a backslash, in their hosts or in the record, found by postings."""
    named = F.transform("target_hosts", lambda h: F.concat(F.lit("corp\\"), h))
    key = F.concat(F.lit("corp\\"), F.col("raw_incident.correlation_key"))
    rows = d.stored_incidents(spark, sf_dir).withColumn("target_hosts", named).withColumn(
        "raw_incident", F.col("raw_incident").withField("correlation_key", key))
    path = work_path(spark, "searched", uuid.uuid4().hex)
    store.save_days(rows, path)
    rows = store.read_incidents(spark, path)
    postings.write_postings(rows, path)
    parts = [postings.search(rows, path, g.Filters(search=text)).select(F.lit(text).alias("searched"), "id")
             for text in ("corp\\WEB-srv", "CORP\\recon")]
    return reduce(DataFrame.unionByName, parts)


@query
def q_next_page(spark, sf_dir):
    """The page after the first one of the list by confidence, found from the first one's last row."""
    rows = d.stored_incidents(spark, sf_dir)
    last = g.list_incidents(rows, sort="confidence").select("confidence", "id").collect()[-1]
    return _listed(g.next_page(rows, last["confidence"], last["id"], sort="confidence"))


@query
def q_recent(spark, sf_dir):
    """Newest incidents."""
    return _listed(g.recent(d.stored_incidents(spark, sf_dir)))


@query
def q_get(spark, sf_dir):
    """The incident with the smallest id, looked up by its id."""
    rows = d.stored_incidents(spark, sf_dir)
    found = g.get(rows, rows.agg(F.min("id")).scalar())
    return found.select("id", at("created_at").alias("created_at"), "severity", "severity_label", "severity_fr",
                        "category", "confidence", "status")


@query
def q_update(spark, sf_dir):
    """Table after a batch of analyst edits."""
    rows = d.stored_incidents(spark, sf_dir)
    edits = rows.select(
        "id", F.when(F.col("confidence") >= 0.9, "closed").when(F.col("confidence") >= 0.8, "investigating").alias("status"),
        F.when(F.col("severity") == 3, "analyst1").alias("assigned_to"),
        F.lit(None).cast("string").alias("analyst_notes"))
    return g.apply_edits(rows, edits, d.newest(rows)).select(
        "id", "status", "assigned_to", "analyst_notes", at("updated_at").alias("updated_at"))


@query
def q_labels(spark, sf_dir):
    """Display labels of every incident."""
    return g.labelled(d.stored_incidents(spark, sf_dir)).select(
        "id", "severity_label", "severity_fr", "attack_text", "status_text", "confidence_text")


@query
def q_top_probs(spark, sf_dir):
    """Most likely classes of every incident."""
    return g.top_probabilities(d.stored_incidents(spark, sf_dir)).withColumn(
        "probability", F.round("probability", 4))


@query
def q_host_overflow(spark, sf_dir):
    """First two of the names tied to every incident and how many more there are."""
    alert = F.col("raw_incident.triggering_alert")
    names = F.array_distinct(F.array(
        alert["host"]["name"], alert["asset"]["hostname"], alert["source"]["ip"], alert["host"]["ip"]))
    rows = d.stored_incidents(spark, sf_dir).withColumn("target_hosts", names)
    return g.host_overflow(rows).select("id", F.array_join("shown", ",").alias("shown"), "more")


# --- labels and evaluation ------------------------------------------------------------------


@query
def q_label(spark, sf_dir):
    """Alerts labelled by the run they fall into."""
    return d.labelled(spark, sf_dir)


@query
def q_label_csv(spark, sf_dir):
    """The same labels from a run log in several CSV files, in the order of their names and lines."""
    path = work_path(spark, "runs", uuid.uuid4().hex)
    runs = ev.run_log(ev.table(spark, sf_dir, "customer")).repartitionByRange(3, "run_idx").sortWithinPartitions("run_idx")
    runs.drop("run_idx").write.option("header", True).option("escape", '"').csv(path)
    return labeling.label_alerts(d.raw_alerts(spark, sf_dir), tables.run_windows(tables.read_run_log(spark, path)))


@query
def q_label_dense(spark, sf_dir):
    """How many alerts each run gets when the windows of all runs overlap."""
    windows = d.windows(spark, sf_dir).withColumn("end_ts", F.col("end_ts") + F.expr("INTERVAL 20 DAYS"))
    return labeling.label_alerts(d.raw_alerts(spark, sf_dir), windows).groupBy("run_id").agg(F.count("*").alias("n"))


@query
def q_label_stats(spark, sf_dir):
    """Alerts matched and skipped."""
    return labeling.label_stats(d.raw_alerts(spark, sf_dir), d.labelled(spark, sf_dir))


@query
def q_class_dist(spark, sf_dir):
    """Labelled alerts per class."""
    return evaluate.class_distribution(d.stored_labelled(spark, sf_dir))


@query
def q_encode(spark, sf_dir):
    """Encoded inputs of every labelled alert."""
    return evaluate.encode(d.stored_labelled(spark, sf_dir)).select(
        "event_id", "rule_id_enc", "agent_name_enc", "rule_groups_enc", "rule_level")


@query
def q_group_split(spark, sf_dir):
    """Split of every run."""
    return evaluate.group_split(d.stored_labelled(spark, sf_dir))


@query
def q_strat_split(spark, sf_dir):
    """Split of every labelled alert, per class."""
    rows = d.stored_labelled(spark, sf_dir).select("event_id", "label", F.md5("event_id").alias("digest"))
    return evaluate.stratified_split(rows, "digest").select("event_id", "label", "split")


def _rounded(rows: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        rows = rows.withColumn(c, F.round(c, 9))
    return rows


@query
def q_report(spark, sf_dir):
    """Classification report of the stand-in predictions."""
    report = evaluate.classification_report(d.predictions(spark, sf_dir), d.class_names(spark, sf_dir))
    return _rounded(report, "precision", "recall", "f1")


@query
def q_confusion(spark, sf_dir):
    """Confusion matrix of the stand-in predictions."""
    return evaluate.confusion_matrix(d.predictions(spark, sf_dir), sorted(ev.RUN_CLASSES))


def _split_predictions(spark, sf_dir) -> DataFrame:
    rows = d.predictions(spark, sf_dir)
    return rows.join(evaluate.group_split(rows), "run_id")


@query
def q_majority(spark, sf_dir):
    """Majority-class baseline on the grouped split."""
    rows = _split_predictions(spark, sf_dir)
    result = evaluate.majority_baseline(
        rows.filter("split = 'train'"), rows.filter("split = 'test'"), d.class_names(spark, sf_dir))
    return _rounded(result, "accuracy", "macro_f1")


@query
def q_level_baseline(spark, sf_dir):
    """Rule-level baseline on the test runs."""
    return evaluate.level_baseline(_split_predictions(spark, sf_dir).filter("split = 'test'"))


@query
def q_fpr(spark, sf_dir):
    """False positives among benign alerts."""
    return _rounded(evaluate.benign_false_positives(d.predictions(spark, sf_dir)), "fp_rate")


@query
def q_calibration(spark, sf_dir):
    """Calibration of the stand-in probabilities."""
    return _rounded(evaluate.calibration(d.predictions(spark, sf_dir)), "mean_predicted", "observed")


# --- detection rules ------------------------------------------------------------------------


@query
def q_fw_parse(spark, sf_dir):
    """Parsed firewall events with their description."""
    return detect.firewall_alerts(d.firewall_events(spark, sf_dir)).select(
        "event_id", "interface", "reason", "action", "protocol_id", "protocol", "srcip", "dstip", "srcport",
        "dstport", "rule_id", "level", "description")


def _scans(spark, sf_dir, **split) -> DataFrame:
    events = d.firewall_events(spark, sf_dir).select("event_id", "ts_us", "srcip", "dstport", "action")
    return portscan.port_scans(
        events, 30 * DETECTION_STRETCH, 10, 60 * DETECTION_STRETCH, **split).select(
        "event_id", "ts_us", "srcip", "rule_id", "level", "description")


@query
def q_portscan(spark, sf_dir):
    """Port scans."""
    return _scans(spark, sf_dir)


@query
def q_portscan_split(spark, sf_dir):
    """The same port scans with every source above 8 events cut into time slices."""
    return _scans(spark, sf_dir, split="always", target_rows=8)


@query
def q_ssh_brute(spark, sf_dir):
    """SSH brute force."""
    alerts = d.raw_alerts(spark, sf_dir).select(
        F.col("rule.id").alias("rule_id"), F.col("data.srcip").alias("srcip"),
        micros(feed.alert_time()).alias("ts_us"), F.col("_event_id").alias("event_id"))
    return detect.ssh_brute_force(alerts, seconds=60 * DETECTION_STRETCH, count=6).select(
        "event_id", "srcip", "ts_us", "rule_id", "level", "description", "mitre", F.array_join("groups", ",").alias("groups"))


@query
def q_win_priv(spark, sf_dir):
    """Special-privilege logons among signups and clicks read as Windows events."""
    logs = ev.table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type").isin("signup", "click"), "60001").otherwise("60002").alias("parent_id"),
        (F.lit(4670) + F.col("event_id") % 5).cast("string").alias("win_event_id"))
    return detect.windows_privilege_logon(logs).select(
        "event_id", "rule_id", "level", "mitre", F.array_join("groups", ",").alias("groups"))


@query
def q_rule_class(spark, sf_dir):
    """Alerts per attack class of their rule."""
    rule = F.col("rule.id")
    return d.raw_alerts(spark, sf_dir).groupBy(
        rule.alias("rule_id"), detect.rule_attack_class(rule).alias("attack_class")).agg(F.count("*").alias("n"))


# --- streams --------------------------------------------------------------------------------


def _streams(spark: SparkSession) -> None:
    """State store of the stateful queries."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def _run(spark: SparkSession, name: str, sf_dir: str) -> str:
    """A folder in the shared space for one run of a stream."""
    return work_path(spark, "streams", f"{name}-{uuid.uuid4().hex}")


# An alert long after all others, so that the watermark passes the last real one, and two without a usable time.
_FLUSH = '{"id":"flush","timestamp":"2024-06-01T00:00:00+00:00","agent":{"name":"flush"}}'
_UNTIMED = ['{"id":"undated","agent":{"name":"u"}}', '{"id":"ahead","timestamp":"2100-01-01T00:00:00+00:00","agent":{"name":"a"}}']
_ARRIVALS = 4


def _land_out_of_order(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The alert lines in a few arrivals of eight days each, of which every second alert comes an arrival late."""
    events = ev.table(spark, sf_dir, "events")
    day = F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"))
    arrival = F.least(F.floor(day / 8), F.lit(_ARRIVALS - 1)) + F.col("event_id") % 2
    for k in range(_ARRIVALS + 1):
        lines = ev.alert_lines(events.filter(arrival == k))
        extra = _UNTIMED if k == 0 else [_FLUSH] if k == _ARRIVALS else []
        if extra:
            lines = lines.unionByName(spark.range(1).select(F.explode(F.array(*map(F.lit, extra))).alias("value")))
        lines.coalesce(1).write.mode("append").text(path)


def _streamed(spark: SparkSession, sf_dir: str, base: str, lateness: str) -> DataFrame:
    """Incidents that a stream finds in lines landed out of order, one file a micro-batch."""
    _streams(spark)
    _land_out_of_order(spark, sf_dir, f"{base}/landing")
    alerts = jobs.enriched_stream(feed.follow_lines(spark, f"{base}/landing", 1), tables.seed_assets(spark))
    found = correlate_stream(alerts, d.TEST_RULES, lateness)
    jobs.run_available(jobs.to_table(found, f"{base}/incidents", f"{base}/checkpoint"))
    return spark.read.parquet(f"{base}/incidents")


@query
def s_ingest(spark, sf_dir):
    """The untidy feed as a stream of landed files: good alerts, stamped."""
    base = _run(spark, "ingest", sf_dir)
    _lines(spark, sf_dir).write.text(f"{base}/landing")
    alerts = feed.ingest(feed.follow_lines(spark, f"{base}/landing"))
    jobs.run_available(jobs.to_table(alerts, f"{base}/alerts", f"{base}/checkpoint"))
    return spark.read.parquet(f"{base}/alerts").select(
        "_event_id", "_source", "timestamp", F.col("rule.id").alias("rule_id"), F.col("rule.level").alias("level"),
        F.col("agent.name").alias("agent_name"), F.col("data.srcip").alias("srcip"))


@query
def s_corr(spark, sf_dir):
    """Alert lines landed out of order, some without a usable time, to incidents in one stream: parse, enrich, correlate."""
    return _flat_incidents(_streamed(spark, sf_dir, _run(spark, "correlate", sf_dir), "17 days"))


@query
def s_late(spark, sf_dir):
    """The same arrivals with less patience than they need, and the incidents put right from the landed lines."""
    base = _run(spark, "late", sf_dir)
    found = _streamed(spark, sf_dir, base, "2 days")
    landed = feed.stamp(feed.good(feed.parse(feed.read_lines(spark, f"{base}/landing"), timed=True)))
    alerts = enrich(normalize(landed), tables.seed_assets(spark))
    return _flat_incidents(reconcile(found, alerts, d.TEST_RULES).filter("state != 'withdrawn'"))


@query
def s_store(spark, sf_dir):
    """Scored incidents from a topic into the table and the documents; the table as it stands."""
    base = _run(spark, "store", sf_dir)
    topics = Topics("files", f"{base}/topics")
    with shuffles_dropped(spark):
        topics.write(d.score_by_rule(d.incidents(spark, sf_dir)), "results", key="incident_id")
        scored = jobs.scored_incidents_of(topics.read_stream(spark, "results", position=True))
        jobs.run_available(jobs.store_stream(
            scored, f"{base}/checkpoint", f"{base}/table", f"{base}/documents", f"{base}/rejects"))
    return read_table(spark, f"{base}/table").select(
        "id", at("created_at").alias("created_at"), at("last_seen").alias("last_seen"), "severity", "category",
        "confidence", F.array_join("source_ips", ",").alias("source_ips"),
        F.array_join("target_hosts", ",").alias("target_hosts"), "event_count", "status")


@query
def q_argmax(spark, sf_dir):
    """Class, confidence and probability map of probability vectors with ties, one for each alert."""
    n = F.col("_event_id").cast("long")
    p = F.array(*[(n % k).cast("double") / 16 for k in (7, 5, 3)])
    rows = d.raw_alerts(spark, sf_dir).select("_event_id", p.alias("p"))
    names = F.array(*[F.lit(c) for c in ("alert_storm", "benign", "brute_force")])
    return rows.select("_event_id", *classifier.best_class(names, F.col("p"))).select(
        F.col("_event_id").alias("event_id"), "attack_class", "confidence", F.col("probabilities")["benign"].alias("p_benign"))


@query
def q_folds(spark, sf_dir):
    """Cross-validation fold of every labelled alert."""
    rows = d.stored_labelled(spark, sf_dir).select("event_id", "label", F.md5("event_id").alias("digest"))
    return evaluate.with_folds(rows, "digest", 5).select("event_id", "label", F.col("_fold").alias("fold"))


# --- model ----------------------------------------------------------------------------------


@query
def ml_score(spark, sf_dir):
    """Incidents per class, with the mean confidence, as the trained classifier scores them."""
    model = classifier.load_or_train(spark, work_path(spark, "model"))
    scored = classifier.score(model, d.incidents(spark, sf_dir))
    return scored.groupBy("correlation_rule.id", "ai_inference.attack_class").agg(
        F.count("*").alias("n"), F.avg("ai_inference.confidence").alias("confidence"),
        F.count_if("ai_inference.is_true_positive").alias("true_positives"))


@query
def s_score(spark, sf_dir):
    """Incidents from a topic scored in a stream."""
    model = classifier.load_or_train(spark, work_path(spark, "model"))
    base = _run(spark, "score", sf_dir)
    topics = Topics("files", f"{base}/topics")
    with shuffles_dropped(spark):
        topics.write(d.incidents(spark, sf_dir), "incidents", key="incident_id")
        scored = jobs.score_stream(jobs.incidents_of(topics.read_stream(spark, "incidents")), model)
        jobs.run_available(topics.write_stream(scored, "results", f"{base}/checkpoint", key="incident_id"))
    return jobs.scored_incidents_of(topics.read(spark, "results")).select(
        "incident_id", "ai_inference.attack_class", "ai_inference.confidence", "ai_inference.is_true_positive")


@query
def ml_grid(spark, sf_dir):
    """Cross-validated macro-F1 of every forest of the grid on the training runs' alerts."""
    rows = d.stored_labelled(spark, sf_dir)
    encoded = evaluate.encode(rows).withColumn("digest", F.md5("event_id"))
    train, _ = evaluate.split(encoded, "digest")
    inputs = [f"{c}_enc" for c in evaluate.CATEGORICAL] + ["rule_level"]
    search, _ = evaluate.grid_search(train.filter("split = 'train'"), inputs, "digest")
    scores = []
    for grid, score in zip(search.getEstimatorParamMaps(), search.avgMetrics):
        chosen = {param.name: value for param, value in grid.items()}
        scores.append((chosen["maxDepth"], chosen["numTrees"], float(score)))
    return spark.createDataFrame(scores, "max_depth int, trees int, macro_f1 double")


@query
def ml_report(spark, sf_dir):
    """Classification report, on the test runs, of a forest trained on the training runs."""
    rows = evaluate.encode(d.stored_labelled(spark, sf_dir)).withColumn("digest", F.md5("event_id"))
    parts, _ = evaluate.split(rows, "digest")
    inputs = [f"{c}_enc" for c in evaluate.CATEGORICAL] + ["rule_level"]
    model = classifier.train(parts.filter("split = 'train'"), inputs=inputs)
    names = classifier.classes(model)
    guessed = classifier.predict(model, parts.filter("split = 'test'"))
    every = spark.range(1).select(F.explode(F.array(*[F.lit(n) for n in names])).alias("label"))
    return evaluate.classification_report(
        guessed.select("label", F.col("attack_class").alias("prediction")), every)
