"""Alerts, incidents and labelled sets of a test-data folder, shared by the queries."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from alertloom.functions.columns import lookup
from alertloom.functions.normalize import enrich, normalize
from alertloom.operators import correlate, labeling, postings, store
from alertloom.operators.model import inference
from alertloom.operators.rules import RULES, scaled
from alertloom.session import work_path
from alertloom.sources import events as ev, tables

TEST_RULES = scaled(RULES, ev.WINDOW_SCALE)

# Class, by correlation rule, of the stand-in classifier that SQL can reproduce.
RULE_CLASS = {
    "CORR-001": "brute_force",
    "CORR-002": "privilege_escalation",
    "CORR-003": "lateral_movement",
    "CORR-004": "alert_storm",
    "CORR-005": "malware_activity",
    "CORR-006": "reconnaissance",
}
# Class, by alert rule, of the stand-in classifier for labelled alerts.
ALERT_CLASS = {
    "5710": "brute_force", "100201": "reconnaissance", "100300": "privilege_escalation",
    "100200": "alert_storm", "530": "benign",
}


def raw_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.raw_alerts(ev.table(spark, sf_dir, "events"))


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(normalize(raw_alerts(spark, sf_dir)), tables.seed_assets(spark))


def incidents(spark: SparkSession, sf_dir: str, **split) -> DataFrame:
    return correlate.correlate(alerts(spark, sf_dir), TEST_RULES, **split)


def event_number() -> Column:
    return F.col("triggering_alert.event.id").cast("long")


def score_by_rule(found: DataFrame) -> DataFrame:
    """Stand-in scores: class from the rule, confidence from the triggering event's number."""
    attack = lookup(RULE_CLASS, F.col("correlation_rule.id"))
    confidence = (event_number() % 101) / 100.0
    rest = F.lit(1.0) - confidence
    probabilities = F.map_from_arrays(
        F.array(attack, F.lit("data_exfiltration"), F.lit("normal_activity")),
        F.array(confidence, rest * 0.75, rest * 0.25))
    record = inference(attack, confidence, probabilities, "stand-in", F.col("`@timestamp`"))
    return found.select("*", record.alias("ai_inference"))


def store_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.store_rows(score_by_rule(incidents(spark, sf_dir)))


_stored: dict[tuple[str, str], str] = {}


def stored_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incidents table of a folder, written once per application to the shared folder.

    Analyst queries read a stored table; deriving the incidents again for each would hide
    their own plans.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stored:
        path = work_path(spark, "incidents", sf_dir.strip("/").replace("/", "_"))
        store.write_incidents(store_rows(spark, sf_dir), path)
        _stored[key] = path
    return store.read_incidents(spark, _stored[key])


def searchable_incidents(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """The stored incidents and their path, beside which postings for searches are written once per application."""
    rows = stored_incidents(spark, sf_dir)
    path = _stored[spark.sparkContext.applicationId, sf_dir]
    if not postings.has_postings(spark, path):
        postings.write_postings(rows, path)
    return rows, path


def newest(rows: DataFrame) -> Column:
    return rows.agg(F.max("created_at")).scalar()


def windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.run_windows(ev.run_log(ev.table(spark, sf_dir, "customer")))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labeling.label_alerts(raw_alerts(spark, sf_dir), windows(spark, sf_dir))


_labelled: dict[tuple[str, str], str] = {}


def stored_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled set of a folder, written once per application: splits, codes and metrics all start from it."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _labelled:
        path = work_path(spark, "labelled", sf_dir.strip("/").replace("/", "_"))
        labelled(spark, sf_dir).write.mode("overwrite").parquet(path)
        _labelled[key] = path
    return spark.read.parquet(_labelled[key])


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled alerts with a stand-in prediction and probability."""
    return stored_labelled(spark, sf_dir).select(
        "event_id", "run_id", "label", "rule_level",
        lookup(ALERT_CLASS, F.col("rule_id")).alias("prediction"),
        ((F.col("event_id").cast("long") % 101) / 100.0).alias("prob"))


def class_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_labelled(spark, sf_dir).select("label").distinct()


def firewall_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    from alertloom.functions.columns import micros
    from alertloom.operators.detect import parse_firewall

    lines = ev.firewall_lines(ev.table(spark, sf_dir, "events"))
    return parse_firewall(lines).withColumn("ts_us", micros(F.col("ts")))
