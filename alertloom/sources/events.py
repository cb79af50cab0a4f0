"""Security alerts, run windows and firewall lines derived from the general test tables.

Every value is an integer or text expression of the source row, so another SQL engine can
reproduce it. All rows of a table are used.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from alertloom.functions.columns import lookup, once

EVENT_RULE = {
    "error": "5710", "signup": "100300", "purchase": "100201", "click": "100200", "view": "530",
}
EVENT_GROUPS = {
    "error": ["syslog", "sshd", "authentication_failed"],
    "signup": ["windows", "privilege_escalation", "windows_security"],
    "purchase": ["recon", "port_scan", "pfsense"],
    "click": ["firewall", "pfsense"],
    "view": ["ossec"],
}
NAMED_HOSTS = [
    ("wazuh-manager", "192.168.10.10"),
    ("web-srv-01", "192.168.10.21"),
    ("db-srv-01", "192.168.10.22"),
    ("win-srv-2022-01", "192.168.10.30"),
]
RUN_CLASSES = [
    "brute_force", "reconnaissance", "alert_storm", "lateral_movement", "privilege_escalation", "benign",
]
# The test events are sparse, so correlation windows are stretched by this factor on them.
WINDOW_SCALE = 360
SPREAD = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Each is one small file that Spark reads in one task, so a table that feeds
    heavy row-wise work is spread by its key when it has fewer splits than there are cores."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    key = {"events": "event_id", "documents": "doc_id", "customer": "c_custkey"}.get(name)
    cores = spark.sparkContext.defaultParallelism
    if key and df.rdd.getNumPartitions() < min(cores, SPREAD):
        df = df.repartition(min(cores, SPREAD), key)
    return df


def _text(column: Column) -> Column:
    return column.cast("string")


def _source_ip() -> Column:
    tail = _text(F.col("user_id") % 250)
    return (
        F.when(F.col("user_id") % 10 == 0, F.lit(None))
        .when(F.col("user_id") % 3 == 0, F.concat(F.lit("203.0.113."), tail))
        .otherwise(F.concat(F.lit("192.168.20."), tail))
    )


def _agent() -> Column:
    slot = F.col("event_id") % 11
    name = F.when(slot == 4, F.concat(F.lit("ubuntu-"), _text(F.col("event_id") % 7)))
    ip = F.when(slot < 0, F.lit(None))
    for i, (host, address) in enumerate(NAMED_HOSTS):
        name = name.when(slot == i, host)
        ip = ip.when(slot == i, address)
    name = name.otherwise(F.concat(F.lit("host-"), _text(F.expr("(event_id div 11) % 40"))))
    ip = ip.otherwise(F.concat(F.lit("10.0.0."), _text(F.col("event_id") % 200)))
    return F.struct(
        F.lpad(_text(slot), 3, "0").alias("id"), name.alias("name"), ip.alias("ip"))


def _groups() -> Column:
    chosen = None
    for kind, groups in EVENT_GROUPS.items():
        value = F.array(*[F.lit(g) for g in groups])
        chosen = (F.when(F.col("event_type") == kind, value) if chosen is None
                  else chosen.when(F.col("event_type") == kind, value))
    return chosen


def _full_log() -> Column:
    """Message text, over 100 characters for some rows and empty for views."""
    return F.when(F.col("event_type") == "view", F.lit("")).otherwise(F.concat(
        F.lit("user "), _text(F.col("user_id")), F.lit(" "), F.col("event_type"), F.lit(" "),
        F.repeat(F.lit("attempt "), (F.col("event_id") % 15).cast("int")), F.col("props")))


def raw_alerts(events: DataFrame) -> DataFrame:
    """RAW_ALERT records, one per event, already typed and stamped with their event id."""
    return events.select(
        _text(F.col("event_id")).alias("id"),
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("timestamp"),
        F.lit(None).cast("string").alias("@timestamp"),
        F.struct(
            lookup(EVENT_RULE, F.col("event_type")).alias("id"),
            _text(F.col("event_id") % 16).alias("level"),
            F.concat(F.col("event_type"), F.lit(" by user "), _text(F.col("user_id"))).alias("description"),
            _groups().alias("groups"),
        ).alias("rule"),
        _agent().alias("agent"),
        _full_log().alias("full_log"),
        F.struct(
            _source_ip().alias("srcip"),
            F.lit(None).cast("string").alias("source_ip"),
            _text(F.col("event_id") % 64511 + 1024).alias("srcport"),
            F.lit(None).cast("string").alias("dstip"),
            F.lit(None).cast("string").alias("destination_ip"),
            F.get_json_object("props", "$.k").alias("dstport"),
            F.when(F.col("event_type") == "error", F.concat(F.lit("user"), _text(F.col("user_id"))))
            .alias("dstuser"),
        ).alias("data"),
        _text(F.col("event_id")).alias("_event_id"),
    )


def alert_lines(events: DataFrame) -> DataFrame:
    """The same alerts as JSON text, as a feed would carry them."""
    alerts = raw_alerts(events).drop("_event_id")
    return alerts.select(once(F.to_json(F.struct(*[F.col(f"`{c}`") for c in alerts.columns]))).alias("value"))


def untidy_lines(events: DataFrame, documents: DataFrame) -> DataFrame:
    """A feed with every kind of line: good alerts, alerts without an id, alerts whose level is
    a word, truncated JSON, blank lines and free text (the documents, whole)."""
    alerts = raw_alerts(events).drop("_event_id")
    kind = F.col("id").cast("long") % 13
    shaped = alerts.withColumn("_kind", kind).withColumn(
        "id", F.when(F.col("_kind") == 1, F.lit(None)).otherwise(F.col("id"))
    ).withColumn(
        "rule", F.when(F.col("_kind") == 2, F.col("rule").withField("level", F.lit("severe")))
        .otherwise(F.col("rule")))
    text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in alerts.columns]))
    value = (
        F.when(F.col("_kind") == 3, F.expr("substring(_json, 1, length(_json) - 1)"))
        .when(F.col("_kind") == 4, F.lit(" \t "))
        .when(F.col("_kind") == 5, F.concat(F.lit("  "), F.col("_json"), F.lit("\t")))
        .otherwise(F.col("_json")))
    lines = shaped.select("_kind", once(text).alias("_json")).select(value.alias("value"))
    return lines.unionByName(documents.select(F.col("text").alias("value")))


def run_log(customers: DataFrame) -> DataFrame:
    """A run log with one run per customer: starts spread over January 2024, 1 to 40 minutes
    long, many overlapping, targets among the sources the alerts use."""
    key = F.col("c_custkey")
    start = F.expr("timestamp_micros(1704067200000000 + ((c_custkey * 7919) % 2592000) * 1000000)")
    end = F.expr(
        "timestamp_micros(1704067200000000 + ((c_custkey * 7919) % 2592000 + 60 + (c_custkey * 31) % 2340) * 1000000)")
    iso = "yyyy-MM-dd'T'HH:mm:ss'+00:00'"
    return customers.select(
        F.concat(F.upper(F.substring("c_mktsegment", 1, 4)), F.lit("-0"), _text(key % 6)).alias("scenario_id"),
        F.element_at(F.array(*[F.lit(c) for c in RUN_CLASSES]), (key % 6 + 1).cast("int")).alias("attack_class"),
        F.lit("replayed").alias("tool_cmd"),
        F.when(key % 7 == 0, "").otherwise(F.concat(F.lit("192.168.20."), _text(key % 25))).alias("target"),
        F.date_format(start, iso).alias("start_time_utc"),
        F.date_format(end, iso).alias("end_time_utc"),
        F.col("c_name").alias("run_note"),
        key.alias("run_idx"),
    )


def firewall_lines(events: DataFrame) -> DataFrame:
    """One firewall log line per event, with its time: mostly TCP, some UDP and ICMP, and sshd
    lines for errors; bare, or behind a syslog header of one of three forms. ``value`` is the line."""
    proto = F.when(F.col("event_id") % 9 == 0, "icmp").when(F.col("event_id") % 9 < 3, "udp").otherwise("tcp")
    number = F.when(F.col("event_id") % 9 == 0, "1").when(F.col("event_id") % 9 < 3, "17").otherwise("6")
    form, ts = F.col("event_id") % 4, F.col("ts").cast("timestamp")
    program = (
        F.when(form == 1, F.concat(F.lit("<134>"), F.date_format(ts, "MMM d HH:mm:ss"), F.lit(" fw-1 filterlog[4711]: ")))
        .when(form == 2, F.concat(F.lit("<134>1 "), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit(" fw-1 filterlog 4711 - - ")))
        .when(form == 3, F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssXXX"), F.lit(" fw-1 filterlog[4711]: ")))
        .otherwise(F.lit("filterlog: ")))
    head = F.concat(
        program, F.lit("5,,,1000000103,em"), _text(F.col("user_id") % 2), F.lit(",match,"),
        F.when(F.col("event_type") == "view", "pass").otherwise("block"),
        F.lit(",in,4,0x0,,64,"), _text(F.col("event_id")), F.lit(",0,DF,"), number, F.lit(","), proto,
        F.lit(",60,"), F.lit("203.0.113."), _text(F.col("user_id") % 250),
        F.lit(",192.168.10."), _text(F.col("event_id") % 200))
    ports = F.concat(
        F.lit(","), _text(F.col("event_id") % 64511 + 1024), F.lit(","), F.get_json_object("props", "$.k"),
        F.lit(",0"))
    line = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("sshd: Failed password for user"), _text(F.col("user_id"))))
        .when(F.col("event_id") % 9 == 0, F.concat(head, F.lit(",request")))
        .otherwise(F.concat(head, ports)))
    return events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), once(line).alias("value"))
