"""Raw alert to enriched alert: defaults, derived fields, record assembly, asset lookup."""

from pyspark.sql import Column, DataFrame, functions as F

from alertloom.constants import SOURCE_TAG
from alertloom.functions.columns import iso_timestamp
from alertloom.functions.sizing import BROADCAST_BYTES, broadcast_if_small, estimated_bytes


def severity_of_level(level: Column) -> Column:
    return (F.when(level <= 0, "info").when(level <= 2, "low").when(level <= 4, "medium")
            .when(level <= 6, "high").otherwise("critical"))


def category_of_level(level: Column) -> Column:
    return F.when(level >= 2, "security").otherwise("process")


def os_of_name(name: Column) -> Column:
    lowered = F.lower(name)
    return (F.when(lowered.contains("ubuntu"), "linux").when(lowered.contains("win"), "windows")
            .otherwise("unknown"))


def log_template(message: Column) -> Column:
    return F.substring(F.coalesce(message, F.lit("")), 1, 100)


def joined_groups(groups: Column) -> Column:
    return F.when(F.size(groups) > 0, F.array_join(groups, ", ")).otherwise("unknown")


def _or(column: str, default) -> Column:
    return F.coalesce(F.col(column), F.lit(default))


def normalize(raw: DataFrame) -> DataFrame:
    """One nested enriched record per raw alert, without the asset.

    ``raw`` holds the RAW_ALERT columns, ``_event_id`` and, if kept, the original ``payload``.
    A null object counts as an absent one. ``event_ts`` is the parsed alert time; it is the
    only column added to the record's own fields, for event-time work downstream.
    """
    level = F.coalesce(F.col("rule.level").try_cast("int"), F.lit(0))
    name = _or("agent.name", "unknown")
    description = _or("rule.description", "Unknown")
    event_ts = F.coalesce(iso_timestamp(F.col("timestamp")), F.current_timestamp())
    payload = F.col("payload") if "payload" in raw.columns else F.lit(None).cast("string")
    return raw.select(
        F.coalesce(F.col("timestamp"), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"))
        .alias("@timestamp"),
        event_ts.alias("event_ts"),
        F.struct(
            _or("_event_id", "unknown").alias("id"),
            F.lit(SOURCE_TAG).alias("module"),
            category_of_level(level).alias("category"),
            F.lit("alert").alias("type"),
            severity_of_level(level).alias("severity"),
            description.alias("reason"),
            F.lit("log").alias("action"),
        ).alias("event"),
        F.struct(
            name.alias("name"),
            _or("agent.id", "unknown").alias("id"),
            _or("agent.ip", "unknown").alias("ip"),
            F.struct(os_of_name(name).alias("type")).alias("os"),
        ).alias("host"),
        F.struct(
            level.alias("level"),
            F.lit(SOURCE_TAG).alias("logger"),
            _or("full_log", "").alias("original"),
        ).alias("log"),
        F.struct(
            _or("rule.id", "unknown").alias("id"),
            description.alias("name"),
            joined_groups(F.col("rule.groups")).alias("category"),
            F.lit(SOURCE_TAG).alias("ruleset"),
        ).alias("rule"),
        log_template(F.col("full_log")).alias("log_template"),
        payload.alias("payload"),
        F.struct(
            F.coalesce("data.srcip", "data.source_ip", F.lit("unknown")).alias("ip"),
            F.col("data.srcport").alias("port"),
        ).alias("source"),
        F.struct(
            F.coalesce("data.dstip", "data.destination_ip", F.lit("unknown")).alias("ip"),
            F.col("data.dstport").alias("port"),
        ).alias("destination"),
        F.current_timestamp().alias("_processing_timestamp"),
        F.lit(True).alias("_normalized"),
    )


def has_numeric_level() -> Column:
    """Whether the level is absent or a number; other alerts cannot be normalised."""
    return F.col("rule.level").isNull() | F.col("rule.level").try_cast("int").isNotNull()


def enrich(alerts: DataFrame, assets: DataFrame) -> DataFrame:
    """Add the asset found by host IP; a miss gives an unknown asset of criticality 1.

    The dimension is broadcast while it is small. One IP must name one asset, so duplicate
    addresses keep the first host name and alerts are never multiplied.
    """
    if estimated_bytes(assets) <= BROADCAST_BYTES:
        assets = assets.coalesce(1)
    dimension = (
        assets.filter(F.col("ip_address").isNotNull())
        .groupBy("ip_address")
        .agg(F.min(F.struct("hostname", "criticality", "role")).alias("found"))
    )
    return (
        alerts.join(broadcast_if_small(dimension), F.col("host.ip") == F.col("ip_address"), "left")
        .withColumn("asset", F.struct(
            F.coalesce("found.hostname", F.lit("unknown")).alias("hostname"),
            F.coalesce("found.criticality", F.lit(1)).alias("criticality"),
            F.coalesce("found.role", F.lit("unknown")).alias("role")))
        .drop("ip_address", "found")
    )
