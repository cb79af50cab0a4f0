"""Analyst queries over the incidents table. ``as_of`` stands for the time of the request."""

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from alertloom.constants import (
    ATTACK_LABEL_FR, SEVERITY_LABEL, SEVERITY_LABEL_FR, SEVERITY_SERIES, STATUS_LABEL_FR,
)
from alertloom.functions.columns import lookup, percent

PERIODS = {
    # period: (interval, truncation, label format)
    "24h": ("24 HOURS", "hour", "HH:mm"),
    "7d": ("7 DAYS", "day", "dd/MM"),
    "30d": ("30 DAYS", "day", "dd/MM"),
}
SORTS = {"created_at", "severity", "confidence", "event_count"}


def _count() -> Column:
    return F.count("*")


def health(incidents: DataFrame) -> DataFrame:
    return incidents.agg(_count().alias("incidents")).select(F.lit("ok").alias("status"), "incidents")


def summary(incidents: DataFrame) -> DataFrame:
    """All headline counts in one scan."""
    severity = F.col("severity")
    return incidents.agg(
        _count().alias("total"),
        F.count_if(F.col("status") == "open").alias("open"),
        F.count_if(severity == 3).alias("critical"),
        F.count_if(severity == 2).alias("high"),
        F.count_if(severity == 1).alias("medium"),
        F.count_if(severity == 0).alias("info"),
        F.count_if(F.col("raw_incident.ai_inference.is_true_positive")).alias("true_positives"),
    )


def by_severity(incidents: DataFrame) -> DataFrame:
    """Four fixed rows, also for severities without incidents."""
    counted = incidents.agg(*[
        F.count_if(F.col("severity") == level).alias(f"s{level}") for _, level, _ in SEVERITY_SERIES])
    series = F.array(*[
        F.struct(F.lit(name).alias("name"), F.col(f"s{level}").alias("value"), F.lit(colour).alias("color"))
        for name, level, colour in SEVERITY_SERIES])
    return counted.select(F.inline(series))


def by_category(incidents: DataFrame, limit: int = 8) -> DataFrame:
    return (
        incidents.groupBy("category").agg(_count().alias("cnt"))
        .orderBy(F.desc("cnt"), "category").limit(limit)
    )


def by_status(incidents: DataFrame) -> DataFrame:
    return incidents.groupBy("status").agg(_count().alias("cnt"))


def since(incidents: DataFrame, as_of: Column, interval: str) -> DataFrame:
    """Incidents created within ``interval`` before ``as_of``; whole days are pruned unread."""
    start = as_of - F.expr(f"INTERVAL {interval}")
    recent = incidents.filter(F.col("created_at") >= start)
    return recent.filter(F.col("created_date") >= F.to_date(start)) if "created_date" in incidents.columns else recent


def timeline(incidents: DataFrame, period: str, as_of: Column) -> DataFrame:
    """Counts per hour or day, oldest first; buckets without incidents are absent."""
    if period not in PERIODS:
        raise ValueError(f"period must be one of {sorted(PERIODS)}")
    interval, unit, label = PERIODS[period]
    severity = F.col("severity")
    return (
        since(incidents, as_of, interval)
        .groupBy(F.date_trunc(unit, "created_at").alias("bucket"))
        .agg(_count().alias("total"),
             F.count_if(severity == 3).alias("critical"),
             F.count_if(severity == 2).alias("high"),
             F.count_if(severity == 1).alias("medium"))
        .orderBy("bucket")
        .select(F.date_format("bucket", label).alias("label"), "total", "critical", "high", "medium")
    )


def _bounded(limit: int) -> int:
    if not 1 <= limit <= 50:
        raise ValueError("limit must be between 1 and 50")
    return limit


def top_hosts(incidents: DataFrame, limit: int = 10) -> DataFrame:
    return (
        incidents.select(F.explode("target_hosts").alias("host"), "severity")
        .groupBy("host").agg(_count().alias("incident_count"), F.max("severity").alias("max_severity"))
        .orderBy(F.desc("incident_count"), "host").limit(_bounded(limit))
    )


def host_share(hosts: DataFrame) -> DataFrame:
    """Count of each listed host as a percentage of the leader's. ``hosts`` is a top-k report."""
    leader = hosts.agg(F.max("incident_count")).scalar()
    base = F.when(leader > 0, leader).otherwise(1)
    return hosts.withColumn("share", F.col("incident_count") / base * 100)


def top_rules(incidents: DataFrame, limit: int = 10) -> DataFrame:
    rule = F.col("raw_incident.correlation_rule")
    return (
        incidents.groupBy(rule.getField("id").alias("rule_id"), rule.getField("name").alias("rule_name"))
        .agg(_count().alias("fired_count"), F.round(F.avg("confidence"), 3).alias("avg_confidence"))
        .orderBy(F.desc("fired_count"), "rule_id").limit(_bounded(limit))
    )


def confidence_histogram(incidents: DataFrame) -> DataFrame:
    c = F.col("confidence")
    label = (F.when(c >= 0.9, "90-100%").when(c >= 0.7, "70-90%").when(c >= 0.5, "50-70%").otherwise("<50%"))
    return (
        incidents.filter(c.isNotNull()).groupBy(label.alias("range")).agg(_count().alias("count"))
        .orderBy(F.desc("range"))
    )


def _containing(text: str) -> str:
    """A pattern for texts that contain ``text``, in which ``%`` and ``_`` stay wildcards and a backslash is a character."""
    return "%" + text.replace("\\", "\\\\") + "%"


def search_patterns(text: str) -> tuple[str, str]:
    """What a record as JSON and what a plain text must be like to contain ``text``."""
    return _containing(json.dumps(text, ensure_ascii=False)[1:-1]), _containing(text)


@dataclass(frozen=True)
class Filters:
    """Conditions of the incident list; empty text and None are off, severity 0 is on."""

    severity: int | None = None
    status: str | None = None
    category: str | None = None
    search: str | None = None

    def condition(self) -> Column:
        on = F.lit(True)
        if self.severity is not None:
            on = on & (F.col("severity") == self.severity)
        if self.status:
            on = on & (F.col("status") == self.status)
        if self.category:
            on = on & F.col("category").ilike(_containing(self.category))
        if self.search:
            in_record, pattern = search_patterns(self.search)
            on = on & (
                F.to_json("raw_incident").ilike(in_record)
                | F.col("category").ilike(pattern)
                | F.coalesce(F.exists("target_hosts", lambda h: h.ilike(pattern)), F.lit(False))
            )
        return on


def sort_order(sort: str, order: str) -> list[Column]:
    name = sort if sort in SORTS else "created_at"
    column = F.col(name)
    return [column.asc_nulls_last() if order == "asc" else column.desc_nulls_first(), F.col("id")]


def _paths() -> list[Column]:
    raw = F.col("raw_incident")
    return [
        raw.getField("correlation_rule").getField("id").alias("rule_id"),
        raw.getField("correlation_rule").getField("name").alias("rule_name"),
        raw.getField("ai_inference").getField("attack_class").alias("attack_class"),
        raw.getField("ai_inference").getField("is_true_positive").cast("string").alias("is_true_positive"),
    ]


_LIST = ["id", "created_at", "severity", "category", "confidence", "status", "event_count",
         "source_ips", "target_hosts", "first_seen", "last_seen", "assigned_to"]
_RECENT = ["id", "created_at", "severity", "category", "confidence", "status", "event_count", "target_hosts"]


def with_severity_labels(rows: DataFrame) -> DataFrame:
    return (
        rows.withColumn("severity_label", lookup(SEVERITY_LABEL, F.col("severity"), "unknown"))
        .withColumn("severity_fr", lookup(SEVERITY_LABEL_FR, F.col("severity"), "Inconnu"))
    )


def check_page(per_page: int, page: int) -> None:
    if page < 1 or not 1 <= per_page <= 100:
        raise ValueError("page must be at least 1 and per_page between 1 and 100")


def list_columns(rows: DataFrame) -> DataFrame:
    return with_severity_labels(rows.select(*_LIST, *_paths()))


def list_incidents(incidents: DataFrame, filters: Filters = Filters(), page: int = 1, per_page: int = 20,
                   sort: str = "created_at", order: str = "desc") -> DataFrame:
    """One page of the filtered, sorted list: a top-k, never a full sort."""
    check_page(per_page, page)
    rows = incidents.filter(filters.condition()).orderBy(*sort_order(sort, order))
    if page > 1:
        rows = rows.offset((page - 1) * per_page)
    return list_columns(rows.limit(per_page))


def next_page(incidents: DataFrame, last_value, last_id: str, filters: Filters = Filters(), per_page: int = 20,
              sort: str = "created_at", order: str = "desc") -> DataFrame:
    """The page after the row with ``last_id`` and ``last_value`` in the column sorted by; its cost does not grow with depth.

    Nulls come first in descending order and last in ascending order, as in the list itself.
    """
    check_page(per_page, 1)
    column = F.col(sort if sort in SORTS else "created_at")
    tied = F.col("id") > F.lit(last_id)
    if last_value is None:
        beyond = column.isNull() & tied
        if order != "asc":
            beyond = beyond | column.isNotNull()
    else:
        last = F.lit(last_value)
        ahead = (column > last) | column.isNull() if order == "asc" else column < last
        beyond = ahead | ((column == last) & tied)
    return list_incidents(incidents.filter(beyond), filters, 1, per_page, sort, order)


def page_meta(incidents: DataFrame, filters: Filters = Filters(), page: int = 1, per_page: int = 20) -> DataFrame:
    check_page(per_page, page)
    return incidents.filter(filters.condition()).agg(_count().alias("total")).select(
        "total", F.lit(page).alias("page"), F.lit(per_page).alias("per_page"),
        F.expr(f"(total + {per_page - 1}) div {per_page}").alias("pages"))


def newest_days(incidents: DataFrame, rows: int) -> DataFrame:
    """The days from which the newest ``rows`` incidents come, of a table partitioned by ``created_date``; other tables whole.

    The days are counted on the partition column alone, and ``rows`` of them are read at most, as none is empty.
    """
    if "created_date" not in incidents.columns:
        return incidents
    counts = incidents.filter("created_date is not null").groupBy("created_date").agg(_count().alias("n"))
    seen, first = 0, None
    for day in counts.orderBy(F.desc("created_date")).limit(rows).collect():
        seen, first = seen + day["n"], day["created_date"]
        if seen >= rows:
            return incidents.filter((F.col("created_date") >= F.lit(first)) | F.col("created_date").isNull())
    return incidents


def recent(incidents: DataFrame, limit: int = 10) -> DataFrame:
    rows = newest_days(incidents, _bounded(limit))
    newest = rows.orderBy(*sort_order("created_at", "desc")).limit(_bounded(limit))
    return with_severity_labels(newest.select(*_RECENT, *_paths()))


def get(incidents: DataFrame, incident_id) -> DataFrame:
    """The incident with an id, or no row."""
    return with_severity_labels(incidents.filter(F.col("id") == incident_id))


EDITABLE = ["status", "assigned_to", "analyst_notes"]


def apply_edits(incidents: DataFrame, edits: DataFrame, as_of: Column, order: Column | None = None) -> DataFrame:
    """The table after a batch of analyst edits (id and any of the editable columns).

    Only values given change, and only rows with a given value get a new ``updated_at``. Of
    several edits of one incident, the last given value in ``order`` stays, per column.
    """
    given = [c for c in EDITABLE if c in edits.columns]
    place = order if order is not None else F.struct(*given)
    asked = edits.filter(F.coalesce(*given).isNotNull()).groupBy("id").agg(*[
        F.max_by(c, F.when(F.col(c).isNotNull(), place)).alias(f"_{c}") for c in given])
    joined = incidents.join(asked.withColumn("_edited", F.lit(True)), "id", "left")
    columns = []
    for c in incidents.columns:
        if c in given:
            columns.append(F.coalesce(f"_{c}", c).alias(c))
        elif c == "updated_at":
            columns.append(F.when(F.col("_edited"), as_of).otherwise(F.col(c)).alias(c))
        else:
            columns.append(F.col(c))
    return joined.select(*columns)


def refused_edits(incidents: DataFrame, edits: DataFrame) -> DataFrame:
    """Edits that change nothing: no value given, or an id the table lacks."""
    given = [c for c in EDITABLE if c in edits.columns]
    known = incidents.select("id", F.lit(True).alias("_known"))
    reason = (F.when(F.coalesce(*given).isNull(), "no field to update")
              .when(F.col("_known").isNull(), "incident not found"))
    return edits.join(known, "id", "left").withColumn("reason", reason).filter("reason IS NOT NULL").drop("_known")


def with_display_labels(rows: DataFrame) -> DataFrame:
    """Text the dashboard shows: attack class (else category), status, confidence."""
    shown = F.coalesce(lookup(ATTACK_LABEL_FR, F.col("attack_class")), "attack_class", "category")
    return (
        rows.withColumn("attack_text", shown)
        .withColumn("status_text", F.coalesce(lookup(STATUS_LABEL_FR, F.col("status")), "status"))
        .withColumn("confidence_text", percent(F.col("confidence")))
    )


def labelled(incidents: DataFrame) -> DataFrame:
    """Every incident with its display labels."""
    rows = incidents.select("id", "severity", "status", "category", "confidence", *_paths())
    return with_display_labels(with_severity_labels(rows))


def top_probabilities(incidents: DataFrame, limit: int = 5) -> DataFrame:
    """The most likely classes of each incident with their rank; ties go by class name."""
    entries = F.map_entries("raw_incident.ai_inference.all_probabilities")
    ranked = F.slice(F.array_sort(F.transform(
        entries, lambda e: F.struct((-e["value"]).alias("neg"), e["key"].alias("key")))), 1, limit)
    return incidents.select("id", F.posexplode(ranked).alias("pos", "e")).select(
        "id", (F.col("pos") + 1).alias("rank"), F.col("e.key").alias("attack_class"),
        (-F.col("e.neg")).alias("probability"))


def host_overflow(incidents: DataFrame) -> DataFrame:
    """The first two hosts of each incident and how many more it has."""
    hosts = F.coalesce("target_hosts", F.array().cast("array<string>"))
    return incidents.select(
        "id", F.slice(hosts, 1, 2).alias("shown"), F.greatest(F.size(hosts) - 2, F.lit(0)).alias("more"))
