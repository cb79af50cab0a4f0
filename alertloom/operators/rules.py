"""Correlation rules as column builders, and their fan-out over enriched alerts."""

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F

from alertloom.constants import BRUTE_FORCE_RULE_IDS, CORRELATION_RULES, PORT_SCAN_RULE_ID, PRIVILEGE_MARKERS
from alertloom.functions.columns import micros, once


@dataclass(frozen=True)
class Rule:
    """A keyed, expiring counter over matching alerts.

    ``member`` makes the rule count distinct members instead of alerts. The builders are
    called when a plan is made, so a rule is plain Spark columns and users add their own.
    """

    id: str
    name: str
    description: str
    window_sec: int
    threshold: int
    severity: str
    match: Callable[[], Column]
    key_prefix: str
    key: Callable[[], Column]
    member: Callable[[], Column] | None = None


def _severity_in(*names: str) -> Column:
    return F.col("event.severity").isin(*names)


def _category_has(*marks: str) -> Column:
    found = F.lit(False)
    for mark in marks:
        found = found | F.col("rule.category").contains(mark)
    return found


def _source() -> Column:
    return F.col("source.ip")


def _host() -> Column:
    return F.col("host.name")


# What each rule matches, the key it counts by and, for a distinct count, the member.
_CONDITIONS: dict[str, tuple[Callable[[], Column], Callable[[], Column], Callable[[], Column] | None]] = {
    "CORR-001": (lambda: F.col("rule.id").isin(*BRUTE_FORCE_RULE_IDS) | _category_has("authentication_failed", "brute_force"),
                 _source, None),
    "CORR-002": (lambda: _severity_in("high", "critical") & _category_has(*PRIVILEGE_MARKERS), _host, None),
    "CORR-003": (lambda: (_source() != "unknown") & _severity_in("medium", "high", "critical"), _source, _host),
    "CORR-004": (lambda: F.lit(True), _host, None),
    "CORR-005": (lambda: _severity_in("high", "critical"), _host, None),
    "CORR-006": (lambda: F.col("rule.id") == PORT_SCAN_RULE_ID, _source, None),
}

RULES: tuple[Rule, ...] = tuple(
    Rule(name, title, text, window, threshold, severity, _CONDITIONS[name][0], prefix, _CONDITIONS[name][1], _CONDITIONS[name][2])
    for name, title, text, window, threshold, severity, prefix in CORRELATION_RULES)


def scaled(rules: Sequence[Rule], factor: int) -> tuple[Rule, ...]:
    """The same rules with windows ``factor`` times as long."""
    return tuple(replace(r, window_sec=r.window_sec * factor) for r in rules)


def _hit(rule: Rule) -> Column:
    member = rule.member() if rule.member else F.lit(None)
    return F.struct(
        F.lit(rule.id).alias("rule_id"),
        F.concat(F.lit(rule.key_prefix + ":"), F.coalesce(rule.key(), F.lit("unknown"))).alias("key"),
        F.coalesce(member.cast("string"), F.lit("unknown")).alias("member"),
        F.lit(rule.window_sec * 1_000_000).cast("long").alias("window_us"),
        F.lit(rule.threshold).alias("threshold"),
    )


def matches(alerts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per alert that matches a rule: ``hits`` (rule_id, key, member, window_us, threshold), ts_us, event_id and the parts of
    the alert an incident keeps.

    All rules are tested in one pass; the alert text and payload are left behind here, so
    they never reach a shuffle.
    """
    hits = F.array_compact(F.array(*[F.when(r.match(), _hit(r)) for r in rules]))
    kept = F.struct(*[F.col(c) for c in ("host", "source", "rule", "event", "asset") if c in alerts.columns])
    found = alerts.select(
        once(hits).alias("hits"), micros(F.col("event_ts")).alias("ts_us"),
        F.col("event.id").alias("event_id"), kept.alias("alert"))
    return found.filter(F.size("hits") > 0)


def each_hit(matched: DataFrame, *kept: str) -> DataFrame:
    """The hits of ``matches``, one row each, with the columns in ``kept``."""
    return matched.select(F.explode("hits").alias("hit"), *kept).select("hit.*", *kept)


def fan_out(alerts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per (alert, matching rule): rule_id, key, member, window_us, threshold, ts_us,
    event_id and the parts of the alert an incident keeps."""
    return each_hit(matches(alerts, rules), "ts_us", "event_id", "alert")


def match_counts(alerts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """How many alerts each rule matches, zero included, in one pass and one tiny shuffle."""
    counted = alerts.agg(*[F.count_if(r.match()).alias(r.id) for r in rules])
    pairs = F.explode(F.array(*[
        F.struct(F.lit(r.id).alias("rule_id"), F.col(f"`{r.id}`").alias("matched")) for r in rules]))
    return counted.select(pairs.alias("p")).select("p.*")
