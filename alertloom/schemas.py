"""Schemas of the records that flow between jobs."""

from pyspark.sql import types as T

_S = T.StringType()


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, _S) for n in names])


# Scalars are read as text: the level of an alert may be sent as 5 or "5".
RAW_ALERT = T.StructType([
    T.StructField("id", _S),
    T.StructField("timestamp", _S),
    T.StructField("@timestamp", _S),
    T.StructField("rule", T.StructType([
        T.StructField("id", _S),
        T.StructField("level", _S),
        T.StructField("description", _S),
        T.StructField("groups", T.ArrayType(_S)),
    ])),
    T.StructField("agent", _strings("id", "name", "ip")),
    T.StructField("full_log", _S),
    T.StructField("data", _strings(
        "srcip", "source_ip", "srcport", "dstip", "destination_ip", "dstport", "dstuser")),
])

ASSET = T.StructType([
    T.StructField("hostname", _S, False),
    T.StructField("ip_address", _S),
    T.StructField("os", _S),
    T.StructField("role", _S),
    T.StructField("site", _S),
    T.StructField("criticality", T.IntegerType()),
    T.StructField("owner", _S),
])

# The part of an alert an incident keeps.
TRIGGERING_ALERT = T.StructType([
    T.StructField("host", T.StructType([
        T.StructField("name", _S), T.StructField("id", _S), T.StructField("ip", _S),
        T.StructField("os", _strings("type"))])),
    T.StructField("source", _strings("ip", "port")),
    T.StructField("rule", _strings("id", "name", "category", "ruleset")),
    T.StructField("event", _strings("id", "module", "category", "type", "severity", "reason", "action")),
    T.StructField("asset", T.StructType([
        T.StructField("hostname", _S), T.StructField("criticality", T.IntegerType()),
        T.StructField("role", _S)])),
])

INCIDENT = T.StructType([
    T.StructField("incident_id", _S),
    T.StructField("@timestamp", T.TimestampType()),
    T.StructField("correlation_rule", T.StructType([
        T.StructField("id", _S), T.StructField("name", _S), T.StructField("description", _S),
        T.StructField("threshold", T.IntegerType()), T.StructField("window_sec", T.IntegerType())])),
    T.StructField("severity", _S),
    T.StructField("status", _S),
    T.StructField("correlation_key", _S),
    T.StructField("event_count", T.IntegerType()),
    T.StructField("triggering_alert", TRIGGERING_ALERT),
    T.StructField("_source", _S),
])

INFERENCE = T.StructType([
    T.StructField("attack_class", _S),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("is_true_positive", T.BooleanType()),
    T.StructField("all_probabilities", T.MapType(_S, T.DoubleType())),
    T.StructField("model", _S),
    T.StructField("inference_timestamp", T.TimestampType()),
])

SCORED_INCIDENT = T.StructType(INCIDENT.fields + [T.StructField("ai_inference", INFERENCE)])

# Document store mapping; identifiers and dates are typed, everything else is kept as is.
DOCUMENT = T.StructType([f for f in SCORED_INCIDENT.fields if not f.name.startswith("_")])

RUN_LOG = T.StructType(
    [T.StructField(n, _S) for n in (
        "scenario_id", "attack_class", "tool_cmd", "target", "start_time_utc", "end_time_utc", "run_note")])

ATTACK_MATRIX = T.StructType([
    T.StructField("scenario_id", _S), T.StructField("attack_class", _S), T.StructField("tool", _S),
    T.StructField("command_template", _S), T.StructField("target", _S),
    T.StructField("repetitions", T.IntegerType()),
    T.StructField("expected_wazuh_rule_id", _S), T.StructField("notes", _S)])

LABELLED = _strings(
    "label", "scenario_id", "run_id", "rule_id", "rule_level", "rule_description", "rule_groups",
    "agent_id", "agent_name", "srcip", "dstuser", "timestamp", "event_id")
