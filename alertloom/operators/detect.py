"""Detection rules over log tables: firewall parsing, port scans, SSH brute force, logons."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from alertloom.constants import DETECTIONS, RULE_ATTACK_CLASS
from alertloom.functions.columns import lookup, once
from alertloom.operators.skew import TARGET_ROWS, with_chunks

# What may stand at each of the leading places of a line, in order: the name of the field, if it is kept, and its form.
_NUMBER, _PRESENT, _ANY = r"\d+", r"[^,\s]+", r"[^,\s]*"
_PLACES = [
    (None, _NUMBER),  # rule
    (None, _ANY),  # sub-rule
    (None, _ANY),  # anchor
    (None, _PRESENT),  # tracker
    ("interface", _PRESENT),
    ("reason", _PRESENT),
    ("action", _PRESENT),
    (None, _PRESENT),  # direction
    (None, _NUMBER),  # IP version
    (None, _ANY),  # type of service
    (None, _ANY),  # congestion
    (None, _NUMBER),  # time to live
    (None, _ANY),  # packet id
    (None, _ANY),  # offset
    (None, _ANY),  # flags
    ("protocol_id", _NUMBER),
    ("protocol", _PRESENT),
    (None, _NUMBER),  # length
    ("srcip", _PRESENT),
    ("dstip", _PRESENT),
    ("srcport", _NUMBER),
    ("dstport", _NUMBER),  # what follows doesn't matter
]
# The program's name alone, or after a syslog header of the old form, of the new form, or of an ISO time and a host.
_PROGRAM = r"filterlog(?:\[\d+\])?:\s*"
_HEADS = [
    _PROGRAM,
    r"(?:<\d{1,3}>)?[A-Z][a-z]{2}\s+\d{1,2}\s\d\d:\d\d:\d\d\s+(?:\S+\s+)?" + _PROGRAM,
    r"(?:<\d{1,3}>)?\d{4}-\d\d-\d\dT\S+\s+(?:\S+\s+)?" + _PROGRAM,
    r"<\d{1,3}>\d{1,2}\s\S+\s\S+\sfilterlog\s\S+\s\S+\s(?:-|\[[^\]]*\])\s*",
]
_LINE = "^(?:" + "|".join(_HEADS) + ")(" + ",".join(form for _, form in _PLACES) + ")"


def parse_firewall(lines: DataFrame) -> DataFrame:
    """Firewall events of log lines, with or without a syslog header: the named fields by position. Lines of other programs,
    and of protocols without ports, are left out."""
    kept = [c for c in lines.columns if c != "value"]
    fields = F.split(F.regexp_extract("value", _LINE, 1), ",")
    return (
        lines.filter(F.col("value").contains("filterlog"))
        .select(*kept, once(fields).alias("_f"))
        .filter(F.size("_f") == len(_PLACES))
        .select(*kept, *[F.get("_f", i).alias(name) for i, (name, _) in enumerate(_PLACES) if name])
    )


def detected(rows: DataFrame, rule_id: str, *named: str, **numbers: int) -> DataFrame:
    """``rows`` as alerts of a detection; its text names the columns ``named`` and the numbers of its rule."""
    level, mitre, groups, text = DETECTIONS[rule_id]
    text = text.format(**numbers) if numbers else text
    return (
        rows.withColumn("rule_id", F.lit(rule_id)).withColumn("level", F.lit(level))
        .withColumn("description", F.format_string(text, *named) if named else F.lit(text))
        .withColumn("mitre", F.lit(mitre).cast("string"))
        .withColumn("groups", F.array(*map(F.lit, groups)))
    )


def firewall_alerts(events: DataFrame) -> DataFrame:
    """The base alert of every parsed firewall event."""
    return detected(events, "100200", "action", "protocol", "srcip", "srcport", "dstip", "dstport").drop("mitre")


def trailing_count(events: DataFrame, key: str, seconds: int, count: int, split: str = "auto",
                   target_rows: int = TARGET_ROWS) -> DataFrame:
    """Events that are at least the ``count``-th of their key within the last ``seconds``.

    The ``count - 1`` events before an event decide. In a sliced hot key, each slice is given
    the last ``count - 1`` events before it, found from the ends of the slices alone.
    ``events`` has ts_us and event_id.
    """
    chunked, sliced = with_chunks(events, [key], split, target_rows)
    rows = chunked.withColumn("_kind", F.lit(1))
    if sliced:
        rows = rows.unionByName(_preceding(rows.filter(F.col("chunk") > 0), key, count - 1), allowMissingColumns=True)
    order = Window.partitionBy(key, "chunk").orderBy("ts_us", "_kind", "event_id")
    back = F.lag("ts_us", count - 1).over(order)
    return (
        rows.withColumn("_span", F.col("ts_us") - back)
        .filter((F.col("_kind") == 1) & (F.col("_span") <= seconds * 1_000_000))
        .drop("_kind", "_span", "chunk")
    )


def _preceding(rows: DataFrame, key: str, n: int) -> DataFrame:
    """Per slice, ``kind`` 0 copies of the times of the ``n`` events before its first event."""
    inside = Window.partitionBy(key, "chunk")
    ends = (
        rows.select(key, "chunk", "ts_us", "event_id")
        .withColumn("_first", F.row_number().over(inside.orderBy("ts_us", "event_id")) == 1)
        .withColumn("_left", F.row_number().over(inside.orderBy(F.desc("ts_us"), F.desc("event_id"))))
        .filter(F.col("_first") | (F.col("_left") <= n))
    )
    before = Window.partitionBy(key).orderBy("ts_us", "event_id").rowsBetween(-n, -1)
    return (
        ends.withColumn("_before", F.collect_list("ts_us").over(before))
        .filter("_first")
        .select(key, "chunk", F.explode("_before").alias("ts_us"), F.lit(0).alias("_kind"))
    )


def ssh_brute_force(alerts: DataFrame, split: str = "auto", target_rows: int = TARGET_ROWS, seconds: int = 60,
                    count: int = 6) -> DataFrame:
    """``count`` failed SSH logins of one source within ``seconds``. ``alerts`` has rule_id, srcip,
    ts_us and event_id."""
    failed = alerts.filter((F.col("rule_id") == "5710") & F.col("srcip").isNotNull())
    found = trailing_count(failed, "srcip", seconds, count, split, target_rows)
    return detected(found, "100210", "srcip", count=count, seconds=seconds)


def windows_privilege_logon(logs: DataFrame) -> DataFrame:
    """Special privileges given to a new Windows logon. ``logs`` has parent_id and win_event_id."""
    return detected(logs.filter((F.col("parent_id") == "60001") & (F.col("win_event_id") == "4672")), "100300")


def rule_attack_class(rule_id: Column) -> Column:
    """The attack class a detection rule stands for, null for other rules."""
    return lookup(RULE_ATTACK_CLASS, rule_id)
