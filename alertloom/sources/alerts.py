"""JSON-lines alert feed: reading, parsing, stamping, dead letters and incremental resume."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from alertloom.constants import SOURCE_TAG
from alertloom.functions.columns import iso_timestamp, once
from alertloom.functions.normalize import has_numeric_level
from alertloom.schemas import RAW_ALERT

_WHITESPACE = " \t\n\r\x0b\x0c"
_CORRUPT = "_corrupt"
#: How far clocks of senders may run ahead.
AHEAD = "1 DAY"
_PARSED = T.StructType(RAW_ALERT.fields + [T.StructField(_CORRUPT, T.StringType())])


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Backlog of a landing folder: every line, one row each, in column ``value``."""
    return spark.read.text(path)


def follow_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream of the lines in files that appear in a landing folder.

    Files must be moved into place whole; the checkpoint of the query keeps the position, so
    a restart neither repeats nor skips a file. Spark takes files in the order of their modification times, in milliseconds, and those of
    one millisecond in any order; the lateness that a query allows must cover the alerts' times of such files.
    """
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)


def has_usable_time() -> Column:
    """Whether the alert's own time is there and at most ``AHEAD`` in the future."""
    return F.coalesce(iso_timestamp(F.col("timestamp")) <= F.current_timestamp() + F.expr(f"INTERVAL {AHEAD}"), F.lit(False))


def parse(lines: DataFrame, timed: bool = False) -> DataFrame:
    """RAW_ALERT columns plus ``payload`` and ``_error`` for every non-blank line.

    ``_error`` is null for a good alert, else ``malformed`` (not a JSON object, or an object
    of the wrong shape), ``level`` (a rule level that is not a number) or, if ``timed`` asks for it,
    ``time`` (no time that parses, or one in the future; such an alert has no place in event time and must not move
    a watermark). Bytes that are not UTF-8 are replaced. Other columns of ``lines`` are kept.
    """
    value = F.btrim(F.make_valid_utf8(F.col("value")), F.lit(_WHITESPACE))
    kept = [c for c in lines.columns if c != "value"]
    record = F.from_json("payload", _PARSED, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    parsed = (
        lines.select(*kept, value.alias("payload"))
        .filter(F.col("payload") != "")
        .select(*kept, "payload", once(record).alias("_a"))
    )
    malformed = (
        ~F.col("payload").startswith("{") | F.col("_a").isNull() | F.col(f"_a.{_CORRUPT}").isNotNull()
    )
    fields = [F.col(f"_a.`{f.name}`").alias(f.name) for f in RAW_ALERT.fields]
    return (
        parsed.select(*kept, "payload", malformed.alias("_malformed"), *fields)
        .withColumn("_error", F.when(F.col("_malformed"), "malformed")
                    .when(~has_numeric_level(), "level")
                    .when(F.lit(timed) & ~has_usable_time(), "time"))
        .drop("_malformed")
    )


def good(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("_error").isNull()).drop("_error")


def dead_letters(parsed: DataFrame) -> DataFrame:
    kept = [c for c in parsed.columns if c not in RAW_ALERT.fieldNames()]
    return parsed.filter(F.col("_error").isNotNull()).select(*kept)


def stamp(alerts: DataFrame) -> DataFrame:
    """Event id, ingest time and source tag.

    An alert without an id gets the hash of its text, so a replay gives the same id.
    """
    return (
        alerts.withColumn("_event_id", F.coalesce("id", F.sha2(F.col("payload"), 256)))
        .withColumn("_ingest_timestamp", F.current_timestamp())
        .withColumn("_source", F.lit(SOURCE_TAG))
    )


def ingest(lines: DataFrame, timed: bool = False) -> DataFrame:
    """Good, stamped alerts of a line feed, batch or streaming. Ask for ``timed`` ones before a correlation: an undated alert would get
    the time of the run, so that a replay differs, and a stream takes it for a dead letter."""
    return stamp(good(parse(lines, timed)))


def alert_time() -> Column:
    """``timestamp``, else ``@timestamp``; null when the chosen one does not parse."""
    text = F.when(F.col("timestamp") != "", F.col("timestamp")).otherwise(F.col("@timestamp"))
    return iso_timestamp(text)


def after(alerts: DataFrame, position: Column, high_water) -> DataFrame:
    """Batch resume: rows beyond the stored position."""
    return alerts if high_water is None else alerts.filter(position > F.lit(high_water))
