"""Scored incidents to table rows: mapping, validation, upsert, documents."""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from alertloom.constants import SEVERITY_STORED
from alertloom.functions.columns import lookup
from alertloom.functions.sizing import BROADCAST_BYTES, estimated_bytes
from alertloom.schemas import DOCUMENT, SCORED_INCIDENT

#: How rows are written that a later step reads and deletes.
PASSING = {"compression": "zstd"}
UPDATED_ON_CONFLICT = ["updated_at", "last_seen", "event_count", "confidence", "raw_incident"]


def store_rows(scored: DataFrame, as_of: Column | None = None, kept: Sequence[str] = ()) -> DataFrame:
    """One incidents-table row per scored incident; the record itself stays as a struct. Columns in ``kept`` go along."""
    now = as_of if as_of is not None else F.current_timestamp()
    ts = F.coalesce(F.col("`@timestamp`").cast("timestamp"), now)
    source = F.col("triggering_alert.source.ip")
    host = F.col("triggering_alert.host.name")

    def one(value: Column) -> Column:
        return F.when((value != "") & (value != "unknown"), F.array(value))

    return scored.select(
        F.col("incident_id").alias("id"),
        ts.alias("created_at"), ts.alias("updated_at"), ts.alias("first_seen"), ts.alias("last_seen"),
        F.coalesce(lookup(SEVERITY_STORED, F.coalesce("severity", F.lit("medium"))), F.lit(1)).alias("severity"),
        F.coalesce("ai_inference.attack_class", "correlation_rule.name", F.lit("unknown")).alias("category"),
        F.coalesce("ai_inference.confidence", F.lit(0.0)).alias("confidence"),
        one(source).alias("source_ips"), one(host).alias("target_hosts"),
        F.coalesce("event_count", F.lit(0)).alias("event_count"),
        F.lit(None).cast("array<string>").alias("event_ids"),
        F.lit(None).cast("array<double>").alias("feature_vector"),
        F.lit(None).cast("string").alias("ai_summary"),
        F.coalesce("status", F.lit("open")).alias("status"),
        F.lit(None).cast("string").alias("assigned_to"),
        F.lit(None).cast("string").alias("analyst_notes"),
        F.lit(None).cast("int").alias("label"),
        F.struct(*[F.col(f"`{f.name}`") for f in SCORED_INCIDENT.fields]).alias("raw_incident"),
        *kept,
    )


def _address_pattern() -> str:
    """An IPv4 or IPv6 address with an optional prefix length, every number within its range."""
    octet = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
    v4, h = rf"{octet}(?:\.{octet}){{3}}", "[0-9A-Fa-f]{1,4}"
    forms = [f"(?:{h}:){{7}}{h}", f"(?:{h}:){{6}}{v4}"]
    for n in range(8):  # n groups before the double colon, 7 - n after it at most
        before = f"{h}(?::{h}){{{n - 1}}}" if n else ""
        forms.append(f"{before}::(?:{h}(?::{h}){{0,{6 - n}}})?" if n < 7 else f"{before}::")
        if n < 6:
            forms.append(f"{before}::(?:{h}:){{0,{5 - n}}}{v4}")
    return rf"^(?:{v4}(?:/(?:3[0-2]|[12]?\d))?|(?:{'|'.join(forms)})(?:/(?:12[0-8]|1[01]\d|[1-9]?\d))?)$"


_ADDRESS = _address_pattern()


def violations() -> Column:
    """Names of the table constraints a row breaks; an empty array for a good row."""
    checks = {
        **{f"{c} is null": F.col(c).isNull() for c in (
            "id", "created_at", "updated_at", "first_seen", "last_seen", "severity", "category",
            "event_count", "status", "raw_incident")},
        "severity out of range": ~F.col("severity").between(0, 3),
        "confidence out of range": ~F.col("confidence").between(0, 1),
        "label out of range": ~F.col("label").between(0, 3),
        "category too long": F.length("category") > 64,
        "status too long": F.length("status") > 32,
        "assigned_to too long": F.length("assigned_to") > 128,
        "source_ips not addresses": F.exists("source_ips", lambda a: ~a.rlike(_ADDRESS)),
    }
    return F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in checks.items()]))


def accepted(rows: DataFrame) -> DataFrame:
    return rows.filter(F.size(violations()) == 0)


def rejected(rows: DataFrame) -> DataFrame:
    return rows.withColumn("reasons", violations()).filter(F.size("reasons") > 0)


def fold_upserts(rows: DataFrame, seq: Column) -> DataFrame:
    """State of the table after inserting ``rows`` in ``seq`` order.

    The first row of an id sets every column, later ones change only the columns updated on
    conflict. Both halves are partial aggregates, so a hot id costs one row per task.
    """
    columns = [c for c in rows.columns if c != "_order"]
    kept = [c for c in columns if c not in UPDATED_ON_CONFLICT and c != "id"]
    changed = [c for c in columns if c in UPDATED_ON_CONFLICT]
    return (
        rows.groupBy("id").agg(
            F.min_by(F.struct(*kept), seq).alias("first"),
            F.max_by(F.struct(*changed), seq).alias("last"))
        .select("id", "first.*", "last.*").select(*columns)
    )


def by_repeats(rows: DataFrame, key: str, path: str, one: Callable[[DataFrame], DataFrame], fold: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``one`` of the rows whose key stands there once and ``fold`` of the others, so that only these are shuffled whole.

    The rows are read three times, so they should lie in files. The keys that repeat are written to ``path``; if they are too many to be
    broadcast, all rows are folded.
    """
    again = rows.groupBy(F.col(key).alias("_again")).count().filter("count > 1").select("_again")
    again.write.mode("overwrite").options(**PASSING).parquet(path)
    again = rows.sparkSession.read.schema(again.schema).parquet(path)
    if estimated_bytes(again) > BROADCAST_BYTES:
        return fold(rows)
    same = F.col(key).eqNullSafe(F.col("_again"))
    return one(rows.join(F.broadcast(again), same, "left_anti")).unionByName(fold(rows.join(F.broadcast(again), same, "left_semi")))


def upsert(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """``existing`` (unique ids) after an upsert of ``batch`` (unique ids); ``updated_at`` never goes back, as behind a later edit."""
    old, new = existing.alias("o"), batch.alias("n")
    both = old.join(new, F.col("o.id") == F.col("n.id"), "full_outer")

    def pick(name: str) -> Column:
        mine, theirs = F.col(f"o.{name}"), F.col(f"n.{name}")
        if name == "updated_at":
            return F.greatest(mine, theirs)
        if name in UPDATED_ON_CONFLICT:
            return F.when(F.col("n.id").isNotNull(), theirs).otherwise(mine)
        return F.when(F.col("o.id").isNotNull(), mine).otherwise(theirs)

    return both.select(*[pick(c).alias(c) for c in existing.columns])


def _document_fields() -> list[Column]:
    return [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in DOCUMENT.fields]


def landed_documents(scored: DataFrame, seq: Column, path: str) -> DataFrame:
    """``documents`` of rows that lie in files, of which only ids that repeat are shuffled whole; ``path`` is for these ids."""
    return by_repeats(scored, "incident_id", path, lambda rows: rows.select(*_document_fields()), lambda rows: documents(rows, seq))


def documents(scored: DataFrame, seq: Column) -> DataFrame:
    """The document store: last write per incident id, without the internal ``_`` fields."""
    latest = scored.select(F.struct(*_document_fields()).alias("d"), seq.alias("_seq"))
    return latest.groupBy(F.col("d.incident_id").alias("_id")).agg(
        F.max_by("d", "_seq").alias("d")).select("d.*")


# --- tables in files ----------------------------------------------------------------------


def append_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Add a micro-batch to an append-only table; writing the same batch again replaces it."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def save_days(rows: DataFrame, path: str, replace_days: bool = False) -> None:
    """Write a table by ``created_date``, whole or only the days that occur in ``rows``.

    Files are sized by a rebalance. Inside a file rows are sorted by id, so that row groups hold apart ranges of ids, and each has a
    bloom filter on id: a look-up by id reads the few row groups that may hold it.
    """
    (rows.hint("rebalance", "created_date").sortWithinPartitions("created_date", "id")
     .write.mode("overwrite").partitionBy("created_date")
     .option("partitionOverwriteMode", "dynamic" if replace_days else "static")
     .option("parquet.bloom.filter.enabled#id", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
     .parquet(path))


def on_days(rows: DataFrame, days: DataFrame) -> DataFrame:
    """The rows whose ``created_date`` is in ``days``; other days are pruned. There are no more days than the calendar has."""
    return of_days(rows, [r[0] for r in days.select(F.date_format("created_date", "yyyy-MM-dd")).distinct().collect()])


def of_days(rows: DataFrame, found: Sequence[str | None]) -> DataFrame:
    """The rows of some days, given as text."""
    wanted = F.col("created_date").isin([F.to_date(F.lit(d)) for d in found if d is not None])
    return rows.filter(wanted | F.col("created_date").isNull() if None in found else wanted)


def write_incidents(rows: DataFrame, path: str) -> None:
    """A snapshot of the table partitioned by creation day."""
    save_days(rows.withColumn("created_date", F.to_date("created_at")), path)


def read_incidents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def incident_row_schema() -> T.StructType:
    ts, s = T.TimestampType(), T.StringType()
    f = T.StructField
    return T.StructType([
        f("id", s), f("created_at", ts), f("updated_at", ts), f("first_seen", ts), f("last_seen", ts),
        f("severity", T.IntegerType()), f("category", s), f("confidence", T.DoubleType()),
        f("source_ips", T.ArrayType(s)), f("target_hosts", T.ArrayType(s)),
        f("event_count", T.IntegerType()), f("event_ids", T.ArrayType(s)),
        f("feature_vector", T.ArrayType(T.DoubleType())), f("ai_summary", s), f("status", s),
        f("assigned_to", s), f("analyst_notes", s), f("label", T.IntegerType()),
        f("raw_incident", SCORED_INCIDENT)])
