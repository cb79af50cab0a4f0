"""Continuous jobs: ingest, enrich, correlate, score, store. Each is a source, a plan and a sink
with its own checkpoint; ``run_available`` processes what is there and stops."""

import threading

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from alertloom.functions.normalize import enrich, normalize
from alertloom.operators import model as classifier, store
from alertloom.operators.table import upsert_rows
from alertloom.schemas import INCIDENT, SCORED_INCIDENT
from alertloom.sources import alerts as feed, files


def observed(parsed: DataFrame) -> DataFrame:
    """Parsed lines with counts of lines and errors in the progress of the query."""
    return parsed.observe("feed", F.count(F.lit(1)).alias("lines"), F.count("_error").alias("errors"))


def enriched_stream(lines: DataFrame, assets: DataFrame) -> DataFrame:
    """Alert lines to enriched alerts: map-only, one query. Alerts without a usable time are errors here."""
    return enrich(normalize(feed.stamp(feed.good(observed(feed.parse(lines, timed=True))))), assets)


def ingest_stream(lines: DataFrame, checkpoint: str, alerts: str, dead: str, timed: bool = False) -> DataStreamWriter:
    """Good alerts into one table and dead letters into another, both replaced by a retry. With ``timed``, alerts without a
    usable time are dead letters too, as they are for the correlation."""

    def land(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        store.append_batch(feed.stamp(feed.good(batch)), alerts, batch_id)
        store.append_batch(feed.dead_letters(batch), dead, batch_id)
        batch.unpersist()

    return observed(feed.parse(lines, timed)).writeStream.option("checkpointLocation", checkpoint).foreachBatch(land)


def decode(messages: DataFrame, schema: StructType) -> DataFrame:
    """Records of JSON messages in column ``value``; messages that do not parse are dropped. Other columns are kept."""
    kept = [c for c in messages.columns if c != "value"]
    record = F.from_json("value", schema)
    return messages.select(*kept, record.alias("r")).filter(F.col("r.incident_id").isNotNull()).select(*kept, "r.*")


def incidents_of(messages: DataFrame) -> DataFrame:
    return decode(messages, INCIDENT)


def scored_incidents_of(messages: DataFrame) -> DataFrame:
    return decode(messages, SCORED_INCIDENT)


def score_stream(incidents: DataFrame, model: PipelineModel) -> DataFrame:
    """Scored incidents; the model runs inside the tasks, one micro-batch at a time."""
    return classifier.score(model, incidents)


def store_batch(scored: DataFrame, batch_id: int, table: str, docs: str, rejects: str) -> None:
    """Upsert one micro-batch into the table, and add it to the document log and the rejects.

    Within a batch, rows of one id are ordered by ``_position``, their place in the source, and the line within a file; without one by
    their time and content. So a retry writes the same. Every sink is tried, and applying a batch again leaves each as it was. If
    any failed the batch fails, so the checkpoint makes Spark run it again. The sinks read the batch from a folder beside the table, where
    it takes less room than in a cache on the executors' disks; the folder goes with the batch.
    """
    if "_position" in scored.columns:
        place = F.struct("_position.*", F.monotonically_increasing_id().alias("line"))
    else:
        place = F.struct(F.col("`@timestamp`").alias("time"), F.xxhash64(F.to_json(F.struct("*"))).alias("content"))
    spark, landed = scored.sparkSession, f"{table}_landed"
    scored = scored.withColumn("_seq", place)
    scored.write.mode("overwrite").options(**store.PASSING).parquet(landed)
    scored = spark.read.schema(scored.schema).parquet(landed)
    rows = store.store_rows(scored, kept=["_seq"])
    failures = []
    for name, write in (
        ("table", lambda: upsert_rows(table, store.accepted(rows), landed=True)),
        ("rejects", lambda: store.append_batch(store.rejected(rows), rejects, batch_id)),
        ("documents", lambda: store.append_batch(
            store.landed_documents(scored, F.col("_seq"), f"{table}_again").withColumn("_seq", F.lit(0)), docs, batch_id)),
    ):
        try:
            write()
        except Exception as e:
            failures.append(f"{name}: {e}")
    for scratch in (landed, f"{table}_again"):
        files.delete(spark, scratch)
    if failures:
        raise RuntimeError("; ".join(failures))


def store_stream(scored: DataFrame, checkpoint: str, table: str, docs: str, rejects: str) -> DataStreamWriter:
    return scored.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: store_batch(batch, batch_id, table, docs, rejects))


def current_documents(spark: SparkSession, path: str) -> DataFrame:
    """Latest document per incident id over all batches."""
    log = spark.read.parquet(path)
    order = F.struct("batch_id", "_seq")
    return log.groupBy("incident_id").agg(
        F.max_by(F.struct(*[F.col(f"`{c}`") for c in log.columns if c not in ("batch_id", "_seq")]), order)
        .alias("d")).select("d.*")


def run_available(writer: DataStreamWriter, timeout_seconds: int | None = None) -> StreamingQuery:
    """Start a query, let it process all available input, and wait for its end, which takes as long as the input asks for unless
    ``timeout_seconds`` sets a bound."""
    Progress.of(SparkSession.active())
    query = writer.trigger(availableNow=True).start()
    if timeout_seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_seconds):
        query.stop()
        raise TimeoutError("the stream did not finish in time")
    return query


def to_table(df: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    return df.writeStream.format("parquet").option("path", path).option(
        "checkpointLocation", checkpoint).outputMode("append")


class Progress(StreamingQueryListener):
    """Adds up what every micro-batch of every query reports, however many there are, by the query's id, which a restart from a checkpoint keeps.

    Spark itself keeps the last 100 reports of a query only. ``Progress.of(spark)`` registers the one listener of a session; a query is counted
    from then on.
    """

    _of_session: "dict[int, tuple[SparkSession, Progress]]" = {}

    def __init__(self):
        self.totals: dict[str, dict[str, int]] = {}
        self.ended: set[str] = set()
        self.changed = threading.Condition()

    @classmethod
    def of(cls, spark: SparkSession) -> "Progress":
        held = cls._of_session.get(id(spark))
        if held is None or held[0] is not spark:
            held = cls._of_session[id(spark)] = (spark, cls())
            spark.streams.addListener(held[1])
        return held[1]

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        feed = p.observedMetrics.get("feed")
        new = {"batches": 1, "input": p.numInputRows, "late": sum(op.numRowsDroppedByWatermark for op in p.stateOperators),
               "lines": feed["lines"] if feed else 0, "errors": feed["errors"] if feed else 0}
        with self.changed:
            total = self.totals.setdefault(str(p.id), dict.fromkeys(new, 0))
            for k, v in new.items():
                total[k] += v

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def total(self, query: StreamingQuery, timeout_seconds: float = 60) -> dict[str, int]:
        """The totals of a query over all its runs that were listened to; of one that has ended, with its last report."""
        with self.changed:
            if not query.isActive and not self.changed.wait_for(lambda: str(query.runId) in self.ended, timeout_seconds):
                raise TimeoutError("the end of the query was not reported")
            return dict(self.totals.get(str(query.id), dict.fromkeys(("batches", "input", "late", "lines", "errors"), 0)))


def counters(query: StreamingQuery) -> dict[str, int]:
    """Micro-batches and rows read, lines and errors of the feed, and rows dropped as late, over all batches and restarts of a query."""
    return Progress.of(SparkSession.active()).total(query)
