"""Topic sources and sinks with a Kafka and a file back-end.

The Kafka back-end needs Spark's Kafka connector on the classpath. The file back-end keeps a
topic as a folder of JSON-lines files and works everywhere. It writes them as gzip, as brokers keep
batches compressed; files that others put there may be plain.
"""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

# Times keep their microseconds.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
_PACKED = {"compression": "gzip"}


@dataclass(frozen=True)
class Topics:
    """Where topics live: ``kind`` is ``kafka`` (``location`` = brokers) or ``files`` (a folder)."""

    kind: str
    location: str
    options: dict = field(default_factory=dict)

    def __post_init__(self):
        if self.kind not in ("kafka", "files"):
            raise ValueError(f"unknown topic back-end {self.kind!r}")

    def _folder(self, topic: str) -> str:
        return f"{self.location.rstrip('/')}/{topic}"

    def read_stream(self, spark: SparkSession, topic: str, position: bool = False) -> DataFrame:
        """Stream of ``value`` text from the earliest record; the checkpoint keeps offsets. With ``position`` also ``_position``, by which
        records of one key are in the order of the topic: partition and offset, or time and name of the file."""
        if self.kind == "files":
            lines = spark.readStream.options(**self.options).text(self._folder(topic))
            at = F.struct(F.col("_metadata.file_modification_time").alias("time"), F.col("_metadata.file_path").alias("name"),
                          F.lit(None).cast("long").alias("offset"))
            return lines.select("value", at.alias("_position")) if position else lines.select("value")
        at = F.struct(F.lit(None).cast("timestamp").alias("time"), F.col("partition").cast("string").alias("name"), "offset")
        return (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", self.location)
            .option("subscribe", topic)
            .option("startingOffsets", "earliest")
            .options(**self.options)
            .load()
            .select(F.col("value").cast("string").alias("value"), *[at.alias("_position")] * position)
        )

    def read(self, spark: SparkSession, topic: str) -> DataFrame:
        if self.kind == "files":
            return spark.read.text(self._folder(topic))
        return (
            spark.read.format("kafka")
            .option("kafka.bootstrap.servers", self.location)
            .option("subscribe", topic)
            .options(**self.options)
            .load()
            .select(F.col("value").cast("string").alias("value"))
        )

    def write_stream(self, df: DataFrame, topic: str, checkpoint: str, key: str | None = None) -> DataStreamWriter:
        """Writer of ``df`` as JSON messages, keyed by column ``key`` when given."""
        writer = encode(df, key).writeStream.option("checkpointLocation", checkpoint).outputMode("append")
        if self.kind == "files":
            text = encode(df).writeStream.option("checkpointLocation", checkpoint).outputMode("append")
            return text.format("text").options(**_PACKED).option("path", self._folder(topic))
        return (
            writer.format("kafka").option("kafka.bootstrap.servers", self.location)
            .option("kafka.acks", "all").option("topic", topic)
        )

    def write(self, df: DataFrame, topic: str, key: str | None = None) -> None:
        out = encode(df, key)
        if self.kind == "files":
            out.select("value").write.mode("append").options(**_PACKED).text(self._folder(topic))
        else:
            (out.write.format("kafka").option("kafka.bootstrap.servers", self.location)
             .option("kafka.acks", "all").option("topic", topic).save())


def encode(df: DataFrame, key: str | None = None) -> DataFrame:
    """``value`` JSON text, with ``key`` text in front when asked for."""
    value = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), _JSON).alias("value")
    return df.select(value) if key is None else df.select(F.col(key).cast("string").alias("key"), value)
