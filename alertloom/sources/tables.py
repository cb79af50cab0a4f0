"""Tables besides the alert feed: asset dimension, run log, attack matrix, retention."""

import datetime
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from alertloom.constants import ASSETS, RETENTION_DAYS
from alertloom.functions.columns import iso_timestamp, literal_table
from alertloom.sources import files
from alertloom.schemas import ASSET, ATTACK_MATRIX, LABELLED, RUN_LOG


def seed_assets(spark: SparkSession) -> DataFrame:
    return literal_table(spark, ASSETS, ASSET)


def insert_missing(new: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """``existing`` plus the rows of ``new`` whose key it lacks; loading twice adds nothing.

    A key given twice in ``new`` is inserted once.
    """
    columns = existing.columns
    fresh = (
        new.withColumn("criticality", F.coalesce("criticality", F.lit(1)))
        if "criticality" in columns else new
    )
    once = fresh.groupBy(key).agg(F.min(F.struct(*columns)).alias("r")).select("r.*")
    return existing.unionByName(once.join(existing.select(key), key, "left_anti").select(*columns))


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """Run windows of header CSV files; ``run_idx`` is the order of the files' names and of the lines, the tie-break of labelling.

    A quoted field may hold line breaks, so a file is read by one task, whose rows are numbered in the order of its lines.
    """
    text = spark.read.schema(RUN_LOG).option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    lines = text.withColumn("_file", F.input_file_name()).withColumn("_line", F.monotonically_increasing_id())
    first = lines.groupBy("_file").agg(F.min("_line").alias("_first"), F.count("*").alias("_n"))  # one row a file
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = first.select("_file", "_first", before.alias("_before"))
    return lines.join(first, "_file").withColumn(
        "run_idx", F.col("_before") + F.col("_line") - F.col("_first")).drop("_file", "_line", "_first", "_before")


def read_attack_matrix(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ATTACK_MATRIX).option("header", True).option("escape", '"').csv(path)


def run_windows(runs: DataFrame, pad_seconds: float = 5) -> DataFrame:
    """Padded windows and run ids of a run log."""
    pad = F.expr(f"make_dt_interval(0, 0, 0, {float(pad_seconds):.6f})")
    return runs.select(
        "run_idx", "scenario_id",
        F.concat_ws("__", "scenario_id", "start_time_utc").alias("run_id"),
        "attack_class", "target",
        (iso_timestamp(F.col("start_time_utc")) - pad).alias("start_ts"),
        (iso_timestamp(F.col("end_time_utc")) + pad).alias("end_ts"),
    )


def retain(df: DataFrame, dataset: str, ts: Column, as_of: Column) -> DataFrame:
    """Rows of a dataset still within its retention at ``as_of``; of a dated table, only the days that may hold some are read."""
    bound = as_of - F.expr(f"INTERVAL {RETENTION_DAYS[dataset]} DAYS")
    kept = df.filter(ts >= bound)
    return kept.filter(F.col("dt") >= F.to_date(bound)) if "dt" in df.columns else kept


def expire(spark: SparkSession, path: str, dataset: str, as_of: datetime.date) -> list[datetime.date]:
    """Delete the days of a dated table that are wholly beyond the dataset's retention; the days deleted.

    The folder is listed through the file system that Spark reads it with. A table holds a folder a day, so the list is short.
    """
    bound = as_of - datetime.timedelta(days=RETENTION_DAYS[dataset])
    days = [n.removeprefix("dt=") for n in files.folders(spark, path) if re.fullmatch(r"dt=\d{4}-\d\d-\d\d", n)]
    gone = [d for d in map(datetime.date.fromisoformat, days) if d < bound]
    return [d for d in gone if files.delete(spark, f"{path}/dt={d}")]


def write_dated(df: DataFrame, path: str, ts: str, codec: str = "lz4_raw") -> None:
    """Append to a table partitioned by day, so that retention and time filters prune files."""
    (df.withColumn("dt", F.to_date(F.col(ts)))
     .write.mode("append").option("compression", codec).partitionBy("dt").parquet(path))


def write_labelled(df: DataFrame, path: str) -> bool:
    """Header CSV of labelled alerts; nothing is written for an empty set."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").option("header", True).csv(path)
    return True


def read_labelled(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LABELLED).option("header", True).csv(path)
