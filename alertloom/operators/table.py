"""An incidents table that lasts: days of Parquet that upserts and analyst edits rewrite.

A change reads the days it touches, joins the batch to them, stages the result beside the table and replaces these days by Spark's dynamic
partition overwrite; other days are not read beyond their ids and not written. A change that was interrupted after staging is finished by
the next one, so no row of a touched day is lost; until then readers may miss such a day. A batch applied again gives the same table. One
change at a time: the stream and the analysts' edits must take turns, and readers should not run while days are being replaced.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from alertloom.functions.sizing import broadcast_if_small
from alertloom.operators.analytics import EDITABLE, apply_edits
from alertloom.operators.postings import has_postings, write_postings
from alertloom.operators.store import (
    PASSING, by_repeats, fold_upserts, incident_row_schema, of_days, on_days, save_days, upsert,
)
from alertloom.sources import files

_DAY = "created_date"
#: Days are replaced together up to so many rows, which bounds what their shuffle takes on disk; a day is not divided.
TOGETHER = 4 << 20


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows with their day; none where there is no table yet, and the planner is told so: no join with it shuffles anything."""
    schema = incident_row_schema().add(_DAY, "date")
    return spark.read.schema(schema).parquet(path) if files.exists(spark, path) else spark.createDataFrame([], schema).filter(F.lit(False))


def _finish(spark: SparkSession, path: str) -> None:
    """Put the staged days in place, if any are staged whole, and their postings if the table has any."""
    staged = f"{path}_staged"
    if files.exists(spark, f"{staged}/_SUCCESS"):
        days = spark.read.schema(incident_row_schema().add(_DAY, "date")).parquet(staged)
        for together in _together(days):
            save_days(of_days(days, together), path, replace_days=True)
        if has_postings(spark, path):
            write_postings(on_days(read_table(spark, path), days), path, replace_days=True)
        files.delete(spark, staged)


def _together(rows: DataFrame) -> list[list[str | None]]:
    """The days of the rows, in groups of up to ``TOGETHER`` rows or of one day. There are no more days than the calendar has."""
    groups, size = [], 0
    for day, n in rows.groupBy(F.date_format(_DAY, "yyyy-MM-dd").alias("day")).count().orderBy("day").collect():
        if not groups or size + n > TOGETHER:
            groups.append([])
            size = 0
        groups[-1].append(day)
        size += n
    return groups


def _replace(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").partitionBy(_DAY).options(**PASSING).option("partitionOverwriteMode", "static").parquet(f"{path}_staged")
    files.delete(rows.sparkSession, f"{path}_incoming")
    _finish(rows.sparkSession, path)


def _incoming(batch: DataFrame, path: str) -> DataFrame:
    """The batch, written once: it is read three times, and a file's size decides about broadcasts."""
    batch.write.mode("overwrite").options(**PASSING).parquet(f"{path}_incoming")
    return batch.sparkSession.read.schema(batch.schema).parquet(f"{path}_incoming")


def _days_of(table: DataFrame, ids: DataFrame) -> DataFrame:
    """Id and day of the rows with these ids: a scan of two columns."""
    return table.select("id", _DAY).join(broadcast_if_small(ids), "id", "left_semi")


def upsert_rows(path: str, rows: DataFrame, landed: bool = False) -> None:
    """Upsert rows, with ``_seq``, their place in the source, if ids repeat. A known id keeps its first row's day and fixed columns.
    Of rows that are read from files (``landed``) only ids that repeat are shuffled to be folded."""
    spark = rows.sparkSession
    names = incident_row_schema().names
    place = F.col("_seq") if "_seq" in rows.columns else F.struct("updated_at", F.xxhash64(F.to_json(F.struct(*names))))
    _finish(spark, path)
    table = read_table(spark, path)
    rows = rows.select(*names, place.alias("_order"))

    def fold(some: DataFrame) -> DataFrame:
        return fold_upserts(some, F.col("_order"))

    batch = _incoming(by_repeats(rows, "id", f"{path}_again", lambda one: one.drop("_order"), fold) if landed else fold(rows), path)
    files.delete(spark, f"{path}_again")
    known = _days_of(table, batch.select("id"))
    days = batch.select("id", F.to_date("created_at").alias("_own")).join(known.withColumn("_known", F.lit(True)), "id", "left")
    touched = days.select(F.when(F.col("_known"), F.col(_DAY)).otherwise(F.col("_own")).alias(_DAY))
    merged = upsert(on_days(table, touched).drop(_DAY), batch)
    _replace(merged.withColumn(_DAY, F.to_date("created_at")), path)


def edit_rows(path: str, edits: DataFrame, as_of: Column) -> None:
    """Apply edits (id, any of the editable columns, and ``_seq`` if their order matters); null leaves a value as it is. Edits of ids
    that the table lacks change nothing."""
    spark = edits.sparkSession
    given = [c for c in EDITABLE if c in edits.columns]
    place = F.col("_seq") if "_seq" in edits.columns else F.struct(*given)
    _finish(spark, path)
    table = read_table(spark, path)
    batch = _incoming(edits.select("id", *given, place.alias("_seq")), path)
    days = _days_of(table, batch.select("id"))
    _replace(apply_edits(on_days(table, days), batch, as_of, F.col("_seq")), path)
