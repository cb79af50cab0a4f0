"""Small column builders used across jobs."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def _literal(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def lookup(mapping: Mapping, key: Column, default=None) -> Column:
    """Value of ``key`` in a small fixed table, ``default`` where it is absent or null."""
    pairs = ", ".join(f"{_literal(k)}, {_literal(v)}" for k, v in mapping.items())
    value = F.try_element_at(F.expr(f"map({pairs})"), key)
    return value if default is None else F.coalesce(value, F.lit(default))


def iso_timestamp(text: Column) -> Column:
    """ISO-8601 text to TIMESTAMP, null when it does not parse."""
    return F.try_to_timestamp(text)


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def once(value: Column) -> Column:
    """``value`` as a generator of one row. Filters on it are not pushed below the generator,
    so a costly expression is computed once instead of in every filter and projection."""
    return F.explode(F.array(value))


def percent(value: Column) -> Column:
    """``0.4567`` as ``45.7%``; a dash for null."""
    return F.when(value.isNull(), F.lit("—")).otherwise(F.format_string("%.1f%%", value * 100))


def literal_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A small fixed table as literals, so Catalyst knows its size."""
    fields = schema.fields
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
