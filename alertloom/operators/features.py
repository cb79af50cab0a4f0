"""Model features of incidents and the synthetic training set."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from alertloom.constants import (
    FEATURES, ROLE_FEATURE, RULE_FEATURE, SEVERITY_FEATURE, TRAINING_PATTERNS, TRAINING_WINDOWS,
)
from alertloom.functions.columns import literal_table, lookup


def features(incidents: DataFrame) -> DataFrame:
    """The nine numeric features of each incident, added as columns named ``f_…``."""
    asset = F.col("triggering_alert.asset")
    criticality = F.coalesce(asset["criticality"], F.lit(1))
    source = F.coalesce("triggering_alert.source.ip", F.lit("unknown"))
    values = [
        lookup(RULE_FEATURE, F.col("correlation_rule.id"), 0),
        lookup(SEVERITY_FEATURE, F.coalesce("severity", F.lit("medium")), 2),
        F.coalesce("event_count", F.lit(1)),
        F.coalesce("correlation_rule.window_sec", F.lit(60)),
        F.coalesce("correlation_rule.threshold", F.lit(5)),
        F.when(criticality == 0, 1).otherwise(criticality),
        lookup(ROLE_FEATURE, asset["role"], 0),
        F.when(source.startswith("192.168."), 1).otherwise(0),
        F.coalesce(F.hour(F.col("`@timestamp`").try_cast("timestamp")), F.lit(12)),
    ]
    return incidents.select("*", *[v.cast("int").alias(f"f_{n}") for n, v in zip(FEATURES, values)])


def _uniform(low: Column, high: Column, seed: int) -> Column:
    """An integer in [low, high) fixed by pattern and row, whatever the partitioning."""
    return (low + F.pmod(F.xxhash64("pattern", "i", F.lit(seed)), high - low)).cast("int")


def training_set(spark: SparkSession, n: int = 2000, seed: int = 42) -> DataFrame:
    """Labelled synthetic incidents, ``n // patterns`` rows per pattern."""
    per_pattern = n // len(TRAINING_PATTERNS)
    schema = T.StructType([
        T.StructField("pattern", T.IntegerType()), T.StructField("label", T.StringType()),
        T.StructField("rule", T.IntegerType())] + [
        T.StructField(f"{name}_{end}", T.IntegerType())
        for name in ("sev", "cnt", "crit", "role") for end in ("lo", "hi")] + [
        T.StructField("internal", T.DoubleType())])
    patterns = literal_table(spark, [
        (i, label, rule, *sev, *cnt, *crit, *role, internal)
        for i, (label, rule, sev, cnt, crit, role, internal) in enumerate(TRAINING_PATTERNS)], schema)
    rows = patterns.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(per_pattern - 1))))

    def draw(low, high, offset: int) -> Column:
        low = F.col(low) if isinstance(low, str) else F.lit(low)
        high = F.col(high) if isinstance(high, str) else F.lit(high)
        return _uniform(low, high, seed * 100 + offset)

    severity = draw("sev_lo", "sev_hi", 1) + draw(-1, 2, 2)
    count = draw("cnt_lo", "cnt_hi", 3) + draw(-2, 5, 4)
    window = F.element_at(F.array(*[F.lit(w) for w in TRAINING_WINDOWS]), draw(1, len(TRAINING_WINDOWS) + 1, 5))
    values = [
        F.col("rule"),
        F.least(F.lit(4), F.greatest(F.lit(0), severity)),
        F.greatest(F.lit(1), count),
        window,
        draw(1, 21, 6),
        draw("crit_lo", "crit_hi", 7),
        draw("role_lo", "role_hi", 8),
        F.when(draw(0, 1_000_000, 9) < F.col("internal") * 1_000_000, 1).otherwise(0),
        draw(0, 24, 10),
    ]
    return rows.select("label", *[v.cast("int").alias(f"f_{n}") for n, v in zip(FEATURES, values)])
