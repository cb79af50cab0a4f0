"""Size checks that decide between a broadcast and a shuffle."""

from pyspark.sql import DataFrame, functions as F

BROADCAST_BYTES = 64 << 20


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate; it runs no job and is very large where the size is unknown."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only for a side whose estimated size is within ``limit``.

    Beyond it the plain frame is returned: Spark then shuffles both sides and adaptive
    execution splits skewed partitions.
    """
    return F.broadcast(df) if estimated_bytes(df) <= limit else df
