"""Session settings and the shared folder for cut lineage."""

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(app: str = "alertloom", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings every job here expects; ``conf`` adds or overrides."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.sql.parquet.compression.codec": "lz4_raw",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_DROP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it a query's shuffle files go when the query ends, not when the driver happens to collect garbage; also in streams that
    are started within it. A DataFrame that is used again runs its stages again."""
    before = spark.conf.get(_DROP, None)
    spark.conf.set(_DROP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_DROP) if before is None else spark.conf.set(_DROP, before)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, ``spark.checkpoint.dir``.

    A temporary folder stands in only where none is set and Spark runs in one process.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = getattr(shared_dir, "_local", None)
        if not path:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            path = shared_dir._local = tempfile.mkdtemp(prefix="alertloom-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(os.path.join(path, "checkpoints"))
    return path


def work_path(spark: SparkSession, *parts: str) -> str:
    """A path in the shared folder that belongs to this application alone."""
    return "/".join([shared_dir(spark).rstrip("/"), "alertloom", spark.sparkContext.applicationId, *parts])
