"""Session settings the operators rely on."""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Business dates are taken from UTC instants, so the session zone has to be UTC.
REQUIRED_CONF = {"spark.sql.session.timeZone": "UTC"}

# Partition counts and memory belong to the cluster; these only let Spark re-plan at run time.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}


def local_session(cpus: int | str = "*", app: str = "sparkmarts", **conf: str) -> SparkSession:
    """Session for tests and the bench; on a cluster pass the cluster's own session around."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    settings = {
        **REQUIRED_CONF,
        **ENGINE_CONF,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8",
        # Call-site capture costs several driver round trips per Column.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.driver.memory": "8g",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> None:
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)


BROADCAST, MEASURED_BROADCAST = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"


@contextmanager
def measured_broadcasts(spark: SparkSession) -> Iterator[None]:
    """Joins broadcast a side only once its rows are there and measured, up to the session's threshold.

    Before that Spark knows no more than the size of compressed files: millions of keys take a few megabytes there
    and pass the threshold, but go to the driver and to every executor at 40 bytes and more each. Without adaptive
    execution, or where the session's owner has set both thresholds, all stays as it is.
    """
    before, limit = spark.conf.get(BROADCAST), spark.conf.get(MEASURED_BROADCAST, None)
    if spark.conf.get("spark.sql.adaptive.enabled") != "true" or limit is not None or before.startswith("-"):
        yield
        return
    spark.conf.set(MEASURED_BROADCAST, before)
    spark.conf.set(BROADCAST, "-1")
    try:
        yield
    finally:
        spark.conf.set(BROADCAST, before)
        spark.conf.unset(MEASURED_BROADCAST)


def in_threads(spark: SparkSession, threads: int, jobs) -> list:
    """Runs independent Spark jobs from a few driver threads, so that small ones do not wait for large ones."""
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=threads) as pool:
        return [done.result() for done in [pool.submit(inherit(job)) for job in jobs]]
