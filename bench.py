"""Times the headline queries and one pipeline run; prints one JSON line.

    BENCH_SF_DIR  directory of the test tables (default /root/testdata/sf0.1)
    BENCH_CPUS    local cores (default 8)
    BENCH_RUNS    timed runs per query after one warm-up; the median is reported (default 3)
    BENCH_COPIES  how many times the pipeline stages take the events, with ids and sessions of their own (default 8:
                  800,000 events at sf0.1)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sparkmarts import query_catalog  # noqa: E402
from sparkmarts.plans import pipeline, reconcile  # noqa: E402
from sparkmarts.schemas import EVENTS, GOLD_NAMES, RAW_SCHEMAS  # noqa: E402
from sparkmarts.session import local_session  # noqa: E402
from sparkmarts.plans.ingest import run_ingest  # noqa: E402
from sparkmarts.sources.driver_tables import RawTables  # noqa: E402
from sparkmarts.sources.scan import FrameSource  # noqa: E402
from sparkmarts.sources.store import TableStore  # noqa: E402

HEADLINE = (
    "silver_user_event_tracking", "silver_session_activity", "silver_comparison_event_device", *GOLD_NAMES,
    "batch_latest", "upsert_versions", "upsert_counts", "silver_incremental", "dq_raw_to_silver", "dq_gold_totals",
    "reconcile_report", "serve_summarize_daily", "top_brands", "serve_catalog_all",
)


def seconds(run) -> float:
    started = time.perf_counter()
    run()
    return time.perf_counter() - started


def say(name: str, times: dict[str, float]) -> None:
    """Each figure as soon as it is known; standard output has the JSON line alone."""
    print(f"{name}: {times[name]} s", file=sys.stderr, flush=True)


def multiplied(events: DataFrame, copies: int) -> DataFrame:
    """The events several times, as different events of different sessions."""
    each = events.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(copies - 1).cast("bigint"))))
    return each.withColumns(
        {
            "id": (F.col("id") + F.col("copy") * F.lit(10**9)).cast(events.schema["id"].dataType),
            "session_id": F.concat("session_id", F.lit("-"), "copy"),
        }
    ).drop("copy")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, app="sparkmarts-bench")
    spark.sparkContext.setLogLevel("ERROR")
    registered = query_catalog.queries()

    # A noop write computes every row and column without moving the result to the driver.
    def execute(name: str) -> None:
        registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times = {}
    for name in HEADLINE:
        execute(name)
        times[name] = round(statistics.median(seconds(lambda: execute(name)) for _ in range(runs)), 4)
        say(name, times)

    # The stages of a scheduled run, on a store of their own.
    store = query_catalog.scratch_store(spark)
    raw = RawTables(spark, sf_dir)
    copies = int(os.environ.get("BENCH_COPIES", "8"))
    tables = {name: raw[name] for name in RAW_SCHEMAS}
    with store.stage(multiplied(tables[EVENTS], copies)) as events:
        run_stages(store, FrameSource({**tables, EVENTS: events}), times)

    print(
        json.dumps(
            {
                "metric": "headline queries and pipeline stages, sum of seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "events": store.read(EVENTS).count(),
                "cpus": cpus,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


def run_stages(store: TableStore, source: FrameSource, times: dict[str, float]) -> None:
    """One scheduled chain: everything once, then a run that finds little new."""
    stages = {
        "pipeline_first_ingest": lambda: run_ingest(store, source, lookback_seconds=7200),
        "pipeline_full_build": lambda: pipeline.build(store, full_refresh=True),
        "pipeline_incremental_ingest": lambda: run_ingest(store, source, lookback_seconds=7200),
        "pipeline_incremental_build": lambda: pipeline.build(store, lookback_seconds=7200),
        "pipeline_reconcile": lambda: reconcile.reconcile(
            pipeline.Marts(pipeline.StoredTables(store)), pipeline.inventory(store)
        ),
    }
    for name, stage in stages.items():
        times[name] = round(seconds(stage), 4)
        say(name, times)


if __name__ == "__main__":
    main()
