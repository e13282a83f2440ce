"""The event load as a stream: new files of a landing folder go through the batch operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..config import lookback
from ..plans.ingest import upsert_events
from ..plans.pipeline import build_events
from ..schemas import EVENTS, RAW_SCHEMAS
from ..sources.store import TableStore


def landing_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Stream over the Parquet files that arrive in a folder."""
    reader = spark.readStream.schema(RAW_SCHEMAS[EVENTS])
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def event_sink(store: TableStore, lookback_seconds: int | None = None) -> Callable[[DataFrame, int], None]:
    """foreachBatch function: upsert into raw, then extend the silver events.

    Newest-version-wins needs the stored rows, which a watermarked deduplication cannot see; the upsert has
    them and is idempotent, so a micro-batch that is run again after a failure leaves the same tables.
    """
    reach = lookback(lookback_seconds)

    def load(batch: DataFrame, _batch_id: int) -> None:
        counts = upsert_events(store, batch)
        if counts["source_ids"]:
            build_events(store, lookback_seconds=reach)

    return load


def run_available(
    store: TableStore,
    folder: str,
    checkpoint: str | None = None,
    lookback_seconds: int | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Loads everything that has arrived since the last call, then stops."""
    query = (
        landing_stream(store.spark, folder, max_files)
        .writeStream.foreachBatch(event_sink(store, lookback_seconds))
        .option("checkpointLocation", checkpoint or f"{store.root}/_stream/{EVENTS}")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
