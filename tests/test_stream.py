"""The streamed load leaves the same tables as the batch load."""

from fixture_data import clickstream, frame, page

from sparkmarts.plans import ingest, pipeline
from sparkmarts.plans.pipeline import SILVER_EVENTS
from sparkmarts.schemas import EVENT_TS, EVENTS
from sparkmarts.sources.store import TableStore
from sparkmarts.streaming.ingest_stream import event_sink, run_available


def contents(store, name):
    df = store.read(name)
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_stream_equals_batch_and_replays_are_harmless(spark, store, tmp_path):
    landing = str(tmp_path / "landing")
    rows = clickstream()
    last = rows[-1]
    batches = [rows[:6], rows[4:], [page(last[0], last[1], "DeviceDetail", last[4] + 5, "11")]]
    for part in batches[:2]:
        frame(spark, EVENTS, part).coalesce(1).write.mode("append").parquet(landing)
    run_available(store, landing, lookback_seconds=10**9, max_files=1)
    frame(spark, EVENTS, batches[2]).coalesce(1).write.mode("append").parquet(landing)
    run_available(store, landing, lookback_seconds=10**9)

    other = TableStore(spark, str(tmp_path / "batch"))
    ingest.upsert_events(other, frame(spark, EVENTS, [row for part in batches for row in part]))
    pipeline.build_events(other, full_refresh=True)
    for name in (EVENTS, SILVER_EVENTS):
        assert contents(store, name) == contents(other, name)
    assert store.read(EVENTS).filter(f"id = {last[0]}").first()[EVENT_TS] == last[4] + 5

    load = event_sink(store, 10**9)
    load(frame(spark, EVENTS, batches[0]), 7)  # a micro-batch that is run again
    load(frame(spark, EVENTS, []), 8)
    for name in (EVENTS, SILVER_EVENTS):
        assert contents(store, name) == contents(other, name)
