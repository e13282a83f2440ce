"""A small catalog and clickstream around one instant that begins both a day and a month in the business zone."""

from __future__ import annotations

import json
from datetime import datetime
from decimal import Decimal

from sparkmarts.schemas import RAW_SCHEMAS

FIRST_OF_MARCH = datetime.fromisoformat("2025-03-01T00:00:00+07:00").timestamp()
PHONE = json.dumps({"os": "Plan 9", "device_type": "Mobile"})
DESK = json.dumps({"os_name": "Haiku", "device_type": "Desktop"})


def event(id, session, name, ts, device=DESK, local=None, **payload):
    sent = float(ts - 3 if local is None else local)
    return (id, session, name, sent, float(ts), json.dumps({k: v for k, v in payload.items() if v is not None}), device)


def page(id, session, page_name, ts, device_id=None, **more):
    return event(id, session, "pageview", ts, page_name=page_name, device_id=device_id, **more)


def clickstream():
    """Thirteen events and a replay; id 11 has no session, id 9 no keyword, id 6 repeats a device and names none."""
    at = FIRST_OF_MARCH
    seen = page(7, "beta", "DeviceDetail", at + 3700, "21", device=PHONE)
    return [
        page(1, "alpha", "Home", at - 30),
        page(2, "alpha", "DeviceDetail", at - 20, "11"),
        page(3, "alpha", "DeviceDetail", at + 10, "12"),
        page(4, "alpha", "CompareDevice", at + 20, "12"),
        event(5, "alpha", "select_device_for_comparison", at + 30, device_id="21"),
        event(6, "beta", "comparison_chart_sort_selection", at + 3600, PHONE, device_ids=["21", "11", "21", "x"], sort_by="price"),
        seen,
        event(8, "beta", "search_for_device", at + 3800, PHONE, keyword="  Thin {14} "),
        event(9, "gamma", "search_for_device", at + 4000, keyword=" "),
        page(10, "gamma", "DeviceDetail", at + 4100, "00012"),
        page(11, None, "Home", at + 4200),
        seen,
        event(12, "delta", "click", at + 2 * 86_400),
        page(13, "gamma", "DeviceComparison", at + 4300.25, "2147483648"),
    ]


def catalog():
    def laptop(id, name, brand, part, inches, kilos, watt_hours):
        return (id, name, brand, part, part, Decimal(inches), Decimal(kilos), Decimal(watt_hours), True, True)

    return {
        "brand": [(10, "Cedar"), (20, "Dune"), (30, "Ember")],
        "cpu_model": [(1, "Quark 5"), (2, "Quark 9")],
        "gpu_model": [(1, "Prism"), (2, "Volt")],
        "laptop_model": [
            laptop(11, "Cedar One", 10, 1, 13, "1.25", 50),
            laptop(12, "Cedar Two {15}", 10, 2, 15, "2", 80),
            laptop(21, "Dune Lite", 20, 1, 13, "1.25", 50),
        ],
        "laptop_benchmark_result": [
            (1, 11, Decimal(300), Decimal(60), 1100, 4000, 3600),
            (2, 12, Decimal(450), Decimal(75), 2100, 9000, 4500),
            (3, 12, Decimal(420), Decimal(80), 2000, 9500, 5000),
            (4, 21, None, None, None, None, None),
        ],
    }


def frame(spark, table, rows):
    return spark.createDataFrame(rows, RAW_SCHEMAS[table])


def raw_frames(spark, events=None):
    tables = {**catalog(), "user_event_tracking": clickstream() if events is None else events}
    return {name: frame(spark, name, rows) for name, rows in tables.items()}
