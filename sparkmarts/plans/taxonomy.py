"""Event and page vocabulary of the clickstream."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import blank_to_null

# Event names, page names and payload keys as the tracker sends them.
PAGEVIEW = "pageview"
CLICK = "click"
SEARCH = "search_for_device"
SELECT_EVENTS = ("select_device_for_comparison", "add_to_comparison")
CHART_SORT = "comparison_chart_sort_selection"
CHART_EVENTS = (CHART_SORT, "comparison_chart_geekbench_version_selection")
DETAIL_PAGE = "DeviceDetail"
COMPARE_PAGE = "CompareDevice"
COMPARE_PAGE_ALIASES = ("DeviceComparisonHome", "DeviceComparison", COMPARE_PAGE)
EVENT_DATA_KEYS = ("device_id", "page_name", "keyword", "sort_by", "sort_direction", "device_ids")
DEVICE_KEYS = ("os", "os_name", "os_version", "browser", "device_type")
UNKNOWN = "Unknown"


# The tests below keep SQL's three-valued logic: a NULL page makes the flag NULL, not false.
def is_pageview() -> Column:
    return F.col("event_name") == PAGEVIEW


def on_page(page: str) -> Column:
    return F.col("page_name") == page


def is_detail_view() -> Column:
    return is_pageview() & on_page(DETAIL_PAGE)


def is_compare_view() -> Column:
    return is_pageview() & on_page(COMPARE_PAGE)


def is_selection() -> Column:
    return F.col("event_name").isin(*SELECT_EVENTS) | ((F.col("event_name") == CLICK) & on_page(DETAIL_PAGE))


def is_sort_action() -> Column:
    acted = (F.col("event_name") == CHART_SORT) | ((F.col("event_name") == CLICK) & on_page(COMPARE_PAGE))
    return acted & blank_to_null(F.col("sort_by")).isNotNull()
