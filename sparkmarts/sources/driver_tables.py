"""Projects the generic test tables (part, orders, events) onto the raw model.

Every table is a narrow projection of one input: ids of CPU and GPU names come from the name itself,
so neither a global numbering nor a join is needed.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from ..schemas import RAW_SCHEMAS

BRAND_ID = "cast(substring(p_brand, 7) as int)"
FIRST_WORD = "substring_index(p_name, ' ', 1)"


def _name_id(name: str) -> str:
    return f"cast(conv(substring(md5({name}), 1, 7), 16, 10) as int)"


def _names(df: DataFrame, name: str, identifier: str) -> DataFrame:
    return df.selectExpr(f"{name} as name").distinct().selectExpr(f"{identifier} as id", "name")


def brand(part: DataFrame) -> DataFrame:
    return _names(part, "p_brand", "cast(substring(name, 7) as int)")


def cpu_model(part: DataFrame) -> DataFrame:
    return _names(part, "p_type", _name_id("name"))


def gpu_model(part: DataFrame) -> DataFrame:
    return _names(part, FIRST_WORD, _name_id("name"))


def laptop_model(part: DataFrame) -> DataFrame:
    return part.selectExpr(
        "p_partkey + 1 as id",
        "concat(' ', replace(p_name, ' ', '  '), ' ') as name",
        f"{BRAND_ID} as brand_id",
        f"if(p_partkey % 17 = 0, null, {_name_id('p_type')}) as cpu_model_id",
        f"if(p_partkey % 19 = 0, null, {_name_id(FIRST_WORD)}) as gpu_model_id",
        "p_size as screen_size",
        "if(p_partkey % 13 = 0, null, p_size % 4 + 1) as laptop_weight",
        "if(p_partkey % 11 = 0, null, p_partkey % 90) as battery_capacity_whr",
        "p_partkey % 10 <> 0 as is_visible",
        "p_partkey % 7 <> 0 as is_active",
    )


def laptop_benchmark_result(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        "o_orderkey as id",
        "if(o_orderkey % 41 = 0, null, o_custkey + 1) as laptop_model_id",
        "floor(o_totalprice / 1000) as office_battery_result_minutes",
        "floor(o_totalprice / 3000) as gaming_battery_result_minutes",
        "o_orderkey % 2500 + 500 as geekbench_6_cpu_single_core_plugged_in",
        "if(o_orderpriority = '4-NOT SPECIFIED', null, floor(o_totalprice / 30)) as geekbench_6_cpu_multi_core_plugged_in",
        "if(o_orderstatus = 'P', null, floor(o_totalprice / 40)) as geekbench_6_cpu_multi_core_battery",
    )


_PAGE = """case when k % 6 = 0 then '"page_name":"Home",' when k % 6 in (1, 2) then '"page_name":"DeviceDetail",'
  when k % 6 = 3 then '"page_name":"DeviceComparison",' when k % 6 = 4 then '"page_name":"CompareDevice",' else '' end"""
_CHART_SORT = """if(event_type = 'error',
  concat('"device_ids":["', event_id % 150 + 1, '","', event_id % 149 + 1, '","', event_id % 150 + 1,
         '"],"sort_by":"', if(k % 3 = 0, ' ', 'performance'), '","sort_direction":"desc",'), '')"""
_KEYWORD = """if(event_type = 'signup',
  concat('"keyword":"', if(k % 20 = 7, ' ', concat(' Key ', k % 20, ' ')), '",'), '')"""
_OWN_DEVICE = "if(k % 10 = 9, '99999999999', cast(event_id % 150 + 1 as string))"
_OS = """case when user_id % 4 = 0 then '"os":"Windows",' when user_id % 4 = 1 then '"os_name":"macOS",'
  when k % 4 = 2 then '"os_name":" ",' when k % 4 = 3 then '"os":"Linux",' else '' end"""


def user_event_tracking(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "event_id", "user_id", "event_type",
        "cast(get_json_object(props, '$.k') as int) as k",
        "unix_micros(cast(ts as timestamp)) / 1e6d as seconds",
    ).selectExpr(
        "event_id as id",
        "if(event_id % 50 = 0, null, concat('s', user_id)) as session_id",
        """case when event_id % 333 = 0 then null when event_type = 'view' then 'pageview'
             when event_type = 'click' then 'click' when event_type = 'purchase' then 'select_device_for_comparison'
             when event_type = 'signup' then 'search_for_device' else 'comparison_chart_sort_selection' end as event_name""",
        "seconds - 10 as event_local_timestamp",
        "seconds as event_received_on_server_timestamp",
        f"""concat('{{', {_PAGE}, {_CHART_SORT}, {_KEYWORD}, '"device_id":"', {_OWN_DEVICE}, '"}}') as event_data""",
        f"""if(user_id % 13 = 5, '{{}}',
             concat('{{', {_OS}, '"device_type":"', if(k % 2 = 0, 'Desktop', 'Mobile'), '"}}')) as device""",
    )


_BUILDERS = {
    "brand": ("part", brand),
    "cpu_model": ("part", cpu_model),
    "gpu_model": ("part", gpu_model),
    "laptop_model": ("part", laptop_model),
    "laptop_benchmark_result": ("orders", laptop_benchmark_result),
    "user_event_tracking": ("events", user_event_tracking),
}


class RawTables(Mapping):
    """The six raw tables over `<sf_dir>/{part,orders,events}.parquet`, typed as declared, opened on demand."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf_dir = spark, sf_dir
        self._inputs: dict[str, DataFrame] = {}

    def _input(self, source: str) -> DataFrame:
        if source not in self._inputs:
            self._inputs[source] = self._spark.read.parquet(f"{self._sf_dir}/{source}.parquet")
        return self._inputs[source]

    def __getitem__(self, table: str) -> DataFrame:
        source, build = _BUILDERS[table]
        typed = (f"cast({f.name} as {f.dataType.simpleString()}) as {f.name}" for f in RAW_SCHEMAS[table].fields)
        return build(self._input(source)).selectExpr(*typed)

    def __contains__(self, table: object) -> bool:
        return table in _BUILDERS

    def __iter__(self) -> Iterator[str]:
        return iter(_BUILDERS)

    def __len__(self) -> int:
        return len(_BUILDERS)
