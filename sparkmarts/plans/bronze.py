"""Bronze: every raw table passed through unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .registry import relation


@relation
def bronze_brand(brand: DataFrame) -> DataFrame:
    return brand.select("*")


@relation
def bronze_cpu_model(cpu_model: DataFrame) -> DataFrame:
    return cpu_model.select("*")


@relation
def bronze_gpu_model(gpu_model: DataFrame) -> DataFrame:
    return gpu_model.select("*")


@relation
def bronze_laptop_model(laptop_model: DataFrame) -> DataFrame:
    return laptop_model.select("*")


@relation
def bronze_laptop_benchmark_result(laptop_benchmark_result: DataFrame) -> DataFrame:
    return laptop_benchmark_result.select("*")


@relation
def bronze_user_event_tracking(user_event_tracking: DataFrame) -> DataFrame:
    return user_event_tracking.select("*")
