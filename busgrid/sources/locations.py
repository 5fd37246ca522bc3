"""Stop coordinates: header-less (number, x, y) or (name, x, y)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_locations(spark: SparkSession, path: str, by_number: bool = False) -> DataFrame:
    key = "stop_number int" if by_number else "stop_name string"
    return spark.read.schema(f"{key}, x double, y double").option("escape", '"').csv(path)
