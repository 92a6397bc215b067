"""JSON objects stored as text: rows per key, and lookups between two objects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import col


def json_map(c: Column | str) -> Column:
    """Object as a string map, so one malformed value cannot void the others."""
    return F.from_json(col(c), "map<string,string>")


def json_number(map_column: Column | str, key: Column | str) -> Column:
    return F.try_element_at(col(map_column), col(key)).try_cast("double")


def explode_rates(df: DataFrame, json_column: str, key: str, value: str) -> DataFrame:
    """A row per object key (one with NULLs for an empty or missing object), value as double."""
    exploded = df.select("*", F.explode_outer(json_map(json_column)).alias(key, "__text"))
    return exploded.withColumn(value, F.col("__text").try_cast("double")).drop("__text")


def lookup_rates(df: DataFrame, json_column: str, key: str, value: str) -> DataFrame:
    """Left join of another object of the same row on the key: a map lookup, so no shuffle."""
    return df.withColumn(value, json_number(json_map(json_column), key))
