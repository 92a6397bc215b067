"""Layered Parquet warehouse: replace and append writes, lookups, census."""

from __future__ import annotations

import threading
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.aggregates import labelled_counts
from tidemark.sources.export_dirs import path_exists
from tidemark.sources.swap import write_then_switch

# The layers of the warehouse, in build order.
LAYERS = ("raw", "bronze", "silver", "gold", "main")

# Whether a table is there, and its schema, must not be asked while another thread makes it.
_APPENDING = threading.Lock()


def _writer(df: DataFrame) -> DataFrameWriter:
    return df.write.option("compression", "zstd")


@dataclass(frozen=True)
class Warehouse:
    """Tables as Parquet directories ``root/layer/table``, packed with Zstandard."""

    spark: SparkSession
    root: str

    def path(self, layer: str, table: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def exists(self, layer: str, table: str) -> bool:
        return path_exists(self.spark, self.path(layer, table))

    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(layer, table))

    def replace(self, df: DataFrame, layer: str, table: str) -> DataFrame:
        """Put a new table in the place of an old one, which stays until the new one is written."""
        write_then_switch(self.spark, self.path(layer, table), _writer(df).parquet)
        self.spark.catalog.refreshByPath(self.path(layer, table))
        return self.read(layer, table)

    def append(self, df: DataFrame, layer: str, table: str, load: str | None = None) -> DataFrame:
        """Add rows, creating the table first if needed; new rows take the stored column order and types.

        With the name of a ``load`` the rows become the partition ``load_id`` of
        that name, in the place of whatever an earlier attempt of the same load
        left, so a load can be run again. A load without rows leaves an empty
        partition. A table is appended to either by loads or without them.
        """
        if load is not None and (not load.strip() or "load_id" in df.columns):
            raise ValueError("a load needs a name, and load_id is its column")
        with _APPENDING:
            if self.exists(layer, table):
                stored = self.read(layer, table).schema
                if ("load_id" in stored.fieldNames()) != (load is not None):
                    raise ValueError(f"{layer}.{table} is appended to {'with' if load is None else 'without'} the name of a load")
                stored = T.StructType([f for f in stored.fields if f.name != "load_id" or load is None])
                unknown = [name for name in df.columns if name not in stored.fieldNames()]
                if unknown:
                    raise ValueError(f"columns not in {layer}.{table}: {unknown}")
                df = df.select(
                    *[
                        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                        for f in stored.fields
                    ]
                )
            path = self.path(layer, table)
            if load is None:
                _writer(df).mode("append").parquet(path)
            else:
                # The word in front keeps Spark from reading the name of a partition as a number or a date.
                write_then_switch(self.spark, f"{path}/load_id=load-{quote(load, safe='')}", _writer(df).parquet)
                self.spark.catalog.refreshByPath(path)
            return self.read(layer, table)

    def missing(self, tables: Sequence[tuple[str, str]]) -> list[str]:
        return sorted(f"{layer}.{table}" for layer, table in tables if not self.exists(layer, table))

    def require(self, tables: Sequence[tuple[str, str]]) -> None:
        absent = self.missing(tables)
        if absent:
            raise LookupError("missing tables: " + ", ".join(absent))

    def tables(self) -> list[tuple[str, str]]:
        """(layer, table) of everything stored, from directory listings."""
        found = []
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        for layer in LAYERS:
            folder = f"{self.root.rstrip('/')}/{layer}"
            if path_exists(self.spark, folder):
                at = jvm.org.apache.hadoop.fs.Path(folder)
                entries = at.getFileSystem(conf).listStatus(at)
                found += sorted((layer, s.getPath().getName()) for s in entries if s.isDirectory() and s.getPath().getName()[0] not in "_.")
        return found


def census(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count, column_count, column_names); no column is read to count the rows."""
    counted = labelled_counts(tables, "table_name", "row_count")
    names = {name: ", ".join(df.columns) for name, df in tables.items()}
    described = F.create_map(*[F.lit(x) for name, listed in names.items() for x in (name, listed)])
    listed = F.element_at(described, F.col("table_name"))
    return counted.select(
        "table_name", "row_count", F.size(F.split(listed, ", ")).cast("long").alias("column_count"), listed.alias("column_names")
    )


def warehouse_census(warehouse: Warehouse) -> DataFrame:
    return census({f"{layer}.{table}": warehouse.read(layer, table) for layer, table in warehouse.tables()})


def preview(df: DataFrame, order: Sequence[str], rows: int = 10) -> DataFrame:
    """First rows in a stated order, each with the table's total."""
    total = df.agg(F.count(F.lit(1)).alias("total_rows"))
    return df.orderBy(*order).limit(rows).select("*", total.scalar().alias("total_rows"))
