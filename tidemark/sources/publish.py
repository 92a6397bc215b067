"""BI exports: files per declared table, a manifest, and checks of what was published."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.export_dirs import path_exists
from tidemark.sources.swap import side_by_side, write_then_switch

FORMATS = {"csv": ("csv",), "parquet": ("parquet",), "both": ("csv", "parquet")}


@dataclass(frozen=True)
class ExportSpec:
    """A published table: its source, the columns in order and the row order."""

    name: str
    source: str
    columns: tuple[str, ...]
    order: tuple[str, ...] = ()
    description: str = ""
    date_columns: tuple[str, ...] = ()

    def shape(self, df: DataFrame) -> DataFrame:
        shaped = df.select(
            *[F.col(c).cast("date").alias(c) if c in self.date_columns else F.col(c) for c in self.columns]
        )
        return in_order(shaped, self.order)


def in_order(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows sorted by columns, those with a leading ``-`` descending, NULLs last."""
    keys = [F.desc_nulls_last(k[1:]) if k.startswith("-") else F.asc_nulls_last(k) for k in order]
    return df.orderBy(*keys) if keys else df


#: Some spreadsheet and BI programs tell UTF-8 by this mark.
MARK = "\ufeff"


def write_export(
    df: DataFrame, directory: str, name: str, kind: str = "both", order: Sequence[str] = (), marked: bool = False
) -> list[str]:
    """Write one table as CSV and/or Parquet, in place of older files once it is written.

    ``marked`` CSV files begin with a byte-order mark.

    For both, the Parquet copy is written first and the CSV is made from it, so
    the plan behind the table runs once; the CSV is sorted again, because a
    reader takes Parquet files by size.
    """
    spark = df.sparkSession
    written = []
    base = f"{directory.rstrip('/')}/{name}"
    formats = FORMATS[kind]
    if "parquet" in formats:
        write_then_switch(spark, f"{base}.parquet", df.write.parquet)
        spark.catalog.refreshByPath(f"{base}.parquet")
        df = in_order(spark.read.parquet(f"{base}.parquet"), order)
    if "csv" in formats:
        if marked:
            df = df.toDF(MARK + df.columns[0], *df.columns[1:])  # the header line is what a file begins with
        write_then_switch(spark, f"{base}.csv", df.write.option("header", True).option("escape", '"').csv)
        written.append(f"{base}.csv")
    if "parquet" in formats:
        written.append(f"{base}.parquet")
    return written


def read_export(spark: SparkSession, directory: str, name: str, kind: str) -> DataFrame:
    path = f"{directory.rstrip('/')}/{name}.{kind}"
    if kind == "parquet":
        return spark.read.parquet(path)
    df = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    return df.toDF(*[name.removeprefix(MARK) for name in df.columns])


def manifest(exports: Mapping[str, tuple[str, str, DataFrame, Sequence[str]]]) -> DataFrame:
    """Sorted manifest of {name: (source, description, stored table, files)}."""
    rows = [
        df.agg(
            F.lit(name).alias("output_name"),
            F.lit(source).alias("source_table"),
            F.count(F.lit(1)).alias("row_count"),
            F.lit(len(df.columns)).cast("long").alias("column_count"),
            F.lit(description).alias("description"),
            F.lit(json.dumps(list(files), ensure_ascii=False)).alias("files"),
        )
        for name, (source, description, df, files) in exports.items()
    ]
    return reduce(DataFrame.unionByName, rows).orderBy("output_name")


def write_summary(spark: SparkSession, specs: Sequence[ExportSpec], directory: str, kind: str) -> DataFrame:
    """(output_name, source_table, row_count, columns, output_path, description) of published files, also written as JSON beside them."""
    rows = []
    for spec in specs:
        stored = read_export(spark, directory, spec.name, kind)
        rows.append(
            stored.agg(
                F.lit(spec.name).alias("output_name"),
                F.lit(spec.source).alias("source_table"),
                F.count(F.lit(1)).alias("row_count"),
                F.array(*map(F.lit, stored.columns)).alias("columns"),
                F.lit(f"{directory.rstrip('/')}/{spec.name}.{kind}").alias("output_path"),
                F.lit(spec.description).alias("description"),
            )
        )
    listed = reduce(DataFrame.unionByName, rows)
    path = f"{directory.rstrip('/')}/_export_summary.json"
    write_then_switch(spark, path, listed.coalesce(1).write.json)
    return spark.read.schema(listed.schema).json(path)


def publish(
    tables: Mapping[str, DataFrame], specs: Sequence[ExportSpec], directory: str, kind: str = "both", marked: bool = False
) -> DataFrame:
    """Write every spec whose source is in ``tables``, a few at a time, and the manifest over the written files."""
    missing = sorted({spec.source for spec in specs} - set(tables))
    if missing:
        raise LookupError("missing source tables: " + ", ".join(missing))
    spark = next(iter(tables.values())).sparkSession

    def write(spec: ExportSpec) -> tuple[str, str, DataFrame, Sequence[str]]:
        files = write_export(spec.shape(tables[spec.source]), directory, spec.name, kind, spec.order, marked)
        stored = read_export(spark, directory, spec.name, "csv" if kind == "csv" else "parquet")
        return spec.source, spec.description, stored, files

    listed = manifest(dict(zip([spec.name for spec in specs], side_by_side(write, specs), strict=True)))
    write_export(listed, directory, "_export_manifest", kind, ("output_name",), marked)
    return read_export(spark, directory, "_export_manifest", "csv" if kind == "csv" else "parquet").orderBy("output_name")


def check_exports(spark: SparkSession, directory: str, expected: Mapping[str, Sequence[str]]) -> DataFrame:
    """(name, exists, row_count, missing_columns, is_valid) of published Parquet tables."""
    rows = []
    for name, columns in expected.items():
        if not path_exists(spark, f"{directory.rstrip('/')}/{name}.parquet"):
            rows.append(_check_row(spark.range(0), name, False, list(columns)))
            continue
        df = read_export(spark, directory, name, "parquet")
        rows.append(_check_row(df, name, True, [c for c in columns if c not in df.columns]))
    return reduce(DataFrame.unionByName, rows)


def _check_row(df: DataFrame, name: str, exists: bool, missing: Sequence[str]) -> DataFrame:
    return df.agg(
        F.lit(name).alias("name"),
        F.lit(exists).alias("file_exists"),
        F.count(F.lit(1)).alias("row_count"),
        F.lit(", ".join(sorted(missing))).alias("missing_columns"),
        F.lit(exists and not missing).alias("is_valid"),
    )
