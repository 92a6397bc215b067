"""Generic grouped summaries the marts and dashboard queries are made of."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates, text


def monthly_summary(
    df: DataFrame, year: str, month: str, year_month: str, measures: Mapping[str, Column], by: Sequence[str] = ()
) -> DataFrame:
    """Measures per calendar month (a NULL month is a group of its own).

    Groups by the two integers only; the text key follows from them after the
    aggregation, so no date is formatted per input row.
    """
    grouped = df.groupBy(year, month, *by).agg(*[m.alias(name) for name, m in measures.items()])
    key = dates.year_month_from_parts(year, month).alias(year_month)
    return grouped.select(year, month, key, *by, *measures)


def counts_by(df: DataFrame, key: str, count: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(count))


def top_k(df: DataFrame, key: str, count: str, k: int = 10) -> DataFrame:
    """The k most frequent non-blank values, ties by value: TakeOrderedAndProject, no full sort."""
    present = df.where(F.col(key).isNotNull() & (F.trim(F.col(key)) != ""))
    return counts_by(present, key, count).orderBy(F.desc(count), F.asc(key)).limit(k)


def latest_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-blank values."""
    return df.select(text.as_text(column).alias("value")).where(~text.is_blank("value")).distinct()


def labelled_counts(
    tables: Mapping[str, DataFrame | Sequence[DataFrame]], label: str = "domain_name", count: str = "total_records"
) -> DataFrame:
    """(label, row count) of several tables; a label with several tables gets their sum.

    All tables are read by one union and counted by one aggregate, so there is
    a single shuffle of a few rows per task. A zero row per label keeps empty
    tables in the result.
    """
    frames = [
        (name, df)
        for name, value in tables.items()
        for df in (value if isinstance(value, (list, tuple)) else [value])
    ]
    ones = [df.select(F.lit(name).alias(label), F.lit(1).cast("long").alias("n")) for name, df in frames]
    zeros = ones[0].sparkSession.createDataFrame([(name, 0) for name in tables], f"`{label}` string, n long")
    return reduce(DataFrame.unionByName, ones, zeros).groupBy(label).agg(F.sum("n").alias(count))


def counts_as_columns(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row with a count column per table."""
    counted = labelled_counts(tables, "name", "n")
    return counted.agg(*[F.max(F.when(F.col("name") == name, F.col("n"))).alias(name) for name in tables])


def one_row(*aggregates: DataFrame) -> DataFrame:
    """Several single-row aggregates with different columns as one row.

    A union whose gaps are NULL, folded by ``max``: one scan each, no join.
    """
    names = [name for part in aggregates for name in part.columns]
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), aggregates)
    return united.agg(*[F.max(name).alias(name) for name in names])


def best_group(df: DataFrame, key: str, value: str, key_alias: str, value_alias: str) -> DataFrame:
    """Key with the largest value (the largest key among ties) and that value, as one row."""
    best = F.max(F.struct(F.col(value), F.col(key))).alias("b")
    return df.agg(best).select(F.col(f"b.{key}").alias(key_alias), F.col(f"b.{value}").alias(value_alias))
