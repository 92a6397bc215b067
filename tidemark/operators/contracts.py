"""Data contracts, load audit and declarative data tests.

Every check is a plain aggregate: it returns a DataFrame of counts and leaves
it to the caller to look at it or to raise.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import text
from tidemark.operators.aggregates import one_row
from tidemark.operators.cleaning import normalize_name


@dataclass(frozen=True)
class TableContract:
    required: tuple[str, ...]
    non_empty: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    sensitive: tuple[str, ...] = ()
    description: str = ""
    owner: str = "account member"


@dataclass(frozen=True)
class HistoryContract:
    table: str
    required: tuple[str, ...]
    non_negative: tuple[str, ...] = ()
    ratios: tuple[str, ...] = ()
    must_have_rows: bool = True


class ContractError(ValueError):
    pass


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [name for name in required if name not in df.columns]


def assert_columns(df: DataFrame, contract: TableContract) -> None:
    missing = missing_columns(df, contract.required)
    if missing:
        raise ContractError("missing required columns: " + ", ".join(missing))


def duplicate_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(row_count, duplicate_rows): rows beyond the first of each key, NULLs comparing equal.

    Two aggregates: the per-key count combines map-side, so a hot key costs
    one partial row per task.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    return per_key.agg(
        F.coalesce(F.sum("__rows"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.col("__rows") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def validate_contract(df: DataFrame, contract: TableContract) -> DataFrame:
    """One row: row_count, missing_columns, duplicate_rows, blank_required_values.

    Without all columns of the unique key duplicates cannot be counted: the
    count is NULL and the absent key columns are among the missing ones.
    """
    missing = missing_columns(df, tuple(dict.fromkeys((*contract.required, *contract.unique))))
    checked = [name for name in contract.non_empty if name in df.columns]
    keys = [name for name in contract.unique if name in df.columns]
    blanks = reduce(
        lambda total, name: total + F.when(text.is_blank(name), 1).otherwise(0), checked, F.lit(0)
    ).cast("long")
    if keys and len(keys) == len(contract.unique):
        per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"), F.sum(blanks).alias("__blank"))
    else:
        per_key = df.agg(F.count(F.lit(1)).alias("__rows"), F.sum(blanks).alias("__blank"))
    duplicates = F.coalesce(F.sum(F.col("__rows") - 1), F.lit(0)) if keys else F.lit(0)
    if len(keys) < len(contract.unique):
        duplicates = F.lit(None)
    return per_key.agg(
        F.coalesce(F.sum("__rows"), F.lit(0)).alias("row_count"),
        F.lit(", ".join(missing)).alias("missing_columns"),
        duplicates.cast("long").alias("duplicate_rows"),
        F.coalesce(F.sum("__blank"), F.lit(0)).alias("blank_required_values"),
    )


def null_rate_columns(names: Mapping[str, str]) -> list[Column]:
    """One aggregate per column: share of NULLs, rounded to four digits."""
    return [
        F.round(F.avg(F.col(f"`{name}`").isNull().cast("int").cast("double")), 4).alias(alias)
        for name, alias in names.items()
    ]


def null_rates(df: DataFrame) -> DataFrame:
    """Long form (column_name, null_rate); every column in a single pass."""
    names = df.columns
    wide = df.agg(*null_rate_columns({name: name for name in names}))
    return wide.unpivot([], names, "column_name", "null_rate")


def load_profile(
    df: DataFrame, prefix: str, *more: Column, without: str | None = None, unique: Sequence[str] = ()
) -> DataFrame:
    """One row: row count, column count and the null-rate map of a table as JSON, and ``more`` aggregates.

    Rates are keyed by normalised column name on both sides of a transform, so
    before and after can be matched. With a ``unique`` key, whose columns the
    table has, the rows are counted per key first, so that the same scan gives
    ``duplicate_rows``, the rows beyond the first of each key.
    """
    pairs: list[Column] = []
    names = [name for name in df.columns if name != without]
    rows = F.count(F.lit(1))
    rates = {name: F.avg(F.col(f"`{name}`").isNull().cast("int").cast("double")) for name in names}
    if unique:
        nulls = {name: f"__null_{i}" for i, name in enumerate(names)}
        counted = [F.count_if(F.col(f"`{name}`").isNull()).alias(alias) for name, alias in nulls.items()]
        df = df.groupBy(*unique).agg(rows.alias("__rows"), *counted)
        rows = F.coalesce(F.sum("__rows"), F.lit(0))
        rates = {name: F.sum(alias).cast("double") / F.sum("__rows").cast("double") for name, alias in nulls.items()}
        more = (*more, F.coalesce(F.sum(F.col("__rows") - 1), F.lit(0)).alias("duplicate_rows"))
    for name, rate in rates.items():
        pairs += [F.lit(normalize_name(name)), F.coalesce(F.round(rate, 4), F.lit(0.0))]
    return df.agg(
        rows.alias(f"{prefix}row_count"),
        F.lit(len(names)).cast("long").alias(f"{prefix}column_count"),
        F.to_json(F.create_map(*pairs)).alias(f"{prefix}null_rate_by_column"),
        *more,
    )


def audit_row(
    raw: DataFrame,
    cleaned: DataFrame,
    contract: TableContract,
    *,
    table_key: str,
    source_file: str,
    source_path: str,
    export_type: str,
    loaded_at: Column,
    rejected: str | None = None,
) -> DataFrame:
    """The audit record of one load, measured on the data itself.

    ``cleaned`` should be the table as written. ``rejected`` names a column of
    ``raw``, no field, that is not NULL where a record was put aside; such records
    are among the source rows, and so among the removed ones. Counts come from aggregates
    rather than from task-side accumulators, which can count a retried task
    twice.
    """
    before = load_profile(raw, "source_", F.count(rejected or F.lit(None)).alias("rejected_rows"), without=rejected)
    keyed = bool(contract.unique) and not missing_columns(cleaned, contract.unique)
    after = load_profile(cleaned, "after_", unique=contract.unique if keyed else ())
    if not keyed:  # 0 without a key, unknown where the table lacks a column of it
        after = after.withColumn("duplicate_rows", F.lit(None if contract.unique else 0).cast("long"))
    one = one_row(before, after)
    return one.select(
        F.lit(table_key).alias("table_key"),
        F.lit(table_key).alias("bronze_table"),
        F.lit(source_file).alias("source_file"),
        F.lit(source_path).alias("source_path"),
        F.lit(export_type).alias("export_type"),
        F.col("after_row_count").alias("row_count"),
        F.col("after_column_count").alias("column_count"),
        "source_row_count",
        "source_column_count",
        F.col("after_row_count").alias("row_count_after_transform"),
        F.col("after_column_count").alias("column_count_after_transform"),
        (F.col("source_row_count") - F.col("after_row_count")).alias("rows_removed_during_transform"),
        F.col("duplicate_rows").alias("duplicate_rows_after_transform"),
        F.lit(contract.owner).alias("contract_owner"),
        F.lit(contract.description).alias("contract_description"),
        F.lit(", ".join(contract.required)).alias("required_columns"),
        F.lit(json.dumps(list(contract.non_empty))).alias("non_empty_columns"),
        F.lit(json.dumps(list(contract.unique))).alias("unique_columns"),
        F.col("after_null_rate_by_column").alias("null_rate_by_column"),
        "source_null_rate_by_column",
        F.lit(", ".join(contract.sensitive)).alias("sensitive_columns"),
        loaded_at.alias("loaded_at_utc"),
        "rejected_rows",
    )


# --- data tests ------------------------------------------------------------


def not_null(column: str) -> tuple[str, str, Column]:
    return "not_null", column, F.col(column).isNull()


def accepted_values(column: str, values: Sequence[object]) -> tuple[str, str, Column]:
    return "accepted_values", column, F.col(column).isNotNull() & ~F.col(column).isin(list(values))


def expression_holds(name: str, column: str, holds: Column) -> tuple[str, str, Column]:
    """A row-level rule; NULL (unknown) does not count as a violation."""
    return name, column, F.coalesce(~holds, F.lit(False))


def run_tests(df: DataFrame, tests: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """(test, column_name, violations): all tests of a table in one scan."""
    names = [f"t{i}" for i in range(len(tests))]
    counts = df.agg(
        *[F.coalesce(F.sum(bad.cast("long")), F.lit(0)).alias(n) for n, (_, _, bad) in zip(names, tests, strict=True)]
    )
    rows = F.explode(
        F.array(
            *[
                F.struct(F.lit(t).alias("test"), F.lit(c).alias("column_name"), F.col(n).alias("violations"))
                for n, (t, c, _) in zip(names, tests, strict=True)
            ]
        )
    )
    return counts.select(rows.alias("r")).select("r.*")


def violating_rows(df: DataFrame, broken: Column) -> DataFrame:
    """Rows that break an invariant; an empty result means it holds."""
    return df.where(broken)


def current_within_total(career: DataFrame) -> DataFrame:
    return violating_rows(career, F.col("current_positions_started") > F.col("total_positions_started"))


def email_within_total(connections: DataFrame) -> DataFrame:
    return violating_rows(connections, F.col("connections_with_email") > F.col("total_connections"))


def reads_add_up(health: DataFrame) -> DataFrame:
    return violating_rows(
        health, F.col("total_inventory_files") != F.col("successful_reads") + F.col("failed_reads")
    )


def counters_non_negative(health: DataFrame) -> DataFrame:
    numeric = [f.name for f in health.schema.fields if isinstance(f.dataType, T.NumericType)]
    return violating_rows(health, reduce(lambda a, b: a | b, [F.col(name) < 0 for name in numeric]))


def history_checks(df: DataFrame, contract: HistoryContract) -> DataFrame:
    """(rule, column_name, violations) of one history table."""
    tests: list[tuple[str, str, Column]] = []
    if "snapshot_date" in df.columns:
        tests.append(("null_date", "snapshot_date", F.col("snapshot_date").isNull()))
    if "is_simulated_snapshot" in df.columns:
        tests.append(("simulated", "is_simulated_snapshot", F.coalesce("is_simulated_snapshot", F.lit(False))))
    if "snapshot_method" in df.columns:
        tests.append(("null_method", "snapshot_method", F.col("snapshot_method").isNull()))
    tests += [
        ("negative", name, F.coalesce(F.col(name) < 0, F.lit(False)))
        for name in contract.non_negative
        if name in df.columns
    ]
    tests += [
        ("out_of_range", name, F.coalesce(~F.col(name).between(0, 1), F.lit(False)))
        for name in contract.ratios
        if name in df.columns
    ]
    found = run_tests(df, tests)
    if contract.must_have_rows:
        empty = df.agg(
            F.lit("no_rows").alias("test"),
            F.lit("*").alias("column_name"),
            (F.count(F.lit(1)) == 0).cast("long").alias("violations"),
        )
        found = found.unionByName(empty)
    missing = missing_columns(df, contract.required)
    if missing:
        rows = F.explode(F.array(*[F.lit(name) for name in missing]))
        one = df.sparkSession.range(1)
        found = found.unionByName(
            one.select(F.lit("missing").alias("test"), rows.alias("column_name"), F.lit(1).cast("long").alias("violations"))
        )
    return found.select(F.lit(contract.table).alias("table_name"), F.col("test").alias("rule"), "column_name", "violations")
