"""Load-audit marts: health and null rates of every load over time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.json_rates import explode_rates, lookup_rates
from tidemark.operators.windows import with_previous

# Loads of a table are ordered by time; the file breaks ties.
LOAD_ORDER = ("loaded_at_utc", "source_file")


def health_timeline(audit: DataFrame) -> DataFrame:
    measures = ("row_count_after_transform", "rows_removed_during_transform")
    previous = {name: f"__previous_{name}" for name in measures}
    audit = with_previous(audit, previous, ["table_key"], LOAD_ORDER)
    changes = {name: F.col(name) - F.col(before) for name, before in previous.items()}
    removed = F.col("rows_removed_during_transform")
    source, kept = F.col("source_row_count"), F.col("row_count_after_transform")
    retention = F.when(source > 0, F.round(kept.cast("double") / source, 4))
    status = (
        F.when(source == 0, F.lit("sem_dados"))
        .when(kept == 0, F.lit("esvaziado"))
        .when(removed > 0, F.lit("atencao"))
        .otherwise(F.lit("saudavel"))
    )
    return audit.select(
        "loaded_at_utc",
        "loaded_on",
        "loaded_year_month",
        "table_key",
        "bronze_table",
        "source_file",
        "export_type",
        "source_row_count",
        "source_column_count",
        "row_count_after_transform",
        "column_count_after_transform",
        "rows_removed_during_transform",
        "duplicate_rows_after_transform",
        retention.alias("row_retention_rate"),
        changes["row_count_after_transform"].alias("row_count_change_vs_previous_load"),
        changes["rows_removed_during_transform"].alias("rows_removed_change_vs_previous_load"),
        "contract_owner",
        "contract_description",
        "required_columns",
        "non_empty_columns",
        "unique_columns",
        "null_rate_by_column_json",
        "source_null_rate_by_column_json",
        (F.col("duplicate_rows_after_transform") > 0).alias("duplicate_alert_flag"),
        (removed > 0).alias("row_removal_alert_flag"),
        status.alias("health_status"),
        F.lit(1).alias("successful_load_flag"),
    )


def null_rate_timeline(audit: DataFrame) -> DataFrame:
    """A row per load and monitored column with its null rate before and after the transform."""
    rated = explode_rates(audit, "null_rate_by_column_json", "monitored_column", "null_rate_after_transform")
    rated = rated.where(F.col("monitored_column").isNotNull())
    rated = lookup_rates(
        rated, "source_null_rate_by_column_json", "monitored_column", "null_rate_before_transform"
    )
    previous = {"null_rate_after_transform": "__previous"}
    rated = with_previous(rated, previous, ["table_key", "monitored_column"], LOAD_ORDER)
    after, before = F.col("null_rate_after_transform"), F.col("null_rate_before_transform")
    return rated.select(
        "loaded_at_utc",
        "loaded_on",
        "loaded_year_month",
        "table_key",
        "bronze_table",
        "export_type",
        "source_file",
        "source_row_count",
        "row_count_after_transform",
        "rows_removed_during_transform",
        "monitored_column",
        "null_rate_before_transform",
        "null_rate_after_transform",
        (after - before).alias("null_rate_delta"),
        (after - F.col("__previous")).alias("null_rate_change_vs_previous_load"),
        (F.coalesce(after, F.lit(0.0)) > 0).alias("null_rate_alert_flag"),
    )
