"""Month-grain history facts with running totals, changes and scores.

Everything here starts from month-grain marts, so the unpartitioned running
windows see one row per calendar month. Months without a date are left out
before any spine or running total.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import dates, lexicon
from tidemark.functions.numeric import clip_unit, count_if, safe_ratio
from tidemark.operators.contracts import ContractError, HistoryContract, history_checks
from tidemark.operators.windows import (
    delta_vs_previous,
    growth_vs_previous,
    running_total,
    running_weighted_mean,
    spread_on_months,
)

if TYPE_CHECKING:
    from tidemark.plans.models import Models

MONTH = "snapshot_year_month"


@dataclass(frozen=True)
class Run:
    """Identity of one history build."""

    run_id: str
    created_at: dt.datetime
    source_path: str = ""
    started_at: dt.datetime | None = None
    finished_at: dt.datetime | None = None
    notes: str = ""


def _moment(value: dt.datetime | None) -> Column:
    return F.lit(None if value is None else value.isoformat(sep=" ")).cast("timestamp_ntz")


def _stamp(df: DataFrame, run: Run, method: str, source: str, columns: list[str]) -> DataFrame:
    """Add what all facts share and fix the column order."""
    return df.select(
        F.lit(run.run_id).alias("snapshot_run_id"),
        *columns,
        F.lit(False).alias("is_simulated_snapshot"),
        F.lit(method).alias("snapshot_method"),
        F.lit(source).alias("snapshot_source"),
        _moment(run.created_at).alias("snapshot_created_at"),
    )


def _months(mart: DataFrame, month: str, **columns: str) -> DataFrame:
    """A mart's dated rows under history names."""
    dated = mart.where(F.col(month).isNotNull())
    return dated.select(F.col(month).alias(MONTH), *[F.col(old).alias(new) for new, old in columns.items()])


def network_growth(models: Models, run: Run) -> DataFrame:
    monthly = _months(
        models.mart("connections_summary"),
        "connection_year_month",
        monthly_new_connections="total_connections",
        monthly_new_connections_with_email="connections_with_email",
        unique_companies_in_month="unique_companies",
        unique_positions_in_month="unique_positions",
    )
    monthly = monthly.withColumns(
        {
            "snapshot_date": dates.month_end(MONTH),
            "total_connections_cumulative": running_total("monthly_new_connections", MONTH),
            "connections_with_email_cumulative": running_total("monthly_new_connections_with_email", MONTH),
            "connections_mom_delta": delta_vs_previous("monthly_new_connections", MONTH),
            "connections_mom_pct": growth_vs_previous("monthly_new_connections", MONTH),
        }
    )
    share = safe_ratio("connections_with_email_cumulative", "total_connections_cumulative")
    columns = [
        "snapshot_date",
        MONTH,
        "monthly_new_connections",
        "total_connections_cumulative",
        "monthly_new_connections_with_email",
        "connections_with_email_cumulative",
        "connections_with_email_pct",
        "unique_companies_in_month",
        "unique_positions_in_month",
        "connections_mom_delta",
        "connections_mom_pct",
    ]
    monthly = monthly.withColumn("connections_with_email_pct", share)
    return _stamp(monthly, run, lexicon.CUMULATIVE_HISTORY, "mart_connections_summary", columns)


def applications(models: Models, run: Run) -> DataFrame:
    mart = models.mart("job_applications_summary")
    monthly = (
        mart.where(F.col("application_year_month").isNotNull())
        .groupBy(F.col("application_year_month").alias(MONTH))
        .agg(
            F.sum("total_applications").alias("total_applications"),
            F.sum("applications_with_resume").alias("applications_with_resume"),
            F.sum("applications_with_questionnaire").alias("applications_with_questionnaire"),
            # The mart has one row per month and family, so counting rows counts families.
            F.count("job_family").alias("job_family_count"),
        )
    )
    monthly = monthly.withColumns(
        {
            "snapshot_date": dates.month_end(MONTH),
            "cumulative_total_applications": running_total("total_applications", MONTH),
            "cumulative_applications_with_resume": running_total("applications_with_resume", MONTH),
            "cumulative_applications_with_questionnaire": running_total("applications_with_questionnaire", MONTH),
            "applications_with_resume_pct": safe_ratio("applications_with_resume", "total_applications"),
            "applications_with_questionnaire_pct": safe_ratio("applications_with_questionnaire", "total_applications"),
            "applications_mom_delta": delta_vs_previous("total_applications", MONTH),
            "applications_mom_pct": growth_vs_previous("total_applications", MONTH),
        }
    )
    columns = [
        "snapshot_date",
        MONTH,
        "total_applications",
        "cumulative_total_applications",
        "applications_with_resume",
        "cumulative_applications_with_resume",
        "applications_with_questionnaire",
        "cumulative_applications_with_questionnaire",
        "applications_with_resume_pct",
        "applications_with_questionnaire_pct",
        "job_family_count",
        "applications_mom_delta",
        "applications_mom_pct",
    ]
    return _stamp(monthly, run, lexicon.CUMULATIVE_HISTORY, "mart_job_applications_summary", columns)


def presence(models: Models, run: Run) -> DataFrame:
    def monthly_sums(mart: str, month: str, **columns: str) -> DataFrame:
        df = models.mart(mart).where(F.col(month).isNotNull())
        sums = [F.sum(old).alias(new) for new, old in columns.items()]
        return df.groupBy(F.col(month).alias(MONTH)).agg(*sums)

    events = monthly_sums(
        "events_summary", "event_year_month", monthly_events="total_events", monthly_events_with_url="events_with_url"
    )
    invitations = monthly_sums(
        "invitations_summary",
        "invitation_year_month",
        monthly_invitations="total_invitations",
        monthly_invitations_with_message="invitations_with_message",
    )
    recommendations = _months(
        models.mart("recommendations_received_timeline"),
        "recommendation_year_month",
        monthly_recommendations="total_recommendations",
        average_recommendation_text_length="avg_text_length",
        mentions_data_count="mentions_data_count",
    )
    frames = [events, invitations, recommendations]
    gaps = {name: 0 for df in frames for name in df.columns if name != MONTH}
    monthly = spread_on_months(frames, MONTH, gaps)
    monthly = monthly.withColumns(
        {
            "snapshot_date": dates.month_end(MONTH),
            "cumulative_events": running_total("monthly_events", MONTH),
            "cumulative_invitations": running_total("monthly_invitations", MONTH),
            "cumulative_recommendations": running_total("monthly_recommendations", MONTH),
            "events_with_url_pct": safe_ratio("monthly_events_with_url", "monthly_events"),
            "invitations_with_message_pct": safe_ratio("monthly_invitations_with_message", "monthly_invitations"),
            "recommendations_mention_data_pct": safe_ratio("mentions_data_count", "monthly_recommendations"),
        }
    )
    weight, part = lexicon.PRESENCE_WEIGHTS, lexicon.ENGAGEMENT_WEIGHTS
    presence_score = (
        F.col("events_with_url_pct") * weight["events"]
        + F.col("invitations_with_message_pct") * weight["invitations"]
        + F.col("recommendations_mention_data_pct") * weight["recommendations"]
    )
    engagement_score = (
        safe_ratio("monthly_recommendations", "cumulative_recommendations") * part["recommendations"]
        + F.col("invitations_with_message_pct") * part["messages"]
        + safe_ratio("monthly_invitations", "cumulative_invitations") * part["invitations"]
        + safe_ratio("monthly_events", "cumulative_events") * part["events"]
    )
    monthly = monthly.withColumns(
        {"presence_score": clip_unit(presence_score), "engagement_score": clip_unit(engagement_score)}
    )
    columns = [
        "snapshot_date",
        MONTH,
        "monthly_events",
        "monthly_events_with_url",
        "events_with_url_pct",
        "monthly_invitations",
        "monthly_invitations_with_message",
        "invitations_with_message_pct",
        "monthly_recommendations",
        "average_recommendation_text_length",
        "mentions_data_count",
        "recommendations_mention_data_pct",
        "cumulative_events",
        "cumulative_invitations",
        "cumulative_recommendations",
        "presence_score",
        "engagement_score",
    ]
    source = "mart_events_summary|mart_invitations_summary|mart_recommendations_received_timeline"
    return _stamp(monthly, run, lexicon.CUMULATIVE_HISTORY, source, columns)


def career_education(models: Models, run: Run) -> DataFrame:
    career = _months(
        models.mart("career_progression"),
        "start_year_month",
        positions_started_in_month="total_positions_started",
        current_positions_started_in_month="current_positions_started",
        avg_position_duration_months="avg_duration_months",
    )
    education = _months(
        models.mart("education_summary"),
        "start_year_month",
        education_started_in_month="total_education_started",
        current_education_started_in_month="current_education_started",
        avg_education_duration_months="avg_education_duration_months",
    )
    certifications = _months(
        models.mart("certifications_summary"),
        "start_year_month",
        certifications_started_in_month="total_certifications",
        avg_certification_duration_months="avg_duration_months",
    )
    frames = [career, education, certifications]
    gaps = {name: 0 for df in frames for name in df.columns if name != MONTH}
    monthly = spread_on_months(frames, MONTH, gaps)

    def mean(of: str, weight: str) -> Column:
        return running_weighted_mean(of, weight, MONTH)

    monthly = monthly.withColumns(
        {
            "snapshot_date": dates.month_end(MONTH),
            "positions_started_cumulative": running_total("positions_started_in_month", MONTH),
            "current_positions_cumulative": running_total("current_positions_started_in_month", MONTH),
            "education_started_cumulative": running_total("education_started_in_month", MONTH),
            "current_education_cumulative": running_total("current_education_started_in_month", MONTH),
            "certifications_cumulative": running_total("certifications_started_in_month", MONTH),
            "avg_position_duration_cumulative": mean("avg_position_duration_months", "positions_started_in_month"),
            "avg_education_duration_cumulative": mean("avg_education_duration_months", "education_started_in_month"),
            "avg_certification_duration_cumulative": mean(
                "avg_certification_duration_months", "certifications_started_in_month"
            ),
        }
    )
    terms = [clip_unit(F.col(name) / full) * weight for name, full, weight in lexicon.MATURITY_TERMS]
    monthly = monthly.withColumn("career_maturity_score", clip_unit(reduce(lambda a, b: a + b, terms)))
    columns = [
        "snapshot_date",
        MONTH,
        "positions_started_in_month",
        "positions_started_cumulative",
        "current_positions_started_in_month",
        "current_positions_cumulative",
        "avg_position_duration_months",
        "avg_position_duration_cumulative",
        "education_started_in_month",
        "education_started_cumulative",
        "current_education_started_in_month",
        "current_education_cumulative",
        "avg_education_duration_months",
        "avg_education_duration_cumulative",
        "certifications_started_in_month",
        "certifications_cumulative",
        "avg_certification_duration_months",
        "avg_certification_duration_cumulative",
        "career_maturity_score",
    ]
    source = "mart_career_progression|mart_education_summary|mart_certifications_summary"
    return _stamp(monthly, run, lexicon.CUMULATIVE_HISTORY, source, columns)


QUALITY_COLUMNS = [
    "snapshot_date",
    MONTH,
    "table_key",
    "export_type",
    "source_row_count",
    "row_count_after_transform",
    "rows_removed_during_transform",
    "duplicate_rows_after_transform",
    "row_retention_rate",
    "health_status",
    "duplicate_alert_flag",
    "row_removal_alert_flag",
    "successful_load_flag",
    "monitored_columns_count",
    "avg_null_rate_before_transform",
    "avg_null_rate_after_transform",
    "avg_null_rate_delta",
    "null_rate_alert_count",
]


def data_quality(models: Models, run: Run) -> DataFrame:
    """Every load's health with the day's null-rate summary of its table."""
    day = [F.col("loaded_on").alias("snapshot_date"), F.col("loaded_year_month").alias(MONTH), "table_key"]
    keys = ["snapshot_date", MONTH, "table_key"]
    rates = models.mart("ingestion_audit_null_rate_timeline").groupBy(*day).agg(
        F.countDistinct("monitored_column").alias("monitored_columns_count"),
        F.avg("null_rate_before_transform").alias("avg_null_rate_before_transform"),
        F.avg("null_rate_after_transform").alias("avg_null_rate_after_transform"),
        F.avg("null_rate_delta").alias("avg_null_rate_delta"),
        count_if("null_rate_alert_flag").alias("null_rate_alert_count"),
    )
    health = models.mart("ingestion_audit_health_timeline").select(*day, *QUALITY_COLUMNS[3:13])
    merged = health.join(rates, keys, "left")
    source = "mart_ingestion_audit_health_timeline|mart_ingestion_audit_null_rate_timeline"
    return _stamp(merged, run, lexicon.ACTUAL_AUDIT, source, QUALITY_COLUMNS)


def data_quality_from_audit(audit: DataFrame, run: Run) -> DataFrame:
    """The same fact from the bare audit table, for warehouses without the audit marts."""
    loaded = F.col("loaded_at_utc").cast("timestamp_ntz")
    duplicates = F.col("duplicate_rows_after_transform")
    status = F.when(duplicates > 0, F.lit("atencao")).otherwise(F.lit("saudavel"))
    nothing_long, nothing_double = F.lit(None).cast("long"), F.lit(None).cast("double")
    values = [
        loaded.cast("date"),
        dates.year_month(loaded),
        F.col("table_key"),
        F.col("export_type"),
        nothing_long,
        F.col("row_count"),
        nothing_long,
        duplicates,
        nothing_double,
        status,
        duplicates > 0,
        F.lit(False),
        F.lit(1),
        nothing_long,
        nothing_double,
        nothing_double,
        nothing_double,
        nothing_long,
    ]
    named = audit.select(*[v.alias(n) for v, n in zip(values, QUALITY_COLUMNS, strict=True)])
    return _stamp(named, run, lexicon.ACTUAL_AUDIT, "bronze.ingestion_audit", QUALITY_COLUMNS)


FACTS = {
    "fact_snapshot_network_growth": network_growth,
    "fact_snapshot_applications": applications,
    "fact_snapshot_presence": presence,
    "fact_snapshot_career_education": career_education,
    "fact_snapshot_data_quality": data_quality,
}


def method_dimension(spark: SparkSession) -> DataFrame:
    rows = [(*method, False) for method in lexicon.HISTORY_METHODS]
    schema = "snapshot_method string, method_group string, method_description string, is_simulated boolean"
    return spark.createDataFrame(rows, schema)


def run_dimension(spark: SparkSession, run: Run) -> DataFrame:
    return spark.range(1).select(
        F.lit(run.run_id).alias("snapshot_run_id"),
        _moment(run.started_at).alias("run_started_at"),
        _moment(run.finished_at or run.created_at).alias("run_finished_at"),
        F.lit("phase_1_actual_only").alias("phase_name"),
        F.lit(False).alias("contains_simulated_data"),
        F.lit(run.source_path).alias("source_warehouse_path"),
        F.lit(None).cast("string").alias("project_git_commit"),
        F.lit(run.notes).alias("notes"),
    )


_KEYS = ("snapshot_run_id", "snapshot_date", MONTH)
_TAGS = ("is_simulated_snapshot", "snapshot_method", "snapshot_source")

# Month-over-month changes are signed, so they are bound neither below by 0 nor to [0, 1].
CONTRACTS = {
    c.table: c
    for c in (
        HistoryContract(
            "fact_snapshot_network_growth",
            required=(*_KEYS, "total_connections_cumulative", *_TAGS),
            non_negative=(
                "monthly_new_connections",
                "total_connections_cumulative",
                "monthly_new_connections_with_email",
                "connections_with_email_cumulative",
                "unique_companies_in_month",
                "unique_positions_in_month",
            ),
            ratios=("connections_with_email_pct",),
        ),
        HistoryContract(
            "fact_snapshot_applications",
            required=(*_KEYS, "total_applications", "cumulative_total_applications", *_TAGS),
            non_negative=(
                "total_applications",
                "cumulative_total_applications",
                "applications_with_resume",
                "applications_with_questionnaire",
                "job_family_count",
            ),
            ratios=("applications_with_resume_pct", "applications_with_questionnaire_pct"),
        ),
        HistoryContract(
            "fact_snapshot_presence",
            required=(*_KEYS, *_TAGS),
            non_negative=(
                "monthly_events",
                "monthly_invitations",
                "monthly_recommendations",
                "cumulative_events",
                "cumulative_invitations",
                "cumulative_recommendations",
            ),
            ratios=(
                "events_with_url_pct",
                "invitations_with_message_pct",
                "recommendations_mention_data_pct",
                "presence_score",
                "engagement_score",
            ),
        ),
        HistoryContract(
            "fact_snapshot_career_education",
            required=(*_KEYS, *_TAGS),
            non_negative=(
                "positions_started_in_month",
                "positions_started_cumulative",
                "current_positions_cumulative",
                "education_started_in_month",
                "education_started_cumulative",
                "current_education_cumulative",
                "certifications_started_in_month",
                "certifications_cumulative",
            ),
            ratios=("career_maturity_score",),
        ),
        HistoryContract(
            "fact_snapshot_data_quality",
            required=(*_KEYS, "table_key", *_TAGS),
            non_negative=(
                "source_row_count",
                "row_count_after_transform",
                "rows_removed_during_transform",
                "duplicate_rows_after_transform",
                "monitored_columns_count",
                "null_rate_alert_count",
            ),
            ratios=("row_retention_rate", "avg_null_rate_before_transform", "avg_null_rate_after_transform"),
        ),
        HistoryContract(
            "dim_snapshot_method",
            required=("snapshot_method", "method_group", "method_description", "is_simulated"),
            must_have_rows=False,
        ),
        HistoryContract(
            "dim_snapshot_run",
            required=(
                "snapshot_run_id",
                "run_started_at",
                "run_finished_at",
                "phase_name",
                "contains_simulated_data",
                "source_warehouse_path",
            ),
            must_have_rows=False,
        ),
    )
}


def check_facts(facts: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, rule, column_name, violations) over all given history tables."""
    return reduce(DataFrame.unionByName, [history_checks(df, CONTRACTS[name]) for name, df in facts.items()])


def require_valid(facts: Mapping[str, DataFrame]) -> None:
    absent = [name for name in FACTS if name not in facts]
    if absent:
        raise ContractError("history tables not built: " + ", ".join(absent))
    broken = check_facts(facts).where("violations > 0").collect()  # a few rows: one per broken rule
    if broken:
        raise ContractError("; ".join(f"{r.table_name}.{r.column_name}: {r.rule} ({r.violations})" for r in broken))


def summarize(facts: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count, methods): stored rows and the methods they were made by."""
    parts = [
        df.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.array_join(F.array_sort(F.collect_set("snapshot_method")), ", ").alias("methods"),
        )
        for name, df in facts.items()
    ]
    return reduce(DataFrame.unionByName, parts)
