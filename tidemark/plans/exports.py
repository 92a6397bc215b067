"""What is published for BI: the declared tables, the calendar and the history layer."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from tidemark.operators.calendar import build_calendar, date_range
from tidemark.plans import history
from tidemark.plans.models import MART_NAMES, Models
from tidemark.sources.publish import ExportSpec, publish, write_summary
from tidemark.sources.warehouse import Warehouse


def _spec(
    name: str,
    source: str,
    columns: tuple[str, ...],
    order: tuple[str, ...] = (),
    description: str = "",
    dates: tuple[str, ...] = (),
) -> ExportSpec:
    return ExportSpec(name, source, columns, order, description, dates)


# Names, columns and orders of the published tables.
EXPORTS: tuple[ExportSpec, ...] = (
    _spec(
        "dim_profile",
        "profile_summary",
        (
            "first_name", "last_name", "headline", "industry", "geo_location", "profile_track", "summary_length",
            "summary_size_category", "primary_contact_url", "primary_contact_label", "portfolio_website",
        ),
        description="Who the member is.",
    ),
    _spec(
        "dim_language_proficiency",
        "languages_summary",
        ("proficiency_track", "total_languages", "unique_languages"),
        description="Languages by proficiency.",
    ),
    _spec(
        "fact_connections_timeline",
        "connections_summary",
        (
            "connection_year", "connection_month", "connection_year_month", "total_connections",
            "connections_with_email", "unique_companies", "unique_positions",
        ),
        ("connection_year", "connection_month"),
        "Connections and e-mail coverage by month.",
    ),
    _spec(
        "fact_career_progression",
        "career_progression",
        (
            "start_year", "start_month", "start_year_month", "total_positions_started", "current_positions_started",
            "unique_companies", "unique_titles", "avg_duration_months",
        ),
        ("start_year", "start_month"),
        "Positions started by month.",
    ),
    _spec(
        "fact_education_timeline",
        "education_summary",
        (
            "start_year", "start_month", "start_year_month", "total_education_started", "current_education_started",
            "unique_schools", "unique_degrees", "avg_education_duration_months",
        ),
        ("start_year", "start_month"),
        "Education started by month.",
    ),
    _spec(
        "fact_certifications_timeline",
        "certifications_summary",
        (
            "start_year", "start_month", "start_year_month", "total_certifications", "unique_certifications",
            "unique_authorities", "avg_duration_months",
        ),
        ("start_year", "start_month"),
        "Certifications by month.",
    ),
    _spec(
        "fact_skills_summary",
        "skills_summary",
        ("skill_category", "total_skills", "unique_skills", "avg_skill_name_length"),
        ("-total_skills", "skill_category"),
        "Skills by category.",
    ),
    _spec(
        "fact_learning_summary",
        "learning_summary",
        ("content_type_clean", "total_contents", "completed_contents", "saved_contents", "contents_with_notes"),
        ("-total_contents", "content_type_clean"),
        "Learning content by type.",
    ),
    _spec(
        "fact_job_applications_timeline",
        "job_applications_summary",
        (
            "application_year", "application_month", "application_year_month", "job_family", "total_applications",
            "unique_companies", "applications_with_resume", "applications_with_questionnaire",
        ),
        ("application_year", "application_month", "job_family"),
        "Applications by month and job family.",
    ),
    _spec(
        "fact_recommendations_timeline",
        "recommendations_received_timeline",
        (
            "recommendation_year", "recommendation_month", "recommendation_year_month", "total_recommendations",
            "avg_text_length", "mentions_data_count", "mentions_teamwork_count",
        ),
        ("recommendation_year", "recommendation_month"),
        "Recommendations by month.",
    ),
    _spec(
        "fact_recommendations_summary",
        "recommendations_received_summary",
        (
            "total_recommendations", "avg_text_length", "mentions_data_count", "mentions_teamwork_count",
            "first_recommendation_date", "last_recommendation_date",
        ),
        description="Recommendations overall.",
    ),
    _spec(
        "fact_endorsements_summary",
        "endorsement_received_info_summary",
        (
            "skill_name_clean", "endorsement_count", "unique_endorsers", "first_endorsement_date",
            "last_endorsement_date",
        ),
        ("-endorsement_count", "skill_name_clean"),
        "Endorsements by skill.",
    ),
    _spec(
        "fact_company_follows",
        "company_follows_summary",
        ("organization_clean", "follow_count", "first_follow_date", "last_follow_date"),
        ("-follow_count", "organization_clean"),
        "Follows by organization.",
    ),
    _spec(
        "fact_events_summary",
        "events_summary",
        ("event_year", "event_month", "event_year_month", "status", "total_events", "events_with_url"),
        ("event_year", "event_month", "status"),
        "Events by month and status.",
    ),
    _spec(
        "fact_invitations_summary",
        "invitations_summary",
        (
            "invitation_year", "invitation_month", "invitation_year_month", "direction", "total_invitations",
            "invitations_with_message",
        ),
        ("invitation_year", "invitation_month", "direction"),
        "Invitations by month and direction.",
    ),
    _spec(
        "fact_saved_job_alerts",
        "saved_job_alerts_summary",
        ("alert_frequency", "total_alerts", "unique_keyword_sets", "remote_alerts", "company_scoped_alerts"),
        ("-total_alerts", "alert_frequency"),
        "Saved job alerts by frequency.",
    ),
    _spec(
        "fact_file_inventory",
        "file_inventory_summary",
        (
            "export_type", "categoria_dado", "status_leitura", "volume_categoria", "total_arquivos", "total_linhas",
            "total_colunas", "total_tamanho_kb", "primeira_execucao_inventario", "ultima_execucao_inventario",
        ),
        ("export_type", "categoria_dado", "status_leitura"),
        "File inventory by category.",
    ),
    _spec(
        "fact_pipeline_health",
        "pipeline_health_summary",
        (
            "total_inventory_files", "successful_reads", "failed_reads", "latest_inventory_timestamp",
            "total_connections", "total_positions", "total_education_records", "total_certifications",
            "total_languages", "total_endorsements", "total_company_follows", "total_recommendations", "total_skills",
            "total_invitations", "total_events", "total_learning_records", "total_job_applications",
            "total_saved_job_alerts", "total_volunteering", "total_email_addresses", "total_phone_numbers",
        ),
        description="Coverage and health of the loads.",
    ),
    _spec(
        "fact_ingestion_audit_health_timeline",
        "ingestion_audit_health_timeline",
        (
            "loaded_at_utc", "loaded_on", "loaded_year_month", "table_key", "bronze_table", "source_file",
            "export_type", "source_row_count", "source_column_count", "row_count_after_transform",
            "column_count_after_transform", "rows_removed_during_transform", "duplicate_rows_after_transform",
            "row_retention_rate", "row_count_change_vs_previous_load", "rows_removed_change_vs_previous_load",
            "duplicate_alert_flag", "row_removal_alert_flag", "health_status", "successful_load_flag",
        ),
        ("loaded_at_utc", "table_key"),
        "Health of every load.",
    ),
    _spec(
        "fact_ingestion_audit_null_rate_timeline",
        "ingestion_audit_null_rate_timeline",
        (
            "loaded_at_utc", "loaded_on", "loaded_year_month", "table_key", "bronze_table", "export_type",
            "source_file", "source_row_count", "row_count_after_transform", "rows_removed_during_transform",
            "monitored_column", "null_rate_before_transform", "null_rate_after_transform", "null_rate_delta",
            "null_rate_change_vs_previous_load", "null_rate_alert_flag",
        ),
        ("loaded_at_utc", "table_key", "monitored_column"),
        "Null rates of every load and column.",
    ),
    _spec(
        "fact_contact_account",
        "contact_account_summary",
        (
            "total_email_addresses", "confirmed_email_addresses", "primary_email_addresses", "total_phone_numbers",
            "first_registered_at", "latest_registered_at", "subscription_types", "account_age_years",
        ),
        description="Contact points and account metadata.",
    ),
)

_HEAD = ("snapshot_run_id", "snapshot_date", "snapshot_year_month")
_TAIL = ("is_simulated_snapshot", "snapshot_method", "snapshot_source", "snapshot_created_at")


def _history_spec(name: str, columns: tuple[str, ...], order: tuple[str, ...], description: str) -> ExportSpec:
    return _spec(name, name, (*_HEAD, *columns, *_TAIL), order, description, ("snapshot_date",))


HISTORY_EXPORTS: tuple[ExportSpec, ...] = (
    _history_spec(
        "fact_snapshot_network_growth",
        (
            "monthly_new_connections", "total_connections_cumulative", "monthly_new_connections_with_email",
            "connections_with_email_cumulative", "connections_with_email_pct", "unique_companies_in_month",
            "unique_positions_in_month", "connections_mom_delta", "connections_mom_pct",
        ),
        ("snapshot_date",),
        "Network growth by month.",
    ),
    _history_spec(
        "fact_snapshot_applications",
        (
            "total_applications", "cumulative_total_applications", "applications_with_resume",
            "cumulative_applications_with_resume", "applications_with_questionnaire",
            "cumulative_applications_with_questionnaire", "applications_with_resume_pct",
            "applications_with_questionnaire_pct", "job_family_count", "applications_mom_delta",
            "applications_mom_pct",
        ),
        ("snapshot_date",),
        "Applications by month.",
    ),
    _history_spec(
        "fact_snapshot_presence",
        (
            "monthly_events", "monthly_events_with_url", "events_with_url_pct", "monthly_invitations",
            "monthly_invitations_with_message", "invitations_with_message_pct", "monthly_recommendations",
            "average_recommendation_text_length", "mentions_data_count", "recommendations_mention_data_pct",
            "cumulative_events", "cumulative_invitations", "cumulative_recommendations", "presence_score",
            "engagement_score",
        ),
        ("snapshot_date",),
        "Presence by month.",
    ),
    _history_spec(
        "fact_snapshot_career_education",
        (
            "positions_started_in_month", "positions_started_cumulative", "current_positions_started_in_month",
            "current_positions_cumulative", "avg_position_duration_months", "avg_position_duration_cumulative",
            "education_started_in_month", "education_started_cumulative", "current_education_started_in_month",
            "current_education_cumulative", "avg_education_duration_months", "avg_education_duration_cumulative",
            "certifications_started_in_month", "certifications_cumulative", "avg_certification_duration_months",
            "avg_certification_duration_cumulative", "career_maturity_score",
        ),
        ("snapshot_date",),
        "Career and education by month.",
    ),
    _history_spec(
        "fact_snapshot_data_quality",
        history.QUALITY_COLUMNS[2:],
        ("snapshot_date", "table_key"),
        "Data quality by load.",
    ),
    _spec(
        "dim_snapshot_method",
        "dim_snapshot_method",
        ("snapshot_method", "method_group", "method_description", "is_simulated"),
        ("snapshot_method",),
        "How history rows are made.",
    ),
    _spec(
        "dim_snapshot_run",
        "dim_snapshot_run",
        (
            "snapshot_run_id", "run_started_at", "run_finished_at", "phase_name", "contains_simulated_data",
            "source_warehouse_path", "project_git_commit", "notes",
        ),
        ("run_started_at",),
        "History builds.",
    ),
)

# Marts and the columns whose values the calendar must cover.
CALENDAR_SOURCES = {
    "connections_summary": ("connection_year_month",),
    "career_progression": ("start_year_month",),
    "education_summary": ("start_year_month",),
    "certifications_summary": ("start_year_month",),
    "job_applications_summary": ("application_year_month",),
    "recommendations_received_timeline": ("recommendation_year_month",),
    "events_summary": ("event_year_month",),
    "invitations_summary": ("invitation_year_month",),
    "company_follows_summary": ("first_follow_date", "last_follow_date"),
    "endorsement_received_info_summary": ("first_endorsement_date", "last_endorsement_date"),
    "recommendations_received_summary": ("first_recommendation_date", "last_recommendation_date"),
    "file_inventory_summary": ("primeira_execucao_inventario", "ultima_execucao_inventario"),
    "pipeline_health_summary": ("latest_inventory_timestamp",),
    "ingestion_audit_health_timeline": ("loaded_on",),
    "ingestion_audit_null_rate_timeline": ("loaded_on",),
    "contact_account_summary": ("first_registered_at", "latest_registered_at"),
}

CALENDAR_EXPORT = _spec(
    "dim_date",
    "calendar",
    (
        "date", "date_key", "year", "quarter_number", "month_number", "month_name", "month_name_short", "year_month",
        "year_month_label", "semester_number", "semester_label", "bimester_number", "bimester_label", "week_of_year",
        "day", "day_of_week_number", "day_of_week_name", "is_weekend", "quarter_label", "half_year_label",
        "bimester_year_label", "year_label",
    ),
    ("date",),
    "Calendar for time filters and relationships.",
)

# Columns the observability report needs in each published table.
OBSERVABILITY_COLUMNS = {
    "dim_date": ("date", "year_month"),
    "fact_ingestion_audit_health_timeline": (
        "loaded_on",
        "table_key",
        "export_type",
        "source_row_count",
        "row_count_after_transform",
        "rows_removed_during_transform",
        "duplicate_rows_after_transform",
        "row_retention_rate",
        "health_status",
        "successful_load_flag",
    ),
    "fact_ingestion_audit_null_rate_timeline": (
        "loaded_on",
        "table_key",
        "export_type",
        "monitored_column",
        "null_rate_before_transform",
        "null_rate_after_transform",
        "null_rate_delta",
        "null_rate_alert_flag",
    ),
}


def calendar(models: Models, as_of: dt.date | str | None = None) -> DataFrame:
    """Calendar over every date in the marts; sources are reduced per mart before they meet."""
    bounds = date_range([(models.mart(mart), columns) for mart, columns in CALENDAR_SOURCES.items()])
    return build_calendar(bounds, as_of)


def publish_marts(models: Models, directory: str, kind: str = "both") -> DataFrame:
    tables = {name: models.mart(name) for name in MART_NAMES}
    tables["calendar"] = calendar(models, models.settings.as_of)
    return publish(tables, (CALENDAR_EXPORT, *EXPORTS), directory, kind, marked=True)


def publish_history(warehouse: Warehouse, directory: str) -> DataFrame:
    tables = {spec.source: warehouse.read("main", spec.source) for spec in HISTORY_EXPORTS}
    listed = publish(tables, HISTORY_EXPORTS, directory, "csv")
    write_summary(warehouse.spark, HISTORY_EXPORTS, directory, "csv")
    return listed


def missing_sources(warehouse: Warehouse) -> list[str]:
    return warehouse.missing([("main", f"mart_{name}") for name in MART_NAMES])
