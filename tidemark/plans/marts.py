"""Marts: grouped summaries of the enriched models.

Rows are not sorted here; ordering belongs to the published exports, where it
is seen. Distinct counts stay with the engine's own distinct rewrite: its first
shuffle key includes the counted value, so a hot month is spread over tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates
from tidemark.functions.numeric import count_if
from tidemark.operators.aggregates import counts_as_columns, monthly_summary, one_row
from tidemark.plans.enriched import Settings

def _rows() -> Column:
    return F.count(F.lit(1))


def career_progression(positions: DataFrame) -> DataFrame:
    return monthly_summary(
        positions,
        "start_year",
        "start_month",
        "start_year_month",
        {
            "total_positions_started": _rows(),
            "current_positions_started": count_if("is_current"),
            "unique_companies": F.countDistinct("company_name_clean"),
            "unique_titles": F.countDistinct("title_clean"),
            "avg_duration_months": F.avg("duration_months"),
        },
    )


def certifications_summary(certifications: DataFrame) -> DataFrame:
    return monthly_summary(
        certifications,
        "start_year",
        "start_month",
        "start_year_month",
        {
            "total_certifications": _rows(),
            "unique_certifications": F.countDistinct("name_clean"),
            "unique_authorities": F.countDistinct("authority_clean"),
            "avg_duration_months": F.avg("certification_duration_months"),
        },
    )


def company_follows_summary(follows: DataFrame) -> DataFrame:
    return follows.groupBy("organization_clean").agg(
        _rows().alias("follow_count"),
        F.min("followed_on").alias("first_follow_date"),
        F.max("followed_on").alias("last_follow_date"),
    )


def connections_summary(connections: DataFrame) -> DataFrame:
    return monthly_summary(
        connections,
        "connection_year",
        "connection_month",
        "connection_year_month",
        {
            "total_connections": _rows(),
            "connections_with_email": count_if("has_email"),
            "unique_companies": F.countDistinct("company_clean"),
            "unique_positions": F.countDistinct("position_clean"),
        },
    )


def contact_account_summary(
    emails: DataFrame, phones: DataFrame, registration: DataFrame, settings: Settings | None = None
) -> DataFrame:
    settings = settings or Settings()
    merged = one_row(
        emails.agg(
            _rows().alias("total_email_addresses"),
            count_if("confirmed").alias("confirmed_email_addresses"),
            count_if("is_primary").alias("primary_email_addresses"),
        ),
        phones.agg(_rows().alias("total_phone_numbers")),
        registration.agg(
            F.min("registered_at").alias("first_registered_at"),
            F.max("registered_at").alias("latest_registered_at"),
            F.max("subscription_types").alias("subscription_types"),
        ),
    )
    age = dates.years_between("first_registered_at", settings.today)
    return merged.withColumn("account_age_years", age)


def education_summary(education: DataFrame) -> DataFrame:
    return monthly_summary(
        education,
        "start_year",
        "start_month",
        "start_year_month",
        {
            "total_education_started": _rows(),
            "current_education_started": count_if("is_current_education"),
            "unique_schools": F.countDistinct("school_name_clean"),
            "unique_degrees": F.countDistinct("degree_name_clean"),
            "avg_education_duration_months": F.avg("education_duration_months"),
        },
    )


def endorsements_summary(endorsements: DataFrame) -> DataFrame:
    return endorsements.groupBy("skill_name_clean").agg(
        _rows().alias("endorsement_count"),
        F.countDistinct("endorser_full_name").alias("unique_endorsers"),
        F.min("endorsement_date").alias("first_endorsement_date"),
        F.max("endorsement_date").alias("last_endorsement_date"),
    )


def events_summary(events: DataFrame) -> DataFrame:
    return monthly_summary(
        events,
        "event_year",
        "event_month",
        "event_year_month",
        {"total_events": _rows(), "events_with_url": count_if("has_external_url")},
        by=["status"],
    )


def file_inventory_summary(inventory: DataFrame) -> DataFrame:
    def total(name: str) -> Column:
        return F.sum(F.coalesce(name, F.lit(0)))

    return inventory.groupBy("export_type", "categoria_dado", "status_leitura", "volume_categoria").agg(
        _rows().alias("total_arquivos"),
        total("row_count").alias("total_linhas"),
        total("column_count").alias("total_colunas"),
        F.round(total("file_size_kb"), 2).alias("total_tamanho_kb"),
        F.min("inventory_timestamp").alias("primeira_execucao_inventario"),
        F.max("inventory_timestamp").alias("ultima_execucao_inventario"),
    )


def invitations_summary(invitations: DataFrame) -> DataFrame:
    return monthly_summary(
        invitations,
        "invitation_year",
        "invitation_month",
        "invitation_year_month",
        {"total_invitations": _rows(), "invitations_with_message": count_if("has_message")},
        by=["direction"],
    )


def job_applications_summary(applications: DataFrame) -> DataFrame:
    return monthly_summary(
        applications,
        "application_year",
        "application_month",
        "application_year_month",
        {
            "total_applications": _rows(),
            "unique_companies": F.countDistinct("company_name_clean"),
            "applications_with_resume": count_if("has_resume"),
            "applications_with_questionnaire": count_if("has_questionnaire"),
        },
        by=["job_family"],
    )


def languages_summary(languages: DataFrame) -> DataFrame:
    return languages.groupBy("proficiency_track").agg(
        _rows().alias("total_languages"), F.countDistinct("language_name_clean").alias("unique_languages")
    )


def learning_summary(learning: DataFrame) -> DataFrame:
    return learning.groupBy("content_type_clean").agg(
        _rows().alias("total_contents"),
        count_if("is_completed").alias("completed_contents"),
        count_if("content_saved").alias("saved_contents"),
        count_if("has_notes").alias("contents_with_notes"),
    )


def profile_summary(profile: DataFrame) -> DataFrame:
    return profile.select(
        "first_name",
        "last_name",
        "headline",
        "industry",
        "geo_location",
        "profile_track",
        "summary_length",
        "summary_size_category",
        "primary_contact_url",
        "primary_contact_label",
        "portfolio_website",
    )


def recommendations_summary(recommendations: DataFrame) -> DataFrame:
    return recommendations.agg(
        _rows().alias("total_recommendations"),
        F.avg("text_length").alias("avg_text_length"),
        F.sum("mentions_data").alias("mentions_data_count"),
        F.sum("mentions_teamwork").alias("mentions_teamwork_count"),
        F.min("recommendation_date").alias("first_recommendation_date"),
        F.max("recommendation_date").alias("last_recommendation_date"),
    )


def recommendations_timeline(recommendations: DataFrame) -> DataFrame:
    dated = recommendations.where(F.col("recommendation_date").isNotNull()).withColumns(
        {
            "recommendation_year": dates.year_of("recommendation_date"),
            "recommendation_month": dates.month_of("recommendation_date"),
        }
    )
    return monthly_summary(
        dated,
        "recommendation_year",
        "recommendation_month",
        "recommendation_year_month",
        {
            "total_recommendations": _rows(),
            "avg_text_length": F.avg("text_length"),
            "mentions_data_count": F.sum("mentions_data"),
            "mentions_teamwork_count": F.sum("mentions_teamwork"),
        },
    )


def saved_job_alerts_summary(alerts: DataFrame) -> DataFrame:
    known = alerts.withColumn("alert_frequency", F.coalesce("alert_frequency", F.lit("unknown")))
    return known.groupBy("alert_frequency").agg(
        _rows().alias("total_alerts"),
        F.countDistinct("search_keywords").alias("unique_keyword_sets"),
        count_if("has_remote_filter").alias("remote_alerts"),
        count_if("has_company_filter").alias("company_scoped_alerts"),
    )


def skills_summary(skills: DataFrame) -> DataFrame:
    return skills.groupBy("skill_category").agg(
        _rows().alias("total_skills"),
        F.countDistinct("skill_name_clean").alias("unique_skills"),
        F.round(F.avg("skill_name_length"), 2).alias("avg_skill_name_length"),
    )


def volunteering_summary(volunteering: DataFrame) -> DataFrame:
    return volunteering.groupBy("cause_clean").agg(
        _rows().alias("total_volunteering_roles"),
        F.countDistinct("company_name_clean").alias("unique_organizations"),
        count_if("is_current_volunteering").alias("current_roles"),
        F.round(F.avg("duration_months"), 2).alias("avg_duration_months"),
    )


# Counter column of the health mart -> table it counts.
HEALTH_COUNTERS = {
    "total_connections": "connections",
    "total_positions": "positions",
    "total_education_records": "education",
    "total_certifications": "certifications",
    "total_languages": "languages",
    "total_endorsements": "endorsement_received_info",
    "total_company_follows": "company_follows",
    "total_recommendations": "recommendations_received",
    "total_skills": "skills",
    "total_invitations": "invitations",
    "total_events": "events",
    "total_learning_records": "learning",
    "total_job_applications": "job_applications",
    "total_saved_job_alerts": "saved_job_alerts",
    "total_volunteering": "volunteering",
    "total_email_addresses": "email_addresses",
    "total_phone_numbers": "phone_numbers",
}


def load_health_summary(inventory: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row: inventory totals and the row count of every domain table.

    All counts are single-row aggregates in one union; nothing is joined.
    """
    reads = inventory.agg(
        _rows().alias("total_inventory_files"),
        count_if("read_success").alias("successful_reads"),
        count_if(~F.col("read_success")).alias("failed_reads"),
        F.max("inventory_timestamp").alias("latest_inventory_timestamp"),
    )
    counts = counts_as_columns({counter: tables[name] for counter, name in HEALTH_COUNTERS.items()})
    return one_row(reads, counts)


# Marts of a single enriched model: name -> (model, builder).
SUMMARIES: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "career_progression": ("positions", career_progression),
    "certifications_summary": ("certifications", certifications_summary),
    "company_follows_summary": ("company_follows", company_follows_summary),
    "connections_summary": ("connections", connections_summary),
    "education_summary": ("education", education_summary),
    "endorsement_received_info_summary": ("endorsement_received_info", endorsements_summary),
    "events_summary": ("events", events_summary),
    "file_inventory_summary": ("file_inventory", file_inventory_summary),
    "invitations_summary": ("invitations", invitations_summary),
    "job_applications_summary": ("job_applications", job_applications_summary),
    "languages_summary": ("languages", languages_summary),
    "learning_summary": ("learning", learning_summary),
    "profile_summary": ("profile", profile_summary),
    "recommendations_received_summary": ("recommendations_received", recommendations_summary),
    "recommendations_received_timeline": ("recommendations_received", recommendations_timeline),
    "saved_job_alerts_summary": ("saved_job_alerts", saved_job_alerts_summary),
    "skills_summary": ("skills", skills_summary),
    "volunteering_summary": ("volunteering", volunteering_summary),
}
