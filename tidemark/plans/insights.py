"""The dashboard questions, each as one DataFrame over the models.

Rankings use TakeOrderedAndProject; overviews are single aggregates; "best
month" questions keep the later month among ties.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates, lexicon, text
from tidemark.functions.numeric import count_if, safe_ratio
from tidemark.operators.aggregates import best_group, counts_by, labelled_counts, latest_n, one_row, top_k
from tidemark.plans.marts import HEALTH_COUNTERS
from tidemark.plans.models import Models

# Domain label -> tables counted under it.
DOMAINS = {
    "connections": ("connections",),
    "positions": ("positions",),
    "education": ("education",),
    "certifications": ("certifications",),
    "languages": ("languages",),
    "endorsements": ("endorsement_received_info",),
    "company_follows": ("company_follows",),
    "recommendations": ("recommendations_received",),
    "skills": ("skills",),
    "invitations": ("invitations",),
    "events": ("events",),
    "learning": ("learning",),
    "job_applications": ("job_applications",),
    "job_alerts": ("saved_job_alerts",),
    "volunteering": ("volunteering",),
    "contact_points": ("email_addresses", "phone_numbers"),
}


def _rows(alias: str):
    return F.count(F.lit(1)).alias(alias)


def for_display(df: DataFrame, titled: Sequence[str] = ()) -> DataFrame:
    """Classified columns by their display labels, the ``titled`` ones in title case."""
    labelled = {c: text.display_label(c, labels) for c, labels in lexicon.DISPLAY_LABELS.items() if c in df.columns}
    return df.withColumns(labelled | {c: text.title_case(c) for c in titled if c in df.columns})


# --- health ------------------------------------------------------------------


def files_by_status(m: Models) -> DataFrame:
    mart = m.mart("file_inventory_summary")
    return mart.groupBy("export_type", "status_leitura").agg(
        F.sum("total_arquivos").alias("total_arquivos"), F.sum("total_linhas").alias("total_linhas")
    )


def domain_ranking(m: Models, k: int | None = 10) -> DataFrame:
    counted = labelled_counts({label: [m.countable(t) for t in tables] for label, tables in DOMAINS.items()})
    ranked = counted.orderBy(F.desc("total_records"), "domain_name")
    return ranked if k is None else ranked.limit(k)


def coverage_total(m: Models) -> DataFrame:
    """Analysable records over all domains."""
    counters = [F.coalesce(F.col(name), F.lit(0)) for name in HEALTH_COUNTERS]
    total = reduce(lambda a, b: a + b, counters).alias("coverage_total")
    return m.mart("pipeline_health_summary").select(total)


def export_totals(m: Models) -> DataFrame:
    """Files, rows and the share of readable files (in percent) per export type."""
    mart = m.mart("file_inventory_summary")
    readable = F.sum(F.when(F.col("status_leitura") == "ok", F.col("total_arquivos")).otherwise(0))
    grouped = mart.groupBy("export_type").agg(
        F.sum("total_arquivos").alias("total_arquivos"),
        F.coalesce(F.sum("total_linhas"), F.lit(0)).alias("total_linhas"),
        readable.alias("readable"),
    )
    rate = F.round(safe_ratio("readable", "total_arquivos") * 100, 2)
    return grouped.select("export_type", "total_arquivos", "total_linhas", rate.alias("success_rate"))


# --- network -----------------------------------------------------------------


def top_connection_companies(m: Models, k: int = 10) -> DataFrame:
    return top_k(m.enriched("connections"), "company_clean", "total_connections", k)


def top_connection_positions(m: Models, k: int = 10) -> DataFrame:
    return top_k(m.enriched("connections"), "position_clean", "total_connections", k)


def connections_overview(m: Models) -> DataFrame:
    return m.enriched("connections").agg(
        _rows("total_connections"),
        count_if("has_email").alias("total_with_email"),
        F.countDistinct("company_clean").alias("total_unique_companies"),
        F.countDistinct("position_clean").alias("total_unique_positions"),
    )


CONNECTION_DETAIL = (
    "full_name",
    "company",
    "position",
    "email_address",
    "connected_on",
    "connection_year_month",
    "has_email",
)


def latest_connections(m: Models, n: int = 200) -> DataFrame:
    """Newest first; the remaining columns decide among connections of the same day."""
    detail = m.enriched("connections").select(*CONNECTION_DETAIL, "profile_url")
    ties = [F.asc_nulls_last(c) for c in ("full_name", "company", "position", "email_address", "profile_url")]
    return latest_n(detail, [F.desc_nulls_last("connected_on"), *ties], n).select(*CONNECTION_DETAIL)


def home_overview(m: Models) -> DataFrame:
    """Totals over the months, and beside the monthly maxima also the exact distinct counts."""
    monthly = m.mart("connections_summary").agg(
        F.sum("total_connections").alias("total_connections"),
        F.sum("connections_with_email").alias("connections_with_email"),
        F.max("unique_companies").alias("unique_companies"),
        F.max("unique_positions").alias("unique_positions"),
    )
    exact = m.enriched("connections").agg(
        F.countDistinct("company_clean").alias("distinct_companies"),
        F.countDistinct("position_clean").alias("distinct_positions"),
    )
    return one_row(monthly, exact)


def top_email_share_months(m: Models, k: int = 10) -> DataFrame:
    share = safe_ratio("connections_with_email", "total_connections").alias("email_share")
    mart = m.mart("connections_summary").where(F.col("connection_year_month").isNotNull())
    rated = mart.select("connection_year_month", "total_connections", "connections_with_email", share)
    return rated.orderBy(F.desc("email_share"), F.desc("connection_year_month")).limit(k)


# --- career, education, certifications, languages ------------------------------


def career_overview(m: Models) -> DataFrame:
    return m.enriched("positions").agg(
        _rows("total_positions"),
        count_if("is_current").alias("current_positions"),
        F.countDistinct("company_name_clean").alias("unique_companies"),
        F.countDistinct("title_clean").alias("unique_titles"),
        F.avg("duration_months").alias("avg_duration_months"),
    )


def top_employers(m: Models, k: int = 10) -> DataFrame:
    return top_k(m.enriched("positions"), "company_name_clean", "total_positions", k)


def top_titles(m: Models, k: int = 10) -> DataFrame:
    return top_k(m.enriched("positions"), "title_clean", "total_positions", k)


def education_overview(m: Models) -> DataFrame:
    return m.enriched("education").agg(
        _rows("total_education_records"),
        count_if("is_current_education").alias("current_education_records"),
        F.countDistinct("school_name_clean").alias("total_unique_schools"),
        F.countDistinct("degree_name_clean").alias("total_unique_degrees"),
        F.avg("education_duration_months").alias("avg_education_duration_months"),
    )


def top_schools(m: Models, k: int = 10) -> DataFrame:
    return top_k(m.enriched("education"), "school_name_clean", "total_records", k)


def education_tracks(m: Models) -> DataFrame:
    return counts_by(m.enriched("education"), "education_track", "total_records")


def certification_overview(m: Models) -> DataFrame:
    return m.enriched("certifications").agg(
        _rows("total_certification_records"),
        F.countDistinct("name_clean").alias("total_unique_certifications"),
        F.countDistinct("authority_clean").alias("total_unique_authorities"),
        F.avg("certification_duration_months").alias("avg_certification_duration_months"),
    )


def top_authorities(m: Models, k: int = 10) -> DataFrame:
    return top_k(m.enriched("certifications"), "authority_clean", "total_records", k)


def certification_tracks(m: Models) -> DataFrame:
    return counts_by(m.enriched("certifications"), "certification_track", "total_records")


def language_overview(m: Models) -> DataFrame:
    return m.enriched("languages").agg(
        _rows("total_language_records"),
        F.countDistinct("language_name_clean").alias("total_unique_languages"),
        F.countDistinct("proficiency_clean").alias("total_unique_proficiencies"),
    )


def language_distribution(m: Models) -> DataFrame:
    return counts_by(m.enriched("languages"), "language_name_clean", "total_records")


# --- endorsements, follows, recommendations, skills ----------------------------


def endorsement_overview(m: Models) -> DataFrame:
    return m.mart("endorsement_received_info_summary").agg(
        F.count("skill_name_clean").alias("total_skills"),
        F.sum("endorsement_count").alias("total_endorsements"),
        F.sum("unique_endorsers").alias("total_unique_endorsers"),
        F.min("first_endorsement_date").alias("first_endorsement"),
        F.max("last_endorsement_date").alias("last_endorsement"),
    )


def endorsement_statuses(m: Models) -> DataFrame:
    return counts_by(m.enriched("endorsement_received_info"), "endorsement_status_group", "total")


def endorsement_months(m: Models) -> DataFrame:
    dated = m.enriched("endorsement_received_info").where(F.col("endorsement_date").isNotNull())
    month = F.trunc("endorsement_date", "month").alias("month")
    grouped = dated.groupBy(month).agg(_rows("total_endorsements"))
    return grouped.select(dates.year_month("month").alias("year_month"), "total_endorsements")


def best_endorsement_month(m: Models) -> DataFrame:
    return best_group(endorsement_months(m), "year_month", "total_endorsements", "best_month", "best_month_total")


def top_endorsed_skills(m: Models, k: int = 10) -> DataFrame:
    mart = m.mart("endorsement_received_info_summary")
    return mart.orderBy(F.desc("endorsement_count"), F.asc_nulls_last("skill_name_clean")).limit(k)


def follow_overview(m: Models) -> DataFrame:
    return m.mart("company_follows_summary").agg(
        F.count("organization_clean").alias("total_companies"),
        F.sum("follow_count").alias("total_follows"),
        F.min("first_follow_date").alias("first_follow"),
        F.max("last_follow_date").alias("last_follow"),
    )


def top_followed(m: Models, k: int = 10) -> DataFrame:
    mart = m.mart("company_follows_summary")
    return mart.orderBy(F.desc("follow_count"), F.asc_nulls_last("organization_clean")).limit(k)


def follow_months(m: Models) -> DataFrame:
    dated = m.enriched("company_follows").where(F.col("followed_on").isNotNull())
    grouped = dated.groupBy("year", "month").agg(_rows("total_follows"))
    return grouped.select(dates.year_month_from_parts("year", "month").alias("year_month"), "total_follows")


def best_follow_month(m: Models) -> DataFrame:
    return best_group(follow_months(m), "year_month", "total_follows", "best_month", "best_month_total")


def recommendation_visibility(m: Models) -> DataFrame:
    return counts_by(m.enriched("recommendations_received"), "visibility", "total_recommendations")


def recommendation_themes(m: Models) -> DataFrame:
    """Dominant theme over all recommendations and the month with most of them."""
    data, team = F.col("mentions_data_count"), F.col("mentions_teamwork_count")
    theme = (
        F.when(data > team, F.lit("data"))
        .when(team > data, F.lit("teamwork"))
        .otherwise(F.lit("equilíbrio entre data e teamwork"))
    )
    summary = m.mart("recommendations_received_summary").select(
        "mentions_data_count", "mentions_teamwork_count", theme.alias("dominant_theme")
    )
    timeline = m.mart("recommendations_received_timeline")
    peak = best_group(
        timeline, "recommendation_year_month", "total_recommendations", "peak_month", "peak_month_total"
    )
    return one_row(summary, peak)


def skills_overview(m: Models) -> DataFrame:
    totals = m.enriched("skills").agg(
        _rows("total_skills"), F.countDistinct("skill_name_clean").alias("unique_skills")
    )
    # Most skills first, then the alphabetically first category.
    ranked = F.min(F.struct((-F.col("total_skills")).alias("n"), F.col("skill_category")))
    top = m.mart("skills_summary").agg(ranked.alias("top")).select(F.col("top.skill_category").alias("top_category"))
    return one_row(totals, top)


# --- engagement, learning, jobs, profile ---------------------------------------


def invitations_by_direction(m: Models) -> DataFrame:
    mart = m.mart("invitations_summary")
    return mart.groupBy("direction").agg(F.sum("total_invitations").alias("total_invitations"))


def events_by_status(m: Models) -> DataFrame:
    return m.mart("events_summary").groupBy("status").agg(F.sum("total_events").alias("total_events"))


def saved_contents(m: Models) -> DataFrame:
    saved = m.enriched("learning").where("content_saved").select("content_title", "content_type", "last_watched_at")
    return saved.orderBy(*order_keys(("content_title",), saved.columns))


def learning_overview(m: Models) -> DataFrame:
    learning = m.enriched("learning").agg(
        _rows("total_contents"),
        count_if("is_completed").alias("completed_contents"),
        count_if("content_saved").alias("saved_contents"),
    )
    rate = F.round(safe_ratio("completed_contents", "total_contents") * 100, 2)
    return learning.withColumn("completion_rate", rate)


def applications_by_family(m: Models) -> DataFrame:
    mart = m.mart("job_applications_summary")
    return mart.groupBy("job_family").agg(F.sum("total_applications").alias("total_applications"))


def applications_overview(m: Models) -> DataFrame:
    return one_row(
        m.enriched("job_applications").agg(
            _rows("total_applications"), F.countDistinct("company_name_clean").alias("unique_companies")
        ),
        m.enriched("saved_job_alerts").agg(_rows("total_alerts")),
    )


def profile_detail(m: Models) -> DataFrame:
    return m.enriched("profile").select(
        "first_name",
        "last_name",
        "maiden_name",
        "address",
        "birth_date",
        "headline",
        "summary",
        "industry",
        "zip_code",
        "geo_location",
        "twitter_handles",
        "websites",
        "primary_contact_url",
        "primary_contact_label",
        "portfolio_website",
        "instant_messengers",
        "profile_track",
        "summary_length",
        "summary_size_category",
    )


# Detail tables: model -> (columns or None for all, order; a leading "-" means descending).
DETAILS: dict[str, tuple[tuple[str, ...] | None, tuple[str, ...]]] = {
    "positions": (
        (
            "company_name",
            "title",
            "location",
            "started_on",
            "finished_on",
            "is_current",
            "duration_months",
            "career_track",
        ),
        ("-started_on",),
    ),
    "education": (
        (
            "school_name",
            "degree_name",
            "notes",
            "started_on",
            "finished_on",
            "is_current_education",
            "education_duration_months",
            "education_track",
        ),
        ("-started_on",),
    ),
    "certifications": (
        (
            "name",
            "authority",
            "url",
            "started_on",
            "finished_on",
            "license_number",
            "certification_duration_months",
            "certification_track",
        ),
        ("-started_on",),
    ),
    "invitations": (None, ("-sent_at",)),
    "events": (None, ("-started_at",)),
    "volunteering": (None, ("-started_on",)),
    "learning": (None, ("-completed_at", "-last_watched_at")),
    "job_applications": (None, ("-application_date",)),
    "saved_job_alerts": (None, ("saved_search_id",)),
    "skills": (None, ("skill_category", "skill_name")),
    "recommendations_received": (
        (
            "recommender_name",
            "company",
            "position",
            "recommendation_date",
            "visibility",
            "text_length",
            "mentions_data",
            "mentions_teamwork",
            "recommendation_text",
        ),
        ("-recommendation_date",),
    ),
    "endorsement_received_info": (None, ("-endorsement_date",)),
    "company_follows": (None, ("-followed_on",)),
    "languages": (None, ("language_name_clean",)),
}


def order_keys(names: Sequence[str], columns: Sequence[str] = ()) -> list[Column]:
    """Columns as sort keys with NULLs last either way, the remaining ``columns`` as tie-breaks.

    The tie-breaks make the order definite, and they let the range partitioning
    of the sort split a day or title that holds a large share of the rows.
    """
    keys = [F.desc_nulls_last(n[1:]) if n.startswith("-") else F.asc_nulls_last(n) for n in names]
    return keys + [F.asc_nulls_last(c) for c in columns if c not in names and f"-{c}" not in names]


def detail(m: Models, table: str) -> DataFrame:
    columns, order = DETAILS[table]
    df = m.enriched(table)
    df = df if columns is None else df.select(*columns)
    return df.orderBy(*order_keys(order, df.columns))
