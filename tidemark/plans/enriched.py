"""Enriched models: derived columns on top of staging. Projections only, no shuffle."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates, lexicon, numeric, text


@dataclass(frozen=True)
class Settings:
    """What the models need besides data; dates never depend on the clock when ``as_of`` is set."""

    as_of: dt.date | str | None = None
    portfolio_url: str = "https://example.com/portfolio"

    @property
    def today(self) -> Column:
        return dates.as_of_column(self.as_of)


def _date_parts(source: str, prefix: str) -> dict[str, Column]:
    return {
        f"{prefix}year": dates.year_of(source),
        f"{prefix}month": dates.month_of(source),
        f"{prefix}year_month": dates.year_month(source),
    }


def _period(end: Column, duration: str) -> dict[str, Column]:
    return {"effective_end_date": end, duration: dates.months_between("started_on", end)}


def _add(df: DataFrame, **columns: Column) -> DataFrame:
    return df.withColumns(columns)


def certifications(df: DataFrame, s: Settings) -> DataFrame:
    end = F.coalesce("finished_on", s.today)
    df = _add(
        df,
        name_clean=text.lower_trim_text("name"),
        authority_clean=text.lower_trim_text("authority"),
        **_date_parts("started_on", "start_"),
        **_date_parts("finished_on", "end_"),
        **_period(end, "certification_duration_months"),
    )
    return _add(df, certification_track=text.classify("authority_clean", lexicon.CERTIFICATION_TRACKS, "outros"))


def company_follows(df: DataFrame, s: Settings) -> DataFrame:
    return df.select(
        "organization",
        F.lower("organization").alias("organization_clean"),
        "followed_on",
        *[c.alias(name) for name, c in _date_parts("followed_on", "").items()],
    )


def connections(df: DataFrame, s: Settings) -> DataFrame:
    return _add(
        df,
        has_email=text.is_present("email_address"),
        company_clean=text.lower_trim_text("company"),
        position_clean=text.lower_trim_text("position"),
        **_date_parts("connected_on", "connection_"),
    )


def education(df: DataFrame, s: Settings) -> DataFrame:
    end = F.when(F.col("is_current_education"), s.today).otherwise(F.col("finished_on"))
    df = _add(
        df,
        school_name_clean=text.lower_trim_text("school_name"),
        degree_name_clean=text.lower_trim_text(F.coalesce("degree_name", F.lit(""))),
        **_date_parts("started_on", "start_"),
        **_date_parts("finished_on", "end_"),
        **_period(end, "education_duration_months"),
    )
    return _add(df, education_track=text.classify("degree_name_clean", lexicon.EDUCATION_TRACKS, "outros"))


def endorsement_received_info(df: DataFrame, s: Settings) -> DataFrame:
    first, last = F.col("endorser_first_name"), F.col("endorser_last_name")
    gap = F.when(first.isNotNull() & last.isNotNull(), F.lit(" ")).otherwise(F.lit(""))
    full = F.concat(F.coalesce(F.trim(first), F.lit("")), gap, F.coalesce(F.trim(last), F.lit("")))
    status = F.lower("endorsement_status")
    return df.select(
        "endorsement_date",
        "skill_name",
        F.lower("skill_name").alias("skill_name_clean"),
        "endorser_first_name",
        "endorser_last_name",
        full.alias("endorser_full_name"),
        "endorser_public_url",
        "endorsement_status",
        text.classify(status, lexicon.ENDORSEMENT_STATUSES, "other").alias("endorsement_status_group"),
    )


def events(df: DataFrame, s: Settings) -> DataFrame:
    return _add(df, has_external_url=text.is_present("external_url"), **_date_parts("started_at", "event_"))


def file_inventory(df: DataFrame, s: Settings) -> DataFrame:
    volume = numeric.bucket(
        "row_count", lexicon.ROW_VOLUME_BUCKETS, lexicon.ROW_VOLUME_TOP, lexicon.ROW_VOLUME_UNKNOWN
    )
    folder: Column | None = None
    for name, category in lexicon.FOLDER_CATEGORIES.items():
        test = F.col("folder_name") == name
        folder = F.when(test, F.lit(category)) if folder is None else folder.when(test, F.lit(category))
    return df.select(
        "export_name",
        "export_type",
        "folder_name",
        "file_name",
        "file_stem",
        "row_count",
        "column_count",
        "file_size_kb",
        volume.alias("volume_categoria"),
        # An unknown read state counts as readable.
        F.when(~F.col("read_success"), F.lit("erro")).otherwise(F.lit("ok")).alias("status_leitura"),
        folder.otherwise(F.lit("outros")).alias("categoria_dado"),
        "inventory_timestamp",
    )


def invitations(df: DataFrame, s: Settings) -> DataFrame:
    return _add(df, has_message=text.is_present("message"), **_date_parts("sent_at", "invitation_"))


def job_applications(df: DataFrame, s: Settings) -> DataFrame:
    return _add(
        df,
        company_name_clean=text.lower_trim_text("company_name"),
        job_title_clean=text.lower_trim_text("job_title"),
        has_resume=text.is_present("resume_name"),
        has_questionnaire=text.is_present("question_and_answers"),
        **_date_parts("application_date", "application_"),
        job_family=text.classify(F.lower("job_title"), lexicon.JOB_FAMILIES, "other"),
    )


def languages(df: DataFrame, s: Settings) -> DataFrame:
    df = _add(
        df, language_name_clean=text.lower_trim_text("name"), proficiency_clean=text.lower_trim_text("proficiency")
    )
    return _add(df, proficiency_track=text.classify("proficiency_clean", lexicon.PROFICIENCY_TRACKS, "outros"))


def learning(df: DataFrame, s: Settings) -> DataFrame:
    return _add(
        df,
        content_title_clean=text.lower_trim_text("content_title"),
        content_type_clean=text.lower_trim_text(F.coalesce("content_type", F.lit("outros"))),
        is_completed=text.is_present("completed_at"),
        has_notes=text.is_present("notes_taken"),
        engagement_year_month=dates.year_month(F.coalesce("completed_at", "last_watched_at")),
    )


def positions(df: DataFrame, s: Settings) -> DataFrame:
    end = F.when(F.col("is_current"), s.today).otherwise(F.col("finished_on"))
    df = _add(
        df,
        company_name_clean=text.lower_trim_text("company_name"),
        title_clean=text.lower_trim_text("title"),
        location_clean=text.lower_trim_text(F.coalesce("location", F.lit(""))),
        **_date_parts("started_on", "start_"),
        **_date_parts("finished_on", "end_"),
        **_period(end, "duration_months"),
    )
    return _add(df, career_track=text.classify("title_clean", lexicon.CAREER_TRACKS, "outros"))


def profile(df: DataFrame, s: Settings) -> DataFrame:
    tagged = F.col("websites").startswith("[PERSONAL:")
    inside = F.regexp_extract("websites", r"\[PERSONAL:(.+)\]", 1)
    length = F.char_length("summary").cast("long")
    return _add(
        df,
        first_name_clean=text.lower_trim_text("first_name"),
        last_name_clean=text.lower_trim_text("last_name"),
        industry_clean=text.lower_trim_text(F.coalesce("industry", F.lit(""))),
        primary_contact_url=F.when(tagged, inside).otherwise(text.nullif_trim_text("websites")),
        primary_contact_label=F.when(tagged, F.lit("WhatsApp")).otherwise(F.lit("Website")),
        portfolio_website=F.lit(s.portfolio_url),
        profile_track=text.classify(F.lower("headline"), lexicon.PROFILE_TRACKS, "outros"),
        summary_length=length,
        summary_size_category=numeric.bucket(
            length, lexicon.SUMMARY_BUCKETS, lexicon.SUMMARY_TOP, lexicon.SUMMARY_UNKNOWN
        ),
    )


def recommendations_received(df: DataFrame, s: Settings) -> DataFrame:
    return df.select(
        "first_name",
        "last_name",
        # A missing part is skipped here, unlike in the connection's full name.
        F.concat_ws("", "first_name", F.lit(" "), "last_name").alias("recommender_name"),
        "company",
        "position",
        "recommendation_text",
        "recommendation_date",
        "visibility",
        F.char_length("recommendation_text").cast("long").alias("text_length"),
        text.mention_count_flag("recommendation_text", "data").alias("mentions_data"),
        text.mention_count_flag("recommendation_text", "team").alias("mentions_teamwork"),
    )


def saved_job_alerts(df: DataFrame, s: Settings) -> DataFrame:
    return df.select(
        "saved_search_id",
        "alert_parameters",
        "query_context",
        text.extract_or_null("query_context", r"keywords=([^,}]+)").alias("search_keywords"),
        F.lower(text.extract_or_null("alert_parameters", r"frequency=([A-Z]+)")).alias("alert_frequency"),
        text.mentions("query_context", "workplacetype:2").alias("has_remote_filter"),
        text.mentions("query_context", "organizations=").alias("has_company_filter"),
    )


def skills(df: DataFrame, s: Settings) -> DataFrame:
    return _add(
        df,
        skill_name_clean=text.lower_trim_text("skill_name"),
        skill_name_length=F.char_length("skill_name").cast("long"),
        skill_category=text.classify(F.lower("skill_name"), lexicon.SKILL_CATEGORIES, "other"),
    )


def volunteering(df: DataFrame, s: Settings) -> DataFrame:
    end = F.coalesce("finished_on", s.today)
    return _add(
        df,
        company_name_clean=text.lower_trim_text("company_name"),
        role_clean=text.lower_trim_text("role"),
        cause_clean=text.lower_trim_text(F.coalesce("cause", F.lit("sem_causa"))),
        **_period(end, "duration_months"),
    )


ENRICHERS: dict[str, Callable[[DataFrame, Settings], DataFrame]] = {
    f.__name__: f
    for f in (
        certifications,
        company_follows,
        connections,
        education,
        endorsement_received_info,
        events,
        file_inventory,
        invitations,
        job_applications,
        languages,
        learning,
        positions,
        profile,
        recommendations_received,
        saved_job_alerts,
        skills,
        volunteering,
    )
}


def enrich(table: str, staged: DataFrame, settings: Settings | None = None) -> DataFrame:
    return ENRICHERS[table](staged, settings or Settings())
