"""Queries for the models: cleaned tables, staging, enriched, marts, history, dashboards."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.binding.oracle_models import COUNTED, CREATED_AT, RUN_ID, count_where
from tidemark.binding.registry import Context, query, register
from tidemark.plans import history, insights
from tidemark.plans.bronze import EXPORT_TABLES

RUN = history.Run(RUN_ID, dt.datetime.fromisoformat(CREATED_AT))

# --- B20-B38: raw export text to cleaned tables -------------------------------

_WS = "' ' || chr(9) || chr(10) || chr(13) || chr(160)"


def _strip(header: str) -> str:
    return f'trim("{header}", {_WS})'


def _clean(header: str) -> str:
    return f"nullif(nullif(nullif({_strip(header)}, ''), 'nan'), 'None')"


def _mixed(header: str) -> str:
    shapes = "['%Y-%m-%d', '%Y-%m-%dT%H:%M:%S', '%d %b %Y', '%b %d, %Y', '%m/%d/%y, %I:%M %p']"
    return f"try_strptime({_strip(header)}, {shapes})"


def _us(header: str) -> str:
    return f"try_strptime(\"{header}\", '%m/%d/%y, %I:%M %p')"


def _flag(header: str) -> str:
    word = f"lower({_strip(header)})"
    return (
        f"case when {word} in ('yes', 'true', '1', 'y', 'sim') then true "
        f"when {word} in ('no', 'false', '0', 'n', 'nao', 'não') then false end"
    )


Pairs = tuple[tuple[str, str], ...]


def _cleaned(
    table: str, text: Pairs = (), mixed: Pairs = (), us: Pairs = (), flags: Pairs = (), more: str = "", keep: tuple[str, ...] = (), distinct: bool = False
) -> str:
    """(column, header) pairs become cleaned columns; rows without ``keep`` columns go."""
    columns = []
    for pairs, form in ((text, _clean), (mixed, _mixed), (us, _us), (flags, _flag)):
        for out, header in pairs:
            columns.append(f'{form(header)} as "{out}"')
    if more:
        columns.append(more)
    rows = f"select {', '.join(columns)} from raw_{table}"
    where = " and ".join(f"{name} is not null" for name in keep) or "true"
    return f"select {'distinct ' if distinct else ''}* from ({rows}) c where {where}"


_NAMES = (("first_name", "First Name"), ("last_name", "Last Name"))
_PERIOD = (("started_on", "Started On"), ("finished_on", "Finished On"))

CLEANED = {
    "connections": _cleaned(
        "connections",
        text=(*_NAMES, ("url", "URL"), ("email_address", "Email Address"), ("company", "Company"), ("position", " Position ")),
        mixed=(("connected_on", "Connected On"),),
    ),
    "positions": f"""select *, finished_on is null as is_current from ({_cleaned(
        "positions",
        text=(("company_name", "Company Name"), ("title", "Title"), ("description", "Description"), ("location", "Location")),
        mixed=_PERIOD,
    )}) t""",
    "profile": _cleaned(
        "profile",
        text=(
            *_NAMES, ("maiden_name", "Maiden Name"), ("address", "Address"), ("headline", "Headline"), ("summary", "Summary"),
            ("industry", "Industry"), ("zip_code", "Zip Code"), ("geo_location", "Geo Location"),
            ("twitter_handles", "Twitter Handles"), ("websites", "Websites"),
        ),
        mixed=(("birth_date", "Birth Date"),),
        more="cast(null as varchar) as instant_messengers",
    ),
    "languages": _cleaned("languages", text=(("name", "Name"), ("proficiency", "Proficiency"))),
    "education": f"""select *, finished_on is null as is_current_education from ({_cleaned(
        "education",
        text=(("school_name", "School"), ("degree_name", "Degree"), ("notes", "Description")),
        mixed=(("started_on", "Started"), ("finished_on", "End Date")),
    )}) t""",
    "certifications": _cleaned(
        "certifications",
        text=(("name", "Name"), ("url", "Url"), ("authority", "Authority"), ("license_number", "License Number")),
        mixed=_PERIOD,
    ),
    "endorsement_received_info": _cleaned(
        "endorsement_received_info",
        text=(
            ("skill_name", "Skill Name"), ("endorser_first_name", "Endorser First Name"),
            ("endorser_last_name", "Endorser Last Name"), ("endorser_public_url", "Endorser Public Url"),
            ("endorsement_status", "Endorsement Status"),
        ),
        mixed=(("endorsement_date", "Endorsement Date"),),
        keep=("skill_name",),
        distinct=True,
    ),
    "company_follows": _cleaned(
        "company_follows",
        text=(("organization", "Organization"),),
        mixed=(("followed_on", "Followed On"),),
        keep=("organization",),
        distinct=True,
    ),
    "recommendations_received": _cleaned(
        "recommendations_received",
        text=(*_NAMES, ("company", "Company"), ("position", "Job Title"), ("recommendation_text", "Text"), ("visibility", "Status")),
        us=(("recommendation_date", "Creation Date"),),
        keep=("recommendation_text",),
        distinct=True,
    ),
    "skills": _cleaned("skills", text=(("skill_name", "Name"),), keep=("skill_name",), distinct=True),
    "phone_numbers": _cleaned(
        "phone_numbers",
        text=(("extension", "Extension"), ("phone_number", "Number"), ("phone_type", "Type")),
        keep=("phone_number",),
        distinct=True,
    ),
    "email_addresses": _cleaned(
        "email_addresses",
        text=(("email_address", "Email Address"),),
        flags=(("confirmed", "Confirmed"), ("primary", "Primary")),
        more="nullif(\"Updated On\", 'Not Available') as updated_on",
        keep=("email_address",),
        distinct=True,
    ),
    "registration": _cleaned(
        "registration",
        text=(("registration_ip", "Registration Ip"), ("subscription_types", "Subscription Types")),
        us=(("registered_at", "Registered At"),),
    ),
    "saved_job_alerts": _cleaned(
        "saved_job_alerts",
        text=(("alert_parameters", "Alert Parameters"), ("query_context", "Query Context"), ("saved_search_id", "Saved Search ID")),
        keep=("saved_search_id",),
        distinct=True,
    ),
    "volunteering": f"""select *, finished_on is null as is_current_volunteering from ({_cleaned(
        "volunteering",
        text=(("company_name", "Company Name"), ("role", "Role"), ("cause", "Cause"), ("description", "Description")),
        mixed=_PERIOD,
        keep=("company_name", "role"),
        distinct=True,
    )}) t""",
    "invitations": _cleaned(
        "invitations",
        text=(
            ("sender_name", "From"), ("recipient_name", "To"), ("message", "Message"), ("direction", "Direction"),
            ("inviter_profile_url", "inviterProfileUrl"), ("invitee_profile_url", "inviteeProfileUrl"),
        ),
        us=(("sent_at", "Sent At"),),
        keep=("sender_name", "recipient_name", "direction"),
        distinct=True,
    ),
    "events": f"""
        select *, try_strptime(split_part(event_time, ' - ', 1), '%b %d, %Y %I:%M %p') as started_at,
            try_strptime(split_part(event_time, ' - ', 2), '%b %d, %Y %I:%M %p') as finished_at
        from ({_cleaned(
            "events",
            text=(("event_name", "Event Name"), ("event_time", "Event Time"), ("status", "Status"), ("external_url", "External Url")),
            keep=("event_name",),
            distinct=True,
        )}) t""",
    "learning": _cleaned(
        "learning",
        text=(
            ("content_title", "Content Title"), ("content_description", "Content Description"), ("content_type", "Content Type"),
            ("notes_taken", "Notes taken on videos (if taken)"),
        ),
        mixed=(("last_watched_at", "Content Last Watched Date (if viewed)"), ("completed_at", "Content Completed At (if completed)")),
        flags=(("content_saved", "Content Saved"),),
        keep=("content_title",),
        distinct=True,
    ),
    "job_applications": _cleaned(
        "job_applications",
        text=(
            ("contact_email", "Contact Email"), ("contact_phone_number", "Contact Phone Number"),
            ("company_name", "Company Name"), ("job_title", "Job Title"), ("job_url", "Job Url"), ("resume_name", "Resume Name"),
            ("question_and_answers", "Question And Answers"),
        ),
        us=(("application_date", "Application Date"),),
        keep=("company_name", "job_title"),
        distinct=True,
    ),
}


def _register_cleaned() -> None:
    for number, key in enumerate(EXPORT_TABLES, start=20):
        register(f"b{number}_{key}", lambda c, k=key: EXPORT_TABLES[k].recipe(c.raw(k)), CLEANED[key])


# --- E, F, G -------------------------------------------------------------------

STAGING_ORDER = (
    "certifications",
    "company_follows",
    "connections",
    "education",
    "email_addresses",
    "endorsement_received_info",
    "events",
    "file_inventory",
    "ingestion_audit",
    "invitations",
    "job_applications",
    "languages",
    "learning",
    "phone_numbers",
    "positions",
    "profile",
    "recommendations_received",
    "registration",
    "saved_job_alerts",
    "skills",
    "volunteering",
)
ENRICHED_ORDER = tuple(
    t for t in STAGING_ORDER if t not in ("email_addresses", "ingestion_audit", "phone_numbers", "registration")
)
MART_ORDER = (
    ("g1", "career_progression", "career_progression"),
    ("g2", "certifications_summary", "certifications_summary"),
    ("g3", "company_follows_summary", "company_follows_summary"),
    ("g4", "connections_summary", "connections_summary"),
    ("g5", "contact_account_summary", "contact_account_summary"),
    ("g6", "education_summary", "education_summary"),
    ("g7", "endorsement_received_info_summary", "endorsement_received_info_summary"),
    ("g8", "events_summary", "events_summary"),
    ("g9", "file_inventory_summary", "file_inventory_summary"),
    ("g10", "invitations_summary", "invitations_summary"),
    ("g11", "job_applications_summary", "job_applications_summary"),
    ("g12", "languages_summary", "languages_summary"),
    ("g13", "learning_summary", "learning_summary"),
    ("g14", "profile_summary", "profile_summary"),
    ("g15", "recommendations_received_summary", "recommendations_received_summary"),
    ("g16", "recommendations_received_timeline", "recommendations_received_timeline"),
    ("g17", "saved_job_alerts_summary", "saved_job_alerts_summary"),
    ("g18", "skills_summary", "skills_summary"),
    ("g19", "volunteering_summary", "volunteering_summary"),
    ("g20", "health_summary", "pipeline_health_summary"),
    ("g21", "health_timeline", "ingestion_audit_health_timeline"),
    ("g22", "null_rate_timeline", "ingestion_audit_null_rate_timeline"),
)


def _register_models() -> None:
    for number, table in enumerate(STAGING_ORDER, start=1):
        register(f"e{number}_staged_{table}", lambda c, t=table: c.models.staged(t), f"select * from stg_{table}")
    for number, table in enumerate(ENRICHED_ORDER, start=1):
        register(f"f{number}_enriched_{table}", lambda c, t=table: c.models.enriched(t), f"select * from int_{table}")
    for number, short, mart in MART_ORDER:
        register(f"{number}_{short}", lambda c, m=mart: c.models.mart(m), f"select * from mart_{short}")


# --- N: history ------------------------------------------------------------------

ROUNDED = (
    "presence_score",
    "engagement_score",
    "career_maturity_score",
    "avg_position_duration_cumulative",
    "avg_education_duration_cumulative",
    "avg_certification_duration_cumulative",
    "avg_null_rate_before_transform",
    "avg_null_rate_after_transform",
    "avg_null_rate_delta",
)


def fact(c: Context, name: str) -> DataFrame:
    """A history fact with its floating-point sums rounded for comparison."""
    df = c.models.history(f"fact_snapshot_{name}", RUN)
    return df.withColumns({n: F.round(n, 6) for n in ROUNDED if n in df.columns})


def _register_history() -> None:
    names = ("network_growth", "applications", "presence", "career_education", "data_quality")
    for number, name in enumerate(names, start=1):
        register(f"n{number}_{name}_history", lambda c, n=name: fact(c, n), f"select * from fact_{name}")


@query(
    "n5_data_quality_from_audit",
    f"""select '{RUN_ID}' as snapshot_run_id, cast(loaded_at_utc as date) as snapshot_date,
        strftime(loaded_at_utc, '%Y-%m') as snapshot_year_month, table_key, export_type,
        cast(null as bigint) as source_row_count, row_count as row_count_after_transform,
        cast(null as bigint) as rows_removed_during_transform, duplicate_rows_after_transform,
        cast(null as double) as row_retention_rate,
        if(duplicate_rows_after_transform > 0, 'atencao', 'saudavel') as health_status,
        duplicate_rows_after_transform > 0 as duplicate_alert_flag, false as row_removal_alert_flag,
        1 as successful_load_flag, cast(null as bigint) as monitored_columns_count,
        cast(null as double) as avg_null_rate_before_transform, cast(null as double) as avg_null_rate_after_transform,
        cast(null as double) as avg_null_rate_delta, cast(null as bigint) as null_rate_alert_count,
        false as is_simulated_snapshot, 'actual_pipeline_audit' as snapshot_method,
        'bronze.ingestion_audit' as snapshot_source, timestamp '{CREATED_AT}' as snapshot_created_at
    from bronze_ingestion_audit""",
)
def data_quality_from_audit(c: Context) -> DataFrame:
    return history.data_quality_from_audit(c.models.bronze("ingestion_audit"), RUN)


@query(
    "n8_history_row_counts",
    " union all ".join(
        f"select 'fact_snapshot_{n}' as table_name, count(*) as row_count, max(snapshot_method) as methods from fact_{n}"
        for n in ("network_growth", "applications", "presence", "career_education", "data_quality")
    ),
)
def history_row_counts(c: Context) -> DataFrame:
    names = ("network_growth", "applications", "presence", "career_education", "data_quality")
    return history.summarize({f"fact_snapshot_{n}": c.models.history(f"fact_snapshot_{n}", RUN) for n in names})


# --- O: dashboards ---------------------------------------------------------------


def _top(table: str, key: str, count: str) -> str:
    return (
        f"select {key}, count(*) as {count} from int_{table} where trim({key}) <> '' group by all "
        f"order by {count} desc, {key} limit 10"
    )


def _share(table: str, key: str, count: str) -> str:
    return f"select {key}, count(*) as {count} from int_{table} group by all"


def _domains() -> str:
    parts = []
    for label, tables in insights.DOMAINS.items():
        counts = [
            f"(select count(*) from {'stg' if t in ('email_addresses', 'phone_numbers') else 'int'}_{t})" for t in tables
        ]
        parts.append(f"select '{label}' as domain_name, {' + '.join(counts)} as total_records")
    return " union all ".join(parts)


_ENDORSED = """select strftime(endorsement_date, '%Y-%m') as year_month, count(*) as total_endorsements
    from int_endorsement_received_info where endorsement_date is not null group by all"""
_FOLLOWED = """select year_month, count(*) as total_follows from int_company_follows
    where followed_on is not null group by all"""


def _best(rows: str, count: str) -> str:
    return (
        f"select year_month as best_month, {count} as best_month_total from ({rows}) r "
        f"order by {count} desc, year_month desc limit 1"
    )


DASHBOARD = {
    "o1_files_by_status": (
        insights.files_by_status,
        """select export_type, status_leitura, count(*) as total_arquivos,
            cast(sum(ifnull(row_count, 0)) as bigint) as total_linhas from int_file_inventory group by all""",
    ),
    "o2_domain_ranking": (
        insights.domain_ranking,
        f"select * from ({_domains()}) d order by total_records desc, domain_name limit 10",
    ),
    "o2_coverage_total": (
        insights.coverage_total,
        f"select {' + '.join(f'(select count(*) from {t})' for t in COUNTED.values())} as coverage_total",
    ),
    "o3_export_totals": (
        insights.export_totals,
        """select export_type, count(*) as total_arquivos, cast(sum(ifnull(row_count, 0)) as bigint) as total_linhas,
            round(100 * avg(if(status_leitura = 'ok', 1.0::double, 0)), 2) as success_rate
        from int_file_inventory group by all""",
    ),
    "o4_top_connection_companies": (
        insights.top_connection_companies,
        _top("connections", "company_clean", "total_connections"),
    ),
    "o4_top_connection_positions": (
        insights.top_connection_positions,
        _top("connections", "position_clean", "total_connections"),
    ),
    "o5_connections_overview": (
        insights.connections_overview,
        f"""select count(*) as total_connections, {count_where('has_email', 'total_with_email')},
            count(distinct company_clean) as total_unique_companies,
            count(distinct position_clean) as total_unique_positions from int_connections""",
    ),
    "o6_career_overview": (
        insights.career_overview,
        f"""select count(*) as total_positions, {count_where('is_current', 'current_positions')},
            count(distinct company_name_clean) as unique_companies, count(distinct title_clean) as unique_titles,
            avg(duration_months) as avg_duration_months from int_positions""",
    ),
    "o6_top_employers": (insights.top_employers, _top("positions", "company_name_clean", "total_positions")),
    "o6_top_titles": (insights.top_titles, _top("positions", "title_clean", "total_positions")),
    "o7_education_overview": (
        insights.education_overview,
        f"""select count(*) as total_education_records, {count_where('is_current_education', 'current_education_records')},
            count(distinct school_name_clean) as total_unique_schools,
            count(distinct degree_name_clean) as total_unique_degrees,
            avg(education_duration_months) as avg_education_duration_months from int_education""",
    ),
    "o7_top_schools": (insights.top_schools, _top("education", "school_name_clean", "total_records")),
    "o7_education_tracks": (insights.education_tracks, _share("education", "education_track", "total_records")),
    "o8_certification_overview": (
        insights.certification_overview,
        """select count(*) as total_certification_records, count(distinct name_clean) as total_unique_certifications,
            count(distinct authority_clean) as total_unique_authorities,
            avg(certification_duration_months) as avg_certification_duration_months from int_certifications""",
    ),
    "o8_top_authorities": (insights.top_authorities, _top("certifications", "authority_clean", "total_records")),
    "o8_certification_tracks": (
        insights.certification_tracks,
        _share("certifications", "certification_track", "total_records"),
    ),
    "o9_language_overview": (
        insights.language_overview,
        """select count(*) as total_language_records, count(distinct language_name_clean) as total_unique_languages,
            count(distinct proficiency_clean) as total_unique_proficiencies from int_languages""",
    ),
    "o9_language_distribution": (
        insights.language_distribution,
        _share("languages", "language_name_clean", "total_records"),
    ),
    "o10_endorsement_statuses": (
        insights.endorsement_statuses,
        _share("endorsement_received_info", "endorsement_status_group", "total"),
    ),
    "o10_endorsement_months": (insights.endorsement_months, _ENDORSED),
    "o10_best_endorsement_month": (insights.best_endorsement_month, _best(_ENDORSED, "total_endorsements")),
    "o10_endorsement_overview": (
        insights.endorsement_overview,
        """select count(skill_name_clean) as total_skills, cast(sum(endorsement_count) as bigint) as total_endorsements,
            cast(sum(unique_endorsers) as bigint) as total_unique_endorsers,
            min(first_endorsement_date) as first_endorsement, max(last_endorsement_date) as last_endorsement
        from mart_endorsement_received_info_summary""",
    ),
    "o10_top_endorsed_skills": (
        insights.top_endorsed_skills,
        """select * from mart_endorsement_received_info_summary
        order by endorsement_count desc, skill_name_clean limit 10""",
    ),
    "o11_top_followed": (
        insights.top_followed,
        "select * from mart_company_follows_summary order by follow_count desc, organization_clean limit 10",
    ),
    "o11_follow_months": (insights.follow_months, _FOLLOWED),
    "o11_best_follow_month": (insights.best_follow_month, _best(_FOLLOWED, "total_follows")),
    "o11_follow_overview": (
        insights.follow_overview,
        """select count(organization_clean) as total_companies, cast(sum(follow_count) as bigint) as total_follows,
            min(first_follow_date) as first_follow, max(last_follow_date) as last_follow
        from mart_company_follows_summary""",
    ),
    "o12_home_overview": (
        insights.home_overview,
        """select cast(sum(total_connections) as bigint) as total_connections,
            cast(sum(connections_with_email) as bigint) as connections_with_email,
            max(unique_companies) as unique_companies, max(unique_positions) as unique_positions,
            (select count(distinct company_clean) from int_connections) as distinct_companies,
            (select count(distinct position_clean) from int_connections) as distinct_positions
        from mart_connections_summary""",
    ),
    "o13_recommendation_visibility": (
        insights.recommendation_visibility,
        _share("recommendations_received", "visibility", "total_recommendations"),
    ),
    "o13_recommendation_themes": (
        insights.recommendation_themes,
        """select mentions_data_count, mentions_teamwork_count,
            case sign(mentions_data_count - mentions_teamwork_count) when 1 then 'data' when -1 then 'teamwork'
                else 'equilíbrio entre data e teamwork' end as dominant_theme,
            (select recommendation_year_month from mart_recommendations_received_timeline
                order by total_recommendations desc, recommendation_year_month desc limit 1) as peak_month,
            (select max(total_recommendations) from mart_recommendations_received_timeline) as peak_month_total
        from mart_recommendations_received_summary""",
    ),
    "o14_skills_overview": (
        insights.skills_overview,
        """select count(*) as total_skills, count(distinct skill_name_clean) as unique_skills,
            (select skill_category from mart_skills_summary order by total_skills desc, skill_category limit 1)
                as top_category
        from int_skills""",
    ),
    "o15_invitations_by_direction": (
        insights.invitations_by_direction,
        _share("invitations", "direction", "total_invitations"),
    ),
    "o15_events_by_status": (insights.events_by_status, _share("events", "status", "total_events")),
    "o16_saved_contents": (
        insights.saved_contents,
        "select content_title, content_type, last_watched_at from int_learning where content_saved",
    ),
    "o16_learning_overview": (
        insights.learning_overview,
        f"""select count(*) as total_contents, {count_where('is_completed', 'completed_contents')},
            {count_where('content_saved', 'saved_contents')},
            round(100 * avg(if(is_completed, 1.0::double, 0)), 2) as completion_rate from int_learning""",
    ),
    "o17_applications_by_family": (
        insights.applications_by_family,
        _share("job_applications", "job_family", "total_applications"),
    ),
    "o17_applications_overview": (
        insights.applications_overview,
        """select count(*) as total_applications, count(distinct company_name_clean) as unique_companies,
            (select count(*) from int_saved_job_alerts) as total_alerts from int_job_applications""",
    ),
    "o18_profile_detail": (
        insights.profile_detail,
        """select * exclude (first_name_clean, last_name_clean, industry_clean) from int_profile""",
    ),
    "o19_top_email_share_months": (
        insights.top_email_share_months,
        """select connection_year_month, total_connections, connections_with_email,
            connections_with_email / cast(total_connections as double) as email_share
        from mart_connections_summary where connection_year_month is not null
        order by email_share desc, connection_year_month desc limit 10""",
    ),
}

_DETAIL_LIST = {
    "positions": "company_name, title, location, started_on, finished_on, is_current, duration_months, career_track",
    "recommendations_received": "recommender_name, company, position, recommendation_date, visibility, text_length, "
    "mentions_data, mentions_teamwork, recommendation_text",
    "education": "school_name, degree_name, notes, started_on, finished_on, is_current_education, "
    "education_duration_months, education_track",
    "certifications": "name, authority, url, started_on, finished_on, license_number, certification_duration_months, "
    "certification_track",
}


def _register_dashboard() -> None:
    for name, (build, oracle) in DASHBOARD.items():
        register(name, lambda c, b=build: b(c.models), oracle)
    for table in insights.DETAILS:
        columns = _DETAIL_LIST.get(table, "*")
        register(
            f"o20_{table}_detail",
            lambda c, t=table: insights.detail(c.models, t),
            f"select {columns} from int_{table}",
        )


_register_cleaned()
_register_models()
_register_history()
_register_dashboard()
