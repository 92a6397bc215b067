"""The models in DuckDB SQL, as the independent answer the Spark ones are checked against.

Every entry of ``CTES`` is one named query; ``compose`` prefixes a statement
with the CTEs it needs. Inputs are the same SELECTs the Spark side reads.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from tidemark.binding import inputs
from tidemark.functions import lexicon

AS_OF = "2024-06-30"
TODAY = f"date '{AS_OF}'"
PORTFOLIO = "https://example.com/portfolio"


def trimmed(c: str) -> str:
    return f"trim(cast({c} as varchar))"


def blank_null(c: str) -> str:
    return f"nullif({trimmed(c)}, '')"


def lowered(c: str) -> str:
    return f"lower({trimmed(c)})"


def case_like(c: str, rules: Sequence[tuple[str, Sequence[str]]], default: str) -> str:
    arms = []
    for label, words in rules:
        test = " or ".join(f"{c} like '%{w}%'" for w in words)
        arms.append(f"when {test} then '{label}'")
    return f"case {' '.join(arms)} else '{default}' end"


def parts(c: str, prefix: str) -> str:
    return f"year({c}) as {prefix}year, month({c}) as {prefix}month, strftime({c}, '%Y-%m') as {prefix}year_month"


Names = tuple[str | tuple[str, str], ...]


def staged(
    table: str, trim: Names = (), blank: Names = (), date: Names = (), moment: Names = (), flag: Names = (), plain: Names = (), more: str = ""
) -> str:
    """A projection; a pair (a, b) renames bronze column b to a."""
    forms = (
        (trim, trimmed),
        (blank, blank_null),
        (date, lambda c: f"cast({c} as date)"),
        (moment, lambda c: f"cast({c} as timestamp)"),
        (flag, lambda c: f"cast({c} as boolean)"),
        (plain, str),
    )
    columns = []
    for names, form in forms:
        for name in names:
            out, source = (name, name) if isinstance(name, str) else name
            columns.append(f"{form(source)} as {out}")
    if more:
        columns.append(more)
    return f"select {', '.join(columns)} from bronze_{table}"


STG = {
    "certifications": staged(
        "certifications", trim=("name",), blank=("url", "authority", "license_number"), date=("started_on", "finished_on")
    ),
    "company_follows": staged("company_follows", trim=("organization",), date=("followed_on",)),
    "connections": staged(
        "connections",
        trim=("first_name", "last_name", ("profile_url", "url"), "company", "position"),
        blank=("email_address",),
        date=("connected_on",),
        more=f"{trimmed('first_name')} || ' ' || {trimmed('last_name')} as full_name",
    ),
    "education": staged(
        "education",
        trim=("school_name",),
        blank=("degree_name", "notes"),
        date=("started_on", "finished_on"),
        more="ifnull(is_current_education, false) as is_current_education",
    ),
    "email_addresses": staged(
        "email_addresses", trim=("email_address",), blank=("updated_on",), flag=("confirmed", ("is_primary", '"primary"'))
    ),
    "endorsement_received_info": staged(
        "endorsement_received_info",
        trim=("skill_name", "endorser_first_name", "endorser_last_name", "endorser_public_url", "endorsement_status"),
        date=("endorsement_date",),
    ),
    "events": staged(
        "events",
        trim=("event_name", "event_time"),
        blank=("external_url",),
        moment=("started_at", "finished_at"),
        more=f"upper({trimmed('status')}) as status",
    ),
    "file_inventory": "select * from bronze_file_inventory",
    "ingestion_audit": """
        select table_key, bronze_table, source_file, source_path, export_type,
            ifnull(source_row_count, row_count) as source_row_count,
            ifnull(source_column_count, column_count) as source_column_count,
            ifnull(row_count_after_transform, row_count) as row_count_after_transform,
            coalesce(column_count_after_transform, source_column_count, column_count) as column_count_after_transform,
            ifnull(rows_removed_during_transform, 0) as rows_removed_during_transform,
            duplicate_rows_after_transform, contract_owner, contract_description, required_columns,
            ifnull(non_empty_columns, '[]') as non_empty_columns, ifnull(unique_columns, '[]') as unique_columns,
            ifnull(null_rate_by_column, '{}') as null_rate_by_column_json,
            ifnull(source_null_rate_by_column, '{}') as source_null_rate_by_column_json,
            sensitive_columns, loaded_at_utc, cast(loaded_at_utc as date) as loaded_on,
            strftime(loaded_at_utc, '%Y-%m') as loaded_year_month
        from bronze_ingestion_audit""",
    "invitations": staged(
        "invitations",
        trim=("sender_name", "recipient_name"),
        blank=("message", "inviter_profile_url", "invitee_profile_url"),
        moment=("sent_at",),
        more=f"upper({trimmed('direction')}) as direction",
    ),
    "job_applications": staged(
        "job_applications",
        trim=("company_name", "job_title"),
        blank=("contact_email", "contact_phone_number", "job_url", "resume_name", "question_and_answers"),
        moment=("application_date",),
    ),
    "languages": staged("languages", trim=("name", "proficiency")),
    "learning": staged(
        "learning",
        trim=("content_title",),
        blank=("content_description", "content_type", "notes_taken"),
        moment=("last_watched_at", "completed_at"),
        flag=("content_saved",),
    ),
    "phone_numbers": staged("phone_numbers", trim=("phone_number",), blank=("extension", "phone_type")),
    "positions": staged(
        "positions", trim=("company_name", "title"), blank=("description", "location"), date=("started_on", "finished_on"), plain=("is_current",)
    ),
    "profile": staged(
        "profile",
        trim=(
            "first_name", "last_name", "maiden_name", "address", "headline", "summary", "industry", "zip_code", "geo_location",
            "twitter_handles", "websites", "instant_messengers",
        ),
        date=("birth_date",),
    ),
    "recommendations_received": staged(
        "recommendations_received",
        trim=("first_name", "last_name", "company", "position", "recommendation_text", "visibility"),
        date=("recommendation_date",),
    ),
    "registration": staged("registration", trim=("registration_ip",), blank=("subscription_types",), moment=("registered_at",)),
    "saved_job_alerts": staged("saved_job_alerts", trim=("alert_parameters", "query_context", "saved_search_id")),
    "skills": staged("skills", trim=("skill_name",)),
    "volunteering": staged(
        "volunteering",
        trim=("company_name", "role"),
        blank=("cause", "description"),
        date=("started_on", "finished_on"),
        flag=("is_current_volunteering",),
    ),
}


def _with_period(table: str, end: str, duration: str, columns: str, track: str = "") -> str:
    inner = f"select *, {end} as effective_end_date, {columns} from stg_{table}"
    return f"select *, date_diff('month', started_on, effective_end_date) as {duration}{track} from ({inner}) e"


INT = {
    "certifications": _with_period(
        "certifications",
        f"ifnull(finished_on, {TODAY})",
        "certification_duration_months",
        f"{lowered('name')} as name_clean, {lowered('authority')} as authority_clean, "
        f"{parts('started_on', 'start_')}, {parts('finished_on', 'end_')}",
        f", {case_like('authority_clean', lexicon.CERTIFICATION_TRACKS, 'outros')} as certification_track",
    ),
    "company_follows": f"""
        select organization, lower(organization) as organization_clean, followed_on, {parts('followed_on', '')}
        from stg_company_follows""",
    "connections": f"""
        select *, email_address is not null as has_email, {lowered('company')} as company_clean,
            {lowered('position')} as position_clean, {parts('connected_on', 'connection_')}
        from stg_connections""",
    "education": _with_period(
        "education",
        f"case when is_current_education then {TODAY} else finished_on end",
        "education_duration_months",
        f"{lowered('school_name')} as school_name_clean, "
        f"lower(trim(ifnull(degree_name, ''))) as degree_name_clean, "
        f"{parts('started_on', 'start_')}, {parts('finished_on', 'end_')}",
        f", {case_like('degree_name_clean', lexicon.EDUCATION_TRACKS, 'outros')} as education_track",
    ),
    "endorsement_received_info": f"""
        select *, lower(skill_name) as skill_name_clean,
            ifnull(endorser_first_name, '')
                || if(endorser_first_name is null or endorser_last_name is null, '', ' ')
                || ifnull(endorser_last_name, '') as endorser_full_name,
            {case_like('lower(endorsement_status)', lexicon.ENDORSEMENT_STATUSES, 'other')} as endorsement_status_group
        from stg_endorsement_received_info""",
    "events": f"""
        select *, external_url is not null as has_external_url, {parts('started_at', 'event_')} from stg_events""",
    "file_inventory": """
        select export_name, export_type, folder_name, file_name, file_stem, row_count, column_count, file_size_kb,
            case when row_count is null then 'erro_leitura' when row_count < 1 then 'vazio'
                when row_count < 10 then 'muito_pequeno' when row_count < 100 then 'pequeno'
                when row_count < 1000 then 'medio' else 'grande' end as volume_categoria,
            if(read_success is not distinct from false, 'erro', 'ok') as status_leitura,
            case folder_name when 'Jobs' then 'job_data' when 'root' then 'core_profile'
                when 'Services Marketplace' then 'services' when 'Verifications' then 'trust' else 'outros' end
                as categoria_dado,
            inventory_timestamp
        from stg_file_inventory""",
    "invitations": f"""
        select *, message is not null as has_message, {parts('sent_at', 'invitation_')} from stg_invitations""",
    "job_applications": f"""
        select *, {lowered('company_name')} as company_name_clean, {lowered('job_title')} as job_title_clean,
            resume_name is not null as has_resume, question_and_answers is not null as has_questionnaire,
            {parts('application_date', 'application_')},
            {case_like('lower(job_title)', lexicon.JOB_FAMILIES, 'other')} as job_family
        from stg_job_applications""",
    "languages": f"""
        select *, {lowered('name')} as language_name_clean, {lowered('proficiency')} as proficiency_clean,
            {case_like('lower(proficiency)', lexicon.PROFICIENCY_TRACKS, 'outros')} as proficiency_track
        from stg_languages""",
    "learning": f"""
        select *, {lowered('content_title')} as content_title_clean,
            lower(ifnull(content_type, 'outros')) as content_type_clean,
            completed_at is not null as is_completed, notes_taken is not null as has_notes,
            strftime(ifnull(completed_at, last_watched_at), '%Y-%m') as engagement_year_month
        from stg_learning""",
    "positions": _with_period(
        "positions",
        f"case when is_current then {TODAY} else finished_on end",
        "duration_months",
        f"{lowered('company_name')} as company_name_clean, {lowered('title')} as title_clean, "
        f"lower(ifnull(location, '')) as location_clean, {parts('started_on', 'start_')}, {parts('finished_on', 'end_')}",
        f", {case_like('title_clean', lexicon.CAREER_TRACKS, 'outros')} as career_track",
    ),
    "profile": rf"""
        select *, {lowered('first_name')} as first_name_clean, {lowered('last_name')} as last_name_clean,
            lower(ifnull(industry, '')) as industry_clean,
            if(websites like '[PERSONAL:%', regexp_extract(websites, '\[PERSONAL:(.+)\]', 1), nullif(websites, ''))
                as primary_contact_url,
            if(websites like '[PERSONAL:%', 'WhatsApp', 'Website') as primary_contact_label,
            '{PORTFOLIO}' as portfolio_website,
            {case_like('lower(headline)', lexicon.PROFILE_TRACKS, 'outros')} as profile_track,
            length(summary) as summary_length,
            case when summary is null then 'sem_summary' when length(summary) < 100 then 'curta'
                when length(summary) < 500 then 'media' else 'longa' end as summary_size_category
        from stg_profile""",
    "recommendations_received": """
        select *, ifnull(first_name, '') || ' ' || ifnull(last_name, '') as recommender_name,
            length(recommendation_text) as text_length,
            if(contains(lower(recommendation_text), 'data'), 1, 0) as mentions_data,
            if(contains(lower(recommendation_text), 'team'), 1, 0) as mentions_teamwork
        from stg_recommendations_received""",
    "saved_job_alerts": """
        select *, nullif(trim(regexp_extract(query_context, 'keywords=([^,}]+)', 1)), '') as search_keywords,
            lower(nullif(regexp_extract(alert_parameters, 'frequency=([A-Z]+)', 1), '')) as alert_frequency,
            ifnull(contains(lower(query_context), 'workplacetype:2'), false) as has_remote_filter,
            ifnull(contains(lower(query_context), 'organizations='), false) as has_company_filter
        from stg_saved_job_alerts""",
    "skills": f"""
        select *, lower(skill_name) as skill_name_clean, length(skill_name) as skill_name_length,
            {case_like('lower(skill_name)', lexicon.SKILL_CATEGORIES, 'other')} as skill_category
        from stg_skills""",
    "volunteering": _with_period(
        "volunteering",
        f"ifnull(finished_on, {TODAY})",
        "duration_months",
        f"{lowered('company_name')} as company_name_clean, {lowered('role')} as role_clean, "
        "lower(ifnull(cause, 'sem_causa')) as cause_clean",
    ),
}


def count_where(test: str, name: str) -> str:
    return f"count(*) filter (where {test}) as {name}"


def monthly(table: str, prefix: str, measures: str, by: str = "") -> str:
    keys = f"{prefix}year, {prefix}month, {prefix}year_month" + (f", {by}" if by else "")
    return f"select {keys}, {measures} from int_{table} group by all"


COUNTED = {
    "total_connections": "int_connections",
    "total_positions": "int_positions",
    "total_education_records": "int_education",
    "total_certifications": "int_certifications",
    "total_languages": "int_languages",
    "total_endorsements": "int_endorsement_received_info",
    "total_company_follows": "int_company_follows",
    "total_recommendations": "int_recommendations_received",
    "total_skills": "int_skills",
    "total_invitations": "int_invitations",
    "total_events": "int_events",
    "total_learning_records": "int_learning",
    "total_job_applications": "int_job_applications",
    "total_saved_job_alerts": "int_saved_job_alerts",
    "total_volunteering": "int_volunteering",
    "total_email_addresses": "stg_email_addresses",
    "total_phone_numbers": "stg_phone_numbers",
}

MART = {
    "career_progression": monthly(
        "positions",
        "start_",
        f"count(*) as total_positions_started, {count_where('is_current', 'current_positions_started')}, "
        "count(distinct company_name_clean) as unique_companies, count(distinct title_clean) as unique_titles, "
        "avg(duration_months) as avg_duration_months",
    ),
    "certifications_summary": monthly(
        "certifications",
        "start_",
        "count(*) as total_certifications, count(distinct name_clean) as unique_certifications, "
        "count(distinct authority_clean) as unique_authorities, "
        "avg(certification_duration_months) as avg_duration_months",
    ),
    "company_follows_summary": """
        select organization_clean, count(*) as follow_count, min(followed_on) as first_follow_date,
            max(followed_on) as last_follow_date
        from int_company_follows group by all""",
    "connections_summary": monthly(
        "connections",
        "connection_",
        f"count(*) as total_connections, {count_where('has_email', 'connections_with_email')}, "
        "count(distinct company_clean) as unique_companies, count(distinct position_clean) as unique_positions",
    ),
    "contact_account_summary": f"""
        select (select count(*) from stg_email_addresses) as total_email_addresses,
            (select count(*) from stg_email_addresses where confirmed) as confirmed_email_addresses,
            (select count(*) from stg_email_addresses where is_primary) as primary_email_addresses,
            (select count(*) from stg_phone_numbers) as total_phone_numbers,
            min(registered_at) as first_registered_at, max(registered_at) as latest_registered_at,
            max(subscription_types) as subscription_types,
            year({TODAY}) - year(min(registered_at)) as account_age_years
        from stg_registration""",
    "education_summary": monthly(
        "education",
        "start_",
        f"count(*) as total_education_started, {count_where('is_current_education', 'current_education_started')}, "
        "count(distinct school_name_clean) as unique_schools, count(distinct degree_name_clean) as unique_degrees, "
        "avg(education_duration_months) as avg_education_duration_months",
    ),
    "endorsement_received_info_summary": """
        select skill_name_clean, count(*) as endorsement_count, count(distinct endorser_full_name) as unique_endorsers,
            min(endorsement_date) as first_endorsement_date, max(endorsement_date) as last_endorsement_date
        from int_endorsement_received_info group by all""",
    "events_summary": monthly(
        "events", "event_", f"count(*) as total_events, {count_where('has_external_url', 'events_with_url')}", "status"
    ),
    "file_inventory_summary": """
        select export_type, categoria_dado, status_leitura, volume_categoria, count(*) as total_arquivos,
            cast(sum(ifnull(row_count, 0)) as bigint) as total_linhas,
            cast(sum(ifnull(column_count, 0)) as bigint) as total_colunas,
            round(sum(ifnull(file_size_kb, 0)), 2) as total_tamanho_kb,
            min(inventory_timestamp) as primeira_execucao_inventario,
            max(inventory_timestamp) as ultima_execucao_inventario
        from int_file_inventory group by all""",
    "invitations_summary": monthly(
        "invitations",
        "invitation_",
        f"count(*) as total_invitations, {count_where('has_message', 'invitations_with_message')}",
        "direction",
    ),
    "job_applications_summary": monthly(
        "job_applications",
        "application_",
        "count(*) as total_applications, count(distinct company_name_clean) as unique_companies, "
        f"{count_where('has_resume', 'applications_with_resume')}, "
        f"{count_where('has_questionnaire', 'applications_with_questionnaire')}",
        "job_family",
    ),
    "languages_summary": """
        select proficiency_track, count(*) as total_languages, count(distinct language_name_clean) as unique_languages
        from int_languages group by all""",
    "learning_summary": f"""
        select content_type_clean, count(*) as total_contents, {count_where('is_completed', 'completed_contents')},
            {count_where('content_saved', 'saved_contents')}, {count_where('has_notes', 'contents_with_notes')}
        from int_learning group by all""",
    "profile_summary": """
        select first_name, last_name, headline, industry, geo_location, profile_track, summary_length,
            summary_size_category, primary_contact_url, primary_contact_label, portfolio_website
        from int_profile""",
    "recommendations_received_summary": """
        select count(*) as total_recommendations, avg(text_length) as avg_text_length,
            cast(sum(mentions_data) as bigint) as mentions_data_count,
            cast(sum(mentions_teamwork) as bigint) as mentions_teamwork_count,
            min(recommendation_date) as first_recommendation_date, max(recommendation_date) as last_recommendation_date
        from int_recommendations_received""",
    "recommendations_received_timeline": f"""
        select {parts('recommendation_date', 'recommendation_')}, count(*) as total_recommendations,
            avg(text_length) as avg_text_length, cast(sum(mentions_data) as bigint) as mentions_data_count,
            cast(sum(mentions_teamwork) as bigint) as mentions_teamwork_count
        from int_recommendations_received where recommendation_date is not null group by all""",
    "saved_job_alerts_summary": f"""
        select ifnull(alert_frequency, 'unknown') as alert_frequency, count(*) as total_alerts,
            count(distinct search_keywords) as unique_keyword_sets,
            {count_where('has_remote_filter', 'remote_alerts')},
            {count_where('has_company_filter', 'company_scoped_alerts')}
        from int_saved_job_alerts group by all""",
    "skills_summary": """
        select skill_category, count(*) as total_skills, count(distinct skill_name_clean) as unique_skills,
            round(avg(skill_name_length), 2) as avg_skill_name_length
        from int_skills group by all""",
    "volunteering_summary": f"""
        select cause_clean, count(*) as total_volunteering_roles,
            count(distinct company_name_clean) as unique_organizations,
            {count_where('is_current_volunteering', 'current_roles')},
            round(avg(duration_months), 2) as avg_duration_months
        from int_volunteering group by all""",
    "health_summary": f"""
        select count(*) as total_inventory_files, {count_where('read_success', 'successful_reads')},
            {count_where('not read_success', 'failed_reads')}, max(inventory_timestamp) as latest_inventory_timestamp,
            {', '.join(f'(select count(*) from {table}) as {name}' for name, table in COUNTED.items())}
        from stg_file_inventory""",
    "health_timeline": """
        select * exclude (sensitive_columns, source_path),
            case when source_row_count > 0
                then round(cast(row_count_after_transform as double) / source_row_count, 4) end as row_retention_rate,
            row_count_after_transform - lag(row_count_after_transform) over loads as row_count_change_vs_previous_load,
            rows_removed_during_transform - lag(rows_removed_during_transform) over loads
                as rows_removed_change_vs_previous_load,
            duplicate_rows_after_transform > 0 as duplicate_alert_flag,
            rows_removed_during_transform > 0 as row_removal_alert_flag,
            case when source_row_count = 0 then 'sem_dados' when row_count_after_transform = 0 then 'esvaziado'
                when rows_removed_during_transform > 0 then 'atencao' else 'saudavel' end as health_status,
            1 as successful_load_flag
        from stg_ingestion_audit
        window loads as (partition by table_key order by loaded_at_utc, source_file)""",
    "null_rate_timeline": """
        select r.*, null_rate_after_transform - null_rate_before_transform as null_rate_delta,
            null_rate_after_transform - lag(null_rate_after_transform) over (
                partition by table_key, monitored_column order by loaded_at_utc, source_file
            ) as null_rate_change_vs_previous_load,
            ifnull(null_rate_after_transform, 0) > 0 as null_rate_alert_flag
        from (
            select loaded_at_utc, loaded_on, loaded_year_month, table_key, bronze_table, export_type, source_file,
                source_row_count, row_count_after_transform, rows_removed_during_transform,
                unnest(json_keys(null_rate_by_column_json)) as monitored_column,
                try_cast(null_rate_by_column_json ->> monitored_column as double) as null_rate_after_transform,
                try_cast(source_null_rate_by_column_json ->> monitored_column as double) as null_rate_before_transform
            from stg_ingestion_audit
        ) r""",
}


def _ratio(a: str, b: str) -> str:
    return f"ifnull(cast({a} as double) / nullif({b}, 0), 0)"


def _clip(x: str) -> str:
    return f"least(greatest({x}, 0), 1)"


def _running(x: str) -> str:
    return f"sum({x}) over (order by snapshot_year_month rows unbounded preceding)"


def _running_count(x: str, name: str) -> str:
    return f"cast({_running(x)} as bigint) as {name}"


def _mom(x: str) -> str:
    before = f"lag({x}) over (order by snapshot_year_month)"
    return (
        f"ifnull({x} - {before}, 0) as {{0}}_mom_delta, "
        f"ifnull(({x} - {before}) / nullif(cast({before} as double), 0), 0) as {{0}}_mom_pct"
    )


RUN_ID = "run-1"
CREATED_AT = "2024-07-01 00:00:00"


def _tags(method: str, source: str) -> str:
    return (
        f"'{RUN_ID}' as snapshot_run_id, false as is_simulated_snapshot, '{method}' as snapshot_method, "
        f"'{source}' as snapshot_source, timestamp '{CREATED_AT}' as snapshot_created_at"
    )


_DATE = "last_day(cast(snapshot_year_month || '-01' as date)) as snapshot_date"

FACT = {
    "network_growth": f"""
        select *, {_ratio('connections_with_email_cumulative', 'total_connections_cumulative')}
                as connections_with_email_pct
        from (
            select {_tags('cumulative_from_event_history', 'mart_connections_summary')}, {_DATE}, m.*,
                {_running_count('monthly_new_connections', 'total_connections_cumulative')},
                {_running_count('monthly_new_connections_with_email', 'connections_with_email_cumulative')},
                {_mom('monthly_new_connections').format('connections')}
            from (
                select connection_year_month as snapshot_year_month, total_connections as monthly_new_connections,
                    connections_with_email as monthly_new_connections_with_email,
                    unique_companies as unique_companies_in_month, unique_positions as unique_positions_in_month
                from mart_connections_summary where connection_year_month is not null
            ) m
        ) h""",
    "applications": f"""
        select {_tags('cumulative_from_event_history', 'mart_job_applications_summary')}, {_DATE}, m.*,
            {_running_count('total_applications', 'cumulative_total_applications')},
            {_running_count('applications_with_resume', 'cumulative_applications_with_resume')},
            {_running_count('applications_with_questionnaire', 'cumulative_applications_with_questionnaire')},
            {_ratio('applications_with_resume', 'total_applications')} as applications_with_resume_pct,
            {_ratio('applications_with_questionnaire', 'total_applications')} as applications_with_questionnaire_pct,
            {_mom('total_applications').format('applications')}
        from (
            select application_year_month as snapshot_year_month,
                cast(sum(total_applications) as bigint) as total_applications,
                cast(sum(applications_with_resume) as bigint) as applications_with_resume,
                cast(sum(applications_with_questionnaire) as bigint) as applications_with_questionnaire,
                count(distinct job_family) as job_family_count
            from mart_job_applications_summary where application_year_month is not null group by all
        ) m""",
    "presence": f"""
        with e as (
            select event_year_month as ym, cast(sum(total_events) as bigint) as n,
                cast(sum(events_with_url) as bigint) as u
            from mart_events_summary group by all
        ), i as (
            select invitation_year_month as ym, cast(sum(total_invitations) as bigint) as n,
                cast(sum(invitations_with_message) as bigint) as u
            from mart_invitations_summary group by all
        ), r as (select * from mart_recommendations_received_timeline),
        spine as (
            select ym from e union select ym from i union select recommendation_year_month from r
        ), monthly as (
            select spine.ym as snapshot_year_month, ifnull(e.n, 0) as monthly_events,
                ifnull(e.u, 0) as monthly_events_with_url, ifnull(i.n, 0) as monthly_invitations,
                ifnull(i.u, 0) as monthly_invitations_with_message,
                ifnull(total_recommendations, 0) as monthly_recommendations,
                ifnull(avg_text_length, 0) as average_recommendation_text_length,
                ifnull(r.mentions_data_count, 0) as mentions_data_count
            from spine left join e on e.ym = spine.ym left join i on i.ym = spine.ym
                left join r on recommendation_year_month = spine.ym
            where spine.ym is not null
        ), running as (
            select *, {_running_count('monthly_events', 'cumulative_events')},
                {_running_count('monthly_invitations', 'cumulative_invitations')},
                {_running_count('monthly_recommendations', 'cumulative_recommendations')},
                {_ratio('monthly_events_with_url', 'monthly_events')} as events_with_url_pct,
                {_ratio('monthly_invitations_with_message', 'monthly_invitations')} as invitations_with_message_pct,
                {_ratio('mentions_data_count', 'monthly_recommendations')} as recommendations_mention_data_pct
            from monthly
        )
        select {_tags('cumulative_from_event_history',
                      'mart_events_summary|mart_invitations_summary|mart_recommendations_received_timeline')},
            {_DATE}, running.*,
            round({_clip('events_with_url_pct * 0.35::double + invitations_with_message_pct * 0.35::double '
                         '+ recommendations_mention_data_pct * 0.30::double')}, 6) as presence_score,
            round({_clip(f"{_ratio('monthly_recommendations', 'cumulative_recommendations')} * 0.25::double "
                         "+ invitations_with_message_pct * 0.35::double "
                         f"+ {_ratio('monthly_invitations', 'cumulative_invitations')} * 0.20::double "
                         f"+ {_ratio('monthly_events', 'cumulative_events')} * 0.20::double")}, 6) as engagement_score
        from running""",
    "career_education": f"""
        with spine as (
            select start_year_month as ym from mart_career_progression
            union select start_year_month from mart_education_summary
            union select start_year_month from mart_certifications_summary
        ), monthly as (
            select ym as snapshot_year_month,
                ifnull(c.total_positions_started, 0) as positions_started_in_month,
                ifnull(c.current_positions_started, 0) as current_positions_started_in_month,
                ifnull(c.avg_duration_months, 0) as avg_position_duration_months,
                ifnull(e.total_education_started, 0) as education_started_in_month,
                ifnull(e.current_education_started, 0) as current_education_started_in_month,
                ifnull(e.avg_education_duration_months, 0) as avg_education_duration_months,
                ifnull(k.total_certifications, 0) as certifications_started_in_month,
                ifnull(k.avg_duration_months, 0) as avg_certification_duration_months
            from spine left join mart_career_progression c on c.start_year_month = ym
                left join mart_education_summary e on e.start_year_month = ym
                left join mart_certifications_summary k on k.start_year_month = ym
            where ym is not null
        ), running as (
            select *, {_running_count('positions_started_in_month', 'positions_started_cumulative')},
                {_running_count('current_positions_started_in_month', 'current_positions_cumulative')},
                {_running_count('education_started_in_month', 'education_started_cumulative')},
                {_running_count('current_education_started_in_month', 'current_education_cumulative')},
                {_running_count('certifications_started_in_month', 'certifications_cumulative')},
                {_ratio(_running('avg_position_duration_months * positions_started_in_month'),
                        _running('positions_started_in_month'))} as p,
                {_ratio(_running('avg_education_duration_months * education_started_in_month'),
                        _running('education_started_in_month'))} as e,
                {_ratio(_running('avg_certification_duration_months * certifications_started_in_month'),
                        _running('certifications_started_in_month'))} as k
            from monthly
        )
        select {_tags('cumulative_from_event_history',
                      'mart_career_progression|mart_education_summary|mart_certifications_summary')},
            {_DATE}, running.* exclude (p, e, k), round(p, 6) as avg_position_duration_cumulative,
            round(e, 6) as avg_education_duration_cumulative, round(k, 6) as avg_certification_duration_cumulative,
            round({_clip(f"{_clip('positions_started_cumulative / 8::double')} * 0.35::double "
                         f"+ {_clip('education_started_cumulative / 4::double')} * 0.20::double "
                         f"+ {_clip('certifications_cumulative / 10::double')} * 0.20::double "
                         f"+ {_clip('p / 24::double')} * 0.15::double + {_clip('e / 36::double')} * 0.10::double")}, 6)
                as career_maturity_score
        from running""",
    "data_quality": f"""
        with rates as (
            select loaded_on, table_key, count(distinct monitored_column) as monitored_columns_count,
                round(avg(null_rate_before_transform), 6) as avg_null_rate_before_transform,
                round(avg(null_rate_after_transform), 6) as avg_null_rate_after_transform,
                round(avg(null_rate_delta), 6) as avg_null_rate_delta,
                {count_where('null_rate_alert_flag', 'null_rate_alert_count')}
            from mart_null_rate_timeline group by all
        )
        select {_tags('actual_pipeline_audit',
                      'mart_ingestion_audit_health_timeline|mart_ingestion_audit_null_rate_timeline')},
            h.loaded_on as snapshot_date, loaded_year_month as snapshot_year_month, h.table_key, export_type,
            source_row_count, row_count_after_transform, rows_removed_during_transform,
            duplicate_rows_after_transform, row_retention_rate, health_status, duplicate_alert_flag,
            row_removal_alert_flag, successful_load_flag, monitored_columns_count, avg_null_rate_before_transform,
            avg_null_rate_after_transform, avg_null_rate_delta, null_rate_alert_count
        from mart_health_timeline h left join rates on rates.loaded_on = h.loaded_on and rates.table_key = h.table_key""",
}

CTES = {
    **{f"bronze_{k}": inputs.duckdb_sql(v) for k, v in inputs.BRONZE.items()},
    **{f"raw_{k}": inputs.duckdb_sql(v) for k, v in inputs.RAW.items()},
    **{f"stg_{k}": v for k, v in STG.items()},
    **{f"int_{k}": v for k, v in INT.items()},
    **{f"mart_{k}": v for k, v in MART.items()},
    **{f"fact_{k}": v for k, v in FACT.items()},
}
_REFERENCE = re.compile(r"\b(?:from|join)\s+((?:bronze|raw|stg|int|mart|fact)_\w+)")


def compose(sql: str) -> str:
    """The statement behind the CTEs it refers to, each after what it needs itself."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in _REFERENCE.findall(text):
            if name not in ordered:
                visit(CTES[name])
                if name not in ordered:
                    ordered.append(name)

    visit(sql)
    if not ordered:
        return sql
    return "with " + ",\n".join(f"{name} as ({CTES[name]})" for name in ordered) + f"\nselect * from ({sql}) answer"
