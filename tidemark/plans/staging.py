"""Staging models: bronze columns trimmed, cast and renamed. Projections only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import dates, text

TRIM, BLANK_NULL, UPPER, DATE, MOMENT, FLAG, AS_IS = "trim", "blank_null", "upper", "date", "moment", "flag", "as_is"

# {table: {output column: treatment, or (treatment, bronze column)}}
COLUMNS: dict[str, dict[str, str | tuple[str, str]]] = {
    "certifications": {
        "name": TRIM,
        "url": BLANK_NULL,
        "authority": BLANK_NULL,
        "started_on": DATE,
        "finished_on": DATE,
        "license_number": BLANK_NULL,
    },
    "company_follows": {"organization": TRIM, "followed_on": DATE},
    "connections": {
        "first_name": TRIM,
        "last_name": TRIM,
        "profile_url": (TRIM, "url"),
        "email_address": BLANK_NULL,
        "company": TRIM,
        "position": TRIM,
        "connected_on": DATE,
    },
    "education": {
        "school_name": TRIM,
        "degree_name": BLANK_NULL,
        "notes": BLANK_NULL,
        "started_on": DATE,
        "finished_on": DATE,
        "is_current_education": AS_IS,
    },
    "email_addresses": {
        "email_address": TRIM,
        "confirmed": FLAG,
        "is_primary": (FLAG, "primary"),
        "updated_on": BLANK_NULL,
    },
    "endorsement_received_info": {
        "endorsement_date": DATE,
        "skill_name": TRIM,
        "endorser_first_name": TRIM,
        "endorser_last_name": TRIM,
        "endorser_public_url": TRIM,
        "endorsement_status": TRIM,
    },
    "events": {
        "event_name": TRIM,
        "event_time": TRIM,
        "status": UPPER,
        "external_url": BLANK_NULL,
        "started_at": MOMENT,
        "finished_at": MOMENT,
    },
    "file_inventory": {
        name: AS_IS
        for name in (
            "export_name",
            "export_type",
            "relative_path",
            "file_name",
            "file_stem",
            "folder_name",
            "file_size_bytes",
            "file_size_kb",
            "row_count",
            "column_count",
            "column_names",
            "detected_encoding",
            "read_success",
            "error_message",
        )
    }
    | {"inventory_timestamp": MOMENT},
    "invitations": {
        "sender_name": TRIM,
        "recipient_name": TRIM,
        "sent_at": MOMENT,
        "message": BLANK_NULL,
        "direction": UPPER,
        "inviter_profile_url": BLANK_NULL,
        "invitee_profile_url": BLANK_NULL,
    },
    "job_applications": {
        "application_date": MOMENT,
        "contact_email": BLANK_NULL,
        "contact_phone_number": BLANK_NULL,
        "company_name": TRIM,
        "job_title": TRIM,
        "job_url": BLANK_NULL,
        "resume_name": BLANK_NULL,
        "question_and_answers": BLANK_NULL,
    },
    "languages": {"name": TRIM, "proficiency": TRIM},
    "learning": {
        "content_title": TRIM,
        "content_description": BLANK_NULL,
        "content_type": BLANK_NULL,
        "last_watched_at": MOMENT,
        "completed_at": MOMENT,
        "content_saved": FLAG,
        "notes_taken": BLANK_NULL,
    },
    "phone_numbers": {"extension": BLANK_NULL, "phone_number": TRIM, "phone_type": BLANK_NULL},
    "positions": {
        "company_name": TRIM,
        "title": TRIM,
        "description": BLANK_NULL,
        "location": BLANK_NULL,
        "started_on": DATE,
        "finished_on": DATE,
        "is_current": AS_IS,
    },
    "profile": {
        "first_name": TRIM,
        "last_name": TRIM,
        "maiden_name": TRIM,
        "address": TRIM,
        "birth_date": DATE,
        "headline": TRIM,
        "summary": TRIM,
        "industry": TRIM,
        "zip_code": TRIM,
        "geo_location": TRIM,
        "twitter_handles": TRIM,
        "websites": TRIM,
        "instant_messengers": TRIM,
    },
    "recommendations_received": {
        "first_name": TRIM,
        "last_name": TRIM,
        "company": TRIM,
        "position": TRIM,
        "recommendation_text": TRIM,
        "recommendation_date": DATE,
        "visibility": TRIM,
    },
    "registration": {"registered_at": MOMENT, "registration_ip": TRIM, "subscription_types": BLANK_NULL},
    "saved_job_alerts": {"alert_parameters": TRIM, "query_context": TRIM, "saved_search_id": TRIM},
    "skills": {"skill_name": TRIM},
    "volunteering": {
        "company_name": TRIM,
        "role": TRIM,
        "cause": BLANK_NULL,
        "started_on": DATE,
        "finished_on": DATE,
        "description": BLANK_NULL,
        "is_current_volunteering": FLAG,
    },
}

STAGED_TABLES = (*COLUMNS, "ingestion_audit")


def _treat(df: DataFrame, name: str, treatment: str) -> Column:
    is_text = isinstance(df.schema[name].dataType, T.StringType)
    if treatment == TRIM:
        return text.trim_text(name)
    if treatment == BLANK_NULL:
        return text.nullif_trim_text(name)
    if treatment == UPPER:
        return text.upper_trim_text(name)
    if treatment == DATE:
        return dates.to_date(name) if is_text else F.col(name).cast("date")
    if treatment == MOMENT:
        return dates.to_timestamp(name) if is_text else F.col(name).cast("timestamp_ntz")
    if treatment == FLAG:
        return F.col(name).cast("boolean")
    return F.col(name)


def stage(table: str, bronze: DataFrame) -> DataFrame:
    """The staging model of a bronze table."""
    if table == "ingestion_audit":
        return _stage_audit(bronze)
    columns = []
    for out, rule in COLUMNS[table].items():
        treatment, source = rule if isinstance(rule, tuple) else (rule, out)
        columns.append(_treat(bronze, source, treatment).alias(out))
    staged = bronze.select(*columns)
    if table == "connections":
        # A missing part makes the whole name NULL.
        full = F.concat(F.col("first_name"), F.lit(" "), F.col("last_name")).alias("full_name")
        staged = staged.select("first_name", "last_name", full, *staged.columns[2:])
    if table == "education":
        staged = staged.withColumn("is_current_education", F.coalesce("is_current_education", F.lit(False)))
    return staged


def _stage_audit(bronze: DataFrame) -> DataFrame:
    """Audit rows with newer columns falling back on the ones older loads wrote."""
    known = set(bronze.columns)

    def first_of(*names: str, default: Column | None = None) -> Column:
        options = [F.col(name) for name in names if name in known]
        options += [] if default is None else [default]
        return F.coalesce(*options) if options else F.lit(None)

    loaded = F.col("loaded_at_utc").cast("timestamp_ntz")
    counts = {
        "source_row_count": first_of("source_row_count", "row_count"),
        "source_column_count": first_of("source_column_count", "column_count"),
        "row_count_after_transform": first_of("row_count_after_transform", "row_count"),
        "column_count_after_transform": first_of(
            "column_count_after_transform", "source_column_count", "column_count"
        ),
        "rows_removed_during_transform": first_of("rows_removed_during_transform", default=F.lit(0)),
        "duplicate_rows_after_transform": first_of("duplicate_rows_after_transform"),
    }
    return bronze.select(
        "table_key",
        "bronze_table",
        "source_file",
        "source_path",
        "export_type",
        *[c.cast("long").alias(name) for name, c in counts.items()],
        "contract_owner",
        "contract_description",
        "required_columns",
        first_of("non_empty_columns", default=F.lit("[]")).alias("non_empty_columns"),
        first_of("unique_columns", default=F.lit("[]")).alias("unique_columns"),
        first_of("null_rate_by_column", default=F.lit("{}")).alias("null_rate_by_column_json"),
        first_of("source_null_rate_by_column", default=F.lit("{}")).alias("source_null_rate_by_column_json"),
        "sensitive_columns",
        loaded.alias("loaded_at_utc"),
        loaded.cast("date").alias("loaded_on"),
        dates.year_month(loaded).alias("loaded_year_month"),
    )
