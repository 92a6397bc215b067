"""The 19 export tables: cleaning recipe, contract and where the file lives."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import dates, lexicon, text
from tidemark.operators import cleaning
from tidemark.operators.cleaning import Recipe
from tidemark.operators.contracts import TableContract, assert_columns, audit_row
from tidemark.session import shuffles_removed
from tidemark.sources.csv_exports import REJECTED, accepted_records, read_records, read_records_after_preamble, rejected_records
from tidemark.sources.swap import side_by_side
from tidemark.sources.warehouse import Warehouse


@dataclass(frozen=True)
class ExportTable:
    key: str
    file: str
    export_type: str
    recipe: Recipe
    contract: TableContract
    preamble_header: tuple[str, ...] = ()


def _current(flag: str):
    return lambda df: df.withColumn(flag, cleaning.current_flag("finished_on"))


def _unknown_update(df: DataFrame) -> DataFrame:
    return df.withColumn("updated_on", text.sentinel_to_null("updated_on", lexicon.UNKNOWN_UPDATE_DATE))


def _event_times(df: DataFrame) -> DataFrame:
    start, end = dates.split_range("event_time")
    return df.withColumns(
        {
            "started_at": dates.parse_month_name_datetime(start),
            "finished_at": dates.parse_month_name_datetime(end),
        }
    )


def _table(
    key: str,
    file: str,
    export_type: str,
    columns: tuple[str, ...],
    *,
    unique: tuple[str, ...] = (),
    sensitive: tuple[str, ...] = (),
    description: str = "",
    header: tuple[str, ...] = (),
    **steps,
) -> ExportTable:
    contract = TableContract(required=columns, unique=unique, sensitive=sensitive, description=description)
    return ExportTable(key, file, export_type, Recipe(columns=columns, **steps), contract, header)


# Files, columns and keys of the export tables.
EXPORT_TABLES: dict[str, ExportTable] = {
    table.key: table
    for table in (
        _table(
            "connections",
            "Connections.csv",
            "complete",
            ("first_name", "last_name", "url", "email_address", "company", "position", "connected_on"),
            text_columns=("first_name", "last_name", "url", "email_address", "company", "position"),
            mixed_dates=("connected_on",),
            sensitive=("first_name", "last_name", "email_address", "url"),
            description="Network connections of the member.",
            header=("First Name", "Last Name", "URL", "Email Address", "Company", "Position", "Connected On"),
        ),
        _table(
            "positions",
            "Positions.csv",
            "basic",
            ("company_name", "title", "description", "location", "started_on", "finished_on", "is_current"),
            text_columns=("company_name", "title", "description", "location"),
            mixed_dates=("started_on", "finished_on"),
            derive=_current("is_current"),
            sensitive=("description",),
            description="Positions held and their periods.",
        ),
        _table(
            "profile",
            "Profile.csv",
            "basic",
            (
                "first_name", "last_name", "maiden_name", "address", "birth_date", "headline", "summary", "industry",
                "zip_code", "geo_location", "twitter_handles", "websites", "instant_messengers",
            ),
            text_columns=(
                "first_name", "last_name", "maiden_name", "address", "headline", "summary", "industry", "zip_code",
                "geo_location", "twitter_handles", "websites", "instant_messengers",
            ),
            mixed_dates=("birth_date",),
            sensitive=(
                "first_name", "last_name", "maiden_name", "address", "birth_date", "zip_code", "twitter_handles",
                "websites", "instant_messengers",
            ),
            description="Identity and profile attributes of the member.",
        ),
        _table(
            "languages",
            "Languages.csv",
            "basic",
            ("name", "proficiency"),
            text_columns=("name", "proficiency"),
            description="Languages on the profile with their proficiency.",
        ),
        _table(
            "education",
            "Education.csv",
            "basic",
            ("school_name", "degree_name", "notes", "started_on", "finished_on", "is_current_education"),
            synonyms={
                "school_name": ("school",),
                "degree_name": ("degree",),
                "notes": ("description",),
                "started_on": ("started", "start_date"),
                "finished_on": ("finished", "end_date"),
            },
            text_columns=("school_name", "degree_name", "notes"),
            mixed_dates=("started_on", "finished_on"),
            derive=_current("is_current_education"),
            sensitive=("notes",),
            description="Schools, degrees and their periods.",
        ),
        _table(
            "certifications",
            "Certifications.csv",
            "basic",
            ("name", "url", "authority", "started_on", "finished_on", "license_number"),
            text_columns=("name", "url", "authority", "license_number"),
            mixed_dates=("started_on", "finished_on"),
            sensitive=("license_number", "url"),
            description="Certifications and their credentials.",
        ),
        _table(
            "endorsement_received_info",
            "Endorsement_Received_Info.csv",
            "basic",
            (
                "endorsement_date", "skill_name", "endorser_first_name", "endorser_last_name", "endorser_public_url",
                "endorsement_status",
            ),
            text_columns=(
                "skill_name", "endorser_first_name", "endorser_last_name", "endorser_public_url",
                "endorsement_status",
            ),
            mixed_dates=("endorsement_date",),
            required=("skill_name",),
            distinct=True,
            unique=("endorsement_date", "skill_name", "endorser_first_name", "endorser_last_name"),
            sensitive=("endorser_first_name", "endorser_last_name", "endorser_public_url"),
            description="Endorsements received, by skill and endorser.",
        ),
        _table(
            "company_follows",
            "Company Follows.csv",
            "complete",
            ("organization", "followed_on"),
            text_columns=("organization",),
            mixed_dates=("followed_on",),
            required=("organization",),
            distinct=True,
            unique=("organization", "followed_on"),
            description="Organizations the member follows.",
        ),
        _table(
            "recommendations_received",
            "Recommendations_Received.csv",
            "complete",
            (
                "first_name", "last_name", "company", "position", "recommendation_text", "recommendation_date",
                "visibility",
            ),
            synonyms={
                "position": ("job_title",),
                "recommendation_text": ("text",),
                "recommendation_date": ("creation_date",),
                "visibility": ("status",),
            },
            text_columns=("first_name", "last_name", "company", "position", "recommendation_text", "visibility"),
            us_datetimes=("recommendation_date",),
            required=("recommendation_text",),
            distinct=True,
            unique=("first_name", "last_name", "recommendation_date"),
            sensitive=("first_name", "last_name", "recommendation_text"),
            description="Recommendations written for the member.",
        ),
        _table(
            "skills",
            "Skills.csv",
            "complete",
            ("skill_name",),
            synonyms={"skill_name": ("name",)},
            text_columns=("skill_name",),
            required=("skill_name",),
            distinct=True,
            unique=("skill_name",),
            description="Skills listed on the profile.",
        ),
        _table(
            "phone_numbers",
            "PhoneNumbers.csv",
            "basic",
            ("extension", "phone_number", "phone_type"),
            synonyms={"phone_number": ("number",), "phone_type": ("type",)},
            text_columns=("extension", "phone_number", "phone_type"),
            required=("phone_number",),
            distinct=True,
            unique=("phone_number", "phone_type"),
            sensitive=("extension", "phone_number"),
            description="Phone numbers of the account.",
        ),
        _table(
            "email_addresses",
            "Email Addresses.csv",
            "basic",
            ("email_address", "confirmed", "primary", "updated_on"),
            text_columns=("email_address", "updated_on"),
            booleans=("confirmed", "primary"),
            derive=_unknown_update,
            required=("email_address",),
            distinct=True,
            unique=("email_address",),
            sensitive=("email_address",),
            description="E-mail addresses of the account and their state.",
        ),
        _table(
            "registration",
            "Registration.csv",
            "basic",
            ("registered_at", "registration_ip", "subscription_types"),
            text_columns=("registration_ip", "subscription_types"),
            us_datetimes=("registered_at",),
            sensitive=("registration_ip",),
            description="How and when the account was registered.",
        ),
        _table(
            "saved_job_alerts",
            "SavedJobAlerts.csv",
            "complete",
            ("alert_parameters", "query_context", "saved_search_id"),
            text_columns=("alert_parameters", "query_context", "saved_search_id"),
            required=("saved_search_id",),
            distinct=True,
            unique=("saved_search_id",),
            description="Saved job searches and their alert settings.",
        ),
        _table(
            "volunteering",
            "Volunteering.csv",
            "basic",
            ("company_name", "role", "cause", "started_on", "finished_on", "description", "is_current_volunteering"),
            text_columns=("company_name", "role", "cause", "description"),
            mixed_dates=("started_on", "finished_on"),
            derive=_current("is_current_volunteering"),
            required=("company_name", "role"),
            distinct=True,
            unique=("company_name", "role", "started_on"),
            sensitive=("description",),
            description="Volunteering roles and their periods.",
        ),
        _table(
            "invitations",
            "Invitations.csv",
            "complete",
            (
                "sender_name", "recipient_name", "sent_at", "message", "direction", "inviter_profile_url",
                "invitee_profile_url",
            ),
            synonyms={
                "sender_name": ("from",),
                "recipient_name": ("to",),
                "inviter_profile_url": ("inviterprofileurl",),
                "invitee_profile_url": ("inviteeprofileurl",),
            },
            text_columns=(
                "sender_name", "recipient_name", "message", "direction", "inviter_profile_url", "invitee_profile_url",
            ),
            us_datetimes=("sent_at",),
            required=("sender_name", "recipient_name", "direction"),
            distinct=True,
            unique=("sender_name", "recipient_name", "sent_at", "direction"),
            sensitive=("sender_name", "recipient_name", "message", "inviter_profile_url", "invitee_profile_url"),
            description="Invitations sent and received.",
        ),
        _table(
            "events",
            "Events.csv",
            "complete",
            ("event_name", "event_time", "status", "external_url", "started_at", "finished_at"),
            text_columns=("event_name", "event_time", "status", "external_url"),
            derive=_event_times,
            required=("event_name",),
            distinct=True,
            unique=("event_name", "event_time"),
            sensitive=("external_url",),
            description="Events and attendance status.",
        ),
        _table(
            "learning",
            "Learning.csv",
            "complete",
            (
                "content_title", "content_description", "content_type", "last_watched_at", "completed_at",
                "content_saved", "notes_taken",
            ),
            synonyms={
                "last_watched_at": ("content_last_watched_date_(if_viewed)",),
                "completed_at": ("content_completed_at_(if_completed)",),
                "notes_taken": ("notes_taken_on_videos_(if_taken)",),
            },
            text_columns=("content_title", "content_description", "content_type", "notes_taken"),
            mixed_dates=("last_watched_at", "completed_at"),
            booleans=("content_saved",),
            required=("content_title",),
            distinct=True,
            unique=("content_title", "last_watched_at", "completed_at"),
            sensitive=("notes_taken",),
            description="Courses watched, saved and completed.",
        ),
        _table(
            "job_applications",
            "Jobs/Job Applications.csv",
            "complete",
            (
                "application_date", "contact_email", "contact_phone_number", "company_name", "job_title", "job_url",
                "resume_name", "question_and_answers",
            ),
            text_columns=(
                "contact_email", "contact_phone_number", "company_name", "job_title", "job_url", "resume_name",
                "question_and_answers",
            ),
            us_datetimes=("application_date",),
            required=("company_name", "job_title"),
            distinct=True,
            unique=("company_name", "job_title", "application_date"),
            sensitive=("contact_email", "contact_phone_number", "job_url", "question_and_answers"),
            description="Job applications and their contact data.",
        ),
    )
}


def _paths(table: ExportTable, directory: str | Sequence[str]) -> list[str]:
    return [f"{d.rstrip('/')}/{table.file}" for d in ([directory] if isinstance(directory, str) else directory)]


def read_raw(spark: SparkSession, table: ExportTable, directory: str | Sequence[str], multiline: bool = True) -> DataFrame:
    """The records of one or several export directories, rejected ones marked; files whose texts have no line breaks can be split (``multiline`` off)."""
    if table.preamble_header:
        return read_records_after_preamble(spark, _paths(table, directory), table.preamble_header)
    return read_records(spark, _paths(table, directory), multiline)


def load_table(
    spark: SparkSession,
    key: str,
    directory: str | Sequence[str],
    warehouse: Warehouse,
    loaded_at: Column | None = None,
    multiline: bool = True,
    load_id: str | None = None,
    landed: Callable[[], None] | None = None,
) -> DataFrame:
    """Land the records, clean, check, replace the bronze table, and append rejected records and the audit row.

    The CSV files are parsed once: the records go to the raw layer as they are,
    and profile, cleaning and rejects read them there. Records with more fields
    than their header are counted in the audit row and kept, as text, in
    raw.rejected_records. A load that failed can be run again under its
    ``load_id`` and leaves one audit row; without a name every call is a load
    of its own. ``landed`` is called once the raw layer has the records: this
    load does not read the files after that.
    """
    table = EXPORT_TABLES[key]
    load = f"{key}-{load_id or uuid.uuid4().hex}"
    moment = F.current_timestamp().cast("timestamp_ntz") if loaded_at is None else loaded_at
    records = warehouse.replace(read_raw(spark, table, directory, multiline), "raw", key)
    if landed:
        landed()
    cleaned = table.recipe(accepted_records(records))
    assert_columns(cleaned, table.contract)
    stored = warehouse.replace(cleaned, "bronze", key)
    source = ", ".join(_paths(table, directory))
    rejected = rejected_records(records).select(
        F.lit(key).alias("table_key"), F.lit(source).alias("source_path"), "record", moment.alias("loaded_at_utc")
    )
    warehouse.append(rejected, "raw", "rejected_records", load)
    audit = audit_row(
        records,
        stored,
        table.contract,
        table_key=key,
        source_file=table.file,
        source_path=source,
        export_type=table.export_type,
        loaded_at=moment,
        rejected=REJECTED,
    )
    warehouse.append(audit, "bronze", "ingestion_audit", load)
    return stored


def load_all(spark: SparkSession, directories: dict[str, str], warehouse: Warehouse, load_id: str | None = None) -> dict[str, int]:
    """Load every table of the given {export type: directory}, a few at a time; row counts by table."""
    keys = [key for key, table in EXPORT_TABLES.items() if table.export_type in directories]

    def load(key: str) -> int:
        return load_table(spark, key, directories[EXPORT_TABLES[key].export_type], warehouse, load_id=load_id).count()

    with shuffles_removed(spark):
        return dict(zip(keys, side_by_side(load, keys), strict=True))
