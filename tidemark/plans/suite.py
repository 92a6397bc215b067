"""The declared data tests of every layer, and running them with one scan per table."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import contracts

# Values that classified columns may take.
EXPORT_TYPES = ("basic", "complete")
SIZE_CLASSES = ("erro_leitura", "vazio", "muito_pequeno", "pequeno", "medio", "grande")
READ_STATES = ("ok", "erro")
DATA_CATEGORIES = ("job_data", "core_profile", "services", "trust", "outros")
EDUCATION_TRACKS = ("tecnologo", "bacharelado", "licenciatura", "pos_graduacao", "mba", "mestrado", "doutorado", "outros")
CAREER_TRACKS = ("analista", "engenharia", "desenvolvimento", "consultoria", "assistente", "outros")
PROFICIENCY_TRACKS = ("nativo", "fluente", "profissional", "intermediario_profissional", "basico", "outros")
SKILL_CATEGORIES = ("analytics", "programming", "cloud_data", "soft_skills", "other")


@dataclass(frozen=True)
class Declared:
    """What is asked of a table: columns that are never NULL, and the values that columns may take."""

    not_null: tuple[str, ...]
    accepted: Mapping[str, tuple[str, ...]] = field(default_factory=dict)


_INVENTORY_CLASSES = {
    "export_type": EXPORT_TYPES,
    "categoria_dado": DATA_CATEGORIES,
    "status_leitura": READ_STATES,
    "volume_categoria": SIZE_CLASSES,
}

# The tests of each layer by table.
BRONZE: dict[str, Declared] = {
    "file_inventory": Declared(("export_name", "export_type", "file_name"), {"export_type": EXPORT_TYPES}),
    "profile": Declared(("first_name", "last_name", "headline")),
    "connections": Declared(("connected_on",)),
    "positions": Declared(("company_name", "title", "started_on", "is_current")),
    "education": Declared(("school_name",)),
    "certifications": Declared(("name", "authority")),
    "languages": Declared(("name", "proficiency")),
    "endorsement_received_info": Declared(("skill_name", "endorsement_status")),
    "company_follows": Declared(("organization", "followed_on")),
    "recommendations_received": Declared(("recommendation_text",)),
    "skills": Declared(("skill_name",)),
    "phone_numbers": Declared(("phone_number",)),
    "email_addresses": Declared(("email_address",)),
    "saved_job_alerts": Declared(("saved_search_id",)),
    "volunteering": Declared(("company_name", "role")),
    "invitations": Declared(("sender_name", "recipient_name", "direction")),
    "events": Declared(("event_name",)),
    "learning": Declared(("content_title",)),
    "job_applications": Declared(("company_name", "job_title")),
    "ingestion_audit": Declared(("table_key", "bronze_table", "export_type", "loaded_at_utc"), {"export_type": EXPORT_TYPES}),
}
STAGED: dict[str, Declared] = {
    "file_inventory": Declared(
        ("export_name", "export_type", "file_name", "read_success", "inventory_timestamp"), {"export_type": EXPORT_TYPES}
    ),
    "connections": Declared(("connected_on",)),
    "positions": Declared(("company_name", "title", "started_on", "is_current")),
    "education": Declared(("school_name", "is_current_education")),
    "certifications": Declared(("name", "authority")),
    "languages": Declared(("name", "proficiency")),
    "endorsement_received_info": Declared(("skill_name", "endorsement_status")),
    "company_follows": Declared(("organization",)),
    "recommendations_received": Declared(("recommendation_text", "visibility")),
    "skills": Declared(("skill_name",)),
    "phone_numbers": Declared(("phone_number",)),
    "email_addresses": Declared(("email_address",)),
    "saved_job_alerts": Declared(("saved_search_id",)),
    "volunteering": Declared(("company_name", "role")),
    "invitations": Declared(("sender_name", "recipient_name", "direction")),
    "events": Declared(("event_name",)),
    "learning": Declared(("content_title",)),
    "job_applications": Declared(("company_name", "job_title")),
}
ENRICHED: dict[str, Declared] = {
    "file_inventory": Declared(
        ("export_type", "file_name", "volume_categoria", "status_leitura", "categoria_dado", "inventory_timestamp"),
        _INVENTORY_CLASSES,
    ),
    "connections": Declared(("connected_on", "has_email", "connection_year", "connection_month", "connection_year_month")),
    "positions": Declared(
        (
            "company_name", "title", "started_on", "is_current", "start_year", "start_month", "start_year_month",
            "effective_end_date", "duration_months", "career_track",
        ),
        {"career_track": CAREER_TRACKS},
    ),
    "education": Declared(
        ("school_name", "is_current_education", "effective_end_date", "education_duration_months", "education_track"),
        {"education_track": EDUCATION_TRACKS},
    ),
    "certifications": Declared(("name_clean", "authority_clean")),
    "languages": Declared(
        ("name", "proficiency", "language_name_clean", "proficiency_clean", "proficiency_track"),
        {"proficiency_track": PROFICIENCY_TRACKS},
    ),
    "endorsement_received_info": Declared(("skill_name_clean", "endorsement_status_group")),
    "company_follows": Declared(("organization_clean",)),
    "recommendations_received": Declared(("recommender_name", "text_length")),
    "skills": Declared(("skill_name", "skill_name_clean", "skill_category"), {"skill_category": SKILL_CATEGORIES}),
    "saved_job_alerts": Declared(("saved_search_id",)),
    "volunteering": Declared(("company_name", "role")),
    "invitations": Declared(("sender_name", "recipient_name", "direction")),
    "events": Declared(("event_name",)),
    "learning": Declared(("content_title",)),
    "job_applications": Declared(("company_name", "job_title")),
}
MARTS: dict[str, Declared] = {
    "file_inventory_summary": Declared(
        (
            "export_type", "categoria_dado", "status_leitura", "volume_categoria", "total_arquivos", "total_linhas",
            "total_colunas", "total_tamanho_kb", "primeira_execucao_inventario", "ultima_execucao_inventario",
        ),
        _INVENTORY_CLASSES,
    ),
    "career_progression": Declared(
        (
            "start_year", "start_month", "start_year_month", "total_positions_started", "current_positions_started",
            "unique_companies", "unique_titles",
        )
    ),
    "certifications_summary": Declared(("total_certifications", "unique_certifications", "unique_authorities")),
    "company_follows_summary": Declared(("organization_clean", "follow_count")),
    "connections_summary": Declared(("connection_year", "connection_month", "connection_year_month", "total_connections")),
    "education_summary": Declared(("total_education_started", "current_education_started", "unique_schools", "unique_degrees")),
    "endorsement_received_info_summary": Declared(("skill_name_clean", "endorsement_count", "unique_endorsers")),
    "languages_summary": Declared(("proficiency_track", "total_languages", "unique_languages")),
    "pipeline_health_summary": Declared(
        (
            "total_inventory_files", "successful_reads", "failed_reads", "latest_inventory_timestamp", "total_connections",
            "total_positions", "total_recommendations",
        )
    ),
    "profile_summary": Declared(("first_name", "last_name", "headline", "profile_track")),
    "recommendations_received_summary": Declared(("total_recommendations", "avg_text_length")),
    "recommendations_received_timeline": Declared(
        ("recommendation_year", "recommendation_month", "recommendation_year_month", "total_recommendations")
    ),
    "skills_summary": Declared(("skill_category", "total_skills")),
    "saved_job_alerts_summary": Declared(("alert_frequency", "total_alerts")),
    "volunteering_summary": Declared(("cause_clean", "total_volunteering_roles")),
    "invitations_summary": Declared(("direction", "total_invitations")),
    "events_summary": Declared(("status", "total_events")),
    "learning_summary": Declared(("content_type_clean", "total_contents")),
    "job_applications_summary": Declared(("job_family", "total_applications")),
    "contact_account_summary": Declared(("total_email_addresses", "total_phone_numbers")),
}
LAYERS: dict[str, dict[str, Declared]] = {"bronze": BRONZE, "staged": STAGED, "enriched": ENRICHED, "mart": MARTS}


def table_tests(df: DataFrame, declared: Declared) -> DataFrame:
    """(test, column_name, violations): all declared tests of a table in one scan."""
    tests = [contracts.not_null(name) for name in declared.not_null]
    tests += [contracts.accepted_values(name, values) for name, values in declared.accepted.items()]
    return contracts.run_tests(df, tests)


def layer_tests(layer: str, read: Callable[[str], DataFrame]) -> DataFrame:
    """(layer, table_name, test, column_name, violations) of all tables of a layer."""
    parts = [
        table_tests(read(table), declared).select(F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "*")
        for table, declared in LAYERS[layer].items()
    ]
    return reduce(DataFrame.unionByName, parts)


def require_layer(layer: str, read: Callable[[str], DataFrame]) -> None:
    """Raise if a declared test of a layer fails, naming every failing column."""
    broken = layer_tests(layer, read).where("violations > 0").collect()  # at most one row per declared test
    if broken:
        said = ", ".join(f"{r['table_name']}.{r['column_name']} {r['test']}: {r['violations']}" for r in broken)
        raise ValueError(f"data tests failed in layer {layer}: {said}")
