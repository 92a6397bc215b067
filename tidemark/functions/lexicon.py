"""Word lists, labels and weights whose exact content defines the results.

Keyword rules are ordered; the first rule with a matching keyword wins, so a
later, more specific keyword can be shadowed by an earlier, broader one.
"""

# Whitespace removed by a full strip (Unicode White_Space plus the ASCII separators).
STRIP_CHARACTERS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Texts that mean "no value" after stripping.
BLANK_MARKERS = ("", "nan", "None")

# Words read as booleans.
TRUE_WORDS = ("yes", "true", "1", "y", "sim")
FALSE_WORDS = ("no", "false", "0", "n", "nao", "não")

# The text an e-mail export uses for an unknown change date.
UNKNOWN_UPDATE_DATE = "Not Available"

# Fixed values: (label, keywords) rules and the default label.
CERTIFICATION_TRACKS = (
    ("microsoft", ("microsoft",)),
    ("aws", ("aws",)),
    ("google", ("google",)),
    ("oracle", ("oracle",)),
)
EDUCATION_TRACKS = (
    ("tecnologo", ("tecnólogo", "tecnologo")),
    ("bacharelado", ("bacharel",)),
    ("licenciatura", ("licenciatura",)),
    ("pos_graduacao", ("pós", "pos")),
    ("mba", ("mba",)),
    ("mestrado", ("mestrado",)),
    ("doutorado", ("doutorado",)),
)
CAREER_TRACKS = (
    ("analista", ("analista",)),
    ("engenharia", ("engenheiro",)),
    ("desenvolvimento", ("programador",)),
    ("consultoria", ("consultor",)),
    ("assistente", ("assistente",)),
)
PROFILE_TRACKS = (
    ("analista", ("analista",)),
    ("engenharia", ("engenheiro",)),
    ("desenvolvimento", ("developer",)),
)
PROFICIENCY_TRACKS = (
    ("nativo", ("native",)),
    ("fluente", ("fluent",)),
    ("profissional", ("professional", "full professional")),
    ("intermediario_profissional", ("working",)),
    ("basico", ("elementary", "limited")),
)
ENDORSEMENT_STATUSES = (
    ("accepted", ("accepted",)),
    ("pending", ("pending",)),
    ("rejected", ("rejected",)),
)
JOB_FAMILIES = (
    ("data", ("data",)),
    ("analyst", ("analista",)),
    ("engineering", ("engenheir",)),
    ("development", ("develop",)),
)
SKILL_CATEGORIES = (
    ("analytics", ("sql", "power bi", "tableau", "analytics", "data")),
    ("programming", ("python", "java", "c#", "javascript", "typescript")),
    ("cloud_data", ("azure", "aws", "cloud", "databricks")),
    ("soft_skills", ("leadership", "communication", "comunica", "team")),
)
FOLDER_CATEGORIES = {
    "Jobs": "job_data",
    "root": "core_profile",
    "Services Marketplace": "services",
    "Verifications": "trust",
}

# Display labels of classified columns.
DISPLAY_LABELS = {
    "education_track": {
        "tecnologo": "Tecnólogo",
        "bacharelado": "Bacharelado",
        "licenciatura": "Licenciatura",
        "pos_graduacao": "Pós-graduação",
        "mba": "MBA",
        "mestrado": "Mestrado",
        "doutorado": "Doutorado",
        "outros": "Outros",
    },
    "certification_track": {
        "microsoft": "Microsoft",
        "aws": "AWS",
        "google": "Google",
        "oracle": "Oracle",
        "outros": "Outros",
    },
    "proficiency_track": {
        "nativo": "Nativo",
        "fluente": "Fluente",
        "profissional": "Profissional",
        "intermediario_profissional": "Intermediário Profissional",
        "basico": "Básico",
        "outros": "Outros",
    },
    "profile_track": {
        "analista": "Analista",
        "engenharia": "Engenharia",
        "desenvolvimento": "Desenvolvimento",
        "outros": "Outros",
    },
    "summary_size_category": {
        "sem_summary": "Sem summary",
        "curta": "Curta",
        "media": "Média",
        "longa": "Longa",
    },
}

# Upper bounds (exclusive) and labels of numeric buckets.
ROW_VOLUME_BUCKETS = ((1, "vazio"), (10, "muito_pequeno"), (100, "pequeno"), (1000, "medio"))
ROW_VOLUME_TOP = "grande"
ROW_VOLUME_UNKNOWN = "erro_leitura"
SUMMARY_BUCKETS = ((100, "curta"), (500, "media"))
SUMMARY_TOP = "longa"
SUMMARY_UNKNOWN = "sem_summary"

# Score weights and caps.
PRESENCE_WEIGHTS = {"events": 0.35, "invitations": 0.35, "recommendations": 0.30}
ENGAGEMENT_WEIGHTS = {"recommendations": 0.25, "messages": 0.35, "invitations": 0.20, "events": 0.20}
MATURITY_TERMS = (
    # (column, value that earns the full weight, weight)
    ("positions_started_cumulative", 8.0, 0.35),
    ("education_started_cumulative", 4.0, 0.20),
    ("certifications_cumulative", 10.0, 0.20),
    ("avg_position_duration_cumulative", 24.0, 0.15),
    ("avg_education_duration_cumulative", 36.0, 0.10),
)

# How a history row was obtained (method, group, description).
ACTUAL_MONTHLY = "actual_monthly_aggregate"
CUMULATIVE_HISTORY = "cumulative_from_event_history"
ACTUAL_AUDIT = "actual_pipeline_audit"
HISTORY_METHODS = (
    (
        ACTUAL_MONTHLY,
        "actual",
        "Monthly aggregate built directly from real monthly marts generated from real event dates.",
    ),
    (
        CUMULATIVE_HISTORY,
        "derived_actual",
        "Cumulative series built from real dated events or real monthly aggregates, without simulated backfill.",
    ),
    (
        ACTUAL_AUDIT,
        "actual",
        "Historical audit series built directly from real pipeline audit and observability records.",
    ),
)

# Column-name rules of the anonymised copy.
PERSON_COLUMNS = (
    "first_name",
    "last_name",
    "full_name",
    "maiden_name",
    "recommender_name",
    "endorser_full_name",
)
PERSON_SUFFIX = "_name"
PERSON_EXCLUSIONS = (
    "organization",
    "company",
    "school",
    "skill",
    "category",
    "track",
    "label",
    "visibility",
    "content_type",
    "job_family",
    "status",
)
ORGANIZATION_WORDS = ("company", "organization", "school", "institution", "issuer")
ROLE_WORDS = ("position", "title", "role")
URL_WORDS = ("url", "website", "link", "twitter", "messenger")
DATE_NAME_HINTS = ("date", "_at", "_on", "timestamp")
NULLED_COLUMNS = ("address", "zip_code", "birth_date")
KEPT_URL_COLUMNS = ("portfolio_website",)
PERSON_PREFIX = "Pessoa"
ORGANIZATION_PREFIX = "Empresa"
ROLE_PREFIX = "Cargo"
LOCATION_PREFIX = "Regiao"
EMAIL_TOKEN_FORMAT = "contact%03d@example.com"
URL_TOKEN_ROOT = "https://example.com/"
REPLACED_TEXTS = {
    "headline": "Analytics engineer focused on reproducible data pipelines and portfolio storytelling.",
    "summary": (
        "Public demo summary. Personal narrative was sanitized while preserving the analytical structure, "
        "career positioning and storytelling flow used by the application."
    ),
    "recommendation_text": (
        "Public recommendation text sanitized for demo deployment. The original message was replaced while "
        "keeping the analytical experience of the page."
    ),
}
