"""Queries for the single operators: cleaning, contracts, functions, joins, windows, calendar, masking."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.binding import inputs
from tidemark.binding.model_queries import CLEANED, fact
from tidemark.binding.oracle_models import COUNTED, TODAY
from tidemark.binding.registry import Context, query, register
from tidemark.functions import dates, lexicon, numeric, text
from tidemark.operators import aggregates, calendar, cleaning, contracts, json_rates, masking, windows
from tidemark.plans import exports, history, insights, suite
from tidemark.plans.bronze import EXPORT_TABLES

# --- B: cleaning -------------------------------------------------------------------

_SYNONYMS = "select o_orderkey, case when o_orderkey % 2 = 0 then o_orderstatus end as start_date, o_orderpriority as started from orders"


@query(
    "b2_rename_synonyms",
    f"select o_orderkey, coalesce(start_date, started) as started_on from ({_SYNONYMS}) o",
)
def rename_synonyms(c: Context) -> DataFrame:
    return cleaning.rename_synonyms(c.sql(_SYNONYMS), {"started_on": ("start_date", "started")})


# Names padded with several kinds of whitespace, or replaced by a blank marker.
_PADDED = """
    select c_custkey, case c_custkey % 7 when 0 then 'nan' when 1 then 'None' when 2 then chr(9) || ' '
        when 3 then '' when 4 then null when 5 then chr(160) || c_name || chr(10) else ' ' || c_name || ' ' end as name
    from customer"""
_PADDED_WS = "' ' || chr(9) || chr(10) || chr(160)"


@query(
    "b4_clean_text",
    f"""select c_custkey, case when trim(name, {_PADDED_WS}) not in ('', 'nan', 'None')
        then trim(name, {_PADDED_WS}) end as name from ({_PADDED}) c""",
)
def clean_text(c: Context) -> DataFrame:
    return cleaning.clean_text_columns(c.sql(_PADDED), ["name"])


_DATE_TEXT = f"select o_orderkey, {inputs._mixed('o_orderdate')} as ordered from orders"


@query(
    "b5_parse_mixed_dates",
    f"""select o_orderkey, try_strptime(trim(ordered),
        ['%Y-%m-%d', '%Y-%m-%dT%H:%M:%S', '%d %b %Y', '%b %d, %Y', '%m/%d/%y, %I:%M %p']) as ordered
    from ({_DATE_TEXT}) o""",
)
def parse_mixed_dates(c: Context) -> DataFrame:
    return cleaning.parse_date_columns(c.sql(_DATE_TEXT), ["ordered"])


_US_TEXT = f"""select event_id, case when event_id % 10 = 0 then '13/45/26, 09:15 AM' when event_id % 10 = 1 then 'soon'
    else {inputs._us('ts')} end as sent from events"""


@query(
    "b6_parse_us_datetime",
    f"select event_id, try_strptime(sent, '%m/%d/%y, %I:%M %p') as sent from ({_US_TEXT}) e",
)
def parse_us_datetime(c: Context) -> DataFrame:
    return cleaning.parse_us_datetime_columns(c.sql(_US_TEXT), ["sent"])


def _named(ts: str) -> str:
    return f"{inputs._month_name(ts)} || ' ' || day({ts}) || ', ' || year({ts}) || ' ' || {inputs._time12(ts)}"


_RANGE_TEXT = f"""select event_id, case when event_id % 9 = 0 then 'all day'
    else {_named('ts')} || ' - ' || {_named("ts + interval '1' day")} end as slot from events"""


@query(
    "b7_split_time_range",
    f"""select event_id, try_strptime(split_part(slot, ' - ', 1), '%b %d, %Y %I:%M %p') as started_at,
        try_strptime(split_part(slot, ' - ', 2), '%b %d, %Y %I:%M %p') as finished_at from ({_RANGE_TEXT}) e""",
)
def split_time_range(c: Context) -> DataFrame:
    start, end = dates.split_range("slot")
    return c.sql(_RANGE_TEXT).select(
        "event_id",
        dates.parse_month_name_datetime(start).alias("started_at"),
        dates.parse_month_name_datetime(end).alias("finished_at"),
    )


_FLAG_TEXT = """select o_orderkey, case o_orderkey % 9 when 0 then ' Yes' when 1 then 'NO' when 2 then 'sim'
    when 3 then 'não' when 4 then '1' when 5 then 'maybe' when 6 then '' when 7 then null else 'Nao ' end as flag
    from orders"""


@query(
    "b8_parse_booleans",
    f"""select o_orderkey, case lower(trim(flag)) when 'yes' then true when 'sim' then true when '1' then true
        when 'no' then false when 'nao' then false when 'não' then false end as flag from ({_FLAG_TEXT}) o""",
)
def parse_booleans(c: Context) -> DataFrame:
    return cleaning.parse_boolean_columns(c.sql(_FLAG_TEXT), ["flag"])


@query(
    "b9_sentinel_to_null",
    "select o_orderkey, nullif(o_orderpriority, '4-NOT SPECIFIED') as priority from orders",
)
def sentinel_to_null(c: Context) -> DataFrame:
    return c.table("orders").select(
        "o_orderkey", text.sentinel_to_null("o_orderpriority", "4-NOT SPECIFIED").alias("priority")
    )


@query(
    "b10_current_flag",
    """select is_open, count(*) as n from (
        select case when l_linenumber = 1 then null else l_shipdate end is null as is_open from lineitem) l
    group by all""",
)
def current_flag(c: Context) -> DataFrame:
    ended = F.when(F.col("l_linenumber") != 1, F.col("l_shipdate"))
    flagged = c.table("lineitem").select(ended.alias("ended")).select(cleaning.current_flag("ended").alias("is_open"))
    return flagged.groupBy("is_open").agg(F.count(F.lit(1)).alias("n"))


@query(
    "b11_drop_blank_rows",
    f"select c_custkey, name from ({_PADDED}) c where trim(name, {_PADDED_WS}) <> ''",
)
def drop_blank_rows(c: Context) -> DataFrame:
    return cleaning.drop_blank_rows(c.sql(_PADDED), ["name"])


@query(
    "b12_deduplicate",
    "select distinct l_suppkey, l_returnflag, l_linestatus from lineitem",
)
def deduplicate(c: Context) -> DataFrame:
    return cleaning.deduplicate(c.table("lineitem").select("l_suppkey", "l_returnflag", "l_linestatus"))


@query(
    "b12_deduplicate_by_key",
    """select o_custkey, o_orderdate, o_orderkey, o_totalprice from orders
    qualify row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) = 1""",
)
def deduplicate_by_key(c: Context) -> DataFrame:
    orders = c.table("orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return cleaning.deduplicate(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query(
    "b14_text_helpers",
    f"""select c_custkey, cast(c_custkey as varchar) as as_text, trim(name, ' ') as trimmed,
        nullif(trim(name, ' '), '') as blank_null, lower(trim(name, ' ')) as lowered, upper(trim(name, ' ')) as uppered
    from ({_PADDED}) c""",
)
def text_helpers(c: Context) -> DataFrame:
    return c.sql(_PADDED).select(
        "c_custkey",
        text.as_text("c_custkey").alias("as_text"),
        text.trim_text("name").alias("trimmed"),
        text.nullif_trim_text("name").alias("blank_null"),
        text.lower_trim_text("name").alias("lowered"),
        text.upper_trim_text("name").alias("uppered"),
    )


@query(
    "b15_display_labels",
    """select p_partkey,
        list_aggregate(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])),
            'string_agg', ' ') as title,
        case p_type when 'ECONOMY' then 'Econômico' else upper(p_type[1]) || lower(p_type[2:]) end as label
    from part""",
)
def display_labels(c: Context) -> DataFrame:
    return c.table("part").select(
        "p_partkey",
        text.title_case("p_name").alias("title"),
        text.display_label("p_type", {"ECONOMY": "Econômico"}).alias("label"),
    )


@query(
    "b15_labelled_tracks",
    """select case education_track when 'tecnologo' then 'Tecnólogo' when 'bacharelado' then 'Bacharelado'
            when 'licenciatura' then 'Licenciatura' when 'pos_graduacao' then 'Pós-graduação' when 'mba' then 'MBA'
            when 'mestrado' then 'Mestrado' when 'doutorado' then 'Doutorado' when 'outros' then 'Outros' end
            as education_track, count(*) as total_records from int_education group by all""",
)
def labelled_tracks(c: Context) -> DataFrame:
    return insights.for_display(insights.education_tracks(c.models))


# --- C: contracts and tests -----------------------------------------------------------

_ORDERS_CONTRACT = contracts.TableContract(
    required=("o_orderkey", "o_custkey", "o_comment"),
    non_empty=("o_orderstatus", "o_orderpriority"),
    unique=("o_custkey", "o_orderstatus"),
)


@query(
    "c1_validate_contract",
    """select count(*) as row_count, 'o_comment' as missing_columns,
        count(*) - (select count(*) from (select distinct o_custkey, o_orderstatus from orders) k) as duplicate_rows,
        count(*) filter (where trim(ifnull(o_orderstatus, '')) = '')
            + count(*) filter (where trim(ifnull(o_orderpriority, '')) = '') as blank_required_values
    from orders""",
)
def validate_contract(c: Context) -> DataFrame:
    return contracts.validate_contract(c.table("orders"), _ORDERS_CONTRACT)


def _audit_oracle(table: str) -> str:
    contract = EXPORT_TABLES[table].contract
    columns, raw_columns = len(contract.required), len(inputs._RAW_COLUMNS[table])
    # the constant makes the key a row, so that NULLs count as values
    distinct = f"count(distinct ({', '.join(contract.unique)}, 1))" if contract.unique else "count(*)"
    return f"""
        select '{table}' as table_key, s.n as source_row_count, cast({raw_columns} as bigint) as source_column_count,
            t.n as row_count_after_transform, cast({columns} as bigint) as column_count_after_transform,
            s.n - t.n as rows_removed_during_transform, t.n - t.k as duplicate_rows_after_transform
        from (select count(*) as n from raw_{table}) s,
            (select count(*) as n, {distinct} as k from ({CLEANED[table]}) x) t"""


@query("c3_load_audit", " union all ".join(_audit_oracle(table) for table in CLEANED))
def load_audit(c: Context) -> DataFrame:
    rows = []
    for key in CLEANED:
        table = EXPORT_TABLES[key]
        raw = c.raw(key)
        rows.append(
            contracts.audit_row(
                raw,
                table.recipe(raw),
                table.contract,
                table_key=key,
                source_file=table.file,
                source_path="",
                export_type=table.export_type,
                loaded_at=F.lit(None).cast("timestamp_ntz"),
            )
        )
    united = reduce(DataFrame.unionByName, rows)
    return united.select(
        "table_key",
        "source_row_count",
        "source_column_count",
        "row_count_after_transform",
        "column_count_after_transform",
        "rows_removed_during_transform",
        "duplicate_rows_after_transform",
    )


_MASKED = """select case when o_orderkey % 3 = 0 then null else o_orderkey end as order_number,
    case when o_custkey % 7 = 0 then null else o_orderstatus end as status, o_orderdate from orders"""


@query(
    "c4_null_rates",
    f"""unpivot (select round(1 - count(order_number) / cast(count(*) as double), 4) as order_number,
            round(1 - count(status) / cast(count(*) as double), 4) as status,
            round(1 - count(o_orderdate) / cast(count(*) as double), 4) as o_orderdate from ({_MASKED}) o)
    on order_number, status, o_orderdate into name column_name value null_rate""",
)
def null_rates(c: Context) -> DataFrame:
    return contracts.null_rates(c.sql(_MASKED))


def _history_rules_oracle(name: str) -> str:
    contract = history.CONTRACTS[f"fact_snapshot_{name}"]
    rules = [("null_date", "snapshot_date", "snapshot_date is null")]
    rules += [("simulated", "is_simulated_snapshot", "is_simulated_snapshot")]
    rules += [("null_method", "snapshot_method", "snapshot_method is null")]
    rules += [("negative", column, f"{column} < 0") for column in contract.non_negative]
    rules += [("out_of_range", column, f"{column} < 0 or {column} > 1") for column in contract.ratios]
    selects = [
        f"select 'fact_snapshot_{name}' as table_name, '{rule}' as rule, '{column}' as column_name, "
        f"count(*) filter (where {test}) as violations from fact_{name}"
        for rule, column, test in rules
    ]
    selects.append(
        f"select 'fact_snapshot_{name}' as table_name, 'no_rows' as rule, '*' as column_name, "
        f"cast(count(*) = 0 as bigint) as violations from fact_{name}"
    )
    return " union all ".join(selects)


_FACTS = ("network_growth", "applications", "presence", "career_education", "data_quality")


@query("c5_history_contracts", " union all ".join(_history_rules_oracle(n) for n in _FACTS))
def history_contracts(c: Context) -> DataFrame:
    return history.check_facts({f"fact_snapshot_{n}": fact(c, n) for n in _FACTS})


@query(
    "c7_not_null_tests",
    """select 'orders' as table_name, 'o_orderkey' as column_name, count(*) filter (where o_orderkey is null) as violations from orders
    union all select 'orders', 'o_orderdate', count(*) filter (where o_orderdate is null) from orders
    union all select 'connections', 'last_name', count(*) filter (where last_name is null) from stg_connections
    union all select 'connections', 'connected_on', count(*) filter (where connected_on is null) from stg_connections
    union all select 'documents', 'text', count(*) filter (where text is null) from documents""",
)
def not_null_tests(c: Context) -> DataFrame:
    checked = {
        "orders": (c.table("orders"), ("o_orderkey", "o_orderdate")),
        "connections": (c.models.staged("connections"), ("last_name", "connected_on")),
        "documents": (c.table("documents"), ("text",)),
    }
    parts = [
        contracts.run_tests(df, [contracts.not_null(n) for n in names]).select(
            F.lit(table).alias("table_name"), "column_name", "violations"
        )
        for table, (df, names) in checked.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_CTE_PREFIXES = {"bronze": "bronze_", "staged": "stg_", "enriched": "int_", "mart": "mart_"}


def _suite_oracle(layer: str) -> str:
    selects = []
    for table, declared in suite.LAYERS[layer].items():
        source = _CTE_PREFIXES[layer] + table.replace("pipeline_", "")
        bad = [("not_null", c, f"{c} is null") for c in declared.not_null]
        bad += [("accepted_values", c, f"{c} not in ({', '.join(map(repr, v))})") for c, v in declared.accepted.items()]
        selects += [
            f"select '{layer}' as layer, '{table}' as table_name, '{test}' as test, '{column}' as column_name, "
            f"count(*) filter (where {broken}) as violations from {source}"
            for test, column, broken in bad
        ]
    return " union all ".join(selects)


def _register_suite(layer: str) -> None:
    def run(c: Context) -> DataFrame:
        read = {"bronze": c.models.bronze, "staged": c.models.staged, "enriched": c.models.enriched, "mart": c.models.mart}
        return suite.layer_tests(layer, read[layer])

    register(f"c7_declared_tests_{layer}", run, _suite_oracle(layer))


for _layer in suite.LAYERS:
    _register_suite(_layer)


# Values each classified column may take, as tested on the enriched models and marts.
ACCEPTED = {
    "career_track": ("positions", ("analista", "engenharia", "desenvolvimento", "consultoria", "assistente", "outros")),
    "education_track": (
        "education",
        ("tecnologo", "bacharelado", "licenciatura", "pos_graduacao", "mba", "mestrado", "doutorado", "outros"),
    ),
    "proficiency_track": (
        "languages",
        ("nativo", "fluente", "profissional", "intermediario_profissional", "basico", "outros"),
    ),
    "skill_category": ("skills", ("analytics", "programming", "cloud_data", "soft_skills", "other")),
    "summary_size_category": ("profile", ("sem_summary", "curta", "media", "longa")),
    "status_leitura": ("file_inventory", ("ok", "erro")),
    # Deliberately short, so that violations occur.
    "volume_categoria": ("file_inventory", ("vazio", "grande")),
}


@query(
    "c8_accepted_values",
    " union all ".join(
        f"select '{table}' as table_name, '{column}' as column_name, "
        f"count(*) filter (where {column} not in ({', '.join(repr(v) for v in values)})) as violations from int_{table}"
        for column, (table, values) in ACCEPTED.items()
    ),
)
def accepted_values(c: Context) -> DataFrame:
    by_table: dict[str, list] = {}
    for column, (table, values) in ACCEPTED.items():
        by_table.setdefault(table, []).append(contracts.accepted_values(column, values))
    parts = [
        contracts.run_tests(c.models.enriched(table), tests).select(
            F.lit(table).alias("table_name"), "column_name", "violations"
        )
        for table, tests in by_table.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# Every other month breaks the rule.
_TOO_MANY = "select * replace (cast(current_positions_started + 1000 * (start_month % 2) as bigint) as current_positions_started) from mart_career_progression"


@query("c9_current_within_total", f"select * from ({_TOO_MANY}) m where current_positions_started > total_positions_started")
def current_within_total(c: Context) -> DataFrame:
    planted = F.col("current_positions_started") + 1000 * (F.col("start_month") % 2)
    return contracts.current_within_total(c.models.mart("career_progression").withColumn("current_positions_started", planted))


@query(
    "c10_email_within_total",
    """select * from (select * replace (cast(total_connections + connection_month % 3 as bigint) as connections_with_email)
        from mart_connections_summary) m where connections_with_email > total_connections""",
)
def email_within_total(c: Context) -> DataFrame:
    planted = F.col("total_connections") + F.col("connection_month") % 3
    return contracts.email_within_total(c.models.mart("connections_summary").withColumn("connections_with_email", planted))


@query(
    "c11_reads_add_up",
    "select * from mart_health_summary where total_inventory_files <> successful_reads + failed_reads",
)
def reads_add_up(c: Context) -> DataFrame:
    return contracts.reads_add_up(c.models.mart("pipeline_health_summary"))


@query(
    "c12_counters_non_negative",
    "select * from (select * replace (cast(successful_reads - total_inventory_files - 1 as bigint) as failed_reads) from mart_health_summary) m "
    "where least(total_inventory_files, successful_reads, failed_reads, " + ", ".join(COUNTED) + ") < 0",
)
def counters_non_negative(c: Context) -> DataFrame:
    planted = F.col("successful_reads") - F.col("total_inventory_files") - 1
    return contracts.counters_non_negative(c.models.mart("pipeline_health_summary").withColumn("failed_reads", planted))


# --- D: scalar functions -----------------------------------------------------------------


@query(
    "d1_trim_and_case",
    "select s_suppkey, trim(' ' || s_name || ' ') as trimmed, lower(s_name) as lowered, upper(s_name) as uppered, "
    "cast(s_nationkey as varchar) as nation_text from supplier",
)
def trim_and_case(c: Context) -> DataFrame:
    padded = F.concat(F.lit(" "), "s_name", F.lit(" "))
    return c.table("supplier").select(
        "s_suppkey",
        text.trim_text(padded).alias("trimmed"),
        text.lower_trim_text("s_name").alias("lowered"),
        text.upper_trim_text("s_name").alias("uppered"),
        text.as_text("s_nationkey").alias("nation_text"),
    )


@query(
    "d2_null_handling",
    """select o_orderkey, coalesce(nullif(o_orderstatus, 'O'), nullif(o_orderpriority, '1-URGENT'), 'none') as known
    from orders""",
)
def null_handling(c: Context) -> DataFrame:
    known = F.coalesce(
        F.nullif("o_orderstatus", F.lit("O")), F.nullif("o_orderpriority", F.lit("1-URGENT")), F.lit("none")
    )
    return c.table("orders").select("o_orderkey", known.alias("known"))


_PARTED = "select p_partkey, nullif(p_type, 'ECONOMY') as a, p_brand as b from part"


@query(
    "d3_concatenation",
    f"select p_partkey, concat(a, ' ', b) as skipping, a || ' ' || b as propagating from ({_PARTED}) p",
)
def concatenation(c: Context) -> DataFrame:
    return c.sql(_PARTED).select(
        "p_partkey",
        F.concat_ws("", "a", F.lit(" "), "b").alias("skipping"),
        F.concat("a", F.lit(" "), "b").alias("propagating"),
    )


@query("d4_text_length", "select doc_id, length(text) as text_length from documents")
def text_length(c: Context) -> DataFrame:
    return c.table("documents").select("doc_id", F.char_length("text").cast("long").alias("text_length"))


@query(
    "d5_classify_keywords",
    """select p_partkey, case when lower(p_name) like '%ring%' or lower(p_name) like '%bolt%' then 'fastener'
        when lower(p_name) like '%gear%' or lower(p_name) like '%gizmo%' then 'machine'
        when lower(p_name) like '%blue%' then 'blue' else 'other' end as part_kind from part""",
)
def classify_keywords(c: Context) -> DataFrame:
    rules = (("fastener", ("ring", "bolt")), ("machine", ("gear", "gizmo")), ("blue", ("blue",)))
    return c.table("part").select("p_partkey", text.classify(F.lower("p_name"), rules, "other").alias("part_kind"))


@query(
    "d6_mention_flags",
    """select doc_id, cast(lower(text) like '%the%' as int) as mentions_the,
        cast(lower(text) like '%license%' as int) as mentions_license, lower(text) like '%@%' as has_at from documents""",
)
def mention_flags(c: Context) -> DataFrame:
    return c.table("documents").select(
        "doc_id",
        text.mention_count_flag("text", "the").alias("mentions_the"),
        text.mention_count_flag("text", "license").alias("mentions_license"),
        text.mentions("text", "@").alias("has_at"),
    )


@query(
    "d7_presence_flag",
    "select d.doc_id, quality is not null as is_labelled from documents d left join labels l on d.doc_id = l.doc_id",
)
def presence_flag(c: Context) -> DataFrame:
    joined = c.table("documents").select("doc_id").join(c.table("labels"), "doc_id", "left")
    return joined.select("doc_id", text.is_present("quality").alias("is_labelled"))


@query(
    "d8_regex_extract",
    r"""select page_id, nullif(regexp_extract(url, '^https?://([^/]+)/', 1), '') as host,
        nullif(regexp_extract(url, '[?&]utm_source=([^&#]+)', 1), '') as utm_source,
        nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '') is not null as has_title from pages""",
)
def regex_extract(c: Context) -> DataFrame:
    return c.table("pages").select(
        "page_id",
        text.extract_or_null("url", r"^https?://([^/]+)/").alias("host"),
        text.extract_or_null("url", r"[?&]utm_source=([^&#]+)").alias("utm_source"),
        text.is_present(text.extract_or_null("html", r"<title>([^<]*)</title>")).alias("has_title"),
    )


@query(
    "d9_numeric_buckets",
    """select case when n_chars is null then 'sem_summary' when n_chars < 100 then 'curta' when n_chars < 500 then 'media'
        else 'longa' end as size_category, count(*) as n from documents group by all""",
)
def numeric_buckets(c: Context) -> DataFrame:
    size = numeric.bucket("n_chars", lexicon.SUMMARY_BUCKETS, lexicon.SUMMARY_TOP, lexicon.SUMMARY_UNKNOWN)
    return aggregates.counts_by(c.table("documents").select(size.alias("size_category")), "size_category", "n")


@query(
    "d10_date_parts",
    """select o_orderkey, year(o_orderdate) as year, month(o_orderdate) as month,
        strftime(o_orderdate, '%Y-%m') as year_month from orders""",
)
def date_parts(c: Context) -> DataFrame:
    day = F.col("o_orderdate")
    return c.table("orders").select(
        "o_orderkey",
        dates.year_of(day).alias("year"),
        dates.month_of(day).alias("month"),
        dates.year_month(day).alias("year_month"),
    )


@query(
    "d11_calendar_differences",
    """select date_diff('month', o_orderdate, l_shipdate) as months, date_diff('year', o_orderdate, l_shipdate) as years,
        count(*) as n from lineitem join orders on l_orderkey = o_orderkey group by all""",
)
def calendar_differences(c: Context) -> DataFrame:
    joined = c.table("lineitem").join(c.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    months = dates.months_between("o_orderdate", "l_shipdate").alias("months")
    years = dates.years_between("o_orderdate", "l_shipdate").alias("years")
    return joined.groupBy(months, years).agg(F.count(F.lit(1)).alias("n"))


@query(
    "d12_effective_end",
    f"""select l_returnflag, case when l_linenumber = 1 then {TODAY} else cast(l_shipdate as date) end as ended_on,
        count(*) as n from lineitem group by all""",
)
def effective_end(c: Context) -> DataFrame:
    today = dates.as_of_column(c.models.settings.as_of)
    end = F.when(F.col("l_linenumber") == 1, today).otherwise(F.col("l_shipdate").cast("date")).alias("ended_on")
    return c.table("lineitem").groupBy("l_returnflag", end).agg(F.count(F.lit(1)).alias("n"))


@query(
    "d13_round_and_try_cast",
    """select event_id, round(value, 1) as value_rounded,
        try_cast(if(event_id % 5 = 0, event_type, cast(event_id as varchar) || '.5') as double) as parsed from events""",
)
def round_and_try_cast(c: Context) -> DataFrame:
    mixed = F.when(F.col("event_id") % 5 == 0, F.col("event_type")).otherwise(
        F.concat(F.col("event_id").cast("string"), F.lit(".5"))
    )
    return c.table("events").select(
        "event_id", F.round("value", 1).alias("value_rounded"), mixed.try_cast("double").alias("parsed")
    )


@query(
    "d14_json_to_rows",
    """select event_type, key, count(*) as n, sum(amount) as total from (
        select event_type, unnest(json_keys(props)) as key, try_cast(props ->> key as double) as amount from events) e
    group by all""",
)
def json_to_rows(c: Context) -> DataFrame:
    rows = json_rates.explode_rates(c.table("events").select("event_type", "props"), "props", "key", "amount")
    present = rows.where(F.col("key").isNotNull())
    return present.groupBy("event_type", "key").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total"))


@query(
    "d15_month_end",
    """select strftime(o_orderdate, '%Y-%m') as year_month, last_day(any_value(cast(o_orderdate as date))) as month_end
    from orders group by strftime(o_orderdate, '%Y-%m')""",
)
def month_end(c: Context) -> DataFrame:
    months = c.table("orders").select(dates.year_month("o_orderdate").alias("year_month")).distinct()
    return months.withColumn("month_end", dates.month_end("year_month"))


@query(
    "d16_safe_ratio",
    """select o_custkey, case when sum(shipped) > 0 then sum(urgent) / cast(sum(shipped) as double) else 0 end as share from (
        select o_custkey, cast(o_orderpriority = '1-URGENT' as int) as urgent, cast(o_orderstatus = 'F' as int) as shipped
        from orders) o group by all""",
)
def safe_ratio(c: Context) -> DataFrame:
    urgent = numeric.count_if(F.col("o_orderpriority") == "1-URGENT")
    shipped = numeric.count_if(F.col("o_orderstatus") == "F")
    sums = c.table("orders").groupBy("o_custkey").agg(urgent.alias("u"), shipped.alias("s"))
    return sums.select("o_custkey", numeric.safe_ratio("u", "s").alias("share"))


@query(
    "d17_clip_to_unit",
    "select c_custkey, least(greatest(c_acctbal / 5000, 0), 1) as clipped from customer",
)
def clip_to_unit(c: Context) -> DataFrame:
    return c.table("customer").select("c_custkey", numeric.clip_unit(F.col("c_acctbal") / 5000).alias("clipped"))


# --- H, W, X, Y: joins, windows, sets, sorts ------------------------------------------------


@query(
    "h1_side_by_side_totals",
    """select (select count(*) from orders) as orders, (select max(o_orderdate) from orders) as last_order,
        (select count(*) from events) as events, (select count(distinct user_id) from events) as users""",
)
def side_by_side_totals(c: Context) -> DataFrame:
    return aggregates.one_row(
        c.table("orders").agg(F.count(F.lit(1)).alias("orders"), F.max("o_orderdate").alias("last_order")),
        c.table("events").agg(F.count(F.lit(1)).alias("events"), F.countDistinct("user_id").alias("users")),
    )


_AUDIT_JSON = "select table_key, loaded_at_utc, null_rate_by_column_json, source_null_rate_by_column_json from stg_ingestion_audit"


@query(
    "h2_lateral_json_keys",
    """select a.table_key, a.loaded_at_utc, k.key as monitored_column from stg_ingestion_audit a
    left join lateral (select unnest(json_keys(a.null_rate_by_column_json)) as key) k on true""",
)
def lateral_json_keys(c: Context) -> DataFrame:
    audit = c.models.staged("ingestion_audit").select("table_key", "loaded_at_utc", "null_rate_by_column_json")
    rows = json_rates.explode_rates(audit, "null_rate_by_column_json", "monitored_column", "rate")
    return rows.select("table_key", "loaded_at_utc", "monitored_column")


@query(
    "h3_json_key_lookup",
    """select table_key, loaded_at_utc, key as monitored_column,
        try_cast(source_null_rate_by_column_json ->> key as double) as null_rate_before from (
            select *, unnest(json_keys(null_rate_by_column_json)) as key from stg_ingestion_audit) a""",
)
def json_key_lookup(c: Context) -> DataFrame:
    audit = c.models.staged("ingestion_audit")
    rows = json_rates.explode_rates(audit, "null_rate_by_column_json", "monitored_column", "rate")
    rows = rows.where(F.col("monitored_column").isNotNull())
    found = json_rates.lookup_rates(rows, "source_null_rate_by_column_json", "monitored_column", "null_rate_before")
    return found.select("table_key", "loaded_at_utc", "monitored_column", "null_rate_before")


_SPINE = {
    "orders": ("orders", "o_orderdate", "orders_in_month"),
    "shipments": ("lineitem", "l_shipdate", "shipments_in_month"),
    "clicks": ("events", "ts", "events_in_month"),
}


def _per_month(c: Context) -> list[DataFrame]:
    return [
        c.table(table)
        .groupBy(F.year(day).alias("y"), F.month(day).alias("m"))
        .agg(F.count(F.lit(1)).alias(count))
        .select(dates.year_month_from_parts("y", "m").alias("ym"), count)
        for table, day, count in _SPINE.values()
    ]


_MONTH_CTES = ", ".join(
    f"{name} as (select strftime({day}, '%Y-%m') as ym, count(*) as {count} from {table} group by all)"
    for name, (table, day, count) in _SPINE.items()
).replace("orders as (", "o as (").replace("shipments as (", "s as (").replace("clicks as (", "e as (")


@query(
    "h4_join_on_month_spine",
    f"""with {_MONTH_CTES}, spine as (select ym from o union select ym from s union select ym from e)
    select ym, ifnull(orders_in_month, 0) as orders_in_month, ifnull(shipments_in_month, 0) as shipments_in_month,
        ifnull(events_in_month, 0) as events_in_month
    from spine left join o using (ym) left join s using (ym) left join e using (ym)""",
)
def join_on_month_spine(c: Context) -> DataFrame:
    counts = {count: 0 for _, _, count in _SPINE.values()}
    return windows.spread_on_months(_per_month(c), "ym", counts)


@query(
    "h5_three_key_left_join",
    """select o.day, o.status, o.ym, o.orders, l.shipments from (
        select cast(o_orderdate as date) as day, strftime(o_orderdate, '%Y-%m') as ym, o_orderstatus as status,
            count(*) as orders from orders group by all) o
    left join (select cast(l_shipdate as date) as day, strftime(l_shipdate, '%Y-%m') as ym, l_linestatus as status,
            count(*) as shipments from lineitem group by all) l
        on o.day = l.day and o.ym = l.ym and o.status = l.status""",
)
def three_key_left_join(c: Context) -> DataFrame:
    def daily(table: str, day: str, status: str, count: str) -> DataFrame:
        grouped = c.table(table).groupBy(F.col(day).cast("date").alias("day"), F.col(status).alias("status"))
        return grouped.agg(F.count(F.lit(1)).alias(count)).withColumn("ym", dates.year_month("day"))

    orders = daily("orders", "o_orderdate", "o_orderstatus", "orders")
    shipped = daily("lineitem", "l_shipdate", "l_linestatus", "shipments")
    return orders.join(shipped, ["day", "ym", "status"], "left")


def _order_calendar(c: Context) -> DataFrame:
    bounds = calendar.date_range([(c.table("orders"), ["o_orderdate"])])
    return calendar.build_calendar(bounds)


@query(
    "h6_facts_per_calendar",
    """select year(l_shipdate) as year, 'Q' || quarter(l_shipdate) as quarter_label, count(*) as shipments from lineitem
    where l_shipdate <= (select last_day(max(o_orderdate)) + interval '1' day - interval '1' second from orders)
        and l_shipdate >= (select date_trunc('month', min(o_orderdate)) from orders)
    group by all""",
)
def facts_per_calendar(c: Context) -> DataFrame:
    return calendar.facts_per_calendar(
        _order_calendar(c), c.table("lineitem"), "l_shipdate", ["year", "quarter_label"], "shipments"
    )


@query(
    "h6_orphan_days",
    """select distinct cast(l_shipdate as date) as date from lineitem
    where cast(l_shipdate as date) > (select last_day(max(o_orderdate)) from orders)
        or l_shipdate < (select date_trunc('month', min(o_orderdate)) from orders)""",
)
def orphan_days(c: Context) -> DataFrame:
    return calendar.orphan_days(_order_calendar(c), c.table("lineitem"), "l_shipdate")


@query(
    "w1_change_vs_previous",
    """select event_type, day, n, n - lag(n) over (partition by event_type order by day) as change from (
        select event_type, cast(ts as date) as day, count(*) as n from events group by all) d""",
)
def change_vs_previous(c: Context) -> DataFrame:
    daily = c.table("events").groupBy("event_type", F.col("ts").cast("date").alias("day"))
    counted = daily.agg(F.count(F.lit(1)).alias("n"))
    return windows.with_changes(counted, {"n": "change"}, ["event_type"], ["day"])


@query(
    "w2_change_per_key_pair",
    """select user_id, event_type, day, n, n - lag(n) over (partition by user_id, event_type order by day) as change from (
        select user_id, event_type, cast(ts as date) as day, count(*) as n from events where event_type <> 'error'
        group by all) d""",
)
def change_per_key_pair(c: Context) -> DataFrame:
    kept = c.table("events").where(F.col("event_type") != "error")
    daily = kept.groupBy("user_id", "event_type", F.col("ts").cast("date").alias("day"))
    counted = daily.agg(F.count(F.lit(1)).alias("n"))
    return windows.with_changes(counted, {"n": "change"}, ["user_id", "event_type"], ["day"])


_ORDER_MONTHS = "select strftime(o_orderdate, '%Y-%m') as ym, count(*) as n from orders group by all"


def _order_months(c: Context) -> DataFrame:
    return _per_month(c)[0].withColumnRenamed("orders_in_month", "n")


@query(
    "w3_running_total",
    f"select ym, n, cast(sum(n) over (order by ym rows unbounded preceding) as bigint) as total from ({_ORDER_MONTHS}) m",
)
def running_total(c: Context) -> DataFrame:
    return _order_months(c).withColumn("total", windows.running_total("n", "ym"))


@query(
    "w4_month_over_month",
    f"""select ym, n, ifnull(n - lag(n) over (order by ym), 0) as delta,
        ifnull((n - lag(n) over (order by ym)) / cast(lag(n) over (order by ym) as double), 0) as growth
    from ({_ORDER_MONTHS}) m""",
)
def month_over_month(c: Context) -> DataFrame:
    return _order_months(c).withColumns(
        {"delta": windows.delta_vs_previous("n", "ym"), "growth": windows.growth_vs_previous("n", "ym")}
    )


@query(
    "w5_running_weighted_mean",
    """select ym, round(sum(mean * n) over w / sum(n) over w, 6) as running_mean from (
        select strftime(l_shipdate, '%Y-%m') as ym, count(*) as n, avg(l_quantity) as mean from lineitem group by all) m
    window w as (order by ym rows unbounded preceding)""",
)
def running_weighted_mean(c: Context) -> DataFrame:
    months = (
        c.table("lineitem")
        .groupBy(F.year("l_shipdate").alias("y"), F.month("l_shipdate").alias("m"))
        .agg(F.count(F.lit(1)).alias("n"), F.avg("l_quantity").alias("mean"))
        .select(dates.year_month_from_parts("y", "m").alias("ym"), "n", "mean")
    )
    return months.select("ym", F.round(windows.running_weighted_mean("mean", "n", "ym"), 6).alias("running_mean"))


@query(
    "x1_union_of_counts",
    " union all ".join(
        f"select '{t}' as domain_name, count(*) as total_records from {t}" for t in inputs.DRIVER_TABLES
    ),
)
def union_of_counts(c: Context) -> DataFrame:
    return aggregates.labelled_counts({t: c.table(t) for t in inputs.DRIVER_TABLES})


@query(
    "x2_distinct_month_union",
    f"with {_MONTH_CTES} select ym from o union select ym from s union select ym from e",
)
def distinct_month_union(c: Context) -> DataFrame:
    return windows.month_spine(_per_month(c), "ym")


@query(
    "y1_order_nulls_last",
    "select connected_on, company, last_name from stg_connections",
)
def order_nulls_last(c: Context) -> DataFrame:
    staged = c.models.staged("connections").select("connected_on", "company", "last_name")
    return staged.orderBy(*insights.order_keys(("-connected_on",), staged.columns))


@query(
    "y2_top_k",
    "select cast(o_custkey as varchar) as customer, count(*) as orders from orders group by all order by orders desc, customer limit 10",
)
def top_k(c: Context) -> DataFrame:
    named = c.table("orders").select(F.col("o_custkey").cast("string").alias("key"))
    return aggregates.top_k(named, "key", "orders").withColumnRenamed("key", "customer")


@query(
    "y3_latest_connections",
    """select full_name, company, position, email_address, connected_on, connection_year_month, has_email
    from int_connections order by connected_on desc nulls last, full_name nulls last, company nulls last,
        position nulls last, email_address nulls last, profile_url nulls last limit 200""",
)
def latest_connections(c: Context) -> DataFrame:


    return insights.latest_connections(c.models)


@query("y4_distinct_values", "select distinct url as value from pages where trim(url) <> ''")
def distinct_values(c: Context) -> DataFrame:
    return aggregates.distinct_values(c.table("pages"), "url")


# --- K: calendar and declared exports ---------------------------------------------------------


@query(
    "k1_calendar",
    """select cast(d as date) as date, cast(strftime(d, '%Y%m%d') as bigint) as date_key, year(d) as year,
        quarter(d) as quarter_number, month(d) as month_number, monthname(d) as month_name,
        strftime(d, '%b') as month_name_short, strftime(d, '%Y-%m') as year_month,
        strftime(d, '%Y-%b') as year_month_label, if(month(d) <= 6, 1::bigint, 2) as semester_number,
        'S' || if(month(d) <= 6, 1, 2) as semester_label, (month(d) + 1) // 2 as bimester_number,
        'B' || ((month(d) + 1) // 2) as bimester_label, weekofyear(d) as week_of_year, day(d) as day,
        isodow(d) as day_of_week_number, dayname(d) as day_of_week_name, isodow(d) in (6, 7) as is_weekend,
        'Q' || quarter(d) as quarter_label, year(d) || '-S' || if(month(d) <= 6, 1, 2) as half_year_label,
        year(d) || '-B' || ((month(d) + 1) // 2) as bimester_year_label, cast(year(d) as varchar) as year_label
    from (
        select unnest(generate_series(date_trunc('month', lo), cast(last_day(hi) as timestamp), interval '1' day)) as d
        from (select least((select min(o_orderdate) from orders), (select min(l_shipdate) from lineitem),
                    (select min(ts) from events)) as lo,
                greatest((select max(o_orderdate) from orders), (select max(l_shipdate) from lineitem),
                    (select max(ts) from events)) as hi) b
    ) days""",
)
def calendar_dimension(c: Context) -> DataFrame:
    sources = [(c.table("orders"), ["o_orderdate"]), (c.table("lineitem"), ["l_shipdate"]), (c.table("events"), ["ts"])]
    return calendar.build_calendar(calendar.date_range(sources))


# --- P: masking --------------------------------------------------------------------------------


def _tokens(value: str, prefix: str, source: str, suffix: str = "", condition: str = "true") -> str:
    """Token per row: position of the value among the sorted distinct non-blank ones."""
    number = (
        f"dense_rank() over (partition by ({value} is null or trim({value}) = '' or not ({condition})) order by {value})"
    )
    padded = f"if(length(cast(n as varchar)) < 3, lpad(cast(n as varchar), 3, '0'), cast(n as varchar))"
    return (
        f"select * exclude (n), case when {value} is not null and trim({value}) <> '' and ({condition}) "
        f"then '{prefix}' || {padded} || '{suffix}' end as token from (select *, {number} as n from {source}) t"
    )


_PEOPLE = """select o_orderkey, case when o_orderkey % 10 = 0 then null when o_orderkey % 10 = 1 then ' '
    when o_orderkey % 10 < 5 then 'Customer#000000001' else c_name end as full_name
    from orders join customer on o_custkey = c_custkey"""


@query(
    "p1_consistent_tokens",
    f"select o_orderkey, token as full_name from ({_tokens('full_name', 'Pessoa ', f'({_PEOPLE}) p')}) q",
)
def consistent_tokens(c: Context) -> DataFrame:
    # Three in ten rows share one name, so the join sees a hot value.
    return masking.mask_names(c.sql(_PEOPLE), "full_name")


_EMAILS = "select c_custkey, case when c_custkey % 9 = 0 then null else 'c' || (c_custkey % 500) || '@mail.example' end as email from customer"


@query(
    "p2_mask_emails",
    f"select c_custkey, token as email from ({_tokens('email', 'contact', f'({_EMAILS}) p', '@example.com')}) q",
)
def mask_emails(c: Context) -> DataFrame:
    return masking.mask_emails(c.sql(_EMAILS), "email")


_KEPT_URL = "https://thther.example.org/en/685"


@query(
    "p3_mask_urls",
    "select page_id, ifnull(token, url) as url from ("
    + _tokens("url", "https://example.com/page-url/", "(select page_id, url from pages) p", "", f"url <> '{_KEPT_URL}'")
    + ") q",
)
def mask_urls(c: Context) -> DataFrame:
    return masking.mask_urls(c.table("pages").select("page_id", "url"), "url", "page-url", [_KEPT_URL])


_DATED = """select o_orderkey, o_orderdate, cast(cast(o_orderdate as date) as string) as shipped_on,
    o_orderpriority as note_at from orders"""


@query(
    "p4_coarsen_dates",
    """select o_orderkey, date_trunc('month', o_orderdate) as o_orderdate, date_trunc('month', o_orderdate) as shipped_on,
        o_orderpriority as note_at from orders""",
)
def coarsen_dates(c: Context) -> DataFrame:
    return masking.coarsen_dates(c.sql(_DATED))


@query(
    "p5_null_out_columns",
    "select c_custkey, cast(null as varchar) as c_name, c_mktsegment from customer",
)
def null_out_columns(c: Context) -> DataFrame:
    return masking.null_out(c.table("customer").select("c_custkey", "c_name", "c_mktsegment"), ["c_name"])


_NOTED = "select doc_id, case when doc_id % 4 = 0 then null else text end as summary from documents"


@query(
    "p6_replace_text",
    f"select doc_id, if(summary is null, null, '{lexicon.REPLACED_TEXTS['summary']}') as summary from ({_NOTED}) d",
)
def replace_text(c: Context) -> DataFrame:
    return masking.replace_text(c.sql(_NOTED), {"summary": lexicon.REPLACED_TEXTS["summary"]})


_TYPED = """select cast(o_custkey as string) as number_text, o_orderpriority as priority,
    case when o_orderkey % 2 = 0 then '12.5' else o_orderstatus end as half_number, cast(null as string) as nothing
    from orders"""


@query(
    "p8_textual_columns",
    """select 'number_text' as column_name, false as is_textual union all select 'priority', true
    union all select 'half_number', true union all select 'nothing', (select count(*) from orders) > 0""",
)
def textual_columns(c: Context) -> DataFrame:
    return masking.textual_columns(c.sql(_TYPED))


_NAMED = """select c_custkey, case when c_custkey % 3 = 0 then null else ' ' || split_part(c_name, '#', 1) end as first_name,
    case when c_custkey % 6 < 3 then null else split_part(c_name, '#', 2) || ' ' end as last_name from customer"""


@query(
    "p9_rebuild_full_name",
    f"""select c_custkey, nullif(trim(ifnull(trim(first_name), '') || ' ' || ifnull(trim(last_name), '')), '')
        as full_name from ({_NAMED}) c""",
)
def rebuild_full_name(c: Context) -> DataFrame:
    return c.sql(_NAMED).select("c_custkey", masking.rebuild_full_name("first_name", "last_name").alias("full_name"))


