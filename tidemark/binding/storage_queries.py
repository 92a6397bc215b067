"""Queries for sources and sinks.

Each writes whole driver tables to a fresh place below the shared folder and
reads them back, so the files grow with the data.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from contextlib import ExitStack
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.binding.inputs import DRIVER_TABLES
from tidemark.binding.model_queries import CLEANED, RUN
from tidemark.binding.oracle_models import AS_OF
from tidemark.binding.registry import Context, query
from tidemark.binding.row_texts import texts, texts_sql
from tidemark.functions import lexicon
from tidemark.plans import exports, history
from tidemark.plans.bronze import EXPORT_TABLES, load_table
from tidemark.plans.public_copy import build_public_copy
from tidemark.session import scratch_path, shuffles_removed
from tidemark.sources import csv_exports, export_dirs, inventory, publish, warehouse
from tidemark.sources.swap import fresh_directory, side_by_side
from tidemark.sources.warehouse import Warehouse


def write_csv(df: DataFrame, path: str, **options: str) -> str:
    """Plain export CSV: header, untouched whitespace, doubled quotes."""
    (
        df.write.options(**options)
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def _blank_to_null(df: DataFrame) -> DataFrame:
    return df.select(*[F.nullif(F.col(f"`{name}`"), F.lit("")).alias(name) for name in df.columns])


def _blank_columns(*headers: str) -> str:
    return ", ".join(f"nullif(\"{h}\", '') as \"{h}\"" for h in headers)


_LEARNING = (
    "Content Title",
    "Content Description",
    "Content Type",
    "Content Last Watched Date (if viewed)",
    "Content Completed At (if completed)",
    "Content Saved",
    "Notes taken on videos (if taken)",
)


@query("a1_read_csv", f"select {_blank_columns(*_LEARNING)} from raw_learning")
def read_csv(c: Context) -> DataFrame:
    """Whole document texts with quotes and line breaks through a CSV file."""
    path = write_csv(c.raw("learning"), scratch_path(c.spark, "learning-csv"))
    return _blank_to_null(csv_exports.read_csv(c.spark, path))


_ODD_LINES = """select o_orderkey, case
        when o_orderkey % 7 = 0 then o_orderkey || ',' || o_orderstatus || ',' || o_orderpriority || ',,' || o_custkey
        when o_orderkey % 11 = 0 then o_orderkey || ',' || o_orderstatus
        else o_orderkey || ',' || o_orderstatus || ',"' || o_orderpriority || ', ""' || o_custkey || repeat('"', 3) end as line from orders"""


def _odd_file(c: Context, header: str, path: str) -> str:
    """Orders as CSV lines, every seventh with two fields too many, of which the first is empty, every eleventh with one too few.

    The header begins every written file, so the files are not to be copied by a job that cuts or joins them.
    """
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    c.sql(_ODD_LINES).select(F.concat(F.when(first, F.lit(f"{header}\n")).otherwise(F.lit("")), "line").alias("value")).write.text(path)
    return path


@query(
    "a1_rejected_records",
    """select o_orderkey::varchar as order_key, o_orderstatus as status,
        case when o_orderkey % 11 <> 0 then o_orderpriority || ', "' || o_custkey || '"' end as note, null as rejected
    from orders where o_orderkey % 7 <> 0
    union all select null, null, null, o_orderkey || ',' || o_orderstatus || ',' || o_orderpriority || ',,' || o_custkey
    from orders where o_orderkey % 7 = 0""",
)
def rejected_records(c: Context) -> DataFrame:
    """Rows with surplus fields are put aside with their text, short ones end with NULL."""
    records = csv_exports.read_records(c.spark, _odd_file(c, "order_key,status,note", scratch_path(c.spark, "odd-csv")), multiline=False)
    accepted = csv_exports.accepted_records(records).withColumn("rejected", F.lit(None).cast("string"))
    return accepted.unionByName(csv_exports.rejected_records(records).withColumnRenamed("record", "rejected"), allowMissingColumns=True)


_PREAMBLE = 'Notes:\n"Some addresses, as ""listed"" here, may be missing."\n\n'


def _preamble_lines(df: DataFrame, header: Sequence[str]) -> DataFrame:
    """CSV lines whose first one per partition, and so per written file, carries notes and header."""
    fields = F.struct(*[F.col(f"`{name}`").alias(f"c{i}") for i, name in enumerate(df.columns)])
    options = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    line = F.to_csv(fields, options)
    head = F.lit(_PREAMBLE + ",".join(header) + "\n")
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    return df.select(F.concat(F.when(first, head).otherwise(F.lit("")), line).alias("value"))


_CONNECTIONS = ("First Name", "Last Name", "URL", "Email Address", "Company", "Position", "Connected On")


@query(
    "a2_read_csv_after_preamble",
    "select "
    + _blank_columns(*[h for h in _CONNECTIONS if h != "Position"])
    + ", nullif(\" Position \", '') as \"Position\" from raw_connections",
)
def read_csv_after_preamble(c: Context) -> DataFrame:
    path = scratch_path(c.spark, "connections-csv")
    _preamble_lines(c.raw("connections"), _CONNECTIONS).write.text(path)
    return _blank_to_null(csv_exports.read_csv_after_preamble(c.spark, path, _CONNECTIONS))


@query(
    "a3_resolve_export_dir",
    """select 'complete' as export_type, 'complete_export_' || strftime(d, '%Y_%m_%d') as label, d as export_date,
        'dated_raw_dir' as source, cast(row_number() over (order by d desc) as int) as rank
    from (select cast(min(o_orderdate) as date) as d from orders
        union all select cast(max(o_orderdate) as date) from orders) dates
    union all select 'basic', 'basic_export_' || strftime(min(l_shipdate), '%Y_%m_%d'), cast(min(l_shipdate) as date),
        'dated_raw_dir', 1 from lineitem""",
)
def resolve_export_dir(c: Context) -> DataFrame:
    """Dated export directories holding the tables' rows as files, then the ranking of directories."""
    root = scratch_path(c.spark, "exports")
    orders, lines = c.table("orders"), c.table("lineitem")
    first, last = orders.agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    shipped = lines.agg(F.min("l_shipdate")).first()[0]
    write_csv(orders, f"{root}/complete_export_{first:%Y_%m_%d}/Connections.csv")
    write_csv(orders, f"{root}/complete_export_{last:%Y_%m_%d}/Connections.csv")
    write_csv(lines, f"{root}/basic_export_{shipped:%Y_%m_%d}/Positions.csv")
    return export_dirs.rank_export_dirs(export_dirs.list_csv_files(c.spark, root)).drop("root")


@query(
    "a4_file_inventory",
    """select 'part export' as export_name, 'basic' as export_type, 'p_type=' || p_type as folder_name,
        count(*) as row_count, cast(5 as bigint) as column_count, true as all_read,
        'utf-8' as detected_encoding from part group by all
    union all select 'missing export', 'complete', null, null, null, false, null""",
)
def file_inventory(c: Context) -> DataFrame:
    """One folder per part type and an export that does not exist, summed per folder."""
    path = scratch_path(c.spark, "part-export")
    c.table("part").write.partitionBy("p_type").option("header", True).csv(path)
    found = inventory.build_inventory(
        c.spark,
        {"basic": ("part export", path), "complete": ("missing export", f"{path}-absent")},
        F.lit(None).cast("timestamp_ntz"),
    )
    return found.groupBy("export_name", "export_type", "folder_name").agg(
        F.sum("row_count").alias("row_count"),
        F.max("column_count").alias("column_count"),
        F.bool_and("read_success").alias("all_read"),
        F.max("detected_encoding").alias("detected_encoding"),
    )


@query(
    "a4_files_by_folder",
    "select folder_name, count(file_name) as files from bronze_file_inventory group by all",
)
def files_by_folder(c: Context) -> DataFrame:
    return inventory.file_counts(c.models.bronze("file_inventory"), "folder_name")


_ORDER_SUMS = (
    "select o_orderstatus, count(*) as n, round(sum(o_totalprice), 2) as total from orders group by o_orderstatus"
)


def _order_sums(df: DataFrame) -> DataFrame:
    return df.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query("a6_replace_table", _ORDER_SUMS)
def replace_table(c: Context) -> DataFrame:
    """A table written twice keeps only the second version."""
    store = Warehouse(c.spark, scratch_path(c.spark, "replace"))
    store.replace(c.table("lineitem"), "bronze", "orders")
    return _order_sums(store.replace(c.table("orders"), "bronze", "orders"))


@query("a7_append_table", _ORDER_SUMS)
def append_table(c: Context) -> DataFrame:
    """A table created and then extended, with the columns in another order."""
    store = Warehouse(c.spark, scratch_path(c.spark, "append"))
    orders = c.table("orders")
    finished = F.col("o_orderstatus") == "F"
    store.append(orders.where(finished), "bronze", "orders")
    rest = orders.where(~finished)
    return _order_sums(store.append(rest.select(*reversed(rest.columns)), "bronze", "orders"))


@query(
    "a8_save_inventory",
    f"""select f as file, {texts_sql(inventory.INVENTORY_COLUMNS)} as record from bronze_file_inventory,
        unnest(['csv', 'parquet', 'latest_csv', 'latest_parquet']) t(f)""",
)
def save_inventory(c: Context) -> DataFrame:
    """All four copies of an inventory hold the same rows."""
    directory = scratch_path(c.spark, "inventory")
    found = c.models.bronze("file_inventory").select(*inventory.INVENTORY_COLUMNS)
    parts = []
    for name, path in inventory.save_inventory(found, directory, "20240501_000000").items():
        stored = c.spark.read.parquet(path) if path.endswith("parquet") else csv_exports.read_csv(c.spark, path)
        parts.append(stored.select(F.lit(name).alias("file"), texts(stored, found).alias("record")))
    return reduce(DataFrame.unionByName, parts)


def _mart_cte(source: str) -> str:
    return f"mart_{source.replace('pipeline_', '').replace('ingestion_audit_', '')}"


def exported_rows_sql(specs: Sequence[publish.ExportSpec], relation: Callable[[str], str]) -> str:
    return " union all ".join(
        f"select '{s.name}' as output_name, {texts_sql(s.columns, s.date_columns)} as record from {relation(s.source)}" for s in specs
    )


def _read_back(c: Context, tables: dict[str, DataFrame], specs: Sequence[publish.ExportSpec], directory: str, kind: str) -> DataFrame:
    """All rows of the published files, in the types they were written with."""
    parts = []
    for s in specs:
        stored = publish.read_export(c.spark, directory, s.name, kind)
        if tuple(stored.columns) != s.columns:
            raise ValueError(f"{s.name} has other columns: {stored.columns}")
        parts.append(stored.select(F.lit(s.name).alias("output_name"), texts(stored, s.shape(tables[s.source])).alias("record")))
    return reduce(DataFrame.unionByName, parts)


@query(
    "a9_bi_export",
    f"select kind, rows.* from ({exported_rows_sql(exports.EXPORTS, _mart_cte)}) rows, unnest(['csv', 'parquet']) t(kind)",
)
def bi_export(c: Context) -> DataFrame:
    """Whole rows of all declared exports, from both formats."""
    directory = scratch_path(c.spark, "bi")
    tables = {s.source: c.models.mart(s.source) for s in exports.EXPORTS}
    publish.publish(tables, exports.EXPORTS, directory, "both", marked=True)
    parts = [_read_back(c, tables, exports.EXPORTS, directory, kind).withColumn("kind", F.lit(kind)) for kind in ("csv", "parquet")]
    return parts[0].unionByName(parts[1])


def _calendar_days_sql() -> str:
    """All days that the published tables name, in one column; ``YYYY-MM`` is its month's first day."""
    parts = []
    for mart, columns in exports.CALENDAR_SOURCES.items():
        for name in columns:
            day = f"try_cast({name} || '-01' as date)" if name.endswith("year_month") else f"cast({name} as date)"
            parts.append(f"select {day} as d from {_mart_cte(mart)}")
    return " union all ".join(parts)


@query(
    "k1_published_calendar",
    f"""select cast(d as date) as date, cast(strftime(d, '%Y%m%d') as bigint) as date_key, strftime(d, '%Y-%m') as year_month,
        isodow(d) in (6, 7) as is_weekend
    from (select unnest(generate_series(date_trunc('month', min(d)), cast(last_day(max(d)) as timestamp), interval '1' day)) as d
        from ({_calendar_days_sql()}) named) days""",
)
def published_calendar(c: Context) -> DataFrame:
    """The calendar over every date column of the published marts."""
    return exports.calendar(c.models, AS_OF).select("date", "date_key", "year_month", "is_weekend")


@query("k2_declared_exports", exported_rows_sql(exports.EXPORTS, _mart_cte))
def declared_exports(c: Context) -> DataFrame:
    """Whole rows of all declared exports as they are shaped."""
    shaped = [(s.name, s.shape(c.models.mart(s.source))) for s in exports.EXPORTS]
    return reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("output_name"), texts(df).alias("record")) for name, df in shaped])


@query(
    "a10_export_manifest",
    " union all ".join(
        f"select '{s.name}' as output_name, '{s.source}' as source_table, count(*) as row_count, "
        f"cast({len(s.columns)} as bigint) as column_count, '{s.description}' as description "
        f"from mart_{s.source.replace('pipeline_', '').replace('ingestion_audit_', '')}"
        for s in exports.EXPORTS
    ),
)
def export_manifest(c: Context) -> DataFrame:
    tables = {s.source: c.models.mart(s.source) for s in exports.EXPORTS}
    listed = publish.publish(tables, exports.EXPORTS, scratch_path(c.spark, "publish"), "parquet")
    return listed.drop("files")


def _values(rows: Sequence[Sequence[object]], columns: Sequence[str]) -> str:
    """A relation of fixed rows; a CSV file does not tell an empty text from none."""
    shown = lambda v: "null" if v is None or v == "" else str(v).lower() if isinstance(v, bool) else f"timestamp '{v}'" if hasattr(v, "year") else f"'{v}'"
    return f"(values {', '.join('(' + ', '.join(map(shown, row)) + ')' for row in rows)}) t({', '.join(columns)})"


_DIMENSIONS = {
    "dim_snapshot_method": _values(
        [(*m, False) for m in lexicon.HISTORY_METHODS], ("snapshot_method", "method_group", "method_description", "is_simulated")
    ),
    "dim_snapshot_run": _values(
        [(RUN.run_id, RUN.started_at, RUN.finished_at or RUN.created_at, "phase_1_actual_only", False, RUN.source_path, None, RUN.notes)],
        next(s.columns for s in exports.HISTORY_EXPORTS if s.name == "dim_snapshot_run"),
    ),
}


def _history_relation(source: str) -> str:
    return _DIMENSIONS.get(source) or source.replace("snapshot_", "")


def _history_tables(c: Context) -> dict[str, DataFrame]:
    dims = {"dim_snapshot_method": history.method_dimension(c.spark), "dim_snapshot_run": history.run_dimension(c.spark, RUN)}
    return {s.source: dims.get(s.source) or c.models.history(s.source, RUN) for s in exports.HISTORY_EXPORTS}


@query("a11_history_export", exported_rows_sql(exports.HISTORY_EXPORTS, _history_relation))
def history_export(c: Context) -> DataFrame:
    """Whole rows of all history tables, written as CSV in their declared shape and read back."""
    directory = scratch_path(c.spark, "history")
    tables = _history_tables(c)
    publish.publish(tables, exports.HISTORY_EXPORTS, directory, "csv")
    return _read_back(c, tables, exports.HISTORY_EXPORTS, directory, "csv")


@query(
    "a11_history_summary",
    " union all ".join(
        f"select '{s.name}' as output_name, '{s.source}' as source_table, count(*) as row_count, "
        f"'{json.dumps(s.columns, separators=(',', ':'))}' as columns, '{s.name}.csv' as output_file, '{s.description}' as description "
        f"from {_history_relation(s.source)}"
        for s in exports.HISTORY_EXPORTS
    ),
)
def history_summary(c: Context) -> DataFrame:
    """The JSON summary that lies beside the history files."""
    directory = scratch_path(c.spark, "history")
    publish.publish(_history_tables(c), exports.HISTORY_EXPORTS, directory, "csv")
    listed = publish.write_summary(c.spark, exports.HISTORY_EXPORTS, directory, "csv")
    return listed.withColumn("columns", F.to_json("columns")).withColumn("output_file", F.element_at(F.split("output_path", "/"), -1)).drop("output_path")


_CENSUS = DRIVER_TABLES


def _census_oracle(table: str) -> str:
    return (
        f"select 'bronze.{table}' as table_name, (select count(*) from {table}) as row_count, "
        f"count(*) as column_count, string_agg(column_name, ', ' order by ordinal_position) as column_names "
        f"from (select name as column_name, cid as ordinal_position from pragma_table_info('{table}')) i"
    )


@query("a13_table_census", " union all ".join(_census_oracle(t) for t in _CENSUS))
def table_census(c: Context) -> DataFrame:
    store = Warehouse(c.spark, scratch_path(c.spark, "census"))
    for name in _CENSUS:
        store.replace(c.table(name), "bronze", name)
    return warehouse.warehouse_census(store)


@query(
    "a14_table_preview",
    "select *, (select count(*) from orders) as total_rows from orders order by o_orderkey limit 10",
)
def table_preview(c: Context) -> DataFrame:
    return warehouse.preview(c.table("orders"), ["o_orderkey"])


@query(
    "a15_inventory_preview",
    "select * from mart_file_inventory_summary",
)
def inventory_preview(c: Context) -> DataFrame:
    return inventory.preview_inventory(c.models.mart("file_inventory_summary"))


_CHECKED = {
    "dim_date": ("date", "year_month"),
    "fact_ingestion_audit_health_timeline": exports.OBSERVABILITY_COLUMNS["fact_ingestion_audit_health_timeline"],
    "fact_ingestion_audit_null_rate_timeline": exports.OBSERVABILITY_COLUMNS["fact_ingestion_audit_null_rate_timeline"],
}


@query(
    "c13_check_published_exports",
    """select 'dim_date' as name, false as file_exists, cast(0 as bigint) as row_count,
        'date, year_month' as missing_columns, false as is_valid
    union all select 'fact_ingestion_audit_health_timeline', true, (select count(*) from mart_health_timeline), '', true
    union all select 'fact_ingestion_audit_null_rate_timeline', true, (select count(*) from mart_null_rate_timeline),
        'null_rate_delta', false""",
)
def check_published_exports(c: Context) -> DataFrame:
    """One table missing, one complete, one without an expected column."""
    directory = scratch_path(c.spark, "observability")
    for spec in exports.EXPORTS:
        if spec.name in _CHECKED:
            df = spec.shape(c.models.mart(spec.source))
            publish.write_export(df.drop("null_rate_delta"), directory, spec.name, "parquet")
    return publish.check_exports(c.spark, directory, _CHECKED)


def _token_number(value: str) -> str:
    """Position of the value among the table's sorted distinct non-blank ones, as token text."""
    blank = f"({value} is null or trim({value}) = '')"
    rank = f"dense_rank() over (partition by {blank} order by {value})"
    text = f"cast({rank} as varchar)"
    return f"case when not {blank} then if(length({text}) < 3, lpad({text}, 3, '0'), {text}) end"


@query(
    "p10_sanitized_tables",
    f"""select *, nullif(trim(ifnull(first_name, '') || ' ' || ifnull(last_name, '')), '') as full_name from (
        select '{lexicon.PERSON_PREFIX} ' || {_token_number('first_name')} as first_name,
            last_name,  -- nothing but digits, so it is not text to mask
            '{lexicon.URL_TOKEN_ROOT}profile-url/' || {_token_number('profile_url')} as profile_url,
            'contact' || {_token_number('email_address')} || '@example.com' as email_address,
            '{lexicon.ORGANIZATION_PREFIX} ' || {_token_number('company')} as company,
            '{lexicon.ROLE_PREFIX} ' || {_token_number('position')} as position,
            cast(date_trunc('month', connected_on) as timestamp) as connected_on
        from stg_connections) s""",
)
def sanitized_tables(c: Context) -> DataFrame:
    """A stored table, rewritten anonymised into a second warehouse."""
    source = Warehouse(c.spark, scratch_path(c.spark, "private"))
    target = Warehouse(c.spark, scratch_path(c.spark, "public"))
    source.replace(c.models.staged("connections"), "main", "connections")
    build_public_copy(source, target)
    return target.read("main", "connections")


_AUDITED = ("source_row_count", "rejected_rows", "row_count", "rows_removed_during_transform", "duplicate_rows_after_transform")


def _loaded_sql(key: str) -> str:
    """The rows of a loaded table, and its audit row."""
    columns = EXPORT_TABLES[key].contract.required
    unique = ", ".join(EXPORT_TABLES[key].contract.unique)
    duplicates = f"(select count(*) - count(distinct ({unique})) from ({CLEANED[key]}) u)" if unique else "0"
    counts = f"(select count(*) from raw_{key}) as source, (select count(*) from ({CLEANED[key]}) k) as kept, {duplicates} as twice"
    return (
        f"select '{key}' as table_key, {texts_sql(columns)} as record from ({CLEANED[key]}) t "
        f"union all select 'audit of {key}', concat_ws('|', source, 0, kept, source - kept, twice) from (select {counts}) a"
    )


@query("l1_load_tables", " union all ".join(map(_loaded_sql, CLEANED)))
def load_tables(c: Context) -> DataFrame:
    """Export files of all tables to bronze tables, by the loader: whole rows and the audit.

    As text the exports are many times their input, so they are packed, and a
    table's files go when the raw layer has its records.
    """
    directory = scratch_path(c.spark, "export")
    store = Warehouse(c.spark, scratch_path(c.spark, "bronze"))
    packed = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}

    def load(key: str) -> DataFrame:
        table = EXPORT_TABLES[key]
        with ExitStack() as files:
            export = files.enter_context(fresh_directory(c.spark, directory))
            path = f"{export}/{table.file}"
            if table.preamble_header:
                _preamble_lines(c.raw(key), table.preamble_header).write.options(**packed).text(path)
            else:
                write_csv(c.raw(key), path, **packed)
            moment = F.lit("2024-05-01").cast("timestamp_ntz")
            stored = load_table(c.spark, key, export, store, moment, load_id="l1", landed=files.close)
        stored = stored.select(*table.contract.required)
        return stored.select(F.lit(key).alias("table_key"), texts(stored).alias("record"))

    with shuffles_removed(c.spark):
        parts = side_by_side(load, CLEANED)
    audit = store.read("bronze", "ingestion_audit")
    parts.append(audit.select(F.concat(F.lit("audit of "), "table_key").alias("table_key"), F.concat_ws("|", *_AUDITED).alias("record")))
    return reduce(DataFrame.unionByName, parts)


@query(
    "c3_load_with_rejects",
    """select 'saved_job_alerts' as table_key, count(*) as source_row_count, count(*) filter (where o_orderkey % 7 = 0) as rejected_rows,
        count(*) filter (where o_orderkey % 7 <> 0 and o_orderkey % 11 <> 0) as row_count,
        count(*) filter (where o_orderkey % 7 = 0 or o_orderkey % 11 = 0) as rows_removed_during_transform,
        count(*) filter (where o_orderkey % 7 = 0) as kept_texts from orders""",
)
def load_with_rejects(c: Context) -> DataFrame:
    """A load that runs twice under one name: records with surplus fields are counted and kept once; short ones lack the required last field."""
    directory = scratch_path(c.spark, "rejects")
    store = Warehouse(c.spark, scratch_path(c.spark, "bronze"))
    _odd_file(c, "Alert Parameters,Query Context,Saved Search ID", f"{directory}/{EXPORT_TABLES['saved_job_alerts'].file}")
    for _ in range(2):
        load_table(c.spark, "saved_job_alerts", directory, store, multiline=False, load_id="c3")
    kept = store.read("raw", "rejected_records").agg(F.count("record").alias("kept_texts"))
    audit = store.read("bronze", "ingestion_audit").select("table_key", *[n for n in _AUDITED if n != "duplicate_rows_after_transform"])
    return audit.select("*", kept.scalar().alias("kept_texts"))
