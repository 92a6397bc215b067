from __future__ import annotations

import json
import threading

import pytest
from pyspark.sql import functions as F

from tidemark.plans.bronze import EXPORT_TABLES, load_table
from tidemark.sources import csv_exports, inventory
from tidemark.sources import publish as publishing
from tidemark.sources.export_dirs import resolve_export_dir
from tidemark.sources.publish import ExportSpec, check_exports, publish
from tidemark.sources.warehouse import Warehouse, preview, warehouse_census


def put(path, content, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content.encode(encoding))
    return str(path)


# --- CSV ---------------------------------------------------------------------------


def test_csv_with_byte_order_mark_and_quoted_line_breaks(spark, tmp_path):
    path = put(tmp_path / "a.csv", 'Name,Text\nAna,"one\ntwo ""x"""\n', "utf-8-sig")
    df = csv_exports.read_csv(spark, path)
    assert df.columns == ["Name", "Text"]
    assert [tuple(r) for r in df.collect()] == [("Ana", 'one\ntwo "x"')]


HEADER = EXPORT_TABLES["connections"].preamble_header


def test_preamble_is_skipped_in_every_file_and_columns_follow_each_header(spark, tmp_path, rows):
    notes = 'Notes:\n"Some, with ""quotes"" and\na break"\n\n'
    put(
        tmp_path / "in" / "1.csv",
        notes + ",".join(HEADER) + '\nAna,Silva,u1,,"Open, Data","Eng\nSenior",01 Apr 2026\n',
    )
    # Another column order, one column missing, one unknown.
    put(tmp_path / "in" / "2.csv", notes + "Last Name,First Name,URL,Company,Extra,Connected On\nReis,Rui,u2,ACME,z,2026\n")
    df = csv_exports.read_csv_after_preamble(spark, str(tmp_path / "in"), HEADER)
    assert rows(df) == [
        ("Ana", "Silva", "u1", None, "Open, Data", "Eng\nSenior", "01 Apr 2026"),
        ("Rui", "Reis", "u2", None, "ACME", None, "2026"),
    ]


def test_preamble_reader_spans_arrow_batches(spark, tmp_path):
    body = "".join(f"n{i},l,u,e,c,p,2024-01-01\n" for i in range(500))
    put(tmp_path / "Connections.csv", "Notes:\nx\n\n" + ",".join(HEADER) + "\n" + body)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "7")
    try:
        assert csv_exports.read_csv_after_preamble(spark, str(tmp_path / "Connections.csv"), HEADER).count() == 500
    finally:
        spark.conf.set(key, before)


# --- export directories -----------------------------------------------------------------


def test_newest_dated_directory_wins(spark, tmp_path):
    for name in ("complete_export_2026_05_01", "complete_export_2026_05_07"):
        put(tmp_path / name / "Connections.csv", "header\n")
        put(tmp_path / name / "Jobs" / "Job Applications.csv", "header\n")
    put(tmp_path / "complete_export_2026_06_01" / "Other.csv", "header\n")  # no marker file
    found = resolve_export_dir(spark, str(tmp_path), "complete")
    assert (found.label, found.source, found.warning) == ("complete_export_2026_05_07", "dated_raw_dir", None)
    assert found.path == str(tmp_path / "complete_export_2026_05_07")


def test_override_is_taken_as_it_is(spark, tmp_path):
    found = resolve_export_dir(spark, str(tmp_path), "complete", {"complete": str(tmp_path)})
    assert (found.source, found.exists, found.warning) == ("override", True, None)
    absent = resolve_export_dir(spark, str(tmp_path), "complete", {"complete": str(tmp_path / "no")})
    assert not absent.exists and absent.warning


def test_directory_of_another_type_is_a_fallback(spark, tmp_path):
    put(tmp_path / "complete_export_2026_05_07" / "Profile.csv", "header\n")
    found = resolve_export_dir(spark, str(tmp_path), "basic")
    assert found.source == "cross_type_fallback" and found.exists and found.warning


def test_manual_directory_qualifies_without_a_date_but_after_dated_ones(spark, tmp_path):
    manual = tmp_path / "manual"
    put(manual / "my download" / "Profile.csv", "header\n")
    found = resolve_export_dir(spark, str(tmp_path / "none"), "basic", manual_roots=[str(manual)])
    assert (found.path, found.source, found.warning) == (str(manual / "my download"), "dated_raw_dir", None)
    put(tmp_path / "raw" / "basic_export_2020_01_02" / "Positions.csv", "header\n")
    found = resolve_export_dir(spark, str(tmp_path / "raw"), "basic", manual_roots=[str(manual)])
    assert found.label == "basic_export_2020_01_02"


def test_nothing_found(spark, tmp_path):
    found = resolve_export_dir(spark, str(tmp_path / "none"), "basic")
    assert found.source == "legacy_default" and not found.exists and found.warning
    assert found.path.endswith("basic_export_latest")


# --- inventory ----------------------------------------------------------------------------


def test_inventory(spark, tmp_path):
    base = tmp_path / "exp"
    put(base / "Profile.csv", "a,b\n1,2\n3,4\n")
    put(base / "Jobs" / "Job Applications.csv", "a;b\nJosé\n", "latin-1")
    put(base / "Connections.csv", "Notes:\nx\n\nFirst Name,URL\nAna,u\n")
    put(base / "SearchQueries.csv", "Time,Query\n1,a,b\n\n2,c\n")
    put(base / "Bad.csv", "a,b\n1,2,3\n")
    found = inventory.build_inventory(
        spark,
        {"basic": ("Basic", str(base)), "complete": ("Complete", str(tmp_path / "absent"))},
        F.lit("2024-05-01").cast("timestamp_ntz"),
    )
    assert found.columns == list(inventory.INVENTORY_COLUMNS)
    by_name = {r.file_name: r for r in found.collect()}
    assert (by_name["Profile.csv"].row_count, by_name["Profile.csv"].folder_name) == (2, "root")
    assert json.loads(by_name["Profile.csv"].column_names) == ["a", "b"]
    jobs = by_name["Job Applications.csv"]
    assert (jobs.folder_name, jobs.detected_encoding, jobs.file_stem) == ("Jobs", "latin-1", "Job Applications")
    assert (by_name["Connections.csv"].row_count, by_name["Connections.csv"].column_count) == (1, 2)
    assert (by_name["SearchQueries.csv"].row_count, by_name["SearchQueries.csv"].column_count) == (2, 2)
    assert by_name["Bad.csv"].read_success is False and by_name["Bad.csv"].error_message
    missing = by_name[None]
    assert missing.export_type == "complete" and missing.read_success is False


def test_inventory_copies(spark, tmp_path):
    put(tmp_path / "exp" / "Profile.csv", "a,b\n1,2\n")
    found = inventory.build_inventory(spark, {"basic": ("B", str(tmp_path / "exp"))}, F.lit(None).cast("timestamp_ntz"))
    paths = inventory.save_inventory(found, str(tmp_path / "out"), "20240501")
    assert spark.read.parquet(paths["latest_parquet"]).count() == 1
    assert csv_exports.read_csv(spark, paths["latest_csv"]).first()["column_names"] == '["a", "b"]'


# --- warehouse -------------------------------------------------------------------------------


def test_append_creates_then_adds(spark, tmp_path, rows):
    store = Warehouse(spark, str(tmp_path))
    store.append(spark.createDataFrame([(1, "alpha")], "id int, name string"), "bronze", "t")
    store.append(spark.createDataFrame([("beta", 2)], "name string, id long"), "bronze", "t")
    assert rows(store.read("bronze", "t")) == [(1, "alpha"), (2, "beta")]
    with pytest.raises(ValueError, match="columns not in"):
        store.append(spark.createDataFrame([(1,)], "other int"), "bronze", "t")
    with pytest.raises(LookupError):
        store.require([("bronze", "absent")])


def test_replace_and_census(spark, tmp_path, rows):
    store = Warehouse(spark, str(tmp_path))
    store.replace(spark.range(5), "bronze", "t")
    store.replace(spark.range(2), "bronze", "t")
    store.replace(spark.range(0), "main", "empty")
    assert rows(warehouse_census(store)) == [("bronze.t", 2, 1, "id"), ("main.empty", 0, 1, "id")]
    assert rows(preview(store.read("bronze", "t"), ["id"], 1)) == [(0, 2)]


def test_load_writes_bronze_and_audit(spark, tmp_path, rows):
    put(tmp_path / "exp" / "Skills.csv", "Name\nPython\nPython\nSQL\n", "utf-8-sig")
    store = Warehouse(spark, str(tmp_path / "wh"))
    loaded = load_table(spark, "skills", str(tmp_path / "exp"), store)
    assert rows(loaded) == [("Python",), ("SQL",)]
    audit = store.read("bronze", "ingestion_audit").first()
    assert (audit.table_key, audit.row_count, audit.duplicate_rows_after_transform) == ("skills", 2, 0)
    assert (audit.source_row_count, audit.rows_removed_during_transform) == (3, 1)
    # Rates before and after are keyed alike, by normalised column name.
    assert json.loads(audit.source_null_rate_by_column) == {"name": 0.0}
    assert json.loads(audit.null_rate_by_column) == {"skill_name": 0.0}


# --- publishing --------------------------------------------------------------------------------


def test_publish_writes_files_and_a_sorted_manifest(spark, tmp_path):
    specs = [ExportSpec("z", "t", ("id",), ("-id",), "zs"), ExportSpec("a", "t", ("id",), (), "as")]
    listed = publish({"t": spark.range(3)}, specs, str(tmp_path), "both").collect()
    assert [(r.output_name, r.row_count, r.column_count) for r in listed] == [("a", 3, 1), ("z", 3, 1)]
    assert json.loads(listed[0].files) == [f"{tmp_path}/a.csv", f"{tmp_path}/a.parquet"]
    assert [r.id for r in spark.read.parquet(f"{tmp_path}/z.parquet").collect()] == [2, 1, 0]
    with pytest.raises(LookupError):
        publish({"t": spark.range(3)}, [ExportSpec("x", "absent", ("id",))], str(tmp_path))


def test_check_exports(spark, tmp_path, rows):
    spark.range(3).write.parquet(f"{tmp_path}/a.parquet")
    found = check_exports(spark, str(tmp_path), {"a": ("id", "x"), "b": ("id",)})
    assert rows(found) == [("a", True, 3, "x", False), ("b", False, 0, "id", False)]


def test_exports_are_written_a_few_at_a_time(spark, tmp_path, monkeypatch):
    both, write = threading.Barrier(2), publishing.write_export

    def meet(df, directory, name, *rest):
        if name in ("one", "two"):
            both.wait(60)  # broken, an error, if the other one is not written meanwhile
        return write(df, directory, name, *rest)

    monkeypatch.setattr(publishing, "write_export", meet)
    specs = [ExportSpec(name, "t", ("id",), ("-id",), name) for name in ("two", "one")]
    listed = publish({"t": spark.range(3)}, specs, str(tmp_path / "bi"))
    assert [(r.output_name, r.row_count) for r in listed.collect()] == [("one", 3), ("two", 3)]
