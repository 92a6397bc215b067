"""Readers that lose nothing, and writers that keep the old data until the new is there."""

from __future__ import annotations

import json
import threading

import pytest
from pyspark.sql import functions as F

from tidemark.operators import masking
from tidemark.operators.contracts import TableContract, validate_contract
from tidemark.plans import bronze
from tidemark.sources import csv_exports, inventory, publish
from tidemark.sources.warehouse import Warehouse

HEADER = ("First Name", "Last Name", "URL")


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())
    return str(path)


def test_files_with_other_headers_are_aligned_by_name(spark, rows, tmp_path):
    one = put(tmp_path / "a/Education.csv", 'School,Notes\nUFSC,"first\nline"\n')
    two = put(tmp_path / "b/Education.csv", "﻿Notes,School,Degree\nsecond,USP,BSc\n")
    expected = [("UFSC", "first\nline", None), ("USP", "second", "BSc")]
    assert rows(csv_exports.read_csv(spark, [one, two]).select("School", "Notes", "Degree")) == expected
    both = put(tmp_path / "c/1.csv", "School,Notes\nUFSC,first\n")
    put(tmp_path / "c/2.csv", "Notes,School\nsecond,USP\n")
    assert rows(csv_exports.read_csv(spark, both.rpartition("/")[0], multiline=False).select("School", "Notes")) == [("UFSC", "first"), ("USP", "second")]


def test_surplus_fields_and_missing_headers_are_errors(spark, tmp_path):
    path = put(tmp_path / "x.csv", "A,B\n1,2\n1,2,3,4\n")
    with pytest.raises(Exception, match="more fields than the header"):
        csv_exports.read_csv(spark, path).collect()
    assert csv_exports.read_csv(spark, put(tmp_path / "short.csv", "A,B\n1\n")).collect() == [("1", None)]
    with pytest.raises(FileNotFoundError):
        csv_exports.read_csv(spark, str(tmp_path / "none.csv"))
    good = put(tmp_path / "p/1.csv", "Notes:\nx\n\nFirst Name,Last Name,URL\na,b,c\n")
    put(tmp_path / "p/2.csv", "Notes:\n\nVorname,Nachname,Adresse\na,b,c\n")
    assert csv_exports.read_csv_after_preamble(spark, good, HEADER).count() == 1
    with pytest.raises(Exception, match="no header that names half"):
        csv_exports.read_csv_after_preamble(spark, str(tmp_path / "p"), HEADER).collect()
    wide = put(tmp_path / "w.csv", "First Name,Last Name,URL\na,b,c\na,b,c,d\n")
    with pytest.raises(Exception, match="more fields than the header"):
        csv_exports.read_csv_after_preamble(spark, wide, HEADER).collect()


SURPLUS = 'A,B\n1,2\n1,2,,4\n"x,y",z\n3\n1,2,\n"a ""q"" b","c\nd",e\n'


def test_rejected_records_keep_their_text(spark, rows, tmp_path):
    path = put(tmp_path / "x.csv", SURPLUS)
    records = csv_exports.read_records(spark, path)
    assert rows(csv_exports.accepted_records(records), order=False) == [("1", "2"), ("x,y", "z"), ("3", None)]
    rejected = [r.record.strip() for r in csv_exports.rejected_records(records).collect()]
    assert rejected == ["1,2,,4", "1,2,", '"a ""q"" b","c\nd",e']
    assert records.select("A").count() == 6 and csv_exports.accepted_records(records).select("B").count() == 3
    with pytest.raises(Exception, match="more fields than the header: 1,2,,4"):
        csv_exports.read_csv(spark, put(tmp_path / "y.csv", "A,B\n1,2,,4\n")).select("A").collect()
    flat = put(tmp_path / "z.csv", "A,B\n1,2\n1,2,,4\n3\n")
    for multiline in (True, False):
        records = csv_exports.read_records(spark, flat, multiline)
        assert records.count() == 3 and rows(csv_exports.rejected_records(records)) == [("1,2,,4",)]
    empty = put(tmp_path / "e.csv", "")
    assert csv_exports.read_records(spark, empty).columns == [csv_exports.REJECTED] and csv_exports.read_csv(spark, empty).columns == []
    noted = put(tmp_path / "n.csv", "Notes:\n\nFirst Name,Last Name,URL\na,b,c\na,b,c,,d\na,b\n")
    records = csv_exports.read_records_after_preamble(spark, noted, HEADER)
    assert rows(csv_exports.accepted_records(records)) == [("a", "b", "c"), ("a", "b", None)]
    assert rows(csv_exports.rejected_records(records)) == [("a,b,c,,d",)]


def test_loads_count_rejects_and_can_run_again(spark, rows, tmp_path, monkeypatch):
    directory = put(tmp_path / "exp/Skills.csv", "Name\nPython\nSQL,\nPython\n,x\n").rpartition("/")[0]
    store = Warehouse(spark, str(tmp_path / "w"))
    moment = F.lit("2024-05-01").cast("timestamp_ntz")
    for day in ("1", "2"):
        # the second load fails between the switch of its table and its audit row, and runs again
        if day == "2":
            with monkeypatch.context() as broken:
                broken.setattr(bronze, "audit_row", lambda *_, **__: 1 / 0)
                with pytest.raises(ZeroDivisionError):
                    bronze.load_table(spark, "skills", directory, store, moment, load_id=day)
        bronze.load_table(spark, "skills", directory, store, moment, load_id=day)
    assert rows(store.read("bronze", "skills")) == [("Python",)]
    audit = store.read("bronze", "ingestion_audit").select("load_id", "source_row_count", "rejected_rows", "row_count", "rows_removed_during_transform")
    assert rows(audit) == [("load-skills-1", 4, 2, 1, 3), ("load-skills-2", 4, 2, 1, 3)]
    put_aside = store.read("raw", "rejected_records").select("load_id", "table_key", "record")
    assert rows(put_aside) == [(f"load-skills-{day}", "skills", record) for day in "12" for record in (",x", "SQL,")]
    assert rows(store.read("raw", "skills").select("Name"))[-2:] == [("SQL",), (None,)]
    with pytest.raises(ValueError, match="with the name"):
        store.append(store.read("bronze", "ingestion_audit").drop("load_id"), "bronze", "ingestion_audit")


def test_failing_replace_keeps_the_old_table(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path / "w"))
    store.replace(spark.range(5), "bronze", "t")
    bad = spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("stop")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        store.replace(bad, "bronze", "t")
    assert store.read("bronze", "t").count() == 5
    assert store.replace(store.read("bronze", "t").where("id > 2"), "bronze", "t").count() == 2
    assert store.tables() == [("bronze", "t")] and [p.name for p in (tmp_path / "w/bronze").iterdir()] == ["t"]


def test_sorted_exports_stay_sorted_in_both_formats(spark, tmp_path):
    spec = publish.ExportSpec("sorted", "s", ("id", "pad"), ("-id",))
    df = spark.range(40_000).select("id", F.repeat(F.lit("x"), (F.col("id") % 7).cast("int")).alias("pad")).repartition(6)
    publish.publish({"s": df}, [spec], str(tmp_path), "both")
    lines = [line for part in sorted((tmp_path / "sorted.csv").glob("part-*")) for line in part.read_text().splitlines()[1:]]
    assert [int(line.split(",")[0]) for line in lines] == list(range(39_999, -1, -1))


def test_inventory_reports_irregular_files(spark, tmp_path):
    put(tmp_path / "e/good.csv", "﻿Name,Notes\na,b\n")
    put(tmp_path / "e/bad.csv", 'Name,Notes\n2,"x"y\n')
    put(tmp_path / "e/large.csv", "Name\n" + "z" * 200_000 + "\n")
    found = {r.file_name: r for r in inventory.build_inventory(spark, {"basic": ("e", str(tmp_path / "e"))}, F.lit(None)).collect()}
    assert found["good.csv"].column_names == '["Name", "Notes"]' and found["good.csv"].row_count == 1
    assert not found["bad.csv"].read_success and found["bad.csv"].error_message
    assert found["large.csv"].read_success and found["large.csv"].row_count == 1


def test_duplicates_are_unknown_without_the_whole_key(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c")], "k long, v string")
    found = validate_contract(df, TableContract(required=("k", "v"), unique=("k", "absent"))).first()
    assert (found.row_count, found.missing_columns, found.duplicate_rows) == (3, "absent", None)


def test_codes_are_not_numbers(spark, rows):
    df = spark.createDataFrame([("10d", "1.5", " -2e3 ", "NaN"), ("20f", "2", ".5", "1")], "a string, b string, c string, d string")
    assert rows(masking.textual_columns(df)) == [("a", True), ("b", False), ("c", False), ("d", True)]
    assert masking.masking_rule("profile_link")[0] == "url" and masking.masking_rule("handle") is None
    assert masking.masking_rule("handle", ("handle",))[0] == "url"


def test_rows_without_value_are_not_gathered(spark, rows):
    df = spark.createDataFrame([(i, None if i % 2 else f"n{i}") for i in range(20)], "id long, name string")
    found = dict(rows(masking.mask_names(df, "name")))
    assert all((found[i] is None) == bool(i % 2) for i in range(20))


def test_marked_exports_and_their_summary(spark, rows, tmp_path):
    spec = publish.ExportSpec("marked", "s", ("id", "name"), ("id",), "Some rows.")
    df = spark.createDataFrame([(1, "é"), (2, None)], "id long, name string")
    publish.publish({"s": df}, [spec], str(tmp_path), "csv", marked=True)
    part = next((tmp_path / "marked.csv").glob("part-*"))
    assert part.read_bytes().startswith("﻿id,name\n1,é".encode())
    assert rows(publish.read_export(spark, str(tmp_path), "marked", "csv")) == [("1", "é"), ("2", None)]
    listed = publish.write_summary(spark, [spec], str(tmp_path), "csv").first()
    assert listed.asDict() == {
        "output_name": "marked", "source_table": "s", "row_count": 2, "columns": ["id", "name"],
        "output_path": f"{tmp_path}/marked.csv", "description": "Some rows.",
    }
    assert len(list((tmp_path / "_export_summary.json").glob("part-*"))) == 1


def test_inventory_counts_records_where_spark_reads_them(spark, tmp_path):
    files = {
        "a+b %20 c.csv": ('A,"B ""q"""\n"1\n2",x\n"y, z",\n\n3\n', ["A", 'B "q"'], 3),
        "Connections.csv": ('Notes, with, commas, in, them\n"More, notes"\n\nFirst Name,URL\nAna,u\nBo,v\n', ["First Name", "URL"], 2),
        "one.csv": ('Name\n"a,b"\nc\n', ["Name"], 2),
        "header.csv": ("﻿A,B,C\n", ["A", "B", "C"], 0),
        "wide.csv": ('"A\nB",C\n1,2\n', ["A\nB", "C"], 1),
        "SearchQueries.csv": ('Time,Query,More\n1,a,b,c\n2,"x"y\n\n', ["Time", "Query,More"], 2),
    }
    for name, (content, *_) in files.items():
        put(tmp_path / "exp" / "sub dir" / name, content)
    bad = {"empty.csv": "", "open.csv": 'A,B\n1,"x\n', "late.csv": "A,B\n" + "1,2\n" * 5000 + "1,2,3\n"}
    for name, content in bad.items():
        put(tmp_path / "exp" / name, content)
    (tmp_path / "exp" / "latin.csv").write_bytes("Nome,Ação\nJosé,é\n".encode("latin-1"))
    found = {r.file_name: r for r in inventory.build_inventory(spark, {"basic": ("e", str(tmp_path / "exp"))}, F.lit(None)).collect()}
    assert set(found) == {*files, *bad, "latin.csv"}
    for name, (content, names, n) in files.items():
        r = found[name]
        assert (r.read_success, r.row_count, json.loads(r.column_names), r.detected_encoding, r.folder_name) == (True, n, names, "utf-8", "sub dir"), name
        assert r.file_size_bytes == len(content.encode()) and r.column_count == len(names)
    assert all(not found[name].read_success and found[name].error_message and found[name].row_count is None for name in bad)
    latin = found["latin.csv"]
    assert (latin.detected_encoding, json.loads(latin.column_names), latin.row_count) == ("latin-1", ["Nome", "Ação"], 1)


def test_tables_load_a_few_at_a_time(spark, tmp_path, monkeypatch):
    directory = put(tmp_path / "exp/Skills.csv", "Name\nPython\nSQL,\n").rpartition("/")[0]
    put(tmp_path / "exp/Languages.csv", "Name,Proficiency\nGerman,Fluent\n")
    both, read = threading.Barrier(2), bronze.read_raw

    def meet(*given):
        both.wait(60)  # broken, an error, if the other table is not loaded meanwhile
        return read(*given)

    monkeypatch.setattr(bronze, "EXPORT_TABLES", {k: bronze.EXPORT_TABLES[k] for k in ("skills", "languages")})
    monkeypatch.setattr(bronze, "read_raw", meet)
    store = Warehouse(spark, str(tmp_path / "w"))
    assert bronze.load_all(spark, {"basic": directory, "complete": directory}, store, "1") == {"skills": 1, "languages": 1}
    audit = store.read("bronze", "ingestion_audit").select("table_key", "source_row_count", "rejected_rows").collect()
    assert sorted(map(tuple, audit)) == [("languages", 1, 0), ("skills", 2, 1)]
