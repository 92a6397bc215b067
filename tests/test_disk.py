"""What a load leaves on disk: its tables, neither export files nor shuffles."""

from __future__ import annotations

import gzip
import time
from types import SimpleNamespace

import pytest

from tidemark.binding import storage_queries
from tidemark.plans.bronze import EXPORT_TABLES, load_table
from tidemark.session import shuffles_removed
from tidemark.sources import csv_exports
from tidemark.sources.warehouse import Warehouse

CONNECTIONS = EXPORT_TABLES["connections"].preamble_header
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def packed(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(gzip.compress(content.encode()))
    return str(path)


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}


def test_headers_of_compressed_files(spark, rows, tmp_path):
    path = packed(tmp_path / "in/a.csv.gz", '﻿Name,Text\nAna,"one\ntwo"\nRui,a,b\n')
    assert csv_exports.header_of(spark, path) == ("Name", "Text")
    records = csv_exports.read_records(spark, path)
    assert rows(csv_exports.accepted_records(records)) == [("Ana", "one\ntwo")]
    assert rows(csv_exports.rejected_records(records)) == [("Rui,a,b",)]


def test_preamble_in_compressed_files(spark, rows, tmp_path):
    packed(tmp_path / "in/a.csv.gz", 'Notes:\n"Some"\n\n' + ",".join(CONNECTIONS) + "\nAna,Silva,u1,,ACME,Eng,2026\n")
    df = csv_exports.read_csv_after_preamble(spark, str(tmp_path / "in"), CONNECTIONS)
    assert rows(df) == [("Ana", "Silva", "u1", None, "ACME", "Eng", "2026")]


def test_load_query_leaves_tables_only(spark, rows, tmp_path, monkeypatch):
    raw = {
        "skills": spark.createDataFrame([("SQL",), ("SQL",), ("Python",), (" ",)], "Name string"),
        "languages": spark.createDataFrame([("German", "Fluent\n"), ("German", "Fluent\n"), ("Greek", None)], "Name string, Proficiency string"),
        "connections": spark.createDataFrame([("Ana", "Silva", "u1", None, "A, B", 'x "y"', "2026-01-02")], ", ".join(f"`{h}` string" for h in CONNECTIONS)),
    }
    monkeypatch.setattr(storage_queries, "CLEANED", dict.fromkeys(raw, ""))
    monkeypatch.setattr(storage_queries, "scratch_path", lambda _, label: str(tmp_path / label))
    before = shuffle_files(spark)
    found = rows(storage_queries.load_tables(SimpleNamespace(spark=spark, raw=raw.__getitem__)))

    assert found == [
        ("audit of connections", "1|0|1|0|0"),
        ("audit of languages", "3|0|3|0|0"),
        ("audit of skills", "4|0|2|2|0"),
        ("connections", 'Ana|Silva|u1|∅|A, B|x "y"|2026-01-02 00:00:00'),
        ("languages", "German|Fluent"),
        ("languages", "German|Fluent"),
        ("languages", "Greek|∅"),
        ("skills", "Python"),
        ("skills", "SQL"),
    ]
    assert not [p for p in (tmp_path / "export").rglob("*") if p.is_file()]
    assert len(rows(Warehouse(spark, str(tmp_path / "bronze")).read("raw", "languages"))) == 3
    for _ in range(100):  # files go in the background
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.1)
    assert shuffle_files(spark) <= before


def test_files_can_go_once_their_records_are_landed(spark, rows, tmp_path):
    file = tmp_path / "exp/Skills.csv"
    file.parent.mkdir()
    file.write_text("Name\nSQL\nPython\nSQL,\n")
    store, seen = Warehouse(spark, str(tmp_path / "w")), []

    def landed():
        seen.append((store.read("raw", "skills").count(), store.exists("bronze", "skills")))
        file.unlink()

    assert rows(load_table(spark, "skills", str(file.parent), store, landed=landed)) == [("Python",), ("SQL",)]
    assert seen == [(3, False)]
    assert store.read("raw", "rejected_records").count() == 1


def test_tables_are_packed_with_zstandard(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path))
    store.replace(spark.range(3), "main", "a")
    store.append(spark.range(3), "main", "b")
    store.append(spark.range(3), "main", "c", "1")
    files = list(tmp_path.rglob("part-*.parquet"))
    assert len({p.relative_to(tmp_path / "main").parts[0] for p in files}) == 3
    assert all(p.name.endswith(".zstd.parquet") for p in files)


@pytest.mark.parametrize("setting", ["false", "true"])
def test_the_setting_comes_back_when_the_last_leaves(spark, setting):
    spark.conf.set(CLEANUP, setting)
    try:
        with pytest.raises(KeyError), shuffles_removed(spark):
            with shuffles_removed(spark):
                pass
            assert spark.conf.get(CLEANUP) == "true"
            raise KeyError
        assert spark.conf.get(CLEANUP) == setting
    finally:
        spark.conf.unset(CLEANUP)
