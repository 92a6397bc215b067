from __future__ import annotations

import datetime as dt

import pytest

from tidemark.operators import cleaning
from tidemark.plans.bronze import EXPORT_TABLES


def clean(spark, table, headers, records):
    schema = ", ".join(f"`{h}` string" for h in headers)
    return EXPORT_TABLES[table].recipe(spark.createDataFrame(records, schema))


def test_education_maps_names_and_flags_current(spark):
    df = clean(
        spark,
        "education",
        ["School", "Degree", "Description", "Started", "Finished"],
        [("UFSC", "Sistemas de Informacao", "Curso superior", "2020-02-01", None)],
    )
    assert df.columns == list(EXPORT_TABLES["education"].contract.required)
    row = df.first()
    assert row.school_name == "UFSC" and row.is_current_education is True
    assert row.started_on == dt.datetime(2020, 2, 1)


def test_recommendations_map_names_and_parse_the_date(spark):
    df = clean(
        spark,
        "recommendations_received",
        ["First Name", "Last Name", "Company", "Job Title", "Text", "Creation Date", "Status"],
        [("Ana", "Silva", "ACME", "Data Analyst", "Excelente parceria.", "04/05/26, 09:15 AM", "VISIBLE")],
    )
    row = df.first()
    assert row.position == "Data Analyst"
    assert row.recommendation_date == dt.datetime(2026, 4, 5, 9, 15)
    assert row.visibility == "VISIBLE"


def test_connections_keep_the_column_order(spark):
    df = clean(
        spark,
        "connections",
        ["First Name", "Last Name", "URL", "Email Address", "Company", "Position", "Connected On"],
        [("Rui", "Silva", "https://example.com/in/x", "r@example.com", "Open", "Engineer", "2026-04-01")],
    )
    assert df.columns == list(EXPORT_TABLES["connections"].contract.required)
    assert df.first().connected_on == dt.datetime(2026, 4, 1)


def test_skills_lose_blanks_and_duplicates(spark, rows):
    df = clean(spark, "skills", ["Name"], [("Python",), (" Python ",), ("",), (None,), ("Python",), ("SQL",)])
    assert rows(df) == [("Python",), ("SQL",)]


def test_rows_that_differ_only_in_a_dropped_column_both_stay(spark, rows):
    df = clean(spark, "skills", ["Name", "Origin"], [("SQL", "a"), ("SQL", "b"), ("SQL", "a")])
    assert rows(df) == [("SQL",), ("SQL",)]


def test_email_addresses(spark, rows):
    df = clean(
        spark,
        "email_addresses",
        ["Email Address", "Confirmed", "Primary", "Updated On"],
        [("a@x.io", "Yes", "No", "Not Available"), ("b@x.io", "?", "sim", "1/1/24"), (" ", "Yes", "Yes", None)],
    )
    assert rows(df) == [("a@x.io", True, False, None), ("b@x.io", None, True, "1/1/24")]


def test_events_split_their_time(spark):
    df = clean(
        spark,
        "events",
        ["Event Name", "Event Time", "Status", "External Url"],
        [("Talk", "Apr 10, 2025 08:00 AM - Apr 10, 2025 05:00 PM", "x", "")],
    )
    row = df.first()
    assert (row.started_at, row.finished_at) == (dt.datetime(2025, 4, 10, 8), dt.datetime(2025, 4, 10, 17))
    assert row.external_url is None


@pytest.mark.parametrize("table", sorted(EXPORT_TABLES))
def test_every_table_has_its_contract_columns_even_without_any_header(spark, table):
    df = EXPORT_TABLES[table].recipe(spark.createDataFrame([("x",)], "Unrelated string"))
    assert df.columns == list(EXPORT_TABLES[table].contract.required)


def test_two_synonyms_in_one_file_are_coalesced(spark, rows):
    df = spark.createDataFrame([(None, "b", 1), ("a", "c", 2)], "start_date string, started string, n int")
    merged = cleaning.rename_synonyms(df, {"started_on": ("start_date", "started")})
    assert rows(merged.select("started_on", "n")) == [("a", 2), ("b", 1)]


def test_deduplicate_by_key_treats_nulls_as_equal_and_keeps_the_smallest(spark, rows):
    df = spark.createDataFrame([(None, 2, "x"), (None, 1, "y"), ("k", 5, "z")], "k string, o int, v string")
    assert rows(cleaning.deduplicate(df, ["k"], ["o"])) == [("k", 5, "z"), (None, 1, "y")]


def test_normalize_columns(spark):
    df = spark.createDataFrame([(1, 2)], "` First Name ` int, `URL` int")
    assert cleaning.normalize_columns(df).columns == ["first_name", "url"]
