from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates, lexicon, numeric, text
from tidemark.operators.cleaning import boolean_of


def evaluate(spark, values, build):
    """Results of a column expression over text values, in order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(build(F.col("v")).alias("x")).collect()]


def test_clean_text_strips_all_whitespace_and_blank_markers(spark):
    got = evaluate(spark, ["\t Ana \n", "\xa0x　", "", "nan", " None ", "None x", None], text.clean_text)
    assert got == ["Ana", "x", None, None, None, "None x", None]


def test_model_trim_removes_spaces_only(spark):
    assert evaluate(spark, ["\tx ", "  y  "], text.trim_text) == ["\tx", "y"]


def test_strip_characters_match_python():
    for code in range(0x3001):
        assert (chr(code) in lexicon.STRIP_CHARACTERS) == (chr(code).strip() == ""), hex(code)


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        ("2024-01-05", dt.datetime(2024, 1, 5)),
        ("2024-01-05T10:11:12", dt.datetime(2024, 1, 5, 10, 11, 12)),
        ("2024-01-05 10:11 UTC", dt.datetime(2024, 1, 5, 10, 11)),
        ("2024-01-05T10:11:12Z", dt.datetime(2024, 1, 5, 10, 11, 12)),
        ("2024-03", dt.datetime(2024, 3, 1)),
        ("2024", dt.datetime(2024, 1, 1)),
        ("05 Jan 2020", dt.datetime(2020, 1, 5)),
        ("Jan 2020", dt.datetime(2020, 1, 1)),
        ("January 5, 2020", dt.datetime(2020, 1, 5)),
        ("Apr 10, 2025 08:00 AM", dt.datetime(2025, 4, 10, 8)),
        ("4/5/26, 9:15 PM", dt.datetime(2026, 4, 5, 21, 15)),
        ("4/5/1999", dt.datetime(1999, 4, 5)),
        ("04/05/69", dt.datetime(1969, 4, 5)),
        ("04/05/68", dt.datetime(2068, 4, 5)),
        ("31 Feb 2020", None),
        ("2024-02-30", None),
        ("99 Abc 2020", None),
        ("soon", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_mixed(spark, value, expected):
    assert evaluate(spark, [value], dates.parse_mixed) == [expected]


def test_us_datetime_pivots_years_at_69(spark):
    values = ["04/05/26, 09:15 AM", "12/31/85, 12:00 AM", "12/31/68, 12:30 PM", "13/45/26, 09:15 AM", "x", None]
    assert evaluate(spark, values, dates.parse_us_datetime) == [
        dt.datetime(2026, 4, 5, 9, 15),
        dt.datetime(1985, 12, 31),
        dt.datetime(2068, 12, 31, 12, 30),
        None,
        None,
        None,
    ]


def test_parsed_times_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        # 02:30 does not exist on this day in Berlin.
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        assert evaluate(spark, ["03/30/25, 02:30 AM"], dates.parse_us_datetime) == [dt.datetime(2025, 3, 30, 2, 30)]
        assert evaluate(spark, ["Mar 30, 2025 02:30 AM"], dates.parse_mixed) == [dt.datetime(2025, 3, 30, 2, 30)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_split_range(spark):
    value = "Apr 10, 2025 08:00 AM - Apr 10, 2025 05:00 PM"
    start = evaluate(spark, [value, "all day"], lambda c: dates.parse_month_name_datetime(dates.split_range(c)[0]))
    end = evaluate(spark, [value, "all day"], lambda c: dates.parse_month_name_datetime(dates.split_range(c)[1]))
    assert start == [dt.datetime(2025, 4, 10, 8), None]
    assert end == [dt.datetime(2025, 4, 10, 17), None]


def test_month_and_year_differences_count_calendar_boundaries(spark):
    df = spark.sql(
        "select date '2024-01-31' a, date '2024-02-01' b union all select date '2023-12-31', date '2024-01-01' "
        "union all select date '2024-03-01', date '2024-01-31' union all select date '2024-01-01', null"
    )
    got = df.select(dates.months_between("a", "b"), dates.years_between("a", "b")).collect()
    assert [tuple(r) for r in got] == [(1, 0), (1, 1), (-2, 0), (None, None)]


def test_month_end(spark):
    assert evaluate(spark, ["2024-02", "2023-12", None], dates.month_end) == [
        dt.date(2024, 2, 29),
        dt.date(2023, 12, 31),
        None,
    ]


def test_booleans(spark):
    got = evaluate(spark, [" YES", "sim", "1", "No", "não", "NAO", "maybe", "", None], lambda c: boolean_of(F.trim(c)))
    assert got == [True, True, True, False, False, False, None, None, None]


def test_classify_keeps_the_order_of_rules(spark):
    def skills(c):
        return text.classify(F.lower(c), lexicon.SKILL_CATEGORIES, "other")

    # "databricks" holds "data" and "javascript" holds "java": the earlier rule wins.
    assert evaluate(spark, ["Databricks", "JavaScript", "AWS", "Team work", "Cooking", None], skills) == [
        "analytics",
        "programming",
        "cloud_data",
        "soft_skills",
        "other",
        "other",
    ]

    def languages(c):
        return text.classify(F.lower(c), lexicon.PROFICIENCY_TRACKS, "outros")

    assert evaluate(spark, ["Professional working", "Working", "Limited"], languages) == [
        "profissional",
        "intermediario_profissional",
        "basico",
    ]


def test_title_case_matches_python(spark):
    values = ["o'neil BROS", " são paulo-sp ", "3rd level", "x", "ABC def", ""]
    assert evaluate(spark, values, text.title_case) == [v.strip().title() for v in values]
    assert evaluate(spark, [None], text.title_case) == [""]


def test_display_label(spark):
    got = evaluate(spark, [" nativo", "other one", None], lambda c: text.display_label(c, {"nativo": "Native"}))
    assert got == ["Native", "Other One", ""]


def test_safe_ratio_and_clip(spark):
    df = spark.createDataFrame([(1, 2), (1, 0), (None, 3), (3, None)], "a int, b int")
    assert [r[0] for r in df.select(numeric.safe_ratio("a", "b")).collect()] == [0.5, 0.0, 0.0, 0.0]
    df = spark.createDataFrame([(-1.0,), (0.4,), (7.0,), (None,)], "x double")
    assert [r[0] for r in df.select(numeric.clip_unit("x")).collect()] == [0.0, 0.4, 1.0, None]


def test_mentions_counts_null_as_no(spark):
    assert evaluate(spark, ["Big DATA", "x", None], lambda c: text.mention_count_flag(c, "data")) == [1, 0, 0]
