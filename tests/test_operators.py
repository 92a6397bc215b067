from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions import lexicon
from tidemark.operators import aggregates, calendar, contracts, json_rates, masking, windows
from tidemark.plans import audit_marts, history
from tidemark.plans.staging import stage

# --- contracts ---------------------------------------------------------------------


def test_contract_counts_duplicates_with_null_keys(spark):
    df = spark.createDataFrame([(None, 1, ""), (None, 1, "x"), ("a", 2, None), ("a", 2, "y"), ("a", 3, "z")], "k string, n int, t string")
    contract = contracts.TableContract(required=("k", "n", "gone"), non_empty=("t",), unique=("k", "n"))
    row = contracts.validate_contract(df, contract).first()
    assert (row.row_count, row.missing_columns, row.duplicate_rows, row.blank_required_values) == (5, "gone", 2, 2)
    empty = contracts.validate_contract(df.limit(0), contract).first()
    assert (empty.row_count, empty.duplicate_rows, empty.blank_required_values) == (0, 0, 0)
    with pytest.raises(contracts.ContractError, match="gone"):
        contracts.assert_columns(df, contract)


def test_null_rates(spark, rows):
    df = spark.createDataFrame([(1, None), (None, None), (3, None)], "a int, b string")
    assert rows(contracts.null_rates(df)) == [("a", 0.3333), ("b", 1.0)]


def test_data_tests(spark, rows):
    df = spark.createDataFrame([("ok", 1), ("odd", None), (None, 3)], "s string, n int")
    tests = [
        contracts.not_null("n"),
        contracts.accepted_values("s", ["ok"]),
        contracts.expression_holds("small", "n", F.col("n") < 3),
    ]
    assert rows(contracts.run_tests(df, tests)) == [("accepted_values", "s", 1), ("not_null", "n", 1), ("small", "n", 1)]


def test_history_contract_reports_each_broken_rule(spark):
    contract = contracts.HistoryContract("fact_x", ("snapshot_date", "gone"), ("n",), ("r",))
    df = spark.createDataFrame(
        [(None, True, None, -1, 1.5), (dt.date(2024, 1, 31), False, "m", 1, 0.5)],
        "snapshot_date date, is_simulated_snapshot boolean, snapshot_method string, n int, r double",
    )
    broken = {(r.rule, r.column_name): r.violations for r in contracts.history_checks(df, contract).collect()}
    assert broken == {
        ("null_date", "snapshot_date"): 1,
        ("simulated", "is_simulated_snapshot"): 1,
        ("null_method", "snapshot_method"): 1,
        ("negative", "n"): 1,
        ("out_of_range", "r"): 1,
        ("no_rows", "*"): 0,
        ("missing", "gone"): 1,
    }
    empty = {r.rule: r.violations for r in contracts.history_checks(df.limit(0), contract).collect()}
    assert empty["no_rows"] == 1


# --- aggregates ---------------------------------------------------------------------


def test_counts_include_empty_tables_and_add_up_shared_labels(spark, rows):
    tables = {"a": spark.range(3), "b": spark.range(0), "c": [spark.range(2), spark.range(5)]}
    assert rows(aggregates.labelled_counts(tables)) == [("a", 3), ("b", 0), ("c", 7)]
    assert rows(aggregates.counts_as_columns({"x": spark.range(4), "y": spark.range(0)})) == [(4, 0)]


def test_top_k_skips_blanks_and_breaks_ties_by_value(spark, rows):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), ("",), (" ",), (None,)], "k string")
    assert rows(aggregates.top_k(df, "k", "n", 2), order=False) == [("c", 2), ("a", 1)]


def test_one_row_puts_aggregates_side_by_side(spark, rows):
    parts = [spark.range(3).agg(F.count(F.lit(1)).alias("n")), spark.range(3).agg(F.max(F.lit("x")).alias("s"))]
    assert rows(aggregates.one_row(*parts)) == [(3, "x")]


def test_monthly_summary_keeps_the_null_month(spark, rows):
    df = spark.createDataFrame([(2024, 3), (2024, 3), (None, None)], "y long, m long")
    out = aggregates.monthly_summary(df, "y", "m", "ym", {"n": F.count(F.lit(1))})
    assert rows(out) == [(2024, 3, "2024-03", 2), (None, None, None, 1)]


# --- windows ------------------------------------------------------------------------


def test_running_operators(spark, rows):
    df = spark.createDataFrame([("2024-01", 4, 10.0), ("2024-02", 0, 0.0), ("2024-03", 2, 4.0)], "ym string, n long, mean double")
    out = df.select(
        "ym",
        windows.running_total("n", "ym").alias("total"),
        windows.delta_vs_previous("n", "ym").alias("delta"),
        windows.growth_vs_previous("n", "ym").alias("growth"),
        windows.running_weighted_mean("mean", "n", "ym").alias("mean"),
    )
    assert rows(out) == [
        ("2024-01", 4, 0, 0.0, 10.0),
        ("2024-02", 4, -4, -1.0, 10.0),
        ("2024-03", 6, 2, 0.0, 8.0),
    ]


def test_previous_values_match_lag_within_and_across_periods(spark, rows):
    rng = random.Random(7)
    start = dt.datetime(2024, 1, 1)
    data = []
    for i in range(600):
        at = start + dt.timedelta(hours=rng.randrange(400))
        data.append((rng.choice(["hot", "hot", "hot", "cold", None]), at, at.date(), i, rng.choice([None, i])))
    df = spark.createDataFrame(data, "k string, at timestamp_ntz, day date, i int, v int").repartition(5)
    plain = Window.partitionBy("k").orderBy("at", "i")
    expected = df.withColumns({"pv": F.lag("v").over(plain), "pi": F.lag("i").over(plain)})
    for ranges in (2, 7, 64):
        got = windows.with_previous(df, {"v": "pv", "i": "pi"}, ["k"], ["at", "i"], ranges)
        assert got.columns == expected.columns and rows(got) == rows(expected)
    undated = df.withColumn("at", F.when(F.col("i") % 3 > 0, F.col("at")))  # rows without a time come first
    expected = undated.withColumns({"pv": F.lag("v").over(plain)})
    assert rows(windows.with_previous(undated, {"v": "pv"}, ["k"], ["at", "i"])) == rows(expected)
    changed = windows.with_changes(df, {"i": "change"}, ["k"], ["at", "i"])
    assert rows(changed) == rows(df.withColumn("change", F.col("i") - F.lag("i").over(plain)))
    assert windows.with_previous(df.limit(0), {"v": "pv"}, ["k"], ["at", "i"]).count() == 0


def test_previous_values_gather_no_key(spark):
    hot = spark.range(40_000, numPartitions=4).select(F.when(F.col("id") >= 0, "hot").alias("k"), "id", (F.col("id") * 7 % 40_000).alias("v"))
    found = windows.with_changes(hot, {"v": "change"}, ["k"], ["id"])
    ids = found.select("id", "change", F.spark_partition_id().alias("p")).where("change is null or change not in (7, -39993)").collect()
    assert [r.id for r in ids] == [0]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "hashpartitioning(__key0#" in plan and "__range#" in plan


def test_months_are_spread_without_the_null_month(spark, rows):
    a = spark.createDataFrame([("2024-01", 1), (None, 9)], "ym string, a int")
    b = spark.createDataFrame([("2024-02", 2.5)], "ym string, b double")
    assert rows(windows.month_spine([a, b], "ym")) == [("2024-01",), ("2024-02",)]
    assert rows(windows.spread_on_months([a, b], "ym", {"a": 0, "b": 0})) == [("2024-01", 1, 0.0), ("2024-02", 0, 2.5)]


# --- audit ----------------------------------------------------------------------------

AUDIT = (
    "table_key string, bronze_table string, source_file string, source_path string, export_type string, "
    "row_count long, column_count long, source_row_count long, row_count_after_transform long, "
    "rows_removed_during_transform long, duplicate_rows_after_transform long, contract_owner string, "
    "contract_description string, required_columns string, null_rate_by_column string, "
    "source_null_rate_by_column string, sensitive_columns string, loaded_at_utc timestamp_ntz"
)


def audit(spark):
    def load(day, source, kept, removed, rates, before):
        at = dt.datetime(2024, 5, day, 6)
        return ("skills", "skills", "Skills.csv", "/x", "complete", kept, 1, source, kept, removed, 0, "o", "d", "c", rates, before, "", at)

    loads = [
        load(1, 10, 8, 2, '{"a": 0.25, "b": "bad"}', '{"a": 0.5}'),
        load(2, None, 9, None, '{"a": 0.5}', None),
        load(3, 0, 0, 0, None, None),
        load(4, 5, 0, 5, "{}", "{}"),
    ]
    return stage("ingestion_audit", spark.createDataFrame(loads, AUDIT))


def test_health_timeline(spark):
    found = audit_marts.health_timeline(audit(spark)).orderBy("loaded_at_utc").collect()
    assert [r.health_status for r in found] == ["atencao", "saudavel", "sem_dados", "esvaziado"]
    assert [r.row_retention_rate for r in found] == [0.8, 1.0, None, 0.0]
    assert [r.row_count_change_vs_previous_load for r in found] == [None, 1, -9, 0]
    assert [r.source_row_count for r in found] == [10, 9, 0, 5]  # falls back on row_count
    assert [r.row_removal_alert_flag for r in found] == [True, False, False, True]


def test_null_rate_timeline(spark):
    found = audit_marts.null_rate_timeline(audit(spark)).orderBy("loaded_at_utc", "monitored_column").collect()
    got = [
        (r.monitored_column, r.null_rate_before_transform, r.null_rate_after_transform, r.null_rate_delta,
         r.null_rate_change_vs_previous_load, r.null_rate_alert_flag)
        for r in found
    ]
    assert got == [
        ("a", 0.5, 0.25, -0.25, None, True),
        ("b", None, None, None, None, False),  # one bad value does not void the others
        ("a", None, 0.5, None, 0.25, True),
    ]


def test_history_from_the_bare_audit(spark):
    run = history.Run("r", dt.datetime(2024, 7, 1))
    found = history.data_quality_from_audit(audit(spark).withColumn("row_count", F.lit(7).cast("long")), run)
    row = found.orderBy("snapshot_date").first()
    assert (row.snapshot_date, row.snapshot_year_month, row.row_count_after_transform) == (dt.date(2024, 5, 1), "2024-05", 7)
    assert row.health_status == "saudavel" and row.source_row_count is None


def test_json_rows_of_an_empty_object_are_kept_as_one_null_row(spark, rows):
    df = spark.createDataFrame([(1, '{"a": 1, "b": "x"}'), (2, "{}"), (3, None)], "id int, j string")
    found = json_rates.explode_rates(df, "j", "k", "v").drop("j")
    assert rows(found) == [(1, "a", 1.0), (1, "b", None), (2, None, None), (3, None, None)]


# --- calendar ---------------------------------------------------------------------------


def test_calendar_covers_whole_months_and_labels_days(spark):
    months = spark.createDataFrame([("2024-02",), (None,)], "ym string")
    stamps = spark.createDataFrame([(dt.datetime(2024, 12, 30, 5), None)], "a timestamp_ntz, b date")
    days = calendar.build_calendar(calendar.date_range([(months, ["ym"]), (stamps, ["a", "b"])]))
    assert len(days.columns) == 22
    found = {r.date: r for r in days.collect()}
    assert min(found) == dt.date(2024, 2, 1) and max(found) == dt.date(2024, 12, 31) and len(found) == 335
    last = found[dt.date(2024, 12, 30)]
    assert (last.date_key, last.week_of_year, last.day_of_week_number, last.day_of_week_name) == (20241230, 1, 1, "Monday")
    assert (last.half_year_label, last.bimester_year_label, last.quarter_label) == ("2024-S2", "2024-B6", "Q4")
    assert (last.month_name, last.month_name_short, last.year_month_label, last.year_label) == (
        "December", "Dec", "2024-Dec", "2024",
    )
    assert found[dt.date(2024, 6, 1)].is_weekend and found[dt.date(2024, 6, 30)].semester_number == 1


def test_calendar_without_dates_is_the_current_year(spark):
    nothing = spark.createDataFrame([(None,)], "d date")
    days = calendar.build_calendar(calendar.date_range([(nothing, ["d"])]), "2023-07-05")
    assert days.agg(F.min("date"), F.max("date")).first() == (dt.date(2023, 1, 1), dt.date(2023, 12, 31))


# --- masking ------------------------------------------------------------------------------


def brute_tokens(values, form):
    known = sorted({v for v in values if v is not None and v.strip()})
    return [form.format(known.index(v) + 1) if v in known else None for v in values]


def test_tokens_match_brute_force_over_many_partitions_and_a_hot_value(spark):
    rng = random.Random(1)
    values = [rng.choice(["hot"] * 3 + [f"v{rng.randrange(1500)}", None, " ", "É", "z'"]) for _ in range(6000)]
    df = spark.createDataFrame(list(enumerate(values)), "i int, full_name string").repartition(7)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")  # keep several dictionary partitions
    try:
        got = masking.mask_names(df, "full_name").orderBy("i").collect()
    finally:
        spark.conf.set(key, before)
    assert [r.full_name for r in got] == brute_tokens(values, "Pessoa {:03d}")


def test_urls_in_the_allow_list_stay_and_do_not_take_a_number(spark, rows):
    df = spark.createDataFrame([("b",), ("a",), ("keep",), (None,)], "url string")
    got = rows(masking.mask_urls(df, "url", "site", ["keep"]))
    assert got == sorted([("https://example.com/site/001",), ("https://example.com/site/002",), ("keep",), (None,)], key=repr)


def test_dates_are_coarsened_by_type_and_by_name(spark):
    df = spark.createDataFrame(
        [(dt.date(2024, 5, 9), dt.datetime(2024, 5, 9, 7), "2024-05-09", "text", "2024-05-09")],
        "d date, t timestamp_ntz, sent_on string, note_at string, plain string",
    )
    row = masking.coarsen_dates(df).first()
    assert tuple(row) == (dt.datetime(2024, 5, 1), dt.datetime(2024, 5, 1), dt.datetime(2024, 5, 1), "text", "2024-05-09")


def test_sanitize_applies_the_name_rules(spark):
    df = spark.createDataFrame(
        [
            ("Ana", "Silva", "Ana Silva", "ACME", "Dev", "SP", "a@x.io", "Street", "Hello", "http://u", "Go", "12"),
            (None, "Reis", "Reis", None, "Dev", None, None, None, None, None, "Go", "13"),
        ],
        "first_name string, last_name string, full_name string, company string, position string, geo_location string, "
        "email_address string, address string, headline string, profile_url string, skill_name string, title_code string",
    )
    got = {r.last_name: r for r in masking.sanitize(df).collect()}
    one = got["Pessoa 002"]
    assert (one.first_name, one.full_name) == ("Pessoa 001", "Pessoa 001 Pessoa 002")
    assert (one.company, one.position, one.geo_location) == ("Empresa 001", "Cargo 001", "Regiao 001")
    assert (one.email_address, one.address) == ("contact001@example.com", None)
    assert one.headline == lexicon.REPLACED_TEXTS["headline"]
    assert one.profile_url == "https://example.com/profile-url/001"
    assert one.skill_name == "Go"  # not a person's name
    assert one.title_code == "12"  # nothing but numbers
    other = got["Pessoa 001"]
    assert (other.full_name, other.headline, other.profile_url) == ("Pessoa 001", None, None)


def test_numbers_follow_the_sorted_order_in_any_ranges(spark, rows):
    rng = random.Random(11)
    values = {"x" * 70 + str(i) for i in range(40)} | {f"v{rng.randrange(10**6)}" for _ in range(300)} | {"é", "Z", "z", "10", "9"}
    df = spark.createDataFrame([(g, v) for g in ("a", "b") for v in values if g == "a" or len(v) < 20], "g string, value string").repartition(5)
    expected = []
    for g in ("a", "b"):
        own = sorted((v for v in values if g == "a" or len(v) < 20), key=lambda v: v.encode())
        expected += [(g, v, i) for i, v in enumerate(own, 1)]
    for ranges in (1, 3, 128):
        assert rows(masking.number_sorted(df, within="g", ranges=ranges)) == sorted(expected, key=repr)
    assert masking.number_sorted(df.limit(0)).count() == 0


def test_sanitizing_runs_no_job_and_shuffles_the_table_once(spark):
    df = spark.createDataFrame(
        [(i, f"f{i % 7}", None if i % 5 == 0 else f"l{i % 11}", f"o{i % 3}", str(i)) for i in range(200)],
        "id long, first_name string, last_name string, company string, position string",
    )
    jobs = spark._jsc.sc().dagScheduler().numTotalJobs
    before = jobs()
    with_codes = masking.sanitize(df)
    assert jobs() == before
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = masking.sanitize(df)._jdf.queryExecution().executedPlan().toString()
        found = {r.id: r for r in masking.sanitize(df).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(found.values()) == sorted(with_codes.collect())
    assert all(r.position == str(i) for i, r in found.items())  # nothing but numbers
    assert found[1].first_name == "Pessoa 002" and found[0].last_name is None
    assert len({r.first_name for r in found.values()}) == 7 and "SortAggregate" not in plan
    wide = [line for line in plan.splitlines() if "Exchange hashpartitioning(__h" in line and "__v" in line]
    assert len(wide) <= 1


def test_cells_of_a_value_that_all_rows_have_do_not_meet_in_one_task(spark):
    """By the last shuffle before the join; counted by the hash that deals it out."""
    rows = 20000
    cells = spark.range(rows).select(F.xxhash64("id").alias("__h"), F.xxhash64(F.lit(1), "id").alias("__k"), "id")
    cells = cells.select("__h", "__k", F.explode(F.array(F.struct(F.lit(0).alias("at"), F.lit("all").alias("value")), F.struct(F.lit(1).alias("at"), F.col("id").cast("string").alias("value")))).alias("c"))
    cells = cells.select("__h", "__k", "c.*")
    counted = cells.groupBy("at", "value").agg(F.count(F.lit(1)).alias("__n"))
    met = masking._join_spread(cells, masking.number_sorted(counted, within="at"), counted)
    assert met.count() == 2 * rows and met.where("at = 0 and index = 1").count() == rows
    assert met.where("at = 1").select("index").distinct().count() == rows
    largest = met.groupBy("at", "value", "__piece").count().agg(F.max("count")).first()[0]
    assert largest < rows / 32


def test_audit_reads_the_written_table_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("a", None), ("a", None), ("a", "x"), (None, "x"), (None, "x")], "k string, v string").write.parquet(path)
    stored, raw = spark.read.parquet(path), spark.range(7).withColumn("id", F.nullif("id", F.lit(0)))
    contract = contracts.TableContract(required=("k", "v"), unique=("k", "v"))

    def audit(table, contract=contract):
        names = dict(table_key="t", source_file="t.csv", source_path="", export_type="basic")
        return contracts.audit_row(raw, table, contract, **names, loaded_at=F.lit(None).cast("timestamp_ntz"))

    found = audit(stored)
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Scan parquet") == 1
    one = found.first()
    assert (one.source_row_count, one.row_count, one.duplicate_rows_after_transform) == (7, 5, 2)
    assert (one.null_rate_by_column, one.source_null_rate_by_column) == ('{"k":0.4,"v":0.4}', '{"id":0.1429}')
    empty = audit(stored.limit(0)).first()
    assert (empty.row_count, empty.duplicate_rows_after_transform, empty.null_rate_by_column) == (0, 0, '{"k":0.0,"v":0.0}')
    assert audit(stored.select("v")).first().duplicate_rows_after_transform is None
    assert audit(stored, contracts.TableContract(required=("k",))).first().duplicate_rows_after_transform == 0
